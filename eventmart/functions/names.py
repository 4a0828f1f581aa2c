"""Checked identifiers for view and database names."""

from __future__ import annotations

import re


def identifier(value: str) -> str:
    if not isinstance(value, str) or not re.fullmatch(r"[a-z][a-z0-9_]*", value):
        raise ValueError(f"invalid identifier: {value!r}")
    return value
