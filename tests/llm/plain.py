"""Helpers of the operators' tests: awkward tables and plain versions of the operators."""

from __future__ import annotations

import os
import re

import pytest

SMOKE = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="no driver tables")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or add; here they are ordinary columns.
CLASHES = ["row", "ident", "digest", "rid", "left", "name", "place", "unit", "set", "node", "held", "p", "key", "label", "chars", "content"]

WORDS = "the cat sat on a mat and then it ran far away over hills to find some more food for all its young kittens".split()


def long_text(words: int = 60_000) -> str:
    return " ".join(WORDS[(k * k + k // 7) % len(WORDS)] for k in range(words))


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns."""
    rows = [
        (1, "The cat sat.\nshared line\nend", "en", "a", 5),
        (2, "the cat  sat.\tshared", "en", "a", None),
        (3, "the cat sat. shared", "en", None, 1),
        (4, None, "en", "b", 1),
        (5, "", None, "b", 0),
        (6, " \n\t\n ", "fr", None, 3),
        (7, long_text(), "en", "a", 9),
        (7, long_text(), "en", "a", 9),
        (None, "nobody\nknows this", "en", "b", 2),
        (None, "nobody\nknows this", "en", "b", 2),
        (8, "żółć 漢字 🙂 ▁ <s>", None, "c", None),
        (9, "...!!!", "en", "c", 6),
        (10, "nobody\nknows this", None, None, None),
    ]
    table = spark.createDataFrame(rows, DOCS)
    for c in CLASHES:
        table = table.withColumn(c, table["n_chars"])
    return table


def none_of(spark):
    return awkward(spark).limit(0)


def normalised(text) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingle_set(text, n: int = 5) -> frozenset:
    words = (text or "").split()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def jaccard(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0
