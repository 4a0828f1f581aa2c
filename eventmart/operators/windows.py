"""Inclusive UTC date windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DAYS = 100


@dataclass(frozen=True)
class DateWindow:
    start: date
    end: date

    @classmethod
    def parse(cls, value) -> "DateWindow | None":
        """Check ``{"start", "end"}``; ``None`` means the full source."""
        if value is None or isinstance(value, cls):
            return value
        if not isinstance(value, dict) or value.keys() != {"start", "end"}:
            raise ValueError("a window needs exactly start and end")
        window = cls(date.fromisoformat(value["start"]), date.fromisoformat(value["end"]))
        if not timedelta(0) <= window.end - window.start < timedelta(days=MAX_DAYS):
            raise ValueError(f"a window holds 1 to {MAX_DAYS} days, start first")
        return window

    def covers(self, day: Column | str) -> Column:
        """Date column inside the window (prunes partitions on a partition column)."""
        day = F.col(day) if isinstance(day, str) else day
        return day.between(F.lit(self.start), F.lit(self.end))

    def contains(self, day: Column) -> Column:
        """The same for a costly date expression: IN evaluates it once, BETWEEN twice.

        Twice also makes the generated code of the text parser too large for the JIT.
        The list is bounded by ``MAX_DAYS``.
        """
        days = (self.end - self.start).days + 1
        return day.isin(*[self.start + timedelta(n) for n in range(days)])

    def condition(self, day: str) -> str:
        """``covers`` as SQL text, for a date expression."""
        return f"{day} BETWEEN DATE'{self.start}' AND DATE'{self.end}'"

    def covers_text(self, day: Column | str) -> Column:
        """The same for a string partition key; no cast, so partitions are pruned."""
        day = F.col(day) if isinstance(day, str) else day
        return day.between(F.lit(self.start.isoformat()), F.lit(self.end.isoformat()))

    def document(self) -> dict:
        return {"start": self.start.isoformat(), "end": self.end.isoformat()}
