from datetime import date

import pytest
from conftest import rows_of

from eventmart.functions.names import identifier
from eventmart.operators.windows import DateWindow


def test_none_is_the_full_source():
    assert DateWindow.parse(None) is None


@pytest.mark.parametrize(
    "bad",
    [
        {},
        {"start": "x", "end": "2024-01-01"},
        {"start": "2024-01-02", "end": "2024-01-01"},
        {"start": "2024-01-01", "end": "2024-05-01"},
        {"start": "2024-01-01", "end": "2024-01-02", "more": 1},
        {"start": 20240101, "end": "2024-01-02"},
        "2024-01-01",
    ],
)
def test_bad_windows_are_rejected(bad):
    with pytest.raises((ValueError, TypeError)):
        DateWindow.parse(bad)


def test_longest_window():
    assert DateWindow.parse({"start": "2024-01-01", "end": "2024-04-09"}).end == date(2024, 4, 9)
    with pytest.raises(ValueError):
        DateWindow.parse({"start": "2024-01-01", "end": "2024-04-10"})


def test_bounds_are_inclusive(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-05')) AS d")
    window = DateWindow.parse({"start": "2024-01-02", "end": "2024-01-03"})
    want = [(date(2024, 1, 2),), (date(2024, 1, 3),)]
    assert rows_of(days.where(window.covers("d"))) == want
    assert rows_of(days.where(window.condition("d"))) == want
    assert rows_of(days.where(window.contains(days.d))) == want
    texts = days.selectExpr("CAST(d AS STRING) AS d")
    assert rows_of(texts.where(window.covers_text("d"))) == [("2024-01-02",), ("2024-01-03",)]


@pytest.mark.parametrize("bad", ["", "A", "1a", "a b", "a;drop", 'a"', None])
def test_identifiers(bad):
    with pytest.raises(ValueError):
        identifier(bad)
    assert identifier("stg_raw_events2") == "stg_raw_events2"
