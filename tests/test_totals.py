"""Exact totals of doubles against Python's decimals."""

from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventmart.functions import totals


def expected(values, scale=2):
    known = [Decimal(v if isinstance(v, str) else repr(v)) for v in values if v is not None]
    if not known:
        return None
    with localcontext() as c:
        c.prec = 1200
        return float(sum(known).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP))


def result(spark, values, scale=2):
    rows = spark.createDataFrame([("a", v) for v in values], "k string, v double").repartition(3)
    (found,) = totals.totals(rows, "v", ["k"], scale).collect()
    assert found["events"] == len(values)
    return found["amount"]


CASES = [
    [1e300, 1e-9, -1e300],
    [1e300] * 7 + [1e-9] * 3,
    [4e-7] * 12_500,
    [4e-7] * 12_499,
    [0.005, 1.005, 2.675],
    [-0.005, -1.005],
    [0.1] * 10 + [0.2, -1.2],
    [1e33, 1e32, -0.004],
    [1.7976931348623157e308, 4.9e-324, -4.9e-324],
    [4.9e-324] * 3,
    [123456789012345.67, 9007199254740993.0, 0.01],
    [0.0, -0.0, None],
    [None, None],
    [1e-3, 9999999.0, 1e7, 12345678.9],
    [99999999.995, 0.0],
]


@pytest.mark.parametrize("scale", [0, 2, 9, 12])
@pytest.mark.parametrize("values", CASES, ids=lambda v: f"{len(v)}x{v[0]}")
def test_extremes(spark, values, scale):
    assert result(spark, values, scale) == expected(values, scale)


def test_infinite_totals_and_amounts(spark):
    assert result(spark, [1.7e308] * 3) == float("inf") and result(spark, [-1.7e308] * 3) == float("-inf")
    for bad in (float("nan"), float("inf"), float("-inf")):
        with pytest.raises(Exception, match="not finite"):
            result(spark, [1.0, bad])
    with pytest.raises(ValueError):
        totals.total(None, 13)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False), st.decimals(-(10**9), 10**9, places=3).map(float)), min_size=1))
def test_any_amounts(spark, values):
    # as Spark prints them: some Java versions print more digits than needed
    shown = spark.createDataFrame([(v,) for v in values], "v double").selectExpr("CAST(v AS STRING)").collect()
    assert result(spark, values) == expected([r[0] for r in shown])


def test_grouping_does_not_matter(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id % 3 AS k", "id % 50 AS u", "pow(10, id % 40 - 20) * IF(id % 2 = 0, 1, -1) / 3 AS v")
    once = totals.put_together(totals.added(totals.digits(rows, "v", ["k"]), ["k"]), ["k"])
    first = totals.added(totals.digits(rows, "v", ["k", "u"]), ["k", "u"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, totals.put_together(totals.added(first, ["k"]), ["k"]).collect()))
    values = [r["v"] for r in rows.where("k = 1").selectExpr("CAST(v AS STRING) AS v").collect()]
    assert dict((r["k"], r["amount"]) for r in once.collect())[1] == expected(values)
