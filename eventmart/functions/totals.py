"""Exact sums of doubles, independent of the order and grouping of rows.

An amount counts as the decimal number that it prints as, whatever its size. It is split into digits of base
10^6, each with its place; the digits of a place are added up as integers, in any grouping,
and put together once per result: carried, rounded half up, and parsed as the nearest double.
All of it is SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Decimal digits of one place.
WIDTH = 6
BASE = 10**WIDTH
#: Places that a double or a sum of fewer than 10^18 of them can have.
LOWEST, HIGHEST = -55, 55
PLACE, PART, ROWS = "_place", "_part", "_rows"


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _power(n: Column) -> Column:
    """10^n for 0 <= n <= ``WIDTH``."""
    return F.get(F.lit([10**k for k in range(WIDTH + 1)]), n.cast("int")).cast("long")


def digits(rows: DataFrame, amount: str, by: list[str]) -> DataFrame:
    """``by`` with one row per non-zero digit of each amount: place, part (signed) and rows.

    The first digit of an amount counts its row, the others count none; zero and null have one
    digit, null a null one. Infinite amounts and NaN raise.
    """
    value = F.col(amount).cast("double")
    finite = F.when(F.isnan(value) | (F.abs(value) == float("inf")), F.raise_error(F.lit("an amount is not finite"))).otherwise(F.abs(value))
    text = finite.cast("string")
    rows = rows.select(*by, (value < 0).alias("_minus"), text.alias("_text"))
    mantissa = F.substring_index("_text", "E", 1)
    written = F.coalesce(F.when(F.contains("_text", F.lit("E")), F.substring_index("_text", "E", -1).cast("int")), F.lit(0))
    exponent = written - F.char_length(F.substring_index(mantissa, ".", -1))  # a mantissa always has a point
    rows = rows.select(*by, "_minus", F.replace(mantissa, F.lit("."), F.lit("")).cast("long").alias("_whole"), exponent.alias("_exponent"))
    place = F.floor(F.col("_exponent") / WIDTH).cast("int")
    shift = F.col("_exponent") - place * WIDTH
    rows = rows.select(*by, "_minus", "_whole", place.alias("_first"), _power(shift).alias("_up"), _power(WIDTH - shift).alias("_cut"))
    above = _div(F.col("_whole"), F.col("_cut"))
    parts = F.array(
        F.col("_whole") % F.col("_cut") * F.col("_up"), above % BASE, _div(above, _long(BASE)) % BASE, _div(above, _long(BASE**2))
    )
    rows = rows.select(*by, "_minus", "_first", F.posexplode(parts).alias("_k", "_digit"))
    sign = F.when(F.col("_minus"), -1).otherwise(1)
    return rows.where("_k = 0 OR _digit <> 0").select(
        *by,
        F.when(F.col("_digit") != 0, F.col("_first") + F.col("_k")).otherwise(0).alias(PLACE),
        (F.col("_digit") * sign).alias(PART),
        F.when(F.col("_k") == 0, 1).otherwise(0).cast("long").alias(ROWS),
    )


def added(digit_rows: DataFrame, by: list[str]) -> DataFrame:
    """The digits of each place added up; may be repeated with coarser keys."""
    return digit_rows.groupBy(*by, PLACE).agg(F.sum(PART).alias(PART), F.sum(ROWS).alias(ROWS))


def _carried(places: Column) -> Column:
    """Digits from the lowest place up, each below the base, and what is carried beyond the last."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("digits"))

    def step(state: Column, digit: Column) -> Column:
        total = digit + state["carry"]
        low = F.pmod(total, _long(BASE))
        return F.struct(_div(total - low, _long(BASE)).alias("carry"), F.concat(state["digits"], F.array(low)).alias("digits"))

    return F.aggregate(places, start, step)


def total(found: Column, scale: int) -> Column:
    """The double nearest to the sum, rounded half up to ``scale`` (up to 12) decimal places.

    ``found`` is a map from place to added digits; null if no amount was there.
    """
    if not 0 <= scale <= 2 * WIDTH:
        raise ValueError(f"scale must be from 0 to {2 * WIDTH}")
    every = F.sequence(F.lit(LOWEST), F.lit(HIGHEST))
    sums = F.transform(every, lambda k: F.coalesce(F.try_element_at(found, k), F.lit(0).cast("long")))
    # half a unit of the last wanted place is added to the absolute value, then the rest is cut off
    place, digit = -(-(scale + 1) // WIDTH), 5 * 10 ** (-(scale + 1) % WIDTH)

    def rounded(values: Column) -> Column:
        return F.transform(values, lambda v, i: F.when(i == -place - LOWEST, v + digit).otherwise(v))

    plain, turned = _carried(sums), _carried(F.transform(sums, lambda v: -v))
    minus = plain["carry"] < 0
    size = _carried(rounded(F.when(minus, turned["digits"]).otherwise(plain["digits"])))["digits"]
    shown = F.transform(size, lambda v: F.lpad(v.cast("string"), WIDTH, "0"))
    joined = F.array_join(F.reverse(shown), "")
    before = (HIGHEST + 1) * WIDTH
    text = F.concat(F.substring(joined, 1, before), F.lit("."), F.substring(joined, before + 1, scale), F.lit("0"))
    value = text.cast("double")
    return F.when(F.size(found) > 0, F.when(minus, -value).otherwise(value))


def totals(rows: DataFrame, amount: str, by: list[str], scale: int = 2) -> DataFrame:
    """``by``, ``events`` (rows) and ``amount`` (exact total, null if all amounts are)."""
    return put_together(added(digits(rows, amount, by), by), by, scale)


def put_together(sums: DataFrame, by: list[str], scale: int = 2) -> DataFrame:
    """The result rows of ``added``: a few places per group."""
    known = F.when(F.col(PART).isNotNull(), F.struct(PLACE, PART))
    grouped = sums.groupBy(*by).agg(F.sum(ROWS).alias("events"), F.map_from_entries(F.collect_list(known)).alias("_found"))
    return grouped.select(*by, "events", total(F.col("_found"), scale).alias("amount"))
