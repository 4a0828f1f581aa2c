"""Verdicts on URLs: given rules first, association rules mined from their verdicts for the rest."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import LOWER, UPPER, field, packed, unpacked, written

# Fixed values of the contract: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.6
VERDICT = "verdict="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-case host and path of a URL; both empty if it is null or has no ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _given(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits; the rules are a bounded parameter."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _tokens() -> Column:
    """What a URL is made of, as a sorted set; numbers are left out, as they name single pages."""
    labels = F.filter(F.split(F.regexp_replace("host", r"\.?[^.]+\.[^.]+\z", ""), r"\."), lambda x: x != "")
    parts = F.filter(F.split("path", "/"), lambda x: (x != "") & ~x.rlike(r"\A[0-9]+(\.[A-Za-z0-9]+)?\z"))
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.regexp_extract(x, r"\A[^=]*", 0))
    ending = F.regexp_extract("path", r"\.([A-Za-z0-9]+)\z", 1)
    marks = F.array(
        F.concat(F.lit("scheme="), F.regexp_extract("url", r"\A([^:/?#]*)://", 1)),
        F.concat(F.lit("site="), F.regexp_extract("host", r"([^.]+\.[^.]+)\z", 1)),
        F.when(ending != "", F.concat(F.lit("ending="), ending)),
        F.when(F.instr("url", "#") > 0, F.lit("fragment")),
        F.when(F.endswith("path", F.lit("/")), F.lit("slash")),
    )

    def prefixed(prefix, values):
        return F.transform(values, lambda x: F.concat(F.lit(prefix), x))

    every = F.concat(prefixed("label=", labels), prefixed("part=", parts), prefixed("key=", keys), F.array_compact(marks))
    return F.sort_array(F.array_distinct(F.coalesce(F.array_compact(every), F.array().cast("array<string>"))))


def items_of(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """(token, item, count) of the tokens in a ``min_support`` share of all rows with ``row`` and ``tokens``.

    Tokens of exactly the same rows are one item, named by the least of them: whichever of them a
    rule asks for, its support and confidence are the same. A template of many fixed parts thus has
    one item, where its combinations would be 2 to the number of parts. The rows of a token are compared by
    their number and two sums of hashes. At most 1 / ``min_support`` times as many tokens
    are common as a row has on average, whatever the number of rows.
    """
    rows = labelled.count()
    sums = [F.sum(F.xxhash64("row", F.lit(seed)).cast("decimal(20, 0)")).alias(f"rows{seed}") for seed in (1, 2)]
    counted = labelled.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"), *sums)
    common = counted.where(F.col("count") >= math.ceil(min_support * rows))
    least = common.groupBy("count", "rows1", "rows2").agg(F.min("token").alias("item"))
    return common.join(least, ["count", "rows1", "rows2"]).select("token", "item", "count")


def mined_rules(labelled: DataFrame, *, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) of rows with ``tokens`` and ``verdict``.

    FP-growth finds the token combinations; rules below the support or confidence, and rules
    that conclude anything but a verdict, are pruned.
    """
    items = labelled.select(F.array_append("tokens", F.concat(F.lit(VERDICT), F.col("verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.startswith(F.get("consequent", F.lit(0)), F.lit(VERDICT)))
    rules = rules.where(~F.exists("antecedent", lambda x: F.startswith(x, F.lit(VERDICT))))
    verdict = F.substring(F.get("consequent", F.lit(0)), len(VERDICT) + 1, 1 << 20)
    return rules.select(F.sort_array("antecedent").alias("needs"), verdict.alias("says"), "confidence", "support")


def url_filter(
    pages: DataFrame,
    *,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Every row with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    A page that a given rule fits gets the longest rule's verdict. These pages are the labels
    from which the other rules are mined. Any other page gets the verdict of the mined rule
    of highest confidence (then support, then more tokens, then order of text) among those
    whose tokens it has all; without such a rule the commoner verdict of the labels, allow if
    there are as many or no labels. Null, empty and odd URLs have empty host and path and are
    judged like any page without a rule. Columns of the added names are replaced; an empty
    table gives an empty result.

    Tokens that the labels never tell apart are one item in a rule, and any of them fits it (see
    ``items_of``). Only distinct token sets of the pages are matched: each looks up its items in an
    inverted index that holds every mined rule once, under its rarest item.
    """
    whole = pages.select(packed(pages).alias("row"), field(url).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    parsed = whole.withColumns({"host": host, "path": path})
    name, verdict = _given(rules)
    tokens = parsed.withColumns({"rule": name, "given": verdict, "tokens": _tokens()}).drop("url")
    tokens = written(tokens.withColumn("number", F.monotonically_increasing_id()), "urls")
    labelled = tokens.where(F.col("given").isNotNull()).select(F.col("number").alias("row"), "tokens", F.col("given").alias("verdict"))
    counts = dict(tuple(r) for r in labelled.groupBy("verdict").count().collect())
    default = F.lit("block" if counts.get("block", 0) > counts.get("allow", 0) else "allow")
    sets = tokens.where(F.col("given").isNull()).select("tokens").distinct()
    if counts:
        items = written(items_of(labelled, min_support), "items")  # bounded by the support, see there
        as_items = (
            labelled.select("row", F.explode("tokens").alias("token"))
            .join(F.broadcast(items), "token")
            .groupBy("row")
            .agg(F.collect_set("item").alias("items"))
        )
        reduced = labelled.join(as_items, "row", "left").select("verdict", F.coalesce("items", F.array().cast("array<string>")).alias("tokens"))
        mined = written(mined_rules(reduced, min_support=min_support, min_confidence=min_confidence), "mined-rules")
        index = written(
            mined.select("*", F.explode("needs").alias("item"))
            .join(F.broadcast(items.select("item", "count").distinct()), "item")
            .groupBy("needs", "says", "confidence", "support")
            .agg(F.min(F.struct("count", "item")).alias("rarest"))
            .select("needs", "says", "confidence", "support", F.col("rarest.item").alias("item")),
            "rule-index",
        )
        held = (
            sets.select("tokens", F.explode("tokens").alias("token"))
            .join(F.broadcast(items), "token")
            .groupBy("tokens")
            .agg(F.collect_list(F.struct("item", "token")).alias("held"))
        )
        has = F.array_distinct(F.col("held.item"))
        asked = F.filter("held", lambda h: F.array_contains("needs", h["item"]))
        fits = F.sort_array(F.transform(asked, lambda h: h["token"]))
        rank = F.struct("confidence", "support", F.size(fits), F.array_join(fits, " "), "says")
        found = (
            held.select("tokens", "held", F.explode(has).alias("item"))
            .join(index, "item")
            .where(F.size(F.array_except("needs", has)) == 0)
            .groupBy("tokens")
            .agg(F.max_by("says", rank).alias("mined"))
        )
        found = written(found, "set-verdicts")
        tokens = tokens.join(found, "tokens", "left")
    else:
        tokens = tokens.withColumn("mined", F.lit(None).cast("string"))
    verdict = F.coalesce("given", "mined", default)
    return unpacked(tokens, "row", {"host": F.col("host"), "path": F.col("path"), "rule": F.col("rule"), "verdict": verdict})
