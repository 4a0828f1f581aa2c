"""Raw events and users shaped from the driver's ``events``, ``customer``, ``nation``.

``clean`` passes every check. ``dirty`` breaks each staging check, ``changed`` is a
later state of the source: new amounts, moved dates, renamed users, and rows that
are gone. All are plain projections of the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.schemas import RAW_EVENTS, RAW_USERS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(ts: Column) -> Column:
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def _mapped_type() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "view", "page_view").when(kind == "error", "logout").otherwise(kind)


def _events(rows: DataFrame, **replaced: Column) -> DataFrame:
    columns = {
        "event_id": F.col("event_id").cast("string"),
        "user_id": F.col("user_id").cast("string"),
        "event_type": _mapped_type(),
        "page": F.concat(F.lit("/products/"), _k()),
        "timestamp": _iso(F.col("ts")),
        "session_id": F.expr("event_id div 8").cast("string"),
        "amount": F.col("value"),
    } | replaced
    return rows.select(*[columns[name].alias(name) for name in RAW_EVENTS.names])


def _users(spark: SparkSession, sf_dir: str, rows: DataFrame, **replaced: Column) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    mail = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    columns = {
        "user_id": F.col("c_custkey").cast("string"),
        "name": F.col("c_name"),
        "email": mail,
        "created_at": F.lit("2024-01-01T00:00:00+00:00"),
        "country": F.col("n_name"),
    } | replaced
    joined = rows.join(nation, "c_nationkey", "left")
    return joined.select(*[columns[name].alias(name) for name in RAW_USERS.names])


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(table(spark, sf_dir, "events"))


def mills_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events with amounts of three decimals."""
    amount = (F.col("value").cast("decimal(18, 2)") + F.lit(0.005).cast("decimal(4, 3)")).cast("double")
    return _events(table(spark, sf_dir, "events"), amount=amount)


def extreme_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups of tiny amounts, clicks of huge ones of either sign, and purchases beside huge amounts that cancel out."""
    rows = table(spark, sf_dir, "events")
    even = F.col("event_id") % 2 == 0
    kind = F.col("event_type")
    amount = F.when(kind == "signup", 4e-7).when(kind == "click", F.when(even, 1e300).otherwise(-1e300)).otherwise(F.col("value"))
    every = F.array(F.struct(amount.alias("amount")), *[F.struct(F.lit(v).alias("amount")) for v in (1e300, -1e300)])
    copies = F.explode(F.when(kind == "purchase", every).otherwise(F.slice(every, 1, 1)))
    return _events(rows.select("*", copies.alias("copy")), amount=F.col("copy.amount"))


def doubled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events, but clicks with twice the amount."""
    amount = F.when(F.col("event_type") == "click", F.col("value") * 2).otherwise(F.col("value"))
    return _events(table(spark, sf_dir, "events"), amount=amount)


def unloadable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text; some values of ``props.k`` have amounts that are no finite number, or no JSON."""
    rows = table(spark, sf_dir, "events")
    k = _k()
    odd = {"1": '"NaN"', "2": '"Infinity"', "3": "-1e400", "4": '"-Infinity"', "5": "NaN"}
    amount = F.col("value").cast("string")
    for value, text in odd.items():
        amount = F.when(k == value, F.lit(text)).otherwise(amount)
    shaped = _events(rows, amount=amount)
    others = F.to_json(F.struct(*[c for c in RAW_EVENTS.names if c != "amount"]))
    line = F.concat(F.regexp_replace(others, r"\}$", ""), F.lit(',"amount":'), F.col("amount"), F.lit("}"))
    broken = F.col("page") == "/products/6"
    return shaped.select(F.when(broken, F.lit('{"event_id": ')).otherwise(line).alias("value"))


def clean_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(spark, sf_dir, table(spark, sf_dir, "customer"))


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two unknown types, and one kind of defect for some values of ``props.k``."""
    k, clean_time = _k(), _iso(F.col("ts"))
    return _events(
        table(spark, sf_dir, "events"),
        event_type=F.when(k != "0", F.col("event_type")),
        user_id=F.when(k == "1", "missing").when(k != "2", F.col("user_id").cast("string")),
        timestamp=F.when(k == "3", "invalid").when(k != "4", clean_time),
        event_id=F.when(k == "6", F.concat(F.lit("twin-"), F.col("user_id").cast("string"))).when(
            k != "5", F.col("event_id").cast("string")
        ),
        amount=F.when(k == "7", -F.col("value")).otherwise(F.col("value")),
    )


def dirty_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    nation = F.col("c_nationkey").cast("string")
    mail = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
    shared = F.concat(F.lit("shared-"), nation, F.lit("@example.com"))
    twin = F.concat(F.lit("twin-"), nation)
    return _users(
        spark,
        sf_dir,
        table(spark, sf_dir, "customer"),
        user_id=F.when(balance.between(8000, 9000), twin)
        .when(balance.between(7900, 7999), F.lit(None))
        .otherwise(F.col("c_custkey").cast("string")),
        name=F.when(~balance.between(7000, 7500), F.col("c_name")),
        email=F.when(balance < 0, shared).when(~balance.between(6000, 6500), mail),
        created_at=F.when(balance.between(5000, 5500), "never").otherwise("2024-01-01T00:00:00Z"),
    )


def changed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No logouts any more, doubled click amounts, signups one day later."""
    rows = table(spark, sf_dir, "events").where("event_type <> 'error'")
    kind, ts = F.col("event_type"), F.col("ts")
    return _events(
        rows,
        amount=F.when(kind == "click", F.col("value") * 2).otherwise(F.col("value")),
        timestamp=F.when(kind == "signup", _iso(F.timestamp_add("DAY", F.lit(1), ts))).otherwise(_iso(ts)),
    )


def changed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No furniture customers any more, machinery customers renamed, one country unset."""
    rows = table(spark, sf_dir, "customer").where("c_mktsegment <> 'FURNITURE'")
    renamed = F.concat(F.col("c_name"), F.lit(" Jr"))
    segment = F.col("c_mktsegment")
    return _users(
        spark,
        sf_dir,
        rows,
        name=F.when(segment == "MACHINERY", renamed).otherwise(F.col("c_name")),
        country=F.when(segment != "BUILDING", F.col("n_name")),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-log text with one run per user and one query per event.

    Each query has a submission line; all but ``error`` events also have a line of
    statistics, clicks log it twice, and some lines are no JSON object.
    """
    query = F.concat(F.lit("q-"), F.col("event_id").cast("string")).alias("query_id")
    run = F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("execution_id")
    submitted = F.to_json(F.struct(query, run, F.lit("submitted").alias("phase")))
    finished = F.to_json(
        F.struct(
            query,
            F.lit("SUCCEEDED").alias("state"),
            F.round(F.col("value") * 1000000).cast("long").alias("bytes_scanned"),
            _k().cast("long").alias("engine_ms"),
        )
    )
    kind = F.col("event_type")
    text = F.when(kind == "view", F.concat(F.lit("START "), query)).when(kind == "purchase", F.lit("[1]"))
    lines = F.array(
        submitted,
        F.when(kind != "error", finished),
        F.when(kind == "click", finished),
        text,
    )
    rows = table(spark, sf_dir, "events").select(F.explode(lines).alias("value"))
    return rows.where("value IS NOT NULL")


def log_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duration and input size of each run in ``log_lines``."""
    seconds = F.timestamp_diff("SECOND", F.min("ts"), F.max("ts"))
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(seconds.alias("duration_seconds"), F.count(F.lit(1)).alias("input_events"))
        .select(
            F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("execution_id"),
            "duration_seconds",
            "input_events",
        )
    )
