import pytest

from eventmart.functions.timeparse import SQL_FUNCTION, utc_millis

# text -> UTC time in milliseconds, or None
CASES = {
    "2024-01-01T00:00:01+00:00": "2024-01-01 00:00:01",
    "2024-01-01T00:00:01Z": "2024-01-01 00:00:01",
    "2024-01-01T05:30:00+05:30": "2024-01-01 00:00:00",
    "2024-01-01T23:30:00-02:00": "2024-01-02 01:30:00",
    "2024-01-01T00:00:01+0530": "2023-12-31 18:30:01",
    "2024-01-01T00:00:01+05": "2023-12-31 19:00:01",
    "2024-01-01T00:00:01.1Z": "2024-01-01 00:00:01.1",
    "2024-01-01T00:00:01.12+00:00": "2024-01-01 00:00:01.12",
    "2024-01-01T00:00:01.123956Z": "2024-01-01 00:00:01.123",
    "2024-01-01T00:00:01.123956+01:00": "2023-12-31 23:00:01.123",
    "2024-01-01T00:00:01.123456789Z": "2024-01-01 00:00:01.123",
    "2024-03-10T02:30:00.123999Z": "2024-03-10 02:30:00.123",
    "2024-03-10T02:30:00": "2024-03-10 02:30:00",
    "1969-12-31T23:59:59.9995Z": "1969-12-31 23:59:59.999",
    "1969-12-31T23:59:59.9995+00:30": "1969-12-31 23:29:59.999",
    "2024-01-01": "2024-01-01 00:00:00",
    "2024-01-01T00:00Z": "2024-01-01 00:00:00",
    "2024-01-01T07Z": "2024-01-01 07:00:00",
    "2024-01-01T07": "2024-01-01 07:00:00",
    "2024-01-01T07+01:00": "2024-01-01 06:00:00",
    "2024-01-01T07:15": "2024-01-01 07:15:00",
    "2024": None,
    "12:30:00": None,
    "2024-01-01 00:00:01": None,
    " 2024-01-01T00:00:01Z": None,
    "2024-01-01T00:00:01Z ": None,
    "2024-01-01T00:00:01Z\n": None,
    "invalid": None,
    "2024-02-30T00:00:00Z": None,
    "2024-02-30T00:00:00+01:00": None,
    "2024-01-01T25:00:00Z": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Asia/Kolkata"])
def test_parse_table(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    spark.sql(SQL_FUNCTION)
    texts = spark.createDataFrame([(t,) for t in CASES], "t string")
    rows = texts.select(
        "t",
        utc_millis("t").cast("string").alias("frame"),
    ).selectExpr("*", "CAST(utc_millis(t) AS STRING) AS sql").collect()
    for row in rows:
        want = CASES[row.t]
        assert (row.frame, row.sql) == (want, want), row


def test_result_has_no_zone(spark):
    typed = spark.range(1).selectExpr("'2024-01-01' AS t").select(utc_millis("t").alias("at"))
    assert dict(typed.dtypes) == {"at": "timestamp_ntz"}
