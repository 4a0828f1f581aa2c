import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from eventmart.plans.lake import Lake  # noqa: E402
from eventmart.session import session  # noqa: E402
from eventmart.sources import generate  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A zone with clock changes: results must not depend on the session zone.
    started = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.session.timeZone": "America/New_York",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    started.sparkContext.setLogLevel("ERROR")
    yield started
    started.stop()


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def sample_events(spark):
    """The 24 sample events."""
    return generate.events_frame(spark, 24, 6).cache()


@pytest.fixture(scope="session")
def sample_users(spark):
    """The 6 sample users."""
    return generate.users_frame(spark, 6).cache()


@pytest.fixture()
def conf(spark):
    """Set session options for one test."""
    old = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows_of(df):
    """Rows as sorted tuples, for whole-table comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
