"""One lake: both marts, the audit history and publications below a root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmart.functions.names import identifier
from eventmart.schemas import MARTS
from eventmart.session import small_frame
from eventmart.storage.audit import AuditHistory
from eventmart.storage.snapshots import Mart


class Lake:
    def __init__(self, spark: SparkSession, root: str, database: str = "eventmart"):
        self.spark, self.root, self.database = spark, root.rstrip("/"), identifier(database)
        self.dim_users = Mart(spark, f"{self.root}/dim_users", MARTS["dim_users"])
        self.fct_events = Mart(spark, f"{self.root}/fct_events", MARTS["fct_events"])
        self.audit = AuditHistory(spark, f"{self.root}/audit", self.database)

    @property
    def marts(self) -> dict[str, Mart]:
        return {"dim_users": self.dim_users, "fct_events": self.fct_events}

    def snapshot_ids(self) -> dict[str, int | None]:
        """Current snapshot number of each mart, from its ref ``main``."""
        return {name: mart.current_id() for name, mart in self.marts.items()}

    def snapshot_log(self) -> DataFrame:
        """All snapshots on the current history of both marts (one row per commit)."""
        rows = []
        for name, mart in self.marts.items():
            chain = mart.history()
            for s in chain:
                rows.append((name, s.id, s.parent, s.committed_at.replace(tzinfo=None), s.rows, s is chain[-1]))
        return small_frame(
            self.spark,
            rows,
            "mart string, snapshot_id long, parent_id long, committed_at timestamp_ntz, "
            "rows long, is_current boolean",
        )
