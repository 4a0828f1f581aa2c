"""Append-only audit history of quality checks."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from eventmart.schemas import AUDIT
from eventmart.session import small_frame
from eventmart.storage import files


class AuditHistory:
    def __init__(self, spark: SparkSession, root: str, database: str):
        self.spark, self.root, self.database = spark, root, database

    def append(self, results: list[dict], invocation: str) -> None:
        """One row per check; the columns not listed here stay null."""
        now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
        rows = []
        for r in results:
            known = {
                "id": str(uuid.uuid4()),
                "invocation_id": invocation,
                "detected_at": now,
                "created_at": now,
                "database_name": self.database,
                "schema_name": self.database,
                "table_name": r["model"],
                "column_name": r["column"],
                "test_type": r["kind"],
                "test_name": r["name"],
                "severity": "ERROR",
                "status": r["status"],
                "failures": r["failures"],
                "failed_row_count": r["failures"],
                "other": json.dumps(r),
            }
            rows.append(tuple(known.get(name) for name in AUDIT.names))
        small_frame(self.spark, rows, AUDIT).write.mode("append").parquet(self.root)

    def read(self) -> DataFrame:
        if not files.exists(self.spark, self.root):
            return self.spark.createDataFrame([], AUDIT)
        return self.spark.read.schema(AUDIT).parquet(self.root)
