"""Snapshot-versioned Parquet marts and the audit history."""
