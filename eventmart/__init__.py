"""Event data refresh, quality gates and snapshot publication on Spark."""
