"""Daily log analytics on Spark: landing checks, log ingest, per-user daily and cumulative figures."""
