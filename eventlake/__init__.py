"""Commerce event analytics on Spark: ingest, live metrics, daily reports, checks."""
