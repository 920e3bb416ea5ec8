"""Payment-transaction ingest and analytics as Spark jobs."""
