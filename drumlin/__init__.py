"""Device-telemetry analytics on Spark: load pages, stage, build marts, test, refresh."""
