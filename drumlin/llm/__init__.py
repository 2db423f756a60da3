"""Operators for building training data: independent of the telemetry jobs."""
