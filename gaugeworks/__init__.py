"""Telemetry analytics on PySpark: EAV history, hot projections, rollups and health queries."""
