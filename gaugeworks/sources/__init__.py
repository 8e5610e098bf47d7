"""Readers: history scans, ingest files, change feeds and the driver tables as a telemetry model."""
