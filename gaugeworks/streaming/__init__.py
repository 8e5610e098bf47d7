"""Structured Streaming jobs: enrichment, deduplication, loading, rollups, state from changes."""
