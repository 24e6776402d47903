"""Operators Spark has no single call for: deduplication, quality checks,
quarantine, exact medians, history merges, upserts and lineage walks."""
