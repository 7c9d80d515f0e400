"""Relational operators (joins, aggregations, ordered series, upserts, quality)."""
