"""Incremental maintenance with Structured Streaming (M*, S22)."""
