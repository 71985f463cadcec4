"""Structured Streaming jobs (T1-T8): sources, jobs and idempotent sinks."""
