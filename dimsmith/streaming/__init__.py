"""Structured Streaming forms of staging loads, type 2 maintenance and weekly snapshots."""
