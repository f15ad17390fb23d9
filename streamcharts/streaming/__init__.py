"""Structured Streaming jobs: rollups, intake, watermark variant, read views."""
