"""Incremental pickup of raw files as Structured Streaming jobs."""

from sluice.streaming.pickup import incremental_clean, read_pickup, run_incremental_clean

__all__ = ["incremental_clean", "read_pickup", "run_incremental_clean"]
