"""sluice: land, clean and reshape folders of headered CSV files as Spark jobs.

Every operator is a plain DataFrame transformation (no Python UDFs): keys,
maps, keyword lists and schemas are arguments, so the same code runs on any
table, in batch or inside a Structured Streaming query.
"""

from sluice.session import build_session, scratch_path, work_dir

__all__ = ["build_session", "scratch_path", "work_dir"]
