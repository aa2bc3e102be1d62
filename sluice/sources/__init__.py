"""Sources and sinks: raw CSV, Parquet layers, file inventory, manifest."""

from sluice.sources.csv import read_raw, write_csv
from sluice.sources.files import list_files
from sluice.sources.manifest import append_manifest, read_manifest, write_manifest_entries
from sluice.sources.parquet import read_domain, write_domain, write_facets

__all__ = ["read_raw", "write_csv", "list_files", "append_manifest", "read_manifest",
           "write_manifest_entries", "read_domain", "write_domain", "write_facets"]
