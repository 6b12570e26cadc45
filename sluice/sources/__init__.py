"""File sources with declared schemas."""

from sluice.sources.dictionary import scan_json_dict
from sluice.sources.files import broken_lines, scan_csv, scan_json_lines, scan_parquet

__all__ = ["broken_lines", "scan_csv", "scan_json_dict", "scan_json_lines", "scan_parquet"]
