"""Lazy DataFrame-to-DataFrame operators."""

from sluice.operators.clean import clean_entity, dedupe_by_key, fill_nulls, require_key
from sluice.operators.enrich import build_master, build_profile, left_enrich, track_bridge
from sluice.operators.shape import (
    bridge,
    edges,
    explode_list,
    normalize_text,
    parse_list_column,
    project,
    unlisted_rows,
)
from sluice.operators.targets import (
    conform,
    conversion_violations,
    count_violations,
    key_violations,
    length_violations,
)

__all__ = [
    "bridge",
    "build_master",
    "build_profile",
    "clean_entity",
    "conform",
    "conversion_violations",
    "count_violations",
    "dedupe_by_key",
    "edges",
    "explode_list",
    "fill_nulls",
    "key_violations",
    "left_enrich",
    "length_violations",
    "normalize_text",
    "parse_list_column",
    "project",
    "require_key",
    "track_bridge",
    "unlisted_rows",
]
