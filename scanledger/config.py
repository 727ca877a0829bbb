"""What one collection looks like to the jobs."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path

# Attribute names that vary from granule to granule and carry no shared structure.
VOLATILE_ATTRIBUTES = frozenset({
    "history",
    "scan_num",
    "time_coverage_start",
    "time_coverage_end",
    "time_coverage_start_since_epoch",
    "time_coverage_end_since_epoch",
    "production_date_time",
    "begin_date",
    "begin_time",
    "end_date",
    "end_time",
    "local_granule_id",
    "input_files",
    "geospatial_bounds",
    "day_of_year",
    "coremetadata",
    "REFERENCE_LIST",
    "DIMENSION_LIST",
})

# Attribute names a write path may add on its own.
WRITE_ARTIFACTS = frozenset({"coordinates", "_FillValue"})

# The root attribute that repeats the granule's own time, and the columns that own a slot.
EPOCH_ATTRIBUTE = "time_coverage_start_since_epoch"
OWNER_ARRAYS = ("granule_ur", "granule_url")

DEFAULT_SCHEMA_ID = "scan-inventory/1"


@dataclass(frozen=True)
class CollectionConfig:
    """Names and lists that steer parsing and validation of one collection."""

    name: str
    collection: str
    concept_id: str = ""
    append_dim: str = "time"
    time_units: str = "seconds since 1980-01-06T00:00:00Z"
    flatten_groups: tuple[str, ...] = ()
    promote_to_time: tuple[str, ...] = ()
    drop_variables: tuple[str, ...] = ()
    volatile_attributes: frozenset[str] = field(default=VOLATILE_ATTRIBUTES)
    time_chunk_size: int = 16384
    schema_id: str = DEFAULT_SCHEMA_ID


def load_collection(path: str | Path, schema_id: str = DEFAULT_SCHEMA_ID) -> CollectionConfig:
    """Read a collection's TOML description; its extra volatile names join the base list."""
    raw = tomllib.loads(Path(path).read_text())
    return CollectionConfig(
        name=raw["name"],
        collection=raw["collection_shortname"],
        concept_id=raw["concept_id"],
        append_dim=raw["append_dim"],
        time_units=raw["time_units"],
        flatten_groups=tuple(raw["flatten_groups"]),
        promote_to_time=tuple(raw["promote_to_time"]),
        drop_variables=tuple(raw["drop_variables"]),
        volatile_attributes=VOLATILE_ATTRIBUTES | set(raw.get("extra_volatile_attributes", ())),
        time_chunk_size=raw["time_chunk_size"],
        schema_id=schema_id,
    )
