"""Audit of a published axis: sampled values against the sources, and completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from scanledger.operators.compare import completeness_diff, nearest_granule, url_drift
from scanledger.operators.findings import all_findings, as_findings
from scanledger.operators.grid import ChunkShape, compare_windows, sampled_windows
from scanledger.operators.slots import sample_slots, sample_windows
from scanledger.session import lookup, pin


# Drawn windows up to this many become literals of the scans; the joins decide in any case.
MAX_LITERALS = 2_000


def _restricted(chunks: DataFrame, drawn: Sequence[Row], names: dict[str, str], shape: ChunkShape, window: int) -> DataFrame:
    """Chunks that a drawn window may need, by literals; ``names`` maps columns of ``chunks`` to those of the windows."""
    if not drawn:
        return chunks.limit(0)
    for column, name in names.items():
        chunks = chunks.filter(F.col(column).isin(sorted({r[name] for r in drawn})))
    for column, corner, cells in (("cy", "y0", shape.height), ("cx", "x0", shape.width)):
        corners = [r[corner] for r in drawn]
        chunks = chunks.filter(F.col(column).between(min(corners) // cells, (max(corners) + window - 1) // cells))
    return chunks


def verify_store(
    slots: DataFrame,
    stored: DataFrame,
    source_headers: DataFrame,
    source: DataFrame,
    variables: DataFrame,
    shape: ChunkShape,
    records: DataFrame | None = None,
    samples: int = 8,
    window: int = 5,
    seed: int = 0,
    target_rows: int | None = None,
) -> DataFrame:
    """Findings for sampled slots and one sampled window per variable.

    ``stored(collection, variable, slot, cy, cx, values)`` are the archive's chunks and
    ``source(url, variable, cy, cx, values)`` the source files'; ``source_headers(url, time)`` lists
    the readable files with their in-file time; ``variables(collection, variable, ny, nx, fill)``
    the grids. With catalogue ``records`` the source url comes from the catalogue, else from the slot.
    """
    label = F.concat_ws("/", "collection", F.col("slot").cast("string"))
    # the sample is small and steers every read below: drawn once, then looked up
    picked = pin(sample_slots(slots, samples, seed))
    parts = []
    if records is not None:
        found = nearest_granule(picked, records, target_rows=target_rows)
        parts.append(
            as_findings(found.filter(F.col("found_url").isNull()), "catalogue", label, F.concat(F.lit("no granule near the slot of "), F.col("granule_ur")))
        )
        parts.append(
            as_findings(url_drift(found), "url_drift", label, F.concat_ws(" -> ", "granule_url", "found_url"))
        )
        picked = found.filter(F.col("found_url").isNotNull()).withColumn("granule_url", F.col("found_url"))
    heads = picked.join(
        source_headers.select(F.col("url").alias("granule_url"), F.col("time").alias("_t")), "granule_url", "left"
    )
    parts.append(
        as_findings(heads.filter(F.col("_t").isNull()), "read", label, F.concat(F.lit("cannot read "), F.col("granule_url")))
    )
    parts.append(
        as_findings(
            heads.filter(F.col("_t").isNotNull() & ~F.col("_t").eqNullSafe(F.col("time"))),
            "time",
            label,
            F.concat(F.lit("source time differs: "), F.col("granule_url")),
        )
    )
    good = heads.filter(F.col("_t").eqNullSafe(F.col("time")))
    corners = sample_windows(good, variables.drop("fill"), window, seed).select("collection", "slot", "variable", "y0", "x0")
    windows = pin(corners.join(good.select("collection", "slot", "granule_url"), ["collection", "slot"]))
    keys = ["collection", "slot", "variable"]
    # read in two phases: what was drawn is known now, so partitions, row groups and chunks outside it are not touched
    drawn = windows.limit(MAX_LITERALS + 1).collect()
    if len(drawn) <= MAX_LITERALS:
        stored = _restricted(stored, drawn, {"collection": "collection", "slot": "slot", "variable": "variable"}, shape, window)
        source = _restricted(source, drawn, {"url": "granule_url", "variable": "variable"}, shape, window)
    held = sampled_windows(stored, shape, lookup(windows.drop("granule_url"), pinned=False), window, keys)
    urls = windows.select("collection", "slot", F.col("granule_url").alias("url")).distinct()
    named = source.join(lookup(urls), "url")
    windows = lookup(windows.drop("granule_url"), pinned=False)
    fills = variables.select("collection", "variable", F.col("fill").cast("double").alias("fill"))
    read = sampled_windows(named, shape, windows, window, keys).join(fills, ["collection", "variable"])
    masked = held.join(fills, ["collection", "variable"]).withColumn(
        "decoded", F.when(F.col("value") == F.col("fill"), F.lit(float("nan"))).otherwise(F.col("value").cast("double"))
    )
    differing = compare_windows(masked.drop("fill"), read, keys, "fill")
    parts.append(
        as_findings(differing, "values", F.concat_ws("/", label, "variable"), F.col("problem"))
    )
    return all_findings(*parts)


def verify_completeness(listed: DataFrame, slots: DataFrame, pending: DataFrame) -> DataFrame:
    """Catalogue against axis and ledger, as findings."""
    diff = completeness_diff(listed, slots, pending)
    return as_findings(diff, "completeness", F.concat_ws("/", "collection", "granule_ur"), F.col("problem"))
