"""Reading cells. Grids are stored as decoded chunks, one array per row:
``chunks(collection, variable, slot, cy, cx, values)`` with ``values`` in row-major order. A window is
turned into chunk bounds first, so that only its chunks are read and only its cells exploded."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.functions import expressions as e
from scanledger.operators.ordering import ordered_running_sum


@dataclass(frozen=True)
class ChunkShape:
    """Cells per chunk along latitude and longitude."""

    height: int
    width: int


def cells_of(chunks: DataFrame, shape: ChunkShape, keys: Sequence[str]) -> DataFrame:
    """One row per cell: keys, y, x, value."""
    flat = chunks.select(*keys, "cy", "cx", F.posexplode("values").alias("_i", "value"))
    y = F.col("cy") * shape.height + F.floor(F.col("_i") / shape.width)
    x = F.col("cx") * shape.width + F.col("_i") % shape.width
    return flat.select(*keys, y.cast("int").alias("y"), x.cast("int").alias("x"), "value")


def touching(chunks: DataFrame, shape: ChunkShape, y0: int, x0: int, height: int, width: int) -> DataFrame:
    """The chunks, or references of chunks, that a rectangle of cells touches; a pixel is one of height and width 1."""
    return chunks.filter(
        F.col("cy").between(y0 // shape.height, (y0 + height - 1) // shape.height)
        & F.col("cx").between(x0 // shape.width, (x0 + width - 1) // shape.width)
    )


def window_slice(
    chunks: DataFrame, shape: ChunkShape, y0: int, x0: int, height: int, width: int, keys: Sequence[str]
) -> DataFrame:
    """Cells of one rectangle, for every slot and variable of ``chunks`` (filter those first)."""
    touched = touching(chunks, shape, y0, x0, height, width)
    inside = F.col("y").between(y0, y0 + height - 1) & F.col("x").between(x0, x0 + width - 1)
    return cells_of(touched, shape, keys).filter(inside)


def sampled_windows(
    chunks: DataFrame, shape: ChunkShape, windows: DataFrame, window: int, keys: Sequence[str]
) -> DataFrame:
    """Cells of many windows at once: ``windows(keys..., y0, x0)``, one per key."""
    hit = chunks.join(windows, list(keys)).filter(
        (F.col("cy") >= F.floor(F.col("y0") / shape.height))
        & (F.col("cy") <= F.floor((F.col("y0") + window - 1) / shape.height))
        & (F.col("cx") >= F.floor(F.col("x0") / shape.width))
        & (F.col("cx") <= F.floor((F.col("x0") + window - 1) / shape.width))
    )
    cells = cells_of(hit, shape, [*keys, "y0", "x0"])
    return cells.filter(
        F.col("y").between(F.col("y0"), F.col("y0") + window - 1)
        & F.col("x").between(F.col("x0"), F.col("x0") + window - 1)
    )


def point_series(chunks: DataFrame, shape: ChunkShape, y: int, x: int, keys: Sequence[str]) -> DataFrame:
    """One pixel along time: its chunk and one element of it, nothing is exploded."""
    at = (y % shape.height) * shape.width + x % shape.width
    return chunks.filter((F.col("cy") == y // shape.height) & (F.col("cx") == x // shape.width)).select(
        *keys, F.get("values", F.lit(at)).alias("value")
    )


def map_slice(chunks: DataFrame, slot: int) -> DataFrame:
    """Every chunk of one slot."""
    return chunks.filter(F.col("slot") == slot)


def robust_limits(
    cells: DataFrame,
    group: Sequence[str],
    value: str = "value",
    low: float = 0.02,
    high: float = 0.98,
    target_rows: int | None = None,
) -> DataFrame:
    """Exact percentiles of the valid cells per group, linearly interpolated between ranks.

    Ranks come from the range-split ordering, so a map of any size never sits in one task; ties are
    equal values and may take either rank.
    """
    valid = cells.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(*group, F.col(value).cast("double").alias("_v"))
    # copies of one value collapse first: a value's rank interval is all that is needed
    counted = valid.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = ordered_running_sum(counted, group, ["_v"], "_n", "_below", target_rows)
    totals = valid.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    placed = ranked.join(totals, list(group)) if group else ranked.withColumn("n", totals.scalar())

    def at_rank(q: float, up: bool) -> Column:
        rank = F.lit(q) * (F.col("n") - 1)
        rank = F.ceil(rank) if up else F.floor(rank)
        holds = (F.col("_below") <= rank) & (rank < F.col("_below") + F.col("_n"))
        return F.max(F.when(holds, F.col("_v")))

    out = placed.groupBy(*group, "n").agg(
        at_rank(low, False).alias("_l0"), at_rank(low, True).alias("_l1"),
        at_rank(high, False).alias("_h0"), at_rank(high, True).alias("_h1"),
    )

    def between(q: float, a: str, b: str) -> Column:
        rank = F.lit(q) * (F.col("n") - 1)
        return F.col(a) + (F.col(b) - F.col(a)) * (rank - F.floor(rank))

    return out.select(
        *group, F.col("n"), between(low, "_l0", "_l1").alias("vmin"), between(high, "_h0", "_h1").alias("vmax")
    )


def inside_polygon(lat: Column, lon: Column, vertices: Sequence[tuple[float, float]]) -> Column:
    """Even-odd test of a point against a polygon of (lat, lon) vertices, for points that are on no grid."""
    crossings = F.lit(0)
    for (ay, ax), (by, bx) in zip(vertices, [*vertices[1:], vertices[0]]):
        if ay == by:
            continue
        spans = (F.lit(min(ay, by)) <= lat) & (lat < F.lit(max(ay, by)))
        at = F.lit(ax) + (lat - F.lit(ay)) * F.lit((bx - ax) / (by - ay))
        crossings = crossings + F.when(spans & (lon < at), 1).otherwise(0)
    return crossings % 2 == 1


def polygon_runs(
    latitude: Sequence[tuple[int, float]], longitude: Sequence[tuple[int, float]], vertices: Sequence[tuple[float, float]]
) -> list[tuple[int, int, int]]:
    """Scan conversion: runs (y, first x, last x) of the grid points inside a polygon of (lat, lon) vertices, even-odd.

    Axes are (idx, value) pairs in any order; a point on an edge counts as inside to its right and above it.
    """
    columns = sorted(longitude)
    index, lon = np.array([i for i, _ in columns], np.int64), np.array([v for _, v in columns], np.float64)
    edges = [(a, b) for a, b in zip(vertices, [*vertices[1:], vertices[0]], strict=True) if a[0] != b[0]]
    runs = []
    for y, lat in latitude:
        crossed = np.zeros(len(lon), np.int64)
        for (ay, ax), (by, bx) in edges:
            if min(ay, by) <= lat < max(ay, by):
                crossed += lon < ax + (lat - ay) * ((bx - ax) / (by - ay))
        inside = index[crossed % 2 == 1]
        if len(inside):
            cuts = np.flatnonzero(np.diff(inside) != 1)
            starts, ends = inside[[0, *(cuts + 1)]], inside[[*cuts, len(inside) - 1]]
            runs += [(y, int(first), int(last)) for first, last in zip(starts, ends, strict=True)]
    return runs


def run_pieces(runs: Sequence[tuple[int, int, int]], shape: ChunkShape) -> list[tuple[int, int, int, int, int, int]]:
    """Runs cut at chunk borders: (cy, cx, y, x, place in the chunk's array from 1, length)."""
    pieces = []
    for y, first, last in runs:
        for cx in range(first // shape.width, last // shape.width + 1):
            x, end = max(first, cx * shape.width), min(last, (cx + 1) * shape.width - 1)
            at = (y % shape.height) * shape.width + x % shape.width + 1
            pieces.append((y // shape.height, cx, y, x, at, end - x + 1))
    return pieces


def polygon_cells(
    chunks: DataFrame, shape: ChunkShape, latitude: DataFrame, longitude: DataFrame, vertices: Sequence[tuple[float, float]],
    keys: Sequence[str],
) -> DataFrame:
    """Cells (keys, y, x, value) whose grid point lies in the polygon; axes are ``(idx, value)``.

    The parts of the axes inside the bounding box (a few thousand numbers, whatever the archive's size) become runs of cells. The
    runs' chunk bounds reach the scan, and only the runs are cut out of the chunks' arrays; no other cell is made a row.
    """
    lats, lons = [v[0] for v in vertices], [v[1] for v in vertices]

    def within(axis: DataFrame, values: Sequence[float]) -> list[tuple[int, float]]:
        rows = axis.filter(F.col("value").between(min(values), max(values))).select("idx", F.col("value").cast("double").alias("value"))
        return [(r.idx, r.value) for r in rows.collect()]

    pieces = run_pieces(polygon_runs(within(latitude, lats), within(longitude, lons), vertices), shape)
    table = chunks.sparkSession.createDataFrame(pieces, "_cy int, _cx int, y int, x int, _at int, _n int")
    rows, columns = [p[0] for p in pieces] or [-1], [p[1] for p in pieces] or [-1]
    touched = chunks.filter(F.col("cy").between(min(rows), max(rows)) & F.col("cx").between(min(columns), max(columns)))
    hit = touched.join(F.broadcast(table), (F.col("cy") == F.col("_cy")) & (F.col("cx") == F.col("_cx")))
    flat = hit.select(*keys, "y", "x", F.posexplode(F.slice("values", F.col("_at"), F.col("_n"))).alias("_i", "value"))
    return flat.select(*keys, "y", (F.col("x") + F.col("_i")).alias("x"), "value")


def zonal_statistics(
    chunks: DataFrame, shape: ChunkShape, latitude: DataFrame, longitude: DataFrame, vertices: Sequence[tuple[float, float]],
    by: Sequence[str] = ("variable", "slot"),
) -> DataFrame:
    """Count, minimum, maximum and mean of a polygon's valid cells along time."""
    inside = polygon_cells(chunks, shape, latitude, longitude, vertices, by).filter(~F.isnan("value"))
    return inside.groupBy(*by).agg(
        F.count("value").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean")
    )


def compare_windows(stored: DataFrame, source: DataFrame, keys: Sequence[str], fill: str | None = None) -> DataFrame:
    """Windows whose stored cells differ from the source: raw first, then under the fill convention.

    Both sides are cells ``(keys..., y, x, value)``; ``source`` may carry a fill value column and
    ``stored`` a ``decoded`` one. One row per differing window: (keys..., problem, n_cells).
    """
    keys = list(keys)
    extra = ["decoded"] if "decoded" in stored.columns else []
    s = stored.select(*keys, "y", "x", F.col("value").alias("_s"), F.lit(True).alias("_has_s"), *extra)
    cols = [F.col(fill).alias("_fill")] if fill else []
    o = source.select(*keys, "y", "x", F.col("value").alias("_o"), F.lit(True).alias("_has_o"), *cols)
    cells = s.join(o, [*keys, "y", "x"], "full_outer")
    raw = ~F.coalesce(F.col("_s") == F.col("_o"), F.lit(False))
    aggs = [
        F.count("_has_o").alias("_n_source"),
        F.count_if(raw).alias("_raw"),
    ]
    if fill and extra:
        aggs.append(F.count_if(~e.cells_match("decoded", e.mask_fill("_o", "_fill"))).alias("_decoded"))
    else:
        aggs.append(F.lit(0).cast("long").alias("_decoded"))
    out = cells.groupBy(*keys).agg(*aggs)
    problem = (
        F.when(F.col("_n_source") == 0, "missing from source")
        .when(F.col("_raw") > 0, "raw values differ")
        .when(F.col("_decoded") > 0, "decoded values differ")
    )
    count = F.when(F.col("_raw") > 0, F.col("_raw")).otherwise(F.col("_decoded"))
    return out.select(*keys, problem.alias("problem"), count.alias("n_cells")).filter(F.col("problem").isNotNull())
