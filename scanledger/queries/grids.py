"""Reads of cells: windows, points, maps, limits and polygons over 8x8 grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanledger.operators import grid as ops
from scanledger.queries.registry import CELLS_SQL, grid_chunks, query, table

SHAPE = ops.ChunkShape(1, 8)
KEYS = ["variable", "slot"]

# a triangle on the grid's own axes: latitude 10 + 2.5 * row, longitude -100 + 5 * column
TRIANGLE = [(11.0, -99.0), (26.0, -92.0), (13.0, -66.0)]
# the same axes; rows in the middle are crossed four times
CONCAVE = [(10.5, -101.0), (28.0, -101.0), (28.0, -64.0), (10.5, -64.0), (24.0, -82.0)]


@query("window_slice", f"WITH {CELLS_SQL} SELECT * FROM cells WHERE y BETWEEN 2 AND 4 AND x BETWEEN 3 AND 6")
def window_slice(spark, sf):
    return ops.window_slice(grid_chunks(spark, sf), SHAPE, 2, 3, 3, 4, KEYS)


@query("point_series", f"WITH {CELLS_SQL} SELECT variable, slot, value FROM cells WHERE y = 5 AND x = 2")
def point_series(spark, sf):
    return ops.point_series(grid_chunks(spark, sf), SHAPE, 5, 2, KEYS)


@query("map_slice", f"WITH {CELLS_SQL} SELECT * FROM cells WHERE slot = 17")
def map_slice(spark, sf):
    return ops.cells_of(ops.map_slice(grid_chunks(spark, sf), 17), SHAPE, KEYS)


@query(
    "robust_limits",
    f"""WITH {CELLS_SQL} SELECT variable, count(*) AS n, round(quantile_cont(CAST(value AS DOUBLE), 0.02), 9) AS vmin,
               round(quantile_cont(CAST(value AS DOUBLE), 0.98), 9) AS vmax FROM cells WHERE abs(value) < 0.3 GROUP BY 1""",
)
def robust_limits(spark, sf):
    # outliers are masked the way fill values are
    cells = ops.cells_of(grid_chunks(spark, sf), SHAPE, KEYS)
    kept = F.when(F.abs("value") < F.lit(0.3).cast("float"), F.col("value")).otherwise(F.lit(float("nan")).cast("float"))
    out = ops.robust_limits(cells.withColumn("value", kept), ["variable"])
    return out.select("variable", "n", F.round("vmin", 9).alias("vmin"), F.round("vmax", 9).alias("vmax"))


def _zone_sql(vertices) -> str:
    edges = ", ".join(
        f"{{'ay': {ay}::DOUBLE, 'ax': {ax}::DOUBLE, 'by': {by}::DOUBLE, 'bx': {bx}::DOUBLE}}"
        for (ay, ax), (by, bx) in zip(vertices, [*vertices[1:], vertices[0]], strict=True)
    )
    return f"""{CELLS_SQL},
placed AS (SELECT *, 10 + 2.5::DOUBLE * y AS lat, -100 + 5::DOUBLE * x AS lon FROM cells),
edges AS (SELECT unnest([{edges}]) AS e),
inside AS (
  SELECT y, x FROM (SELECT DISTINCT y, x, lat, lon FROM placed) p, edges
  WHERE lat >= least(e.ay, e.by) AND lat < greatest(e.ay, e.by)
    AND lon < e.ax + (lat - e.ay) * ((e.bx - e.ax) / (e.by - e.ay))
  GROUP BY y, x HAVING count(*) % 2 = 1
)"""


_ZONE_SQL = _zone_sql(TRIANGLE)


def _axes(spark, sf):
    # row and column numbers as axes; the grid is eight cells wide
    index = table(spark, sf, "embeddings").select(F.explode(F.sequence(F.lit(0), F.lit(7))).alias("idx")).distinct()
    return (
        index.select("idx", (F.lit(10.0) + F.col("idx") * 2.5).cast("float").alias("value")),
        index.select("idx", (F.lit(-100.0) + F.col("idx") * 5.0).cast("float").alias("value")),
    )


@query(
    "zonal_statistics",
    f"""WITH {_ZONE_SQL} SELECT variable, slot, count(value) AS n, min(value) AS min, max(value) AS max,
               round(avg(CAST(value AS DOUBLE)), 9) AS mean FROM placed JOIN inside USING (y, x) GROUP BY 1, 2""",
)
def zonal_statistics(spark, sf):
    return ops.zonal_statistics(grid_chunks(spark, sf), SHAPE, *_axes(spark, sf), TRIANGLE, KEYS).withColumn("mean", F.round("mean", 9))


@query(
    "zonal_concave",
    f"""WITH {_zone_sql(CONCAVE)} SELECT variable, slot, count(value) AS n, min(value) AS min, max(value) AS max,
               round(avg(CAST(value AS DOUBLE)), 9) AS mean FROM placed JOIN inside USING (y, x) GROUP BY 1, 2""",
)
def zonal_concave(spark, sf):
    return ops.zonal_statistics(grid_chunks(spark, sf), SHAPE, *_axes(spark, sf), CONCAVE, KEYS).withColumn("mean", F.round("mean", 9))


@query("polygon_mask", f"WITH {_ZONE_SQL} SELECT y, x, count(*) AS n FROM cells JOIN inside USING (y, x) GROUP BY 1, 2")
def polygon_mask(spark, sf):
    return ops.polygon_cells(grid_chunks(spark, sf), SHAPE, *_axes(spark, sf), TRIANGLE, KEYS).groupBy("y", "x").agg(F.count(F.lit(1)).alias("n"))


@query(
    "compare_windows",
    f"""WITH {CELLS_SQL}, seen AS (SELECT variable, slot, count(*) FILTER (value > 0.2) AS n FROM cells
          WHERE y BETWEEN 1 AND 5 AND x BETWEEN 2 AND 6 GROUP BY 1, 2)
        SELECT variable, slot, CASE WHEN variable = 'v3' THEN 'missing from source' ELSE 'raw values differ' END AS problem,
               CASE WHEN variable = 'v3' THEN 25 ELSE n END AS n_cells FROM seen WHERE n > 0 OR variable = 'v3'""",
)
def compare_windows(spark, sf):
    # in the source, one variable is missing and large values are halved
    stored = ops.window_slice(grid_chunks(spark, sf), SHAPE, 1, 2, 5, 5, KEYS)
    halved = F.when(F.col("value") > F.lit(0.2).cast("float"), F.col("value") / 2).otherwise(F.col("value"))
    source = stored.filter("variable <> 'v3'").withColumn("value", halved)
    return ops.compare_windows(stored, source, KEYS)


@query(
    "decoded_windows",
    f"""WITH {CELLS_SQL} SELECT variable, slot, 'decoded values differ' AS problem, count(*) AS n_cells FROM cells
        WHERE value < -0.25::FLOAT GROUP BY 1, 2""",
)
def decoded_windows(spark, sf):
    # the reader masks what lies below a limit, the source's fill value masks nothing: those cells differ
    cells = ops.cells_of(grid_chunks(spark, sf), SHAPE, KEYS)
    masked = F.when(F.col("value") < F.lit(-0.25).cast("float"), F.lit(float("nan"))).otherwise(F.col("value").cast("double"))
    return ops.compare_windows(cells.withColumn("decoded", masked), cells.withColumn("fill", F.lit(-1e30)), KEYS, "fill")
