"""Registration of queries and the archive tables they derive from the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.functions import expressions as x
from scanledger.operators.slots import assign_slots

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out to all cores by their keys, where few tasks read a table of few bytes but a row takes much work."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *keys)


# -- derived archive tables; each has the same definition as SQL ----------------------------------

SECONDS_SQL = "epoch({c}) - 315964800"


def publication_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a publication log: key = publication order, date = scan, priority = collection."""
    revision = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("collection"),
        F.col("o_orderkey").alias("published"),
        F.col("o_orderdate").alias("scan"),
        revision.alias("revision"),
    )


def axis_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as an inventory: per collection and date the order with the lowest key owns the time."""
    firsts = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("collection"), x.axis_seconds("o_orderdate").alias("time")
    ).agg(F.min("o_orderkey").alias("k"))
    ur = F.concat(F.lit("G"), F.col("k").cast("string"))
    return firsts.select(
        "collection", "time", ur.alias("granule_ur"),
        F.concat(F.lit("s3://archive/"), "collection", F.lit("/"), ur, F.lit(".nc")).alias("url"),
    )


def axis_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_slots(axis_entries(spark, sf_dir)).select(
        "collection", "slot", "time", "granule_ur", F.col("url").alias("granule_url")
    )


AXIS_SQL = """
entries AS (
  SELECT collection, time, 'G' || k AS granule_ur, 's3://archive/' || collection || '/G' || k || '.nc' AS url
  FROM (SELECT o_orderpriority AS collection, epoch(o_orderdate) - 315964800 AS time, min(o_orderkey) AS k
        FROM orders GROUP BY 1, 2)
),
slots AS (
  SELECT collection, CAST(row_number() OVER (PARTITION BY collection ORDER BY time) - 1 AS BIGINT) AS slot,
         time, granule_ur, url AS granule_url FROM entries
)"""


def committed_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A committed axis out of the finished orders before 1998: one time per customer, one customer per time."""
    done = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    )
    per_customer = done.groupBy("o_orderpriority", "o_custkey").agg(F.min("o_orderdate").alias("d"))
    per_time = per_customer.groupBy("o_orderpriority", "d").agg(F.min("o_custkey").alias("c"))
    ur = F.concat(F.lit("C"), F.col("c").cast("string"))
    entries = per_time.select(
        F.col("o_orderpriority").alias("collection"), x.axis_seconds("d").alias("time"), ur.alias("granule_ur"),
        F.concat(F.lit("s3://archive/"), ur, F.lit(".nc")).alias("granule_url"),
        F.lit("first").alias("ref_stage"),
    )
    return assign_slots(entries).select("collection", "slot", "time", "granule_ur", "granule_url", "ref_stage")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order arrives in key order; cheap ones fail validation."""
    ur = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("collection"), ur.alias("granule_ur"),
        F.concat(F.lit("s3://archive/"), F.col("o_orderkey").cast("string"), F.lit("/"), ur, F.lit(".nc")).alias("url"),
        x.axis_seconds("o_orderdate").alias("time"),
        (F.col("o_totalprice") >= 5000.0).alias("valid"),
        F.col("o_orderkey").alias("delivery"),
    )


ROUTE_SQL = """
done AS (
  SELECT o_orderpriority, d, min(o_custkey) AS c
  FROM (SELECT o_orderpriority, o_custkey, min(o_orderdate) AS d FROM orders
        WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2)
  GROUP BY 1, 2
),
committed AS (
  SELECT o_orderpriority AS collection, epoch(d) - 315964800 AS time, 'C' || c AS granule_ur,
         's3://archive/C' || c || '.nc' AS granule_url,
         CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY d) - 1 AS BIGINT) AS slot
  FROM done
),
arrivals AS (
  SELECT o_orderpriority AS collection, 'C' || o_custkey AS granule_ur,
         's3://archive/' || o_orderkey || '/C' || o_custkey || '.nc' AS url,
         epoch(o_orderdate) - 315964800 AS time, o_totalprice >= 5000.0 AS valid, o_orderkey AS delivery
  FROM orders
),
ends AS (
  SELECT a.collection, max(s.time) AS axis_end
  FROM (SELECT DISTINCT collection FROM arrivals) a LEFT JOIN committed s USING (collection) GROUP BY 1
),
known AS (
  SELECT a.*, s.granule_ur AS slot_ur, o.granule_ur IS NOT NULL AS owned, e.axis_end
  FROM arrivals a
  LEFT JOIN committed s ON a.collection = s.collection AND a.time = s.time
  LEFT JOIN committed o ON a.collection = o.collection AND a.granule_ur = o.granule_ur
  JOIN ends e ON a.collection = e.collection
),
candidates AS (
  SELECT * FROM known
  WHERE valid AND slot_ur IS NULL AND NOT owned AND (axis_end IS NULL OR time > axis_end)
),
walk AS (
  SELECT collection, CAST(-1 AS BIGINT) AS pos, axis_end, CAST([] AS VARCHAR[]) AS urs, CAST(NULL AS VARCHAR) AS ur
  FROM ends
  UNION ALL
  SELECT w.collection, min(c.delivery), arg_min(c.time, c.delivery),
         list_append(any_value(w.urs), arg_min(c.granule_ur, c.delivery)), arg_min(c.granule_ur, c.delivery)
  FROM walk w JOIN candidates c
    ON c.collection = w.collection AND c.delivery > w.pos
   AND (w.axis_end IS NULL OR c.time > w.axis_end) AND NOT list_contains(w.urs, c.granule_ur)
  GROUP BY w.collection
),
added AS (SELECT collection, pos AS delivery, axis_end AS time, ur AS granule_ur FROM walk WHERE ur IS NOT NULL),
routed AS (
  SELECT k.collection, k.delivery, k.granule_ur, k.url, k.time, k.valid,
    CASE WHEN NOT k.valid THEN 'rejected'
         WHEN t.delivery = k.delivery THEN 'written'
         WHEN k.slot_ur = k.granule_ur OR (t.delivery < k.delivery AND t.granule_ur = k.granule_ur) THEN 'written'
         WHEN k.slot_ur IS NOT NULL OR t.delivery < k.delivery THEN 'rejected'
         WHEN k.owned OR u.delivery < k.delivery THEN 'rejected'
         ELSE 'deferred' END AS outcome,
    CASE WHEN NOT k.valid THEN 'validation failed'
         WHEN t.delivery = k.delivery OR k.slot_ur = k.granule_ur
              OR (t.delivery < k.delivery AND t.granule_ur = k.granule_ur) THEN NULL
         WHEN k.slot_ur IS NOT NULL OR t.delivery < k.delivery THEN 'slot belongs to another granule'
         WHEN k.owned OR u.delivery < k.delivery THEN 'granule owns another slot' END AS reason,
    t.delivery = k.delivery AS appended
  FROM known k
  LEFT JOIN added t ON k.collection = t.collection AND k.time = t.time
  LEFT JOIN added u ON k.collection = u.collection AND k.granule_ur = u.granule_ur
)"""


def line_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as chunk references: order = slot, line number = chunk row, supplier = writer."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("collection"), F.col("l_linestatus").alias("variable"),
        F.col("l_orderkey").cast("long").alias("slot"), F.col("l_linenumber").alias("cy"), F.lit(0).alias("cx"),
        F.concat(F.lit("s3://archive/"), F.col("l_orderkey").cast("string"), F.lit(".nc")).alias("url"),
        F.col("l_partkey").alias("offset"), F.col("l_quantity").cast("long").alias("length"),
        F.col("l_shipdate").alias("last_updated_at"), F.col("l_suppkey").alias("writer"),
    )


REFS_SQL = """
refs AS (
  SELECT l_returnflag AS collection, l_linestatus AS variable, CAST(l_orderkey AS BIGINT) AS slot,
         l_linenumber AS cy, 0 AS cx, 's3://archive/' || l_orderkey || '.nc' AS url, l_partkey AS "offset",
         CAST(l_quantity AS BIGINT) AS length, l_shipdate AS last_updated_at, l_suppkey AS writer
  FROM lineitem
)"""
REF_KEY = ["collection", "variable", "slot", "cy", "cx"]


def grid_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as 8x8 grids stored in chunks of one row: vector = slot, label = variable."""
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("embedding", r * 8 + 1, F.lit(8)))
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("v"), F.col("label").cast("string")).alias("variable"),
        F.col("vec_id").cast("long").alias("slot"),
        F.posexplode(rows).alias("cy", "values"),
    ).select("variable", "slot", "cy", F.lit(0).alias("cx"), "values")


CELLS_SQL = """
cells AS (
  SELECT 'v' || label AS variable, CAST(vec_id AS BIGINT) AS slot, CAST(i // 8 AS INTEGER) AS y,
         CAST(i % 8 AS INTEGER) AS x, embedding[i + 1] AS value
  FROM (SELECT *, unnest(range(64)) AS i FROM embeddings)
)"""


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as catalogue documents, nested the way a listing is."""
    name = F.concat(F.lit("E"), F.col("event_id").cast("string"))
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    at = F.col("ts").cast("timestamp")
    begin = F.date_format(at, pattern)
    length = F.round(F.col("value") * 100).cast("long") * 10_000
    end = F.date_format(F.timestamp_micros(F.unix_micros(at) + length), pattern)
    direct = F.struct(
        F.lit(x.DIRECT_ACCESS).alias("Type"), F.concat(F.lit("s3://archive/"), name, F.lit(".nc")).alias("URL")
    )
    web = F.struct(F.lit("GET DATA").alias("Type"), F.concat(F.lit("https://host/"), name, F.lit(".nc")).alias("URL"))
    links = F.when(F.col("event_type") == "error", F.array(web)).otherwise(F.array(web, direct))
    meta = F.struct(
        F.col("event_type").alias("concept-id"), F.col("user_id").cast("string").alias("revision-id"),
        begin.alias("revision-date"),
    )
    span = F.struct(begin.alias("BeginningDateTime"), end.alias("EndingDateTime"))
    umm = F.struct(
        name.alias("GranuleUR"), F.struct(span.alias("RangeDateTime")).alias("TemporalExtent"), links.alias("RelatedUrls")
    )
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("position"), meta.alias("meta"), umm.alias("umm"))
