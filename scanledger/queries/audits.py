"""The audit of a store, and what may be removed from it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from scanledger.operators.grid import ChunkShape
from scanledger.plans.store import expired
from scanledger.plans.verify import verify_completeness, verify_store
from scanledger.queries.axis import _MERGE_SQL, old_axis, pending_ledger
from scanledger.queries.registry import axis_slots, grid_chunks, query, table


def _grid_slots(spark, sf):
    """Vectors as slots: label = collection, one grid variable named like it."""
    vectors = table(spark, sf, "embeddings")
    url = F.concat(F.lit("s3://archive/v"), F.col("vec_id").cast("string"), F.lit(".nc"))
    return vectors.select(
        F.concat(F.lit("v"), F.col("label").cast("string")).alias("collection"), F.col("vec_id").cast("long").alias("slot"),
        (F.col("vec_id") * 3600.0).alias("time"), F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("granule_ur"),
        url.alias("granule_url"),
    )


def _audit(spark, sf, source_value, records=None):
    """Audit of every slot against sources made from the stored chunks; some source times are off."""
    slots = _grid_slots(spark, sf)
    stored = grid_chunks(spark, sf).withColumn("collection", F.col("variable"))
    off = F.when(F.col("slot") % 7 == 0, 1.0).otherwise(0.0)
    headers = slots.select(F.col("granule_url").alias("url"), (F.col("time") + off).alias("time"))
    source = stored.select(
        F.concat(F.lit("s3://archive/v"), F.col("slot").cast("string"), F.lit(".nc")).alias("url"), "variable", "cy", "cx",
        source_value.alias("values"),
    )
    variables = slots.select(
        "collection", F.col("collection").alias("variable"), F.lit(8).alias("ny"), F.lit(8).alias("nx"), F.lit(-1e30).alias("fill")
    ).distinct()
    return verify_store(slots, stored, headers, source, variables, ChunkShape(1, 8), records, samples=slots.count(), window=5)


@query(
    "verify_store",
    """SELECT 'time' AS "check", 'v' || label || '/' || vec_id AS subject, 'source time differs: s3://archive/v' || vec_id || '.nc' AS detail, 'error' AS severity
       FROM embeddings WHERE vec_id % 7 = 0
       UNION ALL
       SELECT 'values', 'v' || label || '/' || vec_id || '/v' || label, 'raw values differ', 'error' FROM embeddings WHERE vec_id % 7 <> 0""",
)
def verify_all(spark, sf):
    # every slot is sampled, so the choice of windows cannot matter: all source values are shifted
    return _audit(spark, sf, F.transform("values", lambda v: v + F.lit(1.0).cast("float")))


@query(
    "verify_clean",
    """SELECT 'time' AS "check", 'v' || label || '/' || vec_id AS subject, 'error' AS severity FROM embeddings WHERE vec_id % 7 = 0""",
)
def verify_clean(spark, sf):
    return _audit(spark, sf, F.col("values")).select("check", "subject", "severity")


@query(
    "verify_catalogue",
    """WITH v AS (SELECT vec_id, 'v' || label || '/' || vec_id AS subject FROM embeddings)
       SELECT 'catalogue' AS "check", subject, 'no granule near the slot of v' || vec_id AS detail, 'error' AS severity FROM v WHERE vec_id % 11 = 0
       UNION ALL SELECT 'url_drift', subject, 's3://archive/v' || vec_id || '.nc -> s3://archive/w' || vec_id || '.nc', 'error'
       FROM v WHERE vec_id % 11 <> 0 AND vec_id % 5 = 0
       UNION ALL SELECT 'read', subject, 'cannot read s3://archive/w' || vec_id || '.nc', 'error' FROM v WHERE vec_id % 11 <> 0 AND vec_id % 5 = 0
       UNION ALL SELECT 'time', subject, 'source time differs: s3://archive/v' || vec_id || '.nc', 'error'
       FROM v WHERE vec_id % 11 <> 0 AND vec_id % 5 <> 0 AND vec_id % 7 = 0""",
)
def verify_catalogue(spark, sf):
    # the catalogue lacks every eleventh granule and names another file for every fifth
    moved = F.regexp_replace("granule_url", "/v([0-9]+)", "/w$1")
    records = _grid_slots(spark, sf).filter("slot % 11 <> 0").select(
        "collection", F.col("time").alias("begin"), (F.col("time") + 60).alias("end"), F.col("slot").cast("long").alias("rank"),
        F.when(F.col("slot") % 5 == 0, moved).otherwise(F.col("granule_url")).alias("url"), "granule_ur",
    )
    return _audit(spark, sf, F.col("values"), records)


@query(
    "completeness_findings",
    f"""WITH {_MERGE_SQL}
        SELECT 'completeness' AS "check", collection || '/' || granule_ur AS subject, 'not in archive' AS detail, 'error' AS severity
        FROM (SELECT collection, granule_ur FROM slots EXCEPT (SELECT collection, granule_ur FROM old WHERE slot >= 10 UNION SELECT collection, granule_ur FROM pending))""",
)
def completeness_findings(spark, sf):
    listed = axis_slots(spark, sf)
    held = old_axis(spark, sf).filter("slot >= 10")
    return verify_completeness(listed, held, pending_ledger(spark, sf))


@query(
    "expired_files",
    """WITH files AS (SELECT 'x/stages/s' || o_custkey || '/slots/' || o_orderkey AS path, o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders),
            needed AS (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
       SELECT CASE WHEN o_orderstatus = 'F' THEN 'x/refs/stage=s' || o_custkey || '/' || o_orderkey ELSE path END AS path, o_orderkey AS length
       FROM files WHERE o_orderdate < TIMESTAMP '1998-01-01'
         AND NOT (o_orderstatus = 'F' AND EXISTS (SELECT 1 FROM needed WHERE c_custkey = o_custkey))""",
)
def expired_files(spark, sf):
    key, stage = F.col("o_orderkey").cast("string"), F.concat(F.lit("s"), F.col("o_custkey").cast("string"))
    path = F.when(
        F.col("o_orderstatus") == "F", F.concat(F.lit("x/refs/stage="), stage, F.lit("/"), key)
    ).otherwise(F.concat(F.lit("x/stages/"), stage, F.lit("/slots/"), key))
    files = table(spark, sf, "orders").select(
        path.alias("path"), F.col("o_orderdate").cast("timestamp").alias("modificationTime"), F.col("o_orderkey").alias("length")
    )
    needed = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("stage"), F.lit("refs").alias("kind")
    )
    return expired(files, needed, datetime(1998, 1, 1)).select("path", "length")
