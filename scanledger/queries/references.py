"""Chunk references: totals, gaps, overlaps, merges and moves."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scanledger.operators import refs as ops, slots as slot_ops
from scanledger.operators.grid import ChunkShape, touching
from scanledger.queries.axis import _MERGE_SQL, pinned_axes
from scanledger.queries.registry import REF_KEY, REFS_SQL, line_refs, query, table
from scanledger.session import ensure_checkpoint_dir

_MERGED_SQL = f"""{REFS_SQL},
merged_refs AS (
  SELECT collection, variable, slot, cy, cx, url, "offset", length, last_updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY collection, variable, slot, cy, cx
                                 ORDER BY writer DESC, last_updated_at DESC, "offset" DESC, length DESC) AS n FROM refs)
  WHERE n = 1
)"""
PAYLOAD = ["url", "offset", "length", "last_updated_at"]
WRITE_ORDER = ["writer", "last_updated_at", "offset", "length"]


def merged_refs(spark, sf):
    return ops.merge_writes(line_refs(spark, sf), REF_KEY, PAYLOAD, WRITE_ORDER)


@query(
    "reference_totals",
    f"WITH {REFS_SQL} SELECT collection, variable, count(*) AS chunks, CAST(sum(length) AS BIGINT) AS total_bytes FROM refs GROUP BY 1, 2",
)
def reference_totals(spark, sf):
    return ops.reference_totals(line_refs(spark, sf), ["collection", "variable"])


@query(
    "overlapping_writes",
    f"""WITH {REFS_SQL} SELECT collection, variable, slot, cy, cx, count(DISTINCT writer) AS writers
        FROM refs GROUP BY ALL HAVING count(DISTINCT writer) > 1""",
)
def overlapping_writes(spark, sf):
    return ops.overlapping_writes(line_refs(spark, sf), REF_KEY, "writer")


@query("merge_writes", f"WITH {_MERGED_SQL} SELECT * FROM merged_refs")
def merge_writes(spark, sf):
    return merged_refs(spark, sf)


@query(
    "missing_references",
    f"""WITH {_MERGED_SQL}
        SELECT m.collection, m.variable, s.n * 7 AS expected, count(*) AS actual
        FROM merged_refs m JOIN (SELECT collection, count(DISTINCT slot) AS n FROM refs GROUP BY 1) s USING (collection)
        GROUP BY ALL HAVING count(*) <> s.n * 7""",
)
def missing_references(spark, sf):
    lines = line_refs(spark, sf)
    # every granule is expected to carry seven chunks per variable
    template = lines.select("collection", F.concat(F.lit("/"), "variable").alias("path")).distinct().select(
        "collection", "path", F.lit("array").alias("node_type"),
        F.array(F.lit("time"), F.lit("latitude")).alias("dims"),
        F.array(F.lit(1), F.lit(7)).alias("shape"), F.array(F.lit(1), F.lit(1)).alias("chunk_shape"),
    )
    lengths = lines.groupBy("collection").agg(F.count_distinct("slot").alias("n_slots"))
    expected = ops.expected_references(template, lengths)
    return ops.missing_references(merged_refs(spark, sf), expected)


@query(
    "granule_reference_gaps",
    """SELECT o_orderkey AS slot, 4 AS expected, count(l_orderkey) AS actual
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1 HAVING count(l_orderkey) <> 4""",
)
def granule_reference_gaps(spark, sf):
    # four references per granule are expected; granules without any are found as well
    expected = table(spark, sf, "orders").select(F.col("o_orderkey").alias("slot"), F.lit(4).alias("expected"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("slot"))
    return ops.missing_references(lines, expected, ["slot"])


@query(
    "storage_profile",
    """SELECT p_type, concat_ws('+', CASE WHEN p_size % 2 = 0 THEN 'shuffle' END, CASE WHEN p_size % 3 = 0 THEN 'deflate' END,
                                CASE WHEN p_size % 6 NOT IN (0, 2, 3, 4) THEN 'none' END) AS pipeline,
              count(*) AS datasets, CAST(sum(p_size * 8) AS BIGINT) AS logical_bytes,
              CAST(sum(CASE WHEN p_brand = 'Brand#1' THEN 0 ELSE p_size END) AS BIGINT) AS stored_bytes,
              CAST(sum(p_size * 8) AS DOUBLE) / nullif(sum(CASE WHEN p_brand = 'Brand#1' THEN 0 ELSE p_size END), 0) AS ratio
       FROM part GROUP BY ALL""",
)
def storage_profile(spark, sf):
    # even sizes are shuffled, multiples of three deflated after it
    filters = F.array_compact(F.array(F.when(F.col("p_size") % 2 == 0, "shuffle"), F.when(F.col("p_size") % 3 == 0, "deflate")))
    datasets = table(spark, sf, "part").select(
        "p_type", F.col("p_size").alias("n_items"), F.lit(8).alias("item_size"),
        F.when(F.col("p_brand") == "Brand#1", 0).otherwise(F.col("p_size")).alias("stored"), filters.alias("filters"),
    )
    return ops.storage_profile(datasets, ["p_type"])


@query(
    "outside_container",
    f"""WITH {REFS_SQL} SELECT slot, cy, url FROM refs WHERE NOT starts_with(url, 's3://archive/1')""",
)
def outside_container(spark, sf):
    return ops.outside_container(line_refs(spark, sf), "s3://archive/1").select("slot", "cy", "url")


# -- moves: references of the granules on the axis, by the order that owns the slot ---------------

_AXIS_REFS_SQL = f"""{_MERGE_SQL},
axis_refs AS (
  SELECT o.collection, l_linestatus AS variable, o.slot, l_linenumber AS cy, CAST(l_suppkey AS INTEGER) AS cx, o.granule_url AS url,
         l_partkey AS "offset", CAST(l_quantity AS BIGINT) AS length, l_shipdate AS last_updated_at
  FROM lineitem JOIN old o ON o.granule_ur = 'G' || l_orderkey
)"""


def granule_lines(spark, sf):
    """lineitem as references by granule (the order that owns the slot)."""
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("G"), F.col("l_orderkey").cast("string")).alias("granule_ur"), F.col("l_linestatus").alias("variable"),
        F.col("l_linenumber").alias("cy"), F.col("l_suppkey").cast("int").alias("cx"), F.col("l_partkey").alias("offset"),
        F.col("l_quantity").cast("long").alias("length"), F.col("l_shipdate").alias("last_updated_at"),
    )


def axis_refs(spark, sf, slots):
    held = slots.select("collection", "slot", "granule_ur", F.col("granule_url").alias("url"))
    return granule_lines(spark, sf).join(held, "granule_ur").select(
        "collection", "variable", "slot", "cy", "cx", "url", "offset", "length", "last_updated_at"
    )


@query(
    "relocate_refs",
    f"""WITH {_AXIS_REFS_SQL}
        SELECT r.collection, variable, CASE WHEN r.slot < s.first_shift THEN r.slot ELSE m.new_slot END AS slot, cy, cx, url,
               "offset", length, last_updated_at
        FROM axis_refs r JOIN shifts s ON s.collection = r.collection
        LEFT JOIN moves m ON m.collection = r.collection AND m.old_slot = r.slot""",
)
def relocate_refs(spark, sf):
    old, merged = pinned_axes(spark, sf)
    shifts = slot_ops.first_shift(old, merged)
    return ops.relocate_refs(axis_refs(spark, sf, old), slot_ops.relocation_map(old, merged, shifts), shifts)


@query(
    "concat_time",
    f"""WITH {_MERGE_SQL}
        SELECT o.collection, l_linestatus AS variable, o.slot, count(*) AS chunks, CAST(sum(l_quantity) AS BIGINT) AS total_bytes
        FROM lineitem JOIN slots o ON o.granule_ur = 'G' || l_orderkey
        WHERE l_linestatus <> 'O' OR o.slot = 0 GROUP BY 1, 2, 3""",
)
def concat_time(spark, sf):
    from scanledger.queries.registry import axis_slots

    slots = axis_slots(spark, sf)
    named = granule_lines(spark, sf).join(slots.select("granule_ur", "collection"), "granule_ur")
    stacked = ops.concat_time(named, slots, invariant=["O"])
    return ops.reference_totals(stacked, ["collection", "variable", "slot"])


@query(
    "write_region",
    f"""WITH {REFS_SQL}, fresh AS (SELECT * FROM refs WHERE writer <= 3)
        SELECT collection, variable, slot, cy, url, length + 1000 AS length, writer FROM fresh
        UNION ALL
        SELECT collection, variable, slot, cy, url, length, writer FROM refs r
        WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.collection = r.collection AND f.slot = r.slot)""",
)
def write_region(spark, sf):
    refs = line_refs(spark, sf).select("collection", "variable", "slot", "cy", "url", "length", "writer")
    fresh = refs.filter(F.col("writer") <= 3).withColumn("length", F.col("length") + 1000)
    return ops.write_region(refs, fresh)


@query(
    "append_slot",
    f"""WITH {REFS_SQL}, ends AS (SELECT collection, count(DISTINCT slot) AS n FROM refs WHERE variable = 'F' GROUP BY 1)
        SELECT collection, variable, slot, cy, length FROM refs WHERE variable = 'F'
        UNION ALL
        SELECT collection, variable, coalesce(n, 0), cy, length FROM refs LEFT JOIN ends USING (collection) WHERE variable = 'O'""",
)
def append_slot(spark, sf):
    refs = line_refs(spark, sf).select("collection", "variable", "slot", "cy", "length")
    held, new = refs.filter("variable = 'F'"), refs.filter("variable = 'O'").drop("slot")
    lengths = held.groupBy("collection").agg(F.count_distinct("slot").alias("n_slots"))
    return ops.append_slot(held, lengths, new)


@query(
    "window_references",
    """SELECT l_returnflag AS collection, l_linestatus AS variable, l_orderkey AS slot, l_linenumber AS cy,
              CAST(l_suppkey % 64 AS INTEGER) AS cx, l_partkey AS "offset"
       FROM lineitem WHERE l_linenumber BETWEEN 2 AND 4 AND l_suppkey % 64 BETWEEN 10 AND 17""",
)
def window_references(spark, sf):
    # lineitem as references of a grid of 8 by 64 chunks of 10 by 5 cells, written in chunk order and read back by a window of cells
    folder = f"{ensure_checkpoint_dir(spark)}/refs-{uuid.uuid4().hex}"
    refs = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("collection"), F.col("l_linestatus").alias("variable"), F.col("l_orderkey").alias("slot"),
        F.col("l_linenumber").cast("int").alias("cy"), (F.col("l_suppkey") % 64).cast("int").alias("cx"), F.col("l_partkey").alias("offset"),
    )
    ops.in_chunk_order(refs.hint("rebalance", "collection", "variable"), ["collection", "variable"]).write.parquet(folder)
    return touching(spark.read.schema(refs.schema).parquet(folder), ChunkShape(10, 5), 25, 52, 20, 38)
