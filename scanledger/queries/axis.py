"""Publication order, inventories, positions on the axis, samples and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanledger.functions import expressions as x
from scanledger.operators import catalogue, slots as ops, validate
from scanledger.queries.registry import (
    AXIS_SQL,
    arrivals,
    axis_entries,
    axis_slots,
    committed_slots,
    publication_log,
    query,
    table,
)
from scanledger.session import pin

_LOG_SQL = """
log AS (
  SELECT o_orderpriority AS collection, o_orderkey AS published, o_orderdate AS scan,
         CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS revision FROM orders
),
lagged AS (
  SELECT *, lag(scan) OVER (PARTITION BY collection ORDER BY published) AS prev_scan FROM log
)"""


@query(
    "publish_order_report",
    f"""WITH {_LOG_SQL}, base AS (SELECT collection, min(revision) AS low FROM log GROUP BY 1)
        SELECT collection, count(*) AS total, greatest(count(*) - 1, 0) AS pairs,
               count(*) FILTER (scan < prev_scan) AS inversions,
               count(*) FILTER (scan < prev_scan AND prev_scan - scan <= INTERVAL 240 DAY) AS adjacent_swaps,
               count(*) FILTER (scan < prev_scan AND prev_scan - scan > INTERVAL 240 DAY) AS historical_arrivals,
               count(*) FILTER (revision > low) AS republished,
               100.0::DOUBLE * count(*) FILTER (scan < prev_scan) / greatest(count(*) - 1, 1) AS inversion_pct,
               100.0::DOUBLE * count(*) FILTER (revision > low) / count(*) AS republished_pct
        FROM lagged JOIN base USING (collection) GROUP BY 1""",
)
def publish_order_report(spark, sf):
    return catalogue.publish_order_report(
        publication_log(spark, sf), ["collection"], ["published"], "scan", "revision", 240 * 86400
    )


@query(
    "publish_order_control",
    """WITH lagged AS (SELECT event_type AS collection, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY event_id) AS p,
                              user_id FROM events),
            base AS (SELECT collection, min(user_id) AS low FROM lagged GROUP BY 1)
       SELECT collection, count(*) AS total, count(*) - 1 AS pairs, count(*) FILTER (ts < p) AS inversions,
              count(*) FILTER (user_id > low) AS republished
       FROM lagged JOIN base USING (collection) GROUP BY 1""",
)
def publish_order_control(spark, sf):
    # event times rise with the event id: no inversion may be found
    log = table(spark, sf, "events").select(
        F.col("event_type").alias("collection"), "event_id", "ts", "user_id"
    )
    out = catalogue.publish_order_report(log, ["collection"], ["event_id"], "ts", "user_id", 86400)
    return out.select("collection", "total", "pairs", "inversions", "republished")


@query(
    "publication_lag",
    f"WITH {_LOG_SQL} SELECT collection, published, scan, prev_scan FROM lagged",
)
def publication_lag(spark, sf):
    out = catalogue.publication_lag(publication_log(spark, sf), ["collection"], ["published"], "scan")
    return out.select("collection", "published", "scan", "prev_scan")


@query(
    "axis_violations",
    """SELECT collection, "position", time, prev_time FROM (
         SELECT o_orderpriority AS collection, o_orderkey AS "position", epoch(o_orderdate) - 315964800 AS time,
                lag(epoch(o_orderdate) - 315964800) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS prev_time
         FROM orders) WHERE time <= prev_time""",
)
def axis_violations(spark, sf):
    log = publication_log(spark, sf).select(
        "collection", F.col("published").alias("position"), x.axis_seconds("scan").alias("time")
    )
    return ops.axis_violations(log).select("collection", "position", "time", "prev_time")


@query(
    "latest_revision",
    """SELECT l_orderkey, l_linenumber AS revision, l_partkey, l_suppkey FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                      ORDER BY l_linenumber DESC, l_shipdate, l_partkey, l_suppkey, l_quantity) AS n
         FROM lineitem) WHERE n = 1""",
)
def latest_revision(spark, sf):
    # lineitem as revisions: order = granule, line number = revision, the rest the listing position
    records = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("revision"), "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
    )
    out = catalogue.latest_revision(
        records, ["l_orderkey"], "revision", ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    )
    return out.select("l_orderkey", "revision", "l_partkey", "l_suppkey")


@query(
    "duplicate_urs",
    """SELECT o_orderpriority AS collection, 'C' || o_custkey AS granule_ur, count(*) AS n
       FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_urs(spark, sf):
    return catalogue.duplicate_urs(arrivals(spark, sf))


@query(
    "inventory_findings",
    """WITH log AS (
         SELECT o_orderpriority AS collection, 'C' || o_custkey AS ur, epoch(o_orderdate) - 315964800 AS time,
                lag(epoch(o_orderdate) - 315964800) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS prev_time,
                o_orderstatus FROM orders)
       SELECT "check", subject, count(*) AS findings FROM (
         SELECT 'axis_order' AS "check", collection || '/' || ur AS subject FROM log WHERE time <= prev_time
         UNION ALL
         SELECT 'granule_url', collection || '/' || ur FROM log WHERE o_orderstatus = 'P'
         UNION ALL
         SELECT 'duplicate_ur', collection || '/' || ur FROM log GROUP BY collection, ur HAVING count(*) > 1)
       GROUP BY 1, 2""",
)
def inventory_findings(spark, sf):
    url = F.concat(F.lit("s3://archive/"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderstatus") == "P", ".xml").otherwise(".nc"))
    entries = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("collection"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("granule_ur"),
        url.alias("url"), x.axis_seconds("o_orderdate").alias("time"), F.col("o_orderkey").alias("position"),
    )
    found = validate.validate_inventory(entries)
    return found.groupBy("check", "subject").agg(F.count(F.lit(1)).alias("findings"))


@query(
    "build_inventory",
    """WITH newest AS (
         SELECT l_orderkey, l_shipdate, l_partkey FROM (
           SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate, l_partkey, l_suppkey, l_quantity) AS n
           FROM lineitem) WHERE n = 1)
       SELECT 'LINES' AS collection, 's3://archive/' || n.l_orderkey || '.nc' AS url, CAST(n.l_orderkey AS VARCHAR) AS granule_ur,
              epoch(o_orderdate) - 315964800 AS time
       FROM newest n JOIN orders ON o_orderkey = n.l_orderkey""",
)
def build_inventory(spark, sf):
    name = F.col("l_orderkey").cast("string")
    direct = F.concat(F.lit("s3://archive/"), name, F.lit(".nc"))
    records = table(spark, sf, "lineitem").select(
        name.alias("concept_id"), name.alias("granule_ur"), F.col("l_linenumber").alias("revision_id"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity").alias("position"),
        F.array(F.concat(F.lit("https://host/"), name, F.lit(".nc")), direct).alias("links"),
    )
    times = table(spark, sf, "orders").select(
        F.concat(F.lit("s3://archive/"), F.col("o_orderkey").cast("string"), F.lit(".nc")).alias("url"),
        x.axis_seconds("o_orderdate").alias("time"),
    )
    return catalogue.build_inventory(records, times, "LINES")[0]


@query(
    "assign_slots", f"WITH {AXIS_SQL} SELECT * FROM slots",
)
def assign_slots(spark, sf):
    return axis_slots(spark, sf)


@query(
    "assign_partitions",
    f"""WITH {AXIS_SQL} SELECT collection, CAST(slot // 500 AS BIGINT) AS partition_id, count(*) AS granules, min(time) AS first_time
        FROM slots GROUP BY 1, 2""",
)
def assign_partitions(spark, sf):
    out = ops.assign_partitions(axis_slots(spark, sf))
    return out.groupBy("collection", "partition_id").agg(F.count(F.lit(1)).alias("granules"), F.min("time").alias("first_time"))


@query(
    "assign_batches",
    f"""WITH {AXIS_SQL} SELECT collection, slot, CAST(slot // 500 AS BIGINT) AS partition_id,
               CAST((slot % 500) // 10 AS INTEGER) AS batch_id FROM slots""",
)
def assign_batches(spark, sf):
    return ops.assign_batches(axis_slots(spark, sf)).select("collection", "slot", "partition_id", "batch_id")


@query(
    "running_axis_end",
    f"""WITH {AXIS_SQL}, ends AS (SELECT collection, max(time) AS e FROM slots WHERE time < 500000000 GROUP BY 1)
        SELECT o_orderpriority AS collection, o_orderkey AS delivery,
               greatest(max(epoch(o_orderdate) - 315964800) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), e) AS axis_end
        FROM orders LEFT JOIN ends ON collection = o_orderpriority""",
)
def running_axis_end(spark, sf):
    early = axis_slots(spark, sf).filter(F.col("time") < 500000000.0)
    out = ops.running_axis_end(arrivals(spark, sf), early, ["delivery"])
    return out.select("collection", "delivery", "axis_end")


@query(
    "locate_slot",
    f"""WITH {AXIS_SQL}, dup AS (
          SELECT o_orderpriority AS collection, epoch(o_orderdate) - 315964800 AS time, count(*) AS matches, min(o_orderkey) AS slot
          FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
        SELECT o_orderkey AS delivery, coalesce(matches, 0) AS matches, CASE WHEN matches = 1 THEN d.slot END AS slot
        FROM orders LEFT JOIN dup d ON d.collection = o_orderpriority AND d.time = epoch(o_orderdate) - 315964800""",
)
def locate_slot(spark, sf):
    # an axis with repeated times, so that all three cases occur: none, one and several matches
    axis = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderpriority").alias("collection"), x.axis_seconds("o_orderdate").alias("time"), F.col("o_orderkey").alias("slot")
    )
    return ops.locate_slot(arrivals(spark, sf), axis).select("delivery", "matches", "slot")


@query(
    "slot_owner",
    f"""WITH {AXIS_SQL} SELECT o_orderkey AS delivery, slot, granule_ur AS owner_ur FROM orders
        LEFT JOIN slots ON collection = o_orderpriority AND time = epoch(o_orderdate) - 315964800""",
)
def slot_owner(spark, sf):
    return ops.slot_owner(arrivals(spark, sf), axis_slots(spark, sf)).select("delivery", "slot", "owner_ur")


# -- merge and re-sort: urgent orders' early half is the axis, the rest waits ---------------------
# The axis holds the granules up to 1999, the ledger every later one and those of 1996.

_MERGE_SQL = f"""{AXIS_SQL},
old AS (
  SELECT collection, CAST(row_number() OVER (PARTITION BY collection ORDER BY time) - 1 AS BIGINT) AS slot, time, granule_ur, granule_url
  FROM slots WHERE year(to_timestamp(time + 315964800)::TIMESTAMP) NOT IN (1996, 2000, 2001)
),
pending AS (
  SELECT collection, granule_ur, granule_url AS url, time, CAST(substr(granule_ur, 2) AS BIGINT) AS seq
  FROM slots WHERE year(to_timestamp(time + 315964800)::TIMESTAMP) IN (1996, 2000, 2001)
),
fold AS (
  SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY time, seq) AS n FROM pending) WHERE n <= 500
),
merged AS (
  SELECT collection, CAST(row_number() OVER (PARTITION BY collection ORDER BY time, granule_ur) - 1 AS BIGINT) AS slot,
         time, granule_ur, granule_url, inserted
  FROM (SELECT collection, time, granule_ur, granule_url, false AS inserted FROM old
        UNION ALL SELECT collection, time, granule_ur, url, true FROM fold)
),
shifts AS (
  SELECT o.collection, coalesce(min(o.slot) FILTER (o.granule_ur <> m.granule_ur OR o.time <> m.time), count(*)) AS first_shift
  FROM old o JOIN merged m ON o.collection = m.collection AND o.slot = m.slot GROUP BY 1
),
moves AS (
  SELECT o.collection, o.granule_ur, o.slot AS old_slot, m.slot AS new_slot
  FROM old o JOIN merged m ON o.collection = m.collection AND o.granule_ur = m.granule_ur
  JOIN shifts s ON s.collection = o.collection WHERE o.slot >= s.first_shift
)"""


def _waits(df):
    return df.withColumn("_waits", F.year(x.axis_timestamp("time")).isin(1996, 2000, 2001))


def old_axis(spark, sf):
    kept = _waits(axis_entries(spark, sf)).filter(~F.col("_waits")).drop("_waits")
    return ops.assign_slots(kept).withColumnRenamed("url", "granule_url")


def pending_ledger(spark, sf):
    waiting = _waits(axis_entries(spark, sf)).filter("_waits")
    return waiting.select("collection", "granule_ur", "url", "time", F.expr("substring(granule_ur, 2)").cast("long").alias("seq"))


def merged_axis(spark, sf):
    return ops.merge_pending(old_axis(spark, sf), ops.earliest_pending(pending_ledger(spark, sf)))


def pinned_axes(spark, sf):
    """The axis and its merge, written once for queries that read them several times."""
    old = pin(old_axis(spark, sf))
    return old, pin(ops.merge_pending(old, ops.earliest_pending(pending_ledger(spark, sf))))


@query("earliest_pending", f"WITH {_MERGE_SQL} SELECT * FROM fold")
def earliest_pending(spark, sf):
    return ops.earliest_pending(pending_ledger(spark, sf))


@query("merge_pending", f"WITH {_MERGE_SQL} SELECT * FROM merged")
def merge_pending(spark, sf):
    return merged_axis(spark, sf).select("collection", "slot", "time", "granule_ur", "granule_url", "inserted")


@query("first_shift", f"WITH {_MERGE_SQL} SELECT * FROM shifts")
def first_shift(spark, sf):
    return ops.first_shift(*pinned_axes(spark, sf))


@query("relocation_map", f"WITH {_MERGE_SQL} SELECT * FROM moves")
def relocation_map(spark, sf):
    return ops.relocation_map(*pinned_axes(spark, sf))


@query(
    "drain_pending",
    f"WITH {_MERGE_SQL} SELECT p.* FROM pending p WHERE NOT EXISTS (SELECT 1 FROM fold f WHERE f.collection = p.collection AND f.granule_ur = p.granule_ur)",
)
def drain_pending(spark, sf):
    pending = pending_ledger(spark, sf)
    return ops.drain_pending(pending, ops.earliest_pending(pending))


@query(
    "known_urs",
    f"WITH {_MERGE_SQL} SELECT collection, granule_ur FROM old UNION SELECT collection, granule_ur FROM pending",
)
def known_urs(spark, sf):
    return ops.known_urs(old_axis(spark, sf), pending_ledger(spark, sf))


@query(
    "resort_report",
    f"""WITH {_MERGE_SQL}
        SELECT s.collection, s.first_shift, (SELECT count(*) FROM fold f WHERE f.collection = s.collection) AS inserted,
               (SELECT count(*) FROM pending p WHERE p.collection = s.collection)
                 - (SELECT count(*) FROM fold f WHERE f.collection = s.collection) AS remaining,
               (SELECT count(*) FROM moves m WHERE m.collection = s.collection) AS moved,
               (SELECT max(m.time) FROM merged m WHERE m.collection = s.collection) AS axis_end
        FROM shifts s""",
)
def resort_report(spark, sf):
    old, pending = pin(old_axis(spark, sf)), pin(pending_ledger(spark, sf))
    fold = ops.earliest_pending(pending)
    merged = pin(ops.merge_pending(old, fold))
    shifts = ops.first_shift(old, merged)
    moved = ops.relocation_map(old, merged, shifts).groupBy("collection").agg(F.count(F.lit(1)).alias("moved"))
    inserted = merged.groupBy("collection").agg(F.count_if("inserted").alias("inserted"), F.max("time").alias("axis_end"))
    left = ops.drain_pending(pending, fold).groupBy("collection").agg(F.count(F.lit(1)).alias("remaining"))
    zero = F.lit(0).cast("long")
    return (
        shifts.join(inserted, "collection").join(left, "collection", "left").join(moved, "collection", "left")
        .select("collection", "first_shift", "inserted", F.coalesce("remaining", zero).alias("remaining"),
                F.coalesce("moved", zero).alias("moved"), "axis_end")
    )


# -- selections -----------------------------------------------------------------------------------


@query(
    "most_recent",
    "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 25",
)
def most_recent(spark, sf):
    return ops.most_recent(table(spark, sf, "events").select("event_id", "ts"), 25, "ts", "event_id")


@query(
    "spread_sample",
    """SELECT w AS "window", arg_min(event_id, ts) AS event_id, min(ts) AS ts FROM (
         SELECT event_id, ts, CAST(floor((epoch_us(ts) / 1e6 - 1704067200.0) / 518400.0 * 20) + 1 AS INTEGER) AS w FROM events)
       WHERE w BETWEEN 1 AND 20 GROUP BY 1""",
)
def spread_sample(spark, sf):
    # twenty windows over January and February 2024 in part: a third of them lies past the last event
    events = table(spark, sf, "events").select(
        "event_id", "ts", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("seconds")
    )
    out = ops.spread_sample(events, 20, F.lit(1704067200.0), F.lit(1704067200.0 + 518400.0), "seconds", ["event_id"])
    return out.select("window", "event_id", "ts")


SAMPLE_SQL = f"""{AXIS_SQL},
sampled AS (
  SELECT collection, slot, time, granule_ur, granule_url FROM (
    SELECT *, row_number() OVER (
      PARTITION BY collection ORDER BY substr(md5('0|' || collection || '|' || slot), 1, 15), slot) AS place FROM slots)
  WHERE place <= 8
)"""


@query("sample_slots", f"WITH {SAMPLE_SQL} SELECT * FROM sampled")
def sample_slots(spark, sf):
    return ops.sample_slots(axis_slots(spark, sf), 8, 0)


@query(
    "sample_windows",
    f"""WITH {SAMPLE_SQL},
        pairs AS (SELECT s.collection, slot, variable, 2950 AS ny, 7750 AS nx FROM sampled s JOIN (
          SELECT DISTINCT o_orderpriority AS collection, o_orderstatus AS variable FROM orders) v ON s.collection = v.collection)
        SELECT *, CAST(('0x' || substr(md5('0|y|' || collection || '|' || slot || '|' || variable), 1, 15))::BIGINT % 2945 AS INTEGER) AS y0,
               CAST(('0x' || substr(md5('0|x|' || collection || '|' || slot || '|' || variable), 1, 15))::BIGINT % 7745 AS INTEGER) AS x0
        FROM pairs""",
)
def sample_windows(spark, sf):
    sampled = ops.sample_slots(axis_slots(spark, sf), 8, 0)
    grids = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("collection"), F.col("o_orderstatus").alias("variable"), F.lit(2950).alias("ny"), F.lit(7750).alias("nx")
    ).distinct()
    return ops.sample_windows(sampled, grids, 5, 0)


@query(
    "collection_report",
    """SELECT event_type AS concept_id, count(*) AS granule_count, min(ts) AS first_begin, max(ts) AS last_begin,
              'E' || arg_max(event_id, ts) AS most_recent, upper(event_type) || ' V04' AS title,
              'Present' AS extent_end FROM events GROUP BY 1""",
)
def collection_report(spark, sf):
    from scanledger import schema
    from scanledger.queries.registry import event_records
    from scanledger.sources.catalogue import flatten_records

    records = flatten_records(event_records(spark, sf))
    kinds = table(spark, sf, "events").select("event_type").distinct()
    doc = F.to_json(
        F.struct(
            F.struct(F.col("event_type").alias("concept-id")).alias("meta"),
            F.struct(
                F.upper("event_type").alias("ShortName"), F.lit("V04").alias("Version"),
                F.array(F.struct(
                    F.array(F.struct(F.lit("2024-01-01").alias("BeginningDateTime"))).alias("RangeDateTimes"), F.lit(True).alias("EndsAtPresentFlag")
                )).alias("TemporalExtents"),
            ).alias("umm"),
        )
    )
    # one document per collection, parsed once
    docs = pin(kinds.select(F.from_json(doc, schema.COLLECTION_RECORD).alias("r")).select("r.*"))
    report = catalogue.collection_report(docs, records)
    extents = catalogue.temporal_extent(docs).select("concept_id", F.col("end").alias("extent_end"))
    return report.join(extents, "concept_id").select(
        "concept_id", "granule_count", F.col("first_begin").cast("timestamp_ntz").alias("first_begin"),
        F.col("last_begin").cast("timestamp_ntz").alias("last_begin"), "most_recent", "title", "extent_end",
    )


@query(
    "sequence_gaps",
    """SELECT conv_id, role, turn, prev_turn FROM (
         SELECT conv_id, role, turn, lag(turn) OVER (PARTITION BY conv_id, role ORDER BY turn) AS prev_turn FROM conversations)
       WHERE turn <> coalesce(prev_turn, -1) + 1""",
)
def sequence_gaps(spark, sf):
    # a role's turns as positions of an axis: anything but the successor of its turn before is a gap
    from scanledger.operators.ordering import ordered_lag

    out = ordered_lag(
        table(spark, sf, "conversations").select("conv_id", "role", "turn"), ["conv_id", "role"], ["turn"], ["turn"], "p"
    )
    gap = F.col("turn") != F.coalesce("p.turn", F.lit(-1)) + 1
    return out.filter(gap).select("conv_id", "role", "turn", F.col("p.turn").alias("prev_turn"))


@query(
    "already_owned",
    """WITH done AS (
         SELECT o_orderpriority AS p, min(o_custkey) AS c FROM (
           SELECT o_orderpriority, o_custkey, min(o_orderdate) AS d FROM orders
           WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2) GROUP BY o_orderpriority, d)
       SELECT o_orderkey AS delivery FROM orders WHERE EXISTS (SELECT 1 FROM done WHERE p = o_orderpriority AND c = o_custkey)""",
)
def already_owned(spark, sf):
    return ops.already_owned(arrivals(spark, sf), committed_slots(spark, sf)).select("delivery")
