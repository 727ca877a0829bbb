"""Routing of arrivals, ledger, dead letters and the incremental poll."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from scanledger import schema
from scanledger.operators import routing as ops
from scanledger.operators.slots import stuck_pending, upsert_pending
from scanledger.plans.poll import initial_watermark, poll_increment, poll_landed
from scanledger.queries.registry import (
    ROUTE_SQL,
    arrivals,
    committed_slots,
    event_records,
    query,
    table,
)
from scanledger.queries.scalars import _MESSAGES_SQL, messages
from scanledger.sources.catalogue import flatten_records
from scanledger.session import ensure_checkpoint_dir, pin
from scanledger.sources.messages import read_messages


def routed(spark, sf):
    return ops.route_arrivals(arrivals(spark, sf), committed_slots(spark, sf), ["delivery"])


def pinned_route(spark, sf):
    """The routed arrivals for queries that read them more than once."""
    return pin(routed(spark, sf))


@query("route_arrivals", f"WITH RECURSIVE {ROUTE_SQL} SELECT collection, delivery, granule_ur, outcome, reason FROM routed")
def route_arrivals(spark, sf):
    return routed(spark, sf).select("collection", "delivery", "granule_ur", "outcome", "reason")


@query(
    "sync_slots",
    f"""WITH RECURSIVE {ROUTE_SQL},
        writes AS (SELECT collection, granule_ur, arg_max(url, delivery) AS url FROM routed WHERE outcome = 'written' GROUP BY 1, 2),
        axis AS (SELECT collection, time, granule_ur, granule_url FROM committed
                 UNION ALL SELECT collection, time, granule_ur, url FROM routed WHERE appended)
        SELECT a.collection, CAST(row_number() OVER (PARTITION BY a.collection ORDER BY a.time) - 1 AS BIGINT) AS slot,
               a.time, a.granule_ur, coalesce(w.url, a.granule_url) AS granule_url,
               CASE WHEN w.url IS NOT NULL THEN 'second' ELSE 'first' END AS ref_stage
        FROM axis a LEFT JOIN writes w ON a.collection = w.collection AND a.granule_ur = w.granule_ur""",
)
def sync_slots(spark, sf):
    return ops.sync_slots(committed_slots(spark, sf), pinned_route(spark, sf), ["delivery"], "second")


@query(
    "upsert_pending",
    """WITH known AS (SELECT l_returnflag AS collection, l_partkey, min(l_orderkey) AS seq, arg_min(l_extendedprice, struct_pack(a := l_orderkey, b := l_suppkey, c := l_linenumber, d := l_extendedprice)) AS time
                      FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
            news AS (SELECT l_returnflag AS collection, l_partkey, 1000000000000 + l_orderkey * 100000 + l_linenumber * 10000 + l_suppkey AS seq, l_extendedprice AS time
                     FROM lineitem WHERE l_linestatus = 'O')
       SELECT collection, 'P' || l_partkey AS granule_ur,
              coalesce(n.time, k.time) AS time, coalesce(k.seq, n.first_seq) AS seq
       FROM known k FULL JOIN (SELECT collection, l_partkey, min(seq) AS first_seq, arg_max(time, struct_pack(s := seq, t := time)) AS time
                               FROM news GROUP BY 1, 2) n USING (collection, l_partkey)""",
)
def upsert_ledger(spark, sf):
    # finished lines are the ledger, open ones new deliveries: part = UR, price = time
    lines = table(spark, sf, "lineitem")
    ur = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    first = F.min_by("l_extendedprice", F.struct("l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice"))
    pending = lines.filter("l_linestatus = 'F'").groupBy(F.col("l_returnflag").alias("collection"), ur.alias("granule_ur")).agg(
        first.alias("time"), F.min("l_orderkey").alias("seq")
    ).select("collection", "granule_ur", F.lit("old").alias("url"), "time", "seq")
    seq = F.lit(1_000_000_000_000) + F.col("l_orderkey") * 100_000 + F.col("l_linenumber") * 10_000 + F.col("l_suppkey")
    # two lines may share a delivery number; the dearer one stands for it
    news = lines.filter("l_linestatus = 'O'").groupBy(F.col("l_returnflag").alias("collection"), ur.alias("granule_ur"), seq.alias("seq")).agg(
        F.max("l_extendedprice").alias("time")
    ).select("collection", "granule_ur", F.lit("new").alias("url"), "time", "seq")
    return upsert_pending(pending, news).drop("url")


@query(
    "ledger_after",
    f"""WITH RECURSIVE {ROUTE_SQL}
        SELECT collection, granule_ur, arg_max(url, delivery) AS url, arg_max(time, delivery) AS time, min(delivery) AS seq
        FROM routed WHERE outcome = 'deferred' GROUP BY 1, 2""",
)
def ledger_after(spark, sf):
    return ops.ledger_after(spark.createDataFrame([], schema.PENDING), routed(spark, sf), "delivery")


@query(
    "stuck_pending",
    f"""WITH RECURSIVE {ROUTE_SQL}
        SELECT DISTINCT collection, granule_ur FROM routed r WHERE outcome = 'deferred'
          AND EXISTS (SELECT 1 FROM routed a WHERE a.appended AND a.collection = r.collection AND a.granule_ur = r.granule_ur)""",
)
def stuck_ledger(spark, sf):
    all_routed = pinned_route(spark, sf)
    ledger = ops.ledger_after(spark.createDataFrame([], schema.PENDING), all_routed, "delivery")
    axis = ops.sync_slots(committed_slots(spark, sf), all_routed, ["delivery"])
    return stuck_pending(ledger, axis).select("collection", "granule_ur")


@query(
    "outcome_counts",
    f"WITH RECURSIVE {ROUTE_SQL} SELECT collection, outcome, count(*) AS n FROM routed GROUP BY 1, 2",
)
def outcome_counts(spark, sf):
    from scanledger.streaming.forward import outcome_counts as counts

    return counts(routed(spark, sf))


def _dead(spark, sf):
    # the customer's number stands for the deliveries a message has had: 1 to 25
    with_attempts = arrivals(spark, sf).withColumn(
        "attempts", (F.expr("substring(granule_ur, 2)").cast("long") % 25 + 1).cast("int")
    )
    out = ops.route_arrivals(with_attempts, committed_slots(spark, sf), ["delivery"])
    return ops.retries_after(out, 20)


@query(
    "dead_letter",
    f"""WITH RECURSIVE {ROUTE_SQL} SELECT delivery, CAST(CAST(substr(granule_ur, 2) AS BIGINT) % 25 + 1 AS INTEGER) AS attempts, reason
        FROM routed WHERE outcome = 'rejected' AND CAST(substr(granule_ur, 2) AS BIGINT) % 25 + 1 >= 20""",
)
def dead_letter(spark, sf):
    return _dead(spark, sf)[1].select("delivery", "attempts", "reason")


@query(
    "retries",
    f"""WITH RECURSIVE {ROUTE_SQL} SELECT delivery, reason
        FROM routed WHERE outcome = 'rejected' AND CAST(substr(granule_ur, 2) AS BIGINT) % 25 + 1 < 20""",
)
def retries(spark, sf):
    return _dead(spark, sf)[0].select("delivery", "reason")


@query(
    "batch_result",
    f"WITH RECURSIVE {ROUTE_SQL} SELECT 'm' || delivery AS message_id FROM routed WHERE outcome = 'rejected'",
)
def batch_result(spark, sf):
    named = routed(spark, sf).withColumn("message_id", F.concat(F.lit("m"), F.col("delivery").cast("string")))
    return ops.batch_result(named)


@query(
    "redelivery",
    f"""WITH RECURSIVE {ROUTE_SQL} SELECT count(*) AS granules, CAST(0 AS BIGINT) AS appended_again FROM (
          SELECT collection, granule_ur FROM committed UNION SELECT collection, granule_ur FROM routed WHERE appended)""",
)
def redelivery(spark, sf):
    # what was written is delivered once more: slots are rewritten, none is added
    first = pinned_route(spark, sf)
    axis = pin(ops.sync_slots(committed_slots(spark, sf), first, ["delivery"]))
    again = axis.select("collection", "granule_ur", F.col("granule_url").alias("url"), "time", F.lit(True).alias("valid"), F.col("slot").alias("delivery"))
    second = ops.route_arrivals(again, axis, ["delivery"])
    return second.agg(
        F.count_if((F.col("outcome") == "written") & (F.col("action") == "overwrite")).alias("granules"),
        F.count_if(F.col("action") == "append").alias("appended_again"),
    )


@query(
    "message_order",
    f"""WITH {_MESSAGES_SQL}
        SELECT page_id, row_number() OVER (ORDER BY coalesce(url, ''), page_id) - 1 AS "position" FROM messages WHERE state <> 'skipped'""",
)
def message_order(spark, sf):
    from scanledger.operators.ordering import ordered_position

    read = read_messages(messages(spark, sf)).filter("state <> 'skipped'")
    return ordered_position(read, [], ["sort_url", "message_id"], "position").select("page_id", "position")


@query(
    "poll_increment",
    """SELECT event_id AS position, 's3://archive/E' || event_id || '.nc' AS url FROM events
       WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND event_type <> 'error'""",
)
def poll(spark, sf):
    since = initial_watermark(datetime(2024, 1, 22, 12, tzinfo=timezone.utc))
    return poll_increment(flatten_records(event_records(spark, sf)), F.lit(since))[0].select("position", "url")


@query(
    "poll_unlinked",
    """SELECT event_id AS position, event_type AS concept_id FROM events
       WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND event_type = 'error'""",
)
def poll_unlinked(spark, sf):
    since = initial_watermark(datetime(2024, 1, 30, tzinfo=timezone.utc), "2024-01-20T00:00:00")
    return poll_increment(flatten_records(event_records(spark, sf)), F.lit(since))[1].select("position", "concept_id")


@query(
    "poll_landed",
    """SELECT 's3://archive/E' || event_id || '.nc' AS url, event_type AS concept_id, 'E' || event_id AS granule_ur FROM events
       WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND event_type <> 'error'""",
)
def poll_landed_pages(spark, sf):
    # events as pages of up to 500 records, landed on the day they are from; the poll starts in the middle of a day
    base = f"{ensure_checkpoint_dir(spark)}/poll-{uuid.uuid4().hex}"
    records = event_records(spark, sf).withColumn("day", F.to_date(F.col("meta.`revision-date`").substr(1, 10)))
    pages = records.groupBy("day", F.floor(F.col("position") / 500).alias("page")).agg(
        F.collect_list(F.struct("meta", "umm")).alias("items")
    )
    pages.select("day", "items").write.option("maxRecordsPerFile", 1).partitionBy("day").json(f"{base}/pages")

    def send(urls, batch_id):
        urls.select("url", "concept_id", "granule_ur").write.mode("overwrite").parquet(f"{base}/sent/batch={batch_id}")

    now = datetime(2024, 1, 22, 12, tzinfo=timezone.utc)
    poll_landed(spark, f"{base}/pages", f"{base}/progress", f"{base}/mark", send, now, "2024-01-15T12:00:00")
    return spark.read.schema("url string, concept_id string, granule_ur string").parquet(f"{base}/sent/batch=*")
