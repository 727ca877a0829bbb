"""Forward processing: a stream of queue messages into the archive, one micro-batch per version.

Late granules are deferred, never dropped, so there is no event-time watermark. A micro-batch that is
repeated after a failure is recognised by collection, stream and id, which the version marker records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.config import CollectionConfig
from scanledger.functions import expressions as x
from scanledger.operators.findings import require_valid
from scanledger.operators.ordering import ordered_position
from scanledger.operators.routing import (
    WRITTEN,
    axis_changes,
    last_written,
    ledger_after,
    retries_after,
    route_arrivals,
)
from scanledger.operators.validate import validate_inventory
from scanledger.plans.backfill import _of, header_findings
from scanledger.plans.store import Store, Version, VersionMoved
from scanledger.session import lookup, pin
from scanledger.sources.messages import read_messages

# url order within a batch; id and body only make it total
ORDER = ["sort_url", "message_id", "body"]


def parse_batch(messages: DataFrame, headers: dict[str, DataFrame], template: DataFrame, coordinates: DataFrame, config: CollectionConfig) -> DataFrame:
    """Messages with a url as arrivals, with the granule's time and whether it passed validation."""
    read = read_messages(messages).filter(F.col("state") != "skipped")
    urls = read.select("url").distinct()
    touched = {name: df.join(urls, "url", "left_semi") for name, df in headers.items()}
    bad = (
        header_findings(touched, template, coordinates, config)
        .filter(F.col("severity") == "error")
        .select(F.col("subject").alias("url"))
        .distinct()
        .withColumn("_bad", F.lit(True))
    )
    times = touched["times"].select("url", F.get("times", F.lit(0)).alias("time"))
    return (
        read.join(times, "url", "left")
        .join(bad, "url", "left")
        .select(
            F.lit(config.collection).alias("collection"),
            x.granule_ur("url").alias("granule_ur"),
            "url",
            "time",
            (F.col("url").isNotNull() & F.col("time").isNotNull() & F.col("_bad").isNull()).alias("valid"),
            "sort_url",
            "message_id",
            "body",
            "attempts",
        )
    )


def changed_tail(slots: DataFrame, changes: DataFrame) -> DataFrame:
    """What a batch can have spoiled: changed rows, the last committed one, and committed ones that name an appended granule."""
    ends = slots.groupBy("collection").agg(F.max("slot").alias("_end"))
    appended = changes.join(ends, "collection", "left").filter(F.col("_end").isNull() | (F.col("slot") > F.col("_end"))).drop("_end")
    again = slots.join(lookup(appended.select("collection", "granule_ur")), ["collection", "granule_ur"], "left_semi")
    last = slots.join(lookup(ends), "collection").filter(F.col("slot") == F.col("_end")).drop("_end")
    beside = again.unionByName(last).distinct().join(lookup(changes.select("collection", "slot")), ["collection", "slot"], "left_anti")
    return beside.unionByName(changes)


def process_batch(
    store: Store,
    messages: DataFrame,
    headers: dict[str, DataFrame],
    config: CollectionConfig,
    batch_id: int,
    max_attempts: int = 20,
    target_rows: int | None = None,
    stream: str = "",
) -> Version:
    """Route one batch of ``messages(message_id, body)`` and publish the result.

    Messages of the collection that were rejected before are tried again with the batch; after
    ``max_attempts`` deliveries they go to the dead letters. ``batch_id`` counts within ``stream``.
    """
    pinned = store.require_initialized()
    if batch_id <= pinned.last_batch(config.collection, stream):
        return pinned
    template, coordinates = store.require_collection(config.collection)
    rejected = store.retries(pinned)
    again = _of(rejected, config.collection).select("message_id", "body", (F.col("attempts") + 1).alias("attempts"))
    delivered = messages.select("message_id", "body", F.lit(1).alias("attempts")).unionByName(again)
    # a message delivered twice within one batch counts once
    incoming = delivered.groupBy("message_id", "body").agg(F.max("attempts").alias("attempts"))
    arrivals = pin(parse_batch(incoming, headers, template, coordinates, config))
    slots, pending = _of(store.slots(pinned), config.collection), store.pending(pinned)
    routed = route_arrivals(arrivals, slots, ORDER, target_rows)
    routed = pin(ordered_position(routed, ["collection"], ORDER, "delivery", target_rows))

    stage = store.new_stage()
    changes = axis_changes(slots, routed, ORDER, stage, target_rows)
    # deliveries of a batch come after those of earlier ones
    numbered = routed.withColumn("seq", F.lit(batch_id).cast("long") * (1 << 32) + F.col("delivery"))
    ledger = ledger_after(pending, numbered, "seq")
    written = last_written(routed, ORDER)
    refs = headers["refs"].drop("granule_ur", "collection").join(
        written.select("url", "collection", "granule_ur"), "url"
    )
    retry, dead = retries_after(routed, max_attempts)
    store.write_refs(stage, refs)
    others = rejected.filter(F.col("collection") != config.collection)
    waiting = others.unionByName(retry.select("collection", "message_id", "body", "attempts"))
    store.write_changes(stage, changes, pinned)
    store.write_state(stage, None, ledger, store.meta(pinned), waiting)
    dead.select("collection", "message_id", "body", "attempts", "reason").write.mode("errorifexists").parquet(
        f"{store.base}/dead/stage={stage}"
    )
    tail = changed_tail(slots, store.changes(stage)).withColumnRenamed("granule_url", "url")
    require_valid(validate_inventory(tail, position="slot", target_rows=target_rows), "axis after the batch")
    return store.publish(stage, pinned, "forward", (config.collection, stream, batch_id))


def read_message_stream(spark: SparkSession, path: str, files_per_batch: int = 10) -> DataFrame:
    """Landed message files (JSON lines with message_id and body) as a stream."""
    return (
        spark.readStream.schema("message_id string, body string")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def run_forward(
    store: Store,
    stream: DataFrame,
    headers: Callable[[], dict[str, DataFrame]],
    config: CollectionConfig,
    checkpoint: str,
    available_now: bool = True,
    max_attempts: int = 20,
    max_races: int = 5,
):
    """Start the consumer. A batch that loses the race to publish is processed again on the newer version."""

    def stream_id() -> str:
        # the checkpoint's own id: a new checkpoint counts its batches from 0 again
        return store.spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0].strip()

    def consume(batch: DataFrame, batch_id: int) -> None:
        for race in range(max_races):
            try:
                process_batch(store, batch, headers(), config, batch_id, max_attempts, stream=stream_id())
                return
            except VersionMoved:
                if race + 1 == max_races:
                    raise

    writer = stream.writeStream.foreachBatch(consume).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def outcome_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("collection", "outcome").agg(F.count(F.lit(1)).alias("n"))


__all__ = ["WRITTEN", "outcome_counts", "parse_batch", "process_batch", "read_message_stream", "run_forward"]
