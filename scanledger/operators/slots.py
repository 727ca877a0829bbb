"""The time axis: positions, owners, look-ups, merges and samples.

``slots`` always holds (collection, slot, time, granule_ur, granule_url); times are raw doubles and
joined as doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.operators.ordering import (
    ordered_lag,
    ordered_position,
    ordered_running_max,
    top_per_group,
)
from scanledger.session import lookup


def assign_slots(
    entries: DataFrame, target_rows: int | None = None, sized_by: DataFrame | None = None
) -> DataFrame:
    """Add ``slot``: 0-based position by time inside the collection (UR breaks ties)."""
    return ordered_position(entries, ["collection"], ["time", "granule_ur"], "slot", target_rows, sized_by)


def assign_partitions(slots: DataFrame, size: int = 500) -> DataFrame:
    return slots.withColumn("partition_id", F.floor(F.col("slot") / size))


def assign_batches(slots: DataFrame, size: int = 500, batch: int = 10) -> DataFrame:
    """Partition and batch of every slot; the position in a partition follows from the slot."""
    inside = F.col("slot") % size
    return assign_partitions(slots, size).withColumn("batch_id", F.floor(inside / batch).cast("int"))


def axis_violations(
    entries: DataFrame, position: str = "position", target_rows: int | None = None
) -> DataFrame:
    """Entries whose time does not exceed that of the entry before them, or is no number."""
    out = ordered_lag(entries, ["collection"], [position], ["time"], "_prev", target_rows)
    bad = (F.col("time") <= F.col("_prev.time")) | F.isnan("time") | F.col("time").isNull()
    return out.withColumn("prev_time", F.col("_prev.time")).drop("_prev").filter(F.coalesce(bad, F.lit(False)))


def locate_slot(arrivals: DataFrame, slots: DataFrame) -> DataFrame:
    """Add ``matches`` (slots with exactly the arrival's time) and ``slot``, set when there is one."""
    at = slots.groupBy("collection", "time").agg(
        F.count(F.lit(1)).alias("matches"), F.min("slot").alias("_slot")
    )
    out = arrivals.join(at, ["collection", "time"], "left")
    return out.withColumn("matches", F.coalesce("matches", F.lit(0).cast("long"))).withColumn(
        "slot", F.when(F.col("matches") == 1, F.col("_slot"))
    ).drop("_slot")


def slot_owner(arrivals: DataFrame, slots: DataFrame) -> DataFrame:
    """Add ``slot`` and ``owner_ur`` of the slot at the arrival's time, null where there is none."""
    owners = slots.select("collection", "time", "slot", F.col("granule_ur").alias("owner_ur"))
    return arrivals.join(owners, ["collection", "time"], "left")


def already_owned(arrivals: DataFrame, slots: DataFrame) -> DataFrame:
    """Arrivals whose UR owns some slot."""
    return arrivals.join(slots.select("collection", "granule_ur"), ["collection", "granule_ur"], "left_semi")


def running_axis_end(
    arrivals: DataFrame, slots: DataFrame, order: Sequence[str], target_rows: int | None = None
) -> DataFrame:
    """Add ``axis_end``: committed end and earlier arrivals of the batch, whichever is later."""
    ends = lookup(slots.groupBy("collection").agg(F.max("time").alias("_end")))
    out = ordered_running_max(arrivals, ["collection"], order, "time", "_running", target_rows=target_rows)
    out = out.join(ends, "collection", "left")
    return out.withColumn("axis_end", F.greatest("_running", "_end")).drop("_running", "_end")


# -- pending ledger and merge ---------------------------------------------------------------------


def earliest_pending(pending: DataFrame, max_fold: int = 500) -> DataFrame:
    """The ``max_fold`` earliest ledger entries of each collection."""
    return top_per_group(pending, ["collection"], [F.col("time"), F.col("seq")], max_fold)


def upsert_pending(pending: DataFrame, deferred: DataFrame) -> DataFrame:
    """Ledger with new deliveries: last delivery of a UR wins and keeps the UR's first position.

    ``seq`` counts deliveries and only grows from batch to batch.
    """
    known = pending.withColumn("_order", F.lit(-1).cast("long"))
    new = deferred.select("collection", "granule_ur", "url", "time", F.col("seq").cast("long").alias("seq"))
    both = known.unionByName(new.withColumn("_order", F.col("seq")))
    return (
        both.groupBy("collection", "granule_ur")
        .agg(F.max_by(F.struct("url", "time"), "_order").alias("e"), F.min("seq").alias("seq"))
        .select("collection", "granule_ur", "e.url", "e.time", "seq")
    )


def drain_pending(pending: DataFrame, folded: DataFrame) -> DataFrame:
    """Ledger without the folded URs."""
    return pending.join(folded.select("collection", "granule_ur"), ["collection", "granule_ur"], "left_anti")


def stuck_pending(pending: DataFrame, slots: DataFrame) -> DataFrame:
    """Ledger entries whose UR meanwhile owns a slot: they would abort every later re-sort."""
    return already_owned(pending, slots)


def known_urs(slots: DataFrame, pending: DataFrame) -> DataFrame:
    keys = ["collection", "granule_ur"]
    return slots.select(*keys).union(pending.select(*keys)).distinct()


def merge_pending(slots: DataFrame, folded: DataFrame, target_rows: int | None = None) -> DataFrame:
    """Sorted union of the axis and the folded entries, with new positions.

    Only collections that fold something are merged. Validate the result before writing anything:
    equal times and repeated URs are kept as they are, so that the check sees them.
    """
    entries = slots.select(
        "collection", F.col("granule_url").alias("url"), "granule_ur", "time", F.lit(False).alias("inserted")
    )
    new = folded.select("collection", "url", "granule_ur", "time", F.lit(True).alias("inserted"))
    touched = lookup(folded.select("collection").distinct())
    merged = entries.join(touched, "collection", "left_semi").unionByName(new)
    return assign_slots(merged, target_rows).withColumnRenamed("url", "granule_url")


def first_shift(slots: DataFrame, merged: DataFrame) -> DataFrame:
    """First position per collection whose entry (url, UR, time) changes, else the old length."""
    entry = ["granule_url", "granule_ur", "time"]
    new = merged.select("collection", "slot", F.struct(*entry).alias("_new"))
    old = slots.select("collection", "slot", F.struct(*entry).alias("_old"))
    pairs = old.join(new, ["collection", "slot"], "left").join(
        merged.select("collection").distinct(), "collection", "left_semi"
    )
    changed = F.when(~F.col("_old").eqNullSafe(F.col("_new")), F.col("slot"))
    out = pairs.groupBy("collection").agg(F.min(changed).alias("_first"), F.count(F.lit(1)).alias("_n"))
    return out.select("collection", F.coalesce("_first", F.col("_n")).alias("first_shift"))


def relocation_map(slots: DataFrame, merged: DataFrame, shifts: DataFrame | None = None) -> DataFrame:
    """Old to new slot, by UR, for every slot at or after the first shift."""
    shifts = first_shift(slots, merged) if shifts is None else shifts
    old = slots.select("collection", "granule_ur", F.col("slot").alias("old_slot"))
    new = merged.select("collection", "granule_ur", F.col("slot").alias("new_slot"))
    return (
        old.join(new, ["collection", "granule_ur"])
        .join(shifts, "collection")
        .filter(F.col("old_slot") >= F.col("first_shift"))
        .select("collection", "granule_ur", "old_slot", "new_slot")
    )


# -- selections -----------------------------------------------------------------------------------


def most_recent(records: DataFrame, n: int, time: str, tie: str) -> DataFrame:
    """The ``n`` latest rows, oldest first."""
    return records.orderBy(F.desc(time), F.desc(tie)).limit(n).orderBy(time, tie)


def spread_sample(
    granules: DataFrame, n: int, start: Column, end: Column, time: str, tie: Sequence[str]
) -> DataFrame:
    """First granule in each of ``n`` equal time windows of [start, end); empty windows give no row."""
    window = F.width_bucket(F.col(time), start, end, F.lit(n))
    rows = granules.withColumn("window", window.cast("int")).filter(F.col("window").between(1, n))
    first = F.min_by(F.struct("*"), F.struct(time, *tie))
    return rows.groupBy("window").agg(first.alias("_g")).select("_g.*")


def _draw(*parts: Column | str) -> Column:
    """A 60-bit number in hexadecimal."""
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15)


def sample_slots(slots: DataFrame, k: int = 8, seed: int = 0) -> DataFrame:
    """``k`` slots per collection without replacement; an MD5 of seed and slot decides, which any engine can repeat."""
    draw = _draw(F.lit(str(seed)), "collection", "slot")
    return top_per_group(slots, ["collection"], [draw, F.col("slot")], k)


def sample_windows(
    slots: DataFrame, variables: DataFrame, window: int = 5, seed: int = 0
) -> DataFrame:
    """A window corner for every sampled slot and variable.

    ``variables(collection, variable, ny, nx)`` describes the grids.
    """
    pairs = slots.select("collection", "slot").join(variables, "collection")

    def corner(axis: str, extent: str) -> Column:
        room = F.greatest(F.lit(1), F.col(extent) - window)
        drawn = F.conv(_draw(F.lit(str(seed)), F.lit(axis), "collection", "slot", "variable"), 16, 10).cast("long")
        return F.pmod(drawn, room).cast("int")

    return pairs.withColumn("y0", corner("y", "ny")).withColumn("x0", corner("x", "nx"))
