"""Chunk references: totals, gaps, overlaps, merges and moves. References never leave their rows:
operators are hash joins or partial aggregates and collect nothing; only the search for overlaps sorts, keys alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanledger.config import OWNER_ARRAYS
from scanledger.functions import expressions as x
from scanledger.session import lookup


def reference_totals(refs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Chunks and bytes referenced."""
    return refs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("length").cast("long").alias("total_bytes")
    )


def expected_references(template: DataFrame, lengths: DataFrame, append_dim: str = "time") -> DataFrame:
    """Chunks each array along the append dimension must reference, per collection.

    ``template`` carries a ``collection`` column and ``lengths(collection, n_slots)`` gives the axis
    lengths; the axis and the owner arrays are compared by value elsewhere.
    """
    arrays = template.filter(
        (F.col("node_type") == "array")
        & F.array_contains("dims", append_dim)
        & ~F.ltrim(F.col("path"), F.lit("/")).isin(append_dim, *OWNER_ARRAYS)
    ).select("collection", F.ltrim(F.col("path"), F.lit("/")).alias("variable"), "dims", "shape", "chunk_shape")
    shape = x.resized_shape("dims", F.col("shape").cast("array<long>"), {append_dim: F.col("n_slots")}, "long")
    return arrays.join(lengths.select("collection", "n_slots"), "collection").select(
        "collection", "variable", x.expected_chunks(shape, "chunk_shape").alias("expected")
    )


def missing_references(
    refs: DataFrame, expected: DataFrame, keys: Sequence[str] = ("collection", "variable")
) -> DataFrame:
    """Arrays whose number of stored references differs from the expected number.

    ``refs`` are references, or counts of them in a column ``n_refs`` (``count_references``), which are added up.
    """
    number = F.sum("n_refs") if "n_refs" in refs.columns else F.count(F.lit(1))
    stored = refs.groupBy(*keys).agg(number.alias("actual"))
    out = expected.join(stored, list(keys), "left").withColumn(
        "actual", F.coalesce("actual", F.lit(0).cast("long"))
    )
    return out.filter(F.col("actual") != F.col("expected"))


def count_references(refs: DataFrame) -> DataFrame:
    """References of one write, counted by granule and variable: counts of several writes add up."""
    return refs.groupBy("collection", "granule_ur", "variable").agg(F.count(F.lit(1)).alias("n_refs"))


def in_chunk_order(refs: DataFrame, groups: Sequence[str]) -> DataFrame:
    """References sorted inside their partitions by group and then along the Z-order curve of (cy, cx).

    Written so, a row group holds a compact patch of chunks, and its statistics of cy and cx let readers of a window skip it.
    """
    return refs.sortWithinPartitions(*groups, x.interleaved("cy", "cx"))


def overlapping_writes(writes: DataFrame, keys: Sequence[str], writer: str) -> DataFrame:
    """Keys written by more than one writer, with the number of writers.

    Most rows are of a key of their own, so aggregating them in the tasks would hold them all and save nothing.
    Sorted by key and writer instead, which spills, each further writer is a rise, and only rises are counted.
    """
    before = F.lag(writer).over(Window.partitionBy(*keys).orderBy(writer))
    rises = writes.select(*keys, writer).withColumn("_before", before).filter(F.col(writer) > F.col("_before"))
    return rises.groupBy(*keys).agg((F.count(F.lit(1)) + 1).alias("writers"))


def merge_writes(
    writes: DataFrame, keys: Sequence[str], payload: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Union of independently written reference sets: the last writer of a key wins."""
    last = F.max_by(F.struct(*payload), F.struct(*order))
    return writes.groupBy(*keys).agg(last.alias("_p")).select(*keys, "_p.*")


def relocate_refs(refs: DataFrame, moves: DataFrame, shifts: DataFrame) -> DataFrame:
    """References under their new slots, payload untouched.

    Slots below a collection's first shift stay; later ones move by ``moves``; a later slot without
    a move is cleared (it is stale or waits for an inserted granule). Collections without a shift
    stay as they are. One row of ``moves`` per granule is small next to the references: while it fits
    a broadcast, references move without a shuffle.
    """
    to = lookup(moves.select("collection", F.col("old_slot").alias("slot"), "new_slot"))
    out = refs.join(lookup(shifts), "collection", "left").join(to, ["collection", "slot"], "left")
    stays = F.col("first_shift").isNull() | (F.col("slot") < F.col("first_shift"))
    return (
        out.withColumn("_to", F.when(stays, F.col("slot")).otherwise(F.col("new_slot")))
        .filter(F.col("_to").isNotNull())
        .withColumn("slot", F.col("_to"))
        .select(*refs.columns)
    )


def unmovable_arrays(template: DataFrame, append_dim: str = "time") -> DataFrame:
    """Arrays holding several slots per chunk: their references cannot move slot by slot."""
    at = F.array_position("dims", F.lit(append_dim)).cast("int")
    arrays = template.filter(
        (F.col("node_type") == "array")
        & (at > 0)
        & ~F.ltrim(F.col("path"), F.lit("/")).isin(append_dim, *OWNER_ARRAYS)
    ).withColumn("slots_per_chunk", F.get("chunk_shape", at - 1))
    return arrays.filter(F.col("slots_per_chunk") != 1).select("path", "slots_per_chunk")


def write_region(refs: DataFrame, new_refs: DataFrame) -> DataFrame:
    """Replace every reference of the slots ``new_refs`` covers."""
    covered = lookup(new_refs.select("collection", "slot").distinct())
    return refs.join(covered, ["collection", "slot"], "left_anti").unionByName(new_refs)


def append_slot(refs: DataFrame, lengths: DataFrame, new_refs: DataFrame) -> DataFrame:
    """Add references of one new granule per collection at the next free position."""
    placed = new_refs.join(lengths.select("collection", "n_slots"), "collection", "left").withColumn(
        "slot", F.coalesce("n_slots", F.lit(0)).cast("long")
    )
    return refs.unionByName(placed.select(*refs.columns))


def concat_time(
    granule_refs: DataFrame, slots: DataFrame, invariant: Sequence[str] = ()
) -> DataFrame:
    """Granules stacked along time: each reference takes its granule's slot.

    Variables in ``invariant`` carry no time and come from the first granule of the collection only.
    """
    placed = granule_refs.join(
        lookup(slots.select("collection", "granule_ur", "slot")), ["collection", "granule_ur"]
    )
    fixed = F.col("variable").isin(*invariant) if invariant else F.lit(False)
    return placed.filter(~fixed | (F.col("slot") == 0)).drop("granule_ur")


def storage_profile(datasets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Logical and stored bytes with their ratio, for each group and pipeline of filters.

    ``datasets(..., n_items, item_size, stored)`` has one row per dataset. With a column ``filters`` (an array in the order in which
    they are applied) a group is split by ``pipeline``, the names joined by ``+``; no filters, or null, is ``none``.
    """
    if "filters" in datasets.columns:
        names = F.array_join("filters", "+")
        datasets = datasets.withColumn("pipeline", F.when(F.length(names) > 0, names).otherwise("none"))
        by = [*by, "pipeline"]
    sums = datasets.groupBy(*by).agg(
        F.count(F.lit(1)).alias("datasets"),
        F.sum(F.col("n_items") * F.col("item_size")).cast("long").alias("logical_bytes"),
        F.sum("stored").cast("long").alias("stored_bytes"),
    )
    return sums.withColumn("ratio", x.storage_ratio("logical_bytes", "stored_bytes"))


def outside_container(refs: DataFrame, prefix: str) -> DataFrame:
    """References whose url lies outside the allowed container."""
    return refs.filter(x.outside_prefix("url", prefix))
