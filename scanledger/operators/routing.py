"""Routing of arriving granules: append, overwrite, defer or reject.

Arrivals are taken one after the other (in ``order``), each seeing what the ones before it did. The
rules, first match wins:

1. not valid: rejected;
2. its time is that of a slot: written over it if the same UR owns the slot, else rejected;
3. its UR owns another slot: rejected;
4. the axis is empty, or the time lies past its end: appended;
5. else deferred to the pending ledger.

Only appends change what later arrivals see, so the state machine reduces to finding the appended
rows; joins give every other outcome. A row can be appended only past the committed end and past
every earlier *first* arrival of some UR (nothing can block those); those rows contend.

The contenders are cut where nothing can cross: before a row whose time exceeds all earlier ones, if
no UR has rows on both sides. Such a row is appended whatever happened before, so the pieces settle
independently. A short piece is folded in its own row. A long one settles in rounds, all long ones
at once: a row that is not its UR's first is taken as blocked if that first contends, rows that
exceed the running maximum of the unblocked ones are appended, and who is blocked is looked up again.
Up to the first row for which that differs everything is final; only what lies behind it, less the
rows of URs that are placed and those not past the end, goes into another round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.operators.ordering import ordered_position, ordered_running_max, ordered_running_sum
from scanledger.operators.slots import upsert_pending
from scanledger.session import lookup, pin

WRITTEN, DEFERRED, REJECTED = "written", "deferred", "rejected"

# Rows of a piece of the arrival order that are gone through in one array.
FOLD_ROWS = 1_000


_PLACED = ["collection", "granule_ur", "time", "_ord"]


def _contenders(rows: DataFrame, group: Sequence[str], order: Sequence[str], target_rows: int | None) -> DataFrame:
    """Rows past ``_floor`` and past every earlier first arrival of a UR, with ``_first``: whether they are one."""
    firsts = rows.groupBy(*group, "granule_ur").agg(F.min("_ord").alias("_head"))
    marked = rows.join(firsts, [*group, "granule_ur"]).withColumn("_first", F.col("_ord") == F.col("_head")).drop("_head")
    low = ordered_running_max(marked, group, order, F.when(F.col("_first"), F.col("time")), "_low", target_rows=target_rows, sized_by=rows)
    past = [F.col(c).isNull() | (F.col("time") > F.col(c)) for c in ("_low", "_floor")]
    return low.filter(past[0] & past[1]).drop("_low")


def _pieces(contenders: DataFrame, order: Sequence[str], target_rows: int | None) -> DataFrame:
    """Contenders with the number of their piece and its size."""
    lasts = contenders.groupBy("collection", "granule_ur").agg(F.max("_ord").alias("_last"))
    spans = contenders.join(lasts, ["collection", "granule_ur"])
    for value, name in (("time", "_top"), ("_last", "_open")):
        spans = ordered_running_max(spans, ["collection"], order, value, name, target_rows=target_rows, sized_by=contenders)
    # nobody before it is as late, and no name of those before it comes again
    cut = F.coalesce((F.col("time") > F.col("_top")) & (F.col("_open") < F.col("_ord")), F.lit(False))
    counted = ordered_running_sum(spans.withColumn("_cut", cut.cast("long")), ["collection"], order, "_cut", "_before", target_rows)
    numbered = pin(
        counted.withColumn("_piece", (F.col("_before") + F.col("_cut")).cast("long")).select(*contenders.columns, "_piece")
    )
    sizes = numbered.groupBy("collection", "_piece").agg(F.count(F.lit(1)).alias("_size"))
    return numbered.join(sizes, ["collection", "_piece"])


def _folded(short: DataFrame) -> DataFrame:
    """The appended rows of pieces of at most ``FOLD_ROWS`` rows: one array each, gone through in order."""
    entry = F.struct("_ord", "granule_ur", "time")
    held = short.groupBy("collection", "_piece").agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
    kind = held.schema["_rows"].dataType.simpleString()
    start = F.struct(F.lit(None).cast("double").alias("end"), F.array().cast("array<string>").alias("names"), F.array().cast(kind).alias("placed"))

    def step(state: Column, row: Column) -> Column:
        free = (state["end"].isNull() | (row["time"] > state["end"])) & ~F.array_contains(state["names"], row["granule_ur"])
        return F.when(
            free,
            F.struct(
                row["time"].alias("end"), F.array_append(state["names"], row["granule_ur"]).alias("names"),
                F.array_append(state["placed"], row).alias("placed"),
            ),
        ).otherwise(state)

    placed = F.aggregate("_rows", start, step)["placed"]
    return held.select("collection", F.explode(placed).alias("_p")).select("collection", "_p.granule_ur", "_p.time", "_p._ord")


def _settled(long: DataFrame, order: Sequence[str], target_rows: int | None) -> DataFrame | None:
    """The appended rows of long pieces, None if there are none; each round is written once and looks at what is still open only."""
    group, found = ["collection", "_piece"], None
    names = [*group, "granule_ur"]
    tail = pin(long)
    while not tail.isEmpty():
        rows = _contenders(tail, group, order, target_rows)
        heads = rows.filter("_first").select(*names, F.lit(True).alias("_headed"))
        guess = rows.join(heads, names, "left").withColumn("_blocked", ~F.col("_first") & F.coalesce("_headed", F.lit(False))).drop("_headed")
        free = F.when(~F.col("_blocked"), F.col("time"))
        top = ordered_running_max(guess, group, order, free, "_top", target_rows=target_rows, sized_by=tail)
        past = F.col("_top").isNull() | (F.col("time") > F.col("_top"))
        tried = pin(top.withColumn("_placed", ~F.col("_blocked") & past).drop("_top"))
        owners = tried.filter("_placed").groupBy(*names).agg(F.min("_ord").alias("_owner"))
        met = tried.join(owners, names, "left")
        wrong = F.coalesce(F.col("_owner") < F.col("_ord"), F.lit(False)) != F.col("_blocked")
        ends = met.groupBy(*group).agg(F.min(F.when(wrong, F.col("_ord"))).alias("_until"))
        judged = pin(met.join(ends, group))
        final = F.col("_until").isNull() | (F.col("_ord") < F.col("_until"))
        placed = judged.filter(F.col("_placed") & final)
        found = placed.select(*_PLACED) if found is None else found.unionByName(placed.select(*_PLACED))
        floors = placed.groupBy(*group).agg(F.max("time").alias("_end"))
        open_rows = judged.filter(~final & ~F.coalesce(F.col("_owner") < F.col("_until"), F.lit(False)))
        tail = pin(
            open_rows.join(floors, group, "left").withColumn("_floor", F.greatest("_floor", "_end"))
            .filter(F.col("_floor").isNull() | (F.col("time") > F.col("_floor"))).select(*long.columns)
        )
    return found


def _appended(candidates: DataFrame, order: Sequence[str], target_rows: int | None, fold_rows: int) -> DataFrame:
    """The candidates that are appended, as (collection, granule_ur, time, _ord)."""
    rows = candidates.select("collection", "granule_ur", "time", *order, F.lit(None).cast("double").alias("_floor"))
    # read several times below, and the outcome of joins with the axis: written once
    rows = pin(rows.withColumn("_ord", F.struct(*order)))
    contenders = pin(_contenders(rows, ["collection"], order, target_rows))
    repeated = contenders.groupBy("collection", "granule_ur").count().filter("count > 1")
    if repeated.isEmpty():
        top = ordered_running_max(contenders, ["collection"], order, "time", "_top", target_rows=target_rows)
        return top.filter(F.col("_top").isNull() | (F.col("time") > F.col("_top"))).select(*_PLACED)
    pieces = pin(_pieces(contenders.drop("_first"), order, target_rows))
    short = _folded(pieces.filter(F.col("_size") <= fold_rows))
    settled = _settled(pieces.filter(F.col("_size") > fold_rows).drop("_size"), order, target_rows)
    return short if settled is None else short.unionByName(settled)


def route_arrivals(
    arrivals: DataFrame, slots: DataFrame, order: Sequence[str], target_rows: int | None = None, fold_rows: int = FOLD_ROWS
) -> DataFrame:
    """Add ``outcome``, ``action`` and ``reason`` to every arrival.

    ``arrivals(collection, granule_ur, url, time, valid, ...)`` with ``order`` columns that are
    unique inside a collection; ``slots`` is the committed axis.
    """
    order = list(order)
    ur, at = ["collection", "granule_ur"], ["collection", "time"]
    usable = F.coalesce("valid", F.lit(False)) & F.col("time").isNotNull() & ~F.isnan("time")
    ends = lookup(slots.groupBy("collection").agg(F.max("time").alias("_end")))
    # past the committed end no committed slot can match, so only the UR has to be looked up
    past_end = F.col("_end").isNull() | (F.col("time") > F.col("_end"))
    candidates = (
        arrivals.filter(usable)
        .join(ends, "collection", "left")
        .filter(past_end)
        .join(slots.select(*ur), ur, "left_anti")
    )
    appended = pin(_appended(candidates, order, target_rows, fold_rows))
    since = appended.schema["_ord"].dataType
    committed = slots.select(*ur, "time", F.lit(None).cast(since).alias("_ord"))
    axis = committed.unionByName(appended)
    by_time = axis.select(*at, F.col("granule_ur").alias("_slot_ur"), F.col("_ord").alias("_slot_ord"))
    by_ur = axis.groupBy(*ur).agg(
        F.bool_or(F.col("_ord").isNull()).alias("_owned"), F.min("_ord").alias("_ur_ord")
    )
    seen = (
        arrivals.withColumn("_ok", usable)
        .join(by_time, at, "left")
        .join(by_ur, ur, "left")
        .withColumn("_ord", F.struct(*order))
    )

    is_append = F.coalesce(
        (F.col("_slot_ord") == F.col("_ord")) & (F.col("_slot_ur") == F.col("granule_ur")), F.lit(False)
    )
    holds = F.col("_slot_ord").isNull() | (F.col("_slot_ord") < F.col("_ord"))
    slot_ur = F.when(holds, F.col("_slot_ur"))
    ur_taken = F.coalesce("_owned", F.lit(False)) | F.coalesce(F.col("_ur_ord") < F.col("_ord"), F.lit(False))

    def verdict(outcome: str, action: str, reason: str | None) -> Column:
        return F.struct(
            F.lit(outcome).alias("outcome"), F.lit(action).alias("action"), F.lit(reason).cast("string").alias("reason")
        )

    decision = (
        F.when(~F.col("_ok"), verdict(REJECTED, "none", "validation failed"))
        .when(is_append, verdict(WRITTEN, "append", None))
        .when(slot_ur == F.col("granule_ur"), verdict(WRITTEN, "overwrite", None))
        .when(slot_ur.isNotNull(), verdict(REJECTED, "none", "slot belongs to another granule"))
        .when(ur_taken, verdict(REJECTED, "none", "granule owns another slot"))
        .otherwise(verdict(DEFERRED, "defer", None))
    )
    return seen.withColumn("_d", decision).select(*arrivals.columns, "_d.*")


def last_written(routed: DataFrame, order: Sequence[str]) -> DataFrame:
    """The delivery whose references a slot keeps: the last written one of its UR."""
    return (
        routed.filter(F.col("outcome") == WRITTEN)
        .groupBy("collection", "granule_ur")
        .agg(F.max_by(F.struct("url", "time"), F.struct(*order)).alias("_w"))
        .select("collection", "granule_ur", "_w.url", "_w.time")
    )


def axis_changes(
    slots: DataFrame, routed: DataFrame, order: Sequence[str], stage: str | None = None, target_rows: int | None = None
) -> DataFrame:
    """The axis rows that a batch changes: appended ones, numbered on from the axis' end, and those written over.

    Their number is that of the written granules, whatever the length of the axis. They name ``stage`` as the write that
    holds their references.
    """
    keys = ["collection", "granule_ur"]
    written = last_written(routed, order)
    appended = routed.filter(F.col("action") == "append").select(*keys, "time")
    ends = lookup(slots.groupBy("collection").agg(F.max("slot").alias("_end")))
    ranked = ordered_position(appended, ["collection"], ["time"], "_rank", target_rows).join(ends, "collection", "left")
    number = (F.coalesce(F.col("_end") + 1, F.lit(0)) + F.col("_rank")).cast(slots.schema["slot"].dataType)
    new = ranked.select(*keys, "time", number.alias("slot"))
    over = slots.select(*keys, "time", "slot").join(lookup(written.select(*keys)), keys, "left_semi")
    urls = written.select(*keys, F.col("url").alias("granule_url"))
    return new.unionByName(over).join(urls, keys).select(
        "collection", "slot", "time", "granule_ur", "granule_url", F.lit(stage).cast("string").alias("ref_stage")
    )


def with_changes(slots: DataFrame, changes: DataFrame) -> DataFrame:
    """The axis that ``changes`` (one row a slot) make of ``slots``; unchanged rows are not moved while the changes are few."""
    few = lookup(changes, pinned=False)
    kept = slots.join(few.select("collection", "slot"), ["collection", "slot"], "left_anti")
    columns = ["collection", "slot", "time", "granule_ur", "granule_url", "ref_stage"]
    return kept.select(*columns).unionByName(changes.select(*columns))


def sync_slots(
    slots: DataFrame, routed: DataFrame, order: Sequence[str], stage: str | None = None, target_rows: int | None = None
) -> DataFrame:
    """The axis after a batch: appended slots added, owners' urls refreshed; no position of a committed slot changes."""
    return with_changes(slots, pin(axis_changes(slots, routed, order, stage, target_rows)))


def ledger_after(pending: DataFrame, routed: DataFrame, seq: str) -> DataFrame:
    """The pending ledger after a batch; ``seq`` is the delivery number of an arrival."""
    deferred = routed.filter(F.col("outcome") == DEFERRED).select(
        "collection", "granule_ur", "url", "time", F.col(seq).cast("long").alias("seq")
    )
    return upsert_pending(pending, deferred)


def retries_after(routed: DataFrame, limit: int = 20) -> tuple[DataFrame, DataFrame]:
    """Rejected arrivals to deliver again, and those delivered ``limit`` times already (dead letters)."""
    rejected = routed.filter(F.col("outcome") == REJECTED)
    spent = F.col("attempts") >= limit
    return rejected.filter(~spent), rejected.filter(spent)


def batch_result(routed: DataFrame, committed: bool = True) -> DataFrame:
    """Message ids to report as failed: the rejected ones, or all when the commit failed."""
    failed = routed.filter(F.col("outcome") == REJECTED) if committed else routed
    return failed.select("message_id")
