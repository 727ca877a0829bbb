"""Ordered operators that do not put a whole collection into one task.

A plain ``Window.partitionBy(collection).orderBy(...)`` sorts every row of a collection in one task,
and a third of all rows may belong to one collection. Inputs of more than ``TARGET_ROWS`` rows (those
of a few megabytes are not even counted) are therefore cut into ranges of their order first: a small
sample gives range bounds, the bounds become one literal, and each row finds its range by binary
search. Windows then run per (group, range), and what a range
needs from the ranges before it (last row, row count, maximum) comes from a table with one row per
(group, range). Any bounds give the right result; they only decide the balance, and as literals they
cannot change when a lost executor makes a task run again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.session import lookup

TARGET_ROWS = 2_000_000
# Inputs below this many bytes are fewer than one scan task reads by default (128 MB): no count is needed.
SMALL_BYTES = 32 * 1024 * 1024
MAX_RANGES = 10_000
SAMPLES_PER_RANGE = 20
# Spark's default for limiting a window per task (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000

_RANGE = "_range"


@dataclass(frozen=True)
class Ranges:
    """Bounds over (group, order) as a JSON literal; ``count`` is the number of bounds."""

    json: str
    schema: str
    count: int


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan; joins and unknown sources make it large, not small."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def plan_ranges(
    df: DataFrame, keys: Sequence[str], target_rows: int | None = None
) -> Ranges | None:
    """Range bounds for ``keys``, or None when all rows fit one task comfortably."""
    slim = df.select(*keys)
    if target_rows is None and estimated_bytes(slim) <= SMALL_BYTES:
        return None
    target = target_rows or TARGET_ROWS
    total = slim.count()
    if total <= target:
        return None
    wanted = min(MAX_RANGES, math.ceil(total / target))
    fraction = min(1.0, wanted * SAMPLES_PER_RANGE / total)
    # bounded by wanted * SAMPLES_PER_RANGE rows on average, whatever the size of df
    sample = (
        slim.sample(fraction=fraction, seed=7)
        .distinct()
        .select(F.struct(*keys).alias("k"))
        .orderBy("k")
        .select(F.to_json("k").alias("k"))
        .collect()
    )
    step = max(1, len(sample) // wanted)
    bounds = [row.k for row in sample[step::step]]
    if not bounds:
        return None
    schema = f"array<{slim.select(F.struct(*keys).alias('k')).schema['k'].dataType.simpleString()}>"
    return Ranges("[" + ",".join(bounds) + "]", schema, len(bounds))


def range_index(keys: Sequence[str], ranges: Ranges | None) -> Column:
    """Number of bounds at or below the row's key, by binary search over the literal."""
    if ranges is None:
        return F.lit(0)
    bounds = F.from_json(F.lit(ranges.json), ranges.schema)
    key = F.struct(*keys)
    steps = [F.lit(1 << i) for i in reversed(range(ranges.count.bit_length()))]
    return F.aggregate(
        F.array(*steps),
        F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= key, at + step).otherwise(at),
    )


def _ranged(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    target_rows: int | None,
    sized_by: DataFrame | None = None,
) -> tuple[DataFrame, list[str], bool]:
    """Rows with their range, the window partition, and whether there is more than one range.

    ``sized_by`` has the same keys as ``df`` but is cheaper to read; ranges are planned from it.
    """
    keys = [*group, *order]
    ranges = plan_ranges(df if sized_by is None else sized_by, keys, target_rows)
    if ranges is None:
        return df, list(group), False
    return df.withColumn(_RANGE, range_index(keys, ranges)), [*group, _RANGE], True


def _with_carry(
    rows: DataFrame, edges: DataFrame, group: Sequence[str], carried: Column, name: str
) -> DataFrame:
    """Attach to every row what the earlier ranges of its group add up to.

    The edges have one row per (group, range) with rows in it, so they usually fit a broadcast and
    the rows keep the partitioning of their window.
    """
    keys = [*group, _RANGE]
    earlier = lookup(edges.select(*[F.col(k).alias(f"_e_{k}") for k in keys], carried.alias(name)))
    same = [rows[k].eqNullSafe(earlier[f"_e_{k}"]) for k in keys]
    return rows.join(earlier, same, "left").drop(*[f"_e_{k}" for k in keys])


def _window(group: Sequence[str]):
    return Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))


def ordered_lag(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    name: str = "prev",
    target_rows: int | None = None,
) -> DataFrame:
    """Add ``name``: a struct of ``values`` of the row before in (group, order), null for the first.

    ``order`` must be a total order inside a group.
    """
    rows, parts, split = _ranged(df, group, order, target_rows)
    packed = F.struct(*values)
    w = _window(parts).orderBy(*order)
    out = rows.withColumn(name, F.lag(packed).over(w))
    if not split:
        return out
    edges = rows.groupBy(*parts).agg(F.max_by(packed, F.struct(*order)).alias("_last"))
    before = F.lag("_last").over(_window(group).orderBy(_RANGE))
    # only the first row of a range lacks a predecessor inside it
    out = _with_carry(out, edges, group, before, "_carry")
    return out.withColumn(name, F.coalesce(name, "_carry")).drop("_carry", _RANGE)


def ordered_position(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "slot",
    target_rows: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: the 0-based position in (group, order), as a long."""
    rows, parts, split = _ranged(df, group, order, target_rows, sized_by)
    out = rows.withColumn(
        name, F.row_number().over(_window(parts).orderBy(*order)).cast("long") - 1
    )
    if not split:
        return out
    edges = rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(_window(group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    out = _with_carry(out, edges, group, before, "_carry")
    return out.withColumn(name, F.col(name) + F.coalesce("_carry", F.lit(0))).drop("_carry", _RANGE)


def ordered_running_max(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: Column | str,
    name: str = "running_max",
    inclusive: bool = False,
    target_rows: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: the maximum of ``value`` over the earlier rows of (group, order).

    Rows whose value is null do not take part; ``inclusive`` counts the row itself too.
    """
    value = F.col(value) if isinstance(value, str) else value
    rows, parts, split = _ranged(df.withColumn("_value", value), group, order, target_rows, sized_by)
    frame = _window(parts).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    out = rows.withColumn(name, F.max("_value").over(frame))
    if not split:
        return out.drop("_value")
    edges = rows.groupBy(*parts).agg(F.max("_value").alias("_top"))
    before = F.max("_top").over(_window(group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    out = _with_carry(out, edges, group, before, "_carry")
    # greatest skips nulls
    return out.withColumn(name, F.greatest(name, "_carry")).drop("_carry", "_value", _RANGE)


def ordered_neighbours(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, target_rows: int | None = None
) -> DataFrame:
    """Add ``before``, the maximum of ``value`` over the earlier rows of (group, order), and ``after``, the first of the later rows.

    Rows whose value is null do not take part. Both come from one shuffle and one sort.
    """
    rows, parts, split = _ranged(df.withColumn("_value", value), group, order, target_rows)
    top = F.max("_value").over(_window(parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    by = ", ".join(f"`{p}`" for p in parts) or "0"
    following = F.expr(f"lead(_value) IGNORE NULLS OVER (PARTITION BY {by} ORDER BY {', '.join(f'`{o}`' for o in order)})")
    out = rows.select("*", top.alias("before"), following.alias("after"))
    if not split:
        return out.drop("_value")
    taking = F.when(F.col("_value").isNotNull(), F.struct(*order))
    edges = rows.groupBy(*parts).agg(F.max("_value").alias("_top"), F.min_by("_value", taking).alias("_first"))
    earlier = _window(group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    later = _window(group).orderBy(F.desc(_RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    carried = F.struct(F.max("_top").over(earlier).alias("top"), F.last("_first", ignorenulls=True).over(later).alias("first"))
    out = _with_carry(out, edges, group, carried, "_carry")
    # greatest skips nulls
    out = out.withColumns({"before": F.greatest("before", "_carry.top"), "after": F.coalesce("after", "_carry.first")})
    return out.drop("_carry", "_value", _RANGE)


def ordered_running_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "running_sum",
    target_rows: int | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of (group, order), 0 for the first."""
    rows, parts, split = _ranged(df, group, order, target_rows)
    frame = _window(parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn(name, F.coalesce(F.sum(value).over(frame), F.lit(0)))
    if not split:
        return out
    edges = rows.groupBy(*parts).agg(F.sum(value).alias("_n"))
    before = F.sum("_n").over(_window(group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    out = _with_carry(out, edges, group, before, "_carry")
    return out.withColumn(name, F.col(name) + F.coalesce("_carry", F.lit(0))).drop("_carry", _RANGE)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    """First ``k`` rows of each group.

    Up to ``GROUP_LIMIT`` rows Spark keeps at most ``k`` per task before it shuffles; more are ranked
    over ranges, so that a huge group is not sorted in one task.
    """
    if k <= GROUP_LIMIT:
        w = _window(group).orderBy(*order)
        return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")
    names = [f"_o{i}" for i in range(len(order))]
    ranked = ordered_position(df.withColumns(dict(zip(names, order))), group, names, "_rank")
    return ranked.filter(F.col("_rank") < k).drop("_rank", *names)
