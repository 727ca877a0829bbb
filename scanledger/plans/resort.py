"""Re-sort: fold the earliest pending granules into the axis and publish.

Every read comes from the version pinned first; publishing is refused if another job moved on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger import schema
from scanledger.config import CollectionConfig
from scanledger.operators.findings import all_findings, as_findings, require_valid
from scanledger.operators.refs import unmovable_arrays
from scanledger.operators.slots import drain_pending, earliest_pending, first_shift, merge_pending
from scanledger.operators.validate import validate_inventory
from scanledger.plans.backfill import _of, gate_version, header_findings
from scanledger.plans.store import Store, Version
from scanledger.session import pin


@dataclass(frozen=True)
class ResortReport:
    resorted: bool
    inserted: int = 0
    remaining: int = 0
    first_shift: int | None = None
    version: Version | None = None


def resort(
    store: Store,
    headers: dict[str, DataFrame],
    config: CollectionConfig,
    max_fold: int = 500,
    target_rows: int | None = None,
    pinned: Version | None = None,
) -> ResortReport:
    """Fold up to ``max_fold`` pending granules of a collection, earliest first."""
    pinned = pinned or store.require_initialized()
    pending_all = store.pending(pinned)
    pending = _of(pending_all, config.collection)
    waiting = pending.count()
    if waiting == 0:
        return ResortReport(False)
    template, coordinates = store.require_collection(config.collection)
    fold = earliest_pending(pending, max_fold)
    slots_all = store.slots(pinned)
    slots = _of(slots_all, config.collection)

    # one row per granule, read by every step below
    merged = pin(merge_pending(slots, fold, target_rows))
    require_valid(
        validate_inventory(merged.withColumnRenamed("granule_url", "url"), position="slot", target_rows=target_rows),
        "merged axis",
    )
    frozen = as_findings(
        unmovable_arrays(template, config.append_dim),
        "chunking",
        F.col("path"),
        F.concat(F.col("slots_per_chunk").cast("string"), F.lit(" slots per chunk cannot be relocated")),
    )
    touched = {name: df.join(fold.select("url"), "url", "left_semi") for name, df in headers.items()}
    unread = as_findings(
        fold.join(headers["times"], "url", "left_anti"), "header", F.col("url"), F.lit("granule header missing")
    )
    moved = as_findings(
        fold.join(headers["times"].select("url", F.get("times", F.lit(0)).alias("_t")), "url").filter(
            ~F.col("time").eqNullSafe(F.col("_t"))
        ),
        "axis_slot",
        F.col("url"),
        F.lit("time in the ledger differs from the granule's"),
    )
    require_valid(
        all_findings(frozen, unread, moved, header_findings(touched, template, coordinates, config)), "fold"
    )
    shift = first_shift(slots, merged).first()

    stage = store.new_stage()
    new_refs = touched["refs"].drop("granule_ur", "collection").join(
        fold.select("url", "collection", "granule_ur"), "url"
    )
    axis = (
        merged.join(slots.select("granule_ur", F.col("ref_stage").alias("_stage")), "granule_ur", "left")
        .withColumn("ref_stage", F.when(F.col("inserted"), F.lit(stage)).otherwise(F.col("_stage")))
        .select(*slots_all.columns)
    )
    others = slots_all.filter(F.col("collection") != config.collection)
    store.write_refs(stage, new_refs)
    store.write_state(
        stage,
        others.unionByName(axis),
        drain_pending(pending_all, fold),
        store.meta(pinned),
        store.retries(pinned),
    )
    staged = _of(store._table(stage, "slots", schema.SLOTS), config.collection)
    entries = merged.select("collection", "granule_ur", F.col("granule_url").alias("url"), "time")
    gate_version(store, staged, entries, config, target_rows)
    version = store.publish(stage, pinned, "resort")
    inserted = min(waiting, max_fold)
    return ResortReport(True, inserted, waiting - inserted, shift.first_shift if shift else 0, version)
