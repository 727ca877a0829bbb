"""Backfill: inventory and landed headers to a published version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.config import CollectionConfig
from scanledger.operators.findings import all_findings, as_findings, require_valid
from scanledger.operators.refs import expected_references
from scanledger.operators.slots import assign_slots, locate_slot
from scanledger.operators.template import flat_granules
from scanledger.operators.validate import (
    publish_gate,
    validate_granule_time,
    validate_granules,
    validate_inventory,
)
from scanledger.plans.store import Store, Version
from scanledger.session import lookup


def header_findings(
    headers: dict[str, DataFrame], template: DataFrame, coordinates: DataFrame, config: CollectionConfig
) -> DataFrame:
    """Every finding about the granules in ``headers`` (times, vars, nodes, axes); subject is the url."""
    axes = coordinates.groupBy("axis").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "value"))), lambda c: c["value"]).alias("values")
    )
    _, shape_findings = flat_granules(headers["vars"], config)
    urls = headers["times"].select("url").distinct()
    bare = [
        as_findings(urls.join(headers[table], "url", "left_anti"), check, F.col("url"), F.lit(f"granule has no {what}"))
        for table, check, what in (("vars", "variables", "variables"), ("nodes", "attributes", "attributes"))
    ]
    return all_findings(
        validate_granule_time(headers["times"]),
        validate_granules(template, headers["nodes"], axes, headers["axes"], config.volatile_attributes, urls),
        shape_findings,
        *bare,
    )


def _of(df: DataFrame, collection: str) -> DataFrame:
    return df.filter(F.col("collection") == collection)


def backfill(
    store: Store,
    entries: DataFrame,
    header: DataFrame,
    headers: dict[str, DataFrame],
    config: CollectionConfig,
    target_rows: int | None = None,
) -> Version:
    """Replace a collection's axis by the inventory and publish it.

    ``entries`` are inventory rows with ``position``; ``headers`` holds times(url, times, epoch),
    vars, nodes, axes and refs of the granules. Any finding fails the run and leaves the current
    version as it is; the next run starts over under a new stage.
    """
    pinned = store.require_initialized()
    require_valid(validate_inventory(entries, header, config, target_rows=target_rows), "inventory")
    template, coordinates = store.require_collection(config.collection)

    stage = store.new_stage()
    axis = assign_slots(entries, target_rows).select(
        "collection", "slot", "time", "granule_ur", F.col("url").alias("granule_url"), F.lit(stage).alias("ref_stage")
    )
    listed = headers["times"].join(entries.select("url"), "url", "left_semi")
    placed = locate_slot(
        listed.select(F.lit(config.collection).alias("collection"), "url", F.get("times", F.lit(0)).alias("time")), axis
    )
    unplaced = as_findings(
        placed.filter(F.col("matches") != 1),
        "axis_slot",
        F.col("url"),
        F.concat(F.lit("time matches "), F.col("matches").cast("string"), F.lit(" slots")),
    )
    unread = as_findings(
        entries.join(headers["times"], "url", "left_anti"), "header", F.col("url"), F.lit("granule header missing")
    )
    touched = {name: df.join(entries.select("url"), "url", "left_semi") for name, df in headers.items()}
    require_valid(
        all_findings(unplaced, unread, header_findings(touched, template, coordinates, config)), "granules"
    )

    others = store.slots(pinned).filter(F.col("collection") != config.collection)
    ledger = store.pending(pinned).filter(F.col("collection") != config.collection)
    meta = store.meta(pinned).filter(F.col("collection") != config.collection).unionByName(header)
    slots = others.unionByName(axis.select(*others.columns))
    # references follow their granule's exact time, not its name; one narrow look-up names them in one pass
    names = placed.join(axis.select("slot", "granule_ur"), "slot").select("url", "granule_ur")
    refs = headers["refs"].drop("granule_ur").join(lookup(names), "url")
    store.write_refs(stage, refs)
    store.write_state(stage, slots, ledger, meta, store.retries(pinned))

    staged = store._table(stage, "slots", _slots_schema())
    gate_version(store, _of(staged, config.collection), entries, config, target_rows)
    return store.publish(stage, pinned, "backfill")


def _slots_schema() -> str:
    from scanledger import schema

    return schema.SLOTS


def gate_version(
    store: Store, staged: DataFrame, entries: DataFrame, config: CollectionConfig, target_rows: int | None = None
) -> None:
    """The gate before publishing: axis equals inventory and rises, and every chunk has its reference.

    References are counted once, when they are written; the gate adds the counts of the granules on the axis.
    """
    inventory = assign_slots(entries, target_rows).select(
        "collection", "slot", "time", "granule_ur", F.col("url").alias("granule_url")
    )
    lengths = staged.groupBy("collection").agg(F.count(F.lit(1)).alias("n_slots"))
    expected = expected_references(_of(store.template(), config.collection), lengths, config.append_dim)
    unchecked = as_findings(
        lengths.join(expected.select("collection").distinct(), "collection", "left_anti"), "references", F.col("collection"),
        F.lit("the template names no array along the axis"),
    )
    gate = publish_gate(staged, inventory, store.reference_counts(staged), expected, target_rows=target_rows)
    require_valid(all_findings(gate, unchecked), "staged version")
