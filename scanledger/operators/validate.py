"""Checks as rows. Every function returns findings; none means valid."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.config import EPOCH_ATTRIBUTE, CollectionConfig
from scanledger.functions import expressions as x
from scanledger.operators import compare, refs
from scanledger.operators.catalogue import duplicate_urs
from scanledger.operators.findings import all_findings, as_findings
from scanledger.operators.slots import axis_violations


def validate_inventory(
    entries: DataFrame,
    header: DataFrame | None = None,
    config: CollectionConfig | None = None,
    position: str = "position",
    target_rows: int | None = None,
) -> DataFrame:
    """Empty inventory, urls that are no granule, times that do not rise, repeated URs, foreign header."""
    label = F.concat_ws("/", F.col("collection"), F.col("granule_ur"))
    parts = [
        as_findings(
            entries.filter(~x.is_granule_url("url")), "granule_url", label, F.concat(F.lit("not the url of a .nc granule: "), F.coalesce("url", F.lit("null")))
        ),
        as_findings(
            axis_violations(entries, position, target_rows),
            "axis_order",
            label,
            F.concat(F.lit("time "), F.col("time").cast("string"), F.lit(" does not exceed the one before")),
        ),
        as_findings(
            duplicate_urs(entries), "duplicate_ur", label, F.concat(F.lit("occurs "), F.col("n").cast("string"), F.lit(" times"))
        ),
    ]
    if header is not None:
        filled = entries.select("collection").distinct()
        parts.append(
            as_findings(
                header.join(filled, "collection", "left_anti"), "empty", F.col("collection"), F.lit("inventory holds no granule")
            )
        )
        if config is not None:
            wrong_schema = header.filter(~F.col("schema").eqNullSafe(F.lit(config.schema_id)))
            foreign = header.filter(~F.col("collection").eqNullSafe(F.lit(config.collection)))
            parts.append(as_findings(wrong_schema, "schema", F.col("collection"), F.concat(F.lit("schema is "), F.col("schema"))))
            parts.append(
                as_findings(
                    foreign, "collection", F.col("collection"), F.lit(f"inventory is not for {config.collection}")
                )
            )
    return all_findings(*parts)


def validate_granule_time(granules: DataFrame) -> DataFrame:
    """``granules(url, times ARRAY<DOUBLE>, epoch DOUBLE)``: exactly one time step, equal to the root attribute."""
    n = F.size("times")
    value = F.get("times", F.lit(0))
    problem = (
        F.when(F.col("times").isNull(), "granule has no time variable")
        .when(n != 1, F.concat(n.cast("string"), F.lit(" time steps instead of one")))
        .when(F.col("epoch").isNull(), F.lit(f"root attribute {EPOCH_ATTRIBUTE} missing"))
        .when(~(F.col("epoch") == value) | F.isnan(value), F.lit(f"root attribute {EPOCH_ATTRIBUTE} differs from the time"))
    )
    bad = granules.withColumn("_p", problem).filter(F.col("_p").isNotNull())
    return as_findings(bad, "granule_time", F.col("url"), F.col("_p"))


def validate_granules(
    template: DataFrame,
    granule_nodes: DataFrame,
    reference_axes: DataFrame,
    granule_axes: DataFrame,
    volatile: Collection[str] = (),
    urls: DataFrame | None = None,
) -> DataFrame:
    """Grid and attributes of every granule against the template; undeclared attributes only warn.

    ``urls`` lists the granules, so that one without any axis is found as well.
    """
    axes = compare.compare_axes(reference_axes, granule_axes, urls)
    attrs = compare.compare_attributes(template, granule_nodes, volatile)
    detail = F.concat_ws(" ", F.lit("attribute"), F.col("path"), F.col("key"), F.col("problem"))
    return all_findings(
        as_findings(axes, "coordinates", F.col("url"), F.concat_ws(" ", "axis", "problem")),
        as_findings(attrs, "attributes", F.col("url"), detail, F.col("severity")),
    )


def validate_store(
    template: DataFrame,
    store_nodes: DataFrame,
    allow_extra: bool = False,
    volatile: Collection[str] = (),
) -> DataFrame:
    """Nodes, fields and attributes of a store against its template."""
    nodes = compare.compare_nodes(template, store_nodes, allow_extra)
    attrs = compare.compare_attributes(template, store_nodes.select("path", "attributes"), volatile)
    node_detail = F.concat_ws(" ", "problem", "field", "expected", "found")
    attr_detail = F.concat_ws(" ", F.lit("attribute"), "key", "problem")
    where = F.when(F.col("path") == "", "/").otherwise(F.col("path"))
    return all_findings(
        as_findings(nodes, "nodes", where, node_detail),
        as_findings(attrs, "attributes", where, attr_detail, F.col("severity")),
    )


def publish_gate(
    slots: DataFrame,
    inventory: DataFrame,
    stored_refs: DataFrame,
    expected: DataFrame,
    reference_axes: DataFrame | None = None,
    store_axes: DataFrame | None = None,
    template: DataFrame | None = None,
    store_nodes: DataFrame | None = None,
    volatile: Collection[str] = (),
    target_rows: int | None = None,
) -> DataFrame:
    """Everything that must hold before a version becomes current, all findings together.

    ``slots`` and ``inventory`` are (collection, slot, time, granule_ur, granule_url);
    ``reference_axes`` and ``store_axes`` are (axis, idx, value).
    """
    label = F.concat_ws("/", "collection", F.col("slot").cast("string"))
    positional = compare.compare_positional(slots, inventory)
    rising = axis_violations(slots, "slot", target_rows)
    gaps = refs.missing_references(stored_refs, expected)
    parts = [
        as_findings(positional, "inventory", label, F.concat(F.lit("differs from the inventory: "), F.col("problem"))),
        as_findings(rising, "axis_order", label, F.lit("time does not exceed that of the slot before")),
        as_findings(
            gaps,
            "references",
            F.concat_ws("/", "collection", "variable"),
            F.concat(F.col("actual").cast("string"), F.lit(" of "), F.col("expected").cast("string"), F.lit(" references")),
        ),
    ]
    if reference_axes is not None and store_axes is not None:
        grid = compare.compare_coordinates(reference_axes, store_axes)
        parts.append(as_findings(grid, "coordinates", F.col("axis"), F.col("problem")))
    if template is not None and store_nodes is not None:
        parts.append(validate_store(template, store_nodes, True, volatile))
    return all_findings(*parts)
