"""Granule variables and store templates: flatten, drop, promote, strip, resize, derive."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.config import OWNER_ARRAYS, WRITE_ARTIFACTS, CollectionConfig
from scanledger.functions import expressions as x
from scanledger.operators.findings import as_findings, literal_rows


def _with_dim(config: CollectionConfig) -> Column:
    return F.array_contains("dims", config.append_dim)


def flatten_groups(granule_vars: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Root variables and those of the listed groups, all at the root."""
    return granule_vars.filter((F.col("grp") == "") | F.col("grp").isin(*groups)).withColumn("grp", F.lit(""))


def flatten_findings(granule_vars: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Listed groups a granule lacks, and names that collide at the root."""
    present = granule_vars.groupBy("url").agg(F.collect_set("grp").alias("_groups"))
    wanted = F.array(*[F.lit(g) for g in groups]) if groups else F.array().cast("array<string>")
    missing = present.select("url", F.explode(F.array_except(wanted, "_groups")).alias("g"))
    clashes = (
        flatten_groups(granule_vars, groups).groupBy("url", "name").count().filter(F.col("count") > 1)
    )
    return as_findings(
        missing, "flatten_groups", F.col("url"), F.concat(F.lit("group missing: "), F.col("g"))
    ).unionByName(
        as_findings(
            clashes, "flatten_groups", F.col("url"), F.concat(F.lit("variable collides: "), F.col("name"))
        )
    )


def drop_variables(granule_vars: DataFrame, names: Sequence[str]) -> DataFrame:
    return granule_vars.filter(~F.col("name").isin(*names)) if names else granule_vars


def missing_names(granule_vars: DataFrame, names: Sequence[str], check: str) -> DataFrame:
    """Listed names a granule does not carry (of ``drop_variables`` or ``promote_to_time``)."""
    wanted = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    carried = granule_vars.groupBy("url").agg(
        F.collect_set(F.when(F.col("name").isin(*names) if names else F.lit(False), F.col("name"))).alias("_n")
    )
    lacking = carried.select("url", F.explode(F.array_except(wanted, "_n")).alias("name"))
    return as_findings(lacking, check, F.col("url"), F.concat(F.lit("variable missing: "), F.col("name")))


def promote_to_time(granule_vars: DataFrame, config: CollectionConfig) -> DataFrame:
    """Listed per-scan variables gain a leading time dimension of one; others stay as they are."""
    names = list(config.promote_to_time)
    if not names:
        return granule_vars
    lift = F.col("name").isin(*names) & ~_with_dim(config)
    one = F.array(F.lit(1))
    return (
        granule_vars.withColumn("shape", F.when(lift, F.concat(one, "shape")).otherwise(F.col("shape")))
        .withColumn("chunk_shape", F.when(lift, F.concat(one, "chunk_shape")).otherwise(F.col("chunk_shape")))
        .withColumn("dims", F.when(lift, F.concat(F.array(F.lit(config.append_dim)), "dims")).otherwise(F.col("dims")))
    )


def unpromoted_variables(
    granule_vars: DataFrame, config: CollectionConfig, coordinates: Collection[str] = ("time", "latitude", "longitude")
) -> DataFrame:
    """Data variables that still lack the time dimension: stacking would keep one scan's values."""
    return granule_vars.filter(~F.col("name").isin(*coordinates) & ~_with_dim(config))


def flat_granules(granule_vars: DataFrame, config: CollectionConfig) -> tuple[DataFrame, DataFrame]:
    """Flatten, drop and promote as configured; returns the variables and every finding."""
    flat = flatten_groups(granule_vars, config.flatten_groups)
    kept = drop_variables(flat, config.drop_variables)
    lifted = promote_to_time(kept, config)
    findings = (
        flatten_findings(granule_vars, config.flatten_groups)
        .unionByName(missing_names(flat, config.drop_variables, "drop_variables"))
        .unionByName(missing_names(kept, config.promote_to_time, "promote_to_time"))
        .unionByName(
            as_findings(
                unpromoted_variables(lifted, config),
                "unpromoted_variables",
                F.col("url"),
                F.concat(F.lit("no time dimension: "), F.col("name")),
            )
        )
    )
    return lifted, findings


# -- templates ------------------------------------------------------------------------------------


def strip_attributes(template: DataFrame, names: Collection[str]) -> DataFrame:
    return template.withColumn("attributes", x.without_keys("attributes", names))


def strip_write_artifacts(template: DataFrame, carried: DataFrame) -> DataFrame:
    """Drop write-path attributes from nodes whose reference granule does not carry them.

    ``carried(path, attributes)`` are the nodes of the reference granule.
    """
    own = carried.select("path", F.map_keys("attributes").alias("_own"))
    out = template.join(own, "path", "left").withColumn(
        "_own", F.coalesce("_own", F.array().cast("array<string>"))
    )
    keep = F.map_filter(
        "attributes", lambda k, _: ~k.isin(*sorted(WRITE_ARTIFACTS)) | F.array_contains(F.col("_own"), k)
    )
    return out.withColumn("attributes", keep).select(*template.columns)


def resize_dims(template: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Set named dimension sizes in every array; chunk shapes stay."""
    return template.withColumn("shape", x.resized_shape("dims", "shape", sizes))


def unknown_dims(template: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Named dimensions no array has."""
    seen = template.select(F.explode("dims").alias("dim")).distinct()
    asked = literal_rows(template.sparkSession, "dim string", [(d,) for d in sizes])
    return asked.join(seen, "dim", "left_anti")


def override_time_chunk(template: DataFrame, size: int, append_dim: str = "time") -> DataFrame:
    return template.withColumn(
        "chunk_shape",
        F.when(F.col("path") == f"/{append_dim}", F.array(F.lit(size))).otherwise(F.col("chunk_shape")),
    )


def varying_attributes(
    granule_nodes: DataFrame, volatile: Collection[str] = ()
) -> DataFrame:
    """Attributes whose value differs, or that some granules lack, and that are not declared volatile."""
    nodes = granule_nodes.groupBy("path").agg(F.count(F.lit(1)).alias("_nodes"))
    pairs = granule_nodes.select("path", F.explode("attributes").alias("key", "value"))
    if volatile:
        pairs = pairs.filter(~F.col("key").isin(*sorted(volatile)))
    # pre-aggregated per value, so one value shared by every granule stays one row per task
    per_value = pairs.groupBy("path", "key", x.canonical_json("value").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_key = per_value.groupBy("path", "key").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_granules")
    )
    return (
        per_key.join(nodes, "path")
        .filter((F.col("n_values") > 1) | (F.col("n_granules") != F.col("_nodes")))
        .select("path", "key", "n_values", "n_granules")
    )


def build_template(
    granule_vars: DataFrame, granule_nodes: DataFrame, reference_url: str, config: CollectionConfig
) -> DataFrame:
    """Store template from one reference granule: its arrays and groups without volatile attributes,
    the axis chunk widened, and the owner arrays added. Validate the other granules against it.

    Arrays keep their ``codecs`` where ``granule_vars`` has that column.
    """
    lifted, _ = flat_granules(granule_vars.filter(F.col("url") == reference_url), config)
    nodes = granule_nodes.filter(F.col("url") == reference_url).select("path", "attributes")
    empty = F.create_map().cast("map<string,string>")
    none = F.array().cast("array<string>")
    codecs = F.coalesce("codecs", none) if "codecs" in lifted.columns else none
    arrays = lifted.select(
        F.concat(F.lit("/"), "name").alias("path"),
        F.lit("array").alias("node_type"),
        "data_type",
        "shape",
        "chunk_shape",
        F.col("fill_value").cast("string").alias("fill_value"),
        codecs.alias("codecs"),
        "dims",
    )
    root = nodes.filter(F.col("path") == "").select(
        "path",
        F.lit("group").alias("node_type"),
        F.lit(None).cast("string").alias("data_type"),
        F.lit(None).cast("array<int>").alias("shape"),
        F.lit(None).cast("array<int>").alias("chunk_shape"),
        F.lit(None).cast("string").alias("fill_value"),
        F.lit(None).cast("array<string>").alias("codecs"),
        F.lit(None).cast("array<string>").alias("dims"),
    )
    owners = literal_rows(arrays.sparkSession, "path string", [(f"/{n}",) for n in OWNER_ARRAYS]).select(
        "path",
        F.lit("array").alias("node_type"),
        F.lit("string").alias("data_type"),
        F.array(F.lit(1)).alias("shape"),
        F.array(F.lit(config.time_chunk_size)).alias("chunk_shape"),
        F.lit("").alias("fill_value"),
        F.array().cast("array<string>").alias("codecs"),
        F.array(F.lit(config.append_dim)).alias("dims"),
    )
    out = (
        arrays.unionByName(root)
        .unionByName(owners)
        .join(nodes, "path", "left")
        .withColumn("attributes", F.coalesce("attributes", empty))
    )
    out = strip_attributes(out, config.volatile_attributes)
    return override_time_chunk(out, config.time_chunk_size, config.append_dim)
