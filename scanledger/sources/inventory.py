"""Inventory documents and the partition lists derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger import schema
from scanledger.config import CollectionConfig
from scanledger.operators.ordering import ordered_position


def read_inventory(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Header row and granule rows of inventory JSON documents; ``position`` is the listed order.

    Pass both to ``validate_inventory`` before use.
    """
    doc = spark.read.schema(schema.INVENTORY).option("multiLine", multi_line).json(path)
    header = doc.drop("granules")
    granules = doc.select("collection", F.posexplode("granules").alias("position", "g")).select(
        "collection", F.col("position").cast("long"), "g.url", "g.granule_ur", "g.time"
    )
    return header, granules


def write_inventory(entries: DataFrame, header: DataFrame, path: str) -> None:
    """Inventory rows to Parquet (any size): granules and header side by side."""
    entries.select("collection", "url", "granule_ur", "time").write.mode("errorifexists").partitionBy(
        "collection"
    ).parquet(f"{path}/granules")
    header.write.mode("errorifexists").parquet(f"{path}/header")


def read_inventory_table(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """What ``write_inventory`` wrote, with ``position`` recomputed from the times."""
    header = spark.read.schema(schema.STORE_META).parquet(f"{path}/header")
    entries = spark.read.schema("collection string, url string, granule_ur string, time double").parquet(
        f"{path}/granules"
    )
    return header, ordered_position(entries, ["collection"], ["time", "granule_ur"], "position")


def write_inventory_lines(entries: DataFrame, header: DataFrame, path: str) -> None:
    """Inventory as JSON lines, for exchange with other readers: a line per granule and a line per header, of any size."""
    entries.select("collection", "url", "granule_ur", "time", "position").write.mode("errorifexists").partitionBy(
        "collection"
    ).json(f"{path}/granules")
    header.write.mode("errorifexists").json(f"{path}/header")


def read_inventory_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Header and granule rows of what ``write_inventory_lines`` wrote."""
    granules = spark.read.schema("collection string, url string, granule_ur string, time double, position long").json(f"{path}/granules")
    return spark.read.schema(schema.STORE_META).json(f"{path}/header"), granules.select(
        "collection", "position", "url", "granule_ur", "time"
    )


def header_row(spark: SparkSession, config: CollectionConfig) -> DataFrame:
    """Header of a collection's inventory, built now."""
    return spark.range(1).select(
        F.lit(config.schema_id).alias("schema"),
        F.lit(config.collection).alias("collection"),
        F.lit(config.concept_id).alias("concept_id"),
        F.lit(config.time_units).alias("time_units"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("built_at"),
    )


def write_partitions(entries: DataFrame, path: str) -> None:
    """Granule lists per (collection, partition_id)."""
    entries.write.mode("errorifexists").partitionBy("collection", "partition_id").parquet(path)


def read_partition(spark: SparkSession, path: str, collection: str, partition_id: int) -> DataFrame:
    """One partition's granules; only its files are read."""
    return spark.read.parquet(path).filter(
        (F.col("collection") == collection) & (F.col("partition_id") == partition_id)
    )
