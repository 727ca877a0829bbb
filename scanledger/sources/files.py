"""Source files, header tables and the poll watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger import schema
from scanledger.functions import expressions as x


def source_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, modification time, length and reference stamp of every file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "modificationTime", "length", x.reference_stamp("modificationTime").alias("stamp"))
    )


def read_granule_headers(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Header tables landed by an extractor: times, variables, nodes with attributes, axes, references."""
    return {
        "times": spark.read.schema(schema.GRANULE_TIMES).parquet(f"{path}/times"),
        "vars": spark.read.schema(schema.GRANULE_VARS).parquet(f"{path}/vars"),
        "nodes": spark.read.schema(schema.GRANULE_NODES).parquet(f"{path}/nodes"),
        "axes": spark.read.schema(schema.GRANULE_AXES).parquet(f"{path}/axes"),
        "refs": spark.read.schema(schema.GRANULE_REFS).parquet(f"{path}/refs"),
    }


def read_watermark(spark: SparkSession, path: str):
    """The stored poll instant, or None."""
    from scanledger.plans.store import path_exists

    if not path_exists(spark, path):
        return None
    rows = spark.read.schema("revision_date string").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.json"
    ).json(path)
    return rows.agg(F.max(x.parse_instant("revision_date")).alias("at")).first().at


def write_watermark(spark: SparkSession, path: str, value) -> None:
    """Add a poll instant. The latest one counts and none is replaced, so a crash cannot lose it."""
    spark.range(1).select(
        F.date_format(F.lit(value).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("revision_date")
    ).coalesce(1).write.mode("append").json(path)
