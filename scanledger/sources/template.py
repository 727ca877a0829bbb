"""Store templates and reference coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger import schema

# A template document is a tree: groups hold members, arrays carry shape, chunks, codecs and names.
# Attribute values, codecs and fill values stay raw JSON text.
_ARRAY = (
    "node_type string, data_type string, shape array<int>, fill_value string, "
    "chunk_grid struct<name: string, configuration: struct<chunk_shape: array<int>>>, "
    "codecs array<string>, dimension_names array<string>, attributes map<string,string>, "
    "members map<string,string>"
)


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """Template JSON document to one row per node, however deep its groups nest."""
    text = spark.read.text(path, wholetext=True)
    level = text.select(F.lit("").alias("path"), F.from_json("value", _ARRAY).alias("n"))
    nodes = level
    while not level.filter(F.size("n.members") > 0).isEmpty():
        level = level.select("path", F.explode(F.col("n.members")).alias("name", "doc")).select(
            F.concat_ws("/", "path", "name").alias("path"), F.from_json("doc", _ARRAY).alias("n")
        )
        nodes = nodes.unionByName(level)
    return nodes.select(
        "path",
        F.coalesce("n.node_type", F.when(F.col("n.shape").isNull(), "group").otherwise("array")).alias("node_type"),
        "n.data_type",
        "n.shape",
        F.col("n.chunk_grid.configuration.chunk_shape").alias("chunk_shape"),
        "n.fill_value",
        "n.codecs",
        F.col("n.dimension_names").alias("dims"),
        F.coalesce("n.attributes", F.create_map().cast("map<string,string>")).alias("attributes"),
    )


def write_template(template: DataFrame, path: str) -> None:
    template.coalesce(1).write.mode("errorifexists").json(path)


def read_template_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.TEMPLATE).json(path)


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Reference axes from JSON lines ``{"axis": ..., "values": [...]}``; a missing artifact is named."""
    try:
        lines = spark.read.schema("axis string, `values` array<float>").json(path)
    except Exception as error:
        raise FileNotFoundError(f"cannot read the reference coordinates at {path}") from error
    return lines.select("axis", F.posexplode("values").alias("idx", "value"))


def write_coordinates(coordinates: DataFrame, path: str) -> None:
    """Axes as one array each; an axis is as long as the grid is wide."""
    coordinates.groupBy("axis").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "value"))), lambda c: c["value"]).alias("values")
    ).write.mode("errorifexists").json(path)
