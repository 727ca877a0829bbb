"""Landed catalogue listings."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger import schema
from scanledger.functions import expressions as x
from scanledger.operators.ordering import ordered_position


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """All records of the listing pages under ``path``, in listing order.

    A page is one JSON document with an ``items`` array. Page files are numbered by whoever landed
    them, so (last number in the file name, file name, index in the page) is the listing position; it
    stays a struct because turning it into one number would need a global sort.
    """
    pages = spark.read.schema(schema.CATALOGUE_PAGE).option("multiLine", True).json(path)
    return (
        pages.select(F.col("_metadata.file_name").alias("page"), F.posexplode("items").alias("index", "item"))
        .select(F.struct(_page_number("page").alias("number"), "page", "index").alias("position"), "item.meta", "item.umm")
    )


def read_catalogue_days(
    spark: SparkSession, path: str, since: datetime | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Records of listing pages landed under ``path/day=YYYY-MM-DD``, the UTC day of landing, in listing order inside a day.

    A record is not listed before it is revised, so folders of days before ``since`` hold nothing revised from then on and are not
    read. With ``files_per_batch`` the pages are a stream of so many files a batch.
    """
    reader = spark.read if files_per_batch is None else spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.schema(f"{schema.CATALOGUE_PAGE}, day date").option("multiLine", True).json(path)
    if since is not None:
        pages = pages.filter(F.col("day") >= F.lit(since.astimezone(timezone.utc).date()))
    items = pages.select("day", F.col("_metadata.file_name").alias("page"), F.posexplode("items").alias("index", "item"))
    position = F.struct("day", _page_number("page").alias("number"), "page", "index")
    return items.select(position.alias("position"), "item.meta", "item.umm")


def _page_number(name: str) -> Column:
    """So that page 10 comes after page 2."""
    return F.regexp_extract(name, r"([0-9]+)[^0-9]*$", 1).try_cast("long")


def flatten_records(records: DataFrame) -> DataFrame:
    """One flat row per record; UR falls back to the concept id, junk numbers and dates to null."""
    extent = F.col("umm.TemporalExtent.RangeDateTime")
    return records.select(
        "position",
        F.col("meta.`concept-id`").alias("concept_id"),
        F.coalesce(F.col("umm.GranuleUR"), F.col("meta.`concept-id`")).alias("granule_ur"),
        F.coalesce(F.col("meta.`revision-id`").try_cast("int"), F.lit(0)).alias("revision_id"),
        x.parse_instant("meta.`revision-date`").alias("revision_date"),
        x.parse_instant(extent["BeginningDateTime"]).alias("begin"),
        x.parse_instant(extent["EndingDateTime"]).alias("end"),
        x.direct_link("umm.RelatedUrls").alias("url"),
        F.transform("umm.RelatedUrls", lambda r: r["URL"]).alias("links"),
    )


def read_catalogue_window(
    records: DataFrame, start: str | None = None, end: str | None = None, max_count: int | None = None
) -> DataFrame:
    """Records whose extent meets [start, end]; with ``max_count`` the most recent ones by begin."""
    out = records
    if start is not None:
        out = out.filter(F.coalesce("end", "begin") >= x.parse_instant(F.lit(start)))
    if end is not None:
        out = out.filter(F.col("begin") <= x.parse_instant(F.lit(end)))
    if max_count is not None:
        out = out.orderBy(F.desc("begin"), "position").limit(max_count)
    return out


def data_links(records: DataFrame, access: str = "direct") -> tuple[DataFrame, DataFrame]:
    """Records with their data link, and a finding for every record that has none."""
    linked = records.withColumn("data_url", x.data_link("links", access))
    missing = linked.filter(F.col("data_url").isNull()).select(
        F.lit("data_link").alias("check"),
        F.col("concept_id").alias("subject"),
        F.lit("no .nc data link").alias("detail"),
        F.lit("error").alias("severity"),
    )
    return linked.filter(F.col("data_url").isNotNull()), missing


def read_collections(spark: SparkSession, path: str) -> DataFrame:
    """Collection-level catalogue documents, one JSON document per line."""
    return spark.read.schema(schema.COLLECTION_RECORD).json(path)


def audit_records(flat: DataFrame, collection: str, target_rows: int | None = None) -> DataFrame:
    """Flat records with a link, as ``nearest_granule`` takes them: times in axis seconds and the listing rank as a number."""
    parts = {f"_{name}": F.col("position")[name] for name in flat.schema["position"].dataType.names}
    listed = flat.filter(F.col("url").isNotNull() & F.col("begin").isNotNull()).select(
        F.lit(collection).alias("collection"), x.axis_seconds("begin").alias("begin"),
        x.axis_seconds(F.coalesce("end", "begin")).alias("end"), "url", "granule_ur",
        *(column.alias(name) for name, column in parts.items()),
    )
    return ordered_position(listed, ["collection"], list(parts), "rank", target_rows).drop(*parts)
