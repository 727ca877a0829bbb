"""Catalogue records: newest revisions, publication order, inventories and collection reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.functions import expressions as x
from scanledger.operators.ordering import ordered_lag


def latest_revision(
    records: DataFrame, keys: Sequence[str], revision: str, position: Sequence[str]
) -> DataFrame:
    """Newest revision per key; of equal revisions the first listed one."""
    best = F.min_by(F.struct("*"), F.struct(-F.col(revision), *position))
    return records.groupBy(*keys).agg(best.alias("_best")).select("_best.*")


def duplicate_urs(entries: DataFrame, keys: Sequence[str] = ("collection", "granule_ur")) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def publication_lag(
    log: DataFrame, group: Sequence[str], order: Sequence[str], scan: str, target_rows: int | None = None
) -> DataFrame:
    """Add ``prev_scan``: scan time of the record published just before in the same group."""
    out = ordered_lag(log, group, order, [scan], "_prev", target_rows)
    return out.withColumn("prev_scan", F.col("_prev")[scan]).drop("_prev")


def publish_order_report(
    log: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    scan: str,
    revision: str,
    swap_seconds: int,
    target_rows: int | None = None,
) -> DataFrame:
    """How far publication order strays from scan order, one row per group.

    An inversion is a record whose scan lies before that of the record published just before it; it
    counts as a swap up to ``swap_seconds`` apart (inclusive), else as a historical arrival.
    Republished records are those above the lowest revision of the group.
    """
    lagged = publication_lag(log, group, order, scan, target_rows)

    def micros(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    gap = micros("prev_scan") - micros(scan)
    inverted = gap > 0
    swapped = inverted & (gap <= swap_seconds * 1_000_000)
    # counting per revision first gives the baseline share without a second pass over the log
    by_revision = lagged.groupBy(*group, revision).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(inverted, F.lit(False))).alias("inversions"),
        F.count_if(F.coalesce(swapped, F.lit(False))).alias("swaps"),
    )
    totals = by_revision.groupBy(*group).agg(
        F.sum("n").alias("total"),
        F.sum("inversions").alias("inversions"),
        F.sum("swaps").alias("adjacent_swaps"),
        F.min_by("n", revision).alias("_baseline"),
    )
    pairs = F.greatest(F.col("total") - 1, F.lit(0))
    republished = F.col("total") - F.col("_baseline")
    return totals.select(
        *group,
        "total",
        pairs.alias("pairs"),
        "inversions",
        "adjacent_swaps",
        (F.col("inversions") - F.col("adjacent_swaps")).alias("historical_arrivals"),
        republished.alias("republished"),
        percentage(F.col("inversions"), pairs).alias("inversion_pct"),
        percentage(republished, F.col("total")).alias("republished_pct"),
    )


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 when there is nothing to divide by."""
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))


def build_inventory(
    records: DataFrame, header_times: DataFrame, collection: str, access: str = "direct"
) -> tuple[DataFrame, DataFrame]:
    """Inventory entries of a collection from catalogue records and the times read from file headers.

    ``records`` are flattened records, ``header_times(url, time)`` the exact in-file times. Returns
    the entries and the findings that make the set unusable (no link, no header time).
    """
    newest = latest_revision(records, ["granule_ur"], "revision_id", ["position"])
    linked = newest.withColumn("data_url", x.data_link("links", access))
    timed = linked.join(header_times.select(F.col("url").alias("data_url"), "time"), "data_url", "left")
    problem = F.when(F.col("data_url").isNull(), "no .nc data link").when(
        F.col("time").isNull(), "header time could not be read"
    )
    findings = timed.filter(problem.isNotNull()).select(
        F.lit("build_inventory").alias("check"),
        F.col("concept_id").alias("subject"),
        problem.alias("detail"),
        F.lit("error").alias("severity"),
    )
    entries = timed.filter(problem.isNull()).select(
        F.lit(collection).alias("collection"),
        F.col("data_url").alias("url"),
        x.granule_ur("data_url").alias("granule_ur"),
        "time",
    )
    return entries, findings


def temporal_extent(collections: DataFrame) -> DataFrame:
    """One row per temporal range of a collection; an open end reads "Present" where flagged."""
    extents = collections.select(
        F.col("meta.`concept-id`").alias("concept_id"), F.explode_outer("umm.TemporalExtents").alias("e")
    )
    ranges = extents.select(
        "concept_id", "e", F.explode_outer("e.RangeDateTimes").alias("r")
    )
    open_end = F.when(F.col("e.EndsAtPresentFlag"), "Present").otherwise("?")
    resolution = F.concat_ws(" ", "e.TemporalResolution.Value", "e.TemporalResolution.Unit")
    return ranges.filter(F.col("r").isNotNull()).select(
        "concept_id",
        F.coalesce("r.BeginningDateTime", F.lit("?")).alias("begin"),
        F.coalesce(F.col("r.EndingDateTime"), open_end).alias("end"),
        F.nullif(resolution, F.lit("")).alias("resolution"),
    )


def collection_report(collections: DataFrame, records: DataFrame) -> DataFrame:
    """One row per collection: names, citation, instruments, keywords, granule count and newest granule.

    ``records(concept_id, granule_ur, begin, position)`` are the granule records of the collections.
    """
    counted = records.groupBy("concept_id").agg(
        F.count(F.lit(1)).alias("granule_count"),
        F.min("begin").alias("first_begin"),
        F.max("begin").alias("last_begin"),
        F.max_by("granule_ur", F.struct("begin", "granule_ur")).alias("most_recent"),
    )
    platforms = F.col("umm.Platforms")
    described = collections.select(
        F.col("meta.`concept-id`").alias("concept_id"),
        F.concat_ws(" ", "umm.ShortName", "umm.Version").alias("title"),
        F.col("umm.EntryTitle").alias("entry_title"),
        F.coalesce("umm.Abstract", F.lit("(no abstract)")).alias("abstract"),
        F.col("umm.DOI.DOI").alias("doi"),
        F.transform("umm.CollectionCitations", x.citation).alias("citations"),
        F.transform(platforms, lambda p: F.coalesce(p["ShortName"], F.lit("?"))).alias("platforms"),
        F.transform(
            F.flatten(F.transform(platforms, lambda p: p["Instruments"])), lambda i: F.coalesce(i["ShortName"], F.lit("?"))
        ).alias("instruments"),
        F.transform("umm.Projects", lambda p: F.coalesce(p["ShortName"], F.lit("?"))).alias("projects"),
        x.keyword_paths("umm.ScienceKeywords").alias("keywords"),
        F.col("umm.CollectionProgress").alias("data_state"),
        F.col("umm.ProcessingLevel.Id").alias("processing_level"),
        F.col("meta.`revision-date`").alias("revision_date"),
    )
    return described.join(counted, "concept_id", "left").withColumn(
        "granule_count", F.coalesce("granule_count", F.lit(0).cast("long"))
    )
