"""Incremental polling of the landed catalogue."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.sources.catalogue import flatten_records, read_catalogue_days
from scanledger.sources.files import read_watermark, write_watermark

OVERLAP = timedelta(hours=24)
LOOKBACK = timedelta(days=8)


def initial_watermark(now: datetime, start: str | None = None) -> datetime:
    """Where a first poll starts: the configured instant (UTC if it names no offset), else 8 days back."""
    if not start:
        return now - LOOKBACK
    at = datetime.fromisoformat(start)
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def poll_increment(records: DataFrame, since: Column) -> tuple[DataFrame, DataFrame]:
    """Urls of records revised at or after ``since``, and the records among them without a direct link."""
    fresh = records.filter(F.col("revision_date") >= since)
    return fresh.filter(F.col("url").isNotNull()), fresh.filter(F.col("url").isNull())


def _poll_start(spark: SparkSession, watermark_path: str, started: datetime, start: str | None) -> datetime:
    stored = read_watermark(spark, watermark_path)
    mark = stored.astimezone(timezone.utc) if stored else initial_watermark(started, start)
    return mark - OVERLAP


def poll(
    spark: SparkSession,
    records: DataFrame,
    watermark_path: str,
    send: Callable[[DataFrame], None],
    now: datetime | None = None,
    start: str | None = None,
) -> datetime:
    """Send what is new and then move the watermark to the start of this poll; returns ``since``.

    If sending fails the watermark stays, and the next poll covers the same records again.
    """
    started = now or datetime.now(timezone.utc)
    since = _poll_start(spark, watermark_path, started, start)
    urls, _ = poll_increment(records, F.lit(since))
    send(urls)
    write_watermark(spark, watermark_path, started)
    return since


def poll_landed(
    spark: SparkSession,
    pages: str,
    progress: str,
    watermark_path: str,
    send: Callable[[DataFrame, int], None],
    now: datetime | None = None,
    start: str | None = None,
    files_per_batch: int = 1000,
) -> datetime:
    """``poll`` over day folders of landed pages as a file stream: every page file is read once, whole days before ``since`` never.

    Runs until what has landed is sent and then moves the watermark. ``send(urls, batch_id)`` is called per micro-batch. If it fails
    the watermark stays, and the next poll repeats that batch under the same number and goes on behind it; batches sent before are
    not sent again.
    """
    started = now or datetime.now(timezone.utc)
    since = _poll_start(spark, watermark_path, started, start)
    landed = flatten_records(read_catalogue_days(spark, pages, since, files_per_batch))
    urls, _ = poll_increment(landed, F.lit(since))
    stream = urls.writeStream.foreachBatch(send).option("checkpointLocation", progress).trigger(availableNow=True).start()
    stream.awaitTermination()
    write_watermark(spark, watermark_path, started)
    return since
