"""Queue messages: poller notices, object notifications, and either inside an envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def message_url(body: Column | str) -> Column:
    """The granule url a message carries, or null."""
    body = F.col(body) if isinstance(body, str) else body
    inner = F.coalesce(F.get_json_object(body, "$.Message"), body)
    bucket = F.get_json_object(inner, "$.Records[0].s3.bucket.name")
    key = F.get_json_object(inner, "$.Records[0].s3.object.key")
    from_object = F.when(
        (bucket != "") & (key != ""), F.concat(F.lit("s3://"), bucket, F.lit("/"), key)
    )
    return F.coalesce(F.get_json_object(inner, "$.url"), from_object)


def message_is_json(body: Column | str) -> Column:
    """False for a body that is no JSON document: such a record fails instead of being skipped."""
    body = F.col(body) if isinstance(body, str) else body
    inner = F.coalesce(F.get_json_object(body, "$.Message"), body)
    return F.get_json_object(inner, "$").isNotNull()


def read_messages(messages: DataFrame) -> DataFrame:
    """Add ``url`` (null: none), ``sort_url`` ("" when unreadable) and ``state`` (ok / skipped / unreadable)."""
    url = F.nullif(message_url("body"), F.lit(""))
    return (
        messages.withColumn("url", url)
        .withColumn("sort_url", F.coalesce("url", F.lit("")))
        .withColumn(
            "state",
            F.when(F.col("url").isNotNull(), "ok")
            .when(message_is_json("body"), "skipped")
            .otherwise("unreadable"),
        )
    )
