"""Findings are rows (check, subject, detail, severity); none means valid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class InvalidData(Exception):
    """A check found errors; the message lists the first of them."""


def as_findings(
    rows: DataFrame, check: str, subject: Column, detail: Column, severity: str | Column = "error"
) -> DataFrame:
    return rows.select(
        F.lit(check).alias("check"),
        subject.cast("string").alias("subject"),
        detail.cast("string").alias("detail"),
        F.lit(severity).alias("severity"),
    )


def all_findings(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def literal_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A few configured rows as a DataFrame."""
    return spark.createDataFrame(rows, schema)


def require_valid(findings: DataFrame, what: str, show: int = 20) -> None:
    """Raise when there is an error among the findings; all of them stay readable as rows."""
    errors = findings.filter(F.col("severity") == "error").limit(show).collect()
    if errors:
        lines = "\n".join(f"  [{e.check}] {e.subject}: {e.detail}" for e in errors)
        raise InvalidData(f"{what} is not valid:\n{lines}")
