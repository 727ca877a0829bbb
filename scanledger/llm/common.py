"""What the operators of this subpackage share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.session import ensure_checkpoint_dir

REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and every executor can reach."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder: lineage ends here."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def with_python(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; a cluster gets it with ``--py-files`` or an installation."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if REPOSITORY not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, REPOSITORY) if x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
