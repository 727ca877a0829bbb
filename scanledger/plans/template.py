"""Deriving a collection's template and grid from reference granules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanledger.config import CollectionConfig
from scanledger.operators.findings import all_findings, as_findings
from scanledger.operators.template import build_template, flat_granules, varying_attributes
from scanledger.operators.validate import validate_granules


def derive_template(
    headers: dict[str, DataFrame], reference_url: str, config: CollectionConfig
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Template and reference grid of ``reference_url``, and what the other granules disagree on.

    ``headers`` holds vars, nodes and axes of all reference granules. Attributes that vary without
    being declared volatile are named once, besides the findings of every granule.
    """
    template = build_template(headers["vars"], headers["nodes"], reference_url, config)
    reference = headers["axes"].filter(F.col("url") == reference_url).select("axis", "values")
    coordinates = reference.select("axis", F.posexplode("values").alias("idx", "value"))
    _, shape_findings = flat_granules(headers["vars"], config)
    varying = varying_attributes(headers["nodes"], config.volatile_attributes)
    findings = all_findings(
        validate_granules(template, headers["nodes"], reference, headers["axes"], config.volatile_attributes),
        shape_findings,
        as_findings(
            varying, "varying_attributes", F.concat_ws(" ", "path", "key"),
            F.concat(F.col("n_values").cast("string"), F.lit(" values among the granules")),
        ),
    )
    return template, coordinates, findings
