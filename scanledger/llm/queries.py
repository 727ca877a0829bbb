"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from scanledger.llm import decontaminate, language_id, line_dedup, merkle, near_dedup, packing, pii, quality, spelling, token_counts, toxicity, url_filter, warc
from scanledger.llm.common import table

QUERIES = {
    "op1_language_id": lambda spark, sf_dir: language_id.query(table(spark, sf_dir, "documents")),
    "op2_warc": lambda spark, sf_dir: warc.query(table(spark, sf_dir, "pages")),
    "op3_line_dedup": lambda spark, sf_dir: line_dedup.query(table(spark, sf_dir, "documents")),
    "op4_token_counts": lambda spark, sf_dir: token_counts.query(table(spark, sf_dir, "documents")),
    "op5_url_filter": lambda spark, sf_dir: url_filter.query(table(spark, sf_dir, "pages")),
    "op6_quality_rules": lambda spark, sf_dir: quality.query(table(spark, sf_dir, "documents")),
    "op7_toxicity": lambda spark, sf_dir: toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op8_best_fit_packing": lambda spark, sf_dir: packing.query(table(spark, sf_dir, "documents")),
    "op9_benchmark_decontamination": lambda spark, sf_dir: decontaminate.query(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ),
    "op10_minhash_near_dedup": lambda spark, sf_dir: near_dedup.query(table(spark, sf_dir, "documents")),
    "op11_pii": lambda spark, sf_dir: pii.query(table(spark, sf_dir, "documents")),
    "op12_spelling_variants": lambda spark, sf_dir: spelling.query(table(spark, sf_dir, "documents")),
    "op13_merkle_manifest": lambda spark, sf_dir: merkle.query(table(spark, sf_dir, "documents")),
}
ORACLES = {
    "op2_warc": warc.ORACLE,
    "op3_line_dedup": line_dedup.ORACLE,
    "op6_quality_rules": quality.ORACLE,
    "op9_benchmark_decontamination": decontaminate.ORACLE,
    "op11_pii": pii.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
