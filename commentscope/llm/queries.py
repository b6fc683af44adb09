"""The queries of this subpackage and, where SQL can say the same, their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate,
    gated_lm,
    jaccard,
    language,
    line_templates,
    packing,
    periodic,
    pii,
    quality,
    secrets,
    spelling,
    suffix_dedup,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]


def with_package(query: Query) -> Query:
    """`query`, whose Python workers find this package beside the driver's copy, wherever the
    driver was started. On a cluster without that folder, ship the package with --py-files."""
    root = str(Path(__file__).resolve().parents[2])

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
        return query(spark, sf_dir)

    return run


_QUERIES = {
    "op1_url_filters": url_filter.op1_url_filters,
    "op2_packing": packing.op2_packing,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_ngram_jaccard_join": jaccard.op4_ngram_jaccard_join,
    "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
    "op6_language_id": language.op6_language_id,
    "op7_secret_scans": secrets.op7_secret_scans,
    "op8_suffix_array_dedup": suffix_dedup.op8_suffix_array_dedup,
    "op9_line_dedup": line_templates.op9_line_dedup,
    "op10_pii": pii.op10_pii,
    "op11_lm_scoring": gated_lm.op11_lm_scoring,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}

QUERIES: dict[str, Query] = {name: with_package(query) for name, query in _QUERIES.items()}

ORACLES = {
    "op1_url_filters": url_filter.SQL,
    "op3_quality_rules": quality.SQL,
    "op9_line_dedup": line_templates.SQL,
}
