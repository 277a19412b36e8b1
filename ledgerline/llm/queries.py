"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import oracle
from ledgerline.llm.best_fit_packing import op8_best_fit_packing
from ledgerline.llm.byte_bpe import op2_byte_bpe
from ledgerline.llm.fingerprints import op3_fingerprints
from ledgerline.llm.jaccard_join import op4_jaccard_join
from ledgerline.llm.language_id import op5_language_id
from ledgerline.llm.license_scan import op6_license_scan
from ledgerline.llm.periodic_runs import op11_periodic_runs
from ledgerline.llm.quality_classifier import op10_quality_classifier
from ledgerline.llm.quality_rules import op1_quality_rules
from ledgerline.llm.substring_dedup import op7_substring_dedup
from ledgerline.llm.toxicity import op9_toxicity
from ledgerline.llm.va_clustering import op13_va_clustering
from ledgerline.llm.word_table_bpe import op12_word_table_bpe

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_byte_bpe, op3_fingerprints, op4_jaccard_join, op5_language_id, op6_license_scan,
                            op7_substring_dedup, op8_best_fit_packing, op9_toxicity, op10_quality_classifier, op11_periodic_runs, op12_word_table_bpe,
                            op13_va_clustering)
}


def on_workers(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Workers started by this session find the package where the driver has it (a cluster gets it by --py-files)."""
    def with_path(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *[p for p in paths if p]])
        return run(spark, sf_dir)

    with_path.__name__ = run.__name__
    return with_path


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: on_workers(f) for name, f in OPERATORS.items()}


def all_sql() -> dict[str, str]:
    return oracle.all_sql()
