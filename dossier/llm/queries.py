"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: query name -> (module, name of its SQL or None)
_TABLE = {
    "op1_line_dedup": ("line_dedup", "OP1_SQL"),
    "op2_ngram_lm": ("ngram_lm", None),
    "op3_quality_rules": ("quality_rules", None),
    "op4_license_scan": ("license_scan", "OP4_SQL"),
    "op5_byte_bpe": ("byte_bpe", None),
    "op6_best_fit_packing": ("packing", None),
    "op7_quality_classifier": ("quality_classifier", None),
    "op8_warc": ("warc", "OP8_SQL"),
    "op9_embedding_dedup": ("embedding_dedup", None),
    "op10_minhash": ("minhash", None),
    "op11_source_divergence": ("source_divergence", "OP11_SQL"),
    "op12_embedding_whitening": ("whitening", None),
    "op13_exact_dedup": ("exact_dedup", "OP13_SQL"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"dossier.llm.{module}"), name) for name, (module, _) in _TABLE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(import_module(f"dossier.llm.{module}"), sql) for name, (module, sql) in _TABLE.items() if sql}
