"""A corpus pipeline: each stage's rows are written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dossier.llm.line_dedup import dedup_lines
from dossier.llm.minhash import keep_one
from dossier.llm.packing import pack
from dossier.llm.quality_classifier import fit, keep_good
from dossier.llm.quality_rules import keep_regular
from dossier.llm.shared import cut, quoted, table, workers_see_us


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine predicts to be of quality."""
    workers_see_us(spark)
    model = fit(docs, table(spark, sf_dir, "labels"))
    return keep_good(docs, model, 0.3)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    workers_see_us(spark)
    return keep_regular(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents or more hold; none are dropped."""
    workers_see_us(spark)
    return dedup_lines(docs, 10).select(*map(quoted, docs.columns))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word near-duplicates at 0.8."""
    workers_see_us(spark)
    return keep_one(docs, 5, 80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that stayed and their places in sequences of 2048."""
    import public_tokenizers

    workers_see_us(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("minhash near-dedup", minhash_dedup),
    ("best-fit packing", packing),
]

#: Learned models and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
