"""Helpers on whole frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``frame`` with more columns, each computed once a row: a generator stands between them and what refers to them, so the
    optimiser does not write a long expression anew at every place where its column is used."""
    return frame.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt by ``keys`` over as many tasks as the session shuffles into, at least one a core. For what costs much more
    time a row than bytes: files of a few MB are one task, and adaptive plans merge small exchanges by bytes, but not this one."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)
