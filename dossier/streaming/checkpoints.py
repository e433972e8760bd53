"""Results of a running batch on disk, and what a finished crawl leaves open (SNK-02, STM-01, STM-03).

A micro-batch writes the folder of its number anew, so a repeated one changes nothing; a folder counts when its marker is
there. Every ``every`` batches the state so far is written as one folder, in request order, and older ones are not read again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dossier.operators.crawl import missing_seeds

KEY = "organisation_number"


def _files(spark: SparkSession, path: str):
    of = spark._jvm.org.apache.hadoop.fs.Path(path)
    return of.getFileSystem(spark._jsc.hadoopConfiguration()), of


def versions(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """The last whole state (-1: none) and the finished batches after it."""
    fs, of = _files(spark, path)
    if not fs.exists(of):
        return -1, []
    found: dict[str, list[int]] = {"state": [], "batch": []}
    for entry in fs.listStatus(of):
        named = re.fullmatch(r"(state|batch)=(\d+)", entry.getPath().getName())
        if named and fs.exists(_files(spark, f"{path}/{entry.getPath().getName()}/_SUCCESS")[1]):
            found[named[1]].append(int(named[2]))
    last = max(found["state"], default=-1)
    return last, sorted(n for n in found["batch"] if n > last)


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of the finished batches: of a company the row of the latest batch, in request order."""
    last, after = versions(spark, path)
    folders = [(last, f"{path}/state={last}")] if last >= 0 else []
    folders += [(n, f"{path}/batch={n}") for n in after]
    rows = spark.createDataFrame([], schema).withColumn("_v", F.lit(0))
    for n, folder in folders:
        rows = rows.unionByName(spark.read.schema(schema).parquet(folder).withColumn("_v", F.lit(n)))
    nth = F.row_number().over(Window.partitionBy(KEY).orderBy(F.col("_v").desc(), "seq"))
    return rows.withColumn("_n", nth).where("_n = 1").drop("_n", "_v").orderBy("seq")


def write_batch(rows: DataFrame, number: int, path: str, every: int = 10) -> None:
    """What a micro-batch does; ``rows`` have organisation_number and seq, the place in the request."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
    if number % every == every - 1:
        read(rows.sparkSession, path, rows.schema).write.mode("overwrite").parquet(f"{path}/state={number}")


def start(results: DataFrame, path: str, checkpoint: str, every: int = 10) -> StreamingQuery:
    """Take what is there and stop; a later start goes on behind the last finished batch."""
    return results.writeStream.foreachBatch(lambda rows, number: write_batch(rows, number, path, every)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def terminal_events(seeds: DataFrame, events: DataFrame, finished: bool, retrieved_at: str) -> DataFrame:
    """An event for every seed that a finished crawl has none of; none while the crawl may still bring them."""
    own = missing_seeds(seeds, events)
    made = own.select(KEY, F.lit("homepage").alias("page_kind"), F.col("website").alias("final_url"), F.lit(None).cast("string").alias("content_sha256"), F.lit("source_error").alias("status"), F.lit(retrieved_at).alias("retrieved_at"))
    return made if finished else made.limit(0)
