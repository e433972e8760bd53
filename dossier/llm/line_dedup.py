"""Line dedup: levelled sorted runs of line hashes, compacted periodically.

A run is a table of (h1, h2, n): a line key's 128-bit hash and the number of documents that hold it, bucketed and sorted by
the hash, so runs and batches meet by merge joins that move nothing. A new batch is counted and merge-anti-joined with the
keys that already reached the threshold; its remaining keys are looked up in every run, those whose sum reaches the
threshold leave for a saturated run, and the others become a run of level 0. ``fanout`` runs of a level merge into one run
of the next, without the keys that saturated since.

Null or empty text: one empty line, kept. Lines whose key is empty are never dropped. Rows are documents: repeated
rows count as often as they occur, and doc_id may be of any type. Other columns pass through, but for n_lines and n_dropped;
``text`` is replaced by what stays.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.shared import WHITE, ascii_lower, new_uri, quoted, row_key, table, unused

KEY = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(text: Column) -> Column:
    """Per line struct(h1, h2) of its key; null for an empty key."""
    keys = F.transform(F.transform(split_lines(text), lambda x: F.btrim(x, F.lit(WHITE))), ascii_lower)
    pair = lambda key: F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))
    return F.transform(keys, lambda key: F.when(key != "", pair(key)))


class LineRuns:
    """Counts of line keys that grow batch by batch."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]
        self.saturated: list[DataFrame] = []

    def _run(self, rows: DataFrame) -> DataFrame:
        """Write ``rows`` by bucket, sorted. As many buckets as shuffle partitions: a bucket comes from one task."""
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", new_uri(self.spark, "line-run")).saveAsTable(name)
        run = self.spark.table(name)
        self.spark.sql(f"drop table {name}")  # the files stay, and so does the plan that reads them
        return run

    def _unsaturated(self, keys: DataFrame) -> DataFrame:
        return reduce(lambda k, s: k.join(s.hint("merge"), KEY, "left_anti"), self.saturated, keys)

    def add(self, hashed: DataFrame) -> None:
        """Count the keys of a batch, ``hashed(lines)`` being ``line_hashes`` of one document a row."""
        found = hashed.select(F.explode(F.array_distinct("lines")).alias("k")).where("k is not null").select("k.h1", "k.h2")
        counts = self._unsaturated(found.groupBy(*KEY).agg(F.count("*").alias("n")))
        total = F.col("n")
        for i, run in enumerate(r for level in self.levels for r in level):
            counts = counts.join(run.withColumnRenamed("n", f"n{i}").hint("merge"), KEY, "left")
            total = total + F.coalesce(f"n{i}", F.lit(0))
        whole = self._run(counts.select(*KEY, "n", total.alias("total")))
        self.saturated.append(whole.where(F.col("total") >= self.min_docs).select(*KEY))
        self.levels[0].append(whole.where(F.col("total") < self.min_docs).select(*KEY, "n"))
        self._compact()

    def _compact(self) -> None:
        if len(self.saturated) > 2 * self.fanout:
            merge = lambda a, b: a.join(b.hint("merge"), KEY, "full_outer")
            self.saturated = [self._run(reduce(merge, self.saturated))]
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._run(self._unsaturated(reduce(self._merge, self.levels[level]))))
            self.levels[level] = []
            level += 1

    @staticmethod
    def _merge(a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.join(b.withColumnRenamed("n", "m").hint("merge"), KEY, "full_outer")
        return both.select(*KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

    def frequent(self) -> DataFrame:
        """All keys found in ``min_docs`` documents or more, each once."""
        return reduce(DataFrame.unionAll, self.saturated)


def _at_most(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` broadcast where they are counted to be few, else as they are."""
    return F.broadcast(rows) if rows.count() <= most else rows


def dedup_lines(docs: DataFrame, min_docs: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` without the lines whose key occurs in ``min_docs`` documents or more, plus n_lines and n_dropped.

    The hashes of all lines are written once, dealt into ``batches``. One shuffle moves the places of dropped lines, one the
    texts to them.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    k1, k2 = row_key(docs)
    uri = new_uri(spark, "line-hashes")
    hashed = docs.select(k1.alias("k1"), k2.alias("k2"), line_hashes(F.col("text")).alias("lines"), F.pmod(k1, F.lit(batches)).cast("int").alias("batch"))
    hashed.write.partitionBy("batch").parquet(uri)
    hashed = spark.read.schema(hashed.schema).parquet(uri)
    runs = LineRuns(spark, min_docs, fanout)
    for i in range(batches):
        runs.add(hashed.where(F.col("batch") == i))
    places = hashed.select("k1", "k2", F.posexplode("lines").alias("at", "k")).where("k is not null").select("k1", "k2", "at", "k.h1", "k.h2")
    dropped = places.join(_at_most(runs.frequent(), 1_000_000), KEY, "left_semi")
    n1, n2, gone, parts = unused(names, "_k1", "_k2", "_gone", "_parts")
    dropped = dropped.groupBy(F.col("k1").alias(n1), F.col("k2").alias(n2)).agg(F.collect_set("at").alias(gone))
    uri = new_uri(spark, "line-dropped")
    dropped.write.parquet(uri)
    dropped = spark.read.schema(dropped.schema).parquet(uri)
    places_of = F.coalesce(F.col(gone), F.array().cast("array<int>"))
    held = docs.select(*map(quoted, names), k1.alias(n1), k2.alias(n2)).join(dropped.hint("merge"), [n1, n2], "left")
    held = held.withColumns({parts: split_lines(F.col("text")), gone: places_of})
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))  # in time linear in the lines
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col(parts), i)), "\n")
    text = F.when(F.size(gone) == 0, F.coalesce("text", F.lit(""))).otherwise(kept)
    return held.select(*(text.alias(c) if c == "text" else quoted(c) for c in names), F.size(parts).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), 10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = r"""
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
lines as (select doc_id, unnest(parts) as line, unnest(range(1, len(parts) + 1)) as pos from split),
keyed as (select doc_id, pos, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
common as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, cast(count(*) as bigint) as n_lines,
    cast(count(*) filter (where key in (select key from common)) as bigint) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where key not in (select key from common)), '')) as kept_sha256
from keyed group by doc_id
"""
