"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import gc
import itertools
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ADAPTIVE, PARTITIONS = "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Fixed by the contracts: ``[\x20\x09-\x0D]``.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def base_uri(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, which driver and executors share.

    Where it is unset, a local session (tests) gets a temporary folder; a cluster raises ValueError, as a folder of one
    machine would not do.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="dossier-work-")
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_uri(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{base_uri(spark)}/dossier/{name}-{uuid.uuid4().hex}"


_CUTS = itertools.count(1)
#: Cuts after which the driver collects garbage.
COLLECT_EACH = 10


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: no lineage, survives lost executors.

    Executors keep the shuffle files of a plan until the driver collects it as garbage. In rounds of small plans that is seldom
    by itself, so it is asked to every ``COLLECT_EACH`` cuts.
    """
    spark = df.sparkSession
    uri = new_uri(spark, name)
    df.write.parquet(uri)
    if next(_CUTS) % COLLECT_EACH == 0:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(uri)


@contextmanager
def planned_once(spark: SparkSession, rows: int | None = None, rows_each: int = 20_000) -> Iterator[None]:
    """Plans that run inside are fixed before they start. For rounds over tables that are small or dealt evenly: planning anew at
    every exchange gains nothing there, and starts a thread of the driver for each, which stays for a minute.

    Where the number of ``rows`` is known, exchanges have a partition for every ``rows_each`` of them, at most the session's.
    """
    before = {key: spark.conf.get(key) for key in (ADAPTIVE, PARTITIONS)}
    spark.conf.set(ADAPTIVE, "false")
    if rows is not None:
        spark.conf.set(PARTITIONS, str(max(1, min(int(before[PARTITIONS]), -(-rows // rows_each)))))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


GUESSED = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@contextmanager
def counted_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Joins that run inside broadcast what is marked so, and nothing else. Spark judges by the size of files, which says little
    of the rows: packed ids are a tenth of what they take in the driver, and rows that are spread over chunks are not seen."""
    before = {key: spark.conf.get(key, None) for key in GUESSED}
    for key in GUESSED:
        spark.conf.set(key, "-1")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def mounted(uri: str) -> str:
    """The file-system path of a shared folder; executors map model files from it.

    Raises ValueError for schemes that are not mounted as files.
    """
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{uri}: model files need spark.checkpoint.dir on a mounted shared file system")
    return parts.path if parts.scheme else uri


def replace_file(path: str, data: bytes) -> None:
    """Write whole or not at all, so that a repeated task leaves the same file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.write(data)
    os.replace(own, path)


def workers_see_us(spark: SparkSession) -> None:
    """Let Python workers import this package where it was not installed, and bound Arrow batches by rows and bytes.

    These are settings of the session; a session that has its own bound on bytes keeps it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, environment.get("PYTHONPATH", "")) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    if not spark.conf.get(BATCH_BYTES, None):
        spark.conf.set(BATCH_BYTES, str(3 << 20))


_MEMORIES: dict = {}


def sole_memory(name: str, forget=lambda: None) -> None:
    """In a Python worker that operators use in turn: only the one at work keeps what it remembers; ``forget`` drops it."""
    for other, drop in _MEMORIES.items():
        if other != name:
            drop()
    _MEMORIES[name] = forget
    give_back()


def give_back() -> None:
    """Return what Arrow and the C library hold free to the system, at a task's start and end: workers stay when they idle."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_see_us(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z only; ``lower`` serves where the whole string is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def broadcast_if_few(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` broadcast where they are counted to be at most ``most``, else marked to be shuffled, however small their files."""
    return F.broadcast(rows) if rows.count() <= most else rows.hint("merge")


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(columns: list[str], *names: str) -> list[str]:
    """``names`` with underscores added until no column of ``columns`` has them."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def row_key(docs: DataFrame) -> tuple[Column, Column]:
    """128 bits of (doc_id, text): rows that are equal in both share every decision."""
    doc_id, text = F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(doc_id, text), F.xxhash64(F.lit(7), doc_id, text)
