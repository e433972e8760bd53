"""Snapshots of HTTP responses as a Spark data source over content-addressed files (SRC-06, SRC-25).

``<folder>/urls/<hh>/<sha256 of the URL>.json`` says what a request met; ``<folder>/bodies/<hh>/<sha256 of the bytes>`` holds
the bytes, once for all URLs that share them; ``<folder>/snapshot.json`` has the times that count where a response has none.
A file comes into being by a link of a finished one, so the first write of a URL wins and a repeated task changes nothing.

Reading: a partition is a hash prefix. Filters ``url = x`` and ``url in (...)`` are pushed down: then only those files are
opened, and a URL without one gives a row with status 0 and a note, as a failed request does. Without such a filter all
recorded responses are read. Bytes are hashed again: where they differ from their name the row says so and has no body.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage

from dossier.work import workers_see_us

COLUMNS = ("url", "status", "elapsed_ms", "bytes_received", "body", "error", "content_sha256", "retrieved_at", "effective_at")
SCHEMA = "url string, status int, elapsed_ms int, bytes_received long, body string, error string, content_sha256 string, retrieved_at string, effective_at string"
#: Fixed value: what a request says that the snapshot does not know.
MISSING = "snapshot response missing"
PREFIX = 2


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def raw_bytes(raw_json: str | None, body: str | None) -> bytes:
    """The recorded text as it is, else the JSON of ``body`` with sorted keys and no spaces; no body is JSON's null."""
    if raw_json is not None:
        return raw_json.encode()
    value = None if body is None else json.loads(body)
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True).encode()


def put(path: str, data: bytes) -> bool:
    """Make the file whole if it is not there; whether this call made it."""
    if os.path.exists(path):
        return False
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.write(data)
    try:
        os.link(own, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(own)


class Folder:
    """Paths and rows of one snapshot."""

    def __init__(self, root: str):
        self.root = root.removeprefix("file://")

    def _path(self, kind: str, digest: str, ending: str = "") -> str:
        return os.path.join(self.root, kind, digest[:PREFIX], digest + ending)

    def times(self) -> dict:
        try:
            with open(os.path.join(self.root, "snapshot.json"), encoding="utf-8") as f:
                return json.load(f)
        except FileNotFoundError:
            return {}

    def prefixes(self) -> list[str]:
        folder = os.path.join(self.root, "urls")
        return sorted(os.listdir(folder)) if os.path.isdir(folder) else []

    def add(self, row) -> bool:
        """Record a response; whether its URL was new."""
        path = self._path("urls", _digest(row["url"].encode()), ".json")
        if os.path.exists(path):
            return False
        raw = raw_bytes(row["raw_json"], row["body"])
        digest = _digest(raw)
        put(self._path("bodies", digest), raw)
        said = {"url": row["url"], "status": 200 if row["status"] is None else row["status"], "elapsed_ms": row["elapsed_ms"] or 0, "content_sha256": digest, "retrieved_at": row["retrieved_at"], "effective_at": row["effective_at"]}
        return put(path, json.dumps(said, ensure_ascii=False).encode())

    def row(self, url: str, times: dict) -> tuple:
        return self._row(self._path("urls", _digest(url.encode()), ".json"), times, url)

    def rows(self, prefix: str, times: dict) -> Iterator[tuple]:
        folder = os.path.join(self.root, "urls", prefix)
        for name in sorted(os.listdir(folder)):
            if name.endswith(".json"):
                yield self._row(os.path.join(folder, name), times)

    def _row(self, path: str, times: dict, url: str | None = None) -> tuple:
        try:
            with open(path, encoding="utf-8") as f:
                said = json.load(f)
        except FileNotFoundError:
            return url, 0, 0, 0, None, MISSING, None, times.get("retrieved_at"), times.get("effective_at")
        with open(self._path("bodies", said["content_sha256"]), "rb") as f:
            raw = f.read()
        status, digest = said["status"], _digest(raw)
        error = None if status == 200 else f"HTTP {status}"
        if digest != said["content_sha256"]:
            error = "content differs from its hash"
        when = [said.get(k) or times.get(k) for k in ("retrieved_at", "effective_at")]
        return said["url"], status, said["elapsed_ms"], len(raw), None if error else raw.decode("utf-8", "replace"), error, digest, *when


@dataclass
class Prefix(InputPartition):
    """Responses whose URL hash begins so; ``urls`` where only these are asked for."""

    prefix: str
    urls: tuple[str, ...] | None = None


class _Reader(DataSourceReader):
    def __init__(self, root: str):
        self.folder, self.urls = Folder(root), None

    def pushFilters(self, filters):
        for one in filters:
            wanted = {one.value} if isinstance(one, EqualTo) else set(one.value) if isinstance(one, In) else None
            if wanted is None or one.attribute != ("url",):
                yield one
            else:
                self.urls = wanted if self.urls is None else self.urls & wanted

    def partitions(self):
        if self.urls is None:
            return [Prefix(p) for p in self.folder.prefixes()]
        dealt: dict[str, list[str]] = {}
        for url in sorted(u for u in self.urls if u is not None):
            dealt.setdefault(_digest(url.encode())[:PREFIX], []).append(url)
        return [Prefix(p, tuple(urls)) for p, urls in sorted(dealt.items())]

    def read(self, partition):
        if partition is None:
            return
        times = self.folder.times()
        if partition.urls is None:
            yield from self.folder.rows(partition.prefix, times)
        else:
            for url in partition.urls:
                yield self.folder.row(url, times)


@dataclass
class Written(WriterCommitMessage):
    added: int
    known: int


class _Writer(DataSourceWriter):
    def __init__(self, root: str):
        self.folder = Folder(root)

    def write(self, iterator):
        added = known = 0
        for row in iterator:
            if self.folder.add(row):
                added += 1
            else:
                known += 1
        return Written(added, known)

    def commit(self, messages):
        """Files are in place already; nothing is left to do."""

    def abort(self, messages):
        """Responses that were written stay: they are whole, and a repeated job finds them."""


class SnapshotSource(DataSource):
    """``spark.read.format("snapshot").load(folder)`` and ``df.write.format("snapshot").mode("append").save(folder)``."""

    @classmethod
    def name(cls):
        return "snapshot"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a snapshot is only added to; the first write of a URL wins")
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let filters reach it."""
    workers_see_us(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SnapshotSource)


def save(responses: DataFrame, folder: str, order: str, retrieved_at: str | None = None, effective_at: str | None = None) -> None:
    """Record ``responses(url, status, elapsed_ms, raw_json, body, retrieved_at, effective_at)``: of a URL the first by ``order``,
    unless the folder knows it. The snapshot's own times are those of its first save."""
    register(responses.sparkSession)
    put(os.path.join(Folder(folder).root, "snapshot.json"), json.dumps({"retrieved_at": retrieved_at, "effective_at": effective_at}).encode())
    names = ["status", "elapsed_ms", "raw_json", "body", "retrieved_at", "effective_at"]
    first = responses.where("url is not null").groupBy("url").agg(F.min_by(F.struct(*names), order).alias("r")).select("url", "r.*")
    first.write.format("snapshot").mode("append").save(folder)


def load(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    return spark.read.format("snapshot").load(folder)


def replay(requests: DataFrame, folder: str) -> DataFrame:
    """``requests`` with what the snapshot says to their ``url``; where it does not know it: status 0, a note, its own times."""
    spark = requests.sparkSession
    times = Folder(folder).times()
    held = requests.join(load(spark, folder), "url", "left")
    known = F.col("status").isNotNull()
    filled = {c: F.when(known, F.col(c)).otherwise(F.lit(0)) for c in ("status", "elapsed_ms", "bytes_received")}
    filled |= {"error": F.when(known, F.col("error")).otherwise(F.lit(MISSING))}
    filled |= {c: F.when(known, F.col(c)).otherwise(F.lit(times.get(c))) for c in ("retrieved_at", "effective_at")}
    return held.withColumns(filled)
