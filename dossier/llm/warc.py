"""WARC: captures written as request, response or revisit, and metadata records, and assembled again.

Writing: every page becomes three gzip members of an archive; the request and the metadata name their response by
WARC-Concurrent-To. Of pages with equal payloads of ``min_revisit`` bytes or more the smallest page_id is the response,
others revisit it by digest and id. An archive is named by the attempt that writes it and put in place whole; the table of
archives lists those of the attempts that were committed, so what a lost or repeated attempt leaves is not read.

Reading: archives are parsed record by record; request and metadata join their response on the identifier, and one
nested row per capture comes out, with null for a record that is missing.

Null html: an empty payload. Null url: an empty target. A null page_id is written as such and never the response of
others. Rows that repeat in page_id and payload are all responses. Other columns are not archived.
"""

from __future__ import annotations

import hashlib
import os
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.shared import cut, mounted, new_uri, replace_file, table

_DATE = "2024-01-01T00:00:00Z"


def _record(kind: str, own: str, fields: dict[str, str], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{own}>", "WARC-Date": _DATE, **fields, "Content-Length": str(len(block))}
    whole = ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    return squeeze.compress(whole) + squeeze.flush()


def _name(*parts) -> str:
    h = hashlib.md5("\0".join(map(str, parts)).encode(), usedforsecurity=False).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def _one_line(text: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in text)


def capture(page_id, url: str, payload: bytes, digest: str, refers_to, own: str) -> list[bytes]:
    """The three records of a page."""
    target, response = _one_line(url), _name(own, "response")
    concurrent = {"WARC-Target-URI": target, "WARC-Concurrent-To": f"<urn:uuid:{response}>"}
    request = _record("request", _name(own, "request"), concurrent | {"Content-Type": "application/http; msgtype=request"}, f"GET {target} HTTP/1.1\r\n\r\n".encode())
    fields = {"WARC-Target-URI": target, "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha256:{digest}"}
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        main = _record("response", response, fields, block + payload)
    else:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:page:{refers_to}>"}
        main = _record("revisit", response, fields, block)
    notes = f"page-id: {'' if page_id is None else page_id}\r\npayload-bytes: {len(payload)}\r\n".encode()
    return [request, main, _record("metadata", _name(own, "metadata"), concurrent | {"Content-Type": "application/warc-fields"}, notes)]


def revisits(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """(page_id, digest, refers_to) of pages whose payload an earlier page has; only digests are shuffled."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.where("page_id is not null").where(F.octet_length(body) >= min_revisit).select("page_id", F.sha2(body, 256).alias("digest"))
    first = own.groupBy("digest").agg(F.min("page_id").alias("refers_to"))
    return own.join(first, "digest").where("page_id > refers_to").select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to").distinct()


def write_archives(pages: DataFrame, uri: str, min_revisit: int = 100, roll_bytes: int = 64 << 20) -> DataFrame:
    """Write ``pages(page_id, url, html)`` under ``uri``; a table of (path, records, bytes) says what is there."""
    folder = mounted(uri)
    body = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), body.alias("html"), F.sha2(body.cast("binary"), 256).alias("digest"))
    again = cut(revisits(pages, min_revisit), "warc-revisits")
    held = own.join(again, (F.col("page_id") == F.col("_page")) & (F.col("digest") == F.col("_digest")), "left").select(*own.columns, "refers_to")

    def write(batches):
        from pyspark import TaskContext

        part, attempt, n, out = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, bytearray()
        done = []

        def roll():
            nonlocal out
            path = os.path.join(folder, f"part-{part:06d}-{attempt}-{len(done):04d}.warc.gz")
            replace_file(path, bytes(out))
            done.append((path, n, len(out)))
            out = bytearray()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
            payloads = batch.column("html").cast(pa.binary()).to_pylist()
            for page_id, url, digest, refers_to, payload in zip(*columns, payloads):
                out += b"".join(capture(page_id, url, payload, digest, refers_to, f"{part}/{n}"))
                n += 1
                if len(out) >= roll_bytes:
                    roll()
        if out:
            roll()
        yield pa.RecordBatch.from_pydict({"path": [d[0] for d in done], "records": pa.array([d[1] for d in done], pa.int64()), "bytes": pa.array([d[2] for d in done], pa.int64())})

    return cut(held.mapInArrow(write, "path string, records long, bytes long"), "warc-archives")


def records(path: str):
    """(header fields, block) of every record of an archive, one gzip member at a time."""
    with open(path, "rb") as archive:
        rest = b""
        while True:
            member, whole = zlib.decompressobj(31), []
            while not member.eof:
                rest = rest or archive.read(1 << 20)
                if not rest:
                    break
                whole.append(member.decompress(rest))
                rest = member.unused_data
            if not whole:
                return
            head, _, block = b"".join(whole).partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield fields, block[: int(fields["Content-Length"])]


_RECORD = "record_id string, type string, concurrent_to string, target string, digest string, refers_to long, page_id long, payload_bytes long, payload binary"


def read_records(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record. Digests and lengths of responses come from the payload that was read."""
    bare = lambda x: x[len("<urn:uuid:") : -1] if x else None

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for f, block in records(path):
                    kind, payload, digest, size, page = f["WARC-Type"], None, None, None, None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
                        if f["WARC-Payload-Digest"] != f"sha256:{digest}":
                            raise ValueError(f"{path}: digest of {f['WARC-Record-ID']}")
                    elif kind == "revisit":
                        digest = f["WARC-Payload-Digest"].removeprefix("sha256:")
                    elif kind == "metadata":
                        notes = dict(x.split(": ", 1) for x in block.decode().strip().split("\r\n"))
                        page, size = (int(notes["page-id"]) if notes.get("page-id") else None), int(notes["payload-bytes"])
                    refers = f.get("WARC-Refers-To")
                    rows.append((bare(f["WARC-Record-ID"]), kind, bare(f.get("WARC-Concurrent-To")), f.get("WARC-Target-URI"), digest, int(refers[len("<urn:page:") : -1]) if refers else None, page, size, payload if with_payload else None))
                    if len(rows) == 1000:
                        yield _as_batch(rows)
                        rows = []
                yield _as_batch(rows)

    return archives.select("path").repartition(max(8, archives.sparkSession.sparkContext.defaultParallelism), "path").mapInArrow(read, _RECORD)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64()] * 3 + [pa.binary()]
    columns = list(zip(*rows)) or [()] * 9
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in _RECORD.split(", ")])


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: page_id, target, request, response, metadata."""
    found = found.withColumn("capture", F.coalesce("concurrent_to", "record_id"))
    main = found.where(F.col("type").isin("response", "revisit")).select("capture", "target", F.struct("record_id", "type", "digest", "refers_to", "payload_bytes", "payload").alias("response"))
    request = found.where("type = 'request'").select("capture", F.struct("record_id", "target").alias("request"))
    notes = found.where("type = 'metadata'").select("capture", "page_id", F.struct("record_id", "page_id", "payload_bytes").alias("metadata"))
    return main.join(request, "capture", "full").join(notes, "capture", "full").select("page_id", "target", "request", "response", "metadata")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = new_uri(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages"), uri)
    found = assemble(cut(read_records(archives), "warc-records"))
    return found.select(
        "page_id",
        F.coalesce("response.payload_bytes", "metadata.payload_bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("refers_to"),
    )


OP8_SQL = """
with p as (select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as d from pages),
q as (select *, case when n >= 100 then min(page_id) over (partition by d) end as first_id from p)
select page_id, cast(n as bigint) as payload_bytes, d as payload_digest,
    case when page_id > first_id then 'revisit' else 'response' end as record_type,
    case when page_id > first_id then first_id end as refers_to
from q
"""
