"""MinHash near-dedup with b-bit signatures.

A text's set holds its distinct word shingles. Rows of equal word sequences (128 bits of SHA-256) form a class, named by its
least doc_id; only classes are compared. ``BANDS`` bands of ``ROWS`` minima give candidates (a pair at the threshold shares
no band with probability (1 - 0.8**4)**32 = 5e-8), the low two bits of all minima, packed, an estimate corrected for chance
collisions, and the full sets the decision.

Inside a bucket no pairs are spread: its members are compared with one pivot, and what is linked is joined. What is left is
to compare members of different components. Classes whose estimates with a pivot passed make up crowds; a crowd with more
than one component is compared chunk by chunk inside tasks, where estimates choose the pairs and incidence matrices of the
exact shingles count what they share, and only links come out. Pairs of a bucket in different crowds are joined, with the
estimate inside the join. Buckets and crowds are dealt into chunks, so a frequent band or a large group of copies is spread
over tasks, and no link between components is lost.

Null or empty text: no shingles, linked with nothing. Fewer words than ``width``: the whole sequence is one shingle. A
null doc_id has no component and is kept. Rows are linked by their own texts, also where they repeat a doc_id; of any type.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.components import components
from dossier.llm.shared import broadcast_if_few, counted_broadcasts, cut, give_back, quoted, row_key, sole_memory, table, unused

BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
#: Least matches of 2-bit minima, of 128, for a pair to be verified: at similarity 0.8 they are 108.8 +- 4.0, six deviations above.
LEAST_MATCHES = 85
_MIX = np.uint64(0x9E3779B97F4A7C15)
_draw = np.random.default_rng(20)
_FACTORS = _draw.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _draw.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_words(text: str) -> list[bytes]:
    return text.encode().lower().split()  # bytes: A-Z and [\x20\x09-\x0D] only


def shingle_set(text: str, width: int) -> set[tuple[bytes, ...]]:
    """The exact set, for verification."""
    words = shingle_words(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width))))


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    import xxhash

    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(words))
    if not span:
        return h
    out = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        out = _mixed(out * _MIX + h[i : len(words) - span + 1 + i])
    return np.unique(out)


def signature(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bands' hashes, and the packed low bits: two planes of two 64-bit words."""
    minima = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, hashes.size, 2048):
        minima = np.minimum(minima, (np.multiply.outer(_FACTORS, hashes[i : i + 2048]) >> np.uint64(32)).min(1))
    bands = _mixed((minima.reshape(BANDS, ROWS) * _BAND_FACTORS).sum(1) + np.arange(BANDS, dtype=np.uint64) * _MIX)
    planes = np.packbits(np.stack([(minima & np.uint64(1)), (minima >> np.uint64(1)) & np.uint64(1)]).astype(np.uint8), axis=1)
    return bands.view(np.int64), planes.view("<i8").ravel()


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Per row: doc_id, row key k1 and k2, n_shingles, 128 bits c1 and c2 of its word sequence, bands and bits."""

    def run(batches):
        sole_memory("minhash")
        for batch in batches:
            rows = []
            for text in pc.fill_null(batch.column("text"), "").to_pylist():
                words = shingle_words(text)
                h = shingle_hashes(words, width)
                if h.size:
                    own = np.frombuffer(hashlib.sha256(b" ".join(words)).digest(), "<i8")
                    rows.append((h.size, own[0], own[1], *signature(h)))
                else:
                    rows.append((0, None, None, None, None))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            kept = ["doc_id", "k1", "k2"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[*kept, "n_shingles", "c1", "c2", "bands", "bits"])
        give_back()

    k1, k2 = row_key(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, k1 long, k2 long, n_shingles long, c1 long, c2 long, bands array<long>, bits array<long>"
    return docs.select("doc_id", k1.alias("k1"), k2.alias("k2"), "text").mapInArrow(run, schema)


def matches(a: str, b: str) -> Column:
    """Equal 2-bit minima of two packed signatures."""
    word = lambda i: F.bit_count((F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])).bitwiseOR(F.col(f"{a}.bits")[i + 2].bitwiseXOR(F.col(f"{b}.bits")[i + 2])))
    return F.lit(MINIMA) - word(0) - word(1)


def estimate(equal: Column) -> Column:
    """Similarity from equal 2-bit minima, less the quarter that agrees by chance."""
    return (equal / MINIMA - 0.25) / 0.75


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int, remember: int = 100_000) -> DataFrame:
    """Of ``pairs(a, b)`` those whose full sets have 100 * intersection >= percent * union, as (u, v).

    A task remembers sets until they hold ``remember`` shingles.
    """
    own = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    held = pairs.join(own, "a").join(other, "b").select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("a.nid").alias("i"), F.col("b.nid").alias("j"), "text_a", "text_b")

    def run(batches):
        sets: dict = {}
        held = 0

        def of(key, text):
            nonlocal held
            found = sets.get(key)
            if found is None:
                if held >= remember:
                    sets.clear()
                    held = 0
                found = sets[key] = shingle_set(text, width)
                held += len(found)
            return found

        for batch in batches:
            keep = []
            for i, j, x, y in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "text_a", "text_b"))):
                x, y = of(i, x), of(j, y)
                both = len(x & y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    node = pairs.schema["a"].dataType.simpleString()
    return held.mapInArrow(run, f"u {node}, v {node}")


#: Rows (ids, signatures) that may be broadcast: about 10 MB. The driver holds a broadcast several times over while it is built.
FEW = 100_000


def _broadcast_if_small(rows: DataFrame, most: int | None = None) -> DataFrame:
    return broadcast_if_few(rows, FEW if most is None else most)


def _equal_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal 2-bit minima of all signatures in a with all in b."""
    a, b = a.view(np.uint64), b.view(np.uint64)  # bit counts of signed numbers are those of their absolute values
    words = [(a[:, None, i] ^ b[None, :, i]) | (a[:, None, i + 2] ^ b[None, :, i + 2]) for i in range(2)]
    return MINIMA - np.bitwise_count(words[0]).astype(np.int16) - np.bitwise_count(words[1])


def numbered_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """The exact set of every text as sorted whole numbers, equal where shingles are equal in any of ``texts``.

    Words are numbered from 1, then each shingle by the number of its beginning and its next word; a sequence of fewer
    words is filled up with 0. This takes 8 bytes a shingle instead of a tuple.
    """
    words: dict[bytes, int] = {}
    rows = [np.array([words.setdefault(w, len(words) + 1) for w in shingle_words(t)], np.int64) for t in texts]
    rows = [np.append(r, np.zeros(width - len(r), np.int64)) if 0 < len(r) < width else r for r in rows]
    spans = [max(0, len(r) - width + 1) for r in rows]
    if not any(spans):
        return [np.zeros(0, np.int64) for _ in rows]
    at = lambda i: np.concatenate([r[i : i + n] for r, n in zip(rows, spans)])
    codes = at(0)
    for i in range(1, width):
        codes = np.unique(codes * (len(words) + 1) + at(i), return_inverse=True)[1]
    return [np.unique(own) for own in np.split(codes, np.cumsum(spans)[:-1])]


def shared_shingles(left: list, right: list, slice_: int = 4096) -> np.ndarray:
    """Sizes of all intersections of a set of whole numbers on the left with one on the right, by products of incidence matrices."""
    sides, kinds = [], []
    for groups in (left, right):
        flat = np.concatenate([np.fromiter(g, np.int64, len(g)) for g in groups] or [np.zeros(0, np.int64)])
        kinds.append(np.unique(flat))
        sides.append((np.repeat(np.arange(len(groups)), [len(g) for g in groups]), flat))
    used = np.intersect1d(*kinds, assume_unique=True)
    for i, (row, flat) in enumerate(sides):
        held = np.isin(flat, used)
        row, column = row[held], np.searchsorted(used, flat[held])
        order = np.argsort(column, kind="stable")
        sides[i] = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(used), slice_):
        both = []
        for (row, column), n in zip(sides, (len(left), len(right))):
            a, b = np.searchsorted(column, [start, start + slice_])
            m = np.zeros((n, slice_), np.float32)
            m[row[a:b], column[a:b] - start] = 1
            both.append(m)
        out += both[0] @ both[1].T
    return out.astype(np.int64)


def _block_links(left: list[dict], right: list[dict], same: bool, width: int, percent: int) -> list[tuple[int, int]]:
    """Places (in left, in right) of linked texts of different parts; estimates choose what is compared."""
    bits = [np.array([r["bits"] for r in side], np.int64) for side in (left, right)]
    part = [np.array([r["part"]["nid"] for r in side], np.int64) for side in (left, right)]
    near = (_equal_bits(*bits) >= LEAST_MATCHES) & (part[0][:, None] != part[1][None, :])
    if same:
        near = np.triu(near, 1)
    rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not rows.size:
        return []
    sets = numbered_sets([side[i]["text"] for side, at in ((left, rows), (right, columns)) for i in at], width)
    a, b = sets[: rows.size], sets[rows.size :]
    both = shared_shingles(a, b)
    union = np.fromiter(map(len, a), np.int64)[:, None] + np.fromiter(map(len, b), np.int64)[None, :] - both
    u, v = np.nonzero((100 * both >= percent * union) & near[np.ix_(rows, columns)])
    return list(zip(rows[u].tolist(), columns[v].tolist()))


def blocks(members: DataFrame, texts: DataFrame, width: int, percent: int, chunk: int = 400, chunk_bytes: int = 2 << 20) -> DataFrame:
    """Links between different parts of each group of ``members(node, crowd, part, bits)``, as (u, v).

    Chunks hold about ``chunk`` texts and ``chunk_bytes``, of one large part or of small parts only; chunks of the same
    large part do not meet.
    """
    spark = members.sparkSession
    sizes = _broadcast_if_small(cut(members.groupBy("crowd", "part").agg(F.count("*").alias("n")), "minhash-sizes"))
    big = F.when(F.col("n") > chunk, F.col("part"))
    held = texts.select("node", "text", F.octet_length("text").cast("long").alias("bytes"))
    sized = members.join(sizes, ["crowd", "part"]).select("crowd", F.xxhash64(big).alias("family"), big.isNotNull().alias("large"), "node", "part", "bits").join(held, "node")
    sized = cut(sized, "minhash-sized")
    count = F.ceil(F.greatest(F.count("*") / chunk, F.sum("bytes") / chunk_bytes))
    whole = _broadcast_if_small(cut(sized.groupBy("crowd", "family").agg(count.alias("chunks")), "minhash-whole"))
    placed = sized.join(whole, ["crowd", "family"]).withColumn("nth", F.pmod(F.xxhash64("node"), "chunks"))
    packed = placed.groupBy("crowd", "family", "large", "nth").agg(F.collect_list(F.struct("node", "part", "bits", "text")).alias("rows"))
    packed = cut(packed.withColumn("c", F.xxhash64("crowd", "family", "nth")), "minhash-chunks")
    x, y = packed.select("crowd", "family", "large", "c").alias("x"), packed.select("crowd", "family", "c").alias("y")
    meet = (F.col("x.crowd") == F.col("y.crowd")) & (F.col("x.c") <= F.col("y.c")) & (~F.col("x.large") | (F.col("x.family") != F.col("y.family")))
    tasks = cut(x.join(y, meet).select(F.col("x.c").alias("cx"), F.col("y.c").alias("cy")), "minhash-chunk-pairs")
    spread = tasks.repartition(max(1, min(tasks.count(), 16 * spark.sparkContext.defaultParallelism)), "cx", "cy")
    rows = lambda c, out: packed.select(F.col("c").alias(c), F.col("rows").alias(out))
    both = spread.join(rows("cx", "rx"), "cx").join(rows("cy", "ry"), "cy").select("rx", "ry", (F.col("cx") == F.col("cy")).alias("same"))

    def run(batches):
        for batch in batches:
            for rx, ry, same in zip(batch.column("rx"), batch.column("ry"), batch.column("same").to_pylist()):
                left, right = rx.as_py(), ry.as_py()
                found = _block_links(left, right, same, width, percent)
                nodes = batch.schema.field("rx").type.value_type.field("node").type
                out = [pa.array([left[i]["node"] for i, _ in found], nodes), pa.array([right[j]["node"] for _, j in found], nodes)]
                yield pa.RecordBatch.from_arrays(out, names=["u", "v"])

    node = members.schema["node"].dataType.simpleString()
    return both.mapInArrow(run, f"u {node}, v {node}")


def _spread(keyed: DataFrame) -> DataFrame:
    """One row of ``keyed(key, chunks, ...)`` for every chunk of its bucket."""
    return keyed.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")


def _parts_and_crowds(links: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, part) and (node, crowd): components of ``links(u, v)`` and of ``near(a, b)``, found in the same rounds."""
    edge = lambda rows, of, a, b: rows.select(*(F.struct(F.lit(of).alias("of"), F.col(x).alias("node")).alias(y) for x, y in ((a, "u"), (b, "v"))))
    found = cut(components(edge(links, 0, "u", "v").union(edge(near, 1, "a", "b"))), "minhash-parts")
    return tuple(found.where(F.col("id.of") == of).select(F.col("id.node").alias("node"), F.col("component.node").alias(name)) for of, name in enumerate(("part", "crowd")))


def _linked(docs: DataFrame, width: int, percent: int, bucket_chunk: int = 512) -> DataFrame:
    """doc_id, k1, k2, n_shingles, component_id and kept of every row of ``docs``."""
    with counted_broadcasts(docs.sparkSession):
        signed, tops = _tops(docs, width, percent, bucket_chunk)
    placed = signed.drop("bands", "bits").join(tops, ["c1", "c2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("top", "doc_id"))
    return placed.select("doc_id", "k1", "k2", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _tops(docs: DataFrame, width: int, percent: int, bucket_chunk: int) -> tuple[DataFrame, DataFrame]:
    """The signatures of ``docs`` and, per class, the least doc_id of its component as (c1, c2, top)."""
    signed = cut(signatures(docs, width), "minhash")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    # rows of a class have equal bands and bits, so any will do
    least = F.min(F.struct("doc_id", "k1", "k2")).alias("least")
    classes = full.groupBy("c1", "c2").agg(least, F.any_value("bands").alias("bands"), F.any_value("bits").alias("bits"))
    classes = classes.withColumn("nid", F.monotonically_increasing_id())
    named = F.struct(F.col("least.doc_id").alias("rep"), F.col("nid").alias("nid")).alias("node")
    reps = cut(classes.select(named, "c1", "c2", F.col("least.k1").alias("k1"), F.col("least.k2").alias("k2"), "bands", "bits"), "minhash-reps")
    banded = reps.select("node", F.explode(F.array_distinct("bands")).alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / bucket_chunk).alias("chunks"))
    buckets = banded.join(shared, "key").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    buckets = cut(buckets, "minhash-buckets")
    ids = cut(buckets.select("node").distinct(), "minhash-nodes")
    near_by = reps.join(_broadcast_if_small(ids), "node", "left_semi")
    bits = cut(near_by.select("node", "bits"), "minhash-bits")
    wanted = cut(near_by.select("k1", "k2", "node"), "minhash-wanted")
    k1, k2 = row_key(docs)
    own = docs.where("text is not null").select(k1.alias("k1"), k2.alias("k2"), "text")
    texts = cut(own.join(_broadcast_if_small(wanted), ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("node", "text"), "minhash-texts")
    members = cut(buckets.join(_broadcast_if_small(bits), "node"), "minhash-members")
    pick = F.min_by(F.struct("node", "bits"), F.struct(F.xxhash64("node"), F.col("node.nid")))
    pivots = cut(members.groupBy("key", "chunks").agg(pick.alias("p")).select("key", "chunks", "p.*"), "minhash-pivots")
    close = members.alias("m").join(_broadcast_if_small(cut(_spread(pivots), "minhash-spread"), 2 * FEW).alias("p"), (F.col("m.key") == F.col("p.key")) & (F.col("m.chunk") == F.col("p.chunk")) & (F.col("p.node") != F.col("m.node")) & (matches("p", "m") >= LEAST_MATCHES))
    near = cut(close.select(F.least("p.node", "m.node").alias("a"), F.greatest("p.node", "m.node").alias("b")).distinct(), "minhash-pairs")
    links = cut(verified(near, texts, width, percent), "minhash-links")
    parts, crowds = _parts_and_crowds(links, near)
    crowded = cut(crowds.join(_broadcast_if_small(parts), "node", "left").select("node", "crowd", F.coalesce("part", "node").alias("part")), "minhash-crowds")
    several = cut(crowded.groupBy("crowd").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x < y").select("crowd"), "minhash-several")
    crowded = cut(crowded.join(_broadcast_if_small(several), "crowd").join(_broadcast_if_small(bits), "node"), "minhash-crowded")
    links = links.union(cut(blocks(crowded, texts, width, percent), "minhash-links"))
    # what is left: members of a bucket in different crowds or in none
    rest = cut(members.join(_broadcast_if_small(crowds), "node", "left").withColumn("apart", F.coalesce("crowd", "node")), "minhash-rest")
    meet = rest.groupBy("key", "chunks").agg(F.min("apart").alias("x"), F.max("apart").alias("y")).where("x < y").select("key", "chunks")
    meet = cut(meet, "minhash-meet")
    halves = _spread(meet.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))).where("other <= chunk")
    halves = _broadcast_if_small(cut(halves, "minhash-halves"))
    m, p = rest.join(halves, ["key", "chunk"]).alias("m"), rest.withColumnRenamed("chunk", "other").join(halves, ["key", "other"]).alias("p")
    close = m.join(p, [F.col(f"m.{c}") == F.col(f"p.{c}") for c in ("key", "chunk", "other")] + [((F.col("m.chunk") != F.col("m.other")) | (F.col("p.node") < F.col("m.node"))) & (F.col("p.apart") != F.col("m.apart")) & (matches("p", "m") >= LEAST_MATCHES)])
    pairs = cut(close.select(F.least("p.node", "m.node").alias("a"), F.greatest("p.node", "m.node").alias("b")).distinct(), "minhash-pairs")
    links = links.union(cut(verified(pairs, texts, width, percent), "minhash-links"))
    parts = cut(components(links), "minhash-parts")
    tops = reps.select("c1", "c2", "node").join(_broadcast_if_small(parts.select(F.col("id").alias("node"), F.col("component.rep").alias("top"))), "node", "left")
    return signed, _broadcast_if_small(cut(tops.select("c1", "c2", F.coalesce("top", "node.rep").alias("top")), "minhash-tops"))


def link(docs: DataFrame, width: int = 5, percent: int = 80, **settings) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    return _linked(docs, width, percent, **settings).drop("k1", "k2")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, **settings) -> DataFrame:
    """Rows of ``docs`` whose doc_id is the least of its group, unchanged, one row for each such doc_id.

    Of rows that repeat a doc_id the least stays, in the order of the columns (of texts, where a column has no order);
    null doc_ids all stay.
    """
    names = docs.columns
    n1, n2 = unused(names, "_k1", "_k2")
    gone = cut(_linked(docs, width, percent, **settings).where("not kept").select(F.col("k1").alias(n1), F.col("k2").alias(n2)).distinct(), "minhash-gone")
    k1, k2 = row_key(docs)
    held = docs.select(*map(quoted, names), k1.alias(n1), k2.alias(n2)).join(_broadcast_if_small(gone), [n1, n2], "left_anti").select(*map(quoted, names))
    again = _broadcast_if_small(cut(held.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "minhash-again"))
    single = held.join(again, "doc_id", "left_anti").select(*map(quoted, names))
    order = [quoted(f.name) for f in docs.schema if _ordered(f.dataType)]
    row, least = F.struct(*(quoted(c).alias(f"c{i}") for i, c in enumerate(names))), F.struct(*order)
    repeated = held.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, least).alias("_row"))
    return single.unionByName(repeated.select(*(F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names))))


def _ordered(kind) -> bool:
    return not re.search(r"map<|variant|interval", kind.simpleString())


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents").select("doc_id", "text"), 2, 80)
