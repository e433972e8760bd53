"""Embedding near-dedup over hierarchical navigable small-world graphs, one per shard.

Vectors that are equal, with equal labels, form a class, named by its least vec_id and 128 bits of vector and label; classes of a
label (and length) are dealt into shards of about ``shard_rows``. A task per shard builds its graph and writes it to the shared folder. A task per pair of shards of a
label then queries each graph with the other's vectors: beams widen while all they hold is linked and until a recall
audit against brute force passes; what still fills the widest beam is compared exactly, block by block. An audit counts
only with enough links of its own; where links are too rare for one, all vectors are compared exactly. Cosines
are verified in double precision. A task returns per vector its links and one link into its group, never all pairs.

Vectors that are null, empty, zero or hold null or non-finite parts, and null labels or ids, link with nothing. Rows
that repeat are vectors of their own, linked with each other; so are rows that repeat a vec_id with another vector, which
are compared like any other two: each gets its own links and component, and is kept where its vec_id is the component's.
"""

from __future__ import annotations

import io
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.components import components
from dossier.llm.shared import cut, mounted, new_uri, replace_file, table

FORWARD, REVERSE, BUILD_BEAM, BATCH = 14, 26, 40, 256


def beam_search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search for many queries at once: ids (-1 where none) and similarities of the ``beam`` nearest met."""
    q, n = len(queries), len(x)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # absent links are n
    rows = np.arange(q)
    ids = np.full((q, beam), n, np.int64)
    sims = np.full((q, beam), -np.inf, np.float32)
    done = np.ones((q, beam), bool)
    ids[:, 0], done[:, 0] = entry, False
    sims[:, 0] = np.einsum("qd,qd->q", x[entry], queries)
    seen[rows, entry] = True
    live = rows
    while live.size:
        waiting = np.where(done[live], -np.inf, sims[live])
        best = waiting.argmax(1)
        go = waiting[np.arange(live.size), best] > -np.inf
        live, best = live[go], best[go]
        if not live.size:
            break
        done[live, best] = True
        near = links[ids[live, best]]
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        near = np.where(fresh, near, n)
        got = np.einsum("qmd,qd->qm", x[np.minimum(near, n - 1)], queries[live], optimize=True)
        got[~fresh] = -np.inf
        all_sims = np.concatenate([sims[live], got], 1)
        top = np.argpartition(-all_sims, beam - 1, 1)[:, :beam]
        pick = np.arange(live.size)[:, None]
        sims[live] = all_sims[pick, top]
        ids[live] = np.concatenate([ids[live], near], 1)[pick, top]
        done[live] = np.concatenate([done[live], ~fresh], 1)[pick, top]
    return np.where(np.isfinite(sims), ids, -1), sims


def _diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Per row the nearest candidates that are nearer to the row than to any taken before; then the nearest of the rest."""
    order = np.argsort(-sims, 1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    own = x[np.maximum(ids, 0)]
    between = own @ own.transpose(0, 2, 1)
    there = np.isfinite(sims) & (ids >= 0)
    taken = np.zeros(ids.shape, bool)
    for t in range(ids.shape[1]):
        taken[:, t] = there[:, t] & ~((between[:, t, :] > sims[:, t, None]) & taken).any(1)
    rank = np.where(taken, 0, np.where(there, 1, 2))
    first = np.argsort(rank, 1, kind="stable")[:, :most]
    return np.where(np.take_along_axis(there, first, 1), np.take_along_axis(ids, first, 1), -1)


def _layer(x: np.ndarray, entry_of) -> np.ndarray:
    """Links of one layer over x in order; row i links to earlier rows and to later ones that chose it. n: no link."""
    n = len(x)
    links = np.full((n, FORWARD + REVERSE), n, np.int64)
    filled = np.zeros(n, np.int64)
    for start in range(0, n, BATCH):
        end = min(n, start + BATCH)
        batch = x[start:end]
        inner = batch @ batch.T
        inner[np.triu_indices(end - start)] = -np.inf  # only earlier rows of the batch
        keep = min(BUILD_BEAM, end - start)
        top = np.argpartition(-inner, keep - 1, 1)[:, :keep]
        sims, ids = np.take_along_axis(inner, top, 1), top + start
        if start:
            entry = entry_of(start, end)
            found, close = beam_search(x[:start], np.minimum(links[:start], start), batch, np.where(entry < start, entry, 0), BUILD_BEAM)
            ids, sims = np.concatenate([ids, found], 1), np.concatenate([sims, np.where(found >= 0, close, -np.inf)], 1)
        chosen = _diverse(x, ids, sims, FORWARD)
        links[start:end, : chosen.shape[1]] = np.where(chosen >= 0, chosen, n)
        for i, row in enumerate(chosen, start):
            for j in row[row >= 0]:
                at = filled[j]
                filled[j] += 1
                links[j, FORWARD + (at if at < REVERSE else (at * 2654435761) % REVERSE)] = i
    return links


class Graph:
    """Layers from the top down; layer k holds the first sizes[k] rows. Rows are ordered so that upper rows come first."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray]):
        self.x, self.layers = x, layers

    @classmethod
    def build(cls, x: np.ndarray) -> Graph:
        """``x``: unit vectors in an order independent of their place."""
        sizes = [len(x)]
        while sizes[-1] > 64:
            sizes.append(sizes[-1] // 16 + 1)
        graph = cls(x, [])
        for size in reversed(sizes):
            own = x[:size]
            graph.layers.append(_layer(own, lambda a, b, g=graph: g.descend(x[a:b])))
        return graph

    def descend(self, queries: np.ndarray) -> np.ndarray:
        entry = np.zeros(len(queries), np.int64)
        for links in self.layers:
            ids, sims = beam_search(self.x[: len(links)], links, queries, entry, 4)
            entry = np.take_along_axis(ids, sims.argmax(1)[:, None], 1)[:, 0]
        return entry

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        upper = Graph(self.x, self.layers[:-1])
        return beam_search(self.x, self.layers[-1], queries, upper.descend(queries), min(beam, len(self.x)))

    def within(self, queries: np.ndarray, least: float, beam: int, widest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query, row) at ``least`` or nearer, and the queries whose widest beam was still full of them."""
        at, q, r = np.arange(len(queries)), [], []
        while True:
            full = []
            for i in range(0, at.size, BATCH):
                own = at[i : i + BATCH]
                ids, sims = self.search(queries[own], beam)
                hit = (sims >= least) & (ids >= 0)
                over = hit.all(1) & (ids.shape[1] < len(self.x))
                rows, columns = np.nonzero(hit & ~over[:, None])
                q.append(own[rows])
                r.append(ids[rows, columns])
                full.append(own[over])
            at = np.concatenate(full) if full else at[:0]
            beam *= 4
            if not at.size or beam > widest:
                return np.concatenate(q) if q else at[:0], np.concatenate(r) if r else at[:0], at


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. The largest part of a row is first brought near 1 by a power of two, which rounds nothing, so that no
    square leaves the range of doubles."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def _parts(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """A column of vectors as a matrix: single precision where the column has that, else double."""
    x = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    return x if x.dtype == np.float32 else x.astype(np.float64)


def _exact(a: np.ndarray, b: np.ndarray, least: float):
    """(rows of a, hits) in blocks: all of b against some of a, in double precision."""
    step = max(1, (1 << 22) // max(1, len(b)))
    for i in range(0, len(a), step):
        yield np.arange(i, min(len(a), i + step)), a[i : i + step] @ b.T >= least


def _one_way(graph: Graph, x64: np.ndarray, own: np.ndarray, least: float, goal: float, audit: int, same: bool):
    """Verified pairs of ``own`` (double) against the graph's rows, the queries left to exact comparison, and whether
    every query's links are exact. ``same``: own are the graph's rows, which do not link with themselves.

    The audit compares queries exactly, in random order, until ``audit`` of them are linked and they have ten times as
    many links and one for each 20 queries of the shard; where links are fewer, every query has been compared and its
    exact links stand.
    """
    beam, listed = 32, 256
    q32 = own.astype(np.float32)
    enough = max(10 * audit, len(own) // 20)
    draws = np.random.default_rng(len(own)).permutation(len(own))
    times = np.full(len(own), -1, np.int64)  # true links of the queries drawn
    true_q, true_r = [draws[:0]], [draws[:0]]
    while True:
        q, r, full = graph.within(q32, least - 1e-4, beam, 8 * beam)
        ok = (np.einsum("ij,ij->i", own[q], x64[r]) >= least) & ~(same & (q == r))
        q, r = q[ok], r[ok]
        audited = np.ones(len(own), bool)
        audited[full] = False
        left = draws[audited[draws] & (times[draws] < 0)]
        while left.size and ((seen := times[audited & (times > 0)]).size < audit or seen.sum() < enough):
            some, left = left[:BATCH], left[BATCH:]
            for block, hits in _exact(own[some], x64, least):
                mine = some[block]
                if same:
                    hits[np.arange(len(mine)), mine] = False
                times[mine] = hits.sum(1)
                hits[times[mine] > listed] = False
                rows, columns = np.nonzero(hits)
                true_q.append(mine[rows])
                true_r.append(columns)
        drawn = audited & (times >= 0)
        if not left.size or drawn[q].sum() >= goal * times[drawn].sum():
            sure_q, sure_r = np.concatenate(true_q), np.concatenate(true_r)
            rest, sure = ~drawn[q], drawn[sure_q]
            return np.append(q[rest], sure_q[sure]), np.append(r[rest], sure_r[sure]), np.flatnonzero(~audited | (times > listed)), not left.size
        if beam >= 512:
            return q[:0], r[:0], np.arange(len(own)), True
        beam *= 2


def compare(a: dict, b: dict, least: float, goal: float = 0.99, audit: int = 48):
    """(place, links, root place) of vectors of shards a and b that link across (a is b: within), places running over a then b."""
    same = a is b
    x, y = a["x64"], b["x64"]
    shift = 0 if same else len(x)
    q, r, full, whole = _one_way(b["graph"], y, x, least, goal, audit, same)
    pairs, exact = [np.stack([q, r + shift], 1)], np.zeros(len(x), bool)
    exact[full] = True
    late = np.zeros(len(y), bool)
    if not same and not whole:
        q2, r2, full2, _ = _one_way(a["graph"], x, y, least, goal, audit, same)
        pairs.append(np.stack([r2, q2 + shift], 1))
        late[full2] = True
    total = len(x) if same else len(x) + len(y)
    weight = a["w"] if same else np.concatenate([a["w"], b["w"]])
    exact_all = exact if same else np.concatenate([exact, late])
    both = np.concatenate(pairs)
    both = both[both[:, 0] != both[:, 1]]
    both = both[~exact_all[both[:, 0]] & ~exact_all[both[:, 1]]]
    both = np.unique(np.sort(both, 1), axis=0)
    links = np.bincount(both[:, 0], weight[both[:, 1]], total) + np.bincount(both[:, 1], weight[both[:, 0]], total)
    root = np.arange(total)

    def find(i):
        i = np.asarray(i)
        while True:
            up = root[root[i]]
            if (up == root[i]).all():
                return up
            root[i] = up

    def join(members):
        tops = np.unique(find(members))
        root[tops] = tops[0]

    for u, v in both:
        join(np.array([u, v]))
    sides = [(np.flatnonzero(exact), x, y, 0, shift)] if same else [(np.flatnonzero(exact), x, y, 0, shift), (np.flatnonzero(late), y, x, shift, 0)]
    for side, (rows, own, other, base, there) in enumerate(sides):
        for block, hits in _exact(own[rows], other, least):
            mine = rows[block]
            if same:
                hits[np.arange(len(mine)), mine] = False
            links[mine + base] += hits @ weight[there : there + len(other)]
            rest = ~exact_all[there : there + len(other)]
            links[there : there + len(other)][rest] += (hits.T @ weight[mine + base])[rest]
            for i, row in zip(mine, hits):
                near = np.flatnonzero(row)
                if near.size:
                    join(np.append(near + there, i + base))
    linked = np.flatnonzero(links)
    return linked, links[linked].astype(np.int64), find(linked)


def _load(path: str) -> dict:
    with np.load(path) as f:
        x64 = _unit(f["x"].astype(np.float64))
        unit = x64.astype(np.float32)
        layers = [f[f"layer{i}"].astype(np.int64) for i in range(int(f["layers"]))]
        return {"x32": unit, "x64": x64, "ids": f["ids"], "w": f["w"], "graph": Graph(unit, layers)}


_NAME = ("rep", "k1", "k2")


def _build_shards(folder: str):
    def build(shard: pa.Table) -> pa.Table:
        ids = np.stack([shard.column(c).to_numpy() for c in _NAME], 1)
        order = np.argsort(ids[:, 1] ^ ids[:, 2], kind="stable")
        x = _parts(shard.column("embedding"), len(ids))[order]
        graph = Graph.build(_unit(x.astype(np.float64)).astype(np.float32))
        out = io.BytesIO()
        np.savez(out, x=x, ids=ids[order], w=shard.column("n").to_numpy()[order], layers=len(graph.layers), **{f"layer{i}": v.astype(np.int32) for i, v in enumerate(graph.layers)})
        group, number = shard.column("_group")[0].as_py(), shard.column("_shard")[0].as_py()
        path = os.path.join(folder, f"{group & (1 << 64) - 1:016x}-{number:06d}.npz")
        replace_file(path, out.getvalue())
        return pa.table({"_group": pa.array([group], pa.int64()), "_shard": pa.array([number], pa.int64()), "path": [path]})

    return build


def link(vectors: DataFrame, least: float = 0.93, shard_rows: int = 20_000, goal: float = 0.99, audit: int = 48) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors(vec_id, embedding, label)``."""
    e = F.col("embedding").cast("array<double>")
    fit = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fit, F.lit(False))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding", usable.alias("_ok"))
    own = own.withColumns({"_group": F.when(F.col("_ok"), F.xxhash64("label", F.size("embedding"))), "_k1": F.xxhash64("label", "embedding"), "_k2": F.xxhash64(F.lit(7), "label", "embedding")})
    keys = ["_group", "_k1", "_k2"]
    narrow = own.where("_ok").select(*keys, "vec_id")
    classes = cut(narrow.groupBy(*keys).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vector-classes")
    shards = classes.groupBy("_group").agg(F.ceil(F.count("*") / shard_rows).alias("_shards"))
    placed = classes.join(shards, "_group").select(*keys, "rep", "n", F.pmod(F.xxhash64("_k1", "_k2"), "_shards").alias("_shard"))
    held = own.where("_ok").join(placed, [own[c] == placed[c] for c in keys] + [own["vec_id"] == placed["rep"]])
    held = held.select(*(placed[c] for c in keys), "_shard", "rep", "n", "embedding").dropDuplicates([*keys, "_shard", "rep"])
    folder = mounted(new_uri(vectors.sparkSession, "graphs"))
    held = held.withColumnsRenamed({"_k1": "k1", "_k2": "k2"})
    built = held.groupBy("_group", "_shard").applyInArrow(_build_shards(folder), "_group long, _shard long, path string")
    built = cut(built, "graph-paths")
    left, right = built.alias("l"), built.alias("r")
    tasks = left.join(right, (F.col("l._group") == F.col("r._group")) & (F.col("l._shard") <= F.col("r._shard"))).select(F.col("l.path").alias("a"), F.col("r.path").alias("b"))

    def run(batches):
        for batch in batches:
            for p, q in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a = _load(p)
                b = a if p == q else _load(q)
                at, n, root = compare(a, b, least, goal, audit)
                ids = a["ids"] if p == q else np.concatenate([a["ids"], b["ids"]])
                names = [pa.StructArray.from_arrays([pa.array(ids[x, k]) for k in range(3)], names=list(_NAME)) for x in (at, root)]
                yield pa.RecordBatch.from_arrays([names[0], pa.array(n), names[1]], names=["name", "n", "root"])

    spread = cut(tasks.repartition(max(24, vectors.sparkSession.sparkContext.defaultParallelism * 2), "a", "b"), "graph-tasks")
    name = "struct<rep:bigint,k1:bigint,k2:bigint>"
    found = cut(spread.mapInArrow(run, f"name {name}, n long, root {name}"), "vector-links")
    parts = components(found.select(F.col("name").alias("u"), F.col("root").alias("v")))  # names are ordered by vec_id first
    linked = found.groupBy("name").agg(F.sum("n").alias("_links")).join(parts.withColumnRenamed("id", "name"), "name", "left")
    named = classes.withColumn("name", F.struct("rep", F.col("_k1").alias("k1"), F.col("_k2").alias("k2")))
    known = named.join(linked, "name", "left").select(*keys, F.col("n").alias("_n"), F.coalesce("_links", F.lit(0)).alias("_links"), F.coalesce("component.rep", "rep").alias("_component"))
    out = own.select("vec_id", *keys).join(known, keys, "left")
    component = F.coalesce("_component", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("_links") + F.col("_n") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "embeddings"))
