"""Exact dedup, whitening and divergence audit against brute force; nulls, ties, repeats, odd columns, empty tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dossier.llm import exact_dedup, source_divergence, whitening

SCALE = 10**9
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    texts = [f"text {draw.randint(0, 150)}" for _ in range(300)] + ["hot"] * 200 + [None, "", " ", None, "", "ß" * 100_000, "ß" * 100_000]
    out = [(i, t, "en", "s") for i, t in enumerate(texts)]
    draw.shuffle(out)
    return out + [(None, "alone", "en", "s"), (None, "hot", "en", "s"), (None, "twice", "en", "s"), (None, "twice", "en", "s"), (400, "hot", "x", None), (506, texts[506], "y", "z")]


def _outcome(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    keep = {t: max((x for x in ids if x is not None), default=None) for t, ids in groups.items()}
    return Counter((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)


@pytest.mark.parametrize("parts", [10_000, 20, 2])
def test_exact_dedup(spark, rows, parts, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_PARTS", parts)  # groups by broadcast, by both ways, and nearly all by shuffle
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    own = docs.select("*", docs["lang"].alias("kept"), docs["lang"].alias("_maybe"), docs["source"].alias("a.b `c"))
    found = exact_dedup.mark_copies(own)
    assert found.columns == [*docs.columns, "_maybe", "a.b `c", *exact_dedup.ADDED]
    assert Counter(tuple(r) for r in found.select("doc_id", *exact_dedup.ADDED).collect()) == _outcome(rows)
    stay = exact_dedup.drop_copies(docs)
    assert stay.columns == docs.columns
    assert stay.count() == sum(n for (_, _, _, kept, _), n in _outcome(rows).items() if kept)


def test_exact_dedup_filter(spark, rows):
    """A full filter lets all rows through and changes no result; a roomy one lets few single rows through."""
    docs = spark.createDataFrame(rows, SCHEMA)
    full = exact_dedup.mark_copies(docs, most_bits=1)
    assert Counter(tuple(r) for r in full.select("doc_id", *exact_dedup.ADDED).collect()) == _outcome(rows)
    many = docs.select("text").union(spark.range(20000).select(F.concat(F.lit("only "), "id").alias("text"))).withColumn("doc_id", F.monotonically_increasing_id())
    repeats = exact_dedup.RepeatFilter(many)
    marked = repeats.mark(many, F.coalesce(F.col("text"), F.lit("")), "maybe")
    assert marked.where("text like 'only %' and maybe").count() < 1000
    counts = Counter(t or "" for _, t, *_ in rows)
    assert marked.where("text not like 'only %' or text is null").where("maybe").count() >= sum(n for n in counts.values() if n > 1)


def test_exact_dedup_odd_tables(spark):
    empty = exact_dedup.mark_copies(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[-4:] == list(exact_dedup.ADDED)
    named = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", None)], "doc_id string, text string")
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup.mark_copies(named).collect()) == [("a", "b", False), ("b", "b", True), ("c", "c", True)]


def test_exact_dedup_is_native(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 900).alias("text")).write.parquet(str(tmp_path / "documents.parquet"))
    found = exact_dedup.op13_exact_dedup(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2 * plan.count("SortMergeJoin")  # nothing else moves
    assert found.count() == 1000


def _whitened(vectors, k=16):
    """numpy's own eigenvectors of the covariance: {x vector: (deviation, |whitened|)}, explained, list size."""
    x = [tuple(int(np.floor(64.0 * c)) + 1000000 for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    own = np.array(x, dtype=np.int64)
    return n, [sum(int(a) ** 2 for a in row) for row in n * own - sums], ((n * own - sums) / n) @ (axes / np.sqrt(values)), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("d,k", [(64, 16), (5, 16), (96, 3)])
def test_whitening(spark, d, k):
    draw = np.random.default_rng(d)
    vectors = (draw.standard_normal((400, d)) * np.linspace(2, 0.3, d) + draw.integers(0, 2, (400, 1))).astype(np.float32)
    vectors[200:260] = vectors[7]
    rows = [(i, [float(c) for c in v], f"w{i}") for i, v in enumerate(vectors)]
    odd = [(1000, None, "x"), (1001, [], "x"), (1002, [float("nan")] * d, "x"), (1003, [None] * d, "x"), (1004, [float("inf")] + [0.0] * (d - 1), "x"), (1005, [1e300] * d, "x")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, n string").withColumn("_x", F.lit(1)).repartition(7)
    found = whitening.whiten(frame, components=k)
    assert found.columns == ["vec_id", "embedding", "_x", *whitening.ADDED]
    n, deviation, white, explained = _whitened(vectors, k)
    got = {r["vec_id"]: r for r in found.collect()}
    assert sorted(got) == list(range(400))
    assert all(got[i]["n"] == n and int(got[i]["deviation"]) == deviation[i] for i in range(400))
    mine = np.array([got[i]["whitened"] for i in range(400)])
    signs = np.sign((mine * white).sum(axis=0))
    np.testing.assert_allclose(mine * signs, white, atol=1e-8)
    np.testing.assert_allclose(got[0]["explained"], explained, rtol=1e-9)
    assert {r["identity_error"] for r in got.values()} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_whitening_query_and_odd_tables(spark, tmp_path):
    draw = np.random.default_rng(1)
    rows = [(f"v{i}", [float(c) for c in draw.standard_normal(4)], 1) for i in range(50)]
    spark.createDataFrame(rows, "vec_id string, embedding array<double>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = whitening.op12_embedding_whitening(spark, str(tmp_path))
    assert dict(found.dtypes) == {"vec_id": "string", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert found.count() == 200 and found.agg(F.min("component"), F.max("component")).first() == (1, 4)
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r["n"], int(r["deviation"]), r["whitened"]) for r in same] == [(1, 0, [])] * 2
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], schema)).collect()
    assert {len(r["whitened"]) for r in line} == {1} and abs(line[0]["explained"][0] - 1) < 1e-12
    mixed = whitening.whiten(spark.createDataFrame([(i, [float(i), float(i * i)] if i % 2 else [float(i)]) for i in range(20)], schema)).collect()
    assert {(len(r["embedding"]), r["n"], len(r["whitened"])) for r in mixed} == {(2, 10, 2), (1, 10, 1)}
    far = whitening.whiten(spark.createDataFrame([(i, [1e13 * i, 7.0]) for i in range(6)], schema)).collect()  # beyond 64 bits
    x = [int(64 * 1e13 * i) + 1000000 for i in range(6)]
    assert {r["vec_id"]: int(r["deviation"]) for r in far} == {i: (6 * x[i] - sum(x)) ** 2 for i in range(6)}


def test_lobpcg_needs_its_steps():
    draw = np.random.default_rng(4)
    q = np.linalg.qr(draw.standard_normal((300, 300)))[0]
    values = np.linspace(3, 0.01, 300)
    matrix = (q * values) @ q.T
    found, axes, steps = whitening.lobpcg(lambda b: matrix @ b, 300, 16)
    np.testing.assert_allclose(found, values[:16], rtol=1e-11)
    np.testing.assert_allclose(np.abs((axes * q[:, :16]).sum(axis=0)), 1, atol=1e-12)
    assert 3 < steps < 200


_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _audited(rows, min_docs, top):
    docs = [(lang or "", source or "", _TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))) for _, text, lang, source in rows]
    found = set()
    for lang in {x[0] for x in docs}:
        own = [x for x in docs if x[0] == lang]
        df = Counter(t for x in own for t in set(x[2]))
        kept = sorted((t for t, n in df.items() if n >= min_docs), key=str.encode)
        counts = defaultdict(Counter)
        for _, source, found_terms in own:
            counts[source].update(found_terms)
        whole = sum(counts.values(), Counter())
        shares = lambda c: {t: 1 + SCALE * (c[t] + 2) // (sum(c[u] for u in kept) + 2 * len(kept)) for t in kept}  # noqa: B023, E731
        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s), key=lambda x: (x[0], x[1].encode()))
            best = sorted(((-f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))[:top]
            found |= {(lang, s, part, item, -v, i) for part, of in (("pair", pairs), ("term", best)) for i, (v, item) in enumerate(of, 1)}
    return found


@pytest.mark.parametrize("sources,groups", [(512, 100_000), (2, 3)])
def test_source_divergence(spark, monkeypatch, sources, groups):
    for name, value in (("SOURCES", sources), ("GROUPS", groups)):
        monkeypatch.setattr(source_divergence, name, value)
    draw = random.Random(9)
    word = lambda: "".join(draw.choice(("a", "B", "é", "中", "zz", "\U0001f600", "\x85")) for _ in range(draw.randint(1, 3)))
    rows = [(i, " .1_".join(word() for _ in range(draw.randint(0, 40))), draw.choice(("en", "en", "de", None)), draw.choice(("s0", "s0", "s0", "s1", "é", None))) for i in range(150)]
    rows += [(200, None, "en", "silent"), (201, "", "xx", "a"), (202, "q", "xx", "b"), (203, None, None, "s0"), (204, "Zz " * 30000, "en", "s1")] + rows[:20]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("item", F.lit(1)).repartition(6)
    found = source_divergence.audit(docs, 10, 4)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == _audited(rows, 10, 4)
    assert source_divergence.audit(docs.limit(0)).count() == 0


def test_divergence_tries_in_small_parts(monkeypatch):
    """Tries that are read out again and again, windows of two bytes: the same kept terms."""
    draw = random.Random(2)
    texts = [" ".join(draw.choice(("ab", "abc", "a", "æøå", "æ", "b" * 9)) for _ in range(draw.randint(0, 9))).encode() for _ in range(200)]
    batches = [pa.RecordBatch.from_pydict({"lang": ["en"] * 20, "source": [f"s{i % 3}" for i in range(20)], "text": texts[k : k + 20]}) for k in range(0, 200, 20)]
    read = lambda found: [(r["lang"], r["term"], r["docs"], *zip(*sorted(zip(r["sources"], r["counts"])))) for b in found for r in b.to_pylist()]

    def kept():
        runs = sorted(read(source_divergence._count(iter(batches))))
        columns = [pa.array(list(c), f.type) for c, f in zip(zip(*runs), source_divergence._RUN)]
        whole = pa.RecordBatch.from_arrays(columns, schema=source_divergence._RUN)
        return read(source_divergence._merging(10)(whole.slice(i, 3) for i in range(0, whole.num_rows, 3))), len(runs)

    want, few = kept()
    for name, value in (("LEAVES", 2), ("PENDING", 3), ("WINDOW", 2), ("BURST", 1)):
        monkeypatch.setattr(source_divergence, name, value)
    got, many = kept()
    assert got == want and many > few and [t for _, t, *_ in got] == sorted(t for _, t, *_ in got)
    assert {t: n for _, t, n, *_ in got} == {t: n for t, n in Counter(w for x in texts for w in set(x.split())).items() if n >= 10}


def test_shares_are_exact():
    draw = random.Random(1)
    counts = [draw.randint(0, 10**15) for _ in range(200)] + [0, 1]
    totals = [c + draw.randint(1, 8 * 10**15) for c in counts]
    got = source_divergence.share(np.array(counts, np.int64), np.array(totals, np.int64))
    assert got.tolist() == [SCALE * c // t for c, t in zip(counts, totals)]
