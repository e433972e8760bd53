"""WARC round trip, embedding links and components against brute force; the pipeline; registration."""

import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossier.llm import components, embedding_dedup, queries, warc
from dossier.llm.shared import new_uri, row_key, workers_see_us


def test_components(spark):
    edges = [(5, 4), (4, 9), (9, 2), (7, 8), (8, 8), (4, 5)] + [(100, i) for i in range(101, 160)]
    found = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert {k: v for k, v in found.items() if k < 100} == {2: 2, 4: 2, 5: 2, 9: 2, 7: 7, 8: 7} and {found[i] for i in range(100, 160)} == {100}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_warc_round_trip(spark):
    workers_see_us(spark)
    body = "<p>é</p>" * 30
    rows = [(3, "u\n", body), (1, None, body), (None, "a", body), (2, "b", None), (5, "é", ""), (1, "again", body), (6, "x", "short"), (7, "x", "short"), (9, "z", body + "\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    found = warc.assemble(warc.read_records(warc.write_archives(pages, new_uri(spark, "t")), True)).collect()
    got = sorted(((r["page_id"], r["response"]["type"], r["response"]["refers_to"], r["metadata"]["payload_bytes"], r["response"]["digest"]) for r in found), key=str)
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        again = page_id == 3
        want.append((page_id, "revisit" if again else "response", 1 if again else None, len(data), hashlib.sha256(data).hexdigest()))
    assert got == sorted(want, key=str)
    assert all(bytes(r["response"]["payload"]) == (html or "").encode() for r in found for p, _, html in rows if p == r["page_id"] and r["response"]["type"] == "response")
    assert warc.assemble(warc.read_records(warc.write_archives(pages.limit(0), new_uri(spark, "t")))).count() == 0


def test_warc_large_payloads_rolls_and_missing_records(spark):
    """A payload beyond the reader's buffer that does not compress, archives of one capture each, captures in part."""
    workers_see_us(spark)
    noise = np.random.default_rng(1).integers(0x4E00, 0x9FFF, 900_000).astype("<u2").tobytes().decode("utf-16-le")
    pages = spark.createDataFrame([(1, "a", noise), (2, "b", noise), (3, "c", "x" * 100)], "page_id long, url string, html string").coalesce(1)
    archives = warc.write_archives(pages, new_uri(spark, "t"), roll_bytes=1000)
    assert archives.count() >= 2
    found = warc.read_records(archives, True)
    rows = {r["page_id"]: r for r in warc.assemble(found).collect()}
    assert bytes(rows[1]["response"]["payload"]).decode() == noise and rows[2]["response"]["refers_to"] == 1
    assert warc.assemble(found.where("type <> 'request'")).where("request is null and response is not null").count() == 3
    assert warc.assemble(found.where("type = 'metadata'")).where("response is null").count() == 3


@pytest.mark.parametrize("shard_rows", [20_000, 150])
def test_embedding_links(spark, shard_rows):
    workers_see_us(spark)
    draw = np.random.default_rng(4)
    base = draw.normal(size=(300, 16))
    near = base[draw.integers(0, 60, 250)] + draw.normal(size=(250, 16)) * 0.12
    hot = base[0] + draw.normal(size=(200, 16)) * 0.02
    x = np.concatenate([base, near, hot, base[:3], base[:3]]).astype(np.float32)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    odd = [(9000, None, 1), (9001, [0.0] * 16, 1), (9002, [float("nan")] * 16, 1), (9003, x[0].tolist(), None), (9004, [], 1), (9005, [1.0, None], 1), (None, x[0].tolist(), 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    d = x.astype(float)
    d /= np.sqrt((d * d).sum(1))[:, None]
    hit = (d @ d.T >= 0.93) & (np.arange(len(x))[:, None] % 2 == np.arange(len(x)) % 2)
    np.fill_diagonal(hit, False)
    found = {r["vec_id"]: r for r in embedding_dedup.link(table, shard_rows=shard_rows).collect()}
    got, true = sum(found[i]["n_links"] for i in range(len(x))), int(hit.sum())
    assert 0.98 * true <= got <= true
    for i in range(len(x)):
        assert found[i]["n_links"] <= hit[i].sum() and found[i]["component_id"] <= i
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in range(9000, 9006)) and found[None]["kept"]
    assert embedding_dedup.link(table.limit(0)).count() == 0


def test_embedding_cosines_in_double(spark):
    """Pairs a hair above and below the threshold, and vectors beyond the range of single precision."""
    workers_see_us(spark)
    draw, rows, want = np.random.default_rng(8), [], {}
    for i in range(60):
        u, v = np.linalg.qr(draw.normal(size=(16, 2)))[0].T
        angle = np.arccos(0.93 + (2e-9 if i % 2 else -2e-9))
        scale = (1.0, 1e-50, 1e39, 1e-170, 1e160)[i % 5]
        rows += [(2 * i, (u * scale).tolist(), i), (2 * i + 1, ((np.cos(angle) * u + np.sin(angle) * v) * scale * 3).tolist(), i)]
        want |= {2 * i: i % 2, 2 * i + 1: i % 2}
    found = embedding_dedup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert {r["vec_id"]: r["n_links"] for r in found.collect()} == want


@pytest.mark.parametrize("same", [False, True])
def test_audit_finds_rare_links_that_the_graph_misses(same):
    n, draw = 2000, np.random.default_rng(6)
    x, y = draw.normal(size=(n, 32)), draw.normal(size=(n, 32))
    places = np.array([[11, 700], [303, 1501], [1234, 15], [1777, 1777]])
    assert not np.isin(places, np.linspace(0, n - 1, 48).astype(int)).any()
    (x if same else y)[places[:, 1]] = x[places[:, 0]] + draw.normal(size=(len(places), 32)) * 0.1

    def shard(x):
        x64 = embedding_dedup._unit(x)
        x32 = x64.astype(np.float32)
        blind = embedding_dedup.Graph(x32, [np.full((n, 40), n, np.int64)])  # reaches its entry only
        return {"x32": x32, "x64": x64, "w": np.ones(n, np.int64), "graph": blind}

    a = shard(x)
    at, links, _ = embedding_dedup.compare(a, a if same else shard(y), 0.93)
    want = places[:3] if same else places + [0, n]
    assert sorted(at) == sorted(want.ravel()) and (links == 1).all()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_sql_and_pipeline(spark):
    import duckdb

    import corpus_pipeline

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, "/root/testdata/sf0.001")
        want = con.sql(sql)
        names = sorted(want.columns)
        rows = lambda cols, data: sorted(str([r[cols.index(c)] for c in names]) for r in data)
        assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall()), name
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert 0 < len({r["doc_id"] for r in out}) < 200 and [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier"


def test_repeated_vec_ids_are_vectors_of_their_own(spark):
    workers_see_us(spark)
    rows = [(1, [1.0, 0.0, 0.0], 0), (1, [0.0, 1.0, 0.0], 0), (2, [0.0, 1.0, 0.01], 0), (2, [0.0, 1.0, 0.01], 0), (2, [0.0, 1.0, 0.01], 1)]
    found = embedding_dedup.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == [(1, 0, 1, True), (1, 2, 1, True), (2, 0, 2, True), (2, 2, 1, False), (2, 2, 1, False)]


def _pipeline_rows():
    """Texts of one language: plain ones, copies, near copies, rows in full again, common lines, junk, nulls, a long text."""
    draw = random.Random(21)
    words = ["".join(draw.choice("bcdfgklmnprst") + draw.choice("aeiou") for _ in range(draw.randint(1, 4))) for _ in range(900)]
    text = lambda n=120: "\n".join(" ".join(draw.choice(words) for _ in range(n // 4)) for _ in range(4))
    own = [(i, text(), "en", "s", 1) for i in range(90)]
    own += [(100 + i, own[i][1], "en", "s", 1) for i in range(5)] + [(120 + i, own[10 + i][1] + " " + words[i], "en", "s", 1) for i in range(5)]
    own += [own[20], own[20], own[21]]
    own = [(i, t + ("\nThe same  line" if n % 6 == 0 else ""), a, b, c) for n, (i, t, a, b, c) in enumerate(own)]
    own += [(200 + i, "BUY!!! ### " * 60, "en", "s", 1) for i in range(6)] + [(210, None, "en", "s", 1), (211, "", "en", None, None), (212, text(9000), "en", "s", 1), (None, text(), "en", "s", 1)]
    return own


def test_pipeline_against_brute_force(spark, tmp_path):
    """run() over a small table: its own model and verdicts, then line dedup, near-dedup and packing by brute force."""
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline
    from dossier.llm import quality_classifier, quality_rules

    own = _pipeline_rows()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(own, schema).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 200), 0) for i in (*range(90), *range(200, 206))]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = quality_classifier.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    rows = [r for r in own if model.score(*quality_classifier.features(r[1] or "", r[4])) >= 0.3]
    assert {i for i in range(200, 206)}.isdisjoint(r[0] for r in rows)
    verdict = {(r["doc_id"], r["_k1"]): r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows, schema)).collect()}
    keys = {r: k for r, k in zip(rows, [x[0] for x in spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string").select(row_key(spark.range(1).selectExpr("id as doc_id", "'' as text"))[0]).collect()])}
    rows = [r for r in rows if verdict[r[0], keys[r]]]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
    common = {k for k, n in Counter(k for r in rows for k in {key(x) for x in r[1].split("\n")} if k).items() if n >= 10}
    assert common == {"the same  line"}
    rows = [(r[0], "\n".join(x for x in r[1].split("\n") if key(x) not in common), *r[2:]) for r in rows]
    sets = [set(zip(*(r[1].lower().split()[k:] for k in range(5)))) for r in rows]
    order = sorted((i for i in range(len(rows)) if rows[i][0] is not None), key=lambda i: rows[i][0])
    top = {i: i for i in order}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)), key=order.index)
                top[y] = x
    kept = {rows[i] for i in order if rows[find(i)][0] == rows[i][0]} | {r for r in rows if r[0] is None}
    assert 80 < len(kept) < len(rows) - 8
    coder, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for r in kept:
        ids = np.array(coder.encode(r[1], add_special_tokens=False).ids + [0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            want[r[0], piece, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())] += 1
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    assert max(n for _, n in Counter((r["sequence_id"], r["offset"]) for r in found).items()) == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_tables(spark, empty):
    """Nulls in every column, empty and long texts, repeats, clashing and dotted columns, and no rows at all."""
    import corpus_pipeline

    own = [(1, "a b " * 60, "en", "s", 480, "x", 1), (1, "a b " * 60, "en", "s", 480, "x", 1), (2, "w " * 50000, None, None, None, None, None), (None, None, None, None, None, None, None), (3, "", "en", "s", 0, "y", 2)]
    docs = spark.createDataFrame(own[: 0 if empty else 9], "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, _k1 int").withColumn("score", F.lit(1)).withColumn("length", F.lit("l"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and out.count() <= docs.count(), name
    assert stage(spark, docs, "").count() == (0 if empty else 4)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert packed.count() == (0 if empty else 4 + 25)
