"""Operators on texts against brute force: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from dossier.llm import byte_bpe, license_scan, line_dedup, minhash, ngram_lm, packing, quality_classifier, quality_rules
from dossier.llm.shared import workers_see_us

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice(("the", "an", "ré", "io", "ZU", "k")) for _ in range(draw.randint(1, 3)))
    texts = [" ".join(word() for _ in range(draw.randint(1, 90))) for _ in range(60)]
    texts += [t + " tail" for t in texts[:20]] + texts[:5] + ["Common  line\n" + t + "\n  COMMON  line" for t in texts[5:17]]
    texts += [None, "", " \n\t", "x", "x", "y " * 30000, "é b " * 4, "a&&& b### " * 40]
    out = [(i, t, draw.choice(("en", "fr", None)), draw.choice(("s0", "s0", None)), len(t or "")) for i, t in enumerate(texts)]
    return out + [(None, "no id here", "en", "s0", None), (3, out[3][1], "en", "s0", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    workers_see_us(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_line_dedup(docs, empty, rows, batches):
    counts = Counter(k for r in rows for k in {_key(x) for x in (r[1] or "").split("\n")} if k)
    want = Counter()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if counts[_key(x)] < 10 or not _key(x)]
        want[r[0], "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    own = docs.withColumn("n_lines", docs["lang"]).withColumn("_k1", docs["lang"]).withColumn("_gone", docs["lang"])
    found = line_dedup.dedup_lines(own, 10, batches)
    assert found.columns == [*docs.columns, "_k1", "_gone", "n_lines", "n_dropped"]
    assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in found.collect()) == want
    assert sum(n for *_, n in want) > 20
    assert line_dedup.dedup_lines(empty).count() == 0


def test_runs_meet_without_moving(spark):
    """A batch meets runs and saturated keys by merge joins; only the batch's own counts are exchanged."""
    workers_see_us(spark)
    draw = random.Random(2)
    runs, true, written = line_dedup.LineRuns(spark, 10), Counter(), []
    run = runs._run
    runs._run = lambda rows: written.append(rows) or run(rows)
    for _ in range(4):
        lines = [[f"line {draw.randint(0, 400) ** 2 // 900}" for _ in range(4)] for _ in range(150)]
        true.update(x for own in lines for x in set(own))
        runs.add(spark.createDataFrame([("\n".join(own),) for own in lines], "text string").select(line_dedup.line_hashes(F.col("text")).alias("lines")))
    assert [len(level) for level in runs.levels] == [0, 0, 1] and len(runs.saturated) == 4
    want = spark.createDataFrame([(k,) for k, n in true.items() if n >= 10], "text string").select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"))
    got = runs.frequent()
    assert got.count() == want.count() > 20 and got.join(want, ["h1", "h2"], "left_anti").count() == 0
    for rows in written[1:]:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 1 and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def _shingles(text, width):
    words = (text or "").encode().lower().split()
    return set(zip(*(words[i:] for i in range(width)))) if len(words) >= width else ({tuple(words)} if words else set())


def test_minhash(docs, empty, rows):
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    sets = {i: _shingles(t, 2) for i, t in texts.items()}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    found = minhash.link(docs, 2, 80).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), find(r["doc_id"]), find(r["doc_id"]) == r["doc_id"])
    assert minhash.link(empty, 2, 80).count() == 0


@pytest.mark.parametrize("settings", [{}, {"bucket_chunk": 3}])
def test_minhash_crowds(spark, settings, monkeypatch):
    """Chains of texts around the threshold, equal sets in other orders, textual ids, ids that repeat with other texts."""
    workers_see_us(spark)
    draw = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    own, at = [], 0
    for _ in range(60):
        text = list(words)
        for _ in range(draw.randint(0, 7)):
            text[draw.randrange(60)] = f"x{draw.randrange(40)}"
        own.append((f"d{at // 2 if at % 9 == 1 else at:03d}", " ".join(text)))
        at += 1
    own += [("e1", "a b a b a"), ("e2", "b a b a b"), ("e3", "A  b a\nb a"), (None, own[0][1]), ("e4", ""), ("e5", None)]
    sets = [_shingles(t, 2) for _, t in own]
    top = list(range(len(own)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    order = sorted((i for i in range(len(own)) if own[i][0] is not None), key=lambda i: own[i][0])
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)), key=order.index)
                top[y] = x
    want = Counter((own[i][0], len(sets[i]), own[find(i)][0] if own[i][0] else None) for i in range(len(own)))
    blocks = minhash.blocks
    monkeypatch.setattr(minhash, "blocks", lambda *a, **k: blocks(*a, **k, chunk=7))
    docs = spark.createDataFrame(own, "doc_id string, text string").repartition(3)
    found = minhash.link(docs, 2, 80, **settings).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == want
    assert 5 < len({w[2] for w in want}) < 60


def test_shared_shingles():
    draw = random.Random(3)
    left, right = ([{draw.randrange(50) for _ in range(draw.randint(0, 40))} for _ in range(9)] for _ in range(2))
    assert minhash.shared_shingles(left, right, 16).tolist() == [[len(a & b) for b in right] for a in left]


def test_numbered_sets():
    draw = random.Random(4)
    texts = [" ".join(draw.choice("abcDd") for _ in range(draw.choice([0, 1, 2, 4, 5, 6, 30]))) for _ in range(40)]
    for width in (1, 2, 5):
        numbers, sets = minhash.numbered_sets(texts, width), [minhash.shingle_set(t, width) for t in texts]
        assert [len(n) for n in numbers] == [len(s) for s in sets]
        assert minhash.shared_shingles(numbers[:15], numbers[15:], 16).tolist() == [[len(a & b) for b in sets[15:]] for a in sets[:15]]
    assert minhash.numbered_sets([], 5) == [] and [len(n) for n in minhash.numbered_sets(["", ""], 5)] == [0, 0]


def test_equal_bits():
    draw = np.random.default_rng(5).integers(-(2**63), 2**63, (2, 6, 4), dtype=np.int64)
    bit = lambda w, i, j: int(w[j // 64 + 2 * i]) >> (j % 64) & 1
    want = [[sum(all(bit(x, i, j) == bit(y, i, j) for i in range(2)) for j in range(128)) for y in draw[1]] for x in draw[0]]
    assert minhash._equal_bits(*draw).tolist() == want


def test_keep_one_and_odd_columns(spark):
    workers_see_us(spark)
    own = spark.createDataFrame([("b", "x y z", 1, 2), ("a", "x y z", 3, 4), ("a", "x y z", 0, 9), ("c", None, 5, 6)], "doc_id string, text string, `a.b` int, _k1 int")
    found = minhash.keep_one(own)
    assert found.columns == own.columns and sorted(map(tuple, found.collect())) == [("a", "x y z", 0, 9), ("c", None, 5, 6)]


def test_keep_one_keeps_one_row_of_repeated_ids(spark):
    workers_see_us(spark)
    draw = random.Random(7)
    a, b, c = (" ".join(str(draw.randint(0, 999)) for _ in range(60)) for _ in range(3))
    own = [(1, a, "en", "s", 1)] * 3 + [(2, a, "en", "s", 1)] * 2 + [(3, b, "en", "t", 1), (3, b, "en", "s", 1), (4, c, None, "s", 1), (5, "", "en", "s", 0), (5, "", "en", "s", 0)]
    own += [(None, a, "en", "s", 1)] * 2
    found = minhash.keep_one(spark.createDataFrame(own, SCHEMA).repartition(3))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = Counter({(1, a, "en", "s", 1): 1, (3, b, "en", "s", 1): 1, (4, c, None, "s", 1): 1, (5, "", "en", "s", 0): 1, (None, a, "en", "s", 1): 2})
    assert Counter(tuple(r) for r in found.collect()) == want


def test_estimate_is_unbiased():
    h = np.random.default_rng(1).integers(0, 2**63, 4000, dtype=np.uint64)
    x, y = minhash.signature(h[:3000])[1], minhash.signature(h[1000:])[1]
    equal = 128 - sum((int((x[i] ^ y[i]) | (x[i + 2] ^ y[i + 2])) & (2**64 - 1)).bit_count() for i in range(2))
    assert abs((equal / 128 - 0.25) / 0.75 - 0.5) < 0.2


def test_byte_bpe(docs, rows):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coder = byte_bpe.ByteBPE.load(path, public_tokenizers.PATTERN)
    peer = tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    for text in ["", "a" * 20000, "ab" * 3000 + " " * 500, "<|endoftext|> it's 12\n\n x", "日本語" * 50]:
        assert coder.encode(text) == peer.encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()
    want = Counter()
    for r in rows:
        ids = peer.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in byte_bpe.digest_texts(docs, path).collect()) == want
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in byte_bpe.encode_texts(docs, path).where("doc_id = 7").collect()} == {7: rows[7][1]}


def test_packing(docs, empty, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    peer = Tokenizer.from_file(path)
    want = Counter()
    for r in rows:
        ids = np.array(peer.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            want[r[0], piece, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())] += 1
    found = packing.pack(docs, path).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= sum(r["length"] for r in found) // 2048 + 2
    assert packing.pack(empty, path).count() == 0


def test_odd_chunks_are_encoded_as_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = packing.WordCoder(path)
    for text in ["Ab, c.d e!? É. éa, x&&&. 3. a<|endoftext|>b. ＡＢ, ß. Ⅷ. ª. İ, K. a b, \x1ca. it's. I'M, don't! é. a.́ , ."]:
        assert np.frombuffer(coder.encode([text.encode()])[0], "<u4").tolist() == coder.encoder.encode(text, add_special_tokens=False).ids


def test_plan_places_every_piece():
    draw = random.Random(3)
    counts = Counter(draw.randint(1, 2048) for _ in range(5000)) + Counter({2048: 700, 1: 900})
    used, seen = Counter(), Counter()
    for length, first, n, sequence, offset in packing.plan(counts):
        seen[length] += n
        for s in range(sequence, sequence + n):
            used[s] += length
    assert seen == counts and max(used.values()) <= 2048
    assert len(used) <= -(-sum(k * v for k, v in counts.items()) // 2048) * 1.02 + 1  # the volume bound; pieces over half a sequence cannot reach it


def test_license_scan(docs, empty, spark):
    assert license_scan.scan(docs).where("n_base > 0").count() == 0
    texts = ["", None, "The GNU General\n Public-License, Apache license!", "mit licenses", "KIT MIT LICENSE mit license", "Licensed under CC BY-NC 4.0"]
    found = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found] == [
        (0, 0, None, None, ""), (0, 0, None, None, ""), (7, 2, 1, 5, "apache,gpl"), (2, 0, None, None, ""), (5, 2, 1, 3, "mit"), (7, 1, 2, 2, "cc-by"),
    ]
    assert found[5]["labels"] == "cc-by,cc-by-nc" and all(0 <= r["score"] <= 1 for r in found)
    assert license_scan.scan(empty).count() == 0


def test_license_templates(spark):
    """Whole, modified and cut templates; key phrases without the rest; the index words without the key phrase."""
    import duckdb

    draw = random.Random(4)
    text = {name: t for name, (_, _, t) in license_scan.TEMPLATES.items()}
    noise = " ".join(f"n{draw.randint(0, 500)}" for _ in range(20000))
    changed = text["mit"].replace("any person", "any and every natural person").replace("substantial portions", "large parts").replace("publish, ", "")
    texts = [text["mit"], noise + "\n" + text["zlib"] + "\n" + noise, changed, " ".join(text["isc"].split()[:40]), text["unlicense"].replace("unencumbered", "burdened"), text["boost"] + text["gpl-notice"]]
    texts += ["altered source versions must be plainly marked as such", text["mit"] * 300, "", None, text["mpl-notice"], text["mpl-notice"]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(df).collect()}
    assert [found[i]["templates"] for i in range(12)] == ["mit", "zlib", "mit", "", "", "boost,gpl-notice", "", "mit", "", "", "mpl-notice", "mpl-notice"]
    assert found[1]["labels"] == "zlib" and found[5]["labels"] == "boost,gpl,mit" and found[6]["labels"] == "" and found[0]["score"] == found[7]["score"] == 1
    assert 0.6 <= found[2]["score"] < 1 and found[8]["score"] == found[9]["score"] == 0
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.sql(license_scan.OP4_SQL)
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(found[i][c] for c in want.columns)) for i in range(12))


def test_licenses_that_share_a_file(spark):
    """Every pair of templates, four and all in one file, among noise: none is lost, whichever words are rarest."""
    import duckdb

    draw = random.Random(6)
    text = {name: t for name, (_, _, t) in license_scan.TEMPLATES.items()}
    names = sorted(text)
    sets = [{a, b} for i, a in enumerate(names) for b in names[i + 1 :]] + [set(draw.sample(names, 4)) for _ in range(8)] + [set(names)]
    noise = lambda: " ".join(draw.choice(license_scan.VOCABULARY + ["n1", "n2"]) for _ in range(60))
    texts = ["\n".join(text[n] + " " + noise() for n in draw.sample(sorted(own), len(own))) for own in sets]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(df).collect()}
    assert all(own <= set(found[i]["templates"].split(",")) for i, own in enumerate(sets))
    assert {license_scan.TEMPLATES[n][0] for n in names} <= set(found[len(sets) - 1]["labels"].split(","))
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.sql(license_scan.OP4_SQL)
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(found[i][c] for c in want.columns)) for i in range(len(sets)))


def _stats(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if x.encode().strip() and x in lines[:i])
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_quality_rules(docs, empty, rows):
    want = Counter((r[0], *_stats(r[1])) for r in rows)
    found = quality_rules.judge(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in found) == want
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.keep_regular(docs).columns == docs.columns
    assert quality_rules.judge(empty).count() == 0


def test_mcd_resists_contamination(spark):
    draw = np.random.default_rng(2)
    clean = draw.normal(0.5, 0.3, (800, quality_rules.DIMS))
    junk = draw.normal(5, 0.1, (150, quality_rules.DIMS))
    stats = spark.createDataFrame([("g", x.tolist()) for x in np.concatenate([clean, junk])], "_g string, x array<double>")
    row = quality_rules.mcd(stats).first()
    assert all(abs(row[f"m{i}"] - 0.5) < 0.08 for i in range(quality_rules.DIMS)) and abs(row["f0_0"] - 0.3) < 0.06


def _fast_mcd(x, starts, share=0.75):
    """Least log determinant over concentration steps from random subsets."""
    draw, best = np.random.default_rng(0), None
    h = int(share * len(x))
    for _ in range(starts):
        own = x[draw.choice(len(x), 7, replace=False)]
        last = np.inf
        while True:
            m, c = own.mean(0), np.cov(own.T, bias=True) + 1e-9 * np.eye(x.shape[1])
            z = x - m
            own = x[np.argsort(np.einsum("ij,jk,ik->i", z, np.linalg.inv(c), z))[:h]]
            now = np.linalg.slogdet(np.cov(own.T, bias=True))[1]
            if now > last - 1e-9:
                break
            last = now
        best = min(last, best) if best is not None else last
    return best


def test_mcd_comes_near_the_least_determinant(spark):
    draw = np.random.default_rng(3)
    mix = draw.normal(size=(quality_rules.DIMS, quality_rules.DIMS))
    groups = {"plain": draw.normal(size=(300, 5)) @ mix, "tails": draw.standard_t(3, (300, 5)) @ mix}
    groups["cluster"] = np.concatenate([draw.normal(size=(300, 5)) @ mix, 9 + 0.3 * draw.normal(size=(70, 5))])
    stats = spark.createDataFrame([(g, v.tolist()) for g, x in groups.items() for v in x], "_g string, x array<double>")
    grow = 0.75 / quality_rules._chi2_cdf(quality_rules._chi2_quantile(0.75, 5), 7)
    for row in quality_rules.mcd(stats).collect():
        best = _fast_mcd(groups[row["_g"]], 100) + 5 * np.log(grow)
        assert abs(row["logdet"] - best) < 0.25, row["_g"]  # 5 % of a standard deviation a coordinate


def test_rules_without_groups_and_with_odd_columns(spark):
    workers_see_us(spark)
    own = spark.createDataFrame([("a", "w " * 60, 1, 2), ("b", None, 3, 4), (None, "p q r " * 9, 5, 6)], "doc_id string, text string, `x.y` int, _k1 int")
    assert quality_rules.judge(own).count() == 3
    kept = quality_rules.keep_regular(own)
    assert kept.columns == own.columns and kept.count() == 0


@pytest.mark.parametrize("lang", ["en", "xx"])
def test_small_groups_are_judged_by_all_of_their_language(spark, lang):
    """Rows of a small source stand apart from a large one's in its language, or, in a rare language, from all."""
    workers_see_us(spark)
    draw = random.Random(8)
    text = lambda symbols: " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) + "#" * symbols for _ in range(120))
    own = [(i, text(0), "en", "large", 1) for i in range(100)]
    own += [(i, text(3), lang, "junk", 1) for i in range(200, 203)] + [(300, text(3), lang, "alone", 1), (301, text(0), lang, "fine", 1)]
    found = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(own, SCHEMA)).collect()}
    assert [i for i in found if not found[i]["kept"]] and {i for i in found if not found[i]["kept"] and i >= 200} == {200, 201, 202, 300}
    assert sum(not r["kept"] for r in found.values()) < 10


def test_junk_within_the_base_rules_is_rejected(spark):
    workers_see_us(spark)
    draw = random.Random(9)

    def text(upper=0.02, longer=0, symbols=0.0, repeat=0):
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8) + (draw.random() < longer) * 3)) for _ in range(300)]
        for _ in range(repeat):
            at, to = draw.randrange(0, 140), draw.randrange(150, 290)
            words[to : to + 6] = words[at : at + 6]
        flat = "".join(c.upper() if draw.random() < upper else "#" if c != " " and draw.random() < symbols else c for c in " ".join(words))
        return "\n".join(flat[i : i + 150] for i in range(0, len(flat), 150))

    own = [(i, text(), "en", "s", 1) for i in range(300)]
    own += [(1000 + i, text(upper=0.15), "en", "s", 1) for i in range(3)] + [(2000 + i, text(longer=0.6), "en", "s", 1) for i in range(3)]
    own += [(3000 + i, text(symbols=0.03), "en", "s", 1) for i in range(3)] + [(4000 + i, text(upper=0, repeat=9), "en", "s", 1) for i in range(3)]
    found = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(own, SCHEMA)).collect()}
    assert not any(r["base_failed"] for r in found.values())
    assert not any(r["kept"] for i, r in found.items() if i >= 1000)
    assert sum(not r["kept"] for i, r in found.items() if i < 300) <= 6


def test_classifier_separates_and_uses_the_identity(spark, docs):
    draw = random.Random(1)
    texts = [(" ".join(draw.choice(("alpha", "beta", "gamma")) + str(draw.randint(0, 99)) for _ in range(80)) if i % 2 else "JUNK!! " * 60) for i in range(300)]
    own = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(own, labels)
    held = quality_classifier.classify(own, model).where(quality_classifier.remainder(F.col("doc_id")) == 0)
    assert held.where("predicted <> doc_id % 2").count() == 0
    at, x = quality_classifier.features("some Text here", 14)
    dense = np.zeros(quality_classifier.WIDTH)
    dense[at] = x
    pairs = sum(model.v[i] @ model.v[j] * dense[i] * dense[j] for k, i in enumerate(at) for j in at[k + 1 :])
    assert abs(model.raw(at, x) - (model.bias + model.w @ dense + pairs)) < 1e-9
    extra = quality_classifier.classify(docs.withColumnRenamed("lang", "score"), model)
    assert all(0 <= r["score"] <= 1 for r in extra.collect()) and extra.count() == docs.count()
    assert abs(quality_classifier.fit(own, labels.limit(0)).score(at, x) - 0.5) < 0.01  # nothing learned


def test_classifier_odd_tables(spark, empty):
    model = quality_classifier.FactorisationMachine()
    own = spark.createDataFrame([("a", "x y", "no", 1, 2.0), (None, None, None, 2, 3.0)], "doc_id string, text string, n_chars string, `a.b` int, score double")
    kept = quality_classifier.keep_good(own, model, 0.0)
    assert kept.columns == own.columns and sorted(map(str, kept.collect())) == sorted(map(str, own.collect()))
    assert quality_classifier.classify(empty, model).count() == 0 and quality_classifier.keep_good(empty, model).columns == empty.columns
    twice = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0)], "doc_id string, quality int")
    assert np.isfinite(quality_classifier.fit(own.union(own), twice).bias)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_classifier_on_held_out_labels(spark):
    found = quality_classifier.op7_quality_classifier(spark, "/root/testdata/sf0.01").where("held_out")
    rows = found.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("quality is not null").select("score", "predicted", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert len(good) > 20 and len(bad) > 8
    assert auc > 0.9 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.85, auc


def _brute_lm(train, texts, order, least=2, d=0.75):
    toks = lambda t: [*(t or "").encode().lower().split(), b""]
    grams = {n: Counter() for n in range(1, order + 1)}
    for t in train:
        w = toks(t)
        for n in grams:
            grams[n].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    n_all, kinds = sum(grams[1].values()), len(grams[1])
    kept = {1: grams[1]} | {n: {g: c for g, c in grams[n].items() if c >= least} for n in range(2, order + 1)}
    code = lambda p: -0.05 * min(255, max(0, np.rint(-np.log10(p) / 0.05)))
    mass = {n: Counter() for n in range(2, order + 1)}
    for n in mass:
        for g, c in kept[n].items():
            mass[n][g[:-1]] += (c - d) / kept[n - 1][g[:-1]]
    out = []
    for t in texts:
        w, base, best = toks(t), 0.0, 0.0
        for i in range(len(w)):
            low = np.log10((grams[1][(w[i],)] + 0.5) / (n_all + 0.5 * (kinds + 1)))
            p = code(10**low)
            for n in range(2, order + 1):
                if i - n + 1 < 0:
                    break
                g = tuple(w[i - n + 1 : i + 1])
                if g in kept[n]:
                    p = code((kept[n][g] - d) / kept[n - 1][g[:-1]])
                elif g[:-1] in mass[n]:
                    p += code(max(1e-12, 1 - mass[n][g[:-1]]))
            base, best = base + low, best + p
        out.append((len(w), n_all, base, best))
    return out


@pytest.mark.parametrize("order,least,block", [(2, 2, 2_000_000), (3, 1, 50), (3, 2, 50)])
def test_ngram_lm(spark, docs, empty, rows, order, least, block, monkeypatch):
    monkeypatch.setattr(ngram_lm, "MOST_OPEN", 3)
    own = [r for r in rows if r[0] is not None and r[0] != 3]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    df = spark.createDataFrame(own, SCHEMA)
    about = ngram_lm.train(df.where(ngram_lm.remainder(F.col("doc_id")) != 1), order=order, least=least, block_tokens=block)
    want = _brute_lm([r[1] for r in own if not held(r[0])], [r[1] for r in own], order, least)
    found = {r["doc_id"]: r for r in ngram_lm.score(df, about).collect()}
    for r, (n, total, base, best) in zip(own, want):
        got = found[r[0]]
        assert (got["n_tokens"], got["train_tokens"]) == (n, total)
        assert abs(got["base_score"] - base) < 1e-6 * max(1, -base) and abs(got["score"] - best) < 1e-6 * max(1, -best)
    nothing = ngram_lm.train(empty)
    assert ngram_lm.score(empty, nothing).count() == 0
    assert [r["score"] for r in ngram_lm.score(df.where("doc_id = 1"), nothing).collect()] == [0.0]  # probability 1 of every token


def test_ngram_lm_nulls_and_repeats(spark):
    """Repeated rows count as often as they occur; a null id is the text "", whose remainder is 0."""
    own = [(None, "a b c"), (None, "a b c"), (2, None), (2, None), (3, "A  b\nz"), (3, "A  b\nz"), (4, "")]
    df = spark.createDataFrame(own, "doc_id long, text string")
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    assert not held(None)
    about = ngram_lm.train(df.where(ngram_lm.remainder(F.col("doc_id")) != 1))
    want = Counter((i, n, total, round(base, 6), round(best, 6)) for (i, _), (n, total, base, best) in zip(own, _brute_lm([t for i, t in own if not held(i)], [t for _, t in own], 3, 1)))
    assert Counter((r["doc_id"], r["n_tokens"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in ngram_lm.score(df, about).collect()) == want


def test_elias_fano():
    draw = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (5, 100), (1000, 10**6), (2000, 2**64 - 1), (500, 300)):
        v = np.sort(draw.integers(0, top, n, dtype=np.uint64, endpoint=True))
        coded = ngram_lm.EliasFano.encode(v)
        assert n == 0 or (coded.get(np.arange(n)) == v).all()
        q = np.concatenate([draw.integers(0, top, 300, dtype=np.uint64, endpoint=True), v])
        assert (coded.successor(q) == np.searchsorted(v, q)).all()
