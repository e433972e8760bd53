"""What near-dedup may send through the driver."""

from __future__ import annotations

from dossier.llm import components as cc
from dossier.llm import minhash, shared


def test_guessed_broadcasts_are_off_inside_only(spark):
    small = spark.range(10)
    plan = lambda: spark.range(10).join(small, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    with shared.counted_broadcasts(spark):
        assert "BroadcastHashJoin" not in plan()
    assert "BroadcastHashJoin" in plan()


def test_rows_beyond_the_count_are_shuffled(spark):
    joined = lambda most: spark.range(10).join(shared.broadcast_if_few(spark.range(10), most), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in joined(10) and "SortMergeJoin" in joined(9)


def test_rounds_of_components_broadcast_nothing(spark, monkeypatch):
    plans = []
    write = cc.cut

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(cc, "cut", kept)
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)], "u long, v long")
    assert {tuple(r) for r in cc.components(edges).collect()} == {(i, 0) for i in range(7)}
    assert len(plans) > 2 and not any("Broadcast" in p for p in plans)


def test_near_dedup_is_the_same_when_shuffled(spark, monkeypatch):
    monkeypatch.setattr(minhash, "FEW", 0)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join([*words, "more"]), " ".join(words).upper(), "other words only here", None, " ".join(["head", *words])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: (r["component_id"], r["kept"]) for r in minhash.link(docs, 2, 80).collect()} == {0: (0, True), 1: (0, False), 2: (0, False), 3: (3, True), 4: (4, True), 5: (0, False)}
