"""Every source is taken to its own target, also where a block holds many times its words."""

from __future__ import annotations

from collections import Counter

from palaver.llm import mixing


def test_small_sources_reach_their_own_targets(spark):
    rows = [(i, "word " * 200, f"big{i % 2}") for i in range(100)]
    rows += [(200 + i, "rare words here", "small") for i in range(4)] + [(300, "one", None), (301, "a b c d e", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, slots=64).collect()
    taken, target = Counter(), {}
    for r in out:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert target["small"] == 36 and target["tiny"] == 15 and target[None] == 3
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    times = Counter(r["source"] for r in mixing.mixed_documents(docs, slots=64).collect())
    assert (times["small"], times["tiny"], times[None]) == (12, 3, 3)


def test_texts_go_to_workers_a_thousand_at_a_time(spark, monkeypatch):
    """Sizes are counted while Arrow batches are small, and the setting is as before afterwards."""
    key, seen, real = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, mixing.saved
    before = spark.conf.get(key)
    monkeypatch.setattr(mixing, "saved", lambda df, name: seen.update({name: spark.conf.get(key)}) or real(df, name))
    mixing.mix(spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, source string"))
    assert seen["mix-sizes"] == "1000" and spark.conf.get(key) == before
