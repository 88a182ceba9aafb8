"""Maximal segments against their definition; planted toxic words found, and nothing else."""

from __future__ import annotations

import random
import zlib

import numpy as np

from palaver.llm import toxicity

KIND = "doc_id long, text string, lang string, score long, `Text` string"


def split(scores, base=0):
    """The best segment, then the same left and right of it."""
    sums = np.concatenate([[0], np.cumsum(scores)])
    best = max(((sums[j] - sums[i], -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return split(scores[:i], base) + [(base + i, base + j - 1, int(best[0]))] + split(scores[j:], base + j)


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 30, 60):
        for _ in range(30):
            s = rng.integers(-1000, 900, n)
            assert toxicity.segments(s) == split(s)
    assert toxicity.segments(np.array([-1, -2])) == []
    assert sum(x[2] for x in toxicity.segments(np.full(50_000, 3))) == 150_000


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abdehiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    bad = ["grobklotz", "schurkel", "wichtikus"]
    rows, labels, where = [], [], {}
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 300))]
        toxic = i % 5 == 2
        if toxic:
            for _ in range(3):
                words.insert(rng.randint(0, len(words)), rng.choice(bad) + rng.choice(["", "ung", "HEIT", "!"]))
            where[i] = [w for w in words if any(w.startswith(b) for b in bad)]
        rows.append((i, " ".join(words), "en", i, "x"))
        labels.append((i, int(toxic), 1))
    return rows, labels, where


def test_planted_words(spark):
    rows, labels, where = corpus()
    rows += [(9001, None, None, None, None), (9002, "", "en", 1, "x"), (9003, " \n,;", "en", 1, "x"), (None, rows[2][1], "en", 1, "x"), rows[4], rows[4]]
    rows += [(9004 + i, rows[3][1], "en", 1, "x") for i in range(200)]  # copies of a clean text
    labels += [(9001, None, 1), (9002, 0, 1), (9003, 0, 1), (9005, 0, 0), (2, 1, 0), (2, 0, 0)]
    docs, marks = spark.createDataFrame(rows, KIND).repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int, Text int")
    model = toxicity.train(docs, marks)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == held and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    wrong = [r["doc_id"] for r in got if r["doc_id"] is not None and r["predicted"] != (r["doc_id"] in where)]
    assert len(wrong) <= 6 and not [i for i in wrong if i >= 9000]
    text = {r[0]: r[1] for r in rows}
    found = toxicity.passages(docs, model, expected=0.5).collect()
    hit = {i: " ".join(text[i][r["begin"] : r["end"]] for r in found if r["doc_id"] == i) for i in where}
    missed = sum(w.rstrip("!") not in hit[i] for i, words in where.items() for w in words)
    assert missed <= 0.1 * sum(map(len, where.values()))
    assert all(r["expected"] <= 0.5 for r in found)


def test_held_out_labels_are_not_read(spark):
    rows, labels, _ = corpus(200)
    docs = spark.createDataFrame(rows, KIND)
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, q) for i, t, q in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id long, toxic int, quality int")) for x in (labels, turned))
    assert (a.keys == b.keys).all() and (a.values == b.values).all() and (a.rate, a.k, a.slope, a.offset) == (b.rate, b.k, b.slope, b.offset)


def test_token_scores_by_hand(spark):
    """A token's score from its counts by the stated formula."""
    texts = [("badword here", 1)] * 8 + [("plain words here", 0)] * 9 + [("badword", 0)]
    frame = spark.createDataFrame([(f"{t} w{i}", y) for i, (t, y) in enumerate(texts)], "text string, toxic int")
    model = toxicity._table(frame, 0.1, 1.0, 1000)
    tokens = lambda t: sum(len(w) - 3 if 4 <= len(w) <= 10 else 0 for w in t.split()) + len(t.split())
    n1, n0 = (sum(tokens(f"{t} w{i}") for i, (t, y) in enumerate(texts) if y == kind) for kind in (1, 0))
    a, b = 8, 1
    own, mass = 0.1 * (a + b), 0.1 * (n1 + n0)
    raw = np.log((a + own) / (n1 + mass - a - own)) - np.log((b + own) / (n0 + mass - b - own))
    want = round((raw - np.sqrt(1 / (a + own) + 1 / (b + own))) * 8)
    import pyarrow as pa

    from palaver.llm.blocks import blocks

    b0 = next(iter(blocks(pa.array(["badword"]))))
    assert model.scores(toxicity.words(b0)).tolist() == [want]


def test_without_labels(spark):
    docs = spark.createDataFrame([("a", "some text", "en", 1, "x"), ("b", None, "en", 1, "x")], KIND.replace("doc_id long", "doc_id string"))
    none = spark.createDataFrame([], "doc_id string, toxic int")
    got = toxicity.classify(docs, none).collect()
    assert [round(r["score"], 6) for r in got] == [0.05, 0.05]
    assert toxicity.classify(docs.limit(0), none).count() == 0
    assert toxicity.passages(docs, toxicity.train(docs, none)).count() == 0


def test_letters_of_scripts():
    import pyarrow as pa

    from palaver.llm.blocks import blocks

    texts = ["Ärger, ÄRGER", "", "漢字仮名交", None, "a\x00b"]
    (b,) = blocks(pa.array(texts))
    found = toxicity.words(b)
    whole = dict(zip(*found.tokens[-1], strict=True))
    assert whole[0] == whole[1] and found.owner.tolist() == [0, 0, 2, 2, 2, 2, 2, 4, 4]
    assert found.at.tolist()[:2] == [0, 7] and found.length.tolist()[:2] == [5, 5]
