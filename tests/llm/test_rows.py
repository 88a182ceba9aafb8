"""Odd rows through every operator and stage: nulls, empty tables, repeated rows, clashing names, long texts, other id types."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from palaver.llm import backoff, bpe, fingerprints, line_dedup, mixing, near_dup, omh, pu_quality, quality_rules, repeats, token_counts  # noqa: E402
from palaver.llm.blocks import blocks, opened  # noqa: E402
from palaver.llm.registry import vocabulary  # noqa: E402

KIND = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "Text string, ids long, decoded long, `drop` long, key long, band string, mix_copy long, kept_doc long, DOC_ID long, `c.d` long"


def text_of(rng, n):
    return " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 8))) for _ in range(n))


def rows_of():
    rng = random.Random(2)
    out = [(i, "\n".join(text_of(rng, rng.randint(5, 30)) for _ in range(rng.randint(1, 4))), "en", f"s{i % 3}", 1) for i in range(40)]
    line = "this line is in many of the documents, word for word"
    out = [(i, t + "\n" + line if i % 3 == 0 else t, *r) for i, t, *r in out]
    out += [out[5], out[5], (None, out[6][1], "en", "s0", 1), (None, None, None, None, None), (50, None, "en", "s1", None), (51, "", None, "s1", 0), (52, text_of(rng, 40_000), "en", None, 1)]
    out += [(60, out[7][1], "en", "s1", 1), (7, out[8][1], "en", "s2", 1)]
    return out


def labels_of(spark):
    return spark.createDataFrame([(i, i % 2, 0, "x") for i in range(40)], "doc_id long, quality int, toxic int, Doc_ID string")


def pick(df, *names):
    return opened(df, *names)[0].select(*names)


OPERATORS = {
    "op1": lambda d: pu_quality.classify(d, labels_of(d.sparkSession), sample=50).select("doc_id", "held_out"),
    "op2": lambda d: line_dedup.line_report(d),
    "op3": lambda d: repeats.remove_repeats(d),
    "op4": lambda d: fingerprints.with_neighbours(d),
    "op5": lambda d: near_dup.classes(d),
    "op6": lambda d: mixing.mix(d),
    "op7": lambda d: pick(bpe.encode(d, *vocabulary(), decoded="decoded"), "doc_id", "ids", "decoded"),
    "op8": lambda d: quality_rules.judge(d),
    "op9": lambda d: backoff.scores(d),
    "op10": lambda d: pick(token_counts.apply_edits(token_counts.build(token_counts.three_edits(d), *vocabulary()), *vocabulary()), "doc_id", "text", "n_after"),
}
KEEPERS = {
    "filter": quality_rules.quality_filter, "lines": line_dedup.dedup_lines, "near": near_dup.drop_near_duplicates, "mixed": mixing.mixed_documents,
    **{name: (lambda d, f=f: f(d.sparkSession, d, "")) for name, f in corpus_pipeline.STAGES[:-1]},
}


def plain(rows):
    return Counter(str([bytes(x) if isinstance(x, bytearray) else x for x in r]) for r in rows)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(), KIND).repartition(3).cache()


def clashing(docs):
    extra = [f"cast(null as {t}) as {n}" for n, t in (c.rsplit(" ", 1) for c in CLASH.split(", "))]
    return docs.selectExpr("*", *extra)


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_take_odd_rows(spark, docs, name):
    want = OPERATORS[name](docs).collect()
    assert len(want) == len(rows_of())
    assert plain(OPERATORS[name](clashing(docs)).collect()) == plain(want)
    empty = OPERATORS[name](docs.limit(0))
    assert empty.count() == 0 and empty.columns == OPERATORS[name](docs).columns


@pytest.mark.parametrize("name", KEEPERS)
def test_stages_keep_all_columns(spark, docs, name):
    want = KEEPERS[name](docs).collect()
    clash = clashing(docs)
    got = KEEPERS[name](clash)
    assert got.columns == clash.columns
    assert plain(r[: len(docs.columns)] for r in got.collect()) == plain(want)
    assert KEEPERS[name](docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op2", "op4", "op5", "op6", "op7", "op8", "op9"])
def test_ids_may_be_strings(spark, docs, name):
    named = docs.withColumn("doc_id", docs["doc_id"].cast("string"))
    assert OPERATORS[name](named).count() == len(rows_of())


def test_tokens_of_the_last_stage(spark, docs):
    out = corpus_pipeline.STAGES[-1][1](spark, clashing(docs), "")
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]
    assert Counter(r["decoded_sha256"] for r in out.collect()) == Counter(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows_of())


def test_hot_line_and_hot_passage(spark):
    rng = random.Random(4)
    line, passage = text_of(rng, 12), text_of(rng, 60)
    rows = [(i, (line + "\n" if i % 2 else "") + text_of(rng, 30) + (" " + passage + " " + text_of(rng, 30) if i % 3 == 0 else ""), "en", "s", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, KIND).repartition(5)
    out = {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_report(docs).collect()}
    assert sum(out.values()) == 149 and out[299] == 0
    line_dedup.FEW_KEYS, few = 0, line_dedup.FEW_KEYS
    try:
        assert {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_report(docs).collect()} == out
    finally:
        line_dedup.FEW_KEYS = few
    seen = Counter(t.encode()[p : p + 200] for _, t, *_ in rows for p in range(len(t.encode()) - 199))
    for r in repeats.remove_repeats(docs).collect():
        t = rows[r["doc_id"]][1].encode()
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - 199):
            if seen[t[p : p + 200]] > 1:
                gone[p : p + 200] = True
        assert bytes(r["kept"]) == bytes(np.frombuffer(t, np.uint8)[~gone])


def order_minhash(items, m=64, ell=2):
    """By the definition: occurrence-numbered items in m classes, the ell least of each in text order."""
    seen, tagged = Counter(), []
    h = np.array(items, dtype=np.uint64)
    number = np.array([(seen.update([x]), seen[x])[1] for x in items], dtype=np.uint64)
    if len(h):
        tagged = omh.mix(h + number * np.uint64(0xA0761D6478BD642F)).tolist()
    out = [0] * m
    for c in range(m):
        own = sorted((v, i) for i, v in enumerate(tagged) if v >> (64 - m.bit_length() + 1) == c)[:ell]
        if own:
            t = np.array([0x9E3779B97F4A7C15], dtype=np.uint64)
            picked = [v for _, v in sorted((i, v) for v, i in own)]
            for v in picked + [0] * (ell - len(picked)):
                t = omh.mix(t * np.uint64(0x9E3779B97F4A7C15) + np.uint64(v))
            out[c] = max(1, int(t[0]))
    return out


def test_sketches_are_order_minhash(spark, docs):
    import pyarrow as pa

    rng = random.Random(11)
    texts = ["", "ab", "abcdefghijkl", "abcabc" * 40, text_of(rng, 20), text_of(rng, 900)]
    full = []
    for b in blocks(pa.array(texts)):
        h, doc = omh.byte_kmers(b, 12)
        got = omh.sketch(h, doc, b.n)
        for i in range(b.n):
            full.append(order_minhash(h[doc == i].tolist()))
            assert got[i].tolist() == full[-1]
    short = [[0 if x == 0 else x % 65_535 + 1 for x in f] for f in full]
    assert fingerprints.sketches(pa.array(texts)).tolist() == short
    for a in range(len(texts)):
        for b in range(len(texts)):
            some = [(x, y) for x, y in zip(short[a], short[b]) if x or y]
            want = math.sqrt(sum(x == y for x, y in some) / len(some)) if some else 1.0
            assert math.isclose(omh.likeness(np.array([short[a]]), np.array([short[b]]), 2)[0], want)


def test_near_columns_of_fingerprints(spark):
    rng = random.Random(12)
    rows = [(i, text_of(rng, rng.randint(0, 200))) for i in range(30)]
    out = {r["doc_id"]: r for r in fingerprints.with_neighbours(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}

    def parsed(x):
        return np.array([[int(x[i : i + 4], 16) for i in range(0, len(x), 4)]])

    import pyarrow as pa

    for i, t in rows:
        following = rows[(i - 1) % 30]
        new = fingerprints.edited(t, following[1])
        prints = [fingerprints.sketches(pa.array([x])) for x in (t, new, following[1])]
        r = out[i]
        assert (parsed(r["fingerprint"]) == prints[0]).all() and (parsed(r["edited_fingerprint"]) == prints[1]).all()
        assert math.isclose(r["near_edited"], omh.likeness(prints[0], prints[1], 2)[0]) and math.isclose(r["near_next"], omh.likeness(prints[0], prints[2], 2)[0])


def test_non_negative_risk_and_prior():
    rng = np.random.default_rng(5)
    good, bad = rng.normal(1.5, 1, (4000, 3)), rng.normal(-1.5, 1, (4000, 3))
    u = np.concatenate([rng.normal(1.5, 1, (1600, 3)), bad[:2400]])
    prior = pu_quality.estimate_prior(good, u)
    assert abs(prior - 0.4) < 0.08
    net = pu_quality.fit(good, u, prior)
    assert (net.score(good) >= 0.5).mean() > 0.95 and (net.score(bad) < 0.5).mean() > 0.95
    # The gradient of each part of the risk against differences.
    z = net.standard(u[:50])
    h, g = net.forward(z)
    grad = net.gradient(z, h, pu_quality.sigmoid(g) / 50)
    for w, d in zip(net.w, grad, strict=True):
        at = tuple(0 for _ in w.shape)
        keep, step = w[at], 1e-5
        w[at] = keep + step
        up = np.logaddexp(0, net.forward(z)[1]).mean()
        w[at] = keep - step
        down = np.logaddexp(0, net.forward(z)[1]).mean()
        w[at] = keep
        assert math.isclose((up - down) / (2 * step), d[at], rel_tol=1e-4, abs_tol=1e-8)


def test_edits_encode_little(spark):
    text = " ".join(f"word{i}" for i in range(5_000))
    trees = token_counts.build(token_counts.three_edits(spark.createDataFrame([(1, text)], "doc_id long, text string")), *vocabulary())
    r = token_counts.apply_edits(trees, *vocabulary()).first()
    assert 0 < r["n_encoded"] < 400 < len(r["leaf_tokens"])


def test_backoff_by_brute_force(spark, docs):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    rows = [(r["doc_id"], word.findall(r["text"] or "")) for r in docs.collect()]
    for order in (1, 2, 3):
        count, held = Counter(), Counter()
        for _, w in rows:
            own = Counter(tuple(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1))
            count.update(own)
            held.update(own.keys())
        n = sum(len(w) for _, w in rows)
        count[()] = n
        want = []
        for i, w in rows:
            s = 0.0
            for j in range(len(w)):
                for k in range(min(order, j + 1), 0, -1):
                    g = tuple(w[j - k + 1 : j + 1])
                    if held[g] > 1:
                        s += math.log(count[g] / count[g[:-1]]) + (order - k) * math.log(0.4)
                        break
                else:
                    s += order * math.log(0.4) - math.log(n)
            want.append((str(i), len(w), s))
        got = sorted((str(r["doc_id"]), r["n_words"], r["score"]) for r in backoff.scores(docs, order).collect())
        for a, b in zip(got, sorted(want), strict=True):
            assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-6, abs_tol=1e-5 * (1 + a[1]))


def test_backoff_is_the_same_in_many_chunks(spark, docs, monkeypatch):
    want = plain(backoff.scores(docs).collect())
    for name, n in {"CHUNK": 3, "PACK": 2_000, "PART": 1_500}.items():
        monkeypatch.setattr(backoff, name, n)
    assert plain(backoff.scores(docs).collect()) == want


def test_backoff_moves_few_bytes_an_ngram(spark):
    rng = random.Random(9)
    n_docs, n_words = 300, 300
    texts = spark.createDataFrame([(i, text_of(rng, n_words)) for i in range(n_docs)], "doc_id long, text string").coalesce(1)
    status, bus = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().listenerBus()

    def written():
        bus.waitUntilEmpty(30_000)
        return status.executorList(True).head().totalShuffleWrite()

    before = written()
    backoff.scores(texts).write.format("noop").mode("overwrite").save()
    assert written() - before < 12 * n_docs * (3 * n_words - 3)
