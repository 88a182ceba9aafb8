"""The training-data operators against brute force, on fixtures with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

tiktoken = pytest.importorskip("tiktoken")
import public_tokenizers as P  # noqa: E402

from palaver.llm import bpe, fingerprints, line_dedup, mixing, near_dup, omh, pu_quality, repeats, token_counts  # noqa: E402
from palaver.llm.blocks import blocks  # noqa: E402

VOCABULARY = P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def sentence(rng, n=12):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "é", "ß"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def fixture(n=60, seed=5):
    rng = random.Random(seed)
    shared = [sentence(rng, 14) for _ in range(3)]
    passage = sentence(rng, 60)
    out = []
    for i in range(n):
        lines = [sentence(rng) for _ in range(rng.randint(1, 6))]
        if i % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), "  " + shared[i % 3].upper().replace("É", "é") + "\t")
        if i % 9 == 0:
            lines.append(passage)
        out.append((i, "\n".join(lines), "en" if i % 2 else None, f"s{i % 4}" if i % 5 else None, 0, "e"))
    for i in range(6):  # copies, exact and near
        out.append((n + i, out[7][1], "en", "s1", 0, None))
        words = out[11][1].split(" ")
        words[i] = f"other{i}"
        out.append((n + 10 + i, " ".join(words), "en", "s1", 0, None))
    out += [(n + 30, None, None, None, None, None), (n + 31, "", "en", "", 0, ""), (n + 32, " \n\n ", "xx", "s0", 0, ""), (n + 33, "ü" * 30_000, "en", "s2", 0, ""), (n + 34, "word " * 6_000, "en", "s2", 0, "")]
    out += [out[3], (None, "no id here", "en", "s3", 0, "x")]  # a repeated row, a missing id
    return out


@pytest.fixture(scope="module")
def rows():
    return fixture()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


def got(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def test_line_dedup(docs, rows, empty):
    held: dict[bytes, set] = {}
    split = [(i, (t or "").encode().split(b"\n")) for i, t, *_ in rows]
    for i, lines in split:
        for line in lines:
            key = line.strip(b" \t\n\x0b\x0c\r").lower()
            if len(key.decode()) >= 40:
                held.setdefault(key, set()).add(i)
    low = lambda i: -1 if i is None else i
    repeated = {k: max(v, key=low) for k, v in held.items() if len(v - {None}) >= 5}
    want = Counter()
    for i, lines in split:
        keep = [x for x in lines if (k := x.strip(b" \t\n\x0b\x0c\r").lower()) not in repeated or repeated[k] == i]
        want[i, len(lines), len(lines) - len(keep), hashlib.sha256(b"\n".join(keep)).hexdigest()] += 1
    assert sum(c for (_, _, d, _), c in want.items() if d) > 5
    assert got(line_dedup.line_report(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == want
    assert line_dedup.dedup_lines(docs).columns == docs.columns
    assert line_dedup.dedup_lines(docs).count() == len(rows)
    assert line_dedup.line_report(empty).count() == 0


def test_repeats(docs, rows, empty):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(t[p : p + 200] for _, t in texts for p in range(len(t) - 199))
    want = Counter()
    for i, t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for p in range(len(t) - 199):
            if seen[t[p : p + 200]] > 1:
                gone[p : p + 200] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[: len(t)]])
        want[i, len(t), int(gone.sum()), runs, kept] += 1
    out = Counter((r["doc_id"], len(r["kept"]) + sum(s["end"] - s["begin"] for s in r["removed"]), sum(s["end"] - s["begin"] for s in r["removed"]), len(r["removed"]), bytes(r["kept"])) for r in repeats.remove_repeats(docs).collect())
    assert out == want
    assert repeats.remove_repeats(empty).count() == 0


def test_columns_agree_with_pairs():
    rng = np.random.default_rng(3)
    rows_ = rng.integers(0, 3, (40, repeats.CONTEXT)).astype(np.uint8)
    for i in range(1, 40, 2):  # neighbours share a stretch
        a = rng.integers(0, 140)
        n = 190 + int(rng.integers(0, 20))
        rows_[i, a : a + n] = rows_[i - 1, a : a + n]
    low, high = np.zeros(40, dtype=np.int32), np.full(40, repeats.CONTEXT, dtype=np.int32)
    low[4], high[7] = 30, 300
    first, last = repeats.repeated_windows(rows_, low, high)
    for i in range(40):
        own = [c for c in range(137) if low[i] <= c and c + 200 <= high[i] and any(j != i and low[j] <= c and c + 200 <= high[j] and np.array_equal(rows_[i, c : c + 200], rows_[j, c : c + 200]) for j in range(40))]
        assert (first[i], last[i]) == ((own[0], own[-1]) if own else (-1, -1))


def test_near_duplicates(docs, rows, empty):
    out = {r["doc_id"]: r["class_id"] for r in near_dup.classes(docs).collect()}
    assert out.pop(None) is None
    assert {out[60 + i] for i in range(6)} == {7}
    assert {out[70 + i] for i in range(6)} == {11}
    assert out[90] == out[91] == 90  # the null text is the empty text
    assert len(set(out.values())) >= 55
    assert near_dup.classes(empty).count() == 0
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id is null").count() == 1
    ids = [r["doc_id"] for r in kept.filter("doc_id is not null").collect()]
    assert set(ids) == {c for i, c in out.items()}


def test_banded_distance():
    rng = random.Random(2)
    for _ in range(2000):
        a = [rng.randint(0, 4) for _ in range(rng.randint(0, 25))]
        b = [rng.choice([x, 9]) if rng.random() < 0.2 else x for x in a if rng.random() > 0.1]
        before = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
            before = now
        k = rng.randint(0, 30)
        d = near_dup.banded_distance(a, b, k)
        assert (d <= k) == (before[-1] <= k) and (d > k or d == before[-1])


def test_components_of_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (105, 101)], "b long, a long")
    out = {r["text_id"]: r["class_id"] for r in near_dup.components(links).collect()}
    assert out == {i: 1 for i in range(2, 41)} | {101: 100, 105: 100}


def test_fingerprints(spark, docs, rows, empty):
    ordered = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or ""), reverse=True)
    texts = [r[1] or "" for r in ordered]
    want = Counter((r[0], len(t), hashlib.sha256(fingerprints.edited(t, n).encode()).hexdigest()) for r, t, n in zip(ordered, texts, texts[1:] + texts[:1]))
    df = fingerprints.with_neighbours(docs.filter("doc_id is not null")).cache()
    assert got(df, "doc_id", "n_chars", "edited_sha256") == want
    prints = {r["doc_id"]: r for r in df.collect()}
    assert prints[60]["fingerprint"] == prints[7]["fingerprint"] == prints[65]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in prints.values())
    assert np.mean([r["near_edited"] for r in prints.values()]) > np.mean([r["near_next"] for r in prints.values()])
    assert fingerprints.with_neighbours(empty).count() == 0
    single = spark.createDataFrame([(1, "abcdef", "", "", 6, "")], KIND)
    assert got(fingerprints.with_neighbours(single), "doc_id", "edited_sha256") == Counter({(1, hashlib.sha256(b"abcdab").hexdigest()): 1})


def test_sketch_is_of_the_text_alone():
    import pyarrow as pa

    rng = random.Random(4)
    texts = [sentence(rng, rng.randint(0, 900)) for _ in range(40)]
    alone = [fingerprints.sketches(pa.array([t]))[0].tolist() for t in texts]
    assert fingerprints.sketches(pa.array(texts)).tolist() == alone
    moved = " ".join(reversed(texts[5].split(" ")))
    assert fingerprints.sketches(pa.array([moved]))[0].tolist() != alone[5]


def test_occurrences():
    h = np.array([5, 7, 5, 5, 7, 5], dtype=np.uint64)
    assert omh.occurrences(h, np.array([0, 0, 0, 1, 1, 1])).tolist() == [0, 0, 1, 0, 0, 1]


def test_mixing(spark, docs, rows, empty):
    sizes = {k: sum(len(WORD.findall(t or "")) for _, t, _, s, *_ in rows if s == k) for k in {r[3] for r in rows}}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    total, weights = sum(sizes.values()), {s: 1 + i % 3 for i, s in enumerate(names)}
    target, free = {}, set(names)
    while True:
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            free.discard(s)
    out = mixing.mix(docs).cache()
    taken = Counter()
    for r in out.collect():
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], target[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.02 * total for s in names)
    assert out.count() == len(rows)
    again = mixing.mix(docs)
    assert got(again, "doc_id", "text_id", "source", "taken") == got(out, "doc_id", "text_id", "source", "taken")
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_bpe_is_the_merges(docs, rows, empty):
    own = bpe.Bpe.load(*VOCABULARY)
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    out = bpe.decode(bpe.encode(docs.select("doc_id", "text"), *VOCABULARY), *VOCABULARY)
    want = Counter((i, np.array(reference.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t, *_ in rows)
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in out.collect()) == want
    assert bpe.encode(empty, *VOCABULARY).count() == 0
    rng = random.Random(6)
    for _ in range(3000):
        t = "".join(rng.choice([chr(rng.randint(0, 0x2FF)), chr(rng.randint(0x3000, 0xD7FF)), " ", "\n", "'re", "ing", "\x1c", " "]) for _ in range(rng.randint(0, 20)))
        assert np.frombuffer(own.encode(t), "<u4").tolist() == reference.encode_ordinary(t)


def test_token_trees(docs, rows, empty):
    own = bpe.Bpe.load(*VOCABULARY)
    rng = random.Random(8)
    for _ in range(400):
        t = "".join(rng.choice(["word", " and", " ", "\n", "'s", "1", "é", "!", "\t"]) for _ in range(rng.randint(0, 500)))
        tree = token_counts.TokenTree.of(t, own)
        for _ in range(3):
            a = rng.randint(0, len(t))
            b = min(len(t), a + rng.choice([0, 1, 40]))
            new = "".join(rng.choice(["x", " ", "\n", "'", "ll"]) for _ in range(rng.choice([0, 3, 900])))
            tree.edit(a, b, new)
            t = t[:a] + new + t[b:]
            assert tree.text() == t and tree.count == len(own.encode(t)) // 4
    out = token_counts.apply_edits(token_counts.build(token_counts.three_edits(docs), *VOCABULARY), *VOCABULARY)
    for r in out.collect():
        assert r["n_after"] == len(own.encode(r["text"])) // 4 == sum(r["leaf_tokens"])
    assert token_counts.apply_edits(token_counts.build(token_counts.three_edits(empty), *VOCABULARY), *VOCABULARY).count() == 0


def test_positive_unlabelled(spark, sf_dir, empty):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    labels = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/labels.parquet")
    out = pu_quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    held = out[out["held_out"]]
    ranks = held["score"].rank()
    good = held["quality"] == 1
    auc = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.95 and ((held["score"] >= 0) & (held["score"] <= 1)).all()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in pu_quality.classify(docs.limit(5), none).collect()} == {0.5}
    assert pu_quality.classify(empty, none).count() == 0


def test_blocks_cover_every_row(rows):
    import pyarrow as pa

    column = pa.array([r[1] for r in rows])
    back = [b.text(i) for b in blocks(column, 500) for i in range(b.n)]
    assert back == [(r[1] or "").encode() for r in rows]
    sliced = column.slice(3, 20)
    assert [b.text(i) for b in blocks(sliced, 100) for i in range(b.n)] == back[3:23]
