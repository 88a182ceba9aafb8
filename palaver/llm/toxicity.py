"""Toxic passages as maximum-scoring segments of token log-odds.

The tokens of a word are its beginnings of 4 to 10 letters and the word itself, in
lower case, so that inflected and compound words share tokens; where a script has
no spaces, every letter begins a word.  A token's score is the log-odds of toxic
against other labelled texts, with a Dirichlet prior of ``prior`` times the token's
count in both, less ``z`` standard errors: a token that few texts hold, or both
kinds alike, is neutral.  A word takes the score of its longest token that two
toxic texts hold, and costs ``DRIFT`` if there is none.  Whole words that clean
texts hold although they begin like toxic ones get scores of their own.  Scores
are integers in eighths of a nat.

A linear scan (all maximal segments, each with its score) finds the passages.
Extreme-value statistics say what they are worth: K * n * exp(-lambda * S) of them
are expected in n clean words.  lambda solves sum p(s) * exp(lambda * s) = 1 over
the word scores of clean texts kept from the counts, K is the maximum-likelihood
estimate from their best segments.  A text's evidence is the sum over its
significant passages of log(1 / expected number); a logistic curve over evidence,
fitted on the texts kept back, makes it a score.

What is learnt: at most ``sample`` labelled texts of either kind, chosen by hash,
from training rows only; equal texts count once.  Three of four texts give the
counts, one of four the calibration.  The table has at most ``vocabulary`` tokens,
those of most evidence, and so is broadcast, as is a bit set of fixed size that
keeps tokens which toxic texts lack from being counted in the others.  Every
document is scored, whole.

Defined results: null, empty and wordless texts have no evidence and get the score
of none; a label that is null or not 0 or 1 is no label; several labels of a
document count as toxic if any is; without toxic or without other training texts
there are no tokens and every score is that of no evidence, 0.05; repeated rows
are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.blocks import Block, blocks, mix, opened, saved

LENGTHS = range(4, 11)  # letters of a beginning
LONGEST = 24  # letters of a word that is a token as a whole
UNIT = 8  # score units in a nat
DRIFT = -1
BITS = 1 << 22
_SPACE = 32
_FACTORS = mix(np.arange(1, LONGEST + 1, dtype=np.uint64)) | np.uint64(1)
_WHOLE = np.uint64(0x5851F42D4C957F2D)
_lower: list[np.ndarray] = []


def _lower_case() -> np.ndarray:
    """Code points below 2**16 in lower case; what is no letter, mark or digit is a space."""
    if not _lower:
        table = np.arange(1 << 16, dtype=np.uint32)
        for c in range(1 << 16):
            small = chr(c).lower()
            table[c] = (ord(small) if len(small) == 1 else c) if unicodedata.category(chr(c))[0] in "LMN" else _SPACE
        _lower.append(table)
    return _lower[0]


@dataclass
class Words:
    """The words of a block: owning text, place and length in letters; ``tokens`` from short to long: (words, hashes)."""

    owner: np.ndarray
    at: np.ndarray
    length: np.ndarray
    tokens: list[tuple[np.ndarray, np.ndarray]]


def words(b: Block) -> Words:
    codes = np.frombuffer(b.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), dtype=np.uint32)
    lead = np.concatenate([[0], np.cumsum((b.data & 0xC0) != 0x80)])
    starts = lead[b.starts]
    if len(codes) != starts[-1]:  # not UTF-8: text by text
        each = [np.frombuffer(b.text(i).decode("utf-8", "replace").encode("utf-32-le", "replace"), dtype=np.uint32) for i in range(b.n)]
        codes, starts = np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
    codes = np.where(codes < 1 << 16, _lower_case()[np.minimum(codes, (1 << 16) - 1)], codes).astype(np.uint64)
    ink = codes != _SPACE
    edge = np.zeros(len(codes) + 1, dtype=bool)
    edge[starts] = True
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1] | edge[1:-1]
    last[:-1] &= ~ink[1:] | edge[1:-1]
    ends = np.flatnonzero(last) + 1
    first |= ink & (codes >= 0x2E80) & (codes < 0xA4D0)
    begin = np.flatnonzero(first)
    length = ends[np.searchsorted(ends, begin, side="right")] - begin
    owner = np.searchsorted(starts, begin, side="right") - 1
    tokens = []
    h = np.zeros(len(begin), dtype=np.uint64)
    some = np.arange(len(begin))
    whole = []
    for j in range(LONGEST):
        some = some[length[some] > j]
        h[some] += codes[begin[some] + j] * _FACTORS[j]
        ended = some[length[some] == j + 1]
        whole.append((ended, mix(h[ended] ^ _WHOLE)))
        if j + 1 in LENGTHS:
            tokens.append((some, mix(h[some] ^ np.uint64(j))))
    tokens.append((np.concatenate([w for w, _ in whole]), np.concatenate([x for _, x in whole])))
    return Words(owner, begin - starts[owner], length, tokens)


def segments(scores: np.ndarray) -> list[tuple[int, int, int]]:
    """All maximal scoring segments of integer scores: first and last index, and score, in order.

    Runs of one sign are taken as one score.  ``kept`` holds candidates with the
    sums before and after them; the link of a candidate is the nearest one before
    it that starts at a smaller sum, so every merge is paid for by the candidate
    that it ends.
    """
    up = scores > 0
    if not up.any():
        return []
    cut = np.concatenate([[0], np.flatnonzero(up[1:] != up[:-1]) + 1])
    sums, ends = np.add.reduceat(scores, cut).tolist(), [*(cut[1:] - 1).tolist(), len(scores) - 1]
    kept: list[tuple[int, int, int, int, int]] = []  # first, last, sum before, sum after, link
    total = 0
    for first, last, s in zip(cut.tolist(), ends, sums, strict=True):
        before, total = total, total + s
        if s <= 0:
            continue
        begin, low, high = first, before, total
        link = len(kept) - 1
        while True:
            while link >= 0 and kept[link][2] >= low:
                link = kept[link][4]
            if link < 0 or kept[link][3] >= high:
                kept.append((begin, last, low, high, link))
                break
            begin, low = kept[link][0], kept[link][2]
            below = kept[link][4]
            del kept[link:]
            link = below
    return [(a, z, high - low) for a, z, low, high, _ in kept]


@dataclass
class Model:
    """Scores of known tokens (sorted by hash), the extreme-value parameters and the curve over evidence."""

    keys: np.ndarray
    values: np.ndarray
    rate: float = 1.0
    k: float = 1.0
    slope: float = 1.0
    offset: float = float(np.log(0.05 / 0.95))

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def scores(self, found: Words) -> np.ndarray:
        """The score of each word: that of its longest known token."""
        scores = np.full(len(found.owner), DRIFT, dtype=np.int64)
        if len(self.keys):
            for word, hashes in found.tokens:
                some = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.keys, hashes[some]), len(self.keys) - 1)
                hit = self.keys[at] == hashes[some]
                scores[word[some[hit]]] = np.where(self.values[at[hit]] == 0, DRIFT, self.values[at[hit]])
        return scores

    def worth(self, score, n: int):
        """log(1 / expected number) of segments of a score in n clean tokens."""
        return self.rate * score / UNIT - np.log(max(self.k * n, 1e-300))


def _per_text(b: Block, model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Text, its words' scores, places and lengths, for every text of the block."""
    found = words(b)
    scores = model.scores(found)
    edge = np.searchsorted(found.owner, np.arange(b.n + 1))
    for i in range(b.n):
        own = slice(edge[i], edge[i + 1])
        yield i, scores[own], found.at[own], found.length[own]


def _counts(texts: DataFrame, chosen) -> DataFrame:
    """token, n: texts that hold each token which ``chosen(words)`` admits, as (words, hashes); the null token has the number of all.

    Counted within the task first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = every = 0

        def emitted() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            for a in range(0, len(keys), 1 << 16):
                yield pa.record_batch([pa.array(keys[a : a + (1 << 16)].view(np.int64)), pa.array(n[a : a + (1 << 16)])], names=["token", "n"])

        for batch in batches:
            for b in blocks(batch["text"]):
                found = words(b)
                every += sum(len(w) for w, _ in found.tokens)
                for word, hashes in chosen(found):
                    if len(word):
                        key = np.stack([found.owner[word].astype(np.uint64), hashes])
                        order = np.lexsort(key[::-1])
                        key = key[:, order]
                        new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])
                        held.append(key[1, new])
                        size += len(held[-1])
                if size >= 1 << 23:
                    yield from emitted()
                    held, size = [], 0
        if held:
            yield from emitted()
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([every], pa.int64())], names=["token", "n"])

    return texts.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _in_bits(bits: np.ndarray):
    packed = np.packbits(bits)

    def chosen(found: Words):
        inside = np.unpackbits(packed).view(bool)
        for word, hashes in found.tokens:
            at = inside[(hashes >> np.uint64(42)).astype(np.int64)]
            yield word[at], hashes[at]

    return chosen


def in_training(doc_id) -> F.Column:
    """True for the rows that labels may be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def _labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, toxic, held (for calibration) of the labelled training texts that are learnt from."""
    labels = opened(labels, "doc_id", "toxic")[0].filter(F.expr("try_cast(toxic as int) in (0, 1)") & in_training(F.col("doc_id")))
    labels = labels.groupBy("doc_id").agg(F.max(F.expr("try_cast(toxic as int)")).alias("toxic"))
    by_hash = F.xxhash64(F.lit("toxic"), "doc_id")
    chosen = None
    for kind in (0, 1):
        part = labels.filter(F.col("toxic") == kind).orderBy(by_hash, "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = saved(chosen, "toxic-labels")
    slim = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Two times sample rows of an id and a label at most.
    texts = slim.join(F.broadcast(chosen), "doc_id").select("text", "toxic", F.xxhash64("text").alias("same"))
    return saved(texts.withColumn("held", F.pmod(F.xxhash64(F.lit("held"), "same"), F.lit(4)) == 0), "toxic-texts")


def _once(texts: DataFrame) -> DataFrame:
    """Equal texts as one row, toxic if any is: only copies beyond the first of a hash are moved."""
    label = texts.groupBy("same").agg(F.max("toxic").alias("toxic"), F.count("*").alias("n"))
    several = saved(label.filter("n > 1").select("same", "toxic"), "toxic-copies")
    single = texts.join(several, "same", "left_anti").select("text", "toxic", "held")
    copies = texts.drop("toxic").join(several, "same").groupBy("same", "held", "toxic").agg(F.min("text").alias("text"))
    return single.unionByName(copies.select("text", "toxic", "held"))


def _scored(counts: DataFrame, toxic: int, clean: int, prior: float, z: float) -> DataFrame:
    """token, score and evidence from a, b: texts of either kind that hold the token."""
    mass, own = prior * (toxic + clean), F.lit(prior) * (F.col("a") + F.col("b"))

    def odds(n, of):
        return F.log((n + own) / F.greatest(F.lit(of + mass) - n - own, F.lit(1e-9)))

    raw = odds(F.col("a"), toxic) - odds(F.col("b"), clean)
    error = F.sqrt(1 / (F.col("a") + own) + 1 / (F.col("b") + own))
    sure = F.signum(raw) * F.greatest(F.abs(raw) - F.lit(z) * error, F.lit(0.0))
    return counts.select("token", F.round(sure * UNIT).cast("int").alias("score"), (F.abs(sure) * (F.col("a") + F.col("b"))).alias("evidence"))


def _sorted(table: DataFrame, vocabulary: int) -> Model:
    best = table.orderBy(F.col("evidence").desc(), "token").limit(vocabulary).select("token", "score").toArrow()
    keys, values = best["token"].to_numpy().view(np.uint64), best["score"].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    return Model(keys[order], values[order])


def _table(texts: DataFrame, prior: float, z: float, vocabulary: int) -> Model:
    """Hashes and scores of the tokens that tell toxic from other texts."""
    toxic = saved(_counts(texts.filter("toxic = 1"), lambda found: found.tokens), "toxic-counts")
    known = toxic.filter("token is not null and n > 1").select("token", F.col("n").alias("a"))
    places = known.select(F.shiftrightunsigned("token", 42).cast("int").alias("at")).distinct().toArrow()["at"]  # BITS numbers at most
    bits = np.zeros(BITS, dtype=bool)
    bits[places.to_numpy()] = True
    others = texts.filter("toxic = 0")
    clean = saved(_counts(others, _in_bits(bits)), "clean-counts")
    n1, n0 = (c.filter("token is null").agg(F.sum("n")).first()[0] or 0 for c in (toxic, clean))
    if not n1 or not n0:
        return Model(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    both = known.join(clean.filter("token is not null").select("token", F.col("n").alias("b")), "token", "left").select("token", "a", F.coalesce("b", F.lit(0)).alias("b"))
    table = saved(_scored(both, n1, n0, prior, z), "toxic-table")
    first = _sorted(table, vocabulary)
    shared = texts.sparkSession.sparkContext.broadcast(first)

    def suspected(found: Words):
        word, hashes = found.tokens[-1]
        at = shared.value.scores(found)[word] > 0
        return [(word[at], hashes[at])]

    # Clean words that look toxic by their beginning, whether or not toxic texts hold them.
    seen = _counts(others, suspected).filter("token is not null and n > 1").select("token", F.col("n").alias("b"))
    more = seen.join(toxic.filter("token is not null").select("token", F.col("n").alias("a")), "token", "left").select("token", F.coalesce("a", F.lit(0)).alias("a"), "b")
    more = more.join(table.select("token"), "token", "left_anti")
    return _sorted(table.unionByName(_scored(more, n1, n0, prior, z)), vocabulary)


def _rate(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of sum p(s) exp(rate * s) = 1, at most 1: a log-odds is worth no more than itself."""
    p, s = counts / counts.sum(), scores / UNIT
    if (p * s).sum() >= 0:
        return 0.05
    low, high = 1e-4, 1.0
    if (p * np.exp(high * s)).sum() < 1:
        return high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * s)).sum() < 1 else (low, mid)
    return max(low, 0.05)


def _curve(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over evidence, by Newton steps with smoothed targets."""
    a, b = toxic.sum(), clean.sum()
    if not a or not b:
        return Model.slope, Model.offset
    weight = np.concatenate([toxic, clean]).astype(float)
    target = np.concatenate([np.full(len(x), (a + 1) / (a + 2)), np.full(len(x), 1 / (b + 2))])
    z = np.column_stack([np.concatenate([x, x]), np.ones(2 * len(x))])
    w = np.array([0.5, -2.0])
    ridge = np.diag([1e-2, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - target)) + ridge @ w
        step = np.linalg.solve((z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + ridge, gradient)
        w -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def _calibrated(texts: DataFrame, model: Model) -> Model:
    """The model with rate, K and curve from texts that gave no counts."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = shared.value, {}
        for batch in batches:
            rows = []
            label = batch["toxic"].to_numpy()
            for b in blocks(batch["text"]):
                for i, scores, _, _ in _per_text(b, own):
                    toxic = int(label[b.first + i])
                    rows.append((toxic, len(scores), [s for _, _, s in segments(scores)], None))
                    if not toxic:
                        for s, n in zip(*np.unique(scores, return_counts=True), strict=True):
                            seen[int(s)] = seen.get(int(s), 0) + int(n)
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for s, n in seen.items():
            yield pa.record_batch([pa.array([v], t) for v, t in zip((None, n, None, s), kinds, strict=True)], names=names)

    names, kinds = ["toxic", "n", "found", "score"], (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32())
    table = saved(texts.select("text", "toxic").mapInArrow(run, "toxic int, n long, found array<long>, score int"), "toxic-segments")
    drawn = table.filter("score is not null").groupBy("score").agg(F.sum("n").alias("n")).collect()  # one row a score
    if not drawn:
        return model
    scores, counts = np.array([r["score"] for r in drawn]), np.array([r["n"] for r in drawn], dtype=float)
    # One token more, of the highest score: clean texts may hold some that these do not.
    top = max(int(model.values.max(initial=1)), 1)
    rate = _rate(np.append(scores, top), np.append(counts, 1.0))
    best = F.coalesce(F.array_max("found"), F.lit(0)) / UNIT
    expected = table.filter("toxic = 0 and n > 0").agg(F.count("*").alias("d"), F.sum(F.col("n") * F.exp(-rate * best)).alias("e")).first()
    k = expected["d"] / expected["e"] if expected["e"] else 1.0
    of = F.log(F.greatest(F.lit(k) * F.col("n"), F.lit(1e-300)))
    x = F.aggregate("found", F.lit(0.0), lambda t, s: t + F.greatest(s * F.lit(rate / UNIT) - of, F.lit(0.0)))
    bins = table.filter("toxic is not null").select("toxic", F.least(F.floor(x * 4), F.lit(400)).alias("bin")).groupBy("bin").agg(F.sum("toxic").alias("a"), F.count("*").alias("n")).orderBy("bin").collect()
    a = np.array([r["a"] for r in bins], dtype=float)
    middle = np.array([r["bin"] / 4 + (0.125 if r["bin"] else 0.0) for r in bins])
    slope, offset = _curve(middle, a, np.array([r["n"] for r in bins]) - a)
    return Model(model.keys, model.values, rate, k, slope, offset)


def train(docs: DataFrame, labels: DataFrame, sample: int = 100_000, prior: float = 0.1, z: float = 2.0, vocabulary: int = 1 << 20) -> Model:
    """The model, from at most ``sample`` labelled texts of either kind."""
    texts = saved(_once(_labelled(opened(docs, "doc_id", "text")[0], labels, sample)), "toxic-distinct")
    model = _table(texts.filter("not held").select("text", "toxic"), prior, z, vocabulary)
    return _calibrated(texts.filter("held"), model) if len(model.keys) else model


def _evidence(own: Model, scores: np.ndarray) -> float:
    return float(sum(max(own.worth(s, len(scores)), 0.0) for _, _, s in segments(scores)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, evidence, score and predicted of every document."""
    docs = opened(docs, "doc_id", "text")[0]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 16 bytes a token of the vocabulary
    slim = docs.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            x = np.zeros(batch.num_rows)
            for b in blocks(batch["text"]):
                for i, scores, _, _ in _per_text(b, own):
                    x[b.first + i] = _evidence(own, scores)
            p = 1 / (1 + np.exp(-np.clip(own.slope * x + own.offset, -700, 700)))
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(x), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "evidence", "score", "predicted"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, held_out boolean, evidence double, score double, predicted int")


def passages(docs: DataFrame, model: Model, expected: float = 0.05) -> DataFrame:
    """doc_id, begin, end (code points), score and expected number of every significant passage."""
    docs = opened(docs, "doc_id", "text")[0]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = []
            for b in blocks(batch["text"]):
                for i, scores, at, length in _per_text(b, own):
                    for first, last, s in segments(scores):
                        e = float(np.exp(-own.worth(s, len(scores))))
                        if e <= expected:
                            rows.append((b.first + i, int(at[first]), int(at[last] + length[last]), s / UNIT, e))
            if rows:
                place, *rest = zip(*rows, strict=True)
                yield pa.record_batch([batch["doc_id"].take(pa.array(place)), *map(pa.array, rest)], names=["doc_id", "begin", "end", "score", "expected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, begin long, end long, score double, expected double")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Every document scored by the model that its labelled training rows give."""
    return score(docs, train(docs, labels, **options))
