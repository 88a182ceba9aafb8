"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text, no negatives: a small network
minimises the non-negative unbiased risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with the logistic loss, so that the sigmoid of its output estimates the
probability of a good text.  The class prior is estimated too: a first network
tells P from U, and the prior is the least ratio of the shares of U and of P
above a threshold, with a bound for the noise of small shares.

Inputs of a score are shares and means taken from the whole text alone, never
labels, language, source or ids.  The fit uses at most ``sample`` positives and
``sample`` unlabelled texts, chosen by hash; every document is scored.

Defined results: a null or empty text has the features of no text and gets the
model's score for them; without any positive in the training rows every score
is the prior's default 0.5; several labels of a document count as positive if
any is; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.blocks import Block, blocks, mix, opened
from palaver.llm.quality_rules import base_counts

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _classes() -> list[np.ndarray]:
    byte = np.arange(256)
    made = [byte == m for m in _MARKS]
    made.append((byte >= 65) & (byte <= 90))
    made.append((byte >= 97) & (byte <= 122))
    made.append((byte >= 48) & (byte <= 57))
    made.append(byte == 10)
    made.append(byte == 32)
    made.append(byte >= 128)
    return made


_CLASSES = _classes()
_UPPER_SECOND = (np.arange(256) >= 0x80) & (np.arange(256) <= 0x9E)  # after C3: capital letters of Latin-1


def features(b: Block) -> np.ndarray:
    """A row of shares and means for each text of the block."""
    size = np.maximum(b.lengths, 1).astype(np.float64)
    # One histogram of bytes per text, then sums over byte classes.
    doc = np.repeat(np.arange(b.n), b.lengths)
    histogram = np.bincount(doc * 256 + b.data, minlength=256 * b.n).reshape(b.n, 256)
    columns = [histogram[:, c].sum(axis=1) / size for c in _CLASSES]
    capital = np.zeros(len(b.data), dtype=bool)
    if len(b.data) > 1:
        capital[1:] = (b.data[:-1] == 0xC3) & _UPPER_SECOND[b.data[1:]]
    columns.append(b.per_text(capital) / size)
    base = base_counts(b)
    begin, end, owner = b.words()
    words = base["n_words"]
    some = np.maximum(words, 1).astype(np.float64)
    columns.append(np.log1p(words))
    columns.append(np.log1p(b.lengths))
    length = (end - begin).astype(np.float64)
    mean = np.bincount(owner, length, minlength=b.n) / some
    columns.append(mean)
    columns.append(np.sqrt(np.maximum(np.bincount(owner, length**2, minlength=b.n) / some - mean**2, 0)))
    if len(owner):
        key = mix(b.hashes(begin, end) ^ mix(owner.astype(np.uint64)))
        _, at, n = np.unique(key, return_index=True, return_counts=True)
        columns.append(np.bincount(owner[at], minlength=b.n) / some)
        top = np.zeros(b.n)
        np.maximum.at(top, owner[at], n)
        columns.append(top / some)
        first, last = b.data[begin], b.data[end - 1]
        columns.append(np.bincount(owner[(first >= 65) & (first <= 90)], minlength=b.n) / some)
        columns.append(np.bincount(owner[(last < 48) | ((last > 57) & (last < 65))], minlength=b.n) / some)
    else:
        columns += [np.zeros(b.n)] * 4
    lines = histogram[:, 10] + 1.0
    columns.append(base["n_dup_lines"] / lines)
    columns.append(base["n_repeat_words"] / some)
    columns.append(np.log1p(size / lines))
    return np.column_stack(columns)


def featured(docs: DataFrame, extra: list[str]) -> DataFrame:
    """``extra`` columns and ``x``, the features as an array of doubles."""
    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch["text"]):
                x = features(b)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(b.n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.record_batch([*(batch[c].slice(b.first, b.n) for c in extra), flat], names=[*extra, "x"])

    return docs.select(*extra, F.col("text").cast("string").alias("text")).mapInArrow(run, f"{fields}x array<double>")


class Network:
    """One hidden layer over standardised features."""

    def __init__(self, mean, scale, seed: int = 7, hidden: int = 24):
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.scale = mean, scale
        self.w = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def forward(self, z: np.ndarray):
        h = np.tanh(z @ self.w[0] + self.w[1])
        return h, h @ self.w[2] + self.w[3][0]

    def gradient(self, z, h, dg) -> list[np.ndarray]:
        dh = np.outer(dg, self.w[2]) * (1 - h**2)
        return [z.T @ dh, dh.sum(axis=0), h.T @ dg, np.array([dg.sum()])]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.forward(self.standard(x))[1])


def sigmoid(g: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(g, -40, 40)))


def fit(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int = 1500, batch: int = 1024, rate: float = 0.01, decay: float = 1e-4) -> Network:
    """Minimise the non-negative risk; with ``prior`` None, tell P from U instead."""
    both = np.concatenate([p, u])
    net = Network(both.mean(axis=0), both.std(axis=0) + 1e-3)
    zp, zu = net.standard(p), net.standard(u)
    rng = np.random.default_rng(11)
    m1, m2 = [np.zeros_like(w) for w in net.w], [np.zeros_like(w) for w in net.w]
    for step in range(1, steps + 1):
        a, b = zp[rng.integers(0, len(zp), batch)], zu[rng.integers(0, len(zu), batch)]
        (ha, ga), (hb, gb) = net.forward(a), net.forward(b)
        sa, sb = sigmoid(ga), sigmoid(gb)
        if prior is None:
            g = [x + y for x, y in zip(net.gradient(a, ha, (sa - 1) / batch), net.gradient(b, hb, sb / batch), strict=True)]
        else:
            negative = np.logaddexp(0, gb).mean() - prior * np.logaddexp(0, ga).mean()
            part = [x + y for x, y in zip(net.gradient(b, hb, sb / batch), net.gradient(a, ha, -prior * sa / batch), strict=True)]
            if negative >= 0:
                g = [x + y for x, y in zip(part, net.gradient(a, ha, prior * (sa - 1) / batch), strict=True)]
            else:  # the risk of negatives cannot be below 0: undo the overfit
                g = [-x for x in part]
        lr = rate * 0.5 * (1 + np.cos(np.pi * step / steps))
        for i, w in enumerate(net.w):
            grad = g[i] + decay * w
            m1[i] = 0.9 * m1[i] + 0.1 * grad
            m2[i] = 0.999 * m2[i] + 0.001 * grad**2
            w -= lr * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.999**step)) + 1e-8)
    return net


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """The least ratio, over thresholds, of U's share above to P's share above."""
    half_p, half_u = np.arange(len(p)) % 2 == 0, np.arange(len(u)) % 2 == 0
    net = fit(p[half_p], u[half_u], None, steps=600)
    sp, su = np.sort(net.score(p[~half_p])), np.sort(net.score(u[~half_u]))
    if not len(sp) or not len(su):
        return 0.5
    at = np.unique(np.quantile(sp, np.linspace(0, 0.99, 200)))
    qp = 1 - np.searchsorted(sp, at, side="left") / len(sp)
    qu = 1 - np.searchsorted(su, at, side="left") / len(su)
    noise = np.sqrt(np.log(40) / 2) * (len(sp) ** -0.5 + len(su) ** -0.5)
    best = np.argmin((qu + noise) / np.maximum(qp, 1e-9))
    return float(np.clip(qu[best] / max(qp[best], 1e-9), 0.05, 0.98))


def _gather(frame: DataFrame) -> np.ndarray:
    rows = frame.select("x").toArrow()["x"].combine_chunks()
    return rows.flatten().to_numpy().reshape(len(rows), -1) if len(rows) else np.zeros((0, 1))


def in_training(doc_id) -> F.Column:
    """True for the rows that labels may be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def train(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> tuple[Network | None, float]:
    """Network and prior, from at most ``sample`` positives and ``sample`` unlabelled texts."""
    by_hash = F.xxhash64(F.lit("fit"), "doc_id")
    docs, labels = opened(docs, "doc_id", "text")[0], opened(labels, "doc_id", "quality")[0]
    good = labels.filter((F.col("quality") == 1) & in_training(F.col("doc_id"))).select("doc_id").distinct()
    chosen = good.orderBy(by_hash, "doc_id").limit(sample)  # bounded: safe to broadcast
    slim = docs.select("doc_id", "text").filter(in_training(F.col("doc_id")))
    # The first by hash, of repeated ids too; the sort keeps no more rows than it gives.
    p = _gather(featured(slim.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "text", by_hash.alias("at")), ["at", "doc_id"]).orderBy("at", "doc_id", "x").limit(sample))
    if not len(p):
        return None, 0.5
    total = slim.count()
    # A few more than needed by a hash threshold, then exactly the first by hash.
    share = min(1.0, 1.2 * sample / max(total, 1) + 1e-9)
    drawn = slim.filter((by_hash / F.lit(2.0**64) + 0.5) < share).select("doc_id", "text", by_hash.alias("at"))
    u = _gather(featured(drawn, ["at", "doc_id"]).orderBy("at", "doc_id", "x").limit(sample))
    prior = estimate_prior(p, u)
    return fit(p, u, prior), prior


def classify(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = opened(docs, "doc_id", "text")[0]
    net, prior = train(docs, labels, sample)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few kB
    slim = docs.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            score = np.full(batch.num_rows, 0.5)
            if own is not None:
                for b in blocks(batch["text"]):
                    score[b.rows] = own.score(features(b))
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
