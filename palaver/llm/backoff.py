"""Language-model scores with stupid backoff, computed relationally.

The n-grams are word n-grams of orders 1 to ``order`` as 64-bit hashes; a word is
a run of ``[^\\x20\\x09-\\x0D]``.  Counts come from all documents and nothing is
pruned from them, but a document does not vouch for itself: an n-gram is known
only if two documents hold it.  At each word the longest known n-gram that ends
there gives

    S = ALPHA ** (orders skipped) * count(gram) / count(gram without its last word)

with count() = N, the number of all words, below order 1, and S = ALPHA ** order / N
for an unknown word.  A document's score is the sum of ln S over its words.

Plan: an n-gram is known only if its suffix is, so the sum over words is a sum
over n-grams of what knowing each adds to its suffix's ln S:

    score(doc) = n_words * ln(ALPHA ** order / N) + sum of n(doc, gram) * weight(gram)

1. Documents are compressed to packs, of which ``CHUNK`` that follow each other are
   a chunk: neighbours share more n-grams than texts from anywhere.
2. A chunk is exploded to its n-grams.  Each distinct one moves once, to the part
   of the count table that its hash falls in.  Hashes move in order, so that only
   the steps between them need bits (five bytes and a half, not eight).
3. A part of the count table joins the chunks' n-grams by hash, and answers each
   chunk in the order it asked: a bit an n-gram, and the count if it is known.
4. A chunk's packs, moved once for both steps, meet its answers.  Its n-grams,
   exploded again, find their counts, contexts and suffixes in place; the products
   are summed per document.  A very common n-gram is a row a chunk.

Weights are whole millionths, so that sums do not depend on their order.

Defined results: a null or empty text scores 0 with no words, per_word 0; equal
rows support each other and score alike; doc_id may be null, repeated or of any
type; further columns do not matter; an empty table gives an empty result.  A
table whose rows are others when they are read again is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.blocks import SPACE, Block, blocks, mix, opened, release

ORDER = 3
ALPHA = 0.4
#: Packs of a chunk, bytes of a pack, words of a part of the count table, about.
CHUNK, PACK, PART = 26, 1 << 19, 1_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 1_000_000
_REQUESTS = "chunk long, part int, n int, grams binary, counts binary"
_ANSWERS = "chunk long, part int, n int, sum long, known binary, counts binary"


def exploded(b: Block, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order the n-grams that end at the words; the text of each word, and its place there: n-grams longer than that are none."""
    begin, end, doc = b.words()
    h = b.hashes(begin, end)
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    out, shorter = [], np.zeros(len(h), dtype=np.uint64)
    for k in range(1, order + 1):
        context = np.zeros(len(h), dtype=np.uint64)
        if k > 1:
            context[1:] = shorter[:-1]
        shorter = mix(context * _STEP + h + np.uint64(k))
        out.append(shorter)
    return out, doc, place


def merged(grams: np.ndarray, n: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams in order, how often each occurs, and if ``many`` or several of these hold it."""
    if not len(grams):
        return grams, n, many
    by = np.argsort(grams)
    grams = grams[by]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    several = np.diff(np.append(first, len(grams))) > 1
    return grams[first], np.add.reduceat(n[by], first, dtype=np.int64), np.logical_or.reduceat(many[by], first) | several


class Pack:
    """A pack's distinct n-grams in order (``own``); where those of order 1, 2 and so on are in them, and the texts and places of its words."""

    def __init__(self, texts: pa.Buffer, ends: pa.Buffer, order: int):
        ends = np.frombuffer(ends, dtype="<i8")
        data = pa.Codec("zstd").decompress(texts, int(ends[-1]))
        every, doc, place = exploded(Block(np.frombuffer(data, dtype=np.uint8), np.concatenate([[0], ends]), 0), order)
        self.n, self.doc, self.place = len(ends), doc.astype(np.int32), np.minimum(place, order).astype(np.int8)
        own, at = np.unique(np.concatenate([g[place >= k] for k, g in enumerate(every)]), return_inverse=True)
        self.own, self.at = own, at.astype(np.int32)

    def held(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct n-grams, how often each occurs, and if two rows hold it."""
        least, most = np.full(len(self.own), len(self.doc), np.int32), np.full(len(self.own), -1, np.int32)
        docs = np.concatenate([self.doc[self.place >= k] for k in range(order)])
        most[self.at] = docs  # rows rise within an order
        least[self.at[::-1]] = docs[::-1]
        return self.own, np.bincount(self.at, minlength=len(self.own)).astype(np.int32), least != most


def packs_of(table: pa.Table, order: int) -> Iterator[Pack]:
    for texts, ends in zip(table["texts"], table["ends"], strict=True):
        yield Pack(texts.as_buffer(), ends.as_buffer(), order)


def cuts(grams: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Where the n-grams of each part of the count table begin, and their end."""
    return np.append(np.searchsorted(grams, low), len(grams))


def planes(x: np.ndarray) -> bytes:
    """Whole numbers by planes of their bytes, each compressed: even low bytes take their place, skewed high ones little."""
    width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    codec = pa.Codec("zstd", compression_level=1)
    each = [codec.compress(np.ascontiguousarray(p), asbytes=True) for p in x.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]]
    return np.array([width, *map(len, each)], dtype="<u4").tobytes() + b"".join(each)


def whole(packed: bytes, n: int) -> np.ndarray:
    """The n whole numbers of ``planes``."""
    out = np.zeros((n, 8), dtype=np.uint8)
    width = int(np.frombuffer(packed, "<u4", 1)[0])
    sizes = np.frombuffer(packed, "<u4", width, 4)
    at = 4 + 4 * width
    for i, size in enumerate(sizes.tolist()):
        out[:, i] = np.frombuffer(pa.decompress(packed[at : at + size], n, "zstd"), dtype=np.uint8)
        at += size
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _bounds(parts: int) -> np.ndarray:
    """The least hash of each part of the count table."""
    return np.array([(p << 64) // parts for p in range(parts)], dtype=np.uint64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ids, texts, ends: a few rows as one, their texts in one piece."""
    codec = pa.Codec("zstd", compression_level=6)
    for batch in batches:
        for b in blocks(batch["text"], PACK):
            ids = pa.ListArray.from_arrays(pa.array([0, b.n], pa.int32()), batch["doc_id"].slice(b.first, b.n))
            texts, ends = codec.compress(np.ascontiguousarray(b.data), asbytes=True), b.starts[1:].astype("<i8").tobytes()
            yield pa.record_batch([ids, pa.array([texts]), pa.array([ends])], names=["ids", "texts", "ends"])


def packs(docs: DataFrame, deals: int) -> DataFrame:
    """chunk, ids, texts, ends: the rows of ``docs`` (doc_id, text) in packs, dealt by chunk."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunk = F.floor(F.monotonically_increasing_id() / CHUNK)
    return docs.mapInArrow(_packed, f"ids array<{kind}>, texts binary, ends binary").withColumn("chunk", chunk).repartition(deals, "chunk")


def counts(packed: DataFrame, order: int, parts: int) -> DataFrame:
    """chunk, part, n, sum, known, counts: what each part of the count table answers each chunk, and of how many n-grams."""

    def asked(table: pa.Table) -> pa.Table:
        low, rows = _bounds(parts), []
        each = [p.held(order) for p in packs_of(table, order)]
        at = [cuts(grams, low) for grams, _, _ in each]
        for p in range(parts):
            grams, n, many = merged(*(np.concatenate([x[i][c[p] : c[p + 1]] for x, c in zip(each, at, strict=True)]) for i in range(3)))
            if len(grams):
                rows.append((table["chunk"][0].as_py(), p, len(grams), planes(np.diff(grams, prepend=low[p])), planes(2 * (n - 1) + many)))
        release()
        return _table(rows, ("chunk", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary()))

    def answered(table: pa.Table) -> pa.Table:
        low, asking = _bounds(parts), table.to_pylist()
        each = [low[r["part"]] + np.cumsum(whole(r["grams"], r["n"]), dtype=np.uint64) for r in asking]
        held = np.concatenate([whole(r["counts"], r["n"]) for r in asking])
        grams = np.concatenate(each)
        distinct, n, many = merged(grams, (held >> np.uint64(1)).astype(np.int64) + 1, (held & np.uint64(1)).astype(bool))
        n[~many] = 0
        rows = []
        for r, own in zip(asking, each, strict=True):
            count = n[np.searchsorted(distinct, own)]
            rows.append((r["chunk"], r["part"], len(own), _sum(own), np.packbits(count > 0).tobytes(), planes(count[count > 0])))
        release()
        return _table(rows, ("chunk", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("sum", pa.int64()), ("known", pa.binary()), ("counts", pa.binary()))

    return packed.groupBy("chunk").applyInArrow(asked, _REQUESTS).repartition(parts, "part").groupBy("part").applyInArrow(answered, _ANSWERS)


def _table(rows: list[tuple], *fields: tuple[str, pa.DataType]) -> pa.Table:
    return pa.table([pa.array(x, kind) for x, (_, kind) in zip(zip(*rows, strict=True) if rows else [()] * len(fields), fields, strict=True)], names=[name for name, _ in fields])


def _sum(grams: np.ndarray) -> int:
    """The sum of the hashes modulo 2**64, signed."""
    return int(grams.sum(dtype=np.uint64).view(np.int64))


def _logs(n: np.ndarray) -> np.ndarray:
    """ln n of whole numbers, of which few differ."""
    every, at = np.unique(n, return_inverse=True)
    return np.array([math.log(x) for x in every.tolist()], dtype=np.float64)[at]


def summed(packed: DataFrame, answers: DataFrame, order: int, parts: int, total: int) -> DataFrame:
    """doc_id, n_words, sum (of n-grams' weights, in millionths) of every document."""
    kind = packed.schema["ids"].dataType.elementType.simpleString()
    ln_total, ln_alpha = math.log(max(total, 1)), math.log(ALPHA)

    def together(own: pa.Table, answers: pa.Table) -> pa.Table:
        here, got, low = list(packs_of(own, order)), {r["part"]: r for r in answers.to_pylist()}, _bounds(parts)
        at, ln = [cuts(p.own, low) for p in here], [np.full(len(p.own), math.nan) for p in here]
        for k in range(parts):
            each = [p.own[c[k] : c[k + 1]] for p, c in zip(here, at, strict=True)]
            grams = np.unique(np.concatenate(each))
            r = got.get(k, {"n": 0, "sum": 0})
            if (r["n"], r["sum"]) != (len(grams), _sum(grams)):
                raise RuntimeError("the documents were others when they were read again")
            if len(grams):
                logs = np.full(len(grams), math.nan)
                known = np.unpackbits(np.frombuffer(r["known"], np.uint8))[: len(grams)].astype(bool)
                logs[known] = _logs(whole(r["counts"], int(known.sum())))
                for part, c, to in zip(each, at, ln, strict=True):
                    to[c[k] : c[k + 1]] = logs[np.searchsorted(grams, part)]
        out = []
        for p, logs in zip(here, ln, strict=True):
            every, doc, place = logs[p.at], p.doc, p.place
            sums = np.zeros(len(doc), dtype=np.int64)
            shorter, less, start = np.full(len(doc), ln_total), np.zeros(len(doc)), 0
            for k in range(order):
                whole_k = np.flatnonzero(place >= k)
                c_k = np.full(len(doc), math.nan)
                c_k[whole_k] = every[start : start + len(whole_k)]
                start += len(whole_k)
                f = c_k - (shorter if not k else np.append(math.nan, shorter[:-1]))
                weight = c_k - ln_alpha if not k else f - less - ln_alpha
                known = np.flatnonzero(~np.isnan(weight))
                sums[known] += np.floor(weight[known] * _UNIT + 0.5).astype(np.int64)
                shorter, less = c_k, f
            words = np.bincount(doc, minlength=p.n)
            upto = np.concatenate([[0], np.cumsum(sums)])
            ends_at = np.cumsum(words)
            out.append((words, upto[ends_at] - upto[ends_at - words]))
        ids = pa.chunked_array([x.flatten() for x in own["ids"].chunks], own["ids"].type.value_type)
        words, sums = (np.concatenate(x) for x in zip(*out, strict=True))
        release()
        return pa.table([ids, pa.array(words), pa.array(sums)], names=["doc_id", "n_words", "sum"])

    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(together, f"doc_id {kind}, n_words long, sum long")


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of words of each batch."""
    for batch in batches:
        n = 0
        for b in blocks(batch["text"]):
            ink = np.append(~SPACE[b.data], False)
            new = ink.copy()
            edge = np.zeros(len(ink), dtype=bool)
            edge[b.starts] = True
            new[1:] &= ~ink[:-1] | edge[1:]
            n += int(np.count_nonzero(new))
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, score (the sum of ln S) and per_word (score / n_words) of every document."""
    docs, _ = opened(docs, "doc_id", "text")
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = docs.select("text").mapInArrow(_words, "n long").agg(F.sum("n")).first()[0] or 0  # one number
    parts = max(1, math.ceil(total / PART))
    packed = packs(docs, parts)
    answers = counts(packed, order, parts).repartition(parts, "chunk")
    rows = summed(packed, answers, order, parts, total)
    floor = order * F.ln(F.lit(ALPHA)) - F.ln(F.lit(float(max(total, 1))))
    millionths = F.col("n_words") * F.floor(floor * _UNIT + 0.5) + F.col("sum")
    out = rows.select("doc_id", "n_words", (millionths / F.lit(float(_UNIT))).alias("score"))
    return out.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")).otherwise(F.lit(0.0)))
