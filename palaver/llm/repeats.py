"""Removal of repeated 200-byte strings by column-wise sorting of anchored contexts.

Every byte covered by a ``WINDOW``-byte string that also starts elsewhere, in any
document, goes.  Inserting one symbol per document and round over whole texts
takes as many passes over all data as the longest text has bytes, so the rounds
run over contexts of fixed length instead:

1. Anchors.  Of the ``K``-byte k-mers of each window the one with the least hash
   is an anchor, so equal windows have an anchor at the same place in them.
   An anchor's context is every window around it: ``LEFT`` bytes before its
   k-mer and ``LEFT`` after.
2. Anchors are sorted by (k-mer, context).  A k-mer seen once has no repeated
   window.  Equal contexts repeat as a whole: all their bytes are covered.  What
   is left, contexts that share the k-mer but not all bytes, goes on.
3. Column-wise construction, all contexts of a partition at once: from the last
   column to the first one symbol per context is inserted before all of them;
   a stable sort by the symbol updates the order (the column of the collection's
   Burrows-Wheeler transform) and range minima update the common prefixes with
   the neighbours.  A prefix of ``WINDOW`` bytes with a neighbour is a repeated
   window.  Columns are read from a sequential temporary file where a partition
   is large, so memory is a few numbers a context.
4. A context's repeated windows all hold its anchor, so first and last of them
   bound one covered interval.  Intervals meet their documents once more.

Defined results: a null text is the empty text; matches never cross documents;
overlaps count; equal rows repeat each other; repeated doc_ids are told apart by
their texts; texts under ``WINDOW`` bytes lose nothing; an empty table gives an
empty result.  Strings are judged on the input.

Hot passages: equal contexts of a task are merged before the shuffle, so a
passage that a third of all documents hold costs a row a task for its inner
anchors; those at its two ends differ and are as many as documents, small and
streamed through the sort.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.blocks import Block, blocks, mix, opened, saved, texts_of

WINDOW = 200
K = 64
LEFT = WINDOW - K  # 136
CONTEXT = LEFT + WINDOW  # 336
#: Contexts that one task of step 3 gets on average.
PER_TASK = 30_000
#: Contexts that are held in memory; more go through a temporary file.
IN_MEMORY = 60_000
#: Ids that are broadcast at most, 16 bytes each.
FEW_IDS = 1_000_000


def _slide(x: np.ndarray, n: int, best) -> np.ndarray:
    """best over x[i : i + n] at each i; values beyond the end do not count."""
    out, have = x.copy(), 1
    while have < n:
        step = min(have, n - have)
        out[:-step] = best(out[:-step], out[step:])
        have += step
    return out


def anchors(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the anchors of a block, their texts and their k-mer hashes."""
    none = np.zeros(0, dtype=np.int64)
    if len(b.data) < WINDOW:
        return none, none, none.astype(np.uint64)
    h = np.full(len(b.data), np.iinfo(np.uint64).max, dtype=np.uint64)
    own = b.windows(K) | np.uint64(1)
    h[: len(own)] = own
    least = _slide(h, WINDOW - K + 1, np.minimum)
    valid = np.zeros(len(b.data) + 1, dtype=np.int64)
    long = b.lengths >= WINDOW
    np.add.at(valid, b.starts[:-1][long], 1)
    np.add.at(valid, b.starts[1:][long] - WINDOW + 1, -1)
    least[np.cumsum(valid)[:-1] == 0] = 0
    # An anchor is the least of some window that begins up to WINDOW - K before it.
    back = _slide(least[::-1], WINDOW - K + 1, np.maximum)[::-1]
    at = np.flatnonzero(back == h)
    return at, b.owner(at), h[at]


def _bounds(b: Block, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(at - LEFT, b.starts[doc]), np.minimum(at + WINDOW, b.starts[doc + 1])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """known: 1 for anchors whose context repeats inside the task already, 2 for their common stand-in."""
    for batch in batches:
        gathered: list[list[np.ndarray]] = [[] for _ in range(4)]
        for b in blocks(batch["text"]):
            at, doc, h = anchors(b)
            low, high = _bounds(b, at, doc)
            c = mix(b.hashes(low, high) + (at - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            for part, x in zip(gathered, (h, c, doc + b.first, at - b.starts[doc]), strict=True):
                part.append(x)
        h, c, row, pos = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in gathered)
        known = np.zeros(len(h), dtype=np.int8)
        if len(h):
            key = mix(h ^ mix(c.astype(np.uint64)))
            order = np.argsort(key, kind="stable")
            s = key[order]
            first = np.concatenate([[True], s[1:] != s[:-1]])
            repeated = np.zeros(len(s), dtype=bool)
            repeated[1:] |= ~first[1:]
            repeated[:-1] |= ~first[1:]
            known[order[repeated]] = 1
            heads = order[first & repeated]
            h, c, row, pos = (np.concatenate([x, x[heads]]) for x in (h, c, row, pos))
            known = np.concatenate([known, np.full(len(heads), 2, dtype=np.int8)])
        take = pa.array(row.astype(np.int64))
        yield pa.record_batch(
            [pa.array(h.astype(np.uint64).view(np.int64)), pa.array(c.astype(np.uint64).view(np.int64)), batch["doc_id"].take(take), batch["text_id"].take(take), pa.array(pos.astype(np.int32)), pa.array(known)],
            names=["kmer", "context", "doc_id", "text_id", "pos", "known"],
        )


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours in the order by (kmer, context): what is covered as a whole, what must be compared."""
    held: pa.RecordBatch | None = None  # the last row, whose next is not known yet
    before: tuple[int, int] | None = None  # the row before it

    def judged(rows: pa.Table, n: int, before):
        kmer, context = rows["kmer"].to_numpy(), rows["context"].to_numpy()
        known = rows["known"].to_numpy()
        same = kmer[1:] == kmer[:-1]
        equal = same & (context[1:] == context[:-1])
        prev_same, prev_equal = np.zeros(len(kmer), bool), np.zeros(len(kmer), bool)
        prev_same[1:], prev_equal[1:] = same, equal
        if before is not None and len(kmer):
            prev_same[0] = before[0] == kmer[0]
            prev_equal[0] = prev_same[0] and before[1] == context[0]
        next_same, next_equal = np.append(same, False), np.append(equal, False)
        whole = (prev_equal | next_equal) | (known == 2)
        # One of each run of equal contexts stands for them among the k-mer's others: a
        # run's first or last row, whichever borders on another context.
        compare = (prev_same & ~prev_equal) | (next_same & ~next_equal)
        out = (whole | compare)[:n]
        at = pa.array(np.flatnonzero(out))
        return pa.record_batch([rows["kmer"].combine_chunks().take(at), rows["doc_id"].combine_chunks().take(at), rows["text_id"].combine_chunks().take(at), rows["pos"].combine_chunks().take(at), pa.array(whole[:n][out]), pa.array(compare[:n][out])], names=["kmer", "doc_id", "text_id", "pos", "whole", "compare"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches(([held] if held is not None else []) + [batch])
        n = rows.num_rows - 1
        if n:
            yield judged(rows, n, before)
            last = rows.slice(n - 1, 1)
            before = (last["kmer"][0].as_py(), last["context"][0].as_py())
        held = rows.slice(n, 1).combine_chunks().to_batches()[0]
    if held is not None:
        yield judged(pa.Table.from_batches([held]), 1, before)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each listed anchor, padded to CONTEXT."""
    for batch in batches:
        texts = texts_of(batch["text"]).to_pylist()
        out: list[list] = [[] for _ in range(7)]
        for text, doc, tid, places, kmers in zip(texts, batch["doc_id"].to_pylist(), batch["text_id"].to_pylist(), batch["places"].to_pylist(), batch["kmers"].to_pylist(), strict=True):
            data = text.encode("utf-8", "replace")
            for p, k in zip(places, kmers, strict=True):
                low, high = max(0, p - LEFT), min(len(data), p + WINDOW)
                lead = low - (p - LEFT)
                own = data[low:high]
                row = (k, doc, tid, p, lead, lead + len(own), b"\0" * lead + own + b"\0" * (CONTEXT - lead - len(own)))
                for part, x in zip(out, row, strict=True):
                    part.append(x)
            if len(out[0]) > 5_000:
                yield _context_batch(out, batch)
                out = [[] for _ in range(7)]
        yield _context_batch(out, batch)


def _context_batch(out: list[list], batch: pa.RecordBatch) -> pa.RecordBatch:
    kinds = [pa.int64(), batch["doc_id"].type, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["kmer", "doc_id", "text_id", "pos", "low", "high", "bytes"])


def repeated_windows(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last column at which each context has a repeated window; -1 without any.

    ``rows`` is (n, CONTEXT) bytes, in memory or mapped from a file; [low, high)
    are the columns inside the document.
    """
    n = len(rows)
    first, last = np.full(n, -1, dtype=np.int32), np.full(n, -1, dtype=np.int32)
    if n < 2:
        return first, last
    order = np.arange(n)
    prefix = np.zeros(n + 1, dtype=np.int32)  # with the row above; the entry beyond the last stays 0
    width = 16
    for right in range(CONTEXT, 0, -width):
        left = max(0, right - width)
        columns = np.ascontiguousarray(rows[:, left:right].T).astype(np.uint16)  # one sequential read
        for c in range(right - 1, left - 1, -1):
            symbol = columns[c - left]
            symbol[(c < low) | (c >= high)] = 256
            s = symbol[order]
            step = np.argsort(s, kind="stable")  # a radix sort for 16 bits
            s = s[step]
            # Common prefix of new neighbours: one more than the least between their old places.
            joined = np.flatnonzero(s[1:] == s[:-1]) + 1
            new = np.zeros(n + 1, dtype=np.int32)
            if len(joined):
                a, b = step[joined - 1], step[joined]
                near = b == a + 1
                new[joined[near]] = prefix[b[near]] + 1
                if not near.all():
                    pairs = np.empty(2 * int((~near).sum()), dtype=np.int64)
                    pairs[0::2], pairs[1::2] = a[~near] + 1, b[~near] + 1
                    new[joined[~near]] = np.minimum.reduceat(prefix, pairs)[0::2] + 1
            order, prefix = order[step], new
            if c <= LEFT:
                hit = (prefix[:-1] >= WINDOW) | (prefix[1:] >= WINDOW)
                found = order[hit]
                found = found[(low[found] <= c) & (c + WINDOW <= high[found])]
                first[found] = c
                fresh = found[last[found] < 0]
                last[fresh] = c
    return first, last


def _construct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3 for all contexts of a partition."""
    kept, count = [], 0
    with tempfile.TemporaryFile() as spool:
        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch.select(["doc_id", "text_id", "pos", "low", "high"]))
            for x in batch["bytes"]:
                spool.write(x.as_buffer())
            count += batch.num_rows
        if not count:
            return
        spool.flush()
        spool.seek(0)
        if count <= IN_MEMORY:
            rows = np.frombuffer(spool.read(), dtype=np.uint8).reshape(count, CONTEXT)
        else:
            rows = np.memmap(spool, dtype=np.uint8, mode="r", shape=(count, CONTEXT))
        table = pa.Table.from_batches(kept)
        first, last = repeated_windows(rows, table["low"].to_numpy(), table["high"].to_numpy())
        del rows
    at = np.flatnonzero(first >= 0)
    pos = table["pos"].to_numpy()[at] - LEFT
    found = table.select(["doc_id", "text_id"]).take(pa.array(at))
    found = found.append_column("begin", pa.array((pos + first[at]).astype(np.int32))).append_column("end", pa.array((pos + last[at] + WINDOW).astype(np.int32)))
    yield from found.combine_chunks().to_batches()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open intervals, as maximal runs in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_id and spans (array of begin, end in bytes, not merged) of documents with repeats."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select("doc_id", F.xxhash64(text).alias("text_id"), text.alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    rows = slim.filter(F.octet_length("text") >= WINDOW).mapInArrow(_anchor_rows, f"kmer long, context long, doc_id {kind}, text_id long, pos int, known tinyint")
    rows = saved(rows, "repeat-anchors")
    runs = rows.filter("known <> 1").repartition("kmer").sortWithinPartitions("kmer", "context")
    runs = saved(runs.mapInArrow(_sorted_runs, f"kmer long, doc_id {kind}, text_id long, pos int, whole boolean, compare boolean"), "repeat-runs")
    around = F.struct((F.col("pos") - LEFT).alias("begin"), (F.col("pos") + WINDOW).alias("end"))
    whole = runs.filter("whole").select("doc_id", "text_id", around.alias("span")).union(rows.filter("known = 1").select("doc_id", "text_id", around.alias("span")))
    # Bytes around the anchors that must be compared.
    needed = runs.filter("compare").groupBy("doc_id", "text_id").agg(F.collect_list("pos").alias("places"), F.collect_list("kmer").alias("kmers"))
    needed = saved(needed, "repeat-needed")
    size = needed.agg(F.count("*"), F.sum(F.size("places"))).first()
    spans = whole
    if size[1]:
        ids = needed.select(F.col("doc_id").alias("d"), F.col("text_id").alias("t"))
        mine = slim["doc_id"].eqNullSafe(F.col("d")) & (slim["text_id"] == F.col("t"))
        texts = slim.join(F.broadcast(ids), mine, "left_semi") if size[0] <= FEW_IDS else slim
        texts = texts.dropDuplicates(["doc_id", "text_id"])
        listed = needed.select(F.col("doc_id").alias("d"), F.col("text_id").alias("t"), "places", "kmers")
        texts = texts.join(listed, texts["doc_id"].eqNullSafe(F.col("d")) & (texts["text_id"] == F.col("t"))).drop("d", "t")
        contexts = texts.mapInArrow(_contexts, f"kmer long, doc_id {kind}, text_id long, pos int, low int, high int, bytes binary")
        dealt = contexts.repartition(max(1, -(-size[1] // PER_TASK)), "kmer")
        found = dealt.mapInArrow(_construct, f"doc_id {kind}, text_id long, begin int, end int")
        spans = whole.union(saved(found, "repeat-found").select("doc_id", "text_id", F.struct("begin", "end").alias("span")))
    return spans.groupBy("doc_id", "text_id").agg(F.collect_list("span").alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            part = batch.slice(a, 500)
            gone, kept = [], []
            for text, spans in zip(texts_of(part["text"]).to_pylist(), part["spans"].to_pylist(), strict=True):
                data = text.encode("utf-8", "replace")
                runs = merged([(max(0, s["begin"]), min(len(data), s["end"])) for s in spans or ()])
                pieces, at = [], 0
                for x, y in runs:
                    pieces.append(data[at:x])
                    at = y
                pieces.append(data[at:])
                kept.append(b"".join(pieces))
                gone.append([{"begin": x, "end": y} for x, y in runs])
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.record_batch([part["doc_id"], pa.array(gone, kind), pa.array(kept, pa.binary())], names=["doc_id", "removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, removed (maximal runs of bytes) and kept (remaining bytes, maybe not whole characters)."""
    docs, _ = opened(docs, "doc_id", "text")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select("doc_id", F.xxhash64(text).alias("text_id"), text.alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    spans = repeated_spans(docs).select(F.col("doc_id").alias("d"), F.col("text_id").alias("t"), "spans")
    both = slim.join(spans, slim["doc_id"].eqNullSafe(F.col("d")) & (slim["text_id"] == F.col("t")), "left")
    return both.select("doc_id", "text", "spans").mapInArrow(_cut, f"doc_id {kind}, removed array<struct<begin:int,end:int>>, kept binary")
