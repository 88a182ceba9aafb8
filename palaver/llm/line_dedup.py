"""Line deduplication: explode, hash, count distinct documents, reassemble by position.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, with A-Z
lower-cased.  Keys of at least ``min_chars`` code points that occur in at least
``min_docs`` distinct documents lose all their lines, except in the largest
``doc_id`` that holds them.

Defined results: a null or empty text is one empty line and is never dropped; a
document that loses all its lines keeps the empty text; rows that share a
``doc_id`` count as one document; rows with a null ``doc_id`` take part as one
document that sorts below all others; doc_ids may have any type that has an order; an
empty table gives an empty result; further columns of any name pass through
``dedup_lines`` untouched.

Plan: only 128-bit keys and document ids are shuffled, never lines.  Keys are
made distinct within a document before the shuffle and counted with map-side
partial aggregates, so a line that a third of all documents hold costs a row a
task.  The repeated keys go to all tasks if there are at most ``FEW_KEYS``, and are
joined by a shuffle otherwise.  Texts move once, when drop lists meet their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.blocks import closed, opened, saved, texts_of

#: Repeated keys that are broadcast at most, 16 bytes and a doc_id each.
FEW_KEYS = 500_000
STRIP = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: bytes) -> bytes:
    """The normalised line; ``bytes.lower`` changes A-Z only."""
    return line.strip(STRIP).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _exploded(min_chars: int):
    def _table(doc_ids: pa.Array, keys: list, rows: list, tids: list, places: list) -> pa.RecordBatch:
        ids = doc_ids.take(pa.array(rows, pa.int64()))
        return pa.record_batch([pa.array(keys, pa.binary()), ids, pa.array(tids, pa.int64()), pa.array(places, pa.list_(pa.int32()))], names=["key", "doc_id", "text_id", "positions"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, tids, places = [], [], [], []
            for row, (tid, text) in enumerate(zip(batch["text_id"].to_pylist(), texts_of(batch["text"]).to_pylist(), strict=True)):
                own: dict[bytes, list[int]] = {}
                for i, line in enumerate(text.encode("utf-8", "replace").split(b"\n")):
                    key = line_key(line)
                    if _long_enough(key, min_chars):
                        own.setdefault(_digest(key), []).append(i)
                keys += own
                rows += [row] * len(own)
                tids += [tid] * len(own)
                places += own.values()
                if len(keys) >= 50_000:
                    yield _table(batch["doc_id"], keys, rows, tids, places)
                    keys, rows, tids, places = [], [], [], []
            yield _table(batch["doc_id"], keys, rows, tids, places)

    return run


def dropped_positions(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc_id, text_id, drop array<int>): the 0-based line numbers that each document loses.

    ``text_id`` is a hash of the text, so that rows which share a doc_id but
    not a text have lists of their own.
    """
    lines = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    lines = lines.withColumn("text_id", F.xxhash64("text"))
    kind = lines.schema["doc_id"].dataType.simpleString()
    lines = lines.mapInArrow(_exploded(min_chars), f"key binary, doc_id {kind}, text_id long, positions array<int>")
    # Keys are distinct within a row already; this also merges repeated rows.
    per_doc = lines.select("key", "doc_id").groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    repeated = per_doc.groupBy("key").agg(F.count("one").alias("n_docs"), F.max("doc_id").alias("keeper"))
    repeated = saved(repeated.filter(F.col("n_docs") >= min_docs).select("key", "keeper"), "lines-repeated")
    few = repeated.count() <= FEW_KEYS
    lost = lines.join(F.broadcast(repeated) if few else repeated, "key").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # Equal rows of a document repeat the same positions.
    return lost.groupBy("doc_id", "text_id").agg(F.array_distinct(F.flatten(F.collect_list("positions"))).alias("drop"))


def _apply(schema: T.StructType, report: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch["text"]).to_pylist()
            raw = batch["text"].to_pylist()
            out, n_lines, n_dropped, digests = [], [], [], []
            for text, own, drop in zip(texts, raw, batch["drop"].to_pylist(), strict=True):
                if report:
                    lines = text.encode("utf-8", "replace").split(b"\n")
                    gone = set(drop or ())
                    kept = b"\n".join([x for i, x in enumerate(lines) if i not in gone]) if gone else b"\n".join(lines)
                    n_lines.append(len(lines))
                    n_dropped.append(sum(i < len(lines) for i in gone))
                    digests.append(hashlib.sha256(kept).hexdigest())
                elif drop:
                    gone = set(drop)
                    out.append("\n".join([x for i, x in enumerate(text.split("\n")) if i not in gone]))
                else:
                    out.append(own)
            if report:
                yield pa.record_batch([batch["doc_id"], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])
            else:
                columns = [pa.array(out, pa.string()) if name == "text" else batch[name] for name in schema.names]
                yield pa.record_batch(columns, names=schema.names)

    return run


def _with_drops(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """The opened frame with the column ``drop``."""
    drops = dropped_positions(docs, min_chars, min_docs).select(F.col("doc_id").alias("drop_doc"), F.col("text_id").alias("drop_text"), "drop")
    same = F.col("doc_id").eqNullSafe(F.col("drop_doc")) & (F.xxhash64(F.col("text").cast("string")) == F.col("drop_text"))
    return docs.join(drops, same, "left").drop("drop_doc", "drop_text")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with their remaining lines; all columns stay as they are."""
    docs, names = opened(docs, "doc_id", "text")
    return closed(_with_drops(docs, min_chars, min_docs).mapInArrow(_apply(docs.schema, False), docs.schema), names)


def line_report(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what is kept, per document."""
    slim = opened(docs, "doc_id", "text")[0].select("doc_id", F.col("text").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return _with_drops(slim, min_chars, min_docs).mapInArrow(_apply(slim.schema, True), f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string")
