"""Document fingerprints by Order MinHash, and likeness between neighbouring documents.

``fingerprints`` gives each text a hex string of ``M`` tuple hashes over byte
k-mers (see ``omh``).  ``with_neighbours`` compares every document with an edited
text - its last third replaced by the beginning of the next document in
descending doc_id order - and with that next document.

Defined results: a null or empty text has the fingerprint of no k-mer and
likeness 1 to another such text, 0 to any other; rows that share a doc_id follow
each other in descending order of their texts; the last document's next is the
first, a single document's next is itself; an empty table gives an empty result.

Plan: one range shuffle by doc_id puts neighbours side by side.  Tasks walk their
sorted rows; only the first and last row of each partition, whose neighbour is
elsewhere, meet in a small join by partition number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.blocks import blocks, opened, saved, texts_of
from palaver.llm.omh import byte_kmers, likeness, sketch

K, M, ELL = 12, 64, 2
_BLOCK = 1 << 18


def sketches(texts: pa.Array) -> np.ndarray:
    """(n, M) 16-bit tuple hashes; 0 marks an empty class."""
    out = np.zeros((len(texts), M), dtype=np.uint16)
    for b in blocks(texts, _BLOCK):
        full = sketch(*byte_kmers(b, K), b.n, M, ELL)
        out[b.rows] = np.where(full == 0, 0, full % np.uint64(65_535) + np.uint64(1))
    return out


def _packed(s: np.ndarray) -> pa.Array:
    """Sketches as binary; they become hex only in results, which halves what is written between."""
    return pa.array([row.tobytes() for row in s.astype(">u2")], pa.binary())


def _hex(column: str):
    return F.lower(F.hex(column)).alias(column)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document; no shuffle."""
    docs, _ = opened(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch["doc_id"], _packed(sketches(batch["text"]))], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fingerprint binary").select("doc_id", _hex("fingerprint"))


def edited(text: str, following: str) -> str:
    """The last floor(n / 3) code points replaced by the first as many of the next text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_FIELDS = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], following: list[str], kind: pa.DataType, part: int):
    """The result rows of texts whose next texts are known."""
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    own, new = sketches(pa.array(texts, pa.string())), sketches(pa.array(changed, pa.string()))
    # The next text's sketch is mostly the next row's own.
    after = np.empty_like(own)
    same = [i + 1 < len(texts) and following[i] is texts[i + 1] for i in range(len(texts))]
    rest = [i for i, s in enumerate(same) if not s]
    at = np.flatnonzero(same)
    after[at] = own[at + 1]
    if rest:
        after[rest] = sketches(pa.array([following[i] for i in rest], pa.string()))
    n = len(texts)
    columns = [
        pa.array([0] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(ids, kind), pa.nulls(n, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed], pa.string()), _packed(own), _packed(new),
        pa.array(likeness(own, new, ELL)), pa.array(likeness(own, after, ELL)),
    ]
    return pa.record_batch(columns, names=_NAMES)


_NAMES = ["edge", "part", "doc_id", "text", *(f.split()[0] for f in _FIELDS.split(", "))]


def _edge(edge: int, part: int, doc_id, text: str, kind: pa.DataType):
    head = [pa.array([edge], pa.int32()), pa.array([part], pa.int32()), pa.array([doc_id], kind), pa.array([text], pa.string())]
    rest = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    return pa.record_batch([*head, *(pa.nulls(1, t) for t in rest)], names=_NAMES)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    ids: list = []
    texts: list[str] = []
    kind = None
    for batch in batches:
        column = texts_of(batch["text"])
        for a in range(0, batch.num_rows, 512):
            new = column.slice(a, 512).to_pylist()
            if kind is None and new:
                kind = batch["doc_id"].type
                yield _edge(1, part, batch["doc_id"][0].as_py(), new[0], kind)
            ids += batch["doc_id"].slice(a, 512).to_pylist()
            texts += new
            if len(texts) > 1:
                yield _compared(ids[:-1], texts[:-1], texts[1:], kind, part)
                ids, texts = ids[-1:], texts[-1:]
    if texts:
        yield _edge(2, part, ids[0], texts[0], kind)


def _join_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 64):
            own = batch.slice(a, 64)
            yield _compared(own["doc_id"].to_pylist(), own["text"].to_pylist(), own["following"].to_pylist(), own["doc_id"].type, -1)


def with_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next."""
    docs, _ = opened(docs, "doc_id", "text")
    spark = docs.sparkSession
    slim = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    fields = f"edge int, part int, doc_id {kind}, text string, {_FIELDS}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = slim.repartitionByRange(n, F.col("doc_id").desc_nulls_last()).sortWithinPartitions(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    rows = saved(ranged.mapInArrow(_walk, fields), "fingerprints")
    heads, tails = rows.filter("edge = 1"), rows.filter("edge = 2")
    parts = [r[0] for r in heads.select("part").orderBy("part").collect()]  # one number a partition
    result = rows.filter("edge = 0")
    if parts:
        order = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, next_part int")
        pairs = tails.select("part", "doc_id", "text").join(order, "part")
        pairs = pairs.join(heads.select(F.col("part").alias("next_part"), F.col("text").alias("following")), "next_part")
        result = result.unionByName(pairs.select("doc_id", "text", "following").mapInArrow(_join_edges, fields))
    return result.select("doc_id", "n_chars", "edited_sha256", _hex("fingerprint"), _hex("edited_fingerprint"), "near_edited", "near_next")
