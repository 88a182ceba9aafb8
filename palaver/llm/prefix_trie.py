"""Prefix trie of conversations from mergeable partial tries.

A node is a distinct sequence of first turns (role, text).  Its key is a 127-bit
hash chain: the parent's key times a base, plus the MD5 of the turn, modulo a
prime.  Such chains can be continued from any point, so a conversation may lie in
several partitions.

* ``keyed_turns`` sorts the turns and numbers them; texts go no further.
* ``prefix_trie`` sorts (conversation, place) rows into ranges, chains the keys
  along each partition, and hands what runs over a border from one partition to
  the next: two rows a partition reach the driver.  Every task folds its rows
  into a partial trie, emitted as a table of nodes whenever it is full; tables
  are merged by key, first within groups of partitions, then altogether, so a
  node that all conversations share costs a row a group.
* ``rolled_up`` sums subtrees bottom-up along conversations instead of level by
  level, so a trie may be of any depth: what a node is worth is booked with its
  smallest member and summed from that conversation's end to its start; the sums
  of a node's members then are its subtree's.  A window holds the rows of one
  conversation in one partition at most.
* ``end_digests`` sorts the ends by node and number.  A node's digest is taken in
  the task that holds all its ends; what lies in several partitions goes on as
  packed runs of text and is hashed in order, as SHA-256 must be, in a stream.

Defined results: null roles and texts are empty ones; null turns come first, ties
are ordered by role and text, and repeated rows are turns of their own; rows
without a whole number as conv_id are left out; an empty text has no words; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.blocks import opened, saved

MODULUS = (1 << 127) - 1
BASE = 0x5DEECE66D1234567_89ABCDEF0F1E2D3C % MODULUS
ROOT = 1

#: Rows that a task gathers before it folds them, and nodes that it keeps before it emits them.
FOLD = 1 << 17


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls defined away."""
    rows = opened(conversations, "conv_id", "turn", "role", "text")[0]
    whole = F.expr("try_cast(conv_id as bigint)")
    return rows.select(whole.alias("conv_id"), "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))).filter("conv_id is not null")


def keyed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (1, 2, ... in the conversation), digest and number of words of each turn."""
    rows = turn_rows(conversations)
    # The range is cut by bounded keys that order rows as the whole texts do.
    cut = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.substring("role", 1, 64), F.length("role") > 64, F.when(F.length("role") <= 64, F.substring("text", 1, 64))]
    rows = rows.repartitionByRange(*cut).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    rows = rows.select("conv_id", digest.alias("digest"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    paths, starts, _ = _paths(rows, "trie-turns")
    return _continued(paths, starts, set()).select("conv_id", F.col("n").alias("pos"), "digest", "words")


def openings(keyed: DataFrame) -> DataFrame:
    """The row that opens each conversation: place 0, no turn."""
    none = F.lit(None).cast("binary").alias("digest")
    return keyed.filter("pos = 1").select("conv_id", F.lit(0).cast("long").alias("pos"), none, F.lit(0).cast("long").alias("words"))


def with_shared_heads(keyed: DataFrame, family: int = 20, longest: int = 3) -> DataFrame:
    """Rebuilt conversations: the first h turns come from the first conversation of the family.

    h is crc32(conv_id) mod (longest + 1).  Only heads, ``longest`` turns of one
    conversation in ``family``, are joined; other turns stay as they are.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    heads = keyed.filter((F.col("conv_id") % family == 0) & (F.col("pos") <= longest))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.collect_list(F.struct("pos", "digest", "words")).alias("head"))
    first = keyed.filter("pos = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    taken = first.filter("h > 0").join(heads, "base").select("conv_id", "h", F.explode("head").alias("t")).filter("t.pos <= h").select("conv_id", "t.pos", "t.digest", "t.words")
    own = keyed.filter(F.col("pos") > h).select("conv_id", (F.col("pos") + longest).alias("pos"), "digest", "words")
    return openings(keyed).unionByName(taken).unionByName(own)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and chain the rows of a sorted partition; the last two rows tell of its borders."""
    part = TaskContext.get().partitionId()
    kept: list[tuple] = []
    conv, n, h = None, 0, 0
    first = None
    for batch in batches:
        for c, digest, words in zip(batch["conv_id"].to_pylist(), batch["digest"].to_pylist(), batch["words"].to_pylist(), strict=True):
            if c != conv:
                if kept:
                    kept[-1] = (*kept[-1][:7], True, False, None)
                    first = first or (conv, n, h)
                conv, n, h = c, 0, 0
            n, before = n + 1, h
            h = ROOT if digest is None else (h * BASE + int.from_bytes(digest, "big")) % MODULUS
            kept.append((c, part, n, h.to_bytes(16, "big"), before.to_bytes(16, "big"), digest, words, False, False, None))
        if len(kept) > 1:
            yield _batch(kept[:-1])
            kept = kept[-1:]
    if kept:
        first = first or (conv, n, h)
        kept[-1] = (*kept[-1][:7], True, True, None)
        for edge, (c, m, x) in enumerate((first, (conv, n, h))):
            kept.append((c, part, m, x.to_bytes(16, "big"), None, None, None, None, None, edge))
        yield _batch(kept)


_FIELDS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("digest", pa.binary()), ("words", pa.int64()), ("last", pa.bool_()), ("tail", pa.bool_()), ("edge", pa.int32())])
_KINDS = "conv_id long, part int, n long, key binary, parent binary, digest binary, words long, last boolean, tail boolean, edge int"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=_FIELDS)


def _paths(rows: DataFrame, name: str) -> tuple[DataFrame, dict[int, tuple[int, int, int]], set[int]]:
    """The chained rows, what each partition's first conversation brings along, and partitions whose last one goes on."""
    table = saved(rows.mapInArrow(_chain, _KINDS), name)
    edges: dict[int, dict[int, tuple]] = {}
    for r in table.filter("edge is not null").select("part", "edge", "conv_id", "n", "key").collect():  # two a partition
        edges.setdefault(r["part"], {})[r["edge"]] = (r["conv_id"], r["n"], int.from_bytes(r["key"], "big"))
    starts, going, before, carry = {}, set(), None, None
    for part in sorted(edges):
        first, last = edges[part][0], edges[part][1]
        if carry and carry[0] == first[0]:
            starts[part] = carry
            going.add(before)
            if last[0] == first[0]:
                last = (first[0], carry[1] + first[1], (carry[2] * pow(BASE, first[1], MODULUS) + first[2]) % MODULUS)
        before, carry = part, last
    return table.filter("edge is null").drop("edge"), starts, going


def _continued(paths: DataFrame, starts: dict[int, tuple[int, int, int]], going: set[int]) -> DataFrame:
    """The chained rows with numbers and keys that count from the conversation's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, on = np.array(sorted(starts), dtype=np.int32), np.array(sorted(going), dtype=np.int32)
        for batch in batches:
            part = batch["part"].to_numpy()
            conv, n = batch["conv_id"].to_numpy(), batch["n"].to_numpy().copy()
            last = batch["last"].to_numpy(zero_copy_only=False) & ~(batch["tail"].to_numpy(zero_copy_only=False) & np.isin(part, on))
            key, parent = batch["key"], batch["parent"]
            some = [i for i in np.flatnonzero(np.isin(part, begun)) if starts[int(part[i])][0] == conv[i]]
            if some:
                key, parent = key.to_pylist(), parent.to_pylist()
                for i in some:
                    _, ahead, h = starts[int(part[i])]
                    back = h * pow(BASE, int(n[i]) - 1, MODULUS)
                    parent[i] = ((back + int.from_bytes(parent[i], "big")) % MODULUS).to_bytes(16, "big")
                    key[i] = ((back * BASE + int.from_bytes(key[i], "big")) % MODULUS).to_bytes(16, "big")
                    n[i] += ahead
                key, parent = pa.array(key, pa.binary()), pa.array(parent, pa.binary())
            yield pa.record_batch([batch["conv_id"], batch["part"], pa.array(n), key, parent, batch["digest"], batch["words"], pa.array(last)], names=names)

    names = ["conv_id", "part", "n", "key", "parent", "digest", "words", "last"]
    return paths.mapInArrow(run, "conv_id long, part int, n long, key binary, parent binary, digest binary, words long, last boolean")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's partial trie: one row a node, emitted when the trie is full and at the end."""

    def fold(tables: list[pa.Table]) -> pa.Table:
        sums = [("n_convs", "sum"), ("n_ends", "sum"), ("conv_id", "min"), ("depth", "max"), ("words", "max"), ("parent", "one")]
        made = pa.concat_tables(tables).group_by("key", use_threads=False).aggregate(sums)
        return made.rename_columns([c.removesuffix("_sum").removesuffix("_min").removesuffix("_max").removesuffix("_one") for c in made.column_names]).select(names)

    names = ["key", "parent", "depth", "conv_id", "n_convs", "n_ends", "words"]
    part = TaskContext.get().partitionId()
    kept, rows = [], 0

    def emitted(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for b in table.combine_chunks().to_batches(max_chunksize=10_000):
            yield pa.record_batch([*b.columns, pa.array(np.full(b.num_rows, part, dtype=np.int32))], names=[*names, "part"])

    for batch in batches:
        one = pa.array(np.ones(batch.num_rows, dtype=np.int64))
        ends = batch["last"].cast(pa.int64())
        kept.append(pa.table([batch["key"], batch["parent"], batch["depth"], batch["conv_id"], one, ends, batch["words"]], names=names))
        rows += batch.num_rows
        if rows >= FOLD:
            kept = [fold(kept)]
            rows = kept[0].num_rows
            if rows >= FOLD // 2:
                yield from emitted(kept[0])
                kept, rows = [], 0
    if kept:
        yield from emitted(fold(kept))


def _merged(nodes: DataFrame, *by) -> DataFrame:
    return nodes.groupBy("key", *by).agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_ends").alias("n_ends"), F.max("words").alias("words"),
    )


def prefix_trie(ordered: DataFrame, fan: int = 16) -> tuple[DataFrame, DataFrame, list[int]]:
    """Nodes and paths of conversations given as conv_id, pos, digest, words, each opened by a row without a digest.

    Nodes: key, parent, depth, conv_id (smallest member), n_convs, n_ends, words (of
    the last text).  Paths: conv_id, part, depth, key, parent, words, last, one row a
    conversation and prefix.  Third, the conversations that lie in several partitions,
    at most one a partition.
    """
    rows = ordered.repartitionByRange("conv_id", "pos").sortWithinPartitions("conv_id", "pos").select("conv_id", "digest", "words")
    table, starts, going = _paths(rows, "trie-paths")
    paths = _continued(table.withColumn("digest", F.lit(None).cast("binary")), starts, going).select("conv_id", "part", (F.col("n") - 1).alias("depth"), "key", "parent", "words", "last")
    partial = paths.select("key", "parent", "depth", "conv_id", "words", "last").mapInArrow(_folded, "key binary, parent binary, depth long, conv_id long, n_convs long, n_ends long, words long, part int")
    nodes = saved(_merged(_merged(partial, F.pmod(F.hash("part"), F.lit(fan)).alias("group"))), "trie-nodes")
    return nodes, paths, sorted({c for c, _, _ in starts.values()})


def rolled_up(nodes: DataFrame, paths: DataFrame, spread: list[int]) -> DataFrame:
    """Nodes with parent_conv_id, n_children, n_leaves and saved_tokens of their subtrees.

    The root's sums are those of all nodes, so its rows, one a conversation, move nowhere.
    """
    spark = nodes.sparkSession
    below = nodes.filter("depth > 0").select("key", F.col("conv_id").alias("least"), ((F.col("n_convs") - 1) * F.col("words")).alias("worth"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"))
    own = F.col("least") == F.col("conv_id")
    rows = paths.filter("depth > 0").select("conv_id", "part", "depth", "key").join(below, "key")
    rows = rows.select("conv_id", "part", "depth", "key", F.when(own, F.col("worth")).otherwise(0).alias("worth"), F.when(own, F.col("leaf")).otherwise(0).alias("leaf"))
    to_end = Window.partitionBy("conv_id", "part").orderBy(F.col("depth").desc())
    summed = rows.select("conv_id", "part", "key", F.sum("worth").over(to_end).alias("worth"), F.sum("leaf").over(to_end).alias("leaf"))
    if spread:  # what lies in later partitions, for at most one conversation a partition
        which = F.broadcast(spark.createDataFrame([(c,) for c in spread], "conv_id long"))
        ends = rows.join(which, "conv_id").groupBy("conv_id", "part").agg(F.sum("worth").alias("w"), F.sum("leaf").alias("l"))
        later = Window.partitionBy("conv_id").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select("conv_id", "part", F.sum("w").over(later).alias("w"), F.sum("l").over(later).alias("l"))
        summed = summed.join(F.broadcast(ends), ["conv_id", "part"], "left")
        summed = summed.select("key", (F.col("worth") + F.coalesce("w", F.lit(0))).alias("worth"), (F.col("leaf") + F.coalesce("l", F.lit(0))).alias("leaf"))
    sums = summed.groupBy("key").agg(F.sum("worth").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    root = nodes.filter("depth = 0").select("key")
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("long")
    everything = nodes.agg(F.sum(F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)).alias("saved_tokens"), F.sum(leaf).alias("n_leaves"))
    sums = sums.unionByName(root.crossJoin(F.broadcast(everything)))  # one row beside one row
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, "key").join(children, "key", "left").join(parents, "parent", "left")
    above = F.when(F.col("depth") > 0, F.col("parent_conv_id"))
    return out.select("key", "conv_id", "depth", above.alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens")


#: Ends in a run of text.
RUN = 512


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of nodes whose ends make one run inside this sorted partition; runs of text of all others."""
    part = TaskContext.get().partitionId()
    key, ids, number, inner, out = None, [], 0, False, []

    def close(whole: bool) -> None:
        text = ",".join(map(str, ids)).encode()
        if whole and not number:
            out.append((key, hashlib.sha256(text).hexdigest(), None, None, None))
        elif ids:
            out.append((key, None, part, number, text))

    for batch in batches:
        for k, c in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    close(inner)  # the first may have begun before, the last may go on
                    inner = True
                key, ids, number = k, [], 0
            ids.append(c)
            if len(ids) == RUN:
                out.append((key, None, part, number, ",".join(map(str, ids)).encode()))
                ids, number = [], number + 1
        if len(out) >= 1024:
            yield _ends(out)
            out = []
    if key is not None:
        close(False)
    if out:
        yield _ends(out)


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.binary())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "ends_sha256", "part", "number", "run"])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of text in order to one digest a node, without gathering them."""
    key, digest = None, None
    for batch in batches:
        done = []
        for k, run in zip(batch["key"].to_pylist(), batch["run"].to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(run)
            else:
                digest.update(b"," + run)
        if done:
            yield pa.record_batch([pa.array(c) for c in zip(*done, strict=True)], names=["key", "ends_sha256"])
    if key is not None:
        yield pa.record_batch([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])


def end_digests(paths: DataFrame) -> DataFrame:
    """key and ends_sha256 of every node where conversations end: their numbers, ascending, joined by commas."""
    ends = paths.filter("last").select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    packed = saved(ends.mapInArrow(_packed, "key binary, ends_sha256 string, part int, number long, run binary"), "trie-ends")
    runs = packed.filter("run is not null").select("key", "part", "number", "run").repartition("key").sortWithinPartitions("key", "part", "number")
    return packed.filter("run is null").select("key", "ends_sha256").unionByName(runs.select("key", "run").mapInArrow(_streamed, "key binary, ends_sha256 string"))


def trie_report(conversations: DataFrame, family: int = 20, longest: int = 3) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with the sums of its subtree and a digest of its ends."""
    keyed = keyed_turns(conversations)
    nodes, paths, spread = prefix_trie(with_shared_heads(keyed, family, longest))
    out = rolled_up(nodes, paths, spread).join(end_digests(paths), "key", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
