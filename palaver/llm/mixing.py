"""Mixing sources to target weights along a low-discrepancy schedule.

The mix is as long as the input.  Each source's target is its weight's share,
but at most ``max_epochs`` times its own size; what is cut off goes to the other
sources by weight, until no target is above its limit (water filling).

The schedule has about ``slots`` slots of equal token counts.  Slot t maps the
golden-ratio point frac((t + 1) * phi) through the cumulative targets to a
source; its rank among the source's slots picks the next block of that source's
stream - its documents in hash order, one after another, repeated as needed.
The blocks of a source are joined to its ranked slots, so any prefix of the
schedule is balanced too.  A source's slots miss its target by a few blocks; the
blocks it still lacks follow the schedule, and its last block ends at the target,
so that every source is taken to the word, however small it is beside a block.

Defined results: sizes are counts of runs of non-``[\\x20\\x09-\\x0D]`` (a null text
has size 0); a null source is a source of its own and sorts last; documents of
size 0 are taken 0 times; repeated doc_ids are separate documents, ordered by
text; an empty table gives an empty result.  No document is taken more than
``max_epochs`` times.

Plan: one row a source is gathered for the targets.  Stream positions come from
two-level prefix sums: a source is cut into ``buckets`` ranges of the hash
order, bucket totals are summed ahead by source, rows only within their bucket;
a source with a third of all rows so spreads over thousands of groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.blocks import blocks, closed, opened, rows_per_batch, saved

#: Texts that a Python worker holds at once.
TEXTS = 1000

PHI = 0.6180339887498949


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.zeros(batch.num_rows, dtype=np.int64)
        for b in blocks(batch["text"]):
            size[b.rows] = np.bincount(b.words()[2], minlength=b.n)
        keep = [i for i, n in enumerate(batch.schema.names) if n != "text"]
        yield pa.record_batch([*(batch.column(i) for i in keep), pa.array(size)], names=[*(batch.schema.names[i] for i in keep), "size"])


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, text hash and size of each document; no text goes further."""
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(F.col("text").cast("string")).alias("text_id"), F.col("text").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_count, f"doc_id {kind}, source string, text_id long, size long")


def targets(sized: DataFrame, weights=(1.0, 2.0, 3.0), max_epochs: float = 3.0) -> DataFrame:
    """source, source_size, target: water filling over one row a source.

    Source i (by code point, null last) weighs weights[i mod len(weights)].  A
    source is at its limit when limit / weight is at most the common level;
    walking sources by that ratio, the level is what the limits before leave,
    over the weight that is left.
    """
    each = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    each = each.withColumn("i", F.row_number().over(order) - 1)
    each = each.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("i") % len(weights) + 1).cast("int")))
    each = each.withColumn("limit", F.col("source_size") * F.lit(float(max_epochs)))
    walk = Window.orderBy(F.col("limit") / F.col("weight"), "i")
    all_rows = Window.partitionBy(F.lit(0))
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    each = (
        each.withColumn("total", F.sum("source_size").over(all_rows).cast("double"))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("weight_left"))
        .withColumn("at_limit", F.col("limit") / F.col("weight") <= F.col("level"))
        .withColumn("shared", F.min(F.when(~F.col("at_limit"), F.struct(F.col("limit") / F.col("weight"), "i", "level"))).over(all_rows)["level"])
    )
    target = F.when(F.col("at_limit"), F.col("limit")).otherwise(F.col("shared") * F.col("weight"))
    return each.select("source", "source_size", "i", target.alias("target"))


def _points(bounds: list[float], of: list[int]):
    """Slots to sources: bounds are the cumulative shares, ``of`` the source numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, numbers = np.array(bounds), np.array(of, dtype=np.int32)
        for batch in batches:
            slot = batch["id"].to_numpy()
            # Whole multiples of 2**64 * phi wrap exactly, so large slots lose no precision.
            x = ((slot.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)).astype(np.float64) / 2.0**64
            i = np.minimum(np.searchsorted(edges, x, side="right"), len(numbers) - 1)
            yield pa.record_batch([pa.array(slot), pa.array(numbers[i])], names=["slot", "i"])

    return run


def schedule(per_source: DataFrame, slots: int) -> DataFrame:
    """slot, i (source number), rank of the slot among its source's slots.

    Ranks come from two-level counts too: slots are cut into runs of 4,096.
    """
    spark = per_source.sparkSession
    rows = per_source.filter("target > 0").orderBy("i").collect()  # one row a source
    if not rows or slots <= 0:
        return spark.createDataFrame([], "slot long, i int, rank long")
    shares = np.cumsum([r["target"] for r in rows]) / sum(r["target"] for r in rows)
    drawn = spark.range(slots).mapInArrow(_points([float(x) for x in shares], [r["i"] for r in rows]), "slot long, i int")
    drawn = drawn.withColumn("run", F.floor(F.col("slot") / 4096))
    counts = drawn.groupBy("i", "run").agg(F.count("*").alias("n"))
    ahead = counts.select("i", "run", (F.sum("n").over(Window.partitionBy("i").orderBy("run")) - F.col("n")).alias("ahead"))
    ranked = drawn.withColumn("within", F.row_number().over(Window.partitionBy("i", "run").orderBy("slot")) - 1)
    return ranked.join(ahead, ["i", "run"]).select("slot", "i", (F.col("ahead") + F.col("within")).alias("rank"))


def streams(sized: DataFrame, buckets: int = 4096) -> DataFrame:
    """Each document's first position in its source's stream (column ``begin``)."""
    order = F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("text_id"))
    placed = sized.withColumn("at", order).withColumn("bucket", F.floor((F.col("at") / F.lit(2.0**64) + 0.5) * buckets).cast("int"))
    totals = placed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    ahead = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("ahead"))
    within = Window.partitionBy("source", "bucket").orderBy("at", "doc_id", "text_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("to", F.sum("size").over(within))
    joined = placed.join(ahead, placed["source"].eqNullSafe(ahead["s"]) & (placed["bucket"] == ahead["b"]))
    return joined.select("doc_id", "source", "text_id", "size", (F.col("ahead") + F.col("to") - F.col("size")).alias("begin"))


def mix(docs: DataFrame, weights=(1.0, 2.0, 3.0), max_epochs: int = 3, slots: int = 1 << 17) -> DataFrame:
    """doc_id, source, text_id, size, source_size, target, taken of every document."""
    with rows_per_batch(docs.sparkSession, TEXTS):
        sized = saved(sizes(opened(docs, "doc_id", "text", "source")[0]), "mix-sizes")
    per_source = saved(targets(sized, weights, max_epochs), "mix-targets")
    total = per_source.agg(F.sum("source_size")).first()[0] or 0
    block = max(1, -(-total // slots))  # tokens in a block
    plan = schedule(per_source, -(-total // block)).select("i", F.col("rank").alias("block"))
    wanted = F.round("target").cast("long")
    lacking = per_source.join(plan.groupBy("i").agg(F.count("*").alias("n")), "i", "left").select("i", F.coalesce("n", F.lit(0)).alias("n"), F.ceil(wanted / block).alias("needed")).filter("n < needed")
    plan = plan.union(lacking.select("i", F.explode(F.sequence("n", F.col("needed") - 1)).alias("block")))
    known = F.broadcast(per_source) if per_source.count() <= 100_000 else per_source
    placed = streams(sized).alias("p").join(known.alias("k"), F.col("p.source").eqNullSafe(F.col("k.source")))
    placed = placed.select("p.*", "k.source_size", "k.target", "k.i").withColumn("row", F.struct("doc_id", "text_id", "begin"))
    # A document's words lie in a few blocks of each pass over its source.
    passes = placed.filter("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    low = F.col("begin") + F.col("pass") * F.col("source_size")
    passes = passes.select("row", "size", "i", low.alias("low"), F.least(low + F.col("size"), wanted).alias("high")).filter("low < high")
    first, last = F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block)
    pieces = passes.withColumn("block", F.explode(F.sequence(first, last)))
    overlap = F.least(F.col("high"), (F.col("block") + 1) * block) - F.greatest(F.col("low"), F.col("block") * block)
    taken = pieces.withColumn("words", overlap).join(plan, ["i", "block"]).groupBy("i", "row").agg(F.sum("words").alias("taken"))
    out = placed.join(taken, ["i", "row"], "left")
    return out.select("doc_id", "source", "text_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as the schedule takes it, rounded to whole texts.

    A document without words costs no tokens and is kept once.
    """
    docs, names = opened(docs, "doc_id", "text", "source")
    shares = mix(docs, **options).select(F.col("doc_id").alias("mix_doc"), F.col("text_id").alias("mix_text"), F.col("source").alias("mix_source"), "size", "taken")
    shares = shares.groupBy("mix_doc", "mix_text", "mix_source").agg(F.max("size").alias("size"), F.max("taken").alias("taken"))  # repeated rows alike
    times = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int")
    shares = shares.select("mix_doc", "mix_text", "mix_source", times.alias("mix_times")).filter("mix_times > 0")
    same = docs["doc_id"].eqNullSafe(F.col("mix_doc")) & (F.xxhash64(docs["text"].cast("string")) == F.col("mix_text")) & docs["source"].cast("string").eqNullSafe(F.col("mix_source"))
    repeated = docs.join(shares, same).withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_times"))))
    return closed(repeated.select(*[F.col(f"`{c}`") for c in docs.columns]), names)
