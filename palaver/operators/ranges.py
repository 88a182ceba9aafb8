"""Joins on ranges and on order: bucketed range join, as-of window, minute and position joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucketed_range_join(left: DataFrame, right: DataFrame, low: Column, high: Column, point: Column, width: int, on: list[tuple[str, str]] = ()) -> DataFrame:
    """Rows with low <= point <= high, as an equi-join on buckets of ``width``.

    ``low``, ``high`` (of left) and ``point`` (of right) are whole numbers.  A
    range spans few buckets if width is about its length; equal columns in ``on``
    join the key, so that the shuffle is dealt by them as well.
    """
    spread = left.withColumn("__low", low).withColumn("__high", high)
    spread = spread.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col("__low") / width), F.floor(F.col("__high") / width))))
    points = right.withColumn("__point", point).withColumn("__at", F.floor(F.col("__point") / width))
    same = F.col("__bucket") == F.col("__at")
    for a, b in on:
        same = same & (spread[a] == points[b])
    joined = spread.join(points, same).filter(F.col("__point").between(F.col("__low"), F.col("__high")))
    return joined.drop("__low", "__high", "__bucket", "__point", "__at")


def minutes(t: Column) -> Column:
    """Whole minutes since 1970 of a timestamp without zone."""
    return F.floor(F.unix_micros(t.cast("timestamp")) / 60_000_000)


def _nearest(last: str, first: str, order: list[str], *group: Column | str) -> tuple[Column, Column]:
    """The nearest ``last`` of the rows before and ``first`` of the rows behind, nulls left out.

    Both are running windows, the second in falling order: a frame from each row to
    the end would be read again for every row.
    """
    running = lambda by: Window.partitionBy(*group).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(last, ignorenulls=True).over(running(map(F.asc, order))), F.last(first, ignorenulls=True).over(running(map(F.desc, order)))


def asof_window(points: DataFrame, known: DataFrame, id_column: str = "id", time_column: str = "ts", group: str | None = None) -> DataFrame:
    """For each point's id the times between which it must lie.

    ``low`` is the time of the last known id before it, ``high`` of the first at or
    after it; both null where one is missing or low is after high.  One union and
    two running windows, dealt by ``group``.
    """
    g = F.col(group) if group else F.lit(0)
    rows = points.withColumn("__t", F.lit(None).cast("timestamp_ntz")).withColumn("__p", F.lit(0))
    marks = known.select(F.col(id_column), *([F.col(group)] if group else []), F.col(time_column).alias("__t"), F.lit(1).alias("__p"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    # A point sorts before a mark of the same id: that mark is "at or after".
    low, high = _nearest("__t", "__t", [id_column, "__p"], g)
    out = both.withColumn("low", low).withColumn("high", high).filter("__p = 0").drop("__p", "__t")
    fine = F.col("low") <= F.col("high")
    return out.withColumn("__l", F.when(fine, F.col("low"))).withColumn("high", F.when(fine, F.col("high"))).withColumn("low", F.col("__l")).drop("__l")


def asof_by_blocks(points: DataFrame, known: DataFrame, id_column: str = "id", time_column: str = "ts", width: int = 4096) -> DataFrame:
    """``asof_window`` without one ordering of all rows: ids are cut into blocks.

    A block's own marks answer inside it; what comes from before or behind it is
    the last or first mark of the nearest other block, of which there is one row
    a block.
    """
    block = F.floor(F.col(id_column) / width)
    ends = known.withColumn("__b", block).groupBy("__b").agg(F.min_by(time_column, id_column).alias("first"), F.max_by(time_column, id_column).alias("last"))
    asked = points.select(block.alias("__b")).distinct().join(ends, "__b", "full_outer")
    ends = carried(asked, "__b", "last", "first").select("__b", F.col("before").alias("__before"), F.col("behind").alias("__behind"))
    rows = points.withColumn("__b", block).withColumn("__t", F.lit(None).cast("timestamp_ntz")).withColumn("__p", F.lit(0))
    marks = known.select(F.col(id_column), block.alias("__b"), F.col(time_column).alias("__t"), F.lit(1).alias("__p"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    low, high = _nearest("__t", "__t", [id_column, "__p"], "__b")
    inside = both.withColumn("__low", low).withColumn("__high", high).filter("__p = 0").drop("__p", "__t")
    out = inside.join(ends, "__b", "left").withColumn("low", F.coalesce("__low", "__before")).withColumn("high", F.coalesce("__high", "__behind"))
    fine = F.col("low") <= F.col("high")
    return out.withColumn("__l", F.when(fine, F.col("low"))).withColumn("high", F.when(fine, F.col("high"))).withColumn("low", F.col("__l")).drop("__b", "__low", "__high", "__before", "__behind", "__l")


def carried(blocks: DataFrame, block: str, last: str, first: str, width: int = 4096) -> DataFrame:
    """block, before, behind: the nearest ``last`` of an earlier and ``first`` of a later block that has one.

    Two levels: windows run within ``width`` blocks, and over one row for each
    ``width`` blocks, so that no task orders more than a share of the blocks.
    """
    group = F.floor(F.col(block) / width)
    rows = blocks.select(block, F.col(last).alias("__last"), F.col(first).alias("__first"), group.alias("__g"))
    tops = rows.groupBy("__g").agg(F.max_by("__last", F.when(F.col("__last").isNotNull(), F.col(block))).alias("l"), F.min_by("__first", F.when(F.col("__first").isNotNull(), F.col(block))).alias("f"))
    (low, high), (before, behind) = _nearest("l", "f", ["__g"]), _nearest("__last", "__first", [block], "__g")
    tops = tops.select("__g", low.alias("__low"), high.alias("__high"))
    joined = rows.select(block, "__g", before.alias("__b1"), behind.alias("__b2")).join(tops, "__g")
    return joined.select(block, F.coalesce("__b1", "__low").alias("before"), F.coalesce("__b2", "__high").alias("behind"))


def following(rows: DataFrame, key: str, columns: list[str], width: int = 65_536, block: Column | None = None) -> DataFrame:
    """The rows with ``next_<column>`` of the row with the next larger ``key``, a whole number or what ``block`` cuts.

    A lead within blocks of keys; a block's last row gets the first row of the next block that has any.
    """
    kept = F.struct(*(F.col(c).alias(c) for c in columns))
    cut = rows.withColumn("__b", F.floor(F.col(key) / width) if block is None else block).withColumn("__own", kept)
    heads = cut.groupBy("__b").agg(F.min_by("__own", key).alias("first")).withColumn("last", F.col("first"))
    behind = carried(heads, "__b", "last", "first").select("__b", "behind")
    ahead = F.lead("__own").over(Window.partitionBy("__b").orderBy(key))
    joined = cut.withColumn("__next", ahead).join(behind, "__b")
    found = F.coalesce("__next", "behind")
    return joined.select(*rows.columns, *(found[c].alias(f"next_{c}") for c in columns))


def day_number(t: Column) -> Column:
    return F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date"))


def first_from(points: DataFrame, marks: DataFrame, at: str, mark_at: str) -> DataFrame:
    """The points with ``found``, the first mark (a struct of its columns) at or after their time; null where there is none.

    One union and a running window within days; a day without a later mark takes
    the first of the next day that has any.  Rows do not multiply with the marks
    around them.  Points and marks without a time take and are none.
    """
    marks = marks.filter(F.col(mark_at).isNotNull())
    mark = F.struct(*(F.col(c).alias(c) for c in marks.columns))
    heads = marks.groupBy(day_number(F.col(mark_at)).alias("__b")).agg(F.min_by(mark, mark_at).alias("first"))
    asked = points.select(day_number(F.col(at)).alias("__b")).filter("__b is not null").distinct().join(heads, "__b", "full_outer").withColumn("last", F.col("first"))
    behind = carried(asked, "__b", "last", "first").select("__b", "behind")
    rows = points.withColumn("__k", F.col(at)).withColumn("__p", F.lit(0))
    both = rows.unionByName(marks.select(F.col(mark_at).alias("__k"), F.lit(1).alias("__p"), mark.alias("__mark")), allowMissingColumns=True).withColumn("__b", day_number(F.col("__k")))
    # A point sorts before a mark of the same time: that mark is "at or after".
    _, own = _nearest("__mark", "__mark", ["__k", "__p"], "__b")
    inside = both.withColumn("__own", own).filter("__p = 0")
    return inside.join(behind, "__b", "left").withColumn("found", F.when(F.col("__k").isNotNull(), F.coalesce("__own", "behind"))).select(*points.columns, "found")


def minute_join(old: DataFrame, new: DataFrame, topic: str = "topic_id", old_time: str = "posted_at", new_time: str = "posted_at") -> DataFrame:
    """old_id, new_id, match of rows alone in their topic and minute on both sides."""
    a = old.select(F.col("id").alias("old_id"), F.col(topic).alias("t"), F.date_trunc("minute", old_time).alias("m"))
    b = new.select(F.col("id").alias("new_id"), F.col(topic).alias("t"), F.date_trunc("minute", new_time).alias("m"))
    alone_a = a.groupBy("t", "m").agg(F.count("*").alias("na"), F.min("old_id").alias("old_id")).filter("na = 1")
    alone_b = b.groupBy("t", "m").agg(F.count("*").alias("nb"), F.min("new_id").alias("new_id")).filter("nb = 1")
    return alone_a.join(alone_b, ["t", "m"]).select("old_id", "new_id", F.lit("time").alias("match"))


def position_fill(anchors: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """Between neighbouring anchors with equal gaps the i-th old row is the i-th new one.

    ``anchors`` has old_pos, new_pos (increasing in both); ``old`` and ``new`` have
    pos and id.
    """
    gaps = following(anchors, "old_pos", ["old_pos", "new_pos"]).withColumnsRenamed({"next_old_pos": "next_old", "next_new_pos": "next_new"})
    gaps = gaps.filter((F.col("next_old") - F.col("old_pos") == F.col("next_new") - F.col("new_pos")) & (F.col("next_old") > F.col("old_pos") + 1))
    steps = gaps.select("old_pos", "new_pos", F.explode(F.sequence(F.lit(1).cast("long"), F.col("next_old") - F.col("old_pos") - 1)).alias("k"))
    pairs = steps.select((F.col("old_pos") + F.col("k")).alias("op"), (F.col("new_pos") + F.col("k")).alias("np"))
    return pairs.join(old.select(F.col("pos").alias("op"), F.col("id").alias("old_id")), "op").join(new.select(F.col("pos").alias("np"), F.col("id").alias("new_id")), "np").select("old_id", "new_id", F.lit("position").alias("match"))
