"""Linkage of members between two id spaces: unique names, a consistent chain, positions between."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.operators.chains import longest_chain
from palaver.operators.names import unique_names
from palaver.operators.ranges import position_fill
from palaver.operators.upsert import number_rows


def anchors(old: DataFrame, new: DataFrame, **options) -> DataFrame:
    """old_pos, new_pos of members with the same unique name whose order agrees: the longest chain."""
    both = unique_names(old).join(unique_names(new).select("key", F.col("pos").alias("new_pos")), "key").select(F.col("pos").alias("old_pos"), "new_pos")
    return longest_chain(both, **options)


def link_members(old: DataFrame, new: DataFrame) -> DataFrame:
    """old_id, new_id, match: 'name' for anchors, 'position' for members between them, 'only-name' for the rest.

    ``old`` and ``new`` have id and key (the compared name).  Members off the chain
    were entered anew: they are matched by their name alone, if it is unique on both
    sides and neither member is taken.
    """
    o, n = number_rows(old, ["id"], "pos"), number_rows(new, ["id"], "pos")
    a = anchors(o, n)
    by_name = a.join(o.select(F.col("pos").alias("old_pos"), F.col("id").alias("old_id")), "old_pos").join(n.select(F.col("pos").alias("new_pos"), F.col("id").alias("new_id")), "new_pos").select("old_id", "new_id", F.lit("name").alias("match"))
    found = by_name.unionByName(position_fill(a, o, n))
    alone = unique_names(old).select(F.col("id").alias("old_id"), "key").join(unique_names(new).select(F.col("id").alias("new_id"), "key"), "key")
    rest = alone.join(found.select("old_id"), "old_id", "left_anti").join(found.select("new_id"), "new_id", "left_anti")
    return found.unionByName(rest.select("old_id", "new_id", F.lit("only-name").alias("match")))


def link_archive(archive: DataFrame, posts: DataFrame) -> DataFrame:
    """topic_id, position, post_id of lite-archive rows (day, author) in their topics.

    Rows take posts of their topic, day and author one after another, each post
    once: the k-th row is the k-th post, so ranks join instead of a loop.
    """
    same = ["topic_id", "day", "author"]
    rank = lambda order: F.row_number().over(Window.partitionBy(*same).orderBy(order))
    a = archive.select(*same, "position", rank("position").alias("k"))
    p = posts.select(*same, F.col("id").alias("post_id"), rank("id").alias("k"))
    return a.join(p, [*same, "k"]).select("topic_id", "position", "post_id")


def link_posts(old: DataFrame, new: DataFrame) -> DataFrame:
    """old_id, new_id, match of posts in the same topic and minute.

    Alone on both sides: 'time'.  Otherwise rows of one author pair off if both
    sides have the author equally often ('time+author'), and what is left pairs by
    order if equally many are left ('time+order').
    """
    def side(df: DataFrame, number: int) -> DataFrame:
        return df.select("topic_id", F.date_trunc("minute", "posted_at").alias("m"), "author", "id", F.lit(number).alias("side"))

    # Both sides in one frame, dealt once by cell and put in order by author: counts of all three rules are windows over it.
    rows = side(old, 0).unionByName(side(new, 1)).repartition("topic_id", "m")
    cell, own = Window.partitionBy("topic_id", "m"), Window.partitionBy("topic_id", "m", "author")
    many = lambda c, w: [F.count_if(c & (F.col("side") == i)).over(w) for i in (0, 1)]
    always = F.lit(True)
    for names, of in ((("ao", "an"), own), (("co", "cn"), cell)):
        rows = rows.withColumns(dict(zip(names, many(always, of), strict=True)))
    alone = (F.col("co") == 1) & (F.col("cn") == 1)
    rows = rows.withColumn("tier", F.when(alone, 1).when(F.col("author").isNotNull() & (F.col("ao") == F.col("an")), 2))
    lo, ln = many(F.col("tier").isNull(), cell)
    rows = rows.withColumns({"lo": lo, "ln": ln})
    rows = rows.withColumn("tier", F.coalesce("tier", F.when(F.col("lo") == F.col("ln"), 3))).filter("tier is not null")
    rows = rows.withColumn("who", F.when(F.col("tier") == 2, F.col("author")))
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("topic_id", "m", "tier", "who", "side").orderBy("id")))
    picked = [F.max(F.when(F.col("side") == i, F.col("id"))).alias(name) for i, name in ((0, "old_id"), (1, "new_id"))]
    pairs = rows.groupBy("topic_id", "m", "tier", "who", "k").agg(*picked)
    return pairs.select("old_id", "new_id", F.get(F.array(F.lit("time"), F.lit("time+author"), F.lit("time+order")), F.col("tier") - 1).alias("match"))
