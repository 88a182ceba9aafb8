"""Choices in order: each row takes at most one candidate, and none that an earlier row took.

A row's choice depends on what rows before it took of its candidates.  All rows
that come first for every candidate they still have are decided in one round, each
round a few joins; what they take, and they themselves, leave the table of pairs.
The result is that of deciding row after row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.operators.shared import materialized


def choose_in_order(pairs: DataFrame, pick: Callable[[DataFrame], DataFrame], hopeless: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """row, candidate: what each row takes.

    ``pairs``: row (comparable, earlier is less), candidate and whatever ``pick``
    needs; ``pick`` gives (row, candidate) for the rows that can decide now.
    ``hopeless`` may leave out pairs whose rows can take nothing any more.
    """
    left, chosen = pairs, None
    while True:
        left = materialized(hopeless(left) if hopeless else left, "choice-left")
        if left.isEmpty():
            return chosen if chosen is not None else pick(left)
        first = left.withColumn("__first", F.min("row").over(Window.partitionBy("candidate")) == F.col("row"))
        ready = first.withColumn("__ready", F.min("__first").over(Window.partitionBy("row"))).drop("__first")
        ready = materialized(ready, "choice-ready")
        taken = materialized(pick(ready.filter("__ready").drop("__ready")), "choice-taken")
        chosen = taken if chosen is None else chosen.unionByName(taken)
        left = ready.filter("not __ready").drop("__ready").join(taken.select("candidate"), "candidate", "left_anti")


def only_candidate(rows: DataFrame) -> DataFrame:
    """The candidate of rows that have one alone."""
    return rows.groupBy("row").agg(F.count("*").alias("n"), F.min("candidate").alias("candidate")).filter("n = 1").select("row", "candidate")


def interpolate_references(references: DataFrame, posts: DataFrame, taken: DataFrame) -> DataFrame:
    """old_id, post_id of references (old_id, topic_id, low, high) to whose time one untaken post of the topic fits.

    ``taken``: post_id of posts that others are known to be.  References are decided
    by old_id; in a topic, those before the first with a single candidate have none.
    """
    free = posts.join(taken.select(F.col("post_id").alias("id")), "id", "left_anti")
    same = references.withColumnRenamed("topic_id", "__t")
    pairs = same.join(free, (F.col("__t") == F.col("topic_id")) & F.col("posted_at").between(F.col("low"), F.col("high"))).select(F.col("old_id").alias("row"), F.col("id").alias("candidate"), "topic_id")

    def hopeless(rows: DataFrame) -> DataFrame:
        single = F.count("*").over(Window.partitionBy("row")) == 1
        begin = F.min(F.when(F.col("__single"), F.col("row"))).over(Window.partitionBy("topic_id"))
        return rows.withColumn("__single", single).withColumn("__begin", begin).filter(F.col("row") >= F.col("__begin")).drop("__single", "__begin")

    return choose_in_order(pairs, only_candidate, hopeless).select(F.col("row").alias("old_id"), F.col("candidate").alias("post_id"))


def link_archive_rows(archive: DataFrame, posts: DataFrame) -> DataFrame:
    """topic_id, position, post_id of archive rows (topic_id, position, author, day), which have no ids.

    ``posts``: id, topic_id, day, place (from 0 on) and names, all under which the
    author was known.  Of the day's posts in the topic that are left, the one by the
    author, of several the nearest to the position; or else the one at the position
    after it, if its author is unknown.
    """
    row = F.struct("topic_id", "position")
    p = posts.select("topic_id", "day", F.col("id").alias("candidate"), "place", "names")
    pairs = archive.join(p, ["topic_id", "day"]).select(row.alias("row"), "candidate", F.coalesce(F.array_contains("names", F.col("author")), F.lit(False)).alias("named"),
                                                        ((F.col("place") == F.col("position") + 1) & (F.size("names") == 0)).alias("placed"), F.abs(F.col("place") - F.col("position") - 1).alias("far"))

    def pick(rows: DataFrame) -> DataFrame:
        own = Window.partitionBy("row")
        rows = rows.withColumn("near", F.min(F.when(F.col("named"), F.col("far"))).over(own))
        nearest = F.coalesce(F.col("named") & (F.col("far") == F.col("near")), F.lit(False))
        rows = rows.withColumn("nearest", nearest).withColumn("n", F.count_if("nearest").over(own)).withColumn("m", F.count_if("placed").over(own))
        return rows.filter(F.when(F.col("n") == 1, F.col("nearest")).otherwise((F.col("m") == 1) & F.col("placed"))).select("row", "candidate")

    return choose_in_order(pairs.filter("named or placed"), pick).select("row.topic_id", "row.position", F.col("candidate").alias("post_id"))


def tie_attachments(rows: DataFrame, attachments: DataFrame, blocks: DataFrame) -> DataFrame:
    """post_id, ref, attachment_id of the old board's attachment rows (post_id, ref, kind).

    ``attachments``: id, url, old_attach_id.  ``blocks``: post_id, url of the file each
    post came with.  An image is tied by its address; a file by its post's own upload,
    or else by its number, of several attachments the least.
    """
    from palaver.functions.attachments import canonical

    by_url = attachments.groupBy("url").agg(F.min("id").alias("by_url"))
    by_number = attachments.filter("old_attach_id is not null").groupBy("old_attach_id").agg(F.min("id").alias("by_number"))
    upload = blocks.join(by_url, "url").groupBy("post_id").agg(F.min("by_url").alias("by_upload"))
    image = F.col("kind") == "image"
    asked = rows.withColumn("url", F.when(image, canonical(F.col("ref"))["url"])).withColumn("old_attach_id", F.when(~image & F.col("ref").rlike(r"^\d+$"), F.col("ref").try_cast("long")))
    out = asked.join(by_url, "url", "left").join(by_number, "old_attach_id", "left").join(upload, "post_id", "left")
    return out.select("post_id", "ref", F.when(image, F.col("by_url")).otherwise(F.coalesce("by_upload", "by_number")).alias("attachment_id"))


def pair_attachments(attachments: DataFrame, blocks: DataFrame) -> DataFrame:
    """attach_id, upload_id, source_id, target_id: numbered attachments paired with the upload of the post of that number.

    They are the same file; where one alone has data, it is the source of the other.
    """
    uploads = attachments.select(F.col("id").alias("upload_id"), "url", F.col("data").isNotNull().alias("there"))
    own = blocks.join(uploads, "url").groupBy("post_id").agg(F.min(F.struct("upload_id", "there")).alias("u"))
    numbered = attachments.filter("kind = 'attach-id' and old_attach_id is not null").select(F.col("id").alias("attach_id"), F.col("old_attach_id").alias("post_id"), F.col("data").isNotNull().alias("here"))
    pairs = numbered.join(own, "post_id")
    one = F.col("here") != F.col("u.there")
    ends = [F.when(one & F.col("here"), a).when(one, b) for a, b in ((F.col("attach_id"), F.col("u.upload_id")), (F.col("u.upload_id"), F.col("attach_id")))]
    return pairs.select("attach_id", "u.upload_id", ends[0].alias("source_id"), ends[1].alias("target_id"))
