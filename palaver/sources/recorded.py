"""Recorded answers of a board's interface: topics, threads and members from JSON files.

There is no network here: a crawl's answers lie in a folder, one JSON object a
line, and become the tables that a live connector would fill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_TOPIC = "topic_id bigint, real_topic_id bigint, forum_id bigint, topic_author_id bigint, topic_author_name string, topic_title string, reply_number bigint, total_post_num bigint, view_number bigint, is_closed boolean, is_moved boolean"
_POST = "post_id bigint, post_author_id bigint, post_author_name string, post_content string, position bigint, timestamp string"


def read_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Listed topics: moved ones go, of repeated ones the first listing stays."""
    raw = spark.read.schema(f"forum_id bigint, mode int, page int, topics array<struct<{_TOPIC.replace(' bigint', ':bigint').replace(' string', ':string').replace(' boolean', ':boolean')}>>").json(folder)
    each = raw.select("mode", "page", F.col("forum_id").alias("asked"), F.posexplode("topics").alias("pos", "t")).filter("not coalesce(t.is_moved, false) and t.forum_id = asked")
    rows = each.select(
        F.coalesce(F.nullif("t.real_topic_id", F.lit(0)), "t.topic_id").alias("id"), "t.forum_id", F.col("t.topic_author_id").alias("user_id"), F.col("t.topic_title").alias("name"),
        (F.col("mode") == 1).alias("stickied"), F.coalesce("t.is_closed", F.lit(False)).alias("locked"),
        F.coalesce(F.nullif("t.total_post_num", F.lit(0)), F.col("t.reply_number") + 1).alias("post_count"), F.col("t.view_number").alias("view_count"), "mode", "page", "pos",
    )
    first = F.row_number().over(Window.partitionBy("id").orderBy("mode", "page", "pos"))
    return rows.withColumn("__n", first).filter("__n = 1").drop("__n", "mode", "page", "pos")


def read_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts of pages that start at ``start``; a missing position counts on from there."""
    from palaver.functions.dates import from_unix

    kind = _POST.replace(" bigint", ":bigint").replace(" string", ":string")
    raw = spark.read.schema(f"topic_id bigint, start bigint, posts array<struct<{kind}>>").json(folder)
    each = raw.select("topic_id", "start", F.posexplode("posts").alias("pos", "p"))
    return each.select(F.col("p.post_id").alias("id"), "topic_id", F.col("p.post_author_id").alias("user_id"), F.coalesce(F.nullif("p.position", F.lit(0)), F.col("start") + F.col("pos") + 1).alias("post_index"), from_unix(F.col("p.timestamp")).alias("posted_at"), F.col("p.post_content").alias("content"))


def seed_users(listings: DataFrame) -> DataFrame:
    """id, name of all authors seen; the last name wins, ids of 0 are guests."""
    return listings.filter("user_id > 0").groupBy(F.col("user_id").alias("id")).agg(F.max_by("user_name", "seen").alias("name"))


def read_members(spark: SparkSession, folder: str) -> DataFrame:
    """Members of paged lists, which come as maps from a number to a member; each id once."""
    member = "struct<user_id:bigint,username:string,post_count:bigint,reg_time:string>"
    raw = spark.read.schema(f"page int, members map<string,{member}>").json(folder)
    each = raw.select("page", F.explode(F.map_values("members")).alias("m"))
    return each.filter("m.user_id > 0").groupBy(F.col("m.user_id").alias("id")).agg(F.max_by("m.username", "page").alias("name"), F.max("m.post_count").alias("post_count"))


def split_quotes(answers: DataFrame) -> DataFrame:
    """post_id, source of answers that quote several posts in one text.

    ``answers``: ids (array), text.  Parts end where one quote closes and the next
    opens; an answer whose parts and ids differ in number is ambiguous and gives
    no rows.
    """
    parts = F.split("text", r"(?<=\[/quote\])\s*\n\n(?=\[quote)")
    paired = answers.withColumn("__p", parts).filter(F.size("__p") == F.size("ids"))
    each = paired.select(F.explode(F.arrays_zip(F.col("ids").alias("post_id"), F.col("__p").alias("part"))).alias("z"))
    inner = F.regexp_replace(F.regexp_replace("z.part", r"^\s*\[quote[^\]]*\]", ""), r"\[/quote\]\s*$", "")
    return each.select("z.post_id", inner.alias("source"))


def topic_totals(answers: DataFrame) -> DataFrame:
    """forum_id, total: topics of a forum over its listing modes, one answer's ``total_topic_num`` each."""
    return answers.groupBy("forum_id").agg(F.sum(F.coalesce("total_topic_num", F.lit(0))).cast("long").alias("total"))
