"""Counts and last posts of topics and forums; activity by year; histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Upper bounds and names of the size classes; the last is open.
BUCKETS = ((1, "1"), (10, "2-10"), (100, "11-100"), (1000, "101-1000"), (None, ">1000"))


def finalize_topics(topics: DataFrame, posts: DataFrame) -> DataFrame:
    """post_count, last_post_id and created_at from the stored posts.

    A topic without stored posts keeps its listed count.  One aggregation gives
    all three: the last by (time, id), the first by (index, id).
    """
    when = F.col("posted_at")
    stored = posts.groupBy("topic_id").agg(
        F.count("*").alias("__n"),
        F.max_by("id", F.struct(when.isNotNull(), when, "id")).alias("__last"),
        F.min_by("posted_at", F.struct("post_index", "id")).alias("__created"),
    )
    joined = topics.join(stored, topics["id"] == stored["topic_id"], "left")
    rest = [topics[c] for c in topics.columns if c not in ("post_count", "last_post_id", "created_at")]
    return joined.select(*rest, F.coalesce("__n", topics["post_count"]).alias("post_count"), F.col("__last").alias("last_post_id"), F.col("__created").alias("created_at"))


def finalize_forums(forums: DataFrame, topics: DataFrame, posts: DataFrame) -> DataFrame:
    """Sums over a forum's own topics, and its last post by (time, id); 0, 0, null without topics."""
    last = posts.select(F.col("id").alias("last_post_id"), F.col("posted_at").alias("__t"))
    per_topic = topics.join(last, "last_post_id", "left")
    sums = per_topic.groupBy("forum_id").agg(
        F.sum("post_count").alias("post_count"),
        F.sum("view_count").alias("view_count"),
        F.max_by("last_post_id", F.when(F.col("__t").isNotNull(), F.struct("__t", "last_post_id"))).alias("last_post_id"),
    )
    joined = forums.join(sums, forums["id"] == sums["forum_id"], "left")
    return joined.select(*forums.columns, F.coalesce("post_count", F.lit(0)).alias("post_count"), F.coalesce("view_count", F.lit(0)).alias("view_count"), "last_post_id")


def bucket(n: Column) -> Column:
    """The size class of a count of one or more."""
    out = None
    for top, name in BUCKETS[:-1]:
        out = F.when(n <= top, name) if out is None else out.when(n <= top, name)
    return out.otherwise(BUCKETS[-1][1])


def histogram(counts: DataFrame, n: str) -> DataFrame:
    """ord, bucket and rows of each size class; empty classes stay."""
    spark = counts.sparkSession
    names = spark.createDataFrame([(i, name) for i, (_, name) in enumerate(BUCKETS)], "ord int, bucket string")
    found = counts.filter(F.col(n) > 0).groupBy(bucket(F.col(n)).alias("bucket")).agg(F.count("*").alias("rows"))
    return names.join(found, "bucket", "left").select("ord", "bucket", F.coalesce("rows", F.lit(0)).alias("rows"))


def year_of(t: Column) -> Column:
    return F.coalesce(F.year(t).cast("string"), F.lit("unknown"))


def by_year(topics: DataFrame, posts: DataFrame, users: DataFrame) -> DataFrame:
    """Topics, posts, distinct posting members and joins by year; facts are stacked, then summed."""
    def facts(df: DataFrame, time: str, kind: str, user: Column | None = None) -> DataFrame:
        return df.select(year_of(F.col(time)).alias("year"), F.lit(kind).alias("kind"), (user if user is not None else F.lit(None)).cast("long").alias("user"))

    stacked = facts(topics, "created_at", "topic").unionByName(facts(posts, "posted_at", "post", F.when(F.col("user_id") != 0, F.col("user_id")))).unionByName(facts(users.filter("id <> 0"), "joined_at", "join"))
    kind = F.col("kind")
    # Distinct members first, so that no set of users meets in one task.
    slim = stacked.groupBy("year", "kind", "user").agg(F.count("*").alias("n"))
    return slim.groupBy("year").agg(
        F.coalesce(F.sum(F.when(kind == "topic", F.col("n"))), F.lit(0)).alias("topics"),
        F.coalesce(F.sum(F.when(kind == "post", F.col("n"))), F.lit(0)).alias("posts"),
        F.count_if((kind == "post") & F.col("user").isNotNull()).alias("posters"),
        F.coalesce(F.sum(F.when(kind == "join", F.col("n"))), F.lit(0)).alias("joins"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def first_and_last(posts: DataFrame, key: str) -> DataFrame:
    """First and last post of each key; undated posts come last, then index, then id."""
    order = F.struct(F.col("posted_at").isNull().alias("a"), F.col("posted_at").alias("b"), F.coalesce("post_index", F.lit(0)).alias("c"), F.col("id").alias("d"))
    return posts.groupBy(key).agg(F.min_by("id", order).alias("first_post_id"), F.max_by("id", order).alias("last_post_id"), F.count("*").alias("n_posts"))
