"""What a static site of the board shows: listings, authors, flags, overlays of a second source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def author_of(user_id: Column, name: Column, guest_name: Column | None = None) -> Column:
    guest = F.coalesce(guest_name, F.lit("guest")) if guest_name is not None else F.lit("guest")
    return F.when(name.isNotNull() & (user_id != 0), name).when(user_id == 0, guest).otherwise(F.concat(F.lit("user "), user_id.cast("string")))


def authors(posts: DataFrame, users: DataFrame) -> DataFrame:
    names = users.filter("id <> 0").select(F.col("id").alias("user_id"), F.col("name").alias("__name"))
    return posts.join(names, "user_id", "left").withColumn("author", author_of(F.col("user_id"), F.col("__name"))).drop("__name")


def topic_flags(stickied: Column, locked: Column, poll: Column, alert: Column | None = None, question: Column | None = None) -> Column:
    marks = [(stickied, "S"), (locked, "L"), (poll, "P"), *((c, m) for c, m in ((alert, "A"), (question, "Q")) if c is not None)]
    return F.concat(*(F.when(c, m).otherwise("") for c, m in marks))


def topic_table(topics: DataFrame, posts: DataFrame, users: DataFrame) -> DataFrame:
    """id, forum_id, starter, flags, post_count, last_user of finalized topics."""
    names = users.filter("id <> 0").select(F.col("id").alias("user_id"), "name")
    last = posts.select(F.col("id").alias("last_post_id"), F.col("user_id").alias("last_user"))
    joined = topics.join(names, "user_id", "left").join(last, "last_post_id", "left")
    flags = topic_flags(F.col("stickied"), F.col("locked"), F.col("has_poll"))
    return joined.select("id", "forum_id", author_of(F.col("user_id"), F.col("name")).alias("starter"), flags.alias("flags"), "post_count", "last_user")


def forum_table(forums: DataFrame, posts: DataFrame) -> DataFrame:
    """Forums beside each other by their last post, newest first."""
    last = posts.select(F.col("id").alias("last_post_id"), F.col("posted_at").alias("last_time"))
    place = F.row_number().over(Window.partitionBy("parent_id").orderBy(F.desc_nulls_last("last_time"), "id"))
    return forums.join(last, "last_post_id", "left").withColumn("place", place).select("id", "name", "post_count", "last_time", "place")


def overlay(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """All of the first source, and what only the second has."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))


def lost_topics(posts: DataFrame) -> DataFrame:
    """Topics known by their posts alone."""
    order = F.struct("posted_at", "id")
    return posts.groupBy("topic_id").agg(F.min_by("id", order).alias("first_post"), F.max_by("id", order).alias("last_post"), F.count("*").alias("n"), F.min("posted_at").alias("started"))


def user_key(user_id: Column, old_id: Column) -> Column:
    """A user's id, a lost member's negative old id, or 0 for guests."""
    return F.coalesce(user_id, -old_id, F.lit(0))


def topic_posts(topics: DataFrame, posts: DataFrame) -> DataFrame:
    """Each topic with its posts in order; topics without posts have none.

    A topic's posts are a page or some hundred pages of the site.
    """
    row = F.struct(F.col("posted_at").isNull().alias("undated"), "posted_at", "post_index", "id", "user_id")
    grouped = posts.groupBy(F.col("topic_id").alias("id")).agg(F.sort_array(F.collect_list(row)).alias("posts"))
    return topics.join(grouped, "id", "left").withColumn("posts", F.coalesce("posts", F.array().cast(grouped.schema["posts"].dataType)))
