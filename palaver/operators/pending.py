"""Resumable work: the key-value state and what it leaves to do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def states(state: DataFrame, prefix: str) -> DataFrame:
    """suffix, value of the keys with a prefix; never LIKE, whose _ is a wildcard."""
    return state.filter(F.startswith("key", F.lit(prefix))).select(F.substr("key", F.lit(len(prefix) + 1)).alias("suffix"), "value")


def topics(listed: DataFrame, state: DataFrame, prefix: str = "topic-posts:") -> DataFrame:
    """id and start offset of topics that are not done."""
    known = states(state, prefix).select(F.col("suffix").try_cast("bigint").alias("id"), "value")
    joined = listed.select("id").join(known, "id", "left").filter(~F.col("value").eqNullSafe(F.lit("done")))
    return joined.select("id", F.coalesce(F.col("value").try_cast("bigint"), F.lit(0)).alias("start"))


def users(sources: list[DataFrame], done: DataFrame, column: str = "user_id") -> DataFrame:
    """Ids over 0 that appear in any source and are not done."""
    ids = reduce(lambda a, b: a.union(b), [s.select(F.col(column).alias("id")) for s in sources])
    return ids.filter("id > 0").distinct().join(done.select("id"), "id", "left_anti")


def polls(listed: DataFrame, stored: DataFrame, state: DataFrame) -> DataFrame:
    missing = states(state, "poll:").select(F.col("suffix").try_cast("bigint").alias("id"))
    return listed.filter("has_poll").select("id").join(stored.select(F.col("topic_id").alias("id")), "id", "left_anti").join(missing, "id", "left_anti")


def sources(posts: DataFrame, state: DataFrame, forum_topics: DataFrame | None = None) -> DataFrame:
    """Posts whose source is not known and has not failed; of some topics only, if given."""
    gaps = states(state, "source-gap:").select(F.col("suffix").try_cast("bigint").alias("id"))
    open_posts = posts.filter("source is null").select("id", "topic_id")
    if forum_topics is not None:
        open_posts = open_posts.join(forum_topics.select(F.col("id").alias("topic_id")), "topic_id", "left_semi")
    return open_posts.select("id").join(gaps, "id", "left_anti")


def without_data(files: DataFrame, missing: DataFrame) -> DataFrame:
    return files.filter("data is null").select("id").join(missing.select("id"), "id", "left_anti")


def avatars_of(users: DataFrame, avatars: DataFrame) -> DataFrame:
    """Users with the row of their avatar, where its data was kept."""
    kept = avatars.filter("data is not null").withColumnRenamed("id", "avatar_id")
    return users.join(kept, "avatar_id")


def unlinked_attachments(attachments: DataFrame, posts: DataFrame) -> DataFrame:
    """Attachments without data, with the topic of the post that first names them."""
    where = posts.select(F.col("id").alias("first_post_id"), "topic_id")
    return attachments.filter("data is null").join(where, "first_post_id")
