"""Queries of late data: copies of posts merged batch by batch, aggregates of touched keys."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from palaver.operators.shared import materialized
from palaver.plans.registry import Board, query
from palaver.streaming.late import KeyedLog, apply_batch, kept_posts

_FORM = """regexp_replace(regexp_replace({}, '[^\\x00-\\x7F]', '', 'g'), '\\b(href|src|action)=("[^"]*"|''[^'']*'')', '\\1=', 'g')"""


def _folder(b: Board, name: str) -> str:
    base = b.spark.conf.get("spark.checkpoint.dir", None) or b.spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("l12_merged_posts", "copies", f"""
WITH c AS (SELECT DISTINCT * FROM copies WHERE length(html) > 0),
told AS (SELECT post_id, list(struct_pack(stamp := coalesce(edited_at, -1), html := html, filtered := filtered, lossy := lossy, edited := FALSE) ORDER BY captured_at NULLS FIRST, file, html) AS all_,
  arg_max(topic_id, struct_pack(k := captured_at IS NOT NULL, a := captured_at, f := file, h := html)) FILTER (WHERE topic_id IS NOT NULL) AS topic_id,
  arg_max(forum_id, struct_pack(k := captured_at IS NOT NULL, a := captured_at, f := file, h := html)) AS forum_id FROM c GROUP BY post_id),
folded AS (SELECT post_id, topic_id, forum_id, list_reduce(all_, lambda k, n: CASE
  WHEN n.stamp > k.stamp THEN struct_pack(stamp := n.stamp, html := n.html, filtered := n.filtered, lossy := n.lossy, edited := TRUE)
  WHEN n.stamp < k.stamp OR n.html = k.html OR n.filtered THEN k
  WHEN (k.lossy AND NOT n.lossy) OR NOT (n.lossy AND {_FORM.format('k.html')} = {_FORM.format('n.html')}) THEN struct_pack(stamp := n.stamp, html := n.html, filtered := n.filtered, lossy := n.lossy, edited := k.edited)
  ELSE k END) AS r FROM told)
SELECT post_id, r.html AS html, nullif(r.stamp, -1) AS edited_at, topic_id, forum_id, r.edited AS edited FROM folded""")
def _(b: Board):
    """Three batches of copies, the latest first and the middle one twice; the result is the batch's."""
    copies = b.copies.distinct()
    log = KeyedLog(b.spark, _folder(b, "copies"), copies.schema, "post_id", 16)
    results = KeyedLog(b.spark, _folder(b, "kept"), kept_posts(copies).schema, "post_id", 16)
    parts = materialized(copies.withColumn("part", F.pmod(F.xxhash64("file"), F.lit(3))), "copies", "part")
    for number, part in ((1, 2), (2, 0), (2, 0), (3, 1)):
        apply_batch(log, results, parts.filter(F.col("part") == part).drop("part"), number, kept_posts)
    return results.latest()


def topic_roll_up(posts):
    """topic_id, posts, first and last post of topics, from all their posts."""
    at = F.struct("posted_at", "id")
    return posts.groupBy("topic_id").agg(F.count("*").alias("posts"), F.min_by("id", at).alias("first_post"), F.max_by("id", at).alias("last_post"), F.max("posted_at").alias("last_at"))


@query("i7_incremental_topics", "posts", """
SELECT topic_id, count(*) AS posts, arg_min(id, struct_pack(a := posted_at, b := id)) AS first_post, arg_max(id, struct_pack(a := posted_at, b := id)) AS last_post, max(posted_at) AS last_at FROM posts GROUP BY topic_id""")
def _(b: Board):
    """Topics' roll-ups kept up with three batches of posts, none of them in order of time."""
    posts = b.posts.select("id", "topic_id", "posted_at", "flag")
    log = KeyedLog(b.spark, _folder(b, "posts-log"), "id long, topic_id long, posted_at timestamp_ntz" if dict(posts.dtypes)["posted_at"] == "timestamp_ntz" else posts.drop("flag").schema, "topic_id", 16)
    results = KeyedLog(b.spark, _folder(b, "topics"), topic_roll_up(posts).schema, "topic_id", 16)
    for number, flag in enumerate(("R", "N", "A"), 1):
        apply_batch(log, results, posts.filter(F.col("flag") == flag).drop("flag"), number, topic_roll_up)
    results.compact()
    return results.latest()
