"""Queries of recovery: avatars and attachments from archived copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver.operators import recovery
from palaver.plans.registry import Board, query

_KEY = "lower(split_part(replace(regexp_replace({}, '^.*?://', ''), ':80/', '/'), '?', 1))"


@query("l11_best_avatars", "posts", f"""
WITH c AS (SELECT user_id AS member_id, 'http://h.example:80/uploads/AV-' || part_id % 7 || '.gif?' || id AS original, posted_at AS seen, 'arch-' || id AS archived FROM posts WHERE flag <> 'R'),
m AS (SELECT user_id AS member_id, max('https://h.example/uploads/av-' || user_id % 7 || '.gif') AS avatar_url FROM posts WHERE user_id % 4 <> 0 GROUP BY user_id)
SELECT member_id, original, archived FROM (SELECT c.*, coalesce({_KEY.format('original')} = {_KEY.format('avatar_url')}, FALSE) AS same FROM c LEFT JOIN m USING (member_id))
QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY same DESC, seen DESC, original DESC, archived DESC) = 1""")
def _(b: Board):
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    original = F.concat(F.lit("http://h.example:80/uploads/AV-"), text(F.col("part_id") % 7), F.lit(".gif?"), text("id"))
    captures = b.posts.select(F.col("user_id").alias("member_id"), original.alias("original"), F.col("posted_at").alias("at"), F.concat(F.lit("arch-"), text("id")).alias("archived"), (F.col("flag") != "R").alias("image"))
    shown = b.posts.filter("user_id % 4 <> 0").select(F.col("user_id").alias("member_id"), F.concat(F.lit("https://h.example/uploads/av-"), text(F.col("user_id") % 7), F.lit(".gif")).alias("avatar_url"))
    return recovery.best_avatars(shown, captures)


@query("l11_recovered_files", "topics posts files", """
WITH missing AS (SELECT f.id AS upload_id, t.listed_at AS posted_at, 'f.' || CASE f.id % 3 WHEN 0 THEN 'gif' ELSE 'jpg' END AS name FROM files f JOIN topics t ON t.id = f.id WHERE f.data IS NULL),
n0 AS (SELECT p_.id AS attach_id, p_.id % 6 = 1 AS own, p_.listed_at - INTERVAL 12 DAY AS low, p_.listed_at + INTERVAL 9 DAY AS high FROM topics p_),
g AS (SELECT attach_id, min(upload_id) AS upload_id FROM n0 JOIN missing ON posted_at BETWEEN low AND high WHERE NOT own GROUP BY attach_id HAVING count(*) = 1),
n AS (SELECT attach_id, CASE WHEN own THEN attach_id ELSE g.upload_id END AS upload_id, NOT own AND g.upload_id IS NOT NULL AS guessed FROM n0 LEFT JOIN g USING (attach_id)),
nn AS (SELECT n.*, 'f.' || CASE n.upload_id % 3 WHEN 0 THEN 'gif' ELSE 'jpg' END AS upload_name FROM n),
c AS (SELECT topic_id AS attach_id, posted_at AS seen, 'arch-' || id AS archived, CASE WHEN id % 2 = 0 THEN 'x.JPG' ELSE 'y.gif' END AS file_name, flag <> 'N' AS valid FROM posts
  QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY posted_at, 'arch-' || id) <= 3),
f AS (SELECT attach_id, arg_min(archived, struct_pack(a := seen, b := archived)) FILTER (WHERE valid) AS archived, arg_min(file_name, struct_pack(a := seen, b := archived)) FILTER (WHERE valid) AS file_name FROM c GROUP BY attach_id),
r AS (SELECT id, CASE WHEN id % 5 < 2 THEN id * 4 END AS old_attach_id FROM files WHERE data IS NULL),
k AS (SELECT f.*, coalesce(nn.guessed, FALSE) AS guessed, nn.upload_id, nn.upload_id IN (SELECT id FROM r) AS tried,
  NOT coalesce(nn.guessed, FALSE) OR coalesce(lower(regexp_extract(f.file_name, '(\\.[^.]+)$', 1)) = regexp_extract(nn.upload_name, '(\\.[^.]+)$', 1), FALSE) AS confirmed FROM f LEFT JOIN nn USING (attach_id)),
t AS (SELECT attach_id, r.id AS target FROM k JOIN r ON r.old_attach_id = attach_id UNION SELECT attach_id, upload_id FROM k WHERE coalesce(tried, FALSE) AND confirmed)
SELECT DISTINCT k.attach_id, CASE WHEN archived IS NOT NULL THEN target END AS target, CASE WHEN target IS NOT NULL THEN archived END AS archived,
  CASE WHEN target IS NULL AND NOT coalesce(tried, FALSE) THEN 'nothing missing' WHEN archived IS NULL THEN 'archived copies aren''t the file' WHEN target IS NULL THEN 'guess not confirmed'
    WHEN guessed AND confirmed AND coalesce(tried, FALSE) THEN 'recovered by time' ELSE 'recovered' END AS outcome FROM k LEFT JOIN t USING (attach_id)""")
def _(b: Board):
    """Topics stand for numbered attachments, their posts for captures."""
    kind = lambda c: F.concat(F.lit("f."), F.when(F.col(c) % 3 == 0, "gif").otherwise("jpg"))
    lacking = b.files.filter("data is null")
    missing = lacking.select(F.col("id").alias("upload_id")).join(b.topics.select(F.col("id").alias("upload_id"), F.col("listed_at").alias("posted_at")), "upload_id")
    asked = b.topics.select(F.col("id").alias("attach_id"), (F.col("id") % 6 == 1).alias("own"), (F.col("listed_at") - F.expr("interval 12 days")).alias("low"), (F.col("listed_at") + F.expr("interval 9 days")).alias("high"))
    guesses = recovery.guessed_uploads(asked.filter("not own"), missing)
    numbers = asked.join(guesses, "attach_id", "left").select("attach_id", F.when(F.col("own"), F.col("attach_id")).otherwise(F.col("upload_id")).alias("upload_id"), (~F.col("own") & F.col("upload_id").isNotNull()).alias("guessed")).withColumn("upload_name", kind("upload_id"))
    captures = b.posts.select(F.col("topic_id").alias("attach_id"), F.col("posted_at").alias("at"), F.concat(F.lit("arch-"), F.col("id").cast("string")).alias("archived"), F.when(F.col("id") % 2 == 0, "x.JPG").otherwise("y.gif").alias("file_name"), (F.col("flag") != "N").alias("valid"))
    rows = lacking.select("id", F.when(F.col("id") % 5 < 2, F.col("id") * 4).alias("old_attach_id"))
    return recovery.recovered_files(numbers, captures, rows)


@query("s13_claimed_snapshots", "", """
WITH s AS (SELECT strftime(o_orderdate, '%Y%m%d') || '000000' AS timestamp, 'index__q' || o_custkey || '.php' AS file_id, 'http://h/?c=' || o_custkey AS url FROM orders),
l AS (SELECT DISTINCT timestamp, CASE WHEN o % 5 = 0 THEN 'odd-' || file_id ELSE file_id END AS file_id FROM (SELECT strftime(o_orderdate, '%Y%m%d') || '000000' AS timestamp, 'index__q' || o_custkey || '.php' AS file_id, o_orderkey AS o FROM orders) WHERE o % 7 <> 3),
k AS (SELECT timestamp, file_id, min(url) AS url FROM s GROUP BY ALL),
f AS (SELECT k.* FROM k LEFT JOIN l USING (timestamp, file_id) WHERE l.file_id IS NULL), u AS (SELECT l.* FROM l LEFT JOIN k USING (timestamp, file_id) WHERE k.url IS NULL)
SELECT l.timestamp, l.file_id, coalesce(k.url, CASE WHEN (SELECT count(*) FROM u WHERE u.timestamp = l.timestamp) = 1 AND (SELECT count(*) FROM f WHERE f.timestamp = l.timestamp) = 1 THEN (SELECT min(url) FROM f WHERE f.timestamp = l.timestamp) END) AS url
FROM l LEFT JOIN k USING (timestamp, file_id)""")
def _(b: Board):
    from palaver.sources.dumps import claimed_snapshots

    name = F.concat(F.lit("index__q"), F.col("o_custkey").cast("string"), F.lit(".php"))
    rows = b.orders.select(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("000000")).alias("timestamp"), name.alias("file_id"), F.concat(F.lit("http://h/?c="), F.col("o_custkey").cast("string")).alias("url"), "o_orderkey")
    listed = rows.filter("o_orderkey % 7 <> 3").withColumn("file_id", F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("odd-"), F.col("file_id"))).otherwise(F.col("file_id")))
    return claimed_snapshots(listed, rows.drop("o_orderkey"))
