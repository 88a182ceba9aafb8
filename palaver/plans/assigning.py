"""Queries of choices in order: references into gaps, archive rows without ids, attachments."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver.functions.attachments import canonical
from palaver.operators import assignment
from palaver.plans.registry import Board, query


@query("l6_untaken_references", "posts", """
WITH RECURSIVE r AS (SELECT id AS old_id, topic_id, posted_at - INTERVAL 20 DAY AS low, posted_at + INTERVAL 15 DAY AS high FROM posts WHERE flag = 'A'),
c AS (SELECT r.old_id, r.topic_id, list(p.id) AS cands, row_number() OVER (PARTITION BY r.topic_id ORDER BY r.old_id) AS k FROM r JOIN posts p ON p.topic_id = r.topic_id AND p.posted_at BETWEEN low AND high AND p.part_id % 4 <> 0 GROUP BY r.old_id, r.topic_id),
w AS (SELECT DISTINCT topic_id, 0::BIGINT AS k, []::BIGINT[] AS taken, NULL::BIGINT AS old_id, NULL::BIGINT AS post_id FROM c UNION ALL
  SELECT topic_id, k, CASE WHEN len(f) = 1 THEN list_append(taken, f[1]) ELSE taken END, old_id, CASE WHEN len(f) = 1 THEN f[1] END
  FROM (SELECT c.topic_id, c.k, w.taken, c.old_id, list_filter(c.cands, lambda x: NOT list_contains(w.taken, x)) AS f FROM w JOIN c ON c.topic_id = w.topic_id AND c.k = w.k + 1))
SELECT old_id, post_id FROM w WHERE post_id IS NOT NULL""")
def _(b: Board):
    near = b.posts.filter("flag = 'A'").select(F.col("id").alias("old_id"), "topic_id", (F.col("posted_at") - F.expr("interval 20 days")).alias("low"), (F.col("posted_at") + F.expr("interval 15 days")).alias("high"))
    taken = b.posts.filter("part_id % 4 = 0").select(F.col("id").alias("post_id"))
    return assignment.interpolate_references(near, b.posts.select("id", "topic_id", "posted_at"), taken)


@query("l7_archive_rows", "posts", """
WITH RECURSIVE a AS (SELECT topic_id, post_index AS position, user_id % 3 AS author, date_trunc('month', posted_at) AS day FROM posts WHERE flag <> 'A'),
p AS (SELECT id, topic_id, date_trunc('month', posted_at) AS day, post_index AS place, CASE WHEN user_id % 5 <> 0 THEN user_id % 3 END AS name FROM posts),
c AS (SELECT a.topic_id, a.position, a.day, row_number() OVER (PARTITION BY a.topic_id, a.day ORDER BY a.position) AS k,
  list(struct_pack(id := p.id, named := coalesce(p.name = a.author, FALSE), placed := p.name IS NULL AND p.place = a.position + 1, far := abs(p.place - a.position - 1))) AS cands
  FROM a JOIN p ON p.topic_id = a.topic_id AND p.day = a.day GROUP BY a.topic_id, a.position, a.day),
w AS (SELECT DISTINCT topic_id, day, 0::BIGINT AS k, []::BIGINT[] AS taken, NULL::BIGINT AS position, NULL::BIGINT AS post_id FROM c UNION ALL
  SELECT topic_id, day, k, CASE WHEN pick IS NOT NULL THEN list_append(taken, pick) ELSE taken END, position, pick FROM (
    SELECT *, CASE WHEN len(n) = 1 THEN n[1].id WHEN len(m) = 1 THEN m[1].id END AS pick FROM (
      SELECT *, list_filter(f, lambda x: x.named AND x.far = list_min(list_transform(list_filter(f, lambda y: y.named), lambda z: z.far))) AS n, list_filter(f, lambda x: x.placed) AS m FROM (
        SELECT c.topic_id, c.day, c.k, c.position, w.taken, list_filter(c.cands, lambda x: NOT list_contains(w.taken, x.id)) AS f FROM w JOIN c ON c.topic_id = w.topic_id AND c.day = w.day AND c.k = w.k + 1))))
SELECT topic_id, position, post_id FROM w WHERE post_id IS NOT NULL""")
def _(b: Board):
    month = F.date_trunc("month", "posted_at")
    archive = b.posts.filter("flag <> 'A'").select("topic_id", F.col("post_index").alias("position"), (F.col("user_id") % 3).alias("author"), month.alias("day"))
    names = F.when(F.col("user_id") % 5 != 0, F.array(F.col("user_id") % 3)).otherwise(F.array().cast("array<bigint>"))
    return assignment.link_archive_rows(archive, b.posts.select("id", "topic_id", month.alias("day"), F.col("post_index").alias("place"), names.alias("names")))


_FILES = """files_ AS (SELECT id, url, CASE WHEN url LIKE '%act=Attach%' THEN id % 50 END AS old_attach_id, CASE WHEN url LIKE '%act=Attach%' THEN 'attach-id' ELSE 'upload' END AS kind, CASE WHEN id % 5 < 3 THEN 'x' END AS data FROM attachments),
blocks AS (SELECT p_partkey % 50 AS post_id, concat('http://2.forumer.com/uploads/metanet/post-', (p_partkey % 30)::VARCHAR, '-', (1100000000 + p_partkey)::VARCHAR, '.jpg') AS url FROM part WHERE p_size % 2 = 0)"""


def _files(b: Board):
    act = F.col("url").contains("act=Attach")
    files = b.attachments.select("id", "url", F.when(act, F.col("id") % 50).alias("old_attach_id"), F.when(act, "attach-id").otherwise("upload").alias("kind"), F.when(F.col("id") % 5 < 3, "x").alias("data"))
    number = F.col("p_partkey")
    ref = F.concat(F.lit("/attach/ma/post-"), (number % 30).cast("string"), F.lit("-"), (1_100_000_000 + number).cast("string"), F.lit(".jpg"))
    # Parts are small rows of few splits, reading an address is not: it is dealt over all cores first.
    blocks = b.part.filter("p_size % 2 = 0").select((number % 50).alias("post_id"), ref.alias("ref")).repartition("ref")
    return files, blocks.select("post_id", canonical(F.col("ref"))["url"].alias("url"))


@query("l8_tied_attachments", "attachments", f"""
WITH {_FILES}, r AS (SELECT p_partkey % 70 AS post_id, CASE WHEN p_size % 3 = 0 THEN concat('http://2.forumer.com/uploads/metanet/post-', ((p_partkey + 1) % 30)::VARCHAR, '-', (1100000001 + p_partkey)::VARCHAR, '.jpg') ELSE (p_partkey % 50)::VARCHAR END AS ref,
  CASE WHEN p_size % 3 = 0 THEN 'image' ELSE 'file' END AS kind FROM part)
SELECT r.post_id, r.ref, CASE WHEN r.kind = 'image' THEN (SELECT min(id) FROM files_ f WHERE f.url = r.ref)
  ELSE coalesce((SELECT min(f.id) FROM blocks b JOIN files_ f ON f.url = b.url WHERE b.post_id = r.post_id), (SELECT min(id) FROM files_ f WHERE f.old_attach_id = try_cast(r.ref AS BIGINT))) END AS attachment_id FROM r""")
def _(b: Board):
    files, blocks = _files(b)
    number, image = F.col("p_partkey"), F.col("p_size") % 3 == 0
    ref = F.when(image, F.concat(F.lit("2.forumer.com/uploads/metanet/post-"), ((number + 1) % 30).cast("string"), F.lit("-"), (1_100_000_001 + number).cast("string"), F.lit(".jpg"))).otherwise((number % 50).cast("string"))
    rows = b.part.select((number % 70).alias("post_id"), ref.alias("ref"), F.when(image, "image").otherwise("file").alias("kind"))
    tied = assignment.tie_attachments(rows, files, blocks)
    return tied.select("post_id", F.when(F.col("ref").startswith("2."), F.concat(F.lit("http://"), F.col("ref"))).otherwise(F.col("ref")).alias("ref"), "attachment_id")


@query("j25_paired_attachments", "attachments", f"""
WITH {_FILES}, own AS (SELECT b.post_id, arg_min(struct_pack(id := f.id, there := f.data IS NOT NULL), f.id) AS u FROM blocks b JOIN files_ f ON f.url = b.url GROUP BY b.post_id)
SELECT f.id AS attach_id, u.id AS upload_id, CASE WHEN (f.data IS NOT NULL) <> u.there THEN CASE WHEN u.there THEN u.id ELSE f.id END END AS source_id,
  CASE WHEN (f.data IS NOT NULL) <> u.there THEN CASE WHEN u.there THEN f.id ELSE u.id END END AS target_id FROM files_ f JOIN own ON own.post_id = f.old_attach_id WHERE f.kind = 'attach-id'""")
def _(b: Board):
    return assignment.pair_attachments(*_files(b))
