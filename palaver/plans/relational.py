"""Queries of the relational core: roll-ups, pending work, joins, sets, trees, windows, writes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from palaver.operators import finalize, history, ids, pending, ranges, sets, trees, upsert
from palaver.plans.registry import Board, query

_TOPICS_SQL = """
ft AS (SELECT t.id, t.forum_id, t.user_id, t.stickied, t.locked, t.has_poll, t.view_count, t.listed_at,
        coalesce(s.n, t.post_count) AS post_count, s.last_id AS last_post_id, s.created AS created_at
       FROM topics t LEFT JOIN (SELECT topic_id, count(*) AS n, arg_max(id, struct_pack(a := posted_at, b := id)) AS last_id,
        arg_min(posted_at, struct_pack(a := post_index, b := id)) AS created FROM posts GROUP BY topic_id) s ON s.topic_id = t.id)"""


def final_topics(b: Board):
    return finalize.finalize_topics(b.topics, b.posts)


@query("a1_finalize_topics", "topics posts", f"WITH {_TOPICS_SQL} SELECT id, forum_id, post_count, last_post_id, created_at FROM ft")
def _(b: Board):
    return final_topics(b).select("id", "forum_id", "post_count", "last_post_id", "created_at")


_FORUMS_SQL = f"""WITH {_TOPICS_SQL}, last AS (SELECT ft.*, p.posted_at AS lt FROM ft LEFT JOIN posts p ON p.id = ft.last_post_id),
ff AS (SELECT f.id, f.name, f.parent_id, coalesce(sum(l.post_count), 0)::BIGINT AS post_count, coalesce(sum(l.view_count), 0)::BIGINT AS view_count,
        first(l.last_post_id ORDER BY l.lt DESC NULLS LAST, l.last_post_id DESC NULLS LAST) AS last_post_id
       FROM forums f LEFT JOIN last l ON l.forum_id = f.id GROUP BY ALL)"""


def final_forums(b: Board):
    return finalize.finalize_forums(b.forums, final_topics(b), b.posts)


@query("a2_finalize_forums", "forums topics posts", f"{_FORUMS_SQL} SELECT id, name, post_count, view_count, last_post_id FROM ff")
def _(b: Board):
    return final_forums(b).select("id", "name", "post_count", "view_count", "last_post_id")


@query("a3_posts_per_user", "posts", "SELECT user_id, count(*) AS n_posts, count(DISTINCT topic_id) AS n_topics FROM posts GROUP BY user_id")
def _(b: Board):
    return b.posts.groupBy("user_id").agg(F.count("*").alias("n_posts"), F.count_distinct("topic_id").alias("n_topics"))


@query("a4_global_counts", "topics", "SELECT count(*) AS n, count(*) FILTER (WHERE user_id = 0) AS guests, count(has_poll) AS flagged, count(*) FILTER (WHERE has_poll) AS polls FROM topics")
def _(b: Board):
    return b.topics.agg(F.count("*").alias("n"), F.count_if(F.col("user_id") == 0).alias("guests"), F.count("has_poll").alias("flagged"), F.count_if("has_poll").alias("polls"))


@query("a5_files_by_kind", "files", "SELECT kind, count(*) AS n, count(*) FILTER (WHERE data IS NULL) AS lost, count(*) FILTER (WHERE data IS NOT NULL) AS kept FROM files GROUP BY kind")
def _(b: Board):
    lost = F.col("data").isNull()
    return b.files.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(lost).alias("lost"), F.count_if(~lost).alias("kept"))


@query("a6_post_histogram", "topics posts", """
WITH n AS (SELECT topic_id, count(*) AS n FROM posts GROUP BY topic_id),
b AS (SELECT * FROM (VALUES (0, '1', 1, 1), (1, '2-10', 2, 10), (2, '11-100', 11, 100), (3, '101-1000', 101, 1000), (4, '>1000', 1001, 1000000000)) t(ord, bucket, lo, hi))
SELECT ord, bucket, count(n.n) AS rows FROM b LEFT JOIN n ON n.n BETWEEN lo AND hi GROUP BY ord, bucket""")
def _(b: Board):
    return finalize.histogram(finalize.value_counts(b.posts, "topic_id"), "n")


@query("a7_members_by_year", "posts", "SELECT coalesce(CAST(year(posted_at) AS STRING), 'unknown') AS year, count(DISTINCT user_id) FILTER (WHERE user_id <> 0) AS members FROM posts GROUP BY 1")
def _(b: Board):
    seen = b.posts.filter("user_id <> 0").select(finalize.year_of(F.col("posted_at")).alias("year"), "user_id").distinct()
    years = b.posts.select(finalize.year_of(F.col("posted_at")).alias("year")).distinct()
    return years.join(seen.groupBy("year").agg(F.count("*").alias("members")), "year", "left").select("year", F.coalesce("members", F.lit(0)).alias("members"))


_BY_YEAR = f"""WITH {_TOPICS_SQL}, f AS (
 SELECT coalesce(CAST(year(created_at) AS STRING), 'unknown') AS y, 't' AS k, NULL::BIGINT AS u FROM ft
 UNION ALL SELECT coalesce(CAST(year(posted_at) AS STRING), 'unknown'), 'p', CASE WHEN user_id <> 0 THEN user_id END FROM posts
 UNION ALL SELECT coalesce(CAST(year(joined_at) AS STRING), 'unknown'), 'j', NULL FROM users WHERE id <> 0)
SELECT y AS year, count(*) FILTER (WHERE k = 't') AS topics, count(*) FILTER (WHERE k = 'p') AS posts, count(DISTINCT u) AS posters, count(*) FILTER (WHERE k = 'j') AS joins FROM f GROUP BY y"""


@query("a8_by_year", "topics posts users", _BY_YEAR)
def _(b: Board):
    return finalize.by_year(final_topics(b), b.posts, b.users)


@query("a9_value_counts", "post_rows", "SELECT flag, n, CAST(row_number() OVER (ORDER BY n DESC, flag) AS INT) AS place FROM (SELECT flag, count(*) AS n FROM post_rows GROUP BY flag)")
def _(b: Board):
    counts = finalize.value_counts(b.post_rows, "flag")
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "flag")))


@query("a10_uses_sum", "files", "SELECT kind, CAST(sum(coalesce(uses, 0)) AS BIGINT) AS uses, count(*) FILTER (WHERE coalesce(uses, 1) > 0) AS used FROM files GROUP BY kind")
def _(b: Board):
    return b.files.groupBy("kind").agg(F.sum(F.coalesce("uses", F.lit(0))).alias("uses"), F.count_if(F.coalesce("uses", F.lit(1)) > 0).alias("used"))


@query("a11_bytes_kept", "files", "SELECT kind, count(data) AS n, CAST(coalesce(sum(strlen(data)), 0) AS BIGINT) AS bytes, round_even(coalesce(sum(strlen(data)), 0) / 1048576, 1) AS mib FROM files GROUP BY kind")
def _(b: Board):
    from palaver.functions.files import mib

    size = F.coalesce(F.sum(F.octet_length("data")), F.lit(0))
    return b.files.groupBy("kind").agg(F.count("data").alias("n"), size.alias("bytes"), mib(size).alias("mib"))


@query("a12_uses_and_first_post", "post_rows", "SELECT part_id, count(*) AS uses, min(id) AS first_post_id FROM post_rows GROUP BY part_id")
def _(b: Board):
    return b.post_rows.groupBy("part_id").agg(F.count("*").alias("uses"), F.min("id").alias("first_post_id"))


@query("a14_uses_by_scope", "post_rows", """
SELECT part_id, count(*) FILTER (WHERE flag = 'R') AS signature_uses, count(*) FILTER (WHERE flag <> 'R') AS post_uses,
 concat_ws(',', CASE WHEN count(*) FILTER (WHERE flag <> 'R') > 0 THEN 'post' END, CASE WHEN count(*) FILTER (WHERE flag = 'R') > 0 THEN 'signature' END) AS used_in
FROM post_rows GROUP BY part_id""")
def _(b: Board):
    signature = F.count_if(F.col("flag") == "R")
    post = F.count_if(F.col("flag") != "R")
    return b.post_rows.groupBy("part_id").agg(signature.alias("signature_uses"), post.alias("post_uses")).withColumn("used_in", F.concat_ws(",", F.when(F.col("post_uses") > 0, "post"), F.when(F.col("signature_uses") > 0, "signature")))


@query("a19_image_counts", "files", """
SELECT scope, coalesce(status, 'pending') AS status, count(*) AS images, CAST(sum(n) AS BIGINT) AS uses FROM (
 SELECT 'signatures' AS scope, status, signature_uses AS n FROM files UNION ALL SELECT 'posts', status, post_uses FROM files) WHERE n > 0 GROUP BY 1, 2""")
def _(b: Board):
    scopes = F.explode(F.array(F.struct(F.lit("signatures").alias("scope"), F.col("signature_uses").alias("n")), F.struct(F.lit("posts").alias("scope"), F.col("post_uses").alias("n"))))
    each = b.files.select(F.coalesce("status", F.lit("pending")).alias("status"), scopes.alias("s")).filter("s.n > 0")
    return each.groupBy("s.scope", "status").agg(F.count("*").alias("images"), F.sum("s.n").alias("uses"))


@query("a20_image_presence", "files", """
SELECT concat_ws(' and ', CASE WHEN signature_uses > 0 THEN 'signatures' END, CASE WHEN post_uses > 0 THEN 'posts' END) AS found_in, count(*) AS images,
 count(*) FILTER (WHERE status = 'kept') AS kept, count(*) FILTER (WHERE status = 'missing') AS lost, count(*) FILTER (WHERE status IS NULL) AS pending FROM files GROUP BY 1""")
def _(b: Board):
    where = F.concat_ws(" and ", F.when(F.col("signature_uses") > 0, "signatures"), F.when(F.col("post_uses") > 0, "posts"))
    s = F.col("status")
    return b.files.groupBy(where.alias("found_in")).agg(F.count("*").alias("images"), F.count_if(s == "kept").alias("kept"), F.count_if(s == "missing").alias("lost"), F.count_if(s.isNull()).alias("pending"))


_POLL = "from_json(options, '[{\"text\":\"VARCHAR\",\"votes\":\"BIGINT\"}]')"


@query("a21_poll_totals", "polls", f"SELECT topic_id, CAST(list_sum(list_transform({_POLL}, lambda x: x.votes)) AS BIGINT) AS vote_count, len({_POLL})::BIGINT AS option_count, max_options FROM polls")
def _(b: Board):
    options = F.from_json("options", "array<struct<text:string,votes:bigint>>")
    polls = b.polls.withColumn("o", options)
    return polls.select("topic_id", F.aggregate("o", F.lit(0).cast("long"), lambda n, o: n + o["votes"]).alias("vote_count"), F.size("o").cast("long").alias("option_count"), "max_options")


@query("a22_most_votes", "", "SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) = 1")
def _(b: Board):
    return history.most_votes(b.events.select("user_id", "event_id", "value"), "user_id", "value", "event_id")


@query("a23_seen_flags", "", "SELECT d.doc_id, l.q AS good, l.t AS toxic FROM documents d LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS q, bool_or(toxic = 1) AS t FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id")
def _(b: Board):
    seen = b.labels.select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    return history.seen_flags(b.documents, seen, "doc_id", ["good", "toxic"])


_CLOSURE = """tree(ancestor, id) AS (SELECT id, id FROM forums UNION ALL SELECT t.ancestor, f.id FROM tree t JOIN forums f ON f.parent_id = t.id)"""


@query("a24_subtree_totals", "forums topics posts", f"""WITH RECURSIVE {_CLOSURE}, {_FORUMS_SQL[5:]}, c AS (SELECT forum_id, count(*) AS topics FROM topics GROUP BY forum_id)
SELECT t.ancestor AS id, CAST(sum(coalesce(c.topics, 0)) AS BIGINT) AS topics, CAST(sum(ff.post_count) AS BIGINT) AS posts FROM tree t JOIN ff ON ff.id = t.id LEFT JOIN c ON c.forum_id = t.id GROUP BY t.ancestor""")
def _(b: Board):
    own = final_forums(b).select("id", F.col("post_count").alias("posts"))
    n = b.topics.groupBy(F.col("forum_id").alias("id")).agg(F.count("*").alias("topics"))
    counts = own.join(n, "id", "left")
    return trees.subtree_totals(b.forums, counts, {"topics": "sum", "posts": "absorb"})


@query("a25_subtree_last_time", "forums topics", f"WITH RECURSIVE {_CLOSURE} SELECT t.ancestor AS id, max(x.listed_at) AS last_time FROM tree t LEFT JOIN topics x ON x.forum_id = t.id GROUP BY t.ancestor")
def _(b: Board):
    times = b.topics.groupBy(F.col("forum_id").alias("id")).agg(F.max("listed_at").alias("last_time"))
    return trees.subtree_totals(b.forums, times, {"last_time": "max"})


@query("a26_first_last_by_user", "posts", "SELECT user_id, arg_min(id, struct_pack(a := posted_at, c := post_index, d := id)) AS first_post_id, arg_max(id, struct_pack(a := posted_at, c := post_index, d := id)) AS last_post_id, count(*) AS n_posts FROM posts GROUP BY user_id")
def _(b: Board):
    return finalize.first_and_last(b.posts, "user_id")


@query("a30_status_counts", "topics posts users polls", "SELECT 'topics' AS tbl, count(*) AS n FROM topics UNION ALL SELECT 'posts', count(*) FROM posts UNION ALL SELECT 'users', count(*) FROM users UNION ALL SELECT 'polls', count(*) FROM polls")
def _(b: Board):
    parts = [getattr(b, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("tbl"), "n") for t in ("topics", "posts", "users", "polls")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Pending work

@query("f3_pending_topics", "topics state", """
SELECT t.id, coalesce(TRY_CAST(s.value AS BIGINT), 0) AS start FROM topics t LEFT JOIN state s ON s.key = 'topic-posts:' || t.id WHERE s.value IS DISTINCT FROM 'done'""")
def _(b: Board):
    return pending.topics(b.topics, b.state)


@query("f4_pending_users", "topics posts users", """
SELECT DISTINCT id FROM (SELECT user_id AS id FROM posts UNION SELECT user_id FROM topics) WHERE id > 0 AND id NOT IN (SELECT id FROM users WHERE group_name <> 'BUILDING')""")
def _(b: Board):
    return pending.users([b.posts, b.topics], b.users.filter("group_name <> 'BUILDING'").select("id"))


@query("f7_pending_polls", "topics polls state", """
SELECT id FROM topics WHERE has_poll AND id NOT IN (SELECT topic_id FROM polls) AND NOT EXISTS (SELECT 1 FROM state WHERE key = 'poll:' || topics.id)""")
def _(b: Board):
    return pending.polls(b.topics, b.polls, b.state)


@query("f8_pending_files", "files", "SELECT id FROM files WHERE data IS NULL AND status IS DISTINCT FROM 'missing'")
def _(b: Board):
    return pending.without_data(b.files, b.files.filter("status = 'missing'").select("id"))


@query("f10_pending_images", "files", "SELECT id FROM files WHERE status IS NULL AND (signature_uses > 0 OR post_uses > 2) ORDER BY id LIMIT 25")
def _(b: Board):
    return b.files.filter("status is null and (signature_uses > 0 or post_uses > 2)").select("id").orderBy("id").limit(25)


@query("d10_states_by_prefix", "state", "SELECT substr(key, 10) AS suffix, value FROM state WHERE starts_with(key, 'post-gap:')")
def _(b: Board):
    return pending.states(b.state, "post-gap:")


# Joins

@query("j1_posts_per_forum", "topics posts", "SELECT t.forum_id, count(*) AS n FROM posts p JOIN topics t ON t.id = p.topic_id GROUP BY t.forum_id")
def _(b: Board):
    topics = b.topics.select(F.col("id").alias("topic_id"), "forum_id")
    per_topic = b.posts.groupBy("topic_id").agg(F.count("*").alias("n"))  # pre-aggregated before the join
    return per_topic.join(topics, "topic_id").groupBy("forum_id").agg(F.sum("n").alias("n"))


@query("j2_group_members", "users", "SELECT g.name, count(u.id) AS members FROM (SELECT DISTINCT group_name AS name FROM users UNION SELECT 'Nobody') g LEFT JOIN users u ON u.group_name = g.name GROUP BY g.name")
def _(b: Board):
    groups = b.users.select(F.col("group_name").alias("name")).union(b.spark.createDataFrame([("Nobody",)], "name string")).distinct()
    counts = b.users.groupBy(F.col("group_name").alias("name")).agg(F.count("id").alias("members"))
    return groups.join(counts, "name", "left").select("name", F.coalesce("members", F.lit(0)).alias("members"))


@query("j3_forum_groups", "users", "SELECT forum_id, array_to_string(list_sort(list_distinct(list(group_name))), ',') AS groups FROM users GROUP BY forum_id")
def _(b: Board):
    return b.users.groupBy("forum_id").agg(F.array_join(F.sort_array(F.collect_set("group_name")), ",").alias("groups"))


@query("j5_topics_only_in_second", "topics second_topics", "SELECT s.id, s.title FROM second_topics s WHERE s.id NOT IN (SELECT id FROM topics)")
def _(b: Board):
    return b.second_topics.join(b.topics.select("id"), "id", "left_anti").select("id", "title")


@query("j7_topics_with_posts", "topics posts", "SELECT id FROM topics WHERE EXISTS (SELECT 1 FROM posts p WHERE p.topic_id = topics.id)")
def _(b: Board):
    return b.topics.select("id").join(b.posts.select(F.col("topic_id").alias("id")), "id", "left_semi")


@query("j9_posts_members_topics", "posts topics users", "SELECT p.id, t.forum_id, u.name FROM posts p JOIN topics t ON t.id = p.topic_id JOIN users u ON u.id = p.user_id WHERE p.flag <> 'A'")
def _(b: Board):
    topics = b.topics.select(F.col("id").alias("topic_id"), "forum_id")
    users = b.users.select(F.col("id").alias("user_id"), "name")
    return b.posts.filter("flag <> 'A'").select("id", "topic_id", "user_id").join(topics, "topic_id").join(users, "user_id").select("id", "forum_id", "name")


@query("j10_name_precedence", "", """
SELECT conv_id, role AS name FROM (SELECT conv_id, role, turn FROM conversations) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY role = 'system', turn) = 1""")
def _(b: Board):
    return b.conversations.groupBy("conv_id").agg(F.min_by("role", F.struct(F.col("role") == "system", "turn")).alias("name"))


_SECOND = "second AS (SELECT row_number() OVER (ORDER BY posted_at, id) AS id, topic_id, posted_at, user_id, id AS true_id FROM posts WHERE flag <> 'A')"


def second_posts(b: Board):
    """The second source's posts: own ids in time order, times to the minute."""
    kept = b.posts.filter("flag <> 'A'").select("topic_id", "posted_at", "user_id", F.col("id").alias("true_id"))
    return upsert.number_rows(kept, ["posted_at", "true_id"], "id")


@query("j16_minute_join", "posts", f"""WITH {_SECOND}, a AS (SELECT topic_id, date_trunc('minute', posted_at) AS m, min(id) AS old_id FROM second GROUP BY 1, 2 HAVING count(*) = 1),
p AS (SELECT topic_id, date_trunc('minute', posted_at) AS m, min(id) AS new_id FROM posts GROUP BY 1, 2 HAVING count(*) = 1)
SELECT CAST(a.old_id AS BIGINT) AS old_id, p.new_id, 'time' AS match FROM a JOIN p USING (topic_id, m)""")
def _(b: Board):
    return ranges.minute_join(second_posts(b), b.posts)


@query("j18_asof_window", "posts", """
WITH known AS (SELECT id, posted_at AS ts FROM posts WHERE status = 'F' AND flag = 'R'), q AS (SELECT id FROM posts),
w AS (SELECT q.id, max(k.id) OVER (ORDER BY q.id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lk, min(k.id) OVER (ORDER BY q.id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hk FROM q LEFT JOIN known k ON k.id = q.id),
x AS (SELECT w.id, a.ts AS lo, z.ts AS hi FROM w LEFT JOIN known a ON a.id = w.lk LEFT JOIN known z ON z.id = w.hk)
SELECT id, CASE WHEN lo <= hi THEN lo END AS low, CASE WHEN lo <= hi THEN hi END AS high FROM x""")
def _(b: Board):
    # One topic's ids lie together: dealing by blocks of ids would cut windows, so all marks run in id order.
    known = b.posts.filter("status = 'F' and flag = 'R'").select("id", F.col("posted_at").alias("ts"))
    return ranges.asof_by_blocks(b.posts.select("id"), known)


@query("j20_time_range_join", "posts topics", """
SELECT t.id AS topic_id, p.id AS post_id FROM topics t JOIN posts p ON p.topic_id = t.id AND p.posted_at BETWEEN t.listed_at - INTERVAL 3 DAY AND t.listed_at + INTERVAL 45 DAY""")
def _(b: Board):
    day = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date"))
    topics = b.topics.select(F.col("id").alias("tid"), "listed_at")
    found = ranges.bucketed_range_join(topics, b.posts.select(F.col("id").alias("post_id"), "topic_id", "posted_at"), day("listed_at") - 3, day("listed_at") + 45, day("posted_at"), 48, [("tid", "topic_id")])
    exact = F.col("posted_at").between(F.col("listed_at") - F.expr("interval 3 days"), F.col("listed_at") + F.expr("interval 45 days"))
    return found.filter(exact).select(F.col("tid").alias("topic_id"), "post_id")


@query("j22_name_join", "users", """
WITH k AS (SELECT id, lower(name) AS n FROM users), q AS (SELECT id, CASE WHEN group_name = 'BUILDING' THEN lower(name) ELSE substr(lower(name), 1, 16) END AS n FROM users)
SELECT q.id AS q_id, k.id, CASE WHEN q.n = k.n THEN 2 ELSE 1 END AS score FROM q JOIN k ON substr(q.n, 1, 12) = substr(k.n, 1, 12) AND (q.n = k.n OR (length(q.n) >= 3 AND length(k.n) >= 3
 AND abs(length(q.n) - length(k.n)) <= greatest(length(q.n), length(k.n)) * 0.3 + 2 AND (starts_with(k.n, q.n) OR starts_with(q.n, k.n))))""")
def _(b: Board):
    from palaver.operators.names import name_pairs

    asked = b.users.select(F.col("id").alias("q_id"), F.when(F.col("group_name") == "BUILDING", F.lower("name")).otherwise(F.substring(F.lower("name"), 1, 16)).alias("key"))
    return name_pairs(asked, b.users.select("id", F.lower("name").alias("key"))).select("q_id", "id", "score")


@query("j23_position_fill", "users", """
WITH o AS (SELECT id, row_number() OVER (ORDER BY id) AS pos FROM users), n AS (SELECT id + 100 AS id, row_number() OVER (ORDER BY id) AS pos FROM users WHERE group_name <> 'FURNITURE'),
a AS (SELECT o.pos AS op, n.pos AS np FROM o JOIN n ON n.id = o.id + 100 JOIN users u ON u.id = o.id WHERE u.group_name = 'BUILDING'),
g AS (SELECT *, lead(op) OVER (ORDER BY op) AS nop, lead(np) OVER (ORDER BY op) AS nnp FROM a)
SELECT o.id AS old_id, n.id AS new_id, 'position' AS match FROM g JOIN o ON o.pos > g.op AND o.pos < g.nop JOIN n ON n.pos - g.np = o.pos - g.op WHERE g.nop - g.op = g.nnp - g.np""")
def _(b: Board):
    old = upsert.number_rows(b.users.select("id"), ["id"], "pos")
    new = upsert.number_rows(b.users.filter("group_name <> 'FURNITURE'").select((F.col("id") + 100).alias("id")), ["id"], "pos")
    anchors = old.join(b.users.filter("group_name = 'BUILDING'").select("id"), "id", "left_semi").select(F.col("pos").alias("old_pos"), (F.col("id") + 100).alias("k")).join(new.select(F.col("id").alias("k"), F.col("pos").alias("new_pos")), "k").select("old_pos", "new_pos")
    return ranges.position_fill(anchors, old, new)


@query("j24_members_by_posts", "posts", """
WITH p AS (SELECT topic_id AS member, part_id AS user_id FROM posts WHERE flag = 'R' AND quantity >= 47), m AS (SELECT member, min(user_id) AS user_id FROM p GROUP BY member HAVING count(DISTINCT user_id) = 1)
SELECT member, user_id FROM m QUALIFY count(*) OVER (PARTITION BY user_id) = 1""")
def _(b: Board):
    from palaver.operators.names import sole_owner

    return sole_owner(b.posts.filter("flag = 'R' and quantity >= 47").select(F.col("topic_id").alias("member"), F.col("part_id").alias("user_id")), "member", "user_id")


@query("j26_window_targets", "posts files", """
SELECT p.id AS post_id, min(f.id) AS file_id FROM posts p JOIN files f ON f.id BETWEEN p.part_id - 1 AND p.part_id + 1 AND f.kind = 'image' GROUP BY p.id HAVING count(*) = 1""")
def _(b: Board):
    asked = b.posts.select(F.col("id").alias("post_id"), "part_id")
    found = ranges.bucketed_range_join(asked, b.files.filter("kind = 'image'").select(F.col("id").alias("file_id")), F.col("part_id") - 1, F.col("part_id") + 1, F.col("file_id"), 64)
    return found.groupBy("post_id").agg(F.count("*").alias("n"), F.min("file_id").alias("file_id")).filter("n = 1").drop("n")


@query("j27_placeholders", "", "SELECT user_id, CAST(count(DISTINCT event_type) AS BIGINT) AS names FROM events GROUP BY user_id HAVING count(DISTINCT event_type) >= 3")
def _(b: Board):
    return history.same_digest_names(b.events, "user_id", "event_type", 3)


# Sets

@query("u1_union", "posts topics", "SELECT user_id FROM posts UNION SELECT user_id FROM topics")
def _(b: Board):
    return sets.union(b.posts, b.topics, "user_id")


@query("u3_difference", "second_topics topics", "SELECT id FROM second_topics EXCEPT SELECT id FROM topics")
def _(b: Board):
    return sets.difference(b.second_topics, b.topics, "id")


@query("u4_intersection", "second_topics topics", "SELECT id FROM second_topics INTERSECT SELECT id FROM topics")
def _(b: Board):
    return sets.intersection(b.second_topics, b.topics, "id")


@query("u5_symmetric_difference", "forums second_forums", """
SELECT coalesce(f.id, s.id) AS id, CASE WHEN f.id IS NOT NULL THEN 'a' ELSE 'b' END AS side FROM forums f FULL JOIN second_forums s ON s.id = f.id WHERE f.id IS NULL OR s.id IS NULL""")
def _(b: Board):
    return sets.symmetric_difference(b.forums, b.second_forums, "id")


def six_sql(label: str, a: str, b: str) -> str:
    return f"""SELECT '{label}' AS label, count(*) AS shown, count(x.k) AS n_a, count(y.k) AS n_b, count(*) FILTER (WHERE y.k IS NULL) AS only_a,
 count(*) FILTER (WHERE x.k IS NULL) AS only_b, count(*) FILTER (WHERE x.k IS NOT NULL AND y.k IS NOT NULL) AS both
 FROM (SELECT DISTINCT {a}) x FULL JOIN (SELECT DISTINCT {b}) y ON x.k = y.k"""


@query("u6_sources_row", "topics second_topics", six_sql("Topics", "id AS k FROM topics", "id AS k FROM second_topics"))
def _(b: Board):
    return sets.six_counts(b.topics, b.second_topics, "id", "Topics")


# Windows, sorts, trees

@query("w1_stable_ids", "post_rows", """
WITH u AS (SELECT part_id, count(*) AS uses FROM post_rows GROUP BY part_id), k AS (SELECT part_id, part_id + 5 AS id FROM u WHERE uses % 3 = 0), t AS (SELECT coalesce(max(id), 0) AS top FROM k)
SELECT u.part_id, u.uses, k.id FROM u JOIN k USING (part_id)
UNION ALL SELECT u.part_id, u.uses, t.top + row_number() OVER (ORDER BY u.uses DESC, u.part_id) FROM u, t WHERE u.uses % 3 <> 0""")
def _(b: Board):
    found = b.post_rows.groupBy("part_id").agg(F.count("*").alias("uses"))
    known = found.filter("uses % 3 = 0").select("part_id", (F.col("part_id") + 5).alias("id"))
    return ids.assign_ids(known, found, "part_id", [F.desc("uses"), "part_id"])


@query("w2_ids_by_first_use", "files", """
SELECT url, first_post_id, row_number() OVER (ORDER BY first_post_id NULLS LAST, url) AS id FROM files""")
def _(b: Board):
    found = b.files.select("url", "first_post_id")
    known = found.limit(0).select("url", F.lit(0).cast("long").alias("id"))
    return ids.assign_ids(known, found, "url", [F.asc_nulls_last("first_post_id"), "url"])


@query("w3_position_in_topic", "posts", "SELECT id, row_number() OVER (PARTITION BY topic_id ORDER BY posted_at, id)::BIGINT AS pos FROM posts")
def _(b: Board):
    return b.posts.select("id", F.row_number().over(Window.partitionBy("topic_id").orderBy("posted_at", "id")).cast("long").alias("pos"))


@query("w5_collapse_runs", "", """
SELECT event_id, user_id, event_type FROM events QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type""")
def _(b: Board):
    return history.collapse_runs(b.events.select("event_id", "user_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query("w6_latest_capture", "", "SELECT user_id, event_type, ts, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def _(b: Board):
    return history.latest(b.events.select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], "ts", ["event_id"])


@query("w10_last_of_topic", "posts", "SELECT topic_id, id FROM posts QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY posted_at DESC, id DESC) <= 500")
def _(b: Board):
    ranked = b.posts.withColumn("r", F.row_number().over(Window.partitionBy("topic_id").orderBy(F.desc("posted_at"), F.desc("id"))))
    return ranked.filter("r <= 500").select("topic_id", "id")


@query("w14_changed_captures", "", "SELECT event_id FROM (SELECT event_id, event_type, first(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS f FROM events) WHERE f <> event_type")
def _(b: Board):
    return history.changed_from_first(b.events.select("event_id", "user_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id")


@query("o3_topic_listing", "topics", "SELECT forum_id, id, CAST(row_number() OVER (PARTITION BY forum_id ORDER BY stickied DESC, listed_at DESC, id DESC) AS INT) AS place FROM topics")
def _(b: Board):
    w = Window.partitionBy("forum_id").orderBy(F.desc("stickied"), F.desc("listed_at"), F.desc("id"))
    return b.topics.select("forum_id", "id", F.row_number().over(w).alias("place"))


@query("o9_first_distinct_captures", "", """
WITH d AS (SELECT user_id, event_type, min(struct_pack(ts := ts, event_id := event_id)) AS m FROM events GROUP BY 1, 2)
SELECT user_id, event_type, m.ts AS ts, m.event_id AS event_id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY m.ts, m.event_id) AS rank FROM d) WHERE rank <= 3""")
def _(b: Board):
    return history.first_distinct(b.events, ["user_id"], ["ts", "event_id"], "event_type")


@query("o10_forum_preorder", "forums", """
WITH RECURSIVE w(id, name, depth, p) AS (SELECT id, name, 0, lpad(CAST(id AS STRING), 12, '0') FROM forums WHERE parent_id IS NULL
 UNION ALL SELECT f.id, f.name, w.depth + 1, w.p || '/' || lpad(CAST(f.id AS STRING), 12, '0') FROM w JOIN forums f ON f.parent_id = w.id)
SELECT id, name, depth, CAST(row_number() OVER (ORDER BY p) AS INT) AS place FROM w""")
def _(b: Board):
    walked = trees.paths(b.forums)
    return walked.select("id", "name", "depth", F.row_number().over(Window.orderBy("sort_path")).alias("place"))


@query("m3_breadcrumbs", "forums", "SELECT f.id, CASE WHEN p.id IS NULL THEN f.name ELSE p.name || ' > ' || f.name END AS crumbs FROM forums f LEFT JOIN forums p ON p.id = f.parent_id")
def _(b: Board):
    return trees.crumbs(b.forums)


# Writes

@query("d1_upsert", "topics", """
WITH n AS (SELECT id + 5 AS id, view_count + 1 AS view_count FROM topics WHERE stickied)
SELECT coalesce(t.id, n.id) AS id, t.forum_id, CASE WHEN n.id IS NOT NULL THEN n.view_count ELSE t.view_count END AS view_count FROM topics t FULL JOIN n ON n.id = t.id""")
def _(b: Board):
    new = b.topics.filter("stickied").select((F.col("id") + 5).alias("id"), (F.col("view_count") + 1).alias("view_count"))
    return upsert.upsert(b.topics.select("id", "forum_id", "view_count"), new, ["id"])


@query("d2_update", "topics", """
WITH n AS (SELECT id + 5 AS id, view_count + 1 AS view_count FROM topics WHERE stickied)
SELECT t.id, t.forum_id, CASE WHEN n.id IS NOT NULL THEN n.view_count ELSE t.view_count END AS view_count FROM topics t LEFT JOIN n ON n.id = t.id""")
def _(b: Board):
    new = b.topics.filter("stickied").select((F.col("id") + 5).alias("id"), (F.col("view_count") + 1).alias("view_count"))
    return upsert.update(b.topics.select("id", "forum_id", "view_count"), new, ["id"])


@query("d3_insert_numbered", "users", """
SELECT id, name FROM users UNION ALL SELECT (SELECT max(id) FROM users) + row_number() OVER (ORDER BY name), name FROM (SELECT name || '!' AS name FROM users WHERE group_name = 'BUILDING')""")
def _(b: Board):
    new = b.users.filter("group_name = 'BUILDING'").select(F.concat("name", F.lit("!")).alias("name"))
    return upsert.insert_numbered(b.users.select("id", "name"), new, "id", ["name"])


@query("d4_replace_groups", "posts", "WITH n AS (SELECT id + 1000000000 AS id, topic_id FROM posts WHERE post_index = 1 AND flag = 'R') SELECT id, topic_id FROM posts WHERE topic_id NOT IN (SELECT topic_id FROM n) UNION ALL SELECT id, topic_id FROM n")
def _(b: Board):
    posts = b.posts.select("id", "topic_id", "post_index", "flag")
    new = posts.filter("post_index = 1 and flag = 'R'").select((F.col("id") + 1_000_000_000).alias("id"), "topic_id")
    return upsert.replace_groups(posts.select("id", "topic_id"), new, ["topic_id"])
