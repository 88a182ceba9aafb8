"""The two statistics reports as long tables: one query a report table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.operators import finalize, sets, trees
from palaver.functions.text import nonempty
from palaver.operators.pending import states
from palaver.plans.registry import Board, query
from palaver.plans.relational import _FORUMS_SQL, _TOPICS_SQL, final_topics, six_sql


def stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def measures(df: DataFrame, *rows: tuple[str, Column]) -> DataFrame:
    """label, n: several measures of one frame in a single aggregation."""
    one = df.agg(*(m.cast("long").alias(f"m{i}") for i, (_, m) in enumerate(rows)))
    pairs = F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(name).alias("label"), F.coalesce(F.col(f"m{i}"), F.lit(0)).alias("n")) for i, (name, _) in enumerate(rows)))
    return one.select(F.explode(pairs).alias("r")).select("r.ord", "r.label", "r.n")


def sql_rows(source: str, *rows: tuple[str, str]) -> str:
    """The same in SQL: one aggregation, turned into rows."""
    return " UNION ALL ".join(f"SELECT {i} AS ord, '{name}' AS label, CAST(coalesce({m}, 0) AS BIGINT) AS n FROM {source}" for i, (name, m) in enumerate(rows))


def two_votes(polls: DataFrame) -> DataFrame:
    o = F.from_json("options", "array<struct<text:string,votes:bigint>>")
    return polls.select("topic_id", "max_options", F.aggregate(o, F.lit(0).cast("long"), lambda n, x: n + x["votes"]).alias("votes"))


_VOTES = "CAST(list_sum(list_transform(from_json(options, '[{\"text\":\"VARCHAR\",\"votes\":\"BIGINT\"}]'), lambda x: x.votes)) AS BIGINT)"


#: Sizes by which topics and users are counted: each bound and what lies up to the next.
SIZES = (1, 2, 6, 21, 101, 1001)
_SIZED_SQL = [(f"from {a}", f"count(*) FILTER (WHERE n >= {a}" + (f" AND n < {z})" if z else ")")) for a, z in zip(SIZES, (*SIZES[1:], None), strict=True)]


def sized(n: Column) -> list[tuple[str, Column]]:
    """Counts of rows by size, one measure a bound."""
    return [(f"from {a}", F.count_if((n >= a) & (n < z) if z else n >= a)) for a, z in zip(SIZES, (*SIZES[1:], None), strict=True)]


@query("r1_overview", "forums topics posts users polls files", " UNION ALL ".join(f"SELECT '{t}' AS label, count(*) AS n FROM {t}" for t in ("forums", "topics", "posts", "users", "polls", "files")))
def _(b: Board):
    return stacked([getattr(b, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("label"), "n") for t in ("forums", "topics", "posts", "users", "polls", "files")])


@query("r2_forums", "forums topics", sql_rows("(SELECT f.*, p.id AS pid, EXISTS (SELECT 1 FROM topics t WHERE t.forum_id = f.id) AS has FROM forums f LEFT JOIN forums p ON p.id = f.parent_id)",
    ("All", "count(*)"), ("at the top of the tree", "count(*) FILTER (WHERE pid IS NULL)"), ("in another forum", "count(pid)"), ("With topics", "count(*) FILTER (WHERE has)")))
def _(b: Board):
    parents = b.forums.select(F.col("id").alias("pid"))
    busy = b.topics.select(F.col("forum_id").alias("tid")).distinct()
    joined = b.forums.join(parents, F.col("parent_id") == F.col("pid"), "left").join(busy, F.col("id") == F.col("tid"), "left")
    return measures(joined, ("All", F.count("*")), ("at the top of the tree", F.count_if(F.col("pid").isNull())), ("in another forum", F.count("pid")), ("With topics", F.count("tid")))


@query("r3_forum_tree", "forums topics posts", """
WITH RECURSIVE w(id, name, depth, p) AS (SELECT id, name, 0, lpad(CAST(id AS STRING), 12, '0') FROM forums WHERE parent_id IS NULL
 UNION ALL SELECT f.id, f.name, w.depth + 1, w.p || '/' || lpad(CAST(f.id AS STRING), 12, '0') FROM w JOIN forums f ON f.parent_id = w.id),
t AS (SELECT forum_id, count(*) AS n FROM topics GROUP BY forum_id), p AS (SELECT t.forum_id, count(*) AS n FROM posts p JOIN topics t ON t.id = p.topic_id GROUP BY t.forum_id)
SELECT repeat('  ', depth) || name AS forum, w.id, coalesce(t.n, 0) AS topics, coalesce(p.n, 0) AS posts FROM w LEFT JOIN t ON t.forum_id = w.id LEFT JOIN p ON p.forum_id = w.id""")
def _(b: Board):
    topics = b.topics.groupBy(F.col("forum_id").alias("id")).agg(F.count("*").alias("topics"))
    per_topic = b.posts.groupBy("topic_id").agg(F.count("*").alias("n"))
    posts = per_topic.join(b.topics.select(F.col("id").alias("topic_id"), F.col("forum_id").alias("id")), "topic_id").groupBy("id").agg(F.sum("n").alias("posts"))
    tree = trees.paths(b.forums).join(topics, "id", "left").join(posts, "id", "left")
    return tree.orderBy("sort_path").select(F.concat(F.repeat(F.lit("  "), F.col("depth")), "name").alias("forum"), "id", F.coalesce("topics", F.lit(0)).alias("topics"), F.coalesce("posts", F.lit(0)).alias("posts"))


@query("r4_topics", "topics posts", sql_rows("(SELECT t.*, s.n FROM topics t LEFT JOIN (SELECT topic_id, count(*) AS n FROM posts GROUP BY 1) s ON s.topic_id = t.id)",
    ("All", "count(*)"), ("complete", "count(*) FILTER (WHERE coalesce(n, 0) >= post_count)"), ("fewer", "count(*) FILTER (WHERE n > 0 AND n < post_count)"),
    ("none", "count(*) FILTER (WHERE n IS NULL)"), ("Pinned", "count(*) FILTER (WHERE stickied)"), ("Locked", "count(*) FILTER (WHERE locked)"), *_SIZED_SQL))
def _(b: Board):
    stored = b.posts.groupBy(F.col("topic_id").alias("id")).agg(F.count("*").alias("n"))
    t = b.topics.join(stored, "id", "left")
    n = F.col("n")
    return measures(t, ("All", F.count("*")), ("complete", F.count_if(F.coalesce(n, F.lit(0)) >= F.col("post_count"))), ("fewer", F.count_if((n > 0) & (n < F.col("post_count")))),
                    ("none", F.count_if(n.isNull())), ("Pinned", F.count_if("stickied")), ("Locked", F.count_if("locked")), *sized(n))


@query("r5_posts", "posts state", sql_rows("(SELECT user_id, flag, status, (SELECT count(*) FROM state WHERE starts_with(key, 'post-gap:')) AS gaps FROM posts)",
    ("All", "count(*)"), ("by members", "count(*) FILTER (WHERE user_id IS DISTINCT FROM 0)"), ("by guests", "count(*) FILTER (WHERE user_id = 0)"), ("With source", "count(*) FILTER (WHERE flag <> 'A')"),
    ("repaired", "count(*) FILTER (WHERE flag <> 'A' AND flag || status <> 'NO')"), ("not fetched yet", "greatest(0, count(*) FILTER (WHERE flag = 'A') - max(gaps))")))
def _(b: Board):
    gaps = states(b.state, "post-gap:").agg(F.count("*").alias("gaps"))
    p = b.posts.crossJoin(F.broadcast(gaps))  # one row
    source = F.when(F.col("flag") != "A", F.concat("flag", "status"))
    return measures(p, ("All", F.count("*")), ("by members", F.count_if(~F.col("user_id").eqNullSafe(F.lit(0)))), ("by guests", F.count_if(F.col("user_id") == 0)), ("With source", F.count(source)),
                    ("repaired", F.count_if(source.isNotNull() & (source != "NO"))), ("not fetched yet", F.greatest(F.lit(0), F.count_if(source.isNull()) - F.max("gaps"))))


@query("r6_users", "users posts signatures files", sql_rows("(SELECT u.id, u.name, s.n, coalesce(nullif(g.signature_fixed, ''), nullif(g.signature_source, ''), nullif(g.signature, '')) AS sig, f.id AS avatar, f.status, (SELECT count(DISTINCT user_id) FROM posts WHERE user_id <> 0 AND user_id NOT IN (SELECT id FROM users)) AS others FROM users u LEFT JOIN (SELECT user_id, count(*) AS n FROM posts GROUP BY 1) s ON s.user_id = u.id LEFT JOIN signatures g ON g.id = u.id LEFT JOIN files f ON f.id = u.id AND f.kind = 'image' WHERE u.id <> 0)",
    ("All", "count(*)"), ("with posts", "count(n)"), ("without posts", "count(*) FILTER (WHERE n IS NULL)"), ("Named only by their id", "count(*) FILTER (WHERE name = CAST(id AS STRING))"),
    ("With a signature", "count(sig)"), ("With an avatar", "count(avatar)"), ("kept again", "count(*) FILTER (WHERE status = 'kept')"), ("Whose picture is gone", "count(*) FILTER (WHERE status = 'missing')"), ("Posters the table lacks", "max(others)"), *_SIZED_SQL))
def _(b: Board):
    posted = b.posts.filter("user_id <> 0").groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("n"))
    text = nonempty(F.col("signature_fixed"), F.col("signature_source"), F.col("signature"))
    u = b.users.filter("id <> 0").join(posted, "id", "left").join(b.signatures.select("id", text.alias("sig")), "id", "left")
    u = u.join(b.files.filter("kind = 'image'").select("id", F.col("id").alias("avatar"), "status"), "id", "left")
    others = posted.join(b.users, "id", "left_anti").agg(F.count("*").alias("others"))
    u = u.crossJoin(F.broadcast(others))  # one row
    return measures(u, ("All", F.count("*")), ("with posts", F.count("n")), ("without posts", F.count_if(F.col("n").isNull())), ("Named only by their id", F.count_if(F.col("name") == F.col("id").cast("string"))),
                    ("With a signature", F.count("sig")), ("With an avatar", F.count("avatar")), ("kept again", F.count_if(F.col("status") == "kept")), ("Whose picture is gone", F.count_if(F.col("status") == "missing")), ("Posters the table lacks", F.max("others")), *sized(F.col("n")))


@query("r7_groups", "users", "SELECT group_name AS name, count(*) AS members FROM users GROUP BY group_name")
def _(b: Board):
    return b.users.groupBy(F.col("group_name").alias("name")).agg(F.count("*").alias("members"))


@query("r8_by_year", "topics posts users", f"""WITH {_TOPICS_SQL}, f AS (SELECT coalesce(CAST(year(created_at) AS STRING), 'unknown') AS y, 't' AS k, NULL::BIGINT AS u FROM ft
 UNION ALL SELECT coalesce(CAST(year(posted_at) AS STRING), 'unknown'), 'p', CASE WHEN user_id <> 0 THEN user_id END FROM posts
 UNION ALL SELECT coalesce(CAST(year(joined_at) AS STRING), 'unknown'), 'j', NULL FROM users WHERE id <> 0), g AS (
SELECT y AS year, count(*) FILTER (WHERE k = 't') AS topics, count(*) FILTER (WHERE k = 'p') AS posts, count(DISTINCT u) AS posters, count(*) FILTER (WHERE k = 'j') AS joins FROM f GROUP BY y)
SELECT *, CAST(row_number() OVER (ORDER BY year = 'unknown', year) AS INT) AS ord FROM g""")
def _(b: Board):
    from pyspark.sql import Window

    table = finalize.by_year(final_topics(b), b.posts, b.users)
    return table.withColumn("ord", F.row_number().over(Window.orderBy(F.col("year") == "unknown", "year")))


@query("r9_polls", "topics polls state", f"""WITH p AS (SELECT topic_id, max_options, {_VOTES} AS votes FROM polls), m AS (SELECT TRY_CAST(substr(key, 6) AS BIGINT) AS id FROM state WHERE starts_with(key, 'poll:'))
SELECT 0 AS ord, 'results' AS label, count(*) AS n, CAST(sum(votes) AS BIGINT) AS votes FROM p UNION ALL SELECT 1, 'several options', count(*), CAST(sum(votes) AS BIGINT) FROM p WHERE max_options > 1
UNION ALL SELECT 2, 'showing none', count(*), NULL FROM topics WHERE has_poll AND id IN (SELECT id FROM m) AND id NOT IN (SELECT topic_id FROM p)
UNION ALL SELECT 3, 'not fetched', count(*), NULL FROM topics WHERE has_poll AND id NOT IN (SELECT id FROM m) AND id NOT IN (SELECT topic_id FROM p)""")
def _(b: Board):
    p = two_votes(b.polls)
    missing = states(b.state, "poll:").select(F.col("suffix").try_cast("bigint").alias("id")).withColumn("gone", F.lit(True))
    open_ = b.topics.filter("has_poll").select("id").join(p.select(F.col("topic_id").alias("id")), "id", "left_anti").join(missing, "id", "left")
    first = [p.agg(F.count("*").alias("n"), F.sum("votes").alias("votes")).select(F.lit(0).alias("ord"), F.lit("results").alias("label"), "n", "votes"),
             p.filter("max_options > 1").agg(F.count("*").alias("n"), F.sum("votes").alias("votes")).select(F.lit(1).alias("ord"), F.lit("several options").alias("label"), "n", "votes")]
    rest = [open_.agg(F.count_if(c).alias("n")).select(F.lit(i).alias("ord"), F.lit(label).alias("label"), "n", F.lit(None).cast("long").alias("votes")) for i, label, c in ((2, "showing none", F.col("gone").isNotNull()), (3, "not fetched", F.col("gone").isNull()))]
    return stacked([*first, *rest])


_LOST = "count(*) FILTER (WHERE data IS NULL AND status = 'missing')"


@query("r10_attachments", "files", f"""WITH f AS (SELECT * FROM files WHERE coalesce(uses, 1) > 0), g AS (
 SELECT 'All' AS label, * FROM f UNION ALL SELECT kind, * FROM f UNION ALL SELECT 'only in signatures', * FROM f WHERE first_post_id IS NULL)
SELECT label, count(*) AS files, CAST(sum(coalesce(uses, 0)) AS BIGINT) AS uses, count(data) AS kept, {_LOST} AS lost, count(*) - count(data) - {_LOST} AS open FROM g GROUP BY label""")
def _(b: Board):
    f = b.files.filter(F.coalesce("uses", F.lit(1)) > 0)
    labels = F.explode(F.array_compact(F.array(F.lit("All"), F.col("kind"), F.when(F.col("first_post_id").isNull(), "only in signatures"))))
    lost = F.count_if(F.col("data").isNull() & (F.col("status") == "missing"))
    table = f.withColumn("label", labels).groupBy("label").agg(F.count("*").alias("files"), F.sum(F.coalesce("uses", F.lit(0))).alias("uses"), F.count("data").alias("kept"), lost.alias("lost"))
    return table.withColumn("open", F.col("files") - F.col("kept") - F.col("lost"))


@query("r11_smileys", "files", f"SELECT host, count(*) AS smileys, CAST(sum(coalesce(uses, 0)) AS BIGINT) AS uses, count(data) AS kept, {_LOST} AS lost FROM files GROUP BY host")
def _(b: Board):
    lost = F.count_if(F.col("data").isNull() & (F.col("status") == "missing"))
    return b.files.groupBy("host").agg(F.count("*").alias("smileys"), F.sum(F.coalesce("uses", F.lit(0))).alias("uses"), F.count("data").alias("kept"), lost.alias("lost"))


@query("r14_files_kept", "files", "SELECT kind, count(data) AS files, round_even(coalesce(sum(strlen(data)), 0) / 1048576, 4) AS mb FROM files GROUP BY kind")
def _(b: Board):
    return b.files.groupBy("kind").agg(F.count("data").alias("files"), F.bround(F.coalesce(F.sum(F.octet_length("data")), F.lit(0)) / 1048576, 4).alias("mb"))


# Two sources

_W = "(topic_id) AS k FROM posts"


@query("r20_source_overview", "forums second_forums topics second_topics posts users polls files", " UNION ALL ".join((
    six_sql("Forums", "id AS k FROM forums", "id AS k FROM second_forums"), six_sql("Topics", "id AS k FROM topics", "id AS k FROM second_topics"),
    six_sql("Posts", "id AS k FROM posts", "id AS k FROM posts WHERE flag <> ''A''".replace("''", "'")), six_sql("Members", "id AS k FROM users WHERE id <> 0", "user_id AS k FROM posts WHERE user_id <> 0"),
    six_sql("Members with an avatar", "id AS k FROM files WHERE kind = 'image' AND data IS NOT NULL", "id AS k FROM files WHERE kind = 'image' AND uses > 0"), six_sql("Polls", "topic_id AS k FROM polls", "id AS k FROM second_topics WHERE pinned"),
    six_sql("Attachments", "id AS k FROM files WHERE kind = 'file' AND data IS NOT NULL", "id AS k FROM files WHERE kind = 'file' AND first_post_id IS NOT NULL"), six_sql("Smileys", "id AS k FROM files WHERE signature_uses > 0", "id AS k FROM files WHERE post_uses > 0"))))
def _(b: Board):
    kept = b.files.filter("data is not null")
    members = b.users.filter("id <> 0"), b.posts.filter("user_id <> 0").select(F.col("user_id").alias("id"))
    return stacked([sets.six_counts(b.forums, b.second_forums, "id", "Forums"), sets.six_counts(b.topics, b.second_topics, "id", "Topics"),
                    sets.six_counts(b.posts, b.posts.filter("flag <> 'A'"), "id", "Posts"), sets.six_counts(*members, "id", "Members"),
                    sets.six_counts(kept.filter("kind = 'image'"), b.files.filter("kind = 'image' and uses > 0"), "id", "Members with an avatar"),
                    sets.six_counts(b.polls.select(F.col("topic_id").alias("id")), b.second_topics.filter("pinned"), "id", "Polls"),
                    sets.six_counts(kept.filter("kind = 'file'"), b.files.filter("kind = 'file' and first_post_id is not null"), "id", "Attachments"),
                    sets.six_counts(b.files.filter("signature_uses > 0"), b.files.filter("post_uses > 0"), "id", "Smileys")])


@query("r21_forums_of_one_source", "forums second_forums topics", """
SELECT coalesce(f.id, s.id) AS id, coalesce(f.name, s.name) AS name, CASE WHEN f.id IS NULL THEN 'second' ELSE 'first' END AS source, (SELECT count(*) FROM topics t WHERE t.forum_id = coalesce(f.id, s.id)) AS topics
FROM forums f FULL JOIN second_forums s ON s.id = f.id WHERE f.id IS NULL OR s.id IS NULL""")
def _(b: Board):
    only = sets.symmetric_difference(b.forums, b.second_forums, "id")
    names = b.forums.select("id", F.col("name").alias("a")).join(b.second_forums.select("id", F.col("name").alias("b")), "id", "full_outer")
    n = b.topics.groupBy(F.col("forum_id").alias("id")).agg(F.count("*").alias("topics"))
    return only.join(names, "id").join(n, "id", "left").select("id", F.coalesce("a", "b").alias("name"), F.when(F.col("side") == "a", "first").otherwise("second").alias("source"), F.coalesce("topics", F.lit(0)).alias("topics"))


_NONE = "id AS k FROM topics WHERE FALSE"


@query("r22_source_topics", "topics second_topics posts polls", " UNION ALL ".join((
    six_sql("In a listing", _NONE, "id AS k FROM second_topics WHERE started_at IS NOT NULL"), six_sql("With full pages of posts", _NONE, "topic_id AS k FROM posts WHERE flag <> 'A'"),
    six_sql("With lite pages", _NONE, "topic_id AS k FROM posts WHERE flag = 'A' AND status = 'F'"), six_sql("With a description", _NONE, "id AS k FROM second_topics WHERE title LIKE '%-%'"),
    six_sql("Flag P", "k FROM (SELECT id AS k FROM topics WHERE has_poll UNION SELECT topic_id FROM polls)", "id AS k FROM second_topics WHERE pinned AND question"),
    six_sql("Flag A", _NONE, "id AS k FROM second_topics WHERE pinned"), six_sql("Flag Q", _NONE, "id AS k FROM second_topics WHERE question"), six_sql("Locked", "id AS k FROM topics WHERE locked", _NONE),
    six_sql("All", "id AS k FROM topics", "id AS k FROM second_topics"), six_sql("With posts", "topic_id AS k FROM posts", "id AS k FROM second_topics WHERE question"),
    f"""SELECT 'Pinned' AS label, (SELECT count(*) FROM (SELECT id FROM topics WHERE stickied UNION (SELECT id FROM second_topics WHERE pinned EXCEPT SELECT id FROM topics))) AS shown, * EXCLUDE (label, shown)
    FROM ({six_sql("Pinned", "id AS k FROM topics WHERE stickied", "id AS k FROM second_topics WHERE pinned")})""")))
def _(b: Board):
    a, s = b.topics, b.second_topics
    pinned_a, pinned_b = a.filter("stickied"), s.filter("pinned")
    known = a.select("id", F.lit(True).alias("known"))
    marked = sets.presence(pinned_a, pinned_b, "id").join(known.withColumnRenamed("id", "key"), "key", "left")
    a_, b_ = F.col("in_a"), F.col("in_b")
    pinned = marked.agg(F.count_if(a_ | F.col("known").isNull()).alias("shown"), F.count_if(a_).alias("n_a"), F.count_if(b_).alias("n_b"), F.count_if(a_ & ~b_).alias("only_a"), F.count_if(b_ & ~a_).alias("only_b"), F.count_if(a_ & b_).alias("both")).select(F.lit("Pinned").alias("label"), "*")
    none, topic = a.limit(0).select("id"), F.col("topic_id").alias("id")
    polled = a.filter("has_poll").select("id").unionByName(b.polls.select(topic))
    rows = [("In a listing", none, s.filter("started_at is not null")), ("With full pages of posts", none, b.posts.filter("flag <> 'A'").select(topic)), ("With lite pages", none, b.posts.filter("flag = 'A' and status = 'F'").select(topic)),
            ("With a description", none, s.filter("title like '%-%'")), ("Flag P", polled, s.filter("pinned and question")), ("Flag A", none, s.filter("pinned")), ("Flag Q", none, s.filter("question")), ("Locked", a.filter("locked"), none)]
    return stacked([*(sets.six_counts(x, y, "id", label) for label, x, y in rows), sets.six_counts(a, s, "id", "All"), sets.six_counts(b.posts.select(F.col("topic_id").alias("id")), s.filter("question"), "id", "With posts"), pinned])


@query("r23_source_posts", "posts", " UNION ALL ".join((
    six_sql("All", "CAST(id AS STRING) AS k FROM posts", "CASE WHEN status = ''O'' THEN CAST(id AS STRING) ELSE ''f:'' || id END AS k FROM posts WHERE flag <> ''A''".replace("''", "'")),
    six_sql("By guests", "CAST(id AS STRING) AS k FROM posts WHERE user_id = 0", "CASE WHEN status = ''O'' THEN CAST(id AS STRING) ELSE ''f:'' || id END AS k FROM posts WHERE flag <> ''A'' AND user_id = 0".replace("''", "'")),
    six_sql("With a full copy", "CAST(id AS STRING) AS k FROM posts WHERE FALSE", "CASE WHEN status = ''O'' THEN CAST(id AS STRING) ELSE ''f:'' || id END AS k FROM posts WHERE flag = ''N''".replace("''", "'")),
    six_sql("With a lite copy", "CAST(id AS STRING) AS k FROM posts WHERE FALSE", "CAST(id AS STRING) AS k FROM posts WHERE flag = 'R'"))))
def _(b: Board):
    # A copy that no post is known for has a key of its own.
    key = F.when(F.col("status") == "O", F.col("id").cast("string")).otherwise(F.concat(F.lit("f:"), F.col("id").cast("string")))
    own = b.posts.select(F.col("id").cast("string").alias("key"), "user_id")
    copies = b.posts.filter("flag <> 'A'").select(key.alias("key"), "user_id")
    none = own.limit(0)
    full, lite = b.posts.filter("flag = 'N'").select(key.alias("key")), b.posts.filter("flag = 'R'").select(F.col("id").cast("string").alias("key"))
    return stacked([sets.six_counts(none, full, "key", "With a full copy"), sets.six_counts(none, lite, "key", "With a lite copy"), sets.six_counts(own, copies, "key", "All"), sets.six_counts(own.filter("user_id = 0"), copies.filter("user_id = 0"), "key", "By guests")])


@query("r24_copies", "posts", "SELECT status AS match, count(*) AS n, count(*) FILTER (WHERE flag = 'R') AS shown FROM posts WHERE flag <> 'A' GROUP BY status")
def _(b: Board):
    return b.posts.filter("flag <> 'A'").groupBy(F.col("status").alias("match")).agg(F.count("*").alias("n"), F.count_if(F.col("flag") == "R").alias("shown"))


@query("r26_avatars", "files", sql_rows("(SELECT a.id AS a, b.id AS b, a.data = b.data AS same FROM (SELECT id, data FROM files WHERE data IS NOT NULL AND kind <> 'link') a FULL JOIN (SELECT id, CASE WHEN uses = 1 THEN data ELSE data || 'x' END AS data FROM files WHERE data IS NOT NULL AND kind <> 'file') b ON a.id = b.id)",
    ("first", "count(a)"), ("second", "count(b)"), ("same file", "count(*) FILTER (WHERE same)"), ("another file", "count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL AND NOT coalesce(same, FALSE))"),
    ("only second", "count(*) FILTER (WHERE a IS NULL)"), ("shown", "count(a) + count(b) - count(*) FILTER (WHERE same)")))
def _(b: Board):
    first = b.files.filter("data is not null and kind <> 'link'").select(F.col("id").alias("a"), F.col("data").alias("da"))
    second = b.files.filter("data is not null and kind <> 'file'").select(F.col("id").alias("b"), F.when(F.col("uses") == 1, F.col("data")).otherwise(F.concat("data", F.lit("x"))).alias("db"))
    j = first.join(second, F.col("a") == F.col("b"), "full_outer")
    same = F.coalesce(F.col("da") == F.col("db"), F.lit(False))
    return measures(j, ("first", F.count("a")), ("second", F.count("b")), ("same file", F.count_if(same)), ("another file", F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull() & ~same)),
                    ("only second", F.count_if(F.col("a").isNull())), ("shown", F.count("a") + F.count("b") - F.count_if(same)))


@query("r27_source_polls", "polls topics", sql_rows(f"(SELECT a.topic_id AS a, b.topic_id AS b, a.votes AS va, b.votes AS vb FROM (SELECT topic_id, {_VOTES} AS votes FROM polls WHERE max_options <= 2) a FULL JOIN (SELECT topic_id, topic_id % 20 AS votes FROM polls WHERE max_options >= 2) b ON a.topic_id = b.topic_id)",
    ("results", "count(*)"), ("second only", "count(*) FILTER (WHERE a IS NULL)"), ("second has more", "count(*) FILTER (WHERE vb > va)")))
def _(b: Board):
    a = two_votes(b.polls.filter("max_options <= 2")).select(F.col("topic_id").alias("a"), F.col("votes").alias("va"))
    s = b.polls.filter("max_options >= 2").select(F.col("topic_id").alias("b"), (F.col("topic_id") % 20).alias("vb"))
    j = a.join(s, F.col("a") == F.col("b"), "full_outer")
    return measures(j, ("results", F.count("*")), ("second only", F.count_if(F.col("a").isNull())), ("second has more", F.count_if(F.col("vb") > F.col("va"))))


@query("r28_attachments_by_origin", "files", "SELECT kind, count(*) AS files, count(data) AS kept, count(*) FILTER (WHERE data IS NOT NULL AND starts_with(url, 'http://brand#1')) AS archive, count(*) FILTER (WHERE data IS NULL) AS lost FROM files WHERE uses > 0 GROUP BY kind")
def _(b: Board):
    has = F.col("data").isNotNull()
    return b.files.filter("uses > 0").groupBy("kind").agg(F.count("*").alias("files"), F.count("data").alias("kept"), F.count_if(has & F.col("url").startswith("http://brand#1")).alias("archive"), F.count_if(~has).alias("lost"))


@query("r29_smileys_with_code", "files", "SELECT f.host, count(*) AS smileys, count(f.data) AS kept, count(c.code) AS titled FROM files f LEFT JOIN (SELECT id, ':' || id || ':' AS code FROM files WHERE kind = 'file') c ON c.id = f.id GROUP BY f.host")
def _(b: Board):
    codes = b.files.filter("kind = 'file'").select("id", F.concat(F.lit(":"), F.col("id").cast("string"), F.lit(":")).alias("code"))
    return b.files.join(codes, "id", "left").groupBy("host").agg(F.count("*").alias("smileys"), F.count("data").alias("kept"), F.count("code").alias("titled"))


# Site model

@query("m4_topic_table", "topics posts users", f"""WITH {_TOPICS_SQL}
SELECT ft.id, ft.forum_id, CASE WHEN ft.user_id = 0 THEN 'guest' ELSE coalesce(u.name, 'user ' || ft.user_id) END AS starter, concat(CASE WHEN stickied THEN 'S' ELSE '' END, CASE WHEN locked THEN 'L' ELSE '' END, CASE WHEN has_poll THEN 'P' ELSE '' END) AS flags,
 ft.post_count, p.user_id AS last_user FROM ft LEFT JOIN users u ON u.id = ft.user_id AND u.id <> 0 LEFT JOIN posts p ON p.id = ft.last_post_id""")
def _(b: Board):
    from palaver.operators.site import topic_table

    return topic_table(final_topics(b), b.posts, b.users)


@query("m6_overlay_topics", "topics second_topics", "SELECT id, 'first' AS source, listed_at AS at FROM topics UNION ALL SELECT id, 'second', started_at FROM second_topics WHERE id NOT IN (SELECT id FROM topics)")
def _(b: Board):
    from palaver.operators.site import overlay

    return overlay(b.topics.select("id", F.lit("first").alias("source"), F.col("listed_at").alias("at")), b.second_topics.select("id", F.lit("second").alias("source"), F.col("started_at").alias("at")), "id")


@query("m7_lost_topics", "posts", "SELECT topic_id, arg_min(id, struct_pack(a := posted_at, b := id)) AS first_post, arg_max(id, struct_pack(a := posted_at, b := id)) AS last_post, count(*) AS n, min(posted_at) AS started FROM posts GROUP BY topic_id")
def _(b: Board):
    from palaver.operators.site import lost_topics

    return lost_topics(b.posts)


@query("m5_authors", "posts users", "SELECT p.id, CASE WHEN u.name IS NOT NULL AND p.user_id <> 0 THEN u.name WHEN p.user_id = 0 THEN 'guest' ELSE 'user ' || p.user_id END AS author FROM posts p LEFT JOIN users u ON u.id = p.user_id")
def _(b: Board):
    from palaver.operators.site import authors

    return authors(b.posts, b.users).select("id", "author")


@query("m4_forum_table", "forums topics posts", f"{_FORUMS_SQL} SELECT ff.id, ff.name, ff.post_count, p.posted_at AS last_time, CAST(row_number() OVER (PARTITION BY ff.parent_id ORDER BY p.posted_at DESC NULLS LAST, ff.id) AS INT) AS place FROM ff LEFT JOIN posts p ON p.id = ff.last_post_id")
def _(b: Board):
    from palaver.operators.site import forum_table
    from palaver.plans.relational import final_forums

    return forum_table(final_forums(b), b.posts)
