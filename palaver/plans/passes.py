"""Queries of the passes over texts, images, captures and references."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from palaver.functions import dates, urls
from palaver.operators import history, ids, images, names, pending, ranges, texts
from palaver.plans.registry import Board, query


@query("s6_quoting_texts", "markup_posts", "SELECT id, coalesce(source_fixed, source) AS text FROM markup_posts WHERE coalesce(source_fixed, source) IS NOT NULL AND (source_fixed ILIKE '%[quote%' OR source ILIKE '%[quote%')")
def _(b: Board):
    return texts.best_texts(b.markup_posts, quoting=True, with_html=False)


@query("s7_best_texts_with_html")
def _(b: Board):
    return texts.best_texts(b.markup_posts).select("id", F.char_length("text").alias("n"))


@query("s8_signature_texts", "signatures", "SELECT id, coalesce(nullif(signature_fixed, ''), nullif(signature_source, ''), nullif(signature, '')) AS text FROM signatures WHERE id <> 0 AND coalesce(nullif(signature_fixed, ''), nullif(signature_source, ''), nullif(signature, '')) IS NOT NULL")
def _(b: Board):
    return texts.signature_texts(b.signatures)


_EMB = r"e AS (SELECT id, trim(unnest(regexp_extract_all(coalesce(source_fixed, source), '(?i)\[img\]\s*([^\[\]\s]+)\s*\[/img\]', 1))) AS url FROM markup_posts WHERE coalesce(source_fixed, source) ILIKE '%[img]%')"


@query("t14_embedded_urls", "markup_posts", f"WITH {_EMB} SELECT id, regexp_replace(url, '#.*$', '') AS url FROM e WHERE NOT regexp_matches(url, 'smile\\.example') AND regexp_matches(url, '(?i)^https?://')")
def _(b: Board):
    return texts.embedded(texts.best_texts(b.markup_posts, with_html=False), r"smile\.example")


@query("a13_smiley_uses", "markup_posts", f"WITH {_EMB} SELECT url, count(*) AS uses FROM e WHERE contains(url, '//smile.example') GROUP BY url")
def _(b: Board):
    return texts.collect_smilies(texts.best_texts(b.markup_posts, with_html=False), "http://board.example", r"^smile\.example$")


@query("t15_smiley_ids", "markup_posts", f"WITH {_EMB}, u AS (SELECT url, count(*) AS uses FROM e WHERE contains(url, '//smile.example') GROUP BY url) SELECT url, uses, row_number() OVER (ORDER BY uses DESC, url) AS id FROM u")
def _(b: Board):
    found = texts.collect_smilies(texts.best_texts(b.markup_posts, with_html=False), "http://board.example", r"^smile\.example$")
    return ids.assign_ids(found.limit(0).select("url", F.lit(0).cast("long").alias("id")), found, "url", [F.desc("uses"), "url"])


@query("a14_refreshed_uses", "markup_posts files", f"""WITH {_EMB}, k AS (SELECT 'http://smile.example/' || id || '.gif' AS url, signature_uses, post_uses FROM files WHERE kind = 'image'), n AS (SELECT url, count(*) AS n FROM e GROUP BY url)
SELECT coalesce(k.url, n.url) AS url, coalesce(k.signature_uses, 0) AS signature_uses, coalesce(n.n, 0) AS post_uses FROM k FULL JOIN n ON n.url = k.url""")
def _(b: Board):
    known = b.files.filter("kind = 'image'").select(F.concat(F.lit("http://smile.example/"), F.col("id").cast("string"), F.lit(".gif")).alias("url"), "signature_uses", "post_uses")
    each = texts.best_texts(b.markup_posts, with_html=False).filter(F.col("text").ilike("%[img]%")).select("id", F.explode(F.regexp_extract_all("text", F.lit(texts.IMG), F.lit(1))).alias("url"))
    return texts.refresh_uses(known, each, "post")


@query("l9_image_decision", "files", """
WITH i AS (SELECT id, CASE id % 5 WHEN 0 THEN 'image' WHEN 1 THEN 'gone' WHEN 2 THEN 'moved' WHEN 3 THEN 'dead' END AS live, 'd' || (id % 3) AS ld, CASE WHEN id % 4 <> 0 THEN 'd' || (id % 2) END AS ar, id % 7 = 0 AS pl, id % 11 = 0 AS pa FROM files)
SELECT id, CASE WHEN live IS NULL THEN NULL WHEN live = 'image' AND NOT pl AND ar IS NOT NULL AND NOT pa AND ar <> ld THEN 'archived' WHEN live = 'image' AND NOT pl THEN 'live' WHEN ar IS NOT NULL AND NOT pa THEN 'archived' ELSE 'missing' END AS status,
 CASE WHEN live IS NULL OR (live = 'image' AND NOT pl AND NOT (ar IS NOT NULL AND NOT pa AND ar <> ld)) THEN NULL WHEN live = 'image' AND NOT pl AND ar IS NOT NULL AND NOT pa AND ar <> ld THEN 'changed since' WHEN live = 'image' AND pl THEN 'placeholder' WHEN live = 'moved' THEN 'moved' WHEN live = 'dead' THEN 'host is gone' END AS note FROM i""")
def _(b: Board):
    k = F.col("id") % 5
    live = F.when(k == 0, "image").when(k == 1, "gone").when(k == 2, "moved").when(k == 3, "dead")
    d = lambda n: F.concat(F.lit("d"), (F.col("id") % n).cast("string"))
    return images.decide(b.files.select("id", live.alias("live"), d(3).alias("live_digest"), F.when(F.col("id") % 4 != 0, d(2)).alias("archived"), (F.col("id") % 7 == 0).alias("placeholder_live"), (F.col("id") % 11 == 0).alias("placeholder_archived")))


@query("z12_dead_hosts", "", """
WITH o AS (SELECT user_id AS host, event_id AS tried, event_type <> 'error' AND event_type <> 'click' AS ok FROM events),
r AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY tried) AS run FROM o),
c AS (SELECT *, row_number() OVER (PARTITION BY host, run ORDER BY tried) AS k FROM r WHERE NOT ok) SELECT host, min(tried) AS given_up FROM c WHERE k = 3 GROUP BY host""")
def _(b: Board):
    return images.dead_hosts(b.events.select(F.col("user_id").alias("host"), F.col("event_id").alias("tried"), (~F.col("event_type").isin("error", "click")).alias("ok")))


@query("j27_host_placeholders", "", "SELECT event_type AS host, user_id AS digest FROM events GROUP BY ALL HAVING count(DISTINCT hour(ts)) >= 3")
def _(b: Board):
    return images.placeholders(b.events.select(F.col("event_type").alias("host"), F.col("user_id").alias("digest"), F.hour("ts").alias("name")))


@query("j28_captures_by_folder", "", r"""
WITH p AS (SELECT page_id, nullif(regexp_extract(url, '(?i)^([a-z][a-z0-9+.-]*://[^/?#]+/[^?#]*/)[^/?#]*', 1), '') AS folder, url FROM pages)
SELECT folder, count(*) AS images, min(page_id) AS first FROM p WHERE folder IS NOT NULL GROUP BY folder HAVING count(*) >= 1""")
def _(b: Board):
    return b.pages.select("page_id", urls.folder_of(F.col("url")).alias("folder")).filter("folder is not null").groupBy("folder").agg(F.count("*").alias("images"), F.min("page_id").alias("first"))


@query("s15_merged_captures", "", """
WITH e AS (SELECT event_id % 40 AS file_id, date_trunc('hour', ts) AS at, user_id AS size, CASE event_type WHEN 'view' THEN 'snapshots' WHEN 'click' THEN 'flat' ELSE 'hashed' END AS source FROM events),
s AS (SELECT * FROM e WHERE source = 'snapshots'), f AS (SELECT * FROM e WHERE source = 'flat' AND NOT EXISTS (SELECT 1 FROM s WHERE s.file_id = e.file_id AND s.size = e.size)),
h AS (SELECT * FROM e WHERE source = 'hashed' AND NOT EXISTS (SELECT 1 FROM s WHERE s.file_id = e.file_id AND s.at = e.at) AND NOT EXISTS (SELECT 1 FROM f WHERE f.file_id = e.file_id AND f.size = e.size))
SELECT source, count(*) AS n, CAST(sum(size) AS BIGINT) AS size FROM (SELECT * FROM s UNION ALL SELECT * FROM f UNION ALL SELECT * FROM h) GROUP BY source""")
def _(b: Board):
    from palaver.sources.dumps import merge_dumps

    source = F.when(F.col("event_type") == "view", "snapshots").when(F.col("event_type") == "click", "flat").otherwise("hashed")
    captures = b.events.select((F.col("event_id") % 40).alias("file_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("captured_at"), F.col("user_id").alias("size"), source.alias("source"))
    return merge_dumps([captures]).groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("size"))


@query("f5_pending_profiles", "users state", "SELECT id FROM users WHERE id NOT IN (SELECT TRY_CAST(substr(key, 6) AS BIGINT) FROM state WHERE starts_with(key, 'poll:'))")
def _(b: Board):
    done = pending.states(b.state, "poll:").select(F.col("suffix").try_cast("bigint").alias("id"))
    return b.users.select("id").join(done, "id", "left_anti")


@query("f6_pending_sources", "markup_posts", "SELECT id FROM markup_posts WHERE source IS NULL AND source_fixed IS NOT NULL")
def _(b: Board):
    gaps = b.markup_posts.filter("source_fixed is null").select(F.concat(F.lit("source-gap:"), F.col("id").cast("string")).alias("key"), F.lit("x").alias("value"))
    return pending.sources(b.markup_posts, gaps)


@query("f12_may_reference", "markup_posts", "SELECT id FROM markup_posts WHERE contains(coalesce(source_fixed, source), 'smile.example/1') OR contains(coalesce(source_fixed, source), 'smile.example/2')")
def _(b: Board):
    x = F.coalesce("source_fixed", "source")
    return b.markup_posts.filter(x.contains("smile.example/1") | x.contains("smile.example/2")).select("id")


@query("j6_avatars_not_recovered", "users files", "SELECT id FROM users u WHERE NOT EXISTS (SELECT 1 FROM files f WHERE f.id = u.id AND f.data IS NOT NULL)")
def _(b: Board):
    return b.users.select("id").join(b.files.filter("data is not null").select("id"), "id", "left_anti")


@query("j11_attachment_topics", "files posts", "SELECT f.id, p.topic_id FROM files f JOIN posts p ON p.id = f.first_post_id")
def _(b: Board):
    return b.files.select("id", F.col("first_post_id").alias("pid")).join(b.posts.select(F.col("id").alias("pid"), "topic_id"), "pid").select("id", "topic_id")


@query("j13_polls_of_lost_topics", "polls second_topics topics", "SELECT p.topic_id, p.max_options FROM polls p JOIN second_topics s ON s.id = p.topic_id WHERE s.question AND s.id IN (SELECT id FROM topics WHERE NOT locked)")
def _(b: Board):
    asked = b.second_topics.filter("question").select(F.col("id").alias("topic_id"))
    open_ = b.topics.filter("not locked").select(F.col("id").alias("topic_id"))
    return b.polls.join(asked, "topic_id").join(open_, "topic_id", "left_semi").select("topic_id", "max_options")


@query("j15_url_lookup", "markup_posts", f"WITH {_EMB}, d AS (SELECT DISTINCT url, length(url)::BIGINT AS k FROM e WHERE contains(url, 'smile')) SELECT e.id, d.url, count(*) AS n FROM e JOIN d ON d.url = e.url GROUP BY ALL")
def _(b: Board):
    found = texts.embedded(texts.best_texts(b.markup_posts, with_html=False))
    known = found.filter(F.col("url").contains("smile")).select("url").distinct()
    return found.join(known, "url").groupBy("id", "url").agg(F.count("*").alias("n"))


@query("l6_interpolated", "posts", """
WITH known AS (SELECT id, posted_at AS ts FROM posts WHERE status = 'F' AND flag = 'R'), q AS (SELECT id, topic_id FROM posts),
v AS (SELECT q.*, max(k.id) OVER (ORDER BY q.id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lk, min(k.id) OVER (ORDER BY q.id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hk FROM q LEFT JOIN known k ON k.id = q.id),
w AS (SELECT v.id, v.topic_id, a.ts AS lo, z.ts AS hi FROM v JOIN known a ON a.id = v.lk JOIN known z ON z.id = v.hk WHERE v.id NOT IN (SELECT id FROM known))
SELECT w.id AS old_id, min(p.id) AS post_id FROM w JOIN posts p ON p.topic_id = w.topic_id AND p.posted_at BETWEEN w.lo AND w.hi WHERE w.lo <= w.hi GROUP BY w.id HAVING count(*) = 1""")
def _(b: Board):
    known = b.posts.filter("status = 'F' and flag = 'R'").select("id", F.col("posted_at").alias("ts"))
    asked = b.posts.filter("not (status = 'F' and flag = 'R')").select("id", "topic_id")
    bounded = ranges.asof_by_blocks(asked, known).filter("low is not null").withColumnRenamed("id", "old_id")
    found = bounded.join(b.posts.select(F.col("id").alias("post_id"), "topic_id", "posted_at"), "topic_id").filter(F.col("posted_at").between(F.col("low"), F.col("high")))
    return found.groupBy("old_id").agg(F.count("*").alias("n"), F.min("post_id").alias("post_id")).filter("n = 1").drop("n")


@query("l2_name_dimension", "users", "SELECT key, count(DISTINCT id) AS holders FROM (SELECT id, lower(name) AS key FROM users UNION ALL SELECT id, 'alias ' || (id % 50) FROM users WHERE id % 4 = 0) GROUP BY key")
def _(b: Board):
    from palaver.functions.text import name_key

    every = b.users.select("id", name_key(F.col("name")).alias("key")).unionByName(b.users.filter("id % 4 = 0").select("id", F.concat(F.lit("alias "), (F.col("id") % 50).cast("string")).alias("key")))
    return every.distinct().groupBy("key").agg(F.count("*").alias("holders"))


@query("l3_unique_names", "users", "SELECT key, min(id) AS id FROM (SELECT id, CASE WHEN id % 7 = 3 THEN 'lost' ELSE lower(name) END AS key FROM users) GROUP BY key HAVING count(*) = 1")
def _(b: Board):
    keyed = b.users.select("id", F.when(F.col("id") % 7 == 3, "lost").otherwise(F.lower("name")).alias("key"))
    return names.unique_names(keyed).select("key", "id")


@query("w8_anchor_gaps", "users", "SELECT id, lead(id) OVER (ORDER BY id) - id AS gap FROM users WHERE group_name = 'BUILDING'")
def _(b: Board):
    anchors = b.users.filter("group_name = 'BUILDING'").select("id")
    return ranges.following(anchors, "id", ["id"]).select("id", (F.col("next_id") - F.col("id")).alias("gap"))


@query("w13_latest_nonempty", "", "SELECT user_id, arg_max(props, event_id) FILTER (WHERE event_type <> 'error') AS props FROM events GROUP BY user_id")
def _(b: Board):
    kept = F.when(F.col("event_type") != "error", F.col("event_id"))
    return b.events.groupBy("user_id").agg(F.max_by("props", kept).alias("props"))


@query("w13_ordered_fold", "", "SELECT user_id, count(*)::BIGINT AS changes FROM (SELECT user_id FROM events QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type) GROUP BY user_id")
def _(b: Board):
    return history.collapse_runs(b.events.select("user_id", "event_type", "ts", "event_id"), ["user_id"], ["ts", "event_id"], "event_type").groupBy("user_id").agg(F.count("*").alias("changes"))


_FIXES = """
WITH h AS (SELECT regexp_matches(source, concat('\\[\\w+=[^\\]\\n]*', chr(39), '>\\]')) AS leak, contains(source, '[url=' || chr(39)) AS url, contains(source, '[img]' || chr(39)) AS img, contains(source, '[size=100]') OR contains(source, '[b]QUOTE[/b]') AS blocks FROM quoting)
SELECT 'attribute-leak' AS fix, count(*) AS posts FROM h WHERE leak UNION ALL SELECT 'quoted-url', count(*) FROM h WHERE url UNION ALL SELECT 'quoted-img', count(*) FROM h WHERE img UNION ALL SELECT 'blocks', count(*) FROM h WHERE blocks"""


@query("a18_fix_report", "quoting", _FIXES)
def _(b: Board):
    from palaver.functions.markup import fix

    fixed = fix(b.quoting.withColumnRenamed("post_id", "id"))
    return fixed.select(F.explode("applied").alias("fix")).groupBy("fix").agg(F.count("*").alias("posts"))


@query("a29_survey", "topics", "SELECT forum_id, count(*) AS topics, CAST(sum(post_count) AS BIGINT) AS posts FROM topics GROUP BY forum_id")
def _(b: Board):
    return b.topics.groupBy("forum_id").agg(F.count("*").alias("topics"), F.sum("post_count").alias("posts"))


@query("m8_added_forums", "second_topics", "SELECT id % 25 + 1 AS forum_id, count(*) AS topics, max(started_at) AS last FROM second_topics GROUP BY 1")
def _(b: Board):
    return b.second_topics.groupBy((F.col("id") % 25 + 1).alias("forum_id")).agg(F.count("*").alias("topics"), F.max("started_at").alias("last"))


@query("m2_topic_posts", "topics posts", "SELECT t.id, count(p.id) AS n, coalesce(array_to_string(list(p.id ORDER BY p.posted_at, p.post_index, p.id) FILTER (WHERE p.id IS NOT NULL), ','), '') AS posts FROM topics t LEFT JOIN posts p ON p.topic_id = t.id GROUP BY t.id")
def _(b: Board):
    from palaver.operators.site import topic_posts

    grouped = topic_posts(b.topics.select("id"), b.posts)
    return grouped.select("id", F.size("posts").cast("long").alias("n"), F.array_join(F.transform("posts", lambda p: p["id"].cast("string")), ",").alias("posts"))


@query("z22_user_keys", "users", "SELECT id, CASE WHEN id % 3 = 0 THEN id WHEN id % 3 = 1 THEN -id ELSE 0 END AS key FROM users")
def _(b: Board):
    from palaver.operators.site import user_key

    k = F.col("id") % 3
    return b.users.select("id", user_key(F.when(k == 0, F.col("id")), F.when(k == 1, F.col("id"))).alias("key"))


@query("x27_partial_zones", "topics", "SELECT id, CAST(CASE WHEN has_poll IS NULL THEN 0 WHEN has_poll THEN 330 ELSE -300 END AS INT) AS tz FROM topics")
def _(b: Board):
    shift = F.when(F.col("has_poll").isNull(), 0).when(F.col("has_poll"), 330).otherwise(-300)
    shown = F.col("listed_at") + F.make_interval(mins=shift)
    when = F.struct(F.year(shown).alias("year"), F.lit(None).cast("int").alias("month"), F.day(shown).alias("day"), F.hour(shown).alias("hour"), F.minute(shown).alias("minute"))
    return b.topics.select("id", dates.partial_offset(when, F.col("listed_at")).cast("int").alias("tz"))
