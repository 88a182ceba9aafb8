"""Queries of the linkage stages: trigram join, zones, habits, decisions, members, archive."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver.functions import markup, text
from palaver.operators import brackets, chains, members, names, quotes
from palaver.plans.registry import Board, query

_W = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+')"


def _tri(name: str, key: str, source: str, column: str) -> str:
    w = _W.format(column)
    return f"""{name}w AS (SELECT {key} AS k, {w} AS w FROM {source}), {name} AS (SELECT DISTINCT k, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM {name}w))"""


_HITS = f"""{_tri('qa', 'item_id', 'benchmark', 'text')}, {_tri('pa', 'doc_id', 'documents', "regexp_replace(regexp_replace(text, '(?i)\\[/?[a-z*][^\\]\\n]*\\]|<[^>\\n]*>', ' ', 'g'), '&(lt|gt|quot|#39|nbsp|amp);', ' ', 'g')")},
qn AS (SELECT k, s, row_number() OVER (PARTITION BY k ORDER BY md5(s)) - 1 AS r, count(*) OVER (PARTITION BY k) AS n FROM qa),
q AS (SELECT k, s FROM qn WHERE n <= 60 OR r IN (SELECT CAST(floor(i * qn.n / 60) AS BIGINT) FROM range(60) t(i))),
pf AS (SELECT k, s FROM pa WHERE s IN (SELECT s FROM q)), p AS (SELECT * FROM pf WHERE s IN (SELECT s FROM pf GROUP BY s HAVING count(*) <= 2000)),
u AS (SELECT k, count(*) AS usable FROM q WHERE s IN (SELECT s FROM p) GROUP BY k),
h AS (SELECT q.k AS quote_id, p.k AS post_id, count(*) AS hits FROM q JOIN p USING (s) GROUP BY ALL)"""


def benchmark_hits(b: Board):
    asked = b.benchmark.select(F.col("item_id").alias("quote_id"), F.col("text").alias("body"))
    wanted = quotes.wanted_trigrams(asked)
    return quotes.text_hits(wanted, quotes.postings(b.documents.select(F.col("doc_id").alias("id"), "text"), wanted, F.col("text")))


@query("j21_trigram_join", "", f"WITH {_HITS} SELECT quote_id, post_id, hits, usable, CASE WHEN usable >= 3 THEN round(hits / usable, 6) END AS similarity FROM h JOIN u ON u.k = h.quote_id")
def _(b: Board):
    return benchmark_hits(b).select("quote_id", "post_id", "hits", "usable", F.round("similarity", 6).alias("similarity"))


@query("w9_top_text_candidates", "", f"WITH {_HITS} SELECT quote_id, post_id, hits FROM h QUALIFY row_number() OVER (PARTITION BY quote_id ORDER BY hits DESC, post_id) <= 20")
def _(b: Board):
    return quotes.top_hits(benchmark_hits(b)).select("quote_id", "post_id", "hits")


_EV = """ev AS (SELECT p.id AS quote_id, q.id AS post_id, p.user_id % 20 AS viewer, q.posted_at, CAST(q.id % 3 AS INT) AS author,
 CASE WHEN q.id % 4 = 0 THEN NULL ELSE CAST((q.user_id % 3 - 1) * 60 AS BIGINT) END AS off, CASE WHEN q.id % 5 = 0 THEN NULL ELSE (q.part_id % 100) / 100.0::DOUBLE END AS similarity,
 q.part_id % 2 = 0 AS same_topic, p.id % 2 = 0 AS named, p.id % 3 <> 0 AS dated_quote FROM posts p JOIN posts q ON q.topic_id = p.topic_id AND q.id <> p.id WHERE p.post_index = 2),
les AS (SELECT quote_id, viewer, min(off) AS off FROM ev WHERE author = 2 AND off IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 1),
sn AS (SELECT viewer, off, count(*) AS n, sum(count(*)) OVER (PARTITION BY viewer) AS total FROM les GROUP BY viewer, off),
us AS (SELECT viewer, off FROM sn WHERE n >= 2 AND n >= total / 5)"""


def synthetic_evidence(b: Board):
    p = b.posts.filter("post_index = 2").select(F.col("id").alias("quote_id"), "topic_id", (F.col("user_id") % 20).alias("viewer"), (F.col("id") % 2 == 0).alias("named"), (F.col("id") % 3 != 0).alias("dated_quote"))
    q = b.posts.select(F.col("id").alias("post_id"), "topic_id", "posted_at", (F.col("id") % 3).cast("int").alias("author"),
                       F.when(F.col("id") % 4 != 0, (F.col("user_id") % 3 - 1) * 60).alias("offset"), F.when(F.col("id") % 5 != 0, F.col("part_id") % 100 / 100.0).alias("similarity"), (F.col("part_id") % 2 == 0).alias("same_topic"))
    return p.join(q, "topic_id").filter("post_id <> quote_id").withColumn("exact_quote", F.col("dated_quote"))


@query("a27_viewer_habits", "posts", f"WITH {_EV} SELECT viewer, off AS \"offset\" FROM us")
def _(b: Board):
    return quotes.habits(synthetic_evidence(b))


@query("w11_decide_quotes", "posts", f"""WITH {_EV}, e AS (SELECT ev.*, (off IS NOT NULL AND CASE WHEN ev.viewer IN (SELECT viewer FROM us) THEN EXISTS (SELECT 1 FROM us WHERE us.viewer = ev.viewer AND us.off = ev.off) ELSE off = 0 END) AS habit FROM ev),
d AS (SELECT *, coalesce(similarity, 0) AS txt, off IS NOT NULL AND NOT (similarity IS NOT NULL AND similarity < 0.2 AND NOT (habit AND same_topic)) AS dated FROM e),
t AS (SELECT *, CASE WHEN dated AND author = 2 THEN 0 WHEN dated AND txt >= 0.5 THEN 1 WHEN author > 0 AND txt >= 0.5 THEN 2 WHEN dated AND author = 1 AND (similarity IS NULL OR similarity >= 0.3) THEN 3
 WHEN txt >= 0.8 AND same_topic THEN 4 WHEN dated AND dated_quote AND same_topic AND NOT named AND similarity IS NULL THEN 5 WHEN author = 2 AND similarity IS NULL AND same_topic AND NOT dated_quote THEN 6 END AS tier FROM d),
r AS (SELECT *, struct_pack(a := -tier, b := habit, c := round_even(txt, 2), d := author, e := same_topic) AS rk FROM t WHERE tier IS NOT NULL),
w AS (SELECT *, row_number() OVER o AS place, lead(rk) OVER o AS nrk, lead(tier) OVER o AS nt FROM r WINDOW o AS (PARTITION BY quote_id ORDER BY rk DESC, posted_at DESC, post_id DESC)),
z AS (SELECT *, coalesce(nrk = rk AND tier NOT IN (4, 6), FALSE) OR coalesce(tier = 5 AND nt = 5, FALSE) AS amb FROM w WHERE place = 1)
SELECT quote_id, CASE WHEN NOT amb THEN post_id END AS post_id, CASE WHEN amb THEN 'ambiguous' ELSE ['author+date', 'date+text', 'author+text', 'near-author+date', 'text', 'date', 'author'][tier + 1] END AS match,
 CASE WHEN NOT amb THEN CAST(round_even(100 * least(similarity, 1), 0) AS BIGINT) END AS similarity, CASE WHEN NOT amb THEN off END AS "offset" FROM z""")
def _(b: Board):
    e = synthetic_evidence(b)
    return quotes.decide(e, quotes.habits(e))


@query("j20_zone_candidates", "posts topics", """
WITH q AS (SELECT id, date_trunc('minute', listed_at) + INTERVAL (id % 5 * 60 - 120) MINUTE AS at FROM topics),
p AS (SELECT t.id AS topic_id, t.id * 10 + k.k AS post_id, date_trunc('minute', t.listed_at) + INTERVAL (k.k * 37) MINUTE AS posted_at FROM topics t, range(6) k(k)),
o AS (SELECT q.id AS quote_id, p.post_id, date_diff('minute', p.posted_at, q.at) AS diff FROM q JOIN p ON p.topic_id = q.id),
f AS (SELECT *, CAST(floor((diff + 7) / 15.0) * 15 AS BIGINT) AS off FROM o)
SELECT quote_id, post_id, off AS "offset" FROM f WHERE abs(diff - off) <= 1 AND off BETWEEN -720 AND 840 AND (off % 30 = 0 OR off IN (345, 525, 765))""")
def _(b: Board):
    minute = F.date_trunc("minute", "listed_at")
    asked = b.topics.select(F.col("id").alias("quote_id"), F.col("id").alias("topic_id"), (minute + F.make_interval(mins=(F.col("id") % 5 * 60 - 120).cast("int"))).cast("timestamp_ntz").alias("quoted_at"))
    ks = F.explode(F.array(*map(F.lit, range(6))))
    posted = b.topics.select(F.col("id").alias("topic_id"), "listed_at", ks.alias("k")).select("topic_id", (F.col("topic_id") * 10 + F.col("k")).alias("id"), (minute + F.make_interval(mins=F.col("k") * 37)).cast("timestamp_ntz").alias("posted_at"))
    return quotes.zone_candidates(asked, posted)


@query("l1_parsed_quotes", "quoting", """
SELECT post_id, 0 AS position, 1 AS level, CAST(NULL AS INT) AS parent, author, CAST(quoted_at AS STRING) AS date, (length(body) + CASE WHEN nested THEN 1 ELSE 0 END)::INT AS n FROM quoting
UNION ALL SELECT post_id, 1, 2, 0, 'Al', NULL, 4 FROM quoting WHERE nested
UNION ALL SELECT post_id, CASE WHEN nested THEN 2 ELSE 1 END, 1, NULL, 'Bo', 'Nov 4 2005', 0 FROM quoting WHERE contains(source, '[quote=Bo')""")
def _(b: Board):
    found = brackets.quotes_of(b.quoting.withColumnRenamed("post_id", "id"))
    return found.select("post_id", "position", "level", "parent", "author", "date", F.char_length("body").alias("n"))


@query("l1_linked_quotes")
def _(b: Board):
    """Quotes of the quoting posts, linked to the documents they quote; both lie in the same topics."""
    clock = F.timestamp_seconds(F.col("doc_id") * 3600 + 600_000_000).cast("timestamp_ntz")
    texts = b.documents.select(F.col("doc_id").alias("id"), (F.col("n_chars") % 100).cast("long").alias("topic_id"), F.col("doc_id").alias("user_id"), clock.alias("posted_at"), "text")
    later = b.quoting.select((-F.col("post_id")).alias("id"), "topic_id", F.col("post_id").alias("user_id"), F.lit("2020-01-01").cast("timestamp_ntz").alias("posted_at"), "source")
    posts = texts.unionByName(later.withColumn("text", markup.own_text("source")).drop("source"))
    known = b.users.select(F.col("id").alias("user_id"), F.substring(F.md5("name"), 1, 10).alias("key"))
    return quotes.link_quotes(brackets.quotes_of(later), posts, known)


def _chain(pairs: str) -> str:
    """The chain by patience sorting, one pair after another, of CTE ``pairs`` (a, b)."""
    return f"""num AS (SELECT a, b, row_number() OVER (ORDER BY a, b DESC) AS n FROM (SELECT DISTINCT a, b FROM {pairs})),
piles AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS tops, 0::BIGINT AS length UNION ALL
  SELECT n, list_concat(tops[:k], [b], tops[k + 2:]), k + 1 FROM (SELECT num.n, num.b, tops, len(list_filter(tops, lambda t: t < num.b)) AS k FROM piles JOIN num ON num.n = piles.n + 1)),
placed AS (SELECT num.*, length FROM num JOIN piles USING (n)),
back AS (SELECT max(n) + 1 AS n, max(length) AS wanted, NULL::BIGINT AS a, NULL::BIGINT AS b FROM placed UNION ALL
  SELECT p.n, wanted - CASE WHEN p.length = wanted THEN 1 ELSE 0 END, CASE WHEN p.length = wanted THEN p.a END, CASE WHEN p.length = wanted THEN p.b END FROM back JOIN placed p ON p.n = back.n - 1),
chain AS (SELECT a, b FROM back WHERE a IS NOT NULL)"""


@query("w7_anchor_chain", "users", f"WITH RECURSIVE pairs AS (SELECT id AS a, id * 7919 % 1009 + id // 3 AS b FROM users), {_chain('pairs')} SELECT a, b FROM chain")
def _(b: Board):
    """The longest rising chain of a disorderly sequence with equal values."""
    return chains.longest_chain(b.users.select(F.col("id").alias("a"), (F.col("id") * 7919 % 1009 + F.floor(F.col("id") / 3)).alias("b")))


@query("l3_link_members", "users", f"""
WITH RECURSIVE old AS (SELECT id, CASE WHEN group_name = 'FURNITURE' THEN 'lost' ELSE lower(name) END AS key, row_number() OVER (ORDER BY id) AS pos FROM users),
nid AS (SELECT CASE WHEN md5(name) < '2' THEN id * 2 + 601 ELSE id * 2 + 100 END AS id, lower(name) AS key FROM users WHERE group_name <> 'MACHINERY'),
new AS (SELECT *, row_number() OVER (ORDER BY id) AS pos FROM nid),
uo AS (SELECT key, any_value(pos) AS pos, any_value(id) AS id FROM old GROUP BY key HAVING count(*) = 1), un AS (SELECT key, any_value(pos) AS pos, any_value(id) AS id FROM new GROUP BY key HAVING count(*) = 1),
both_ AS (SELECT uo.pos AS a, un.pos AS b, uo.id AS old_id, un.id AS new_id FROM uo JOIN un USING (key)), {_chain('both_')},
gaps AS (SELECT a, b, lead(a) OVER (ORDER BY a) AS na, lead(b) OVER (ORDER BY a) AS nb FROM chain),
found AS (SELECT old_id, new_id, 'name' AS match FROM chain JOIN both_ USING (a, b)
  UNION ALL SELECT o.id, n.id, 'position' FROM gaps g JOIN old o ON o.pos > g.a AND o.pos < g.na JOIN new n ON n.pos - g.b = o.pos - g.a WHERE g.na - g.a = g.nb - g.b)
SELECT * FROM found UNION ALL SELECT old_id, new_id, 'only-name' FROM both_ WHERE old_id NOT IN (SELECT old_id FROM found) AND new_id NOT IN (SELECT new_id FROM found)""")
def _(b: Board):
    """Members of one group have lost their names, those of another never came over, and some came late."""
    old = b.users.select("id", F.when(F.col("group_name") == "FURNITURE", "lost").otherwise(F.lower("name")).alias("key"))
    late = F.md5("name") < "2"
    new = b.users.filter("group_name <> 'MACHINERY'").select((F.col("id") * 2 + F.when(late, 601).otherwise(100)).alias("id"), F.lower("name").alias("key"))
    return members.link_members(old, new)


_KNOWN = "substr(md5(name), 1, 14)"
_ASKED = """CASE WHEN md5(name) < '4' THEN concat(substr(md5(name), 1, 4), substr(md5(name), 6, 9)) WHEN md5(name) < '8' THEN concat(substr(md5(name), 1, 6), 'zzz', substr(md5(name), 7, 8))
 WHEN md5(name) < 'a' THEN concat('x', substr(md5(name), 2, 6), 'y', substr(md5(name), 9, 6)) WHEN md5(name) < 'd' THEN concat(substr(md5(name), 8, 7), substr(md5(name), 1, 7)) ELSE substr(md5(name), 1, 14) END"""


@query("x2_name_ratio", "users", f"""
WITH RECURSIVE k AS (SELECT DISTINCT {_KNOWN} AS b FROM users), q AS (SELECT DISTINCT {_ASKED} AS a FROM users),
p AS (SELECT a, b FROM q, k WHERE a <> b AND levenshtein(a, b) <= 0.15 * (length(a) + length(b))),
grid AS (SELECT a, b, i, j, len(list_filter(range(1, least(length(a) - i, length(b) - j) + 2), lambda n: substr(a, i, n) = substr(b, j, n))) AS n
  FROM (SELECT a, b, i, unnest(range(1, length(b) + 1)) AS j FROM (SELECT a, b, unnest(range(1, length(a) + 1)) AS i FROM p)) WHERE substr(a, i, 1) = substr(b, j, 1)),
seg AS (SELECT a, b, 1::BIGINT AS al, length(a) + 1 AS ah, 1::BIGINT AS bl, length(b) + 1 AS bh, 0::BIGINT AS got FROM p
  UNION ALL
  SELECT a, b, CASE WHEN side = 0 THEN al ELSE m.i + m.n END, CASE WHEN side = 0 THEN m.i ELSE ah END, CASE WHEN side = 0 THEN bl ELSE m.j + m.n END, CASE WHEN side = 0 THEN m.j ELSE bh END, CASE WHEN side = 0 THEN m.n ELSE 0 END
  FROM (SELECT *, struct_pack(n := best.n, i := -best.ni, j := -best.nj) AS m FROM (SELECT a, b, al, ah, bl, bh, max(struct_pack(n := least(n, ah - i, bh - j), ni := -i, nj := -j)) AS best
        FROM seg JOIN grid USING (a, b) WHERE i >= al AND i < ah AND j >= bl AND j < bh GROUP BY a, b, al, ah, bl, bh)) s, (VALUES (0), (1)) sides(side))
SELECT a, b, 2.0::DOUBLE * sum(got) / (length(a) + length(b)) AS ratio FROM seg GROUP BY a, b HAVING 2.0::DOUBLE * sum(got) / (length(a) + length(b)) >= 0.85""")
def _(b: Board):
    """Names that are alike though letters are lost, doubled, changed or moved, among all names."""
    asked, known = b.users.select(F.expr(_ASKED).alias("__a")).distinct(), b.users.select(F.expr(_KNOWN).alias("__b")).distinct()
    return names.alike(asked, known, 0.85).select(F.col("__a").alias("a"), F.col("__b").alias("b"), text.ratio("__a", "__b").alias("ratio"))


@query("l7_link_archive", "posts", """
WITH p AS (SELECT topic_id, id, CAST(posted_at AS DATE) AS day, user_id, row_number() OVER (PARTITION BY topic_id, CAST(posted_at AS DATE), user_id ORDER BY id) AS k FROM posts),
a AS (SELECT topic_id, post_index AS position, CAST(posted_at AS DATE) AS day, user_id, row_number() OVER (PARTITION BY topic_id, CAST(posted_at AS DATE), user_id ORDER BY post_index) AS k FROM posts WHERE flag <> 'A')
SELECT a.topic_id, a.position, p.id AS post_id FROM a JOIN p USING (topic_id, day, user_id, k)""")
def _(b: Board):
    day = F.to_date("posted_at")
    posts = b.posts.select("topic_id", "id", day.alias("day"), F.col("user_id").cast("string").alias("author"))
    archive = b.posts.filter("flag <> 'A'").select("topic_id", F.col("post_index").alias("position"), day.alias("day"), F.col("user_id").cast("string").alias("author"))
    return members.link_archive(archive, posts)


_L4 = """second AS (SELECT row_number() OVER (ORDER BY posted_at, id) AS id, topic_id, posted_at, user_id FROM posts WHERE flag <> 'A'),
o AS (SELECT CAST(id AS BIGINT) AS old_id, topic_id, date_trunc('minute', posted_at) AS m, user_id AS author FROM second), n AS (SELECT id AS new_id, topic_id, date_trunc('minute', posted_at) AS m, user_id AS author FROM posts),
o1 AS (SELECT *, row_number() OVER (PARTITION BY topic_id, m ORDER BY old_id) AS k, count(*) OVER (PARTITION BY topic_id, m) AS c FROM o), n1 AS (SELECT *, row_number() OVER (PARTITION BY topic_id, m ORDER BY new_id) AS k, count(*) OVER (PARTITION BY topic_id, m) AS c FROM n),
p1 AS (SELECT old_id, new_id, 'time' AS match FROM o1 JOIN n1 USING (topic_id, m, k, c) WHERE c = 1),
o2 AS (SELECT *, row_number() OVER (PARTITION BY topic_id, m, author ORDER BY old_id) AS k, count(*) OVER (PARTITION BY topic_id, m, author) AS c FROM o WHERE old_id NOT IN (SELECT old_id FROM p1)),
n2 AS (SELECT *, row_number() OVER (PARTITION BY topic_id, m, author ORDER BY new_id) AS k, count(*) OVER (PARTITION BY topic_id, m, author) AS c FROM n WHERE new_id NOT IN (SELECT new_id FROM p1)),
p2 AS (SELECT old_id, new_id, 'time+author' AS match FROM o2 JOIN n2 USING (topic_id, m, author, k, c)),
o3 AS (SELECT *, row_number() OVER (PARTITION BY topic_id, m ORDER BY old_id) AS k, count(*) OVER (PARTITION BY topic_id, m) AS c FROM o WHERE old_id NOT IN (SELECT old_id FROM p1 UNION ALL SELECT old_id FROM p2)),
n3 AS (SELECT *, row_number() OVER (PARTITION BY topic_id, m ORDER BY new_id) AS k, count(*) OVER (PARTITION BY topic_id, m) AS c FROM n WHERE new_id NOT IN (SELECT new_id FROM p1 UNION ALL SELECT new_id FROM p2)),
p3 AS (SELECT old_id, new_id, 'time+order' AS match FROM o3 JOIN n3 USING (topic_id, m, k, c))"""


@query("l4_link_posts", "posts", f"WITH {_L4} SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3")
def _(b: Board):
    from palaver.plans.relational import second_posts

    old = second_posts(b).select("id", "topic_id", "posted_at", F.col("user_id").alias("author"))
    return members.link_posts(old, b.posts.select("id", "topic_id", "posted_at", F.col("user_id").alias("author")))


@query("t10_fix_posts")
def _(b: Board):
    posts = b.quoting.withColumnRenamed("post_id", "id")
    return markup.fix(posts).select("id", "fixed", "applied")


@query("t13_html_to_markup")
def _(b: Board):
    return b.pages.select("page_id", markup.to_markup(F.col("html")).alias("source"))


@query("t17_render")
def _(b: Board):
    return b.quoting.select("post_id", markup.to_html(F.col("source")).alias("html"))
