"""Queries of the function library: names, words, dates, URLs, files, JSON, HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver.functions import dates, files, scan, text, urls
from palaver.operators import ranges
from palaver.plans.registry import Board, query


@query("x1_name_key", "", "SELECT conv_id, turn, lower(trim(regexp_replace(replace(replace(replace(replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g'))) AS key FROM conversations")
def _(b: Board):
    return b.conversations.select("conv_id", "turn", text.name_key(F.col("text")).alias("key"))


@query("x3_clean_author", "users", "SELECT id, name AS author FROM users")
def _(b: Board):
    decorated = F.concat("name", F.element_at(F.array(F.lit(" wrote"), F.lit("  posted on"), F.lit(" @"), F.lit(", ("), F.lit("")), (F.col("id") % 5 + 1).cast("int")))
    return b.users.select("id", text.clean_author(decorated).alias("author"))


_WORDS = r"regexp_extract_all(lower(body), '[\p{L}\p{N}_]+')"


@query("x5_words", "quoting", rf"SELECT post_id, len({_WORDS})::INT AS n_words, len(list_distinct({_WORDS}))::INT AS n_distinct FROM quoting")
def _(b: Board):
    w = text.words(F.col("body"))
    return b.quoting.select("post_id", F.size(w).alias("n_words"), F.size(F.array_distinct(w)).alias("n_distinct"))


@query("x6_shingles", "quoting", rf"""
WITH w AS (SELECT post_id, {_WORDS} AS w FROM quoting), s AS (SELECT DISTINCT post_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT post_id, w, unnest(range(1, len(w) - 1)) AS i FROM w))
SELECT w.post_id, count(s.s) AS n FROM w LEFT JOIN s USING (post_id) GROUP BY w.post_id""")
def _(b: Board):
    return b.quoting.select("post_id", F.size(text.shingles(text.words(F.col("body")))).cast("long").alias("n"))


@query("x7_snippet", "", """
WITH p AS (SELECT doc_id, text, strpos(text, ' the ') AS pos FROM documents WHERE strpos(text, ' the ') > 0),
q AS (SELECT *, greatest(pos - 30, 1) AS l, least(pos + 34, length(text)) AS r FROM p)
SELECT doc_id, CASE WHEN l > 1 THEN '…' ELSE '' END || replace(substr(text, l, r - l + 1), chr(10), '⏎') || CASE WHEN r < length(text) THEN '…' ELSE '' END AS snippet FROM q""")
def _(b: Board):
    at = F.instr("text", " the ")
    return b.documents.filter(at > 0).select("doc_id", text.snippet(F.col("text"), at, F.lit(5)).alias("snippet"))


_UN = "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"


@query("x8_plain_text", "", f"""SELECT page_id, nullif(trim(replace({_UN.format("regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', '', 'g'), '<[^>]*>', '', 'g')")}, chr(160), ' ')), '') AS body FROM pages""")
def _(b: Board):
    return b.pages.select("page_id", text.plain_text(F.col("html")).alias("body"))


@query("x9_escape", "", "SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped FROM pages")
def _(b: Board):
    return b.pages.select("page_id", text.escape(F.col("html")).alias("escaped"))


@query("x10_number", "topics", "SELECT id, view_count AS n FROM topics")
def _(b: Board):
    return b.topics.select("id", text.number(F.concat(F.lit("seen "), F.format_number("view_count", 0), F.lit(" times, 3 today"))).alias("n"))


@query("x15_filled", "files", "SELECT count(*) FILTER (WHERE data IS NOT NULL AND trim(data) <> '') AS n FROM files")
def _(b: Board):
    return b.files.agg(F.count_if(text.filled(F.col("data"))).alias("n"))


@query("x20_unix_times", "", "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) END AS at FROM events")
def _(b: Board):
    seconds = F.when(F.col("event_id") % 7 != 0, F.unix_timestamp(F.col("ts").cast("timestamp"))).otherwise(0)
    return b.events.select("event_id", dates.from_unix(seconds.cast("string")).alias("at"))


@query("x21_parse_dates", "", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderdate END AS at FROM orders")
def _(b: Board):
    shown = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "MMM d yyyy, hh:mm a")).when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "dd MMMM yyyy - hh:mm a")).when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("Today, 10:02 PM"))
    return b.orders.select("o_orderkey", dates.first_format(shown, "MMM d yyyy, hh:mm a", "dd MMMM yyyy - hh:mm a", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("x22_quote_dates", "", """SELECT o_orderkey, year(o_orderdate)::INT AS year, CASE WHEN o_orderkey % 3 <> 2 THEN month(o_orderdate)::INT END AS month, day(o_orderdate)::INT AS day,
 CASE WHEN o_orderkey % 3 <> 1 THEN hour(o_orderdate)::INT END AS hour, CASE WHEN o_orderkey % 3 <> 1 THEN minute(o_orderdate)::INT END AS minute FROM orders""")
def _(b: Board):
    t = F.col("o_orderdate")
    shown = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Bob @ "), F.date_format(t, "MMM d yyyy, hh:mm a"))).when(F.col("o_orderkey") % 3 == 1, F.date_format(t, "MMMM d, yyyy")).otherwise(F.concat(F.lit("name @  "), F.date_format(t, "d, yyyy hh:mm a")))
    when = b.orders.select("o_orderkey", dates.quote_date(shown).alias("w"))
    return when.select("o_orderkey", "w.year", "w.month", "w.day", "w.hour", "w.minute")


@query("x24_tz_offset", "posts topics", """
WITH d AS (SELECT t.id, CAST(date_diff('minute', TIMESTAMP '1970-01-01', t.listed_at + INTERVAL (t.id % 97 * 15 - 700 + t.id % 3) MINUTE) - date_diff('minute', TIMESTAMP '1970-01-01', t.listed_at) AS BIGINT) AS diff FROM topics t),
o AS (SELECT id, diff, CAST(floor((diff + 7) / 15.0) * 15 AS BIGINT) AS off FROM d)
SELECT id, CASE WHEN abs(diff - off) <= 1 AND off BETWEEN -720 AND 840 AND (off % 30 = 0 OR off IN (345, 525, 765)) THEN off END AS tz FROM o""")
def _(b: Board):
    quoted = F.col("listed_at") + F.make_interval(mins=(F.col("id") % 97 * 15 - 700 + F.col("id") % 3).cast("int"))
    return b.topics.select("id", dates.exact_offset(quoted, F.col("listed_at")).alias("tz"))


@query("x25_truncations", "posts", "SELECT id, year(posted_at)::INT AS y, date_trunc('minute', posted_at) AS m, strftime(posted_at, '%Y-%m-%d') AS d FROM posts")
def _(b: Board):
    return b.posts.select("id", F.year("posted_at").alias("y"), F.date_trunc("minute", "posted_at").cast("timestamp_ntz").alias("m"), F.date_format("posted_at", "yyyy-MM-dd").alias("d"))


@query("x26_capture_time", "", "SELECT event_id, date_trunc('second', ts) AS at, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def _(b: Board):
    return b.events.select("event_id", dates.capture_time(F.date_format("ts", "yyyyMMddHHmmss")).alias("at"), dates.iso(F.col("ts")).alias("iso"))


@query("x31_image_url", "", r"""
WITH u AS (SELECT page_id, regexp_replace(trim(trim(CASE page_id % 4 WHEN 0 THEN '''' || url || '''' WHEN 1 THEN url || '#top' WHEN 2 THEN 'www.' || regexp_replace(url, '^https?://', '') ELSE 'ftp:' || url END), '''"'), '#.*$', '') AS u FROM pages)
SELECT page_id, CASE WHEN regexp_matches(w, '(?i)^https?://[^/\s]+') THEN w END AS image FROM (SELECT page_id, CASE WHEN u ILIKE 'www.%' THEN 'http://' || u ELSE u END AS w FROM u)""")
def _(b: Board):
    k = F.col("page_id") % 4
    seen = F.when(k == 0, F.concat(F.lit("'"), "url", F.lit("'"))).when(k == 1, F.concat("url", F.lit("#top"))).when(k == 2, F.concat(F.lit("www."), F.regexp_replace("url", "^https?://", ""))).otherwise(F.concat(F.lit("ftp:"), "url"))
    return b.pages.select("page_id", urls.image_url(seen).alias("image"))


@query("x34_url_parts", "", r"""
WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://([^/:?#]+)', 1)) AS host FROM pages)
SELECT page_id, host, regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS site, lower(regexp_extract(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://[^/?#]+(/[^?#]*)', 1), '([^/]*)$', 1)) AS file,
 nullif(regexp_extract(url, '(?i)^([a-z][a-z0-9+.-]*://[^/?#]+/[^?#]*/)[^/?#]*', 1), '') AS folder FROM p""")
def _(b: Board):
    u = F.col("url")
    return b.pages.select("page_id", urls.host_of(u).alias("host"), urls.site_of(u).alias("site"), urls.file_name(u).alias("file"), urls.folder_of(u).alias("folder"))


@query("x33_capture_key", "", r"SELECT page_id, regexp_replace(lower(url), '^https?://(www\.)?', '') AS key FROM pages")
def _(b: Board):
    odd = F.when(F.col("page_id") % 2 == 0, F.upper("url")).otherwise(F.regexp_replace("url", "^(https?://[^/]+)", "$1:80"))
    return b.pages.select("page_id", urls.capture_key(odd).alias("key"))


@query("x35_query_map", "topics", "SELECT id, CAST(id AS STRING) AS topic, CAST(id % 40 AS STRING) AS st, 'topic' AS kind FROM topics")
def _(b: Board):
    link = F.concat(F.lit("http://board.example/index.php?ShowTopic=0&amp;st="), (F.col("id") % 40).cast("string"), F.lit("&amp;showtopic="), F.col("id").cast("string"))
    q = urls.query_map(link)
    return b.topics.select("id", q["showtopic"].alias("topic"), q["st"].alias("st"), urls.page_kind(q).alias("kind"))


@query("x36_query_hash", "topics", "SELECT id, substr(sha256('showtopic=' || id), 1, 12) AS hash FROM topics")
def _(b: Board):
    return b.topics.select("id", urls.query_hash(F.concat(F.lit("showtopic="), F.col("id").cast("string"))).alias("hash"))


@query("x40_archive_position", "topics", "SELECT id, id AS topic, id % 9 * 50 AS start FROM topics")
def _(b: Board):
    name = F.concat(F.lit("t"), F.col("id").cast("string"), F.when(F.col("id") % 9 == 0, "").otherwise(F.concat(F.lit("-"), (F.col("id") % 9 * 50).cast("string"))), F.lit(".html"))
    at = urls.archive_position(name)
    return b.topics.select("id", at["topic"].alias("topic"), at["offset"].alias("start"))


@query("f17_file_kinds", "", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'png' WHEN 1 THEN 'gif' WHEN 2 THEN 'jpeg' WHEN 3 THEN 'pdf' END AS kind, o_orderkey % 5 < 3 AS image, o_orderkey % 5 < 3 AND o_orderkey % 2 = 0 AS whole FROM orders")
def _(b: Board):
    k = F.col("o_orderkey") % 5
    head = F.when(k == 0, "89504E470D0A1A0A").when(k == 1, "474946383961").when(k == 2, "FFD8FFE0").when(k == 3, "255044462D").otherwise("3C68746D6C")
    end = F.when(k == 0, "49454E44AE426082").when(k == 1, "3B").when(k == 2, "FFD9").otherwise("")
    data = F.unhex(F.concat(head, F.lit("00112200"), F.when(F.col("o_orderkey") % 2 == 0, end).otherwise("")))
    return b.orders.select("o_orderkey", files.kind_of(data).alias("kind"), files.is_image(data).alias("image"), files.whole_image(data).alias("whole"))


@query("s34_error_pages", "", "SELECT page_id, length(html) < 200 OR contains(html, 'mySQL error') OR contains(html, 'You are not logged in') OR contains(html, 'domain is parked') AS bad FROM pages")
def _(b: Board):
    return b.pages.select("page_id", files.error_page(F.col("html")).alias("bad"))


@query("s33_page_links", "", r"""
SELECT page_id, i::INT AS pos, hrefs[i] AS href FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?i)<a [^>]*href="([^"]*)"', 1) AS hrefs FROM pages))""")
def _(b: Board):
    found = F.regexp_extract_all("html", F.lit(r'(?i)<a [^>]*href="([^"]*)"'), F.lit(1))
    return b.pages.select("page_id", F.posexplode(found).alias("pos", "href")).withColumn("pos", F.col("pos") + 1)


# Scanning

_RULES = ", ".join(f"({i}, '{n}', '{p.replace(chr(39), chr(39) * 2)}')" for i, (n, p) in enumerate(scan.RULES))


@query("t1_scan_rules", "quoting", f"""
WITH r(ord, rule, p) AS (VALUES {_RULES}), h AS (SELECT r.ord, r.rule, q.post_id, len(regexp_extract_all(q.source, r.p)) AS n FROM quoting q, r)
SELECT ord, rule, count(*) FILTER (WHERE n > 0) AS posts, CAST(coalesce(sum(n), 0) AS BIGINT) AS matches FROM h GROUP BY ord, rule""")
def _(b: Board):
    return scan.rule_report(b.quoting.withColumnRenamed("post_id", "id")).select("ord", "rule", "posts", "matches")


_KNOWN = ", ".join(f"'{t}'" for t in scan.KNOWN)
_BR = r"brk AS (SELECT post_id, lower(ltrim(x, '/')) AS tag, CASE WHEN starts_with(x, '/') THEN -1 ELSE 1 END AS step FROM (SELECT post_id, unnest(regexp_extract_all(source, '(?i)\[(/?[a-z*][a-z0-9*]*)(?:=[^\]\n]*)?\]', 1)) AS x FROM quoting))"


@query("t2_tag_balance", "quoting", f"""
WITH {_BR}, d AS (SELECT post_id, tag, sum(step) AS diff FROM brk WHERE tag IN ({_KNOWN}) AND tag NOT IN ('*', 'hr') GROUP BY 1, 2 HAVING sum(step) <> 0)
SELECT '[' || tag || '] ' || CASE WHEN diff > 0 THEN 'unclosed' ELSE 'extra close' END AS kind, count(*) AS posts, CAST(sum(abs(diff)) AS BIGINT) AS surplus FROM d GROUP BY 1""")
def _(b: Board):
    return scan.unbalanced(b.quoting.withColumnRenamed("post_id", "id"))


@query("t3_unknown_tags", "quoting", f"WITH {_BR} SELECT tag, count(DISTINCT post_id) AS posts, min(post_id) AS example FROM brk WHERE tag NOT IN ({_KNOWN}) GROUP BY tag")
def _(b: Board):
    return scan.unknown_tags(b.quoting.withColumnRenamed("post_id", "id"))


@query("f11_matching_posts", "quoting", "SELECT post_id AS id FROM quoting WHERE regexp_matches(source, '(?i)\\[size=100\\]')")
def _(b: Board):
    return scan.matching_posts(b.quoting.withColumnRenamed("post_id", "id"), "size-100")


@query("t19_restored_links", "topics", """
SELECT t.id, 'showtopic=' || t.id || '&st=' || (t.id % 3 * 25) AS query FROM topics t WHERE t.stickied""")
def _(b: Board):
    spelled = F.concat(F.lit("showtopic="), F.col("id").cast("string"), F.lit("&st="), F.col("st").cast("string"))
    candidates = b.topics.select("id", F.explode(F.array(F.lit(0), F.lit(25), F.lit(50))).alias("st")).select("id", spelled.alias("query"))
    asked = F.concat(F.lit("showtopic="), F.col("id").cast("string"), F.lit("&amp;st="), (F.col("id") % 3 * 25).cast("string"))
    pages = b.topics.filter("stickied").select("id", urls.query_hash(asked).alias("hash"))
    return urls.restored(pages, candidates, "id").select("id", "query")


@query("x80_minutes", "posts", "SELECT id, date_diff('minute', TIMESTAMP '1970-01-01', posted_at) AS m FROM posts")
def _(b: Board):
    return b.posts.select("id", ranges.minutes(F.col("posted_at")).alias("m"))
