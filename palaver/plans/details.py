"""Queries of smaller rules: addresses of attachments, captures' text, listings, member reports, quotes."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver.functions import attachments, markup, scan
from palaver.operators import history, sets
from palaver.plans.registry import Board, query
from palaver.plans.relational import six_sql
from palaver.plans.reports import measures, sql_rows, stacked
from palaver.sources import dumps

# Scalars


@query("x50_similarity", "", "SELECT doc_id, CAST(round_even(100 * least(n_chars / 3000.0::DOUBLE, 1), 0) AS BIGINT) AS pct FROM documents")
def _(b: Board):
    return b.documents.select("doc_id", markup.percent(F.col("n_chars") / 3000.0).alias("pct"))


@query("x61_captures", "", "SELECT page_id, i AS pos, '2009' || lpad(CAST(i AS STRING), 10, '0') AS at, url || '?' || i AS original, (length(html) + i)::BIGINT AS size FROM pages, range(1, 3) t(i) WHERE url IS NOT NULL AND html IS NOT NULL")
def _(b: Board):
    one = lambda i: F.format_string('{"timestamp":"2009%010d","original":"%s?%d","length":%d}', F.lit(i), "url", F.lit(i), F.char_length("html") + i)
    listed = b.pages.filter("url is not null and html is not null").withColumn("json", F.concat(F.lit("["), one(1), F.lit(","), one(2), F.lit("]")))
    found = listed.select("page_id", F.posexplode(dumps.captures_of(F.col("json"))).alias("p", "c"))
    return found.select("page_id", (F.col("p") + 1).cast("long").alias("pos"), F.col("c.timestamp").alias("at"), F.col("c.original").alias("original"), F.col("c.length").alias("size"))


@query("x62_sentinel_attrs", "topics", "SELECT id, id AS ref, id % 40 AS start, CASE WHEN stickied THEN view_count END AS old_post FROM topics")
def _(b: Board):
    tag = F.concat(F.lit("ts:topic="), F.col("id").cast("string"), F.lit(" start="), (F.col("id") % 40).cast("string"), F.when(F.col("stickied"), F.concat(F.lit(" old_post="), F.col("view_count").cast("string"))).otherwise(F.lit(" old_post=none")))
    read = markup.sentinel(tag)
    return b.topics.select("id", read["id"].alias("ref"), read["attributes"]["start"].alias("start"), read["attributes"]["old_post"].alias("old_post"))


@query("f14_filtered_captures", "", "SELECT o_orderkey, o_orderdate IS NOT NULL AND o_orderdate + INTERVAL 14 YEAR >= TIMESTAMP '2012-03-01' AS filtered FROM orders")
def _(b: Board):
    return b.orders.select("o_orderkey", dumps.filtered(F.col("o_orderdate") + F.expr("interval 14 years")).alias("filtered"))


@query("x32_attachment_addresses", "files", """
WITH r AS (SELECT id, CASE WHEN kind = 'file' THEN '/attach/ma/post-' || (id % 9) || '-' || (1100000000 + id) || '.png.' WHEN kind = 'image' THEN 'Metanet.2.forumer.com:80//uploads//metanet/my%20pic' || id || '.JPG' ELSE 'http://x.forumer.com/index.php?act=Attach&amp;type=' || CASE WHEN uses = 1 THEN 'msg' ELSE '' END || '&id=' || id || ')' END AS ref, kind, uses FROM files)
SELECT id, CASE WHEN kind = 'link' THEN 'attach-id' ELSE 'upload' END AS kind,
 CASE WHEN kind = 'file' THEN 'http://2.forumer.com/uploads/metanet/post-' || (id % 9) || '-' || (1100000000 + id) || '.png' WHEN kind = 'image' THEN 'http://metanet.2.forumer.com/uploads/metanet/my%20pic' || id || '.JPG'
  ELSE 'http://x.forumer.com/index.php?act=Attach&type=' || CASE WHEN uses = 1 THEN 'msg' ELSE 'post' END || '&id=' || id END AS url,
 CASE WHEN kind = 'file' THEN 'post-' || (id % 9) || '-' || (1100000000 + id) || '.png' WHEN kind = 'image' THEN 'my pic' || id || '.JPG' END AS name,
 CASE WHEN kind = 'file' THEN id % 9 END AS old_forum_id, CASE WHEN kind = 'file' THEN TIMESTAMP '1970-01-01' + to_seconds(1100000000 + id) END AS uploaded_at, CASE WHEN kind = 'link' THEN id END AS old_attach_id FROM r""")
def _(b: Board):
    i = F.col("id").cast("string")
    upload = F.concat(F.lit("/attach/ma/post-"), (F.col("id") % 9).cast("string"), F.lit("-"), (F.col("id") + 1_100_000_000).cast("string"), F.lit(".png."))
    hosted = F.concat(F.lit("Metanet.2.forumer.com:80//uploads//metanet/my%20pic"), i, F.lit(".JPG"))
    page = F.concat(F.lit("http://x.forumer.com/index.php?act=Attach&amp;type="), F.when(F.col("uses") == 1, "msg").otherwise(""), F.lit("&id="), i, F.lit(")"))
    ref = F.when(F.col("kind") == "file", upload).when(F.col("kind") == "image", hosted).otherwise(page)
    return b.files.select("id", attachments.canonical(ref).alias("a")).select("id", "a.*")


@query("x37_payload_digests", "", """
WITH h AS (SELECT part.p_partkey AS id, sha1(p_name) AS h FROM part), b AS (SELECT id, string_agg(CASE substr(h, i, 1) WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011' WHEN '4' THEN '0100' WHEN '5' THEN '0101' WHEN '6' THEN '0110' WHEN '7' THEN '0111'
 WHEN '8' THEN '1000' WHEN '9' THEN '1001' WHEN 'a' THEN '1010' WHEN 'b' THEN '1011' WHEN 'c' THEN '1100' WHEN 'd' THEN '1101' WHEN 'e' THEN '1110' ELSE '1111' END, '' ORDER BY i) AS bits FROM h, range(1, 41) t(i) GROUP BY id)
SELECT id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(bits, j * 5 + 1, 1) AS INT) + 8 * CAST(substr(bits, j * 5 + 2, 1) AS INT) + 4 * CAST(substr(bits, j * 5 + 3, 1) AS INT) + 2 * CAST(substr(bits, j * 5 + 4, 1) AS INT) + CAST(substr(bits, j * 5 + 5, 1) AS INT), 1), '' ORDER BY j) AS digest FROM b, range(32) t(j) GROUP BY id""")
def _(b: Board):
    return b.part.select(F.col("p_partkey").alias("id"), attachments.payload_digest(F.col("p_name").cast("binary")).alias("digest"))


@query("x38_address_helpers", "files", """
SELECT id, url AS original, coalesce(uses = 1, FALSE) AS shortened, host || '/' || id AS file_key, CASE kind WHEN 'file' THEN '.gif' WHEN 'image' THEN '.tar' ELSE '' END AS extension, 'smile ' || id AS name,
 CASE kind WHEN 'file' THEN 'yuku' WHEN 'image' THEN 'forumer' ELSE 'other' END AS host_kind FROM files""")
def _(b: Board):
    i = F.col("id").cast("string")
    kind = F.col("kind")
    proxied = F.when(kind == "file", F.concat(F.lit("http://img.example/imageproxy.php?url="), F.replace(F.replace("url", F.lit(":"), F.lit("%3A")), F.lit("#"), F.lit("%23")))).otherwise(F.col("url"))
    shown = F.when(F.col("uses") == 1, F.concat(F.substring("url", 1, 9), F.lit(" ... "), i)).otherwise(F.concat(F.lit("x ... "), i))
    spelled = F.concat(F.lit("HTTPS://"), F.upper("host"), F.lit(":80/"), i, F.lit("?x=1"))
    name = F.when(kind == "file", F.concat(F.lit("dir.x/A.GIF"))).when(kind == "image", "b.c.tar").otherwise(".hidden")
    smiley = attachments.smiley_of(F.concat(F.lit("http://"), F.when(kind == "file", "static.yuku.com").when(kind == "image", "2.forumer.com").otherwise("forumer.com.example"), F.lit("/a/smile%20"), i, F.lit(".gif?v=2")))
    return b.files.select(
        "id", attachments.unproxied(proxied).alias("original"), F.coalesce(attachments.is_shortened(shown, F.col("url")), F.lit(False)).alias("shortened"),
        attachments.file_key(spelled).alias("file_key"), attachments.extension(name).alias("extension"), smiley["name"].alias("name"), smiley["host"].alias("host_kind"),
    )


@query("z27_pages_to_read", "files", """
SELECT id, CASE kind WHEN 'file' THEN 'index__q' || id WHEN 'image' THEN 'a/t' || id || '-50.html' ELSE 'a/members/index.html' END AS path, CASE kind WHEN 'file' THEN 'topic' WHEN 'image' THEN 'archive-topic' ELSE 'archive-members' END AS page
FROM files WHERE kind <> 'link' OR uses = 1""")
def _(b: Board):
    from palaver.functions.urls import query_map

    i, kind = F.col("id").cast("string"), F.col("kind")
    name = F.when(kind == "file", F.concat(F.lit("index__q"), i)).when(kind == "image", F.concat(F.lit("a/t"), i, F.lit("-50.html"))).when(F.col("uses") == 1, "a/members").otherwise("style/x.css")
    page = dumps.page_of(name, query_map(F.concat(F.lit("http://x/index.php?showtopic="), i)))
    return b.files.select("id", page.alias("p")).filter("p is not null").select("id", "p.path", F.col("p.kind").alias("page"))


# Captures


@query("x15_newest_text", "", """
SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN 'Free stuff here' WHEN 1 THEN 'Caf' || chr(233) || ' now' WHEN 2 THEN 'a whole new text of some other words' WHEN 3 THEN 'kept' WHEN 4 THEN 'Free stuff here' ELSE '<a href="http://u">x</a>' END AS text FROM orders""")
def _(b: Board):
    """Later copies that are filtered, lossy, new, empty, changed in more than a word, or without addresses."""
    old = ("Free stuff here", "Café now", "first words", "kept", "Free stuff here", '<a href="http://u">x</a>')
    new = ("delicious stuff here", "Caf now", "a whole new text of some other words", "", "FREE things HERE", '<a href="">x</a>')
    k = (F.col("o_orderkey") % 6).cast("int")

    def copy(place: int, texts, filtered, lossy):
        return b.orders.select(F.col("o_orderkey").alias("id"), F.lit(place).alias("place"), F.get(F.array(*map(F.lit, texts)), k).alias("text"), filtered.alias("filtered"), lossy.alias("lossy"))

    copies = copy(0, old, F.lit(False), F.lit(False)).unionByName(copy(1, new, k.isin(0, 4), k.isin(1, 5)))
    return history.newest_text(copies, ["id"], ["place"], "text", "filtered", "lossy")


# Joins and listings


@query("j4_avatars_of_users", "users files", "SELECT u.id, f.url FROM users u JOIN files f ON f.id = u.id AND f.kind = 'image' AND f.data IS NOT NULL")
def _(b: Board):
    from palaver.operators.pending import avatars_of

    return avatars_of(b.users.select("id", F.col("id").alias("avatar_id")), b.files.filter("kind = 'image'")).select("id", "url")


@query("j8_linked_archive_posts", "posts", "SELECT id FROM posts WHERE flag <> 'A' AND part_id IN (SELECT part_id FROM posts WHERE flag = 'A' AND quantity > 48)")
def _(b: Board):
    from palaver.operators.sets import among

    return among(b.posts.filter("flag <> 'A'"), b.posts.filter("flag = 'A' and quantity > 48"), "part_id").select("id")


@query("j12_unlinked_attachments", "files posts", "SELECT f.id, p.topic_id FROM files f JOIN posts p ON p.id = f.first_post_id WHERE f.kind <> 'link' AND f.data IS NULL")
def _(b: Board):
    from palaver.operators.pending import unlinked_attachments

    return unlinked_attachments(b.files.filter("kind <> 'link'"), b.posts).select("id", "topic_id")


@query("o5_user_listing", "users", "SELECT id, CAST(row_number() OVER (ORDER BY CASE WHEN group_name <> 'BUILDING' THEN id END NULLS LAST, -id DESC) AS BIGINT) AS place FROM users")
def _(b: Board):
    from palaver.operators.upsert import number_rows

    listed = b.users.select("id", (F.col("group_name") == "BUILDING").cast("int").alias("without"))
    return number_rows(listed, ["without", "id"], "place").select("id", "place")


@query("o7_top_unknown_tags", "quoting", r"""
WITH brk AS (SELECT post_id, lower(ltrim(x, '/')) AS tag FROM (SELECT post_id, unnest(regexp_extract_all(source, '(?i)\[(/?[a-z*][a-z0-9*]*)(?:=[^\]\n]*)?\]', 1)) AS x FROM quoting))
SELECT tag, count(DISTINCT post_id) AS posts FROM brk WHERE tag NOT IN (@) GROUP BY tag ORDER BY posts DESC, tag LIMIT 20""".replace("@", ", ".join(f"'{t}'" for t in scan.KNOWN)))
def _(b: Board):
    return scan.unknown_tags(b.quoting.withColumnRenamed("post_id", "id")).select("tag", "posts").orderBy(F.desc("posts"), "tag").limit(20)


@query("z2_topic_totals", "topics", "SELECT forum_id, CAST(sum(post_count) AS BIGINT) AS total FROM topics WHERE stickied OR locked OR has_poll GROUP BY forum_id")
def _(b: Board):
    from palaver.sources.recorded import topic_totals

    modes = [b.topics.filter("stickied"), b.topics.filter("not stickied and locked"), b.topics.filter("not stickied and not locked and has_poll")]
    answers = stacked([m.select("forum_id", F.lit(str(i)).alias("mode"), F.col("post_count").alias("total_topic_num")) for i, m in enumerate(modes)])
    return topic_totals(answers)


# Markup


@query("t7_smilies_to_ids", "markup_posts", r"SELECT id, regexp_replace(source, '(?i)\[img\]\s*http://smile.example/1.gif\s*\[/img\]', '[ts:smiley=11]', 'g') AS fixed FROM markup_posts WHERE source IS NOT NULL")
def _(b: Board):
    smilies = b.spark.createDataFrame([("http://smile.example/1.gif", 11)], "url string, id long")
    return markup.fix(b.markup_posts.filter("source is not null"), smilies).select("id", "fixed")


@query("t12_fixed_signatures", "signatures", "SELECT id, signature_source AS fixed FROM signatures WHERE signature_source IS NOT NULL")
def _(b: Board):
    leaky = F.concat(F.lit("[color="), F.col("signature_source"), F.lit("'>]"))
    fixed = markup.fix(b.signatures.filter("signature_source is not null").select("id", leaky.alias("signature_source")), text="signature_source")
    return fixed.select("id", F.regexp_extract("fixed", r"^\[color=(.*)\]$", 1).alias("fixed"))


# Reports

_QUOTES = "(SELECT CASE WHEN post_index % 3 = 0 THEN 2 ELSE 1 END AS level, CASE WHEN flag <> 'A' THEN part_id END AS quoted, CASE flag WHEN 'N' THEN 'text' WHEN 'R' THEN 'author+date' ELSE CASE WHEN status = 'F' THEN 'ambiguous' END END AS match FROM posts)"


@query("r13_quotes", "posts", sql_rows(_QUOTES, ("All", "count(*)"), ("in the post itself", "count(*) FILTER (WHERE level = 1)"), ("nested in another quote", "count(*) FILTER (WHERE level > 1)"), ("Linked", "count(quoted)"),
    ("several posts fit", "count(*) FILTER (WHERE quoted IS NULL AND match = 'ambiguous')"), ("no post fits", "count(*) FILTER (WHERE quoted IS NULL AND match IS DISTINCT FROM 'ambiguous')"))
    + f" UNION ALL SELECT 6, 'by ' || coalesce(match, 'unknown'), count(*) FROM {_QUOTES} WHERE quoted IS NOT NULL GROUP BY match")
def _(b: Board):
    flag = F.col("flag")
    match = F.when(flag == "N", "text").when(flag == "R", "author+date").when(F.col("status") == "F", "ambiguous")
    rows = b.posts.select(F.when(F.col("post_index") % 3 == 0, 2).otherwise(1).alias("level"), F.when(flag != "A", F.col("part_id")).alias("quoted_post_id"), match.alias("match"))
    return quote_report(rows)


def quote_report(quotes):
    """ord, label, n of linked quotes (level, quoted_post_id, match)."""
    linked, tied = F.col("quoted_post_id").isNotNull(), F.coalesce(F.col("match") == "ambiguous", F.lit(False))
    fixed = measures(quotes, ("All", F.count("*")), ("in the post itself", F.count_if(F.col("level") == 1)), ("nested in another quote", F.count_if(F.col("level") > 1)), ("Linked", F.count_if(linked)),
                     ("several posts fit", F.count_if(~linked & tied)), ("no post fits", F.count_if(~linked & ~tied)))
    each = quotes.filter(linked).groupBy(F.concat(F.lit("by "), F.coalesce("match", F.lit("unknown"))).alias("label")).agg(F.count("*").alias("n"))
    return fixed.unionByName(each.select(F.lit(6).alias("ord"), "label", "n"))


_MEMBERS = "(SELECT u.id, u.name, m.part_id AS title, m.flag AS main_group, CASE WHEN m.status = 'F' THEN 'http://' ELSE 'http://home' END AS website, m.quantity AS listed, p.id AS user_id, CASE WHEN p.id IS NOT NULL THEN CASE WHEN u.group_name = 'BUILDING' THEN 'name' ELSE 'position' END END AS match FROM users u LEFT JOIN (SELECT DISTINCT ON (user_id) * FROM posts ORDER BY user_id, id) m ON m.user_id = u.id LEFT JOIN files p ON p.id = u.id AND p.data IS NOT NULL)"


@query("r25_members", "users posts files", sql_rows(_MEMBERS, ("All", "count(*)"), ("not matched: pruned", "count(*) FILTER (WHERE user_id IS NULL AND listed > 25)"), ("not matched: others", "count(*) FILTER (WHERE user_id IS NULL AND NOT coalesce(listed > 25, FALSE))"),
    ("With a title", "count(title)"), ("With a website", "count(*) FILTER (WHERE website IS NOT NULL AND website <> 'http://')"))
    + f" UNION ALL SELECT 5, 'matched by ' || match, count(*) FROM {_MEMBERS} WHERE match IS NOT NULL GROUP BY match")
def _(b: Board):
    first = b.posts.groupBy(F.col("user_id").alias("id")).agg(F.min_by(F.struct("part_id", "status", "quantity"), "id").alias("m"))
    linked = b.files.filter("data is not null").select("id", F.col("id").alias("user_id"))
    rows = b.users.join(first, "id", "left").join(linked, "id", "left")
    match = F.when(F.col("user_id").isNotNull(), F.when(F.col("group_name") == "BUILDING", "name").otherwise("position"))
    pruned = F.when(F.col("m").isNotNull(), F.col("m.quantity") > 25)
    site = F.when(F.coalesce(F.col("m.status") == "F", F.lit(False)), "http://").otherwise("http://home")
    return member_report(rows.select("user_id", match.alias("match"), pruned.alias("pruned"), F.col("m.part_id").cast("string").alias("title"), site.alias("website")), {"With a title": ["title"], "With a website": ["website"]})


def member_report(members, details: dict[str, list[str]]):
    """ord, label, n of members: how they were matched, and who fills in which details (a bare ``http://`` fills nothing)."""
    alone, pruned = F.col("user_id").isNull(), F.coalesce("pruned", F.lit(False))
    empty = ("", "http://", "https://")
    given = [(label, F.count_if(F.exists(F.array(*columns), lambda x: x.isNotNull() & ~F.lower(F.trim(x)).isin(*empty)))) for label, columns in details.items()]
    fixed = measures(members, ("All", F.count("*")), ("not matched: pruned", F.count_if(alone & pruned)), ("not matched: others", F.count_if(alone & ~pruned)), *given)
    each = members.filter("match is not null").groupBy(F.concat(F.lit("matched by "), "match").alias("label")).agg(F.count("*").alias("n"))
    return fixed.unionByName(each.select(F.lit(3 + len(given)).alias("ord"), "label", "n"))


@query("r25_members_of_sources", "users posts signatures", " UNION ALL ".join((
    six_sql("All", "id AS k FROM users WHERE id <> 0", "user_id AS k FROM posts WHERE user_id <> 0"),
    six_sql("With a signature", "id AS k FROM signatures WHERE coalesce(nullif(signature_fixed, ''), nullif(signature_source, ''), nullif(signature, '')) IS NOT NULL", "user_id AS k FROM posts WHERE flag = 'R'"))))
def _(b: Board):
    from palaver.functions.text import nonempty

    signed = b.signatures.filter(nonempty(F.col("signature_fixed"), F.col("signature_source"), F.col("signature")).isNotNull())
    posters = b.posts.select(F.col("user_id").alias("id"), "flag")
    return stacked([sets.six_counts(b.users.filter("id <> 0"), posters.filter("id <> 0"), "id", "All"), sets.six_counts(signed, posters.filter("flag = 'R'"), "id", "With a signature")])
