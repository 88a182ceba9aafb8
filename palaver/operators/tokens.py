"""Rewriting texts at token level: texts as rows of tokens, references resolved by joins, texts put together again.

A text becomes one row a match of a pattern, with what stands before the match.
What a match refers to is looked up in a table by an equi-join, however large the
table is; a match may offer several references, of which the first known one
counts.  Rows of a text meet again by its id.  Ids are those of single texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.attachments import TRAILING, canonical
from palaver.functions.text import let
from palaver.functions.urls import query_map
from palaver.operators.shared import materialized

#: A code block; its content is literal.
CODE = r"\[code\b[^\]]*\].*?\[/code\]"
_FLAGS = "(?isU)"

#: Addresses of the old board, references to attachments and the text of an attachment's block.
OLD_URL = r"https?://(?:www\.)?metanet\.(?:2\.)?forumer\.com/(?:index\.php)?\?[^\s\[\]<>\"']*"
ATTACHED = (
    r"(?:/attach/ma/[^\s\[\]<>\"']+"
    r"|(?:https?://)?[\w.-]*forumer\.com(?::\d+)?/+uploads/[^\s\[\]<>\"']+"
    r"|https?://[\w.-]*forumer\.com(?::\d+)?/index\.php\?[^\s\[\]<>\"']*act=attach[^\s\[\]<>\"']*)"
)
BLOCK = r"(?:-{5,}\s?)?\[url=/attach/ma/[^\]\s]+\]Click here to view the attachment\[/url\]"


def pairs_of(*names: str) -> str:
    """A pattern of tag pairs of these names, each up to its next closing tag."""
    return "|".join(rf"\[{n}\b[^\]]*\].*?\[/{n}\]" for n in names)


def tokens_of(texts: DataFrame, pattern: str) -> DataFrame:
    """id, i, gap, token: each match and what stands before it; the last row of a text has no match."""
    found = F.arrays_zip(F.split("text", pattern, -1).alias("gap"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("token"))
    return texts.select("id", F.posexplode(found).alias("i", "t")).select("id", "i", "t.gap", "t.token")


def joined(pieces: DataFrame, *by: str, order: str = "i", piece: str = "piece", between: str = "") -> DataFrame:
    """Pieces of text in order, one text for each group."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(piece).alias("piece"))))
    return pieces.groupBy(*by).agg(F.array_join(F.transform(rows, lambda r: r["piece"]), between).alias("text"))


def resolved(rows: DataFrame, references: Callable[[Column], Column], known: DataFrame) -> DataFrame:
    """id, i, hit: for every token the first of its references that ``known`` (kind, key, target) has.

    ``references`` gives an array of structs (kind, key), null for a token without any.
    """
    asked = rows.filter("token is not null").select("id", "i", F.posexplode(references(F.col("token"))).alias("rank", "r"))
    asked = asked.select("id", "i", "rank", "r.kind", F.col("r.key").cast("string").alias("key")).filter("key is not null")
    found = asked.join(known.select("kind", F.col("key").cast("string").alias("key"), "target"), ["kind", "key"])
    return found.groupBy("id", "i").agg(F.min_by(F.struct("kind", "key", "target"), "rank").alias("hit"))


def rewritten(texts: DataFrame, pattern: str, references: Callable[[Column], Column], known: DataFrame, replacement: Callable[[Column, Column], Column]) -> DataFrame:
    """The texts with every token that refers to something known replaced; other texts and tokens stay.

    The tokens are read twice, for what they refer to and for the text, and the next
    rewriting reads the result twice again: they are matched once and written.
    """
    rows = materialized(tokens_of(texts, pattern), "tokens")
    rows = rows.join(resolved(rows, references, known), ["id", "i"], "left")
    token = F.when(F.col("hit").isNotNull(), replacement(F.col("token"), F.col("hit"))).otherwise(F.coalesce("token", F.lit("")))
    return joined(rows.select("id", "i", F.concat("gap", token).alias("piece")), "id")


def _only(texts: DataFrame, mark: Column, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``change`` for the texts that hold the mark; no others are moved."""
    held = F.coalesce(mark, F.lit(False))
    slim = texts.select("id", "text")
    return change(slim.filter(held)).unionByName(slim.filter(~held))


# Links to the old board


def old_link(url: Column) -> Column:
    """struct(topic, forum, start, old_post) of an address of the old board; null where it names none."""

    def read(x: Column) -> Column:
        def parts(q: Column) -> Column:
            digits = lambda v: F.when(v.rlike(r"^\d+$"), v)
            act = F.lower(q["act"])
            topic = F.coalesce(F.nullif(q["showtopic"], F.lit("")), F.when(act == "st", q["t"]))
            forum = F.coalesce(F.nullif(q["showforum"], F.lit("")), F.when(act == "sf", q["f"]))
            entry = F.nullif(F.regexp_extract(x, r"^[^#]*#entry(\d+)$", 1), F.lit(""))
            post = F.coalesce(F.when(F.lower(q["view"]) == "findpost", F.nullif(q["p"], F.lit(""))), entry)
            number = lambda v: digits(v).try_cast("long")
            named = F.coalesce(topic != "", F.lit(False))
            return F.struct(number(topic).alias("topic"), F.when(~named, number(forum)).alias("forum"), F.nullif(number(q["st"]), F.lit(0)).alias("start"), number(post).alias("old_post"))

        return let(query_map(x), parts)

    return let(F.replace(url, F.lit("&amp;"), F.lit("&")), read)


def _opened(address: Column, hit: Column) -> Column:
    """The opening tag of a link that was resolved."""

    def tag(link: Column) -> Column:
        start = F.coalesce(F.concat(F.lit(" start="), link["start"].cast("string")), F.lit(""))
        post = F.coalesce(F.concat(F.lit(" old_post="), link["old_post"].cast("string")), F.lit(""))
        return F.when(hit["kind"] == "topic", F.concat(F.lit("[ts:topic="), hit["target"].cast("string"), start, post, F.lit("]"))).otherwise(F.concat(F.lit("[ts:forum="), hit["target"].cast("string"), F.lit("]")))

    return let(old_link(address), tag)


def _linked(address: Column, shown: Column, hit: Column) -> Column:
    return F.concat(_opened(address, hit), shown, F.lit("[/ts:"), hit["kind"], F.lit("]"))


def _old_references(address: Column) -> Column:
    def both(link: Column) -> Column:
        return F.filter(F.array(*(F.struct(F.lit(kind).alias("kind"), link[kind].alias("key")) for kind in ("topic", "forum"))), lambda r: r["key"].isNotNull())

    return let(address, lambda a: F.when(a != "", let(old_link(a), both)))


def _tagged(pattern: str, token: Column) -> Column:
    """The address of ``[url=address]...[/url]`` or ``[url]address[/url]``; '' for other tokens."""
    return F.coalesce(F.nullif(F.regexp_extract(token, rf"{_FLAGS}^\[url=({pattern})\].*\[/url\]$", 1), F.lit("")), F.regexp_extract(token, rf"{_FLAGS}^\[url\]({pattern})\[/url\]$", 1))


def _label(token: Column) -> Column:
    return F.regexp_extract(token, rf"{_FLAGS}^\[url[^\]]*\](.*)\[/url\]$", 1)


def _bare(pattern: str, token: Column) -> Column:
    """A bare address without the punctuation behind it; '' for other tokens."""
    return F.rtrim(F.regexp_extract(token, rf"{_FLAGS}^({pattern})$", 1), F.lit(TRAILING))


def _rest(token: Column, address: Column) -> Column:
    return F.substr(token, F.length(address) + 1)


def link_old_board(texts: DataFrame, topics: DataFrame, forums: DataFrame) -> DataFrame:
    """id, text: links to the old board's topics and forums as tags of their own, outside of code.

    First tagged links, then bare addresses that no link, image or such tag holds.
    """
    known = topics.select(F.lit("topic").alias("kind"), F.col("id").alias("key"), F.col("id").alias("target")).unionByName(forums.select(F.lit("forum").alias("kind"), F.col("id").alias("key"), F.col("id").alias("target")))
    links = rf"{_FLAGS}{CODE}|\[url={OLD_URL}\].*?\[/url\]|\[url\]{OLD_URL}\[/url\]"
    bare = rf"{_FLAGS}{CODE}|{pairs_of('url', 'img', 'ts:topic', 'ts:forum')}|{OLD_URL}"

    def change(held: DataFrame) -> DataFrame:
        once = rewritten(held, links, lambda t: _old_references(_tagged(OLD_URL, t)), known, lambda t, hit: _linked(_tagged(OLD_URL, t), _label(t), hit))
        return rewritten(once, bare, lambda t: _old_references(_bare(OLD_URL, t)), known, lambda t, hit: F.concat(_linked(_bare(OLD_URL, t), _bare(OLD_URL, t), hit), _rest(t, _bare(OLD_URL, t))))

    return _only(texts, F.col("text").ilike("%forumer.com%"), change)


# Attachments


def link_attachments(texts: DataFrame, attachments: DataFrame) -> DataFrame:
    """id, text: references to known attachments (url, id) as tags of their own, outside of code.

    Blocks and images first, then links, then bare addresses that no tag holds.
    """
    known = attachments.select(F.lit("attachment").alias("kind"), F.col("url").alias("key"), F.col("id").alias("target"))

    def refer(address: Column) -> Column:
        return let(address, lambda a: F.when(a != "", F.array(F.struct(F.lit("attachment").alias("kind"), canonical(a)["url"].alias("key")))))

    def of_block(token: Column) -> Column:
        image = F.regexp_extract(token, rf"{_FLAGS}^\[img\]({ATTACHED})\[/img\]$", 1)
        block = F.regexp_extract(token, r"(?isU)\[url=(/attach/ma/[^\]\s]+)\]Click here to view the attachment\[/url\]$", 1)
        return F.coalesce(F.nullif(image, F.lit("")), block)

    def shown(token: Column, hit: Column) -> Column:
        kind = F.when(token.ilike("[img]%"), "attachment-image").otherwise("attachment")
        return F.concat(F.lit("[ts:"), kind, F.lit("="), hit["target"].cast("string"), F.lit("]"))

    def link(label: Column, hit: Column) -> Column:
        return F.concat(F.lit("[ts:attachment-link="), hit["target"].cast("string"), F.lit("]"), label, F.lit("[/ts:attachment-link]"))

    blocks = rf"{_FLAGS}{CODE}|{BLOCK}|\[img\]{ATTACHED}\[/img\]"
    links = rf"{_FLAGS}{CODE}|\[url={ATTACHED}\].*?\[/url\]|\[url\]{ATTACHED}\[/url\]"
    bare = rf"{_FLAGS}{CODE}|{pairs_of('url', 'img', 'ts:attachment-link')}|{ATTACHED}"

    def change(held: DataFrame) -> DataFrame:
        first = rewritten(held, blocks, lambda t: refer(of_block(t)), known, shown)
        second = rewritten(first, links, lambda t: refer(_tagged(ATTACHED, t)), known, lambda t, hit: link(_label(t), hit))
        return rewritten(second, bare, lambda t: refer(_bare(ATTACHED, t)), known, lambda t, hit: F.concat(link(_bare(ATTACHED, t), hit), _rest(t, _bare(ATTACHED, t))))

    low = F.lower("text")
    return _only(texts, low.contains("/attach/") | low.contains("/uploads/") | low.contains("act=attach"), change)


# Targets of links


def link_targets(texts: DataFrame, old_posts: DataFrame, topics: DataFrame, forums: DataFrame) -> DataFrame:
    """id, i, kind, target, href of every topic and forum tag: the post that an old post became, else the topic.

    ``old_posts``: old_post, post_id, topic_id, place (its number in the topic).  A tag
    whose post, topic and forum are all unknown has no row.
    """
    page = lambda folder, key: F.concat(F.lit(f"{folder}/"), F.col(key).cast("string"), F.lit(".html"))
    known = (
        old_posts.select(F.lit("post").alias("kind"), F.col("old_post").alias("key"), F.struct(F.col("post_id").alias("id"), F.concat(page("t", "topic_id"), F.lit("#p"), F.col("post_id").cast("string")).alias("href")).alias("target"))
        .unionByName(topics.select(F.lit("topic").alias("kind"), F.col("id").alias("key"), F.struct("id", page("t", "id").alias("href")).alias("target")))
        .unionByName(forums.select(F.lit("forum").alias("kind"), F.col("id").alias("key"), F.struct("id", page("f", "id").alias("href")).alias("target")))
    )

    def references(token: Column) -> Column:
        number = lambda pattern: F.nullif(F.regexp_extract(token, pattern, 1), F.lit(""))
        of = {"post": r"(?i)^\[ts:topic=.* old_post=(\d+)", "topic": r"(?i)^\[ts:topic=(\d+)", "forum": r"(?i)^\[ts:forum=(\d+)"}
        return F.filter(F.array(*(F.struct(F.lit(k).alias("kind"), number(p).alias("key")) for k, p in of.items())), lambda r: r["key"].isNotNull())

    rows = tokens_of(texts.filter(F.col("text").ilike("%[ts:%")), r"(?i)\[ts:(?:topic|forum)=[^\]]*\]")
    return resolved(rows, references, known).select("id", "i", F.col("hit.kind").alias("kind"), F.col("hit.target.id").alias("target"), F.col("hit.target.href").alias("href"))
