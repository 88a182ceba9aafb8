"""URLs as column expressions: normal forms, parts, keys and query strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palaver.functions.text import let


def image_url(x: Column) -> Column:
    """An embedded image's URL: no quotes, no fragment, a scheme; null unless http(s)."""
    bare = F.regexp_replace(F.btrim(F.trim(x), F.lit("'\"")), r"#.*$", "")
    whole = F.when(bare.ilike("www.%"), F.concat(F.lit("http://"), bare)).otherwise(bare)
    return F.when(whole.rlike(r"(?i)^https?://[^/\s]+"), whole)


def host_of(x: Column) -> Column:
    return F.lower(F.regexp_extract(x, r"(?i)^[a-z][a-z0-9+.-]*://([^/:?#]+)", 1))


def site_of(x: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host_of(x), ".", -2)


def path_of(x: Column) -> Column:
    return F.regexp_extract(x, r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]+(/[^?#]*)", 1)


def file_name(x: Column) -> Column:
    """The last part of the path, lower-cased."""
    return F.lower(F.regexp_extract(path_of(x), r"([^/]*)$", 1))


def folder_of(x: Column) -> Column:
    """Scheme, host and folders; null directly below the root."""
    folder = F.regexp_extract(x, r"(?i)^([a-z][a-z0-9+.-]*://[^/?#]+/[^?#]*/)[^/?#]*", 1)
    return F.nullif(folder, F.lit(""))


def capture_key(x: Column) -> Column:
    """One key for all spellings of an address: no scheme, www or :80, unquoted, lower case."""
    read = F.lower(F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x))
    return F.regexp_replace(F.regexp_replace(read, r"^https?://(www\.)?", ""), r"^([^/]*):80(/|$)", "$1$2")


def normalize_url(x: Column, base: str) -> Column:
    """Board-relative to absolute; scheme and host in lower case, no :80."""
    whole = F.when(x.startswith("//"), F.concat(F.lit("http:"), x)).when(x.startswith("/"), F.concat(F.lit(base), x)).otherwise(x)
    head = F.regexp_extract(whole, r"(?i)^([a-z]+://[^/]*)", 1)
    return F.concat(F.regexp_replace(F.lower(head), r":80$", ""), F.substr(whole, F.length(head) + 1))


def query_map(x: Column) -> Column:
    """The query string as a map with lower-cased keys; the last of equal keys wins."""
    query = F.replace(F.regexp_extract(x, r"\?([^#]*)", 1), F.lit("&amp;"), F.lit("&"))
    pairs = F.filter(F.split(query, "&"), lambda p: p.contains("="))
    entries = F.transform(pairs, lambda p: F.struct(F.lower(F.substring_index(p, "=", 1)).alias("key"), F.regexp_extract(p, r"=(.*)$", 1).alias("value")))

    def last(every: Column) -> Column:
        return F.filter(every, lambda e, i: ~F.exists(F.slice(every, i + 2, F.size(every)), lambda later: later["key"] == e["key"]))

    return F.map_from_entries(let(entries, last))


def query_hash(query: Column) -> Column:
    """How hashed dumps name a query: twelve hex digits of its SHA-256."""
    return F.substring(F.sha2(query, 256), 1, 12)


def page_kind(query: Column) -> Column:
    """The kind of page a query map asks for; null for others."""
    q = lambda k: query[k]
    return (
        F.when(q("showtopic").isNotNull(), "topic").when(q("showforum").isNotNull(), "forum").when(q("showuser").isNotNull(), "profile")
        .when(F.lower(q("act")) == "members", "members").when(F.lower(q("act")) == "attach", "attach")
    )


def archive_position(name: Column) -> Column:
    """struct(topic, offset) of an archive page's file name such as t123-50.html."""
    topic = F.regexp_extract(name, r"t(\d+)(?:-(\d+))?\.html$", 1)
    offset = F.regexp_extract(name, r"t(\d+)(?:-(\d+))?\.html$", 2)
    return F.when(topic != "", F.struct(topic.cast("bigint").alias("topic"), F.coalesce(F.nullif(offset, F.lit("")).cast("bigint"), F.lit(0)).alias("offset")))


def query_candidates(queries):
    """Both spellings of each candidate query, with their hashes and all its columns."""
    both = queries.select("*", F.explode(F.array(F.col("query"), F.replace("query", F.lit("&"), F.lit("&amp;")))).alias("spelling"))
    return both.withColumn("hash", query_hash(F.col("spelling"))).drop("spelling").distinct()


def restored(links, queries, *own: str):
    """The links (``hash`` and more) with the query of each that is known.

    Twelve digits are 48 bits, too few for the queries of a large board: queries of
    two topics may have one hash.  ``own`` names columns that a link and its query
    share, such as the topic of its page, so that only queries made from a page's own
    numbers are taken for its links.
    """
    return links.join(query_candidates(queries), ["hash", *own])
