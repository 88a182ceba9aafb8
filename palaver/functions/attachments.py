"""Attachments and hosted files: one address for all ways of naming them, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palaver.functions.text import let
from palaver.functions.urls import query_map

#: Where attached files of the old board lay, how uploads are named, marks behind a bare address.
UPLOADS = "http://2.forumer.com/uploads/metanet/"
UPLOAD_NAME = r"(?i)^post-(\d+)-(\d{9,10})\.\w+$"
TRAILING = ".,;:!?)"


def _upload(url: Column) -> Column:
    def read(name: Column) -> Column:
        forum, seconds = (F.regexp_extract(name, UPLOAD_NAME, i).try_cast("long") for i in (1, 2))
        made = F.struct(
            F.lit("upload").alias("kind"), url.alias("url"), name.alias("name"), forum.alias("old_forum_id"),
            F.timestamp_seconds(seconds).cast("timestamp_ntz").alias("uploaded_at"), F.lit(None).cast("long").alias("old_attach_id"),
        )
        return F.when(name != "", made)

    return let(F.url_decode(F.replace(F.substring_index(url, "/", -1), F.lit("+"), F.lit("%2B"))), read)


def canonical(ref: Column) -> Column:
    """struct(kind, url, name, old_forum_id, uploaded_at, old_attach_id) of a reference; null if it names no attachment.

    Three forms: board-relative ``/attach/ma/...``, an address under ``/uploads/`` and
    a page address with ``act=attach`` and an id.
    """

    def read(x: Column) -> Column:
        whole = F.replace(F.when(x.contains("://"), x).otherwise(F.concat(F.lit("http://"), x)), F.lit("&amp;"), F.lit("&"))
        host = F.regexp_replace(F.lower(F.regexp_extract(whole, r"^[a-zA-Z]+://([^/?#]*)", 1)), r":80$", "")
        path = F.regexp_replace(F.regexp_extract(whole, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1), r"/+", "/")
        query = query_map(whole)
        number = query["id"]
        kind = F.coalesce(F.nullif(query["type"], F.lit("")), F.lit("post"))
        page = F.struct(
            F.lit("attach-id").alias("kind"), F.concat(F.lit("http://"), host, F.lit("/index.php?act=Attach&type="), kind, F.lit("&id="), number.try_cast("long").cast("string")).alias("url"),
            F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("old_forum_id"), F.lit(None).cast("timestamp_ntz").alias("uploaded_at"), number.try_cast("long").alias("old_attach_id"),
        )
        own = F.lower(x).startswith("/attach/ma/")
        return (
            F.when(own, _upload(F.concat(F.lit(UPLOADS), F.substr(x, F.lit(len("/attach/ma/") + 1)))))
            .when(F.lower(path).contains("/uploads/"), _upload(F.concat(F.lit("http://"), host, path)))
            .when((F.lower(query["act"]) == "attach") & number.rlike(r"^\d+$"), page)
        )

    return let(F.rtrim(ref, F.lit(TRAILING)), read)


def unproxied(url: Column) -> Column:
    """The address behind an image proxy's query."""
    mark = "imageproxy.php?url="
    at = F.locate(mark, url)
    behind = (at > 0) & ((at == 1) | (F.substr(url, at - 1, F.lit(1)) == "/"))
    rest = F.substr(url, at + len(mark))
    return F.when(behind, F.coalesce(F.try_url_decode(F.replace(rest, F.lit("+"), F.lit("%2B"))), rest)).otherwise(url)


def is_shortened(shown: Column, url: Column) -> Column:
    """Whether a shown address is ``start ... end`` of the real one."""
    start, end = F.substring_index(shown, " ... ", 1), F.regexp_extract(shown, r"(?s)^.*? \.\.\. (.*)$", 1)
    return shown.contains(" ... ") & url.startswith(start) & url.endswith(end)


def file_key(url: Column) -> Column:
    """Equal for two addresses of one file: no scheme, port 80 or query, lower case."""
    return F.lower(F.substring_index(F.replace(F.regexp_replace(url, r"^.*?://", ""), F.lit(":80/"), F.lit("/")), "?", 1))


def extension(name: Column) -> Column:
    """The last dot of a file name and what follows, lower-cased; '' without one."""
    return F.lower(F.regexp_extract(name, r"[^/.][^/]*?(\.[^./]+)$", 1))


def smiley_of(url: Column) -> Column:
    """struct(name, host): a smiley's file name without extension, and whose server it lies on."""
    path = F.substring_index(url, "?", 1)
    name = F.regexp_replace(F.regexp_extract(F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path), r"([^/]*)/*$", 1), r"(?<=.)\.[^.]*$", "")
    host = F.substring_index(F.regexp_replace(url, r"^.*://", ""), "/", 1)
    kind = F.when(host.contains("yuku.com"), "yuku").when(host.endswith("forumer.com"), "forumer").when(host.endswith("tapatalk.com"), "tapatalk").otherwise("other")
    return F.struct(name.alias("name"), kind.alias("host"))


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(data: Column) -> Column:
    """SHA-1 in base 32, as capture lists give it: 160 bits are 32 digits of 5."""
    bits = F.lpad(F.conv(F.substring(F.sha1(data), 1, 10), 16, 2), 40, "0")
    for i in range(1, 4):
        bits = F.concat(bits, F.lpad(F.conv(F.substring(F.sha1(data), 10 * i + 1, 10), 16, 2), 40, "0"))
    digit = lambda b: F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.substr(F.lit(_BASE32), F.conv(F.substr(b, i * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1, F.lit(1)))
    return F.array_join(let(bits, digit), "")
