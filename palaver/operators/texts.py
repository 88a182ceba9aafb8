"""Texts of posts and signatures as the passes read them, and the images they embed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.functions.markup import to_markup
from palaver.functions.text import nonempty
from palaver.functions.urls import host_of, image_url, normalize_url

IMG = r"(?i)\[img\]\s*([^\[\]\s]+)\s*\[/img\]"


def best_texts(posts: DataFrame, quoting: bool = False, with_html: bool = True) -> DataFrame:
    """id, text: repaired source, else source, else the HTML as markup; '' counts as a text.

    Only rows without a source send their HTML to Python.  ``quoting`` keeps texts
    that may hold quotes, before any conversion.
    """
    if quoting:
        posts = posts.filter(F.col("source_fixed").ilike("%[quote%") | F.col("source").ilike("%[quote%") | (F.col("source").isNull() & F.col("content").ilike("%quote%")))
    known = F.coalesce("source_fixed", "source")
    if not with_html:
        return posts.select("id", known.alias("text")).filter("text is not null")
    html = F.when(known.isNull(), F.col("content"))
    return posts.select("id", F.coalesce(known, F.when(html.isNotNull(), to_markup(html))).alias("text")).filter("text is not null")


def signature_texts(users: DataFrame) -> DataFrame:
    """id, text of members' signatures as shown; '' is no signature."""
    shown = nonempty(F.col("signature_fixed"), F.col("signature_source"), F.col("signature"))
    return users.filter("id <> 0").select("id", shown.alias("text")).filter("text is not null")


def embedded(texts: DataFrame, skip: str | None = None) -> DataFrame:
    """id, url of embedded images in normal form; hosts that match ``skip`` are handled elsewhere.

    The cheap test for a tag comes before the pattern.
    """
    holding = texts.filter(F.col("text").ilike("%[img]%"))
    each = holding.select("id", F.explode(F.regexp_extract_all("text", F.lit(IMG), F.lit(1))).alias("raw"))
    found = each.select("id", image_url(F.col("raw")).alias("url")).filter("url is not null")
    return found.filter(~F.col("url").rlike(skip)) if skip else found


def collect_smilies(texts: DataFrame, base: str, hosts: str) -> DataFrame:
    """url, uses of smiley images on the board's hosts."""
    holding = texts.filter(F.col("text").ilike("%[img]%"))
    each = holding.select(F.explode(F.regexp_extract_all("text", F.lit(IMG), F.lit(1))).alias("raw")).select(normalize_url(F.col("raw"), base).alias("url"))
    return each.filter(host_of(F.col("url")).rlike(hosts)).groupBy("url").agg(F.count("*").alias("uses"))


def refresh_uses(known: DataFrame, found: DataFrame, scope: str) -> DataFrame:
    """``known`` (url, signature_uses, post_uses) with one scope counted anew; the other stays.

    Urls that the scope no longer has count 0 there; new ones come with 0 elsewhere.
    """
    other = {"signature": "post", "post": "signature"}[scope]
    joined = known.join(found.groupBy("url").agg(F.count("*").alias("n")), "url", "full_outer")
    return joined.select("url", F.coalesce("n", F.lit(0)).alias(f"{scope}_uses"), F.coalesce(f"{other}_uses", F.lit(0)).alias(f"{other}_uses")).select("url", "signature_uses", "post_uses")
