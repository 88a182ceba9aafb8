"""Scanning legacy markup: rules, tag balance, unknown tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions.text import snippet

#: What is counted, as (name, pattern).  The table rules mind case.
RULES = (
    ("table-quote", r"\[table\]\[tr\]\[td\]\[b\]QUOTE\[/b\]"),
    ("table-code", r"\[table\]\[tr\]\[td\]\[b\]CODE\[/b\]"),
    ("attribute-leak", r"(?i)\[(\w+)=[^\]\n]*'>\]"),
    ("quoted-url", r"(?i)\[url='[^'\]\n]*'\]"),
    ("quoted-img", r"(?i)\[img\]'[^'\[\n]*'\[/img\]"),
    ("yuku-smiley", r"(?i)\[img\]https?://static\.yuku\.com/domain/bypass/images/[^\[]*\[/img\]"),
    ("forumer-emoticon", r"(?i)\[img\]'?https?://2\.forumer\.com/html/emoticons/[^\[]*\[/img\]"),
    ("ipb-emoticon", r"(?i)\(IMG:style_emoticons/[^)]*\)"),
    ("ipb-html", r"(?i)<!--(?:Quote|QuoteE|Code|EndCode|c1|ec1|c2|ec2|emo&|endemo|sizeo|sizec|colorc?o?)"),
    ("html-br", r"(?i)<br\s*/?>"),
    ("html-entity", r"(?i)&(?:#\d+|[a-z]+);"),
    ("size-100", r"(?i)\[size=100\]"),
    ("quote-with-date", r"(?i)\[quote=[^\]\n]*(?:@|,)\s*\w+ \d+,? \d{4}"),
    ("odd-spoiler-title", r"(?i)\[spoiler=(?:_?\]|\[)"),
    ("attachment-link", r"(?i)\[url=/attach/[^\]]*\]"),
    ("old-forum-link", r"(?i)metanet\.2\.forumer\.com/index\.php\?showtopic=\d+"),
)
#: Tags a board renders, and those that are never closed.
KNOWN = ("b", "i", "u", "s", "url", "img", "color", "size", "font", "quote", "spoiler", "code", "list", "*", "sup", "sub", "hr", "table", "tr", "td", "center", "email")
VOID = ("*", "hr")
BRACKET = r"(?i)\[(/?[a-z*][a-z0-9*]*)(?:=[^\]\n]*)?\]"


def rule_hits(posts: DataFrame, text: str = "source") -> DataFrame:
    """id, rule, n, example for each rule that a text matches; one pass over the texts."""
    x = F.col(text)
    counts = F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(name).alias("rule"), F.regexp_count(x, F.lit(p)).cast("long").alias("n"), F.lit(p).alias("pattern")) for i, (name, p) in enumerate(RULES)))
    hits = posts.select("id", x.alias("__x"), F.explode(F.filter(counts, lambda c: c["n"] > 0)).alias("h"))
    start, found = F.regexp_instr("__x", F.col("h.pattern")), F.regexp_substr("__x", F.col("h.pattern"))
    return hits.select("id", "h.ord", "h.rule", "h.n", snippet(F.col("__x"), start, F.length(found)).alias("example"))


def rule_report(posts: DataFrame, text: str = "source", examples: int = 3) -> DataFrame:
    """rule, posts, matches and the ids of the first examples; rules without a match stay."""
    hits = rule_hits(posts, text)
    ranked = hits.withColumn("k", F.row_number().over(Window.partitionBy("rule").orderBy("id")))
    found = ranked.groupBy("rule").agg(F.count("*").alias("posts"), F.sum("n").alias("matches"), F.sort_array(F.collect_list(F.when(F.col("k") <= examples, F.col("id")))).alias("ids"))
    names = posts.sparkSession.createDataFrame([(i, n) for i, (n, _) in enumerate(RULES)], "ord int, rule string")
    return names.join(found, "rule", "left").select("ord", "rule", F.coalesce("posts", F.lit(0)).alias("posts"), F.coalesce("matches", F.lit(0)).alias("matches"), F.coalesce("ids", F.array().cast("array<bigint>")).alias("ids"))


def brackets(posts: DataFrame, text: str = "source") -> DataFrame:
    """id, tag (lower case), step (+1 opens, -1 closes) of every bracketed word."""
    every = posts.select("id", F.explode(F.regexp_extract_all(F.col(text), F.lit(BRACKET), F.lit(1))).alias("b"))
    return every.select("id", F.lower(F.regexp_replace("b", "^/", "")).alias("tag"), F.when(F.col("b").startswith("/"), -1).otherwise(1).alias("step"))


def unbalanced(posts: DataFrame, text: str = "source") -> DataFrame:
    """kind, posts, surplus of known tags that do not add up."""
    tags = brackets(posts, text).filter(F.col("tag").isin(*KNOWN) & ~F.col("tag").isin(*VOID))
    per_post = tags.groupBy("id", "tag").agg(F.sum("step").alias("diff")).filter("diff <> 0")
    kind = F.concat(F.lit("["), "tag", F.lit("] "), F.when(F.col("diff") > 0, "unclosed").otherwise("extra close"))
    return per_post.groupBy(kind.alias("kind")).agg(F.count("*").alias("posts"), F.sum(F.abs("diff")).alias("surplus"))


def unknown_tags(posts: DataFrame, text: str = "source") -> DataFrame:
    """tag, posts and the first post of bracketed words that are no tags."""
    words = brackets(posts, text).filter(~F.col("tag").isin(*KNOWN)).select("id", "tag").distinct()
    return words.groupBy("tag").agg(F.count("*").alias("posts"), F.min("id").alias("example"))


def matching_posts(posts: DataFrame, rule: str, text: str = "source") -> DataFrame:
    pattern = dict(RULES)[rule]
    return posts.filter(F.col(text).rlike(pattern)).select("id")


def matches(x: Column, rule: str) -> Column:
    return x.rlike(dict(RULES)[rule])
