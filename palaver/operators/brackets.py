"""Matching of nested tags as windows over rows of tokens.

Tags inside of code blocks do not count.  An opening tag adds one to a running
sum, a closing one takes one away; the depth is that sum less its running minimum
below 0, so that stray closing tags change nothing.  The partner of an opening tag
is the next tag of its level; what encloses a tag is the last one opened a level
above.  All windows are dealt by text, so texts are shuffled once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.functions.attribution import attribution
from palaver.operators.tokens import joined, tokens_of

_TAGS = r"(?i)\[/?(?:quote|code)\b[^\]\n]*\]"


def _is(pattern: str) -> Column:
    return F.coalesce(F.col("token").rlike(pattern), F.lit(False))


def matched(rows: DataFrame, opening: Column, closing: Column, code_opening: Column, code_closing: Column) -> DataFrame:
    """Token rows (id, i, ...) with ``kind`` (open, close or null), ``before`` (the depth at the token), ``level``, ``position``, ``part``, ``partner`` and ``enclosing``.

    ``part`` is how many tags that count stand before; ``partner`` is the row of the closing tag, null for an unclosed one; ``position``
    counts opening tags from 0; ``enclosing`` is the position of the innermost tag
    that is open where the token begins.
    """
    along = Window.partitionBy("id").orderBy("i")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    # A code block runs from the first opening tag after a closing one to the next closing one, if there is any.
    begun = F.max(F.when(code_opening, F.col("i"))).over(so_far)
    ended = F.coalesce(F.max(F.when(code_closing, F.col("i"))).over(before), F.lit(-1))
    final = F.max(F.when(code_closing, F.col("i"))).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("__code", F.coalesce((begun > ended) & (F.col("i") <= final), F.lit(False)))
    step = F.when(F.col("__code"), 0).when(opening, 1).when(closing, -1).otherwise(0)
    rows = rows.withColumn("__step", step).withColumn("__sum", F.sum("__step").over(so_far))
    rows = rows.withColumn("__depth", F.col("__sum") - F.least(F.lit(0), F.min("__sum").over(so_far)))
    rows = rows.withColumn("before", F.lag("__depth", 1, 0).over(along))
    kind = F.when(F.col("__step") == 1, "open").when((F.col("__step") == -1) & (F.col("before") > 0), "close")
    rows = rows.withColumn("kind", kind).withColumn("level", F.when(F.col("kind") == "open", F.col("before") + 1).when(F.col("kind") == "close", F.col("before")))
    opened = F.sum((F.col("kind") == "open").cast("int")).over(so_far) - 1
    part = F.coalesce(F.sum(F.col("kind").isNotNull().cast("int")).over(before), F.lit(0))
    rows = rows.withColumns({"position": F.when(F.col("kind") == "open", opened), "part": part})
    of_level = Window.partitionBy("id", "level").orderBy("i")
    partner = F.when((F.col("kind") == "open") & (F.lead("kind").over(of_level) == "close"), F.lead("i").over(of_level))
    rows = rows.withColumn("partner", partner).drop("__code", "__step", "__sum", "__depth")
    # Each token asks for the last tag opened at the depth it stands in; an opening tag answers at its own level.
    marks = F.array(F.struct(F.col("before").alias("at"), F.lit(None).cast("int").alias("opened")), F.struct(F.col("level").alias("at"), F.col("position").cast("int").alias("opened")))
    marks = F.slice(marks, 1, F.when(F.col("kind") == "open", 2).otherwise(1))
    spread = rows.withColumn("__m", F.explode(marks))
    last = F.last("__m.opened", ignorenulls=True).over(Window.partitionBy("id", F.col("__m.at")).orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    return spread.withColumn("enclosing", last).filter("`__m`.opened is null").drop("__m")


def quote_tags(posts: DataFrame, text: str = "source") -> DataFrame:
    """The matched quote and code tags of posts (id and a text)."""
    holding = posts.filter(F.col(text).ilike("%[quote%")).select("id", F.col(text).alias("text"))
    opening = _is(r"(?i)^\[quote(?:[= \t][^\]\n]*)?\]$")
    return matched(tokens_of(holding, _TAGS), opening, F.coalesce(F.lower("token") == "[/quote]", F.lit(False)), _is(r"(?i)^\[code"), _is(r"(?i)^\[/code"))


def bodies(tags: DataFrame) -> DataFrame:
    """id, position (null: outside of quotes), text: what each quote holds itself, nested quotes left out.

    Pieces between tags that count are joined by a space; other tags are text.
    """
    literal = F.when(F.col("kind").isNull(), F.coalesce("token", F.lit(""))).otherwise("")
    rows = tags.select("id", "i", F.col("enclosing").alias("position"), "part", F.concat("gap", literal).alias("piece"))
    parts = joined(rows, "id", "position", "part")
    return joined(parts, "id", "position", order="part", piece="text", between=" ")


def own_words(tags: DataFrame) -> DataFrame:
    """id, text: posts without their closed quotes; from an unclosed outer quote on, everything is the post's own."""
    outer = (F.col("kind") == "open") & (F.col("level") == 1) & F.col("partner").isNull()
    begin = F.max(F.when(outer, F.col("i"))).over(Window.partitionBy("id"))
    after = tags.withColumn("__b", begin).filter("i >= `__b`")
    piece = F.concat(F.when(F.col("i") == F.col("__b"), "").otherwise(F.col("gap")), F.coalesce("token", F.lit("")))
    tail = joined(after.select("id", "i", piece.alias("piece")), "id").select("id", F.lit(1).alias("n"), "text")
    own = bodies(tags).filter("position is null").select("id", F.lit(0).alias("n"), "text")
    return joined(own.unionByName(tail), "id", order="n", piece="text", between=" ")


@F.pandas_udf(T.StructType([T.StructField("author", T.StringType()), T.StructField("date", T.StringType()), T.StructField("unix", T.LongType()), T.StructField("post_ref", T.LongType()), T.StructField("user_ref", T.LongType())]))
def who_and_when(tags: pd.Series) -> pd.DataFrame:
    """What an opening tag says of the quoted post."""
    out = pd.DataFrame([attribution(t) for t in tags], columns=["author", "date", "unix", "post_ref", "user_ref"])
    for c in ("unix", "post_ref", "user_ref"):
        out[c] = out[c].astype("Int64")
    return out


def quotes_of(posts: DataFrame, text: str = "source") -> DataFrame:
    """post_id, position, level, parent, closed, author, date, unix, post_ref, user_ref, body of every quote."""
    tags = quote_tags(posts, text)
    each = tags.filter("kind = 'open'").select("id", "position", "level", F.col("enclosing").alias("parent"), F.col("partner").isNotNull().alias("closed"), "token")
    held = bodies(tags).filter("position is not null").withColumnRenamed("text", "body")
    out = each.join(held, ["id", "position"], "left").withColumn("said", who_and_when("token"))
    kinds = {"position": "int", "level": "int", "parent": "int"}
    return out.select(F.col("id").alias("post_id"), *(F.col(c).cast(k).alias(c) for c, k in kinds.items()), "closed", "said.*", F.coalesce("body", F.lit("")).alias("body"))


def anchored_quotes(posts: DataFrame, links: DataFrame, text: str = "source") -> DataFrame:
    """id, text: quotes whose post is known as ``[ts:quote=<post>]...[/ts:quote]``, by (post_id, position) of ``links``.

    Links that name no post, unclosed quotes and other tags stay as they are.
    """
    tags = quote_tags(posts, text)
    known = links.filter("quoted_post_id is not null").select(F.col("post_id").alias("id"), "position", "quoted_post_id")
    found = tags.filter("kind = 'open' and partner is not null").select("id", "i", "partner", "position").join(known, ["id", "position"])
    new = F.array(F.struct(F.col("i").alias("i"), F.concat(F.lit("[ts:quote="), F.col("quoted_post_id").cast("string"), F.lit("]")).alias("new")), F.struct(F.col("partner").alias("i"), F.lit("[/ts:quote]").alias("new")))
    changed = found.select("id", F.explode(new).alias("c")).select("id", "c.i", "c.new")
    rows = tags.select("id", "i", "gap", "token").join(changed, ["id", "i"], "left")
    return joined(rows.select("id", "i", F.concat("gap", F.coalesce("new", "token", F.lit(""))).alias("piece")), "id")
