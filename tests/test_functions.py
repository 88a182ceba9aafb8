"""Markup, names, dates and URLs: strings in, strings out."""

from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palaver.functions import dates, files, markup, text, urls


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return df.select(column.alias("r")).first()["r"]


def test_quotes_nest_and_unclosed_run_on():
    quotes, own = markup.parse_quotes('a [quote="Bob" date="May 2 2004"]x [quote=Al]deep[/quote] y[/quote] b [/quote] [code][quote][/code] [quote]tail')
    assert [(q["level"], q["parent"], q["author"], q["date"]) for q in quotes] == [(1, None, "Bob", "May 2 2004"), (2, 0, "Al", None), (1, None, None, None)]
    assert quotes[0]["body"].split() == ["x", "y"] and quotes[1]["body"] == "deep" and quotes[2]["body"] == "tail"
    assert "tail" in own and "deep" not in own


@pytest.mark.parametrize(
    ("tag", "want"),
    [
        ("[quote=Bob @ Nov 4 2005, 07:37 PM]", ("Bob", "Nov 4 2005, 07:37 PM", None, None)),
        ("[quote=(Bob @ Nov 4 2005)]", ("Bob", "Nov 4 2005", None, None)),
        ('[quote="Bob, post: 12, member: 7"]', ("Bob", None, 12, 7)),
        ("[quote name='Bob' post='5' timestamp='1234']", ("Bob", None, 5, None)),
        ("[quote]", (None, None, None, None)),
        ("[quote=Bob wrote]", ("Bob", None, None, None)),
    ],
)
def test_attribution(tag, want):
    a = markup.attribution(tag)
    assert (a["author"], a["date"], a["post_ref"], a["user_ref"]) == want


@pytest.mark.parametrize(
    ("before", "after"),
    [
        ("[size=100]a[/size]", "a"),
        ("[size=50]a [size=100]b[/size][/size]", "[size=50]a b[/size]"),
        ("[size=100]open", "[size=100]open"),
        ("x[/size]", "x[/size]"),
    ],
)
def test_size_100(before, after):
    assert markup.drop_size_100(before) == after


def test_table_blocks():
    quote = "[table][tr][td][b]QUOTE[/b] (Al @ Nov 4 2005, 07:37 PM)[/td][/tr][tr][td]hi[/td][/tr][/table]"
    assert markup.tables_to_blocks(quote) == '[quote="Al" date="Nov 4 2005, 07:37 PM"]hi[/quote]'
    assert markup.tables_to_blocks("[table][tr][td][b]CODE[/b][/td][/tr][tr][td]x=1[/td][/tr][/table]") == "[code]x=1[/code]"
    other = "[table][tr][td]1[/td][td]2[/td][/tr][/table]"
    assert markup.tables_to_blocks(other) == other


@given(st.text(alphabet="[]/size=100quote b\n", max_size=80))
def test_fixes_are_idempotent(t):
    once = markup.tables_to_blocks(markup.drop_size_100(t))
    assert markup.tables_to_blocks(once) == once


def test_fix_applies_in_order(spark):
    posts = spark.createDataFrame([(1, "[color=RED'>]x[/color] [url='http://a.b']y[/url] [size=100]z[/size]"), (2, "plain"), (3, "[img]http://s/1.gif[/img][code][img]http://s/1.gif[/img][/code]")], "id long, source string")
    smilies = spark.createDataFrame([("http://s/1.gif", 7)], "url string, id long")
    got = {r["id"]: (r["fixed"], r["applied"]) for r in markup.fix(posts, smilies).collect()}
    assert got[1] == ("[color=RED]x[/color] [url=http://a.b]y[/url] z", ["attribute-leak", "quoted-url", "blocks"])
    assert got[2] == ("plain", [])
    assert got[3] == ("[ts:smiley=7][code][img]http://s/1.gif[/img][/code]", ["smilies"])


def test_html_round():
    assert markup.html_to_markup("<b>a</b><br>x <a href='http://u'>l</a><img src='http://i'><script>no</script>") == "[b]a[/b]\nx [url=http://u]l[/url][img]http://i[/img]"
    assert markup.html_to_markup('<span style="color:red">a</span><ul><li>1</li></ul>') == "[color=red]a[/color]\n[list][*]1[/list]"


def test_render():
    assert markup.render("[b]a[/b] <i> [nope]x[/nope]") == "<b>a</b> &lt;i&gt; [nope]x[/nope]"
    assert markup.render("[url=javascript:x]y[/url]").startswith("[url=javascript:x]y")
    assert markup.render("[b]open") == "[b]open"
    assert markup.render("[code][b]x[/b][/code]") == "<pre>[b]x[/b]</pre>"
    assert markup.render('[quote="Al"]hi[/quote]') == "<blockquote><cite>Al wrote:</cite>hi</blockquote>"
    assert markup.render("[ts:topic=5]t[/ts:topic]", {"ts:topic=5": "t5.html"}) == '<a href="t5.html">t</a>'


@given(st.text(alphabet="[]/bquotei=* \n<>&", max_size=60))
def test_render_never_breaks(t):
    out = markup.render(t)
    assert out.count("<b>") == out.count("</b>")


def test_names_and_text(spark):
    assert one(spark, text.name_key(F.col("x")), x="  A&amp;B \n c ") == "a&b c"
    assert one(spark, F.size(text.shingles(text.words(F.col("x")))), x="a b [b]c[/b] d a b c") == 4
    assert one(spark, F.size(text.shingles(text.words(F.col("x")))), x="a b") == 0
    assert one(spark, text.plain_text(F.col("x")), x="<p>a<script>b</script> &lt;c</p>") == "a <c"
    assert one(spark, text.clean_author(F.col("x")), x="Al  B posted on @") == "Al B"
    assert one(spark, text.exact_or_prefix(F.col("a"), F.col("b")), a="robert", b="rob") == 1


def test_dates(spark):
    got = one(spark, dates.quote_date(F.col("x")), x="name @  25, 2007 03:11 pm")
    assert (got["year"], got["month"], got["day"], got["hour"], got["minute"]) == (2007, None, 25, 15, 11)
    assert one(spark, dates.quote_date(F.col("x")), x="no date") is None
    t = lambda s: F.to_timestamp_ntz(F.lit(s))
    for quoted, posted, want in (("2005-06-15 12:00:00", "2005-06-15 12:00:00", 0), ("2005-06-15 07:00:00", "2005-06-15 12:00:00", -300), ("2005-06-15 12:31:00", "2005-06-15 07:00:00", 330), ("2005-06-15 12:20:00", "2005-06-15 12:00:00", None)):
        assert one(spark, dates.exact_offset(t(quoted), t(posted)), x=1) == want


def test_urls(spark):
    assert one(spark, urls.image_url(F.col("x")), x=" 'www.a.b/c.png#f' ") == "http://www.a.b/c.png"
    assert one(spark, urls.image_url(F.col("x")), x="ftp://a/b") is None
    assert one(spark, urls.capture_key(F.col("x")), x="HTTP://www.A.b:80/c%20d") == "a.b/c d"
    assert one(spark, urls.query_map(F.col("x")), x="http://h/i.php?A=1&amp;b=2&a=3") == {"b": "2", "a": "3"}
    assert one(spark, urls.folder_of(F.col("x")), x="http://h/a/b/c.gif") == "http://h/a/b/"
    assert one(spark, urls.normalize_url(F.col("x"), "http://board"), x="/s/1.gif") == "http://board/s/1.gif"


def test_file_kinds(spark):
    png = F.unhex(F.lit("89504E470D0A1A0A0000000049454E44AE426082"))
    assert one(spark, files.whole_image(png), x=1) is True
    assert one(spark, files.whole_image(F.unhex(F.lit("FFD8FF0000"))), x=1) is False
    assert one(spark, files.is_image(F.unhex(F.lit("3C68746D6C"))), x=1) is False


def test_links_of_one_hash_are_told_apart_by_their_pages(spark):
    """Two real queries whose twelve digits agree: each page keeps its own topic's."""
    queries = spark.createDataFrame([(i, f"showtopic={i}&st={st}") for i in (26000052806, 12000096415) for st in (0, 25, 50)], "id long, query string")
    asked = F.concat(F.lit("showtopic="), F.col("id").cast("string"), F.lit("&amp;st="), F.col("st"))
    links = spark.createDataFrame([(26000052806, "50"), (12000096415, "0")], "id long, st string").select("id", urls.query_hash(asked).alias("hash"))
    assert urls.query_candidates(queries).groupBy("hash").count().filter("count > 1").count() == 1
    assert {tuple(r) for r in urls.restored(links, queries, "id").select("id", "query").collect()} == {(26000052806, "showtopic=26000052806&st=50"), (12000096415, "showtopic=12000096415&st=0")}


def test_long_texts_move_in_small_batches(spark, capsys):
    """A task holds a hundred texts in Python, not an Arrow batch of 10,000."""
    posts = spark.createDataFrame([(1, "[b]x[/b] [size=100]y[/size] [img]http://a/1.gif[/img]"), (2, None)], "id long, source string")
    smilies = spark.createDataFrame([("http://a/1.gif", 11)], "url string, id long")
    fixed = markup.fix(posts, smilies).select("id", "fixed")
    for frame in (posts.select(markup.to_html("source")), posts.select(markup.to_markup("source")), posts.select(markup.own_text("source")), fixed):
        frame.explain()
        plan = capsys.readouterr().out
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert {r["id"]: r["fixed"] for r in fixed.collect()} == {1: "[b]x[/b] y [ts:smiley=11]", 2: None}
    assert [r[0] for r in posts.orderBy("id").select(markup.to_html("source")).collect()][1] is None
