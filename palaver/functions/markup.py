"""Board markup: quotes with their bodies, repairs, HTML to markup and markup to HTML.

Small per-text helpers; all grouping and joining around them is Spark's.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable
from html import escape
from html.parser import HTMLParser
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.functions.attribution import attribution, opening_tag, unquoted
from palaver.functions.text import text_function

# Quotes

#: Tags that open or close a quote or a code block; what lies between two of them is text.
_TAGS = re.compile(r"\[(/?)(quote|code)\b([^\]\n]*)\]", re.I)


def parse_quotes(text: str) -> tuple[list[dict], str]:
    """The quotes of a text in opening order, and the text outside of closed ones.

    One walk over the tags: text goes to the innermost open quote, or to the post's
    own words.  Unclosed quotes run to the end and, like their text, stay the
    post's own; stray closing tags are left out.
    """
    quotes: list[dict] = []
    open_: list[dict] = []
    own: list[str] = []
    at = 0

    def text_until(end: int) -> None:
        (open_[-1]["pieces"] if open_ else own).append(text[at:end])

    code_ends = [m.start() for m in _TAGS.finditer(text) if m[1] and m[2].lower() == "code"]
    skip = 0  # tags inside of a closed code block are its text
    for m in _TAGS.finditer(text):
        closing, kind = bool(m[1]), m[2].lower()
        if m.start() < skip:
            continue
        if kind == "code":
            i = bisect.bisect_left(code_ends, m.end())
            if not closing and i < len(code_ends):
                skip = code_ends[i] + 1
        elif closing and not m[3]:
            if open_:
                text_until(m.start())
                at = m.end()
                open_.pop()["closed"] = True
        elif not closing and (not m[3] or m[3][0] in "= \t"):
            text_until(m.start())
            at = m.end()
            quote = attribution(m[0]) | {"position": len(quotes), "level": len(open_) + 1, "parent": open_[-1]["position"] if open_ else None, "pieces": [], "closed": False, "start": m.start()}
            quotes.append(quote)
            open_.append(quote)
    text_until(len(text))
    if open_:  # an unclosed outer quote may well hold the post's own words
        own.append(text[open_[0]["start"] :])
    for q in quotes:
        q["body"] = " ".join(q.pop("pieces"))
    return quotes, " ".join(own)


@text_function
def own_text(text: str | None) -> str | None:
    """A text without its closed quotes."""
    return parse_quotes(text)[1] if text is not None else None


# Repairs

#: The patterns of the simple repairs.  They stay inside Spark's expressions.
SIMPLE = (
    ("attribute-leak", r"\[(\w+)=([^\]\n]*?)'>\]", "[$1=$2]"),
    ("quoted-url", r"(?i)\[url='([^'\[\]\n]*)'\]", "[url=$1]"),
    ("quoted-img", r"(?i)\[img\]'([^'\[\]\n]*)'\[/img\]", "[img]$1[/img]"),
)
_SIZE = re.compile(r"\[size=([^\]\n]*)\]|\[/size\]", re.I)
_TABLE = re.compile(r"\[/?table\]")
def _pairs(text: str, tags: re.Pattern, closing: Callable[[str], bool], rewrite: Callable[[str, str, str], str]) -> str:
    """Rewrite well-formed pairs from the inside out, with a stack of open tags."""
    stack: list[tuple[str, list[str]]] = [("", [])]
    at = 0
    for m in tags.finditer(text):
        stack[-1][1].append(text[at : m.start()])
        at = m.end()
        if not closing(m[0]):
            stack.append((m[0], []))
        elif len(stack) > 1:
            tag, inner = stack.pop()
            stack[-1][1].append(rewrite(tag, "".join(inner), m[0]))
        else:
            stack[-1][1].append(m[0])
    stack[-1][1].append(text[at:])
    while len(stack) > 1:  # never closed: stays as it is
        tag, inner = stack.pop()
        stack[-1][1].append(tag + "".join(inner))
    return "".join(stack[0][1])


def drop_size_100(text: str) -> str:
    return _pairs(text, _SIZE, lambda t: t[1] == "/", lambda tag, inner, end: inner if tag[6:-1].strip() == "100" else tag + inner + end)


def _single_cells(rows: str) -> list[str] | None:
    """The cells of a table whose rows have one cell each; None for any other."""
    begin, between, end = "[tr][td]", "[/td][/tr][tr][td]", "[/td][/tr]"
    if not (rows.startswith(begin) and rows.endswith(end)) or len(rows) < len(begin) + len(end):
        return None
    cells = rows[len(begin) : -len(end)].split(between)
    return None if any(mark in c for c in cells for mark in ("[tr]", "[/td]")) else cells


def tables_to_blocks(text: str) -> str:
    """Two-row tables headed QUOTE or CODE to tags; tables of other shapes stay."""

    def rewrite(tag: str, inner: str, end: str) -> str:
        cells = _single_cells(inner) or []
        if len(cells) == 2:
            (head, body), title = cells, cells[0][: len("[b]QUOTE[/b]")]
            if title == "[b]QUOTE[/b]" and not set("[]") & set(head[len(title) :]):
                return f"{opening_tag(head[len(title) :])}{body}[/quote]"
            if head.rstrip() == "[b]CODE[/b]" and "[/code]" not in body.lower():
                return f"[code]{body}[/code]"
        return tag + inner + end

    return _pairs(text, _TABLE, lambda t: t[1] == "/", rewrite)


def sentinel(tag: Column) -> Column:
    """struct(id, attributes) of a sentinel tag such as ``ts:topic=5 start=20``; attributes that are whole numbers only."""
    id_ = F.regexp_extract(tag, r"^[\w:-]*=(\d+)", 1).try_cast("long")
    pairs = F.filter(F.split(F.trim(tag), r"\s+"), lambda p: p.rlike(r"^\w+=\d+$"))
    entries = F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1).alias("key"), F.substring_index(p, "=", -1).cast("long").alias("value")))
    return F.struct(id_.alias("id"), F.map_from_entries(entries).alias("attributes"))


def percent(share: Column) -> Column:
    """A share as a whole percentage, at most 100, halves to even."""
    return F.bround(100 * F.least(share, F.lit(1.0)), 0).cast("long")


_CODE = re.compile(r"(\[code\b[^\]]*\].*?\[/code\])", re.I | re.S)
_IMG = re.compile(r"\[img\]\s*([^\[\]\s]+)\s*\[/img\]", re.I)


def images_to_ids(text: str, ids: dict[str, int], tag: str = "ts:smiley") -> str:
    """[img]url[/img] with a known url to a tag with its id, outside of code."""
    one = lambda m: f"[{tag}={ids[m[1]]}]" if m[1] in ids else m[0]
    return "".join(p if i % 2 else _IMG.sub(one, p) for i, p in enumerate(_CODE.split(text)))


@text_function
def _structural(text: str | None) -> str | None:
    if text is None:
        return None
    if "=100]" in text:
        text = drop_size_100(text)
    return tables_to_blocks(text) if "[b]QUOTE[/b]" in text or "[b]CODE[/b]" in text else text


@text_function
def _with_ids(text: str | None, urls: list[str] | None, ids: list[int] | None) -> str | None:
    return images_to_ids(text, dict(zip(urls, ids, strict=True))) if text is not None and urls else text


def fix_simple(x: Column) -> Column:
    for _, pattern, new in SIMPLE:
        x = F.regexp_replace(x, pattern, new)
    return x


def fix(posts: DataFrame, smilies: DataFrame | None = None, text: str = "source") -> DataFrame:
    """posts with ``fixed`` and ``applied``; texts that need no structural repair skip Python.

    ``smilies`` (url, id): a text's image urls are joined to it, so that a row
    carries the few ids it needs.
    """
    x = F.col(text)
    out, applied = x, []
    for name, pattern, new in SIMPLE:
        after = F.regexp_replace(out, pattern, new)
        applied.append(F.when(after != out, name))
        out = after
    df = posts.withColumn("__a", out).withColumn("__names", F.array_compact(F.array(*applied)))
    needs = F.col("__a").contains("=100]") | F.col("__a").contains("[b]QUOTE[/b]") | F.col("__a").contains("[b]CODE[/b]")
    df = df.withColumn("__b", F.when(needs, _structural(F.col("__a"))).otherwise(F.col("__a")))
    df = df.withColumn("__names", F.when(F.col("__b") != F.col("__a"), F.concat("__names", F.array(F.lit("blocks")))).otherwise(F.col("__names")))
    if smilies is not None:
        used = df.filter(F.col("__b").ilike("%[img]%") & ~F.col("__b").contains("[ts:")).select("id", F.explode(F.array_distinct(F.regexp_extract_all("__b", F.lit(r"(?i)\[img\]\s*([^\[\]\s]+)\s*\[/img\]"), F.lit(1)))).alias("url"))
        found = used.join(smilies.select("url", F.col("id").alias("__sid")), "url").groupBy("id").agg(F.collect_list(F.struct("url", "__sid")).alias("__s"))
        df = df.join(found, "id", "left")
        changed = F.when(F.col("__s").isNotNull(), _with_ids(F.col("__b"), F.col("__s.url"), F.col("__s.__sid"))).otherwise(F.col("__b"))
        df = df.withColumn("__c", changed)
        df = df.withColumn("__names", F.when(F.col("__c") != F.col("__b"), F.concat("__names", F.array(F.lit("smilies")))).otherwise(F.col("__names"))).withColumn("__b", F.col("__c")).drop("__s", "__c")
    return df.withColumn("fixed", F.col("__b")).withColumn("applied", F.col("__names")).drop("__a", "__b", "__names")


# HTML to markup

_WRAP = {"b": "b", "strong": "b", "i": "i", "em": "i", "u": "u", "s": "s", "strike": "s", "del": "s", "sup": "sup", "sub": "sub", "center": "center", "table": "table", "tr": "tr", "td": "td", "th": "td", "li": None, "code": "code", "pre": "code"}


class _Reader(HTMLParser):
    """Collects markup; a stack remembers what each element's end must write."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.ends: list[tuple[str, str]] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "br":
            self.out.append("\n")
        elif tag == "hr":
            self.out.append("[hr]")
        elif tag == "img":
            if a.get("src"):
                self.out.append(f"[img]{a['src']}[/img]")
        elif tag in ("script", "style"):
            self.ends.append((tag, ""))
        else:
            begin = end = ""
            style = {k.strip().lower(): v.strip() for k, _, v in (p.partition(":") for p in (a.get("style") or "").split(";")) if v}
            if tag == "a" and a.get("href"):
                begin, end = f"[url={a['href']}]", "[/url]"
            elif tag == "blockquote":
                name = a.get("cite")
                begin, end = f'[quote="{name}"]' if name else "[quote]", "[/quote]"
            elif tag in ("ul", "ol"):
                begin, end = "[list]" if tag == "ul" else "[list=1]", "[/list]"
            elif tag == "li":
                begin = "[*]"
            elif tag in ("span", "font"):
                for key, name in (("color", "color"), ("font-size", "size"), ("font-family", "font")):
                    value = style.get(key) or (a.get(name) if tag == "font" else None)
                    if value:
                        begin, end = begin + f"[{name}={value}]", f"[/{name}]" + end
            elif tag in ("div", "p") and (style.get("text-align") or a.get("align")) == "center":
                begin, end = "[center]", "[/center]"
            elif _WRAP.get(tag):
                begin, end = f"[{_WRAP[tag]}]", f"[/{_WRAP[tag]}]"
            if tag in ("div", "p", "blockquote", "ul", "ol") and self.out and not self.out[-1].endswith("\n"):
                begin = "\n" + begin
            self.out.append(begin)
            self.ends.append((tag, end))

    def handle_endtag(self, tag):
        while any(t == tag for t, _ in self.ends):
            t, end = self.ends.pop()
            self.out.append(end)
            if t == tag:
                break

    def handle_data(self, data):
        if not any(t in ("script", "style") for t, _ in self.ends):
            self.out.append(re.sub(r"\s+", " ", data.replace("\xa0", " ")) if not any(t == "pre" for t, _ in self.ends) else data)


def html_to_markup(html: str) -> str:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    for _, end in reversed(reader.ends):
        reader.out.append(end)
    return re.sub(r" *\n *", "\n", "".join(reader.out)).strip()


@text_function
def to_markup(html: str | None) -> str | None:
    return html_to_markup(html) if html is not None else None


# Markup to HTML

_TAG = re.compile(r"\[(/?)([a-z*][a-z0-9*:-]*)(=[^\]\n]*|(?: [^\]\n]*))?\]", re.I)
_PLAIN = {"b": "b", "i": "i", "u": "u", "s": "s", "sup": "sup", "sub": "sub", "table": "table", "tr": "tr", "td": "td"}
DEEPEST = 250


def safe_url(url: str) -> str | None:
    parts = urlsplit(url.strip())
    return url.strip() if parts.scheme.lower() in ("http", "https", "ftp", "mailto") or (not parts.scheme and url.startswith("/")) else None


def _open_html(name: str, value: str) -> tuple[str, str] | None:
    """Begin and end of a tag's HTML; None if the tag is to stay literal."""
    if name in _PLAIN:
        return f"<{_PLAIN[name]}>", f"</{_PLAIN[name]}>"
    if name == "center":
        return '<div style="text-align:center">', "</div>"
    if name == "quote":
        who = attribution(f"[quote={value}]")["author"] if value else None
        head = f"<cite>{escape(who)} wrote:</cite>" if who else ""
        return f"<blockquote>{head}", "</blockquote>"
    if name == "spoiler":
        return f"<details><summary>{escape(value or 'Spoiler')}</summary>", "</details>"
    if name == "color" and re.fullmatch(r"#?[A-Za-z0-9]+", value):
        return f'<span style="color:{value}">', "</span>"
    if name == "size" and re.fullmatch(r"\d+", value):
        return f'<span style="font-size:{min(max(int(value), 50), 300)}%">' if int(value) > 40 else f'<span style="font-size:{max(8, int(value))}px">', "</span>"
    if name == "font" and re.fullmatch(r"[\w ,'-]+", value):
        return f'<span style="font-family:{escape(value)}">', "</span>"
    if name == "url" and value and safe_url(value):
        return f'<a href="{escape(safe_url(value))}">', "</a>"
    if name == "list":
        return ("<ol>", "</ol>") if value else ("<ul>", "</ul>")
    return None


def render(text: str, links: dict[str, str] | None = None) -> str:
    """Markup as HTML; unknown, unclosed and invalid tags stay text.

    ``links`` maps sentinels such as 'ts:topic=12' to addresses.
    """
    links = links or {}
    stack: list[tuple[str, str, str, list[str], str]] = [("", "", "", [], "")]  # name, literal, begin, pieces, end
    at = 0

    def add(s: str) -> None:
        stack[-1][3].append(s)

    def plain(s: str) -> str:
        return escape(s).replace("\n", "<br>\n")

    def close_literal() -> None:
        _, literal, _, pieces, _ = stack.pop()
        add(plain(literal) + "".join(pieces))

    for m in _TAG.finditer(text):
        if m.start() < at:
            continue
        add(plain(text[at : m.start()]))
        at = m.end()
        name, value = m[2].lower(), unquoted((m[3] or "").lstrip("= ").strip())
        if m[1]:
            if any(s[0] == name for s in stack[1:]):
                while stack[-1][0] != name:
                    close_literal()
                _, _, begin, pieces, end = stack.pop()
                add(begin + "".join(pieces) + end)
            else:
                add(plain(m[0]))
        elif name in ("code", "img", "email") or (name == "url" and not value):
            stop = re.compile(re.escape(f"[/{name}]"), re.I).search(text, at)
            inner = text[at : stop.start()] if stop else ""
            shown = None
            if stop and name == "code":
                shown = f"<pre>{escape(inner)}</pre>"
            elif stop and safe_url(inner if name != "email" else f"mailto:{inner}"):
                target = escape(inner.strip())
                shown = {"img": f'<img src="{target}" alt="">', "url": f'<a href="{target}">{target}</a>', "email": f'<a href="mailto:{target}">{target}</a>'}[name]
            if shown is None:
                add(plain(m[0]))
            else:
                add(shown)
                at = stop.end()
        elif name == "hr":
            add("<hr>")
        elif name == "*" and any(s[0] == "list" for s in stack[1:]):
            add("<li>")
        elif name.startswith("ts:"):
            key = f"{name}={value.split(' ')[0]}"
            if name in ("ts:topic", "ts:forum", "ts:attachment-link"):
                stack.append((name, m[0], f'<a href="{escape(links[key])}">' if key in links else "", [], "</a>" if key in links else ""))
            else:
                add(f'<img src="{escape(links[key])}" alt="">' if key in links else f"<span class=\"lost\">{escape(key)}</span>")
        else:
            html = _open_html(name, value) if len(stack) <= DEEPEST else None
            if html is None:
                add(plain(m[0]))
            else:
                stack.append((name, m[0], html[0], [], html[1]))
    add(plain(text[at:]))
    while len(stack) > 1:
        close_literal()
    return "".join(stack[0][3])


@text_function
def to_html(text: str | None) -> str | None:
    return render(text) if text is not None else None
