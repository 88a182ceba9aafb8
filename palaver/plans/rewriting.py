"""Queries of token-level work: nested quotes, links and attachments as tags, targets of links."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver.operators import brackets, tokens
from palaver.plans.registry import Board, query

# Nested quotes: the check walks each text with a stack.

_TAG = r"(?i)\[/?(?:quote|code)\b[^\]\n]*\]"
_WALK = rf"""
tok AS (SELECT id, unnest(range(len(g))) AS i, g, t FROM (SELECT id, regexp_split_to_array(source, '{_TAG}') AS g, regexp_extract_all(source, '{_TAG}') AS t FROM nested_posts WHERE source ILIKE '%[quote%')),
raw AS (SELECT id, i, g[i + 1] AS gap, t[i + 1] AS token FROM tok),
t AS (SELECT *, regexp_matches(token, '(?i)^\[code') AS co, coalesce(lower(token) = '[/quote]', FALSE) AS qc, regexp_matches(token, '(?i)^\[quote([= \t][^\]\n]*)?\]$') AS qo,
  min(i) FILTER (WHERE regexp_matches(token, '(?i)^\[/code')) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_end FROM raw),
walk AS (
  SELECT id, -1::BIGINT AS i, []::BIGINT[] AS stack, -1::BIGINT AS skip, 0::BIGINT AS opened, NULL::VARCHAR AS kind, NULL::BIGINT AS enclosing, 0::BIGINT AS before FROM (SELECT DISTINCT id FROM t)
  UNION ALL
  SELECT id, i, CASE kind WHEN 'open' THEN list_append(stack, opened) WHEN 'close' THEN stack[:-2] ELSE stack END, skip2, opened + CASE WHEN kind = 'open' THEN 1 ELSE 0 END, kind, stack[-1], len(stack) FROM (
    SELECT w.id, t.i, w.stack, w.opened, CASE WHEN t.i > w.skip AND t.co AND t.next_end IS NOT NULL THEN t.next_end ELSE w.skip END AS skip2,
           CASE WHEN t.i > w.skip AND t.qo THEN 'open' WHEN t.i > w.skip AND t.qc AND len(w.stack) > 0 THEN 'close' END AS kind
    FROM walk w JOIN t ON t.id = w.id AND t.i = w.i + 1) s
),
w AS (SELECT walk.*, t.gap, t.token, coalesce(count(walk.kind) OVER (PARTITION BY walk.id ORDER BY walk.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM walk JOIN t ON t.id = walk.id AND t.i = walk.i),
part AS (SELECT id, enclosing, part, string_agg(gap || CASE WHEN kind IS NULL THEN coalesce(token, '') ELSE '' END, '' ORDER BY i) AS piece FROM w GROUP BY ALL),
body AS (SELECT id, enclosing AS position, string_agg(piece, ' ' ORDER BY part) AS body FROM part GROUP BY ALL)"""


@query("w4_nested_quotes", "nested_posts", rf"""WITH RECURSIVE {_WALK}
SELECT w.id AS post_id, (w.opened - 1)::INTEGER AS position, (w.before + 1)::INTEGER AS level, w.enclosing::INTEGER AS parent,
  EXISTS (SELECT 1 FROM w c WHERE c.id = w.id AND c.i > w.i AND c.kind = 'close' AND c.before = w.before + 1) AS closed,
  CASE WHEN w.token LIKE '%Al%' THEN 'Al' WHEN w.token LIKE '%Bo%' THEN 'Bo' END AS author, md5(coalesce(body, '')) AS body_md5
FROM w LEFT JOIN body ON body.id = w.id AND body.position = w.opened - 1 WHERE w.kind = 'open'""")
def _(b: Board):
    found = brackets.quotes_of(b.nested_posts)
    return found.select("post_id", "position", "level", "parent", "closed", "author", F.md5("body").alias("body_md5"))


@query("z14_own_words", "nested_posts", rf"""WITH RECURSIVE {_WALK},
closed AS (SELECT o.id, o.i, EXISTS (SELECT 1 FROM w c WHERE c.id = o.id AND c.i > o.i AND c.kind = 'close' AND c.before = 1) AS closed FROM w o WHERE o.kind = 'open' AND o.before = 0),
cut AS (SELECT id, max(i) AS begin_at FROM closed WHERE NOT closed GROUP BY id),
rest AS (SELECT w.id, string_agg(CASE WHEN w.i = begin_at THEN '' ELSE gap END || coalesce(token, ''), '' ORDER BY w.i) AS piece FROM w JOIN cut ON w.id = cut.id AND w.i >= begin_at GROUP BY w.id)
SELECT body.id AS post_id, md5(body || CASE WHEN rest.piece IS NOT NULL THEN ' ' || rest.piece ELSE '' END) AS own_md5 FROM body LEFT JOIN rest ON rest.id = body.id WHERE position IS NULL""")
def _(b: Board):
    return brackets.own_words(brackets.quote_tags(b.nested_posts)).select(F.col("id").alias("post_id"), F.md5("text").alias("own_md5"))


@query("m11_quote_links", "nested_posts", rf"""WITH RECURSIVE {_WALK},
o AS (SELECT *, opened - 1 AS position FROM w WHERE kind = 'open' AND opened % 3 <> 0 AND id % 4 <> 1),
pairs AS (SELECT o.id, o.i, o.position, min(c.i) AS partner FROM o JOIN w c ON c.id = o.id AND c.i > o.i AND c.kind = 'close' AND c.before = o.before + 1 GROUP BY ALL),
changed AS (SELECT id, i, '[ts:quote=' || (id * 1000 + position) || ']' AS new FROM pairs UNION ALL SELECT id, partner, '[/ts:quote]' FROM pairs)
SELECT w.id AS post_id, md5(string_agg(gap || coalesce(new, token, ''), '' ORDER BY w.i)) AS text_md5 FROM w LEFT JOIN changed c ON c.id = w.id AND c.i = w.i GROUP BY w.id""")
def _(b: Board):
    """Linked quotes with their posts; two of three quotes of most posts were linked."""
    quotes = brackets.quotes_of(b.nested_posts)
    links = quotes.filter("(position + 1) % 3 <> 0 and post_id % 4 <> 1").select("post_id", "position", (F.col("post_id") * 1000 + F.col("position")).alias("quoted_post_id"))
    return brackets.anchored_quotes(b.nested_posts, links).select(F.col("id").alias("post_id"), F.md5("text").alias("text_md5"))


# Links and attachments


def _q(pattern: str) -> str:
    """A pattern as a SQL literal; RE2 reads it without Java's flag for Unicode classes."""
    return "'" + pattern.replace("(?isU)", "(?is)").replace("\\\"", '"').replace("'", "''") + "'"


def _tokens(name: str, source: str, pattern: str) -> str:
    p = _q(pattern)
    return f"""{name}x AS (SELECT id, unnest(range(len(g))) AS i, g, t FROM (SELECT id, regexp_split_to_array(text, {p}) AS g, regexp_extract_all(text, {p}) AS t FROM {source})),
{name} AS (SELECT id, i, g[i + 1] AS gap, t[i + 1] AS token FROM {name}x)"""


def _tagged(pattern: str) -> str:
    return f"coalesce(nullif(regexp_extract(token, {_q(rf'(?is)^\[url=({pattern})\].*\[/url\]$')}, 1), ''), regexp_extract(token, {_q(rf'(?is)^\[url\]({pattern})\[/url\]$')}, 1))"


def _bare(pattern: str) -> str:
    return f"rtrim(regexp_extract(token, {_q(rf'(?is)^({pattern})$')}, 1), '.,;:!?)')"


_LABEL = r"regexp_extract(token, '(?is)^\[url[^\]]*\](.*)\[/url\]$', 1)"


def _old(name: str, source: str, address: str, label: str, rest: str) -> str:
    get = lambda k: f"nullif(regexp_extract(q, '(?i)^(?:.*&)?{k}=([^&]*)', 1), '')"
    number = lambda v: f"CASE WHEN regexp_matches({v}, '^[0-9]+$') THEN {v}::BIGINT END"
    return f"""{name}a AS (SELECT *, {address} AS address FROM {source}),
{name}q AS (SELECT *, replace(address, '&amp;', '&') AS whole, regexp_extract(replace(address, '&amp;', '&'), '\\?([^#]*)', 1) AS q FROM {name}a),
{name}p AS (SELECT *, coalesce({get('showtopic')}, CASE WHEN lower({get('act')}) = 'st' THEN {get('t')} END) AS tp, coalesce({get('showforum')}, CASE WHEN lower({get('act')}) = 'sf' THEN {get('f')} END) AS fp,
  {get('st')} AS sp, coalesce(CASE WHEN lower({get('view')}) = 'findpost' THEN {get('p')} END, nullif(regexp_extract(whole, '^[^#]*#entry([0-9]+)$', 1), '')) AS pp FROM {name}q),
{name}n AS (SELECT *, {number('tp')} AS topic, CASE WHEN tp IS NULL THEN {number('fp')} END AS forum, nullif({number('sp')}, 0) AS start, {number('pp')} AS post FROM {name}p),
{name}h AS (SELECT n.*, CASE WHEN t.id IS NOT NULL THEN '[ts:topic=' || topic || coalesce(' start=' || start, '') || coalesce(' old_post=' || post, '') || ']' WHEN f.id IS NOT NULL THEN '[ts:forum=' || forum || ']' END AS tag,
  CASE WHEN t.id IS NOT NULL THEN '[/ts:topic]' ELSE '[/ts:forum]' END AS finish FROM {name}n n LEFT JOIN topics t ON t.id = n.topic LEFT JOIN forums f ON f.id = n.forum),
{name} AS (SELECT id, string_agg(gap || CASE WHEN tag IS NOT NULL THEN tag || {label} || finish || {rest} ELSE coalesce(token, '') END, '' ORDER BY i) AS text FROM {name}h GROUP BY id)"""


_T9 = f"""{_tokens('u', 'linked_posts', rf'{tokens._FLAGS}{tokens.CODE}|\[url={tokens.OLD_URL}\].*?\[/url\]|\[url\]{tokens.OLD_URL}\[/url\]')},
{_old('first', 'u', _tagged(tokens.OLD_URL), _LABEL, "''")},
{_tokens('v', 'first', f"{tokens._FLAGS}{tokens.CODE}|{tokens.pairs_of('url', 'img', 'ts:topic', 'ts:forum')}|{tokens.OLD_URL}")},
{_old('linked', 'v', _bare(tokens.OLD_URL), 'address', 'substr(token, length(address) + 1)')}"""


@query("t9_fix_old_links", "topics forums linked_posts", f"WITH {_T9} SELECT id, md5(text) AS text_md5, text LIKE '%[ts:%' AS linked FROM linked")
def _(b: Board):
    fixed = tokens.link_old_board(b.linked_posts, b.topics, b.forums)
    return fixed.select("id", F.md5("text").alias("text_md5"), F.col("text").contains("[ts:").alias("linked"))


@query("z23_link_targets", "posts topics forums linked_posts", f"""WITH {_T9},
old AS (SELECT id AS old_post, id AS post_id, topic_id FROM posts WHERE flag <> 'A'),
{_tokens('w', 'linked', r'(?i)\[ts:(?:topic|forum)=[^\]]*\]')},
r AS (SELECT *, nullif(regexp_extract(token, '(?i)^\\[ts:topic=([0-9]+)', 1), '')::BIGINT AS topic, nullif(regexp_extract(token, '(?i)^\\[ts:topic=.* old_post=([0-9]+)', 1), '')::BIGINT AS post,
  nullif(regexp_extract(token, '(?i)^\\[ts:forum=([0-9]+)', 1), '')::BIGINT AS forum FROM w WHERE token IS NOT NULL)
SELECT r.id, r.i::INTEGER AS i, CASE WHEN o.post_id IS NOT NULL THEN 'post' WHEN t.id IS NOT NULL THEN 'topic' ELSE 'forum' END AS kind, coalesce(o.post_id, t.id, f.id) AS target,
  CASE WHEN o.post_id IS NOT NULL THEN 't/' || o.topic_id || '.html#p' || o.post_id WHEN t.id IS NOT NULL THEN 't/' || t.id || '.html' ELSE 'f/' || f.id || '.html' END AS href
FROM r LEFT JOIN old o ON o.old_post = r.post LEFT JOIN topics t ON t.id = r.topic LEFT JOIN forums f ON f.id = r.forum WHERE coalesce(o.post_id, t.id, f.id) IS NOT NULL""")
def _(b: Board):
    """Tags that the repair of links makes, each with what it leads to: an old post before its topic."""
    texts = tokens.link_old_board(b.linked_posts, b.topics, b.forums)
    old = b.posts.filter("flag <> 'A'").select(F.col("id").alias("old_post"), F.col("id").alias("post_id"), "topic_id")
    return tokens.link_targets(texts, old, b.topics, b.forums)


def _file(name: str, source: str, address: str, new: str) -> str:
    """Rewrites of attachment references; addresses here have no port, escapes or doubled slashes."""
    return f"""{name}a AS (SELECT *, {address} AS address FROM {source}),
{name}q AS (SELECT *, replace(CASE WHEN address LIKE '%://%' THEN address ELSE 'http://' || address END, '&amp;', '&') AS whole FROM {name}a),
{name}c AS (SELECT *, CASE WHEN address = '' THEN NULL WHEN lower(address) LIKE '/attach/ma/%' THEN 'http://2.forumer.com/uploads/metanet/' || substr(address, 12)
  WHEN whole LIKE '%/uploads/%' THEN whole ELSE 'http://metanet.2.forumer.com/index.php?act=Attach&type=post&id=' || regexp_extract(whole, '[?&]id=([0-9]+)', 1) END AS url FROM {name}q),
{name} AS (SELECT c.id, string_agg(gap || CASE WHEN f.id IS NOT NULL THEN {new} ELSE coalesce(token, '') END, '' ORDER BY i) AS text FROM {name}c c LEFT JOIN attachments f ON f.url = c.url GROUP BY c.id)"""


_A = tokens.ATTACHED
_BLOCK_AT = rf"coalesce(nullif(regexp_extract(token, {_q(rf'(?is)^\[img\]({_A})\[/img\]$')}, 1), ''), regexp_extract(token, '(?is)\[url=(/attach/ma/[^\]\s]+)\]Click here to view the attachment\[/url\]$', 1))"
_LINK = "'[ts:attachment-link=' || f.id || ']' || {} || '[/ts:attachment-link]'"


@query("t8_fix_attachments", "attachments attaching_posts", f"""WITH {_tokens('u', 'attaching_posts', rf'{tokens._FLAGS}{tokens.CODE}|{tokens.BLOCK}|\[img\]{_A}\[/img\]')},
{_file('first', 'u', _BLOCK_AT, "'[ts:attachment' || CASE WHEN token ILIKE '[img]%' THEN '-image' ELSE '' END || '=' || f.id || ']'")},
{_tokens('v', 'first', rf'{tokens._FLAGS}{tokens.CODE}|\[url={_A}\].*?\[/url\]|\[url\]{_A}\[/url\]')},
{_file('second', 'v', _tagged(_A), _LINK.format(_LABEL))},
{_tokens('w', 'second', f"{tokens._FLAGS}{tokens.CODE}|{tokens.pairs_of('url', 'img', 'ts:attachment-link')}|{_A}")},
{_file('third', 'w', _bare(_A), _LINK.format('address') + ' || substr(token, length(address) + 1)')}
SELECT id, md5(text) AS text_md5, len(regexp_extract_all(text, '\\[ts:attachment')) AS n FROM third""")
def _(b: Board):
    fixed = tokens.link_attachments(b.attaching_posts, b.attachments)
    return fixed.select("id", F.md5("text").alias("text_md5"), F.regexp_count("text", F.lit(r"\[ts:attachment")).cast("long").alias("n"))
