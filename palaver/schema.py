"""Logical tables of an archived discussion board, and schema evolution.

Tables are declared once, independent of any storage; ``evolve`` brings a stored
frame to its declaration: renamed columns move, dropped ones go, new ones come as
nulls, order and types as declared.  Nothing is ever inferred.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"long": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType(), "timestamp": T.TimestampNTZType(), "binary": T.BinaryType()}


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    required: frozenset[str] = frozenset()
    renamed: dict[str, str] = field(default_factory=dict, hash=False)
    dropped: frozenset[str] = frozenset()

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(n, _TYPES[t], n not in self.required) for n, t in self.columns])

    def ddl(self, path: str | None = None) -> str:
        """A CREATE TABLE statement for a Parquet table."""
        body = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}" for f in self.struct)
        at = f" LOCATION '{path}'" if path else ""
        return f"CREATE TABLE IF NOT EXISTS `{self.name}` ({body}) USING parquet{at}"


def _table(name: str, columns: str, key: str, **more) -> TableSpec:
    """``columns``: 'id long!, name string'; a ! marks a column that is never null."""
    pairs = [c.strip().split() for c in columns.split(",")]
    required = frozenset(n for n, t in pairs if t.endswith("!"))
    return TableSpec(name, tuple((n, t.rstrip("!")) for n, t in pairs), tuple(key.split()), required, **more)


_SPECS = [
    _table("forums", "id long!, parent_id long, name string!, description string, last_post_id long, post_count long, view_count long", "id"),
    _table("topics", "id long!, forum_id long!, user_id long, name string!, stickied boolean!, locked boolean!, created_at timestamp, post_count long, view_count long, last_post_id long, has_poll boolean", "id"),
    _table("posts", "id long!, topic_id long!, user_id long, index long!, timestamp timestamp, content string, source string, source_fixed string", "id"),
    _table("users", "id long!, name string!, rank string, joined_at timestamp, last_active_at timestamp, post_count long, signature string, signature_source string, signature_fixed string, avatar_url string, avatar_id long", "id"),
    _table("avatars", "id long!, user_id long!, data binary!", "id"),
    _table("groups", "id long!, name string", "id"),
    _table("group_users", "group_id long!, user_id long!", "group_id user_id"),
    _table("smilies", "id long!, url string!, name string, host string, uses long, content_type string, data binary, recovered_from string", "id"),
    _table("attachments", "id long!, kind string!, url string!, name string, old_forum_id long, uploaded_at timestamp, old_attach_id long, first_post_id long, uses long, content_type string, size long, data binary, recovered_from string", "id", renamed={"old_member_id": "old_forum_id"}),
    _table("embedded_images", "id long!, url string!, host string, used_in string, uses long, signature_uses long, post_uses long, live string, live_digest string, captures string, status string, note string, content_type string, size long, data binary, recovered_from string, captured_at timestamp, checked_at timestamp", "id"),
    _table("quotes", "post_id long!, position long!, level long!, parent_position long, author string, date string, quoted_post_id long, quoted_user_id long, match string, similarity long, tz_offset long", "post_id position"),
    _table("polls", "topic_id long!, title string, vote_count long, option_count long, max_options long, options string", "topic_id"),
    _table("crawl_state", "key string!, value string", "key"),
    _table("old_members", "old_id long!, name string, user_id long, match string, listed boolean, group_name string, title string, joined_at timestamp, post_count long, avatar_url string, country string, signature string, birthday string, location string, specific_location string, interests string, website string, msn string, aim string, yahoo string, icq string, integrity string", "old_id"),
    _table("old_forums", "id long!, name string, description string, parent_id long, category string, in_board boolean", "id"),
    _table("old_topics", "id long!, forum_id long, title string, description string, started_at timestamp, pinned boolean, has_poll boolean, alert boolean, question boolean, in_board boolean", "id", dropped=frozenset({"poll"})),
    _table("old_polls", "topic_id long!, title string, vote_count long, option_count long, max_options long, options string, source_file string", "topic_id"),
    _table("old_posts", "id long!, topic_id long, forum_id long, post_id long, match string, member_id long, author string, posted string, posted_at timestamp, html string, edited_by string, edited_at timestamp, source_file string", "id"),
    _table("old_attachments", "old_post_id long!, ref string!, kind string, name string, downloads long, attachment_id long, content_type string, data binary, source_file string", "old_post_id ref"),
    _table("archive_posts", "topic_id long!, position long!, author string, posted_on timestamp, html string, post_id long", "topic_id position"),
    _table("old_emoticons", "url string!, code string", "url"),
    _table("old_avatars", "old_id long!, url string, content_type string, data binary, recovered_from string", "old_id"),
]
TABLES: dict[str, TableSpec] = {t.name: t for t in _SPECS}


def register(spec: TableSpec) -> TableSpec:
    """Add a board's own table to the catalogue."""
    if spec.name in TABLES:
        raise ValueError(f"table {spec.name} exists")
    TABLES[spec.name] = spec
    return spec


def evolve(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A pure projection from a stored layout to the declared one."""
    have = set(df.columns)
    back = {new: old for old, new in spec.renamed.items()}
    out = []
    for name, kind in spec.columns:
        source = name if name in have else back.get(name)
        column = F.col(f"`{source}`") if source in have else F.lit(None)
        out.append(column.cast(_TYPES[kind]).alias(name))
    return df.select(*out)
