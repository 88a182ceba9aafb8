"""The board model over the star-schema test tables.

Each board table is one portable SELECT over the driver's Parquet tables, so that
the same definition serves Spark and the checking SQL.  Everything on top of these
tables is built twice and independently: with DataFrame operators here, with plain
SQL in the checks.
"""

from __future__ import annotations

import contextlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations", "embeddings")

#: name -> (tables it reads, SELECT); lens tables may read earlier ones.
LENS: dict[str, tuple[tuple[str, ...], str]] = {
    "forums": (("region", "nation"), """
        SELECT CAST(1000 + r_regionkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id, r_name AS name FROM {region}
        UNION ALL
        SELECT CAST(n_nationkey + 1 AS BIGINT), CAST(1000 + n_regionkey AS BIGINT), n_name FROM {nation}"""),
    "users": (("customer", "orders"), """
        SELECT c.c_custkey AS id, c.c_name AS name, c.c_mktsegment AS group_name, CAST(c.c_nationkey + 1 AS BIGINT) AS forum_id, j.joined_at AS joined_at
        FROM {customer} c LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS joined_at FROM {orders} GROUP BY o_custkey) j ON j.o_custkey = c.c_custkey"""),
    "topics": (("orders", "customer"), """
        SELECT o.o_orderkey AS id, CAST(c.c_nationkey + 1 AS BIGINT) AS forum_id, o.o_custkey AS user_id,
               o.o_orderpriority = '1-URGENT' AS stickied, o.o_orderstatus = 'F' AS locked,
               CASE o.o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS has_poll,
               CAST(floor(o.o_totalprice) AS BIGINT) AS view_count, CAST(o.o_orderkey % 7 AS BIGINT) AS post_count, o.o_orderdate AS listed_at
        FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey"""),
    "post_rows": (("lineitem",), """
        SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id, l_orderkey AS topic_id, l_suppkey AS user_id, CAST(l_linenumber AS BIGINT) AS post_index,
               l_shipdate AS posted_at, l_partkey AS part_id, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
               l_returnflag AS flag, l_linestatus AS status
        FROM {lineitem}"""),
    "state": (("orders",), """
        SELECT concat('topic-posts:', CAST(o_orderkey AS STRING)) AS key, CASE o_orderstatus WHEN 'F' THEN 'done' ELSE CAST(o_orderkey % 50 AS STRING) END AS value
        FROM {orders} WHERE o_orderstatus <> 'O'
        UNION ALL
        SELECT concat('post-gap:', CAST(o_orderkey AS STRING), ':', CAST(o_orderkey % 9 AS STRING)), 'error' FROM {orders} WHERE o_orderkey % 97 = 0
        UNION ALL
        SELECT concat('poll:', CAST(o_orderkey AS STRING)), 'missing' FROM {orders} WHERE o_orderkey % 31 = 0"""),
    "polls": (("orders",), """
        SELECT o_orderkey AS topic_id, concat('[{{"text":"yes","votes":', CAST(o_custkey % 11 AS STRING), '}},{{"text":"no","votes":', CAST(o_orderkey % 13 AS STRING), '}}]') AS options,
               CAST(1 + o_orderkey % 3 AS BIGINT) AS max_options
        FROM {orders} WHERE o_orderstatus <> 'F' AND o_orderkey % 5 <> 0"""),
    "files": (("part",), """
        SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN 'file' WHEN 1 THEN 'image' ELSE 'link' END AS kind, concat('http://', lower(p_brand), '.example/', CAST(p_partkey AS STRING)) AS url,
               lower(p_brand) AS host, CASE WHEN p_size % 10 = 9 THEN NULL ELSE CAST(p_size % 5 AS BIGINT) END AS uses,
               CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_name END AS data, CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_partkey END AS first_post_id,
               CASE p_size % 7 WHEN 0 THEN 'missing' WHEN 1 THEN NULL ELSE 'kept' END AS status,
               CAST(p_size % 3 AS BIGINT) AS signature_uses, CAST(p_partkey % 4 AS BIGINT) AS post_uses
        FROM {part}"""),
    "second_forums": (("nation",), """
        SELECT CAST(n_nationkey + 4 AS BIGINT) AS id, n_name AS name FROM {nation} WHERE n_nationkey % 5 <> 0"""),
    "second_topics": (("orders",), """
        SELECT o_orderkey AS id, o_orderpriority AS title, o_orderdate AS started_at, o_orderkey % 3 = 0 AS pinned, o_orderkey % 4 = 0 AS question
        FROM {orders} WHERE o_orderkey % 4 <> 3
        UNION ALL
        SELECT o_orderkey + 10000000, 'lost', o_orderdate, FALSE, FALSE FROM {orders} WHERE o_orderkey % 50 = 1"""),
    "markup_posts": (("pages",), """
        SELECT page_id AS id, CAST(page_id % 20 AS BIGINT) AS topic_id, html AS content,
               CASE WHEN page_id % 6 <> 0 THEN concat('see [img]', url, '[/img] and [IMG] http://smile.example/', CAST(page_id % 5 AS STRING), '.gif [/IMG] [img]http://smile.example/',
                    CAST(page_id % 3 AS STRING), '.gif[/img] [quote=Al]x[/quote]') END AS source,
               CASE WHEN page_id % 4 = 0 THEN concat('[img]http://smile.example/', CAST(page_id % 7 AS STRING), '.gif[/img] fixed') END AS source_fixed
        FROM {pages}"""),
    "signatures": (("customer",), """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN concat('[img]http://sig.example/', CAST(c_custkey % 9 AS STRING), '.png[/img]') END AS signature_fixed,
               CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END AS signature_source, CASE WHEN c_custkey % 5 = 0 THEN c_name ELSE '' END AS signature
        FROM {customer}"""),
    "quoting": (("documents", "customer", "orders"), """
        SELECT d.doc_id AS post_id, CAST(d.n_chars % 100 AS BIGINT) AS topic_id, substr(md5(c.c_name), 1, 10) AS author, o.o_orderdate AS quoted_at, d.n_chars % 3 = 0 AS nested,
               concat('[quote="', substr(md5(c.c_name), 1, 10), '" date="', CAST(o.o_orderdate AS STRING), '"]', CASE WHEN d.n_chars % 3 = 0 THEN '[quote=Al]deep[/quote]' ELSE '' END, d.text, '[/quote] I agree [b]fully[/b] &amp; <br> ',
                 CASE d.n_chars % 11 WHEN 0 THEN '[b]open' WHEN 1 THEN '[i]x[/i][/u] [sarcasm]' WHEN 2 THEN '[table][tr][td][b]QUOTE[/b] (Al @ Nov 4 2005, 07:37 PM)[/td][/tr][tr][td]hi[/td][/tr][/table]'
                   WHEN 3 THEN concat('[color=RED', chr(39), '>]x[/color]') WHEN 4 THEN concat('[img]', chr(39), 'http://a.example/1.gif', chr(39), '[/img]') WHEN 5 THEN concat('[url=', chr(39), 'http://a.example', chr(39), ']u[/url]') WHEN 6 THEN '[size=100]x[/size]'
                   WHEN 7 THEN '(IMG:style_emoticons/smile.gif) <!--emo&:)--> [sarcasm]' WHEN 8 THEN '[url=/attach/1]f[/url] [spoiler=]s[/spoiler]' WHEN 9 THEN 'metanet.2.forumer.com/index.php?showtopic=7 [quote=Bo, Nov 4 2005]' ELSE '[list][*]1' END) AS source,
               d.text AS body
        FROM {documents} d JOIN {customer} c ON c.c_custkey = d.doc_id JOIN {orders} o ON o.o_orderkey = d.doc_id WHERE d.text IS NOT NULL"""),
    "nested_posts": (("documents",), """
        SELECT doc_id AS id, replace(replace(replace(replace(replace(replace(replace(replace(text, ' with ', ' [quote=Al] '), ' for ', ' [/quote] '), ' as ', ' [quote] '), ' at ', ' [CODE] '), ' be ', ' [/code] '),
               ' was ', ' [/quote] '), ' von ', ' [quote=Bo, Nov 4 2005] '), ' zu ', ' [/quote] ') AS source
        FROM {documents}"""),
    "linked_posts": (("documents",), """
        SELECT doc_id AS id, replace(replace(replace(replace(replace(replace(text,
               ' and ', concat(' [url=http://metanet.2.forumer.com/index.php?showtopic=', CAST(doc_id AS STRING), '&amp;st=', CAST(doc_id % 3 * 20 AS STRING), ']here[/url] ')),
               ' of ', concat(' (http://metanet.2.forumer.com/?showforum=', CAST(doc_id % 40 AS STRING), '). ')),
               ' is ', concat(' [url]http://www.metanet.forumer.com/index.php?act=ST&t=', CAST(doc_id + 1 AS STRING), '&view=findpost&p=', CAST(doc_id * 8 + 1 AS STRING), '[/url] ')),
               ' with ', ' [code] '), ' for ', ' [/CODE] '), ' on ', ' [img] http://metanet.2.forumer.com/?showtopic=1 [url=http://metanet.2.forumer.com/index.php?showtopic=7#entry33]x[/url] ') AS text
        FROM {documents} WHERE text IS NOT NULL"""),
    "copies": (("lineitem",), """
        SELECT l_partkey AS post_id, CASE WHEN l_linenumber < 7 THEN l_shipdate END AS captured_at, concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(floor(l_quantity) AS STRING)) AS file,
               CASE WHEN l_quantity >= 30 THEN CAST(floor(l_quantity / 10) AS BIGINT) END AS edited_at,
               CASE WHEN l_linenumber = 6 THEN '' ELSE concat('<a href="/', CAST(l_suppkey % 5 AS STRING), '">caf', CASE WHEN l_linestatus = 'O' THEN 'é' ELSE '' END, CAST(l_linenumber % 3 AS STRING), '</a>') END AS html,
               l_returnflag = 'A' AS filtered, l_linestatus = 'F' OR l_suppkey % 3 = 0 AS lossy, CASE WHEN l_linenumber <> 5 THEN l_orderkey END AS topic_id, CAST(l_suppkey % 9 AS BIGINT) AS forum_id
        FROM {lineitem}"""),
    "attachments": (("part",), """
        SELECT p_partkey AS id, concat('http://2.forumer.com/uploads/metanet/post-', CAST(p_partkey % 30 AS STRING), '-', CAST(1100000000 + p_partkey AS STRING), '.jpg') AS url FROM {part} WHERE p_partkey % 3 <> 0
        UNION ALL
        SELECT p_partkey, concat('http://metanet.2.forumer.com/index.php?act=Attach&type=post&id=', CAST(p_partkey AS STRING)) FROM {part} WHERE p_partkey % 3 = 0"""),
    "attaching_posts": (("documents",), """
        SELECT doc_id AS id, replace(replace(replace(replace(replace(replace(replace(text,
               ' and ', concat(' -----\n[url=/attach/ma/post-', CAST(doc_id % 30 AS STRING), '-', CAST(1100000000 + doc_id AS STRING), '.jpg]Click here to view the attachment[/url] ')),
               ' of ', concat(' [img]http://2.forumer.com/uploads/metanet/post-', CAST((doc_id + 1) % 30 AS STRING), '-', CAST(1100000001 + doc_id AS STRING), '.jpg[/img] ')),
               ' is ', concat(' [url=http://metanet.2.forumer.com/index.php?act=attach&amp;type=post&amp;id=', CAST(doc_id AS STRING), ']the file[/url] ')),
               ' to ', concat(' see 2.forumer.com/uploads/metanet/post-', CAST(doc_id % 30 AS STRING), '-', CAST(1100000000 + doc_id AS STRING), '.jpg, ')),
               ' with ', ' [code] '), ' for ', ' [/code] '), ' on ', ' [url] ') AS text
        FROM {documents} WHERE text IS NOT NULL"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or a lens table built from base tables."""
    if name == "posts":
        return posts(spark, sf_dir)
    if name not in LENS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs, text = LENS[name]
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in needs})


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts by key: of rows that share an id the last in full-row order stays, as in an upsert.

    The table is written once for each state of a session's input, and read by all
    queries; input that was written anew since is read anew.  Rows are dealt by id
    before they are compared: few rows of an id meet in one split of the input, and
    combining them there would sort all rows in tasks as large as the splits.
    """
    from palaver.operators.shared import materialized
    from palaver.operators.upsert import last_of_batch

    key = spark.sparkContext.applicationId, sf_dir, _state(spark, f"{sf_dir}/lineitem.parquet")
    if key in _written:
        with contextlib.suppress(AnalysisException):  # the folder may have been cleared
            return spark.read.parquet(_written[key])
    rows = table(spark, sf_dir, "post_rows")
    rest = [c for c in rows.columns if c != "id"]
    out = materialized(last_of_batch(rows.repartition("id"), ["id"], rest), "posts")
    _written[key] = os.path.dirname(out.inputFiles()[0])
    return out


def _state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Size, number of files and last change of a table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = fs.getContentSummary(at)
    return whole.getLength(), whole.getFileCount(), fs.getFileStatus(at).getModificationTime()


_written: dict[tuple, str] = {}


_POSTS_SQL = """SELECT * FROM post_rows QUALIFY row_number() OVER (PARTITION BY id ORDER BY topic_id DESC, user_id DESC, post_index DESC, posted_at DESC,
    part_id DESC, quantity DESC, price DESC, discount DESC, tax DESC, flag DESC, status DESC) = 1"""


def with_lens(sql: str, *names: str) -> str:
    """The checking SQL with the lens tables it names as CTEs in front."""
    wanted = []
    for name in names:
        if name == "posts" and "post_rows" not in wanted:
            wanted.append("post_rows")
        wanted.append(name)
    parts = []
    for name in wanted:
        if name == "posts":
            parts.append(f"posts AS ({_POSTS_SQL})")
        else:
            needs, text = LENS[name]
            parts.append(f"{name} AS ({text.format(**{n: n for n in needs})})")
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ", ".join(parts) + ", " + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + body[5:]
    return "WITH " + ", ".join(parts) + " " + body
