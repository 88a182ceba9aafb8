"""Dumps of a board's pages: flat folders, hashed files with a manifest, snapshots by time.

All three become one layout - file_id, captured_at, content, source - of which
``merge_dumps`` keeps each capture once, oldest first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palaver.functions.dates import capture_time

#: From this day on captures show filtered text.
FILTERED_FROM = "2012-03-01"


def page_text(content: Column) -> Column:
    """Bytes as text: cp1252; what it does not define reads as Latin-1."""
    return F.coalesce(F.try_validate_utf8(F.decode(content, "windows-1252")), F.decode(content, "ISO-8859-1"))


def read_flat(spark: SparkSession, folder: str) -> DataFrame:
    """File names are URLs with ? as _; no capture times."""
    files = spark.read.format("binaryFile").load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(F.try_url_decode(name).alias("file_id"), F.lit(None).cast("timestamp_ntz").alias("captured_at"), "content", F.col("length").alias("size"), F.lit("flat").alias("source"))


def read_hashed(spark: SparkSession, folder: str, manifest: str) -> DataFrame:
    """Files named by the first twelve hex digits of their query's SHA-256; a JSON manifest lists [timestamp, url]."""
    files = spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", r"([^/.]+)(?:\.[^/]*)?$", 1).alias("hash"), "content", F.col("length").alias("size"))
    listed = spark.read.text(manifest, wholetext=True).select(F.explode(F.from_json("value", "array<array<string>>")).alias("r"))
    known = listed.select(capture_time(F.col("r")[0]).alias("captured_at"), F.col("r")[1].alias("url"))
    query = F.regexp_extract("url", r"\?(.*)$", 1)
    known = known.withColumn("hash", F.substring(F.sha2(query, 256), 1, 12))
    newest = known.groupBy("hash").agg(F.max_by("url", "captured_at").alias("file_id"), F.max("captured_at").alias("captured_at"))
    return files.join(newest, "hash").select("file_id", "captured_at", "content", "size", F.lit("hashed").alias("source"))


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """<timestamp>/<file id> below the folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    stamp, name = F.regexp_extract("path", r"/(\d{14})/([^/]+)$", 1), F.regexp_extract("path", r"/(\d{14})/([^/]+)$", 2)
    return files.filter(stamp != "").select(F.try_url_decode(name).alias("file_id"), capture_time(stamp).alias("captured_at"), "content", F.col("length").alias("size"), F.lit("snapshots").alias("source"))


def claimed_snapshots(listed: DataFrame, snapshots: DataFrame) -> DataFrame:
    """timestamp, file_id, url of downloaded files (timestamp, file_id); url is null where no snapshot explains one.

    ``snapshots``: timestamp, file_id, url; of several addresses with one id the least
    counts.  A name that the downloader made in another way is the one snapshot of its
    time that no file claims, if it is the one such name.
    """
    known = snapshots.groupBy("timestamp", "file_id").agg(F.min("url").alias("url"))
    files = listed.select("timestamp", "file_id").distinct()
    both = files.withColumn("__file", F.lit(1)).join(known, ["timestamp", "file_id"], "full_outer")
    odd = F.col("url").isNull()
    free = F.col("__file").isNull()
    left = both.groupBy("timestamp").agg(F.count_if(odd).alias("__odd"), F.count_if(free).alias("__free"), F.min(F.when(free, F.col("url"))).alias("__url"))
    found = both.filter("`__file` = 1").join(left, "timestamp")
    forced = odd & (F.col("__odd") == 1) & (F.col("__free") == 1)
    return found.select("timestamp", "file_id", F.when(forced, F.col("__url")).otherwise(F.col("url")).alias("url"))


def layout_of(paths: DataFrame, manifest: str) -> str:
    """'flat', 'hashed' or 'snapshots', from the paths (relative, column path) below a dump's folder.

    A dump without its manifest is flat; folders named by 14 digits hold snapshots.
    """
    stamped = F.col("path").rlike(r"^\d{14}/")
    seen = paths.agg(F.bool_or(F.col("path") == manifest).alias("listed"), F.bool_or(stamped).alias("stamped")).first()  # one row
    return "flat" if not seen["listed"] else "snapshots" if seen["stamped"] else "hashed"


def decoded(x: Column) -> Column:
    """An address without percent codes, however often it was encoded; what is no code stays."""
    once = lambda t: F.coalesce(F.try_url_decode(F.replace(F.regexp_replace(t, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))), t)
    # Each pass takes one level of codes away, and a text has no more levels than codes.
    return F.aggregate(F.sequence(F.lit(0), F.regexp_count(x, F.lit("%"))), x, lambda t, _: once(t))


def merge_dumps(dumps: list[DataFrame]) -> DataFrame:
    """Each capture once: snapshots before flat files of the same size before hashed copies of the same time."""
    every = reduce(lambda a, b: a.unionByName(b), dumps)
    rank = F.when(F.col("source") == "snapshots", 0).when(F.col("source") == "flat", 1).otherwise(2)
    ranked = every.withColumn("__r", rank)
    snaps = ranked.filter("__r = 0")
    flat = ranked.filter("__r = 1").join(snaps.select("file_id", "size"), ["file_id", "size"], "left_anti")
    hashed = ranked.filter("__r = 2").join(snaps.select("file_id", "captured_at"), ["file_id", "captured_at"], "left_anti").join(flat.select("file_id", "size"), ["file_id", "size"], "left_anti")
    kept = snaps.unionByName(flat.select(*snaps.columns)).unionByName(hashed.select(*snaps.columns))
    return kept.withColumn("filtered", filtered(F.col("captured_at"))).drop("__r")


def captures_of(x: Column) -> Column:
    """The captures that a JSON list gives: time, address and size each."""
    return F.from_json(x, "array<struct<timestamp:string,original:string,length:bigint>>")


def filtered(captured_at: Column) -> Column:
    """Whether a copy was made after the board's word filter came."""
    return F.coalesce(captured_at >= F.lit(FILTERED_FROM).cast("timestamp_ntz"), F.lit(False))


def page_of(file_id: Column, query: Column) -> Column:
    """struct(path, kind): where a downloaded file lies and what page it is; null if it is not worth reading.

    ``query`` is the map of the address's query string.
    """
    from palaver.functions.urls import archive_position, page_kind

    lite = file_id.rlike(r"^a/[^/]+$") & archive_position(file_id)["topic"].isNotNull()

    def page(path: Column, kind: Column) -> Column:
        return F.struct(path.alias("path"), kind.alias("kind"))

    return (
        F.when(~file_id.contains("/") & file_id.startswith("index__q"), page(file_id, page_kind(query)))
        .when(file_id == "a/members", page(F.lit("a/members/index.html"), F.lit("archive-members")))
        .when(lite, page(file_id, F.lit("archive-topic")))
        .when(file_id.isin("", "index.php"), page(F.when(file_id == "", "index.html").otherwise(file_id), F.lit("other")))
    )


def oldest_first(captures: DataFrame) -> DataFrame:
    """Captures of each file numbered from the oldest; undated ones come first."""
    w = Window.partitionBy("file_id").orderBy(F.asc_nulls_first("captured_at"), "source")
    return captures.withColumn("place", F.row_number().over(w))
