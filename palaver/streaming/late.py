"""Late data: tables kept by appending batches, of which only the keys that a batch touches are worked out again.

What arrives is appended under its batch's number, so a batch that is repeated
replaces itself.  A result is not folded into the one before: for every touched key
all its rows are read again and the result is written as that key's next version.
The rows of a key are a set, and the rules order them by when they were captured,
so batches may come in any order and any number of times.  Folders are cut into
buckets by key; a batch reads the buckets it touches and writes its own rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from palaver.operators.history import newest_text

BUCKETS = 256


class KeyedLog:
    """Rows by batch and bucket of their key, in one folder."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType | str, key: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.key, self.buckets = spark, folder.rstrip("/"), key, buckets
        self.schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, batch: int, folder: str = "batch") -> None:
        names = [f.name for f in self.schema.fields]
        seen = F.col("seen") if "seen" in rows.columns else F.lit(0)
        rows.select(*names, seen.cast("long").alias("seen"), self.bucket().alias("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{folder}={batch}")

    def _whole(self, folder: str) -> list[int]:
        at = self._path(self.folder)
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{folder}=") and self._fs.exists(self._path(f"{self.folder}/{n}/_SUCCESS")))

    def batches(self) -> list[int]:
        """Numbers of the batches that were written whole; a compaction that was cut short is finished first."""
        for newest in self._whole("compacted"):
            for n in self._whole("batch"):
                if n <= newest:
                    self._fs.delete(self._path(f"{self.folder}/batch={n}"), True)
            self._fs.rename(self._path(f"{self.folder}/compacted={newest}"), self._path(f"{self.folder}/batch={newest}"))
        return self._whole("batch")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows with their ``batch``, and ``seen``; those of some buckets without reading others."""
        done = self.batches()
        whole = T.StructType([*self.schema.fields, T.StructField("seen", T.LongType()), T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())])
        if not done:
            return self.spark.createDataFrame([], whole).drop("bucket")
        rows = self.spark.read.schema(whole).option("basePath", self.folder).parquet(*(f"{self.folder}/batch={n}" for n in done))
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin([int(b) for b in buckets]))
        return rows.drop("bucket")

    def latest(self, *more: str) -> DataFrame:
        """The newest version of each key: the one that was worked out from most rows."""
        rest = [*(f.name for f in self.schema.fields if f.name != self.key), *more]
        return self.read().groupBy(self.key).agg(F.max_by(F.struct(*rest), F.struct("seen", "batch")).alias("r")).select(self.key, *(f"r.{c}" for c in rest))

    def compact(self) -> None:
        """Each key's newest version under the newest batch's number; the folders before it go."""
        done = self.batches()
        if len(done) > 1:
            self.write(self.latest("seen"), done[-1], "compacted")
            self.batches()


def apply_batch(log: KeyedLog, results: KeyedLog, batch: DataFrame, number: int, compute: Callable[[DataFrame], DataFrame]) -> None:
    """Append a batch and write the results of the keys that it touches, from all their rows."""
    log.write(batch, number)
    touched = batch.select(log.key).distinct()
    buckets = [r[0] for r in touched.select(log.bucket().alias("b")).distinct().collect()]  # at most BUCKETS numbers
    whole = log.read(buckets)
    rows = whole.join(touched, log.key, "left_semi").drop("batch", "seen")
    seen = whole.groupBy(log.key).agg(F.count("*").alias("seen"))  # reads the keys alone
    results.write(compute(rows).join(seen, log.key), number)


def follow(source: DataFrame, log: KeyedLog, results: KeyedLog, compute: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Apply what is new in a stream and stop; a batch that is run again writes the same."""

    def batch(rows: DataFrame, number: int) -> None:
        rows.persist()
        try:
            apply_batch(log, results, rows, number + 1, compute)
        finally:
            rows.unpersist()

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# Rules

#: Fixed value: attributes whose addresses a lossy copy changes.
_ADDRESSES = r"""\b(href|src|action)=(?:"[^"]*"|'[^']*')"""


def kept_posts(copies: DataFrame) -> DataFrame:
    """post_id, html, edited_at, topic_id, forum_id, edited: each post from all its copies.

    ``copies``: post_id, captured_at, file, edited_at, html, filtered, lossy, topic_id,
    forum_id.  The latest edit stamp decides (none is the earliest).  Among its copies
    the first counts, whatever it is; then each whole one replaces what is kept, and a
    lossy one only if it differs by more than what such copies lose; filtered ones
    never do.  So the kept copy is the last whole one, or the first of the last run of
    lossy ones that look alike after it.  Where the post lies is the latest copy's.
    """
    rows = copies.withColumn("at", F.struct(F.col("captured_at").isNotNull().alias("known"), "captured_at", "file", "html"))
    place, along = Window.partitionBy("post_id"), Window.partitionBy("post_id").orderBy("at")
    stamp = F.struct(F.col("edited_at").isNotNull().alias("known"), "edited_at")
    rows = rows.filter(F.length("html") > 0).withColumn("stamp", stamp)
    # Some stamp is above all before it if the greatest is above the first.  Only copies of that stamp are put in order.
    last = {f"last_{c}": F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("at", c))).over(place) for c in ("topic_id", "forum_id")}
    rows = rows.withColumns({"top": F.max("stamp").over(place), "edited": F.max("stamp").over(place) > F.min_by("stamp", "at").over(place), **last})
    top = rows.filter("stamp = top").withColumn("n", F.row_number().over(along))
    whole = (F.col("n") == 1) | ~F.coalesce("lossy", F.lit(False))
    top = top.filter((F.col("n") == 1) | ~F.coalesce("filtered", F.lit(False))).withColumn("base", F.max(F.when(whole, F.col("n"))).over(place)).filter("n >= base")
    form = F.regexp_replace(F.regexp_replace("html", r"[^\x00-\x7F]", ""), _ADDRESSES, "$1=")
    top = top.withColumn("form", form)
    changed = (F.col("n") == F.col("base")) | (F.col("form") != F.lag("form").over(along))
    kept = top.withColumn("changed", changed).filter("changed").groupBy("post_id").agg(F.max_by(F.struct("html", "edited_at", F.col("last_topic_id").alias("topic_id"), F.col("last_forum_id").alias("forum_id"), "edited"), "n").alias("r"))
    return kept.select("post_id", "r.*")


def members_from(blocks: DataFrame, fields: Sequence[str]) -> DataFrame:
    """member_id, name and the fields of each member, from author blocks and profiles.

    ``blocks``: member_id, captured_at, posted_at, file, filtered, lossy, profile, name,
    signature and the fields.  The latest capture's block wins (of pages of unknown
    date the latest post's), field by field, as ``newest_text`` has it; the name is
    the first seen; a profile's signature counts only if no block has one.
    """
    order = ["captured_at", "posted_at", "file"]
    at = F.struct(*(x for c in order for x in (F.col(c).isNotNull().alias(f"k_{c}"), F.col(c))))
    out = blocks.groupBy("member_id").agg(F.min_by("name", F.when(F.length("name") > 0, at)).alias("name"))
    seen = blocks.filter("not profile")
    for c in fields:
        out = out.join(newest_text(blocks.select("member_id", *order, F.col(c).cast("string").alias(c), "filtered", "lossy"), ["member_id"], order, c, "filtered", "lossy"), "member_id", "left")
    own = newest_text(seen.select("member_id", *order, "signature", "filtered", "lossy"), ["member_id"], order, "signature", "filtered", "lossy")
    shown = blocks.filter("profile").groupBy("member_id").agg(F.min_by("signature", F.when(F.length("signature") > 0, at)).alias("__profile"))
    out = out.join(own, "member_id", "left").join(shown, "member_id", "left")
    return out.withColumn("signature", F.coalesce("signature", "__profile")).drop("__profile")
