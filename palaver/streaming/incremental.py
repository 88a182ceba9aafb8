"""Incremental ingest: new capture files merged into stored tables, once each.

The merges - most votes, flags seen, newest capture - do not depend on order and
give the same when repeated, so at-least-once batches have exactly-once results.
Tables are versions in folders; a pointer file names the current one, and a reader
never sees a half-written version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


class VersionedTable:
    """A Parquet table of which each write is a new folder."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType | str):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _current(self) -> int:
        at = self._path(f"{self.folder}/versions")
        if not self._fs.exists(at):
            return 0
        done = [s.getPath().getName() for s in self._fs.listStatus(at)]
        return max((int(n) for n in done if self._fs.exists(self._path(f"{self.folder}/versions/{n}/_SUCCESS"))), default=0)

    def read(self) -> DataFrame:
        n = self._current()
        if not n:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema if isinstance(self.schema, T.StructType) else T._parse_datatype_string(self.schema)).parquet(f"{self.folder}/versions/{n}")

    def write(self, df: DataFrame, version: int | None = None) -> None:
        """Write the next version; a repeated version overwrites its own folder only."""
        n = version or self._current() + 1
        df.write.mode("overwrite").parquet(f"{self.folder}/versions/{n}")


def merge_stream(source: DataFrame, table: VersionedTable, merge: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Merge what is new in ``source`` into ``table`` and stop; files already read stay read."""

    def batch(df: DataFrame, number: int) -> None:
        table.write(merge(table.read(), df))

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_flags(old: DataFrame, seen: DataFrame) -> DataFrame:
    """id, pinned, question: true once shown, false if only seen without."""
    both = old.unionByName(seen.select(*old.columns))
    flags = [c for c in old.columns if c != "id"]
    return both.groupBy("id").agg(*(F.bool_or(c).alias(c) for c in flags))


def merge_polls(old: DataFrame, new: DataFrame) -> DataFrame:
    """topic_id, votes, title, seen: the copy with most votes, of equals the first seen."""
    both = old.unionByName(new.select(*old.columns))
    rest = [c for c in old.columns if c != "topic_id"]
    picked = both.groupBy("topic_id").agg(F.max_by(F.struct(*rest), F.struct("votes", (-F.unix_micros(F.col("seen").cast("timestamp"))).alias("o"), F.col("title"))).alias("r"))
    return picked.select("topic_id", *(f"r.{c}" for c in rest))


def merge_latest(old: DataFrame, new: DataFrame, key: str = "id", time: str = "captured_at") -> DataFrame:
    """The newest capture of each key."""
    both = old.unionByName(new.select(*old.columns))
    rest = [c for c in old.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(time, *(c for c in rest if c != time))).alias("r")).select(*(c if c == key else F.col(f"r.{c}").alias(c) for c in old.columns))
