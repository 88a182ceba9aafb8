"""What becomes of an embedded image: the live file, an archived one, a stand-in, or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def decide(images: DataFrame) -> DataFrame:
    """status and note from live outcome, archived digests and known placeholders.

    ``images``: id, live ('image', 'gone', 'moved', 'dead' or null), live_digest,
    archived (a digest or null), placeholder_live, placeholder_archived (flags).
    A live image counts unless its file is its host's placeholder; then an archived
    image that is none; a live stand-in is better than nothing only if the archive
    never had another.
    """
    live = F.col("live") == "image"
    good_live = live & ~F.col("placeholder_live")
    good_old = F.col("archived").isNotNull() & ~F.col("placeholder_archived")
    status = F.when(F.col("live").isNull(), None).when(good_live & good_old & (F.col("archived") != F.col("live_digest")), "archived").when(good_live, "live").when(good_old, "archived").otherwise("missing")
    note = F.when(good_live & good_old & (F.col("archived") != F.col("live_digest")), "changed since").when(live & F.col("placeholder_live"), "placeholder").when(F.col("live") == "moved", "moved").when(F.col("live") == "dead", "host is gone")
    return images.select("id", status.alias("status"), F.when(status != "live", note).alias("note"))


def placeholders(captures: DataFrame, least: int = 3) -> DataFrame:
    """Digests that a host serves under ``least`` or more names."""
    return captures.groupBy("host", "digest").agg(F.count_distinct("name").alias("names")).filter(F.col("names") >= least).select("host", "digest")


def dead_hosts(outcomes: DataFrame, misses: int = 3) -> DataFrame:
    """Hosts with ``misses`` failures in a row: each host with the try at which it is given up.

    A try's run number changes with every success, so runs of failures are groups.
    """
    w = Window.partitionBy("host").orderBy("tried")
    runs = outcomes.withColumn("run", F.sum(F.when(F.col("ok"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    counted = runs.filter("not ok").withColumn("k", F.row_number().over(Window.partitionBy("host", "run").orderBy("tried")))
    return counted.filter(F.col("k") == misses).groupBy("host").agg(F.min("tried").alias("given_up"))
