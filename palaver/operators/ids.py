"""Stable ids: known urls keep theirs, new ones continue in a fixed order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assign_ids(known: DataFrame, found: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """``found`` with an ``id``: the known one, else max + 1 onwards by ``order``.

    Distinct keys of one site's files number at most some hundred thousand; the
    rank runs over keys and their order columns alone.
    """
    known = known.select(F.col(key).alias("__key"), F.col("id").alias("__id"))
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    joined = found.join(known, F.col(key) == F.col("__key"), "left")
    top = known.agg(F.coalesce(F.max("__id"), F.lit(0)).alias("__top"))
    fresh = F.row_number().over(Window.partitionBy(F.col("__id").isNull()).orderBy(*by))
    out = joined.withColumn("__n", fresh).crossJoin(F.broadcast(top))  # one row
    return out.withColumn("id", F.coalesce("__id", F.col("__top") + F.col("__n"))).drop("__key", "__id", "__n", "__top")
