"""Set algebra between two sources of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def presence(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, in_a, in_b: one shuffle over the stacked keys; null keys do not count."""
    both = a.select(F.col(key).alias("key"), F.lit(True).alias("a"), F.lit(False).alias("b")).unionByName(b.select(F.col(key).alias("key"), F.lit(False).alias("a"), F.lit(True).alias("b")))
    return both.filter("key is not null").groupBy("key").agg(F.bool_or("a").alias("in_a"), F.bool_or("b").alias("in_b"))


def six_counts(a: DataFrame, b: DataFrame, key: str, label: str, shown: Column | None = None) -> DataFrame:
    """One row: shown, in A, in B, only in A, only in B, in both."""
    a_, b_ = F.col("in_a"), F.col("in_b")
    return presence(a, b, key).agg(
        F.count_if(shown if shown is not None else a_ | b_).alias("shown"),
        F.count_if(a_).alias("n_a"),
        F.count_if(b_).alias("n_b"),
        F.count_if(a_ & ~b_).alias("only_a"),
        F.count_if(b_ & ~a_).alias("only_b"),
        F.count_if(a_ & b_).alias("both"),
    ).select(F.lit(label).alias("label"), "*")


def union(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of a that b lacks; null keys are in neither."""
    return a.select(key).filter(F.col(key).isNotNull()).distinct().join(b.select(key), key, "left_anti")


def intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key), key, "left_semi")


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return presence(a, b, key).filter("in_a <> in_b").select(F.col("key").alias(key), F.when(F.col("in_a"), "a").otherwise("b").alias("side"))


def among(rows: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """The rows whose key the other frame has."""
    return rows.join(chosen.select(key).distinct(), key, "left_semi")
