"""Writes by primary key as pure projections: upsert, update, insert, replace."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def last_of_batch(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row a key: the last in ``order``.  One shuffle with map-side combination.

    An order by all columns holds each row once.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in rows.columns if c not in key]
    if rest and list(map(str, order)) == rest:
        last = F.max(F.struct(*rest))
    else:
        last = F.max_by(F.struct(*rest), F.struct(*(c.alias(f"o{i}") for i, c in enumerate(by))))
    picked = rows.groupBy(*key).agg(last.alias("r"))
    return picked.select(*(c if c in key else F.col(f"r.{c}").alias(c) for c in rows.columns))


def _same_key(a: DataFrame, b: DataFrame, key: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in key:
        same = same & (a[c] == b[f"__{c}"])
    return same


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """``new`` written over ``old``: only ``columns`` change, other columns of known keys survive.

    Rows of a batch that share a key: the last in ``order`` (all columns if none
    is given) wins.  Unknown keys are inserted with nulls elsewhere.
    """
    columns = [c for c in (columns or new.columns) if c not in key]
    batch = last_of_batch(new.select(*key, *columns, *(c for c in order or () if c not in columns and c not in key)), key, order or columns or key)
    batch = batch.select(*(F.col(c).alias(f"__{c}") for c in (*key, *columns)), F.lit(True).alias("__new"))
    both = old.join(batch, _same_key(old, batch, key), "full_outer")
    out = []
    for c in old.columns:
        if c in key:
            out.append(F.coalesce(old[c], F.col(f"__{c}")).alias(c))
        elif c in columns:
            out.append(F.when(F.col("__new"), F.col(f"__{c}")).otherwise(old[c]).alias(c))
        else:
            out.append(old[c])
    return both.select(*out)


def update(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """As ``upsert``, but keys that ``old`` lacks are ignored."""
    return upsert(old.withColumn("__old", F.lit(True)), new, key, columns).filter("__old").drop("__old")


def insert_numbered(old: DataFrame, new: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """``new`` appended with ids from max(id) + 1 on, in ``order``."""
    top = old.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("__top"))
    numbered = number_rows(new.drop(id_column), order, "__number").crossJoin(F.broadcast(top))  # one row
    return old.unionByName(numbered.withColumn(id_column, F.col("__top") + F.col("__number")).drop("__top", "__number"), allowMissingColumns=True)


def replace_groups(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Delete and rebuild: rows of every key that ``new`` holds are replaced by its rows."""
    return old.join(new.select(*key).distinct(), list(key), "left_anti").unionByName(new)


def number_rows(rows: DataFrame, order: Sequence[str], name: str, ranges: int = 48, most: int = 250_000) -> DataFrame:
    """Numbers 1.. by ascending columns without moving all rows into one task.

    Sampled values of the first column, some twenty a range, cut the order into
    ranges of about ``most`` rows, ``ranges`` at least and 4,096 at most; a row's
    number is its place in its range after the rows of the ranges before.  Nulls sort
    first, as in Spark.
    """
    first = F.col(order[0])
    values = rows.select(first.alias("v")).filter("v is not null")
    n = values.count()
    ranges = max(ranges, min(4096, math.ceil(n / most)))
    seen = sorted(r[0] for r in values.sample(min(1.0, 20.0 * ranges / max(n, 1)), seed=1).limit(100 * ranges).collect())
    cuts = sorted({seen[i * len(seen) // ranges] for i in range(1, ranges)}) if seen else []
    placed = rows.withColumn("__p", F.when(first.isNull(), -1).otherwise(_cuts_up_to(first, cuts, rows.schema[order[0]].dataType)))
    counts = placed.groupBy("__p").agg(F.count("*").alias("__c"))
    ahead = counts.select("__p", (F.sum("__c").over(Window.orderBy("__p")) - F.col("__c")).alias("__ahead"))
    within = placed.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy(*order)))
    return within.join(F.broadcast(ahead), "__p").withColumn(name, F.col("__n") + F.col("__ahead")).drop("__p", "__n", "__ahead")


def _cuts_up_to(value: Column, cuts: Sequence, kind: T.DataType) -> Column:
    """How many of the ascending cuts lie at or below a value: first which group of cuts, then which of the group.

    Counting them is the same whenever it is evaluated.
    """
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts) - 1) + 1
    listed = lambda some: F.array(*(F.lit(c).cast(kind) for c in some))
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    own, before, ahead = F, F, 0
    for g in groups:  # the first group that ends above the value; none: all cuts are below it
        here = value < F.lit(g[-1]).cast(kind)
        own, before, ahead = own.when(here, listed(g)), before.when(here, ahead), ahead + len(g)
    none = F.array().cast(T.ArrayType(kind))
    return before.otherwise(ahead) + F.size(F.filter(own.otherwise(none), lambda c: c <= value))
