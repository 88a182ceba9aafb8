"""Joins by name and by ownership between two sources of people."""

from __future__ import annotations

import functools
import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions.text import exact_or_prefix, let, ratio
from palaver.operators.shared import materialized

#: Ways to leave letters out of a name that it is joined by at most; names that have more are joined by their pieces.
WAYS = 1000
#: Names that a Python worker leaves letters out of at once.
SLICE = 1000


def name_pairs(asked: DataFrame, known: DataFrame, fuzzy: float | None = None) -> DataFrame:
    """Pairs of asked and known rows whose ``key`` agrees: score 2 exact, 1 prefix or alike.

    Equal keys are an equi-join.  For prefixes the longer name gives those of its
    prefixes whose length the score allows, a few each, and these are joined on the
    whole shorter name, whichever side it is on.  With ``fuzzy``, names whose share
    of matching characters reaches it are found by ``alike``.
    """
    a, b = asked.withColumnRenamed("key", "__a"), known.withColumnRenamed("key", "__b")
    names_a, names_b = a.select("__a").distinct(), b.select("__b").distinct()
    equal = names_a.join(names_b, F.col("__a") == F.col("__b")).select("__a", "__b")
    heads = equal
    for longer, shorter, long_name, short_name in ((names_a, names_b, "__a", "__b"), (names_b, names_a, "__b", "__a")):
        n = F.length(long_name)
        least = F.greatest(F.lit(3), F.ceil(n - n * 0.3 - 2).cast("int"))
        pieces = longer.filter(n > least).withColumn("__head", F.explode(F.transform(F.sequence(least, n - 1), lambda i: F.substr(F.col(long_name), F.lit(1), i))))
        heads = heads.unionByName(pieces.join(shorter, F.col("__head") == F.col(short_name)).select("__a", "__b"))
    scored = heads.withColumn("score", exact_or_prefix(F.col("__a"), F.col("__b"))).filter("score > 0")
    close = a.join(scored, "__a").join(b, "__b")
    if fuzzy is None:
        return close
    near = F.abs(F.length("__a") - F.length("__b")) <= F.greatest(F.length("__a"), F.length("__b")) * 0.3 + 2
    found = alike(names_a, names_b, fuzzy).filter(near & (F.least(F.length("__a"), F.length("__b")) >= 3))
    more = a.join(found, "__a").join(b, "__b").withColumn("score", F.lit(1))
    return close.unionByName(more.join(close.select("__a", "__b").distinct(), ["__a", "__b"], "left_anti").select(*close.columns))


def _needed(total: Column, least: float) -> Column:
    """Pairs of letters that two names of ``total`` letters share at least if their ratio is ``least``.

    At most u = (1 - least) * total letters match nothing, and u is odd if total is.
    The others lie in u + 1 runs at most, since an unmatched letter parts two runs,
    and a run of m letters has m - 1 pairs in common.
    """
    most = F.floor(total * (1 - least) + 1e-9).cast("int")
    unmatched = most - F.pmod(total - most, F.lit(2))
    return F.when(unmatched < 0, total).otherwise(F.floor((total - unmatched) / 2).cast("int") - unmatched - 1)


def _pieces(name: Column) -> Column:
    """Pairs of letters, numbered where a pair occurs again: sets that intersect like multisets."""

    def numbered(every: Column) -> Column:
        return F.transform(every, lambda g, i: F.concat(g, F.lit(":"), F.size(F.filter(F.slice(every, 1, i), lambda h: h == g)).cast("string")))

    pairs = F.transform(F.sequence(F.lit(1), F.length(name) - 1), lambda i: F.substr(name, i, F.lit(2)))
    return F.when(F.length(name) >= 2, let(pairs, numbered)).otherwise(F.array().cast("array<string>"))


def alike(names_a: DataFrame, names_b: DataFrame, least: float) -> DataFrame:
    """All pairs __a, __b of different names whose share of matching characters is at least ``least``."""
    return may_be_alike(names_a, names_b, least).filter(ratio("__a", "__b") >= least)


def may_be_alike(names_a: DataFrame, names_b: DataFrame, least: float) -> DataFrame:
    """Pairs __a, __b of different names, among them all whose share of matching characters is at least ``least``.

    Matching characters are a common subsequence, so of two alike names of n and m
    letters ``least * (n + m) / 2`` letters are left when some are left out of either:
    short names are joined on what is left, of which unlike names have next to none
    in common.  Pairs of longer names, for which there are more than ``WAYS`` ways to
    leave letters out, are met by pieces.  Names of less than three letters are alike
    to none.
    """
    if least < 0.8:
        raise ValueError("names are compared by ratios of 0.8 or more")
    spark = names_a.sparkSession
    sides = [d.filter(F.length(c) >= 3).select(F.col(c), F.length(c).alias(f"{c}_n")) for d, c in ((names_a, "__a"), (names_b, "__b"))]
    sizes = [materialized(d.select(f"{c}_n").distinct(), "name-lengths") for d, c in zip(sides, ("__a", "__b"), strict=True)]
    n, m = F.col("__a_n"), F.col("__b_n")
    lengths = sizes[0].join(F.broadcast(sizes[1]), F.abs(n - m) <= (n + m) * (1 - least) + 1e-9).withColumn("left", F.ceil((n + m) * least / 2 - 1e-9).cast("int"))
    short = F.broadcast(spark.createDataFrame(_short(least), "__a_n int, __b_n int"))
    few, many = lengths.join(short, ["__a_n", "__b_n"]), lengths.join(short, ["__a_n", "__b_n"], "left_anti")
    kept = [d.join(F.broadcast(few.select(f"{c}_n", "left").distinct()), f"{c}_n").select(F.col(c).alias("name"), "left") for d, c in zip(sides, ("__a", "__b"), strict=True)]
    by_left = [left_over(d).withColumnsRenamed({"name": c}) for d, c in zip(kept, ("__a", "__b"), strict=True)]
    met = by_left[0].join(by_left[1], ["left", "rest"]).filter((F.col("__a") != F.col("__b")) & (F.col("left") == F.ceil((F.length("__a") + F.length("__b")) * least / 2 - 1e-9)))
    longer = [d.join(F.broadcast(many.select(f"{c}_n").distinct()), f"{c}_n", "left_semi").select(c) for d, c in zip(sides, ("__a", "__b"), strict=True)]
    by_pieces = _by_pieces(*longer, least).withColumn("__a_n", F.length("__a")).withColumn("__b_n", F.length("__b")).join(short, ["__a_n", "__b_n"], "left_anti")
    return met.select("__a", "__b").distinct().unionByName(by_pieces.select("__a", "__b"))


def _short(least: float) -> list[tuple[int, int]]:
    """Lengths of two names of which either has few ways to leave out what need not match."""
    out = []
    for n, m in itertools.product(range(3, 64), repeat=2):
        left = math.ceil(least * (n + m) / 2 - 1e-9)
        if left <= min(n, m) and max(math.comb(n, left), math.comb(m, left)) <= WAYS:
            out.append((n, m))
    return out


@functools.lru_cache(maxsize=256)
def _choices(n: int, left: int) -> np.ndarray:
    """All choices of ``left`` of n places, a row each."""
    return np.array(list(itertools.combinations(range(n), left)), dtype=np.int64)


def _left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """name, left, rest: distinct hashes of what is left of a name, of ``left`` letters, when any others are left out."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            names, out = part["name"].to_pylist(), [None] * part.num_rows
            alike = defaultdict(list)  # names of one length that keep as many letters
            for row, (name, k) in enumerate(zip(names, part["left"].to_pylist(), strict=True)):
                alike[len(name), k].append(row)
            for (n, k), rows in alike.items():
                letters = np.frombuffer("".join(names[r] for r in rows).encode("utf-32-le"), "<u4").reshape(-1, n).astype(np.uint64)
                letters = (letters + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                letters ^= letters >> np.uint64(29)
                places, sums = _choices(n, k), np.zeros((len(rows), 1), np.uint64)
                for j in range(k):
                    sums = sums * np.uint64(0xD1342543DE82EF95) + letters[:, places[:, j]]
                for row, hashes in zip(rows, sums.view(np.int64), strict=True):
                    out[row] = np.unique(hashes)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
            yield pa.record_batch([part["name"], part["left"], pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out)))], names=["name", "left", "rest"])


def left_over(names: DataFrame) -> DataFrame:
    """name, left, rest for every row of ``names`` (name, left) and every way to keep ``left`` of its letters."""
    every = names.select("name", "left").mapInArrow(_left_over, "name string, left int, rest array<bigint>")
    return every.select("name", "left", F.explode("rest").alias("rest"))


def _by_pieces(names_a: DataFrame, names_b: DataFrame, least: float) -> DataFrame:
    """Pairs __a, __b of different names that may be alike by the pairs of letters they share, none left out.

    A prefix filter: pieces are ordered by how few names hold them; two names that
    share t pieces share one of their first n - t + 1 in that order.  So only rare
    pieces are joined on, a name's common ones never.  t is the proven bound for
    the shortest name that may be alike; below a ratio of 0.8 it may be 0, so that is
    an error.  Pairs are then held against the bound for their own lengths, and the
    rest are left to the caller to compare.
    """
    sides = [d.filter(F.length(c) >= 3).select(F.col(c).alias("name"), F.lit(c).alias("side")) for d, c in ((names_a, "__a"), (names_b, "__b"))]
    both = sides[0].unionByName(sides[1]).withColumn("pieces", _pieces(F.col("name"))).withColumn("n", F.length("name"))
    shortest = F.ceil(F.col("n") * least / (2 - least) - 1e-9).cast("int")
    longest = F.floor(F.col("n") * (2 - least) / least + 1e-9).cast("int")
    needed = F.array_min(F.transform(F.sequence(shortest, F.greatest(shortest, longest)), lambda m: _needed(F.col("n") + m, least)))
    both = materialized(both.withColumn("first", F.size("pieces") - F.greatest(needed, F.lit(1)) + 1), "name-pieces")
    each = both.select("side", "name", "first", "pieces", F.explode("pieces").alias("piece"))
    held = each.groupBy("piece").agg(F.count("*").alias("names"))
    ordered = each.join(held, "piece").withColumn("place", F.row_number().over(Window.partitionBy("side", "name").orderBy("names", "piece")))
    keys = ordered.filter(F.col("place") <= F.col("first"))
    a, b = (keys.filter(F.col("side") == c).select(F.col("name").alias(c), F.col("pieces").alias(f"{c}_pieces"), "piece") for c in ("__a", "__b"))
    la, lb = F.length("__a"), F.length("__b")
    met = a.join(b, "piece").filter((F.col("__a") != F.col("__b")) & (F.abs(la - lb) <= (la + lb) * (1 - least) + 1e-9))
    met = met.filter(F.size(F.array_intersect("__a_pieces", "__b_pieces")) >= _needed(la + lb, least))
    return met.select("__a", "__b").distinct()


def sole_owner(links: DataFrame, member: str, user: str) -> DataFrame:
    """member, user where all of a member's links name one user whom no other member has."""
    one = links.groupBy(member).agg(F.min(user).alias(user), F.max(user).alias("__max")).filter(F.col(user) == F.col("__max")).drop("__max")
    return one.groupBy(user).agg(F.min(member).alias(member), F.count("*").alias("__n")).filter("__n = 1").select(member, user)


def unique_names(rows: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose name nobody else in the source has: anchors of a linkage."""
    alone = rows.groupBy(key).agg(F.count("*").alias("__n")).filter("__n = 1").select(key)
    return rows.join(alone, key, "left_semi")
