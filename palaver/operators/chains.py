"""The longest chain of pairs that increases in both numbers, found over blocks.

Places by the first number and ranks by the second cut the plane into tiles of
``block`` places and ranks.  A tile needs two things of the tiles before it: the
tops of the piles that end among its ranks (from the tile of earlier places), and
the length of the best chain among lower ranks at each of its places (from the
tile of lower ranks).  Both have at most ``block`` entries.  The tiles of a
diagonal depend on the diagonal before only, so they are one round of tasks; there
are as many rounds as blocks on both sides, one for up to ``block`` pairs.

The chain is the one that patience sorting gives: from the last pair of the
greatest length back, always the last earlier pair that is one shorter.  Going
back takes one number from block to block.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.operators.shared import materialized
from palaver.operators.upsert import number_rows

#: Kinds of rows in a tile: pairs with their lengths, tops of piles by value, best lengths by place.
PAIR, TOPS, BEST = 0, 1, 2
_COLUMNS = "kind int, i long, j long, a long, b long, q long, length long, x array<long>, y array<long>"
_NAMES = [c.split()[0] for c in _COLUMNS.split(", ")]
_TYPES = {"int": pa.int32(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
_SCHEMA = pa.schema([(n, _TYPES[t]) for n, t in map(str.split, _COLUMNS.split(", "))])
#: Pairs whose numbers a tile has as Python's at once.
PIECE = 65_536


def _carried(table: pa.Table, kind: int) -> tuple[list[int], list[int]]:
    rows = table.filter(pc.equal(table["kind"], kind)).select(["x", "y"]).slice(0, 1)
    return (rows["x"][0].as_py(), rows["y"][0].as_py()) if len(rows) else ([], [])


def _rows(**columns) -> pa.Table:
    """Rows of a tile; columns that are not given are null."""
    n = len(columns["kind"])
    return pa.table([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(_SCHEMA.names, _SCHEMA.types, strict=True)], schema=_SCHEMA)


def _tile(table: pa.Table) -> pa.Table:
    """Lengths of a tile's pairs, and what the tiles behind and above it need.

    Pairs stay in Arrow's columns; of Python's numbers there are those of the tops,
    of the best lengths and of ``PIECE`` pairs at once.
    """
    values, lengths = _carried(table, TOPS)
    places, best = _carried(table, BEST)
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    pairs = table.filter(pc.equal(table["kind"], PAIR)).select(["a", "b", "q"]).sort_by("q")
    found, at, below = np.zeros(len(pairs), dtype=np.int64), 0, 0
    steps, rises, most = [], [], 0

    def risen(q: int, length: int) -> None:
        nonlocal most
        if length > most:
            steps.append(q)
            rises.append(length)
            most = length

    risen(-1, lengths[-1] if lengths else 0)
    for start in range(0, len(pairs), PIECE):
        piece = pairs.slice(start, PIECE)
        for n, (q, b) in enumerate(zip(piece["q"].to_pylist(), piece["b"].to_pylist(), strict=True), start):
            while at < len(places) and places[at] <= q:
                risen(places[at], best[at])
                below, at = best[at], at + 1
            k = bisect.bisect_left(values, b)
            length = max(lengths[k - 1] if k else 0, below) + 1
            end = k
            while end < len(values) and lengths[end] <= length:
                end += 1
            if end > k or k == len(values) or values[k] != b:
                values[k:end], lengths[k:end] = [b], [length]
            found[n] = length
            risen(q, length)
    for q, length in zip(places[at:], best[at:], strict=True):
        risen(q, length)
    same = lambda x: np.full(len(pairs), x)
    out = _rows(kind=same(PAIR), i=same(i), j=same(j), a=pairs["a"].combine_chunks(), b=pairs["b"].combine_chunks(), q=pairs["q"].combine_chunks(), length=found)
    return pa.concat_tables([out, _rows(kind=[TOPS, BEST], i=[i, i], j=[j, j], x=[values, steps], y=[lengths, rises])])


def chain_lengths(pairs: DataFrame, block: int) -> tuple[DataFrame, int]:
    """i (block of places), q, a, b, length of the best chain that ends with each pair; and the number of blocks."""
    rows = pairs.select(F.col(pairs.columns[0]).cast("long").alias("a"), F.col(pairs.columns[1]).cast("long").alias("b")).filter("a is not null and b is not null").distinct()
    rows = number_rows(rows.withColumn("down", -F.col("b")), ["a", "down"], "q").drop("down")
    ranks = number_rows(rows.select("b").distinct(), ["b"], "rank")
    tile = lambda c: F.floor((F.col(c) - 1) / block).cast("long")
    rows = rows.join(ranks, "b").select(F.lit(PAIR).alias("kind"), tile("q").alias("i"), tile("rank").alias("j"), "a", "b", "q", F.lit(None).cast("long").alias("length"), F.lit(None).cast("array<long>").alias("x"), F.lit(None).cast("array<long>").alias("y"))
    rows = materialized(rows.withColumn("diagonal", F.col("i") + F.col("j")), "chain-pairs", "diagonal")
    size = rows.agg(F.max("i").alias("i"), F.max("j").alias("j")).first()
    if size["i"] is None:
        return rows.select("i", "q", "a", "b", "length"), 0
    state, lengths = None, []
    for diagonal in range(size["i"] + size["j"] + 1):
        tiles = rows.filter(F.col("diagonal") == diagonal).select(*_NAMES)
        if state is not None:
            tops = state.filter(F.col("kind") == TOPS).withColumn("i", F.col("i") + 1).filter(F.col("i") <= size["i"])
            best = state.filter(F.col("kind") == BEST).withColumn("j", F.col("j") + 1).filter(F.col("j") <= size["j"])
            tiles = tiles.unionByName(tops).unionByName(best)
        state = materialized(tiles.groupBy("i").applyInArrow(_tile, _COLUMNS), "chain-diagonal")
        lengths.append(state.filter(F.col("kind") == PAIR).select("i", "q", "a", "b", "length"))
    found = lengths[0]
    for more in lengths[1:]:
        found = found.unionByName(more)
    return materialized(found, "chain-lengths", "i"), size["i"] + 1


def _back_from(wanted: int):
    """A block's part of the chain, which is to have ``wanted`` pairs up to the block's end."""

    def taken(frame: pd.DataFrame) -> pd.DataFrame:
        out, left = [], wanted
        for a, b, length in frame.sort_values("q", ascending=False)[["a", "b", "length"]].itertuples(index=False):
            if length == left:
                out.append((a, b))
                left -= 1
        return pd.DataFrame(out, columns=["a", "b"])

    return taken


def longest_chain(pairs: DataFrame, block: int = 1_000_000) -> DataFrame:
    """The pairs (two whole-number columns) of the longest chain that increases in both."""
    names = pairs.columns[:2]
    lengths, blocks = chain_lengths(pairs, block)
    if not blocks:
        return lengths.select(F.col("a").alias(names[0]), F.col("b").alias(names[1]))
    wanted = lengths.agg(F.max("length")).first()[0]
    chain = None
    for i in reversed(range(blocks)):
        part = materialized(lengths.filter(F.col("i") == i).groupBy("i").applyInPandas(_back_from(wanted), "a long, b long"), "chain")
        chain = part if chain is None else chain.unionByName(part)
        wanted -= part.count()
        if not wanted:
            break
    return chain.select(F.col("a").alias(names[0]), F.col("b").alias(names[1]))
