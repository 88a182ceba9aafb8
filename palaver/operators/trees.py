"""Hierarchies of forums: closure, subtree totals, preorder, ways to the root.

Ways to the root grow by doubling: each round joins a forum's way to that of the
forum at its top, so a tree of any depth takes a logarithm of rounds.  Forums that
hang on a cycle have no root and are left out, as are the cycle's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.operators.shared import materialized

def paths(forums: DataFrame) -> DataFrame:
    """id, name, depth, path (ids from the top down) and sort_path of every reachable forum."""
    parents = forums.select(F.col("id").alias("__p")).distinct()
    every = forums.join(parents, F.col("parent_id") == F.col("__p"), "left").select("id", F.col("__p").alias("top"))
    done = every.filter("top is null").select("id", F.array("id").alias("path"))
    open_ = every.filter("top is not null").select("id", F.array("top", "id").alias("path"))
    finished = done
    while True:
        # A way that ends at a root is complete; the others go on by their top's own way.
        top = F.get("path", F.lit(0))
        further = finished.unionByName(open_).select(F.col("id").alias("__top"), F.col("path").alias("__way"))
        longer = open_.withColumn("__top", top).join(further, "__top").select("id", F.concat("__way", F.slice("path", F.lit(2), F.size("path") - 1)).alias("path"))
        longer = materialized(longer.filter(F.size(F.array_distinct("path")) == F.size("path")), "forum-ways")
        roots = done.select(F.col("id").alias("__root"))
        whole = longer.join(roots, F.get("path", F.lit(0)) == F.col("__root"), "left_semi")
        finished = finished.unionByName(whole)
        open_ = longer.join(roots, F.get("path", F.lit(0)) == F.col("__root"), "left_anti")
        if open_.isEmpty():
            break
    out = finished.join(forums.select("id", "name"), "id")
    key = F.array_join(F.transform("path", lambda i: F.lpad(i.cast("string"), 19, "0")), "/")
    return out.select("id", "name", (F.size("path") - 1).alias("depth"), "path", key.alias("sort_path"))


def closure(forums: DataFrame) -> DataFrame:
    """ancestor, id: every forum with itself and all its ancestors."""
    return paths(forums).select(F.explode("path").alias("ancestor"), "id")


def subtree_totals(forums: DataFrame, counts: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Sums over each forum's subtree.

    ``measures`` maps a column of ``counts`` to 'sum' (missing counts as 0),
    'absorb' (any null makes the total null) or 'max'.
    """
    joined = closure(forums).join(counts, "id", "left")
    made = []
    for name, how in measures.items():
        if how == "absorb":
            made.append(F.when(F.bool_or(F.col(name).isNull()), None).otherwise(F.sum(name)).alias(name))
        elif how == "max":
            made.append(F.max(name).alias(name))
        else:
            made.append(F.sum(F.coalesce(name, F.lit(0))).alias(name))
    return joined.groupBy(F.col("ancestor").alias("id")).agg(*made)


def crumbs(forums: DataFrame) -> DataFrame:
    """id and the names from the top to it, joined by ' > '."""
    steps = paths(forums).select("id", F.posexplode("path").alias("pos", "step"))
    named = steps.join(forums.select(F.col("id").alias("step"), F.col("name").alias("step_name")), "step")
    return named.groupBy("id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "step_name"))), lambda x: x["step_name"]), " > ").alias("crumbs"))


def flatten_tree(spark: SparkSession, answers: DataFrame, column: str = "tree") -> DataFrame:
    """Forums from nested JSON answers (id, name, child array), parents from the nesting."""
    kind = "struct<id:bigint,name:string,child:array<string>>"
    level = answers.select(F.lit(None).cast("long").alias("parent_id"), F.from_json(column, kind).alias("f"))
    found = []
    while True:
        rows = level.filter("f.id is not null")
        found.append(rows.select("f.id", "parent_id", "f.name"))
        level = rows.select(F.col("f.id").alias("parent_id"), F.explode("f.child").alias("c")).select("parent_id", F.from_json("c", kind).alias("f"))
        if level.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
