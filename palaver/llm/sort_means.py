"""Centroid clustering by sort-means, exact in integers.

Vectors become integers floor(scale * x).  Each round orders, for every centroid,
the others by their distance from it; a vector starts at the centroid it was
assigned to and scans the others in that order, until one lies strictly beyond
twice the vector's distance from its own: by the triangle inequality neither that
one nor any later one can be nearer, or as near.  Ties go to the smaller number.
A centroid then becomes the floor of its vectors' mean; one without vectors stays.

Plan: a round is one pass over a table of (id, integers, assignment), written to
the shared folder for the next round; the table before it is deleted.  A task adds
one row a centroid with its sums, so what is gathered is ``k`` rows of sums, and a
cluster of any size costs a row a task.  Nothing is shuffled but those sums.

Defined results: vectors that are null, have other than ``dims`` components, or a
null, NaN or infinite one, are left out, and so are those with a component too
large for a squared distance to fit in a long (2**26 after scaling, with 64
components); repeated ids are separate vectors, and start as centroids in the
order of their components; a null id hashes last; with fewer than ``k`` vectors
there are as many centroids; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.blocks import opened, shared_dir


def integers(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and x, the integer components, of every vector that can be clustered."""
    vectors = opened(vectors, "vec_id", "embedding")[0]
    most = math.isqrt((1 << 60) // dims) // 2
    wide = F.col("embedding").cast("array<double>")
    fits = (F.size(wide) == dims) & F.forall(wide, lambda c: F.coalesce(F.abs(c) < most / scale, F.lit(False)))
    return vectors.filter(F.coalesce(fits, F.lit(False))).select("vec_id", F.transform(wide, lambda c: F.floor(c * scale).cast("int")).alias("x"))


def first_centroids(whole: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors of least hash, in its order; the sort keeps no more rows than that."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r["x"]) for r in whole.select("x", digest.alias("digest")).orderBy(F.col("digest").asc_nulls_last(), "x").limit(k).collect()]


def nearest(x: np.ndarray, start: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid, scanned from ``start``."""
    gaps = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    best, distance = start.copy(), np.empty(len(x), dtype=np.int64)
    for own in np.unique(start):
        at = np.flatnonzero(start == own)
        near = ((x[at] - centroids[own]) ** 2).sum(axis=1)
        reach, found = 4 * near, np.full(len(at), own)
        alive = np.arange(len(at))
        for other in np.argsort(gaps[own], kind="stable"):
            if other == own:
                continue
            alive = alive[gaps[own, other] <= reach[alive]]  # twice the distance, squared
            if not len(alive):
                break
            d = ((x[at[alive]] - centroids[other]) ** 2).sum(axis=1)
            better = (d < near[alive]) | ((d == near[alive]) & (other < found[alive]))
            near[alive[better]], found[alive[better]] = d[better], other
        best[at], distance[at] = found, near
    return best, distance


def _assigned(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, x, cluster, distance of every row, and a row of sums for each task and cluster."""
    dims, k = len(centroids[0]), len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.array(centroids, dtype=np.int64)
        sums, n, spread = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64), [0] * k
        kind = pa.int64()
        for batch in batches:
            kind = batch["vec_id"].type
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                x = part["x"].flatten().to_numpy().reshape(-1, dims).astype(np.int64)
                cluster, distance = nearest(x, part["cluster"].to_numpy(), own)
                for c in np.unique(cluster):
                    mine = cluster == c
                    sums[c] += x[mine].sum(axis=0)
                    n[c] += int(mine.sum())
                    d = distance[mine]
                    spread[c] += (int((d >> 32).sum()) << 32) + int((d & 0xFFFFFFFF).sum())
                none = pa.nulls(len(x))
                yield pa.record_batch([part["vec_id"], part["x"], pa.array(cluster, pa.int32()), pa.array(distance), none.cast(pa.list_(pa.int64())), none.cast(pa.int64()), none.cast(pa.decimal128(38, 0))], names=names)
        some = np.flatnonzero(n)
        if len(some):
            none = pa.nulls(len(some))
            totals = pa.array([sums[c].tolist() for c in some], pa.list_(pa.int64()))
            yield pa.record_batch([none.cast(kind), none.cast(pa.list_(pa.int32())), pa.array(some, pa.int32()), none.cast(pa.int64()), totals, pa.array(n[some]), pa.array([Decimal(spread[c]) for c in some], pa.decimal128(38, 0))], names=names)

    names = ["vec_id", "x", "cluster", "distance", "sums", "n", "spread"]
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x", "cluster").mapInArrow(run, f"vec_id {kind}, x array<int>, cluster int, distance long, sums array<long>, n long, spread decimal(38,0)")


def _moved(table: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The next centroids, from the rows of sums alone: one a task and cluster."""
    parts = table.filter("n is not null").select("cluster", "n", F.posexplode("sums").alias("i", "s"))
    totals = parts.groupBy("cluster", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    moved = [list(c) for c in centroids]
    for r in totals.collect():  # k * dims numbers
        moved[r["cluster"]][r["i"]] = int(r["s"]) // r["n"]
    return moved


def _delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def sort_means(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3") -> tuple[DataFrame, list[dict]]:
    """vec_id, cluster, distance of every vector, and the clusters: centroid, inertia, n."""
    spark = vectors.sparkSession
    whole = integers(vectors, dims, scale)
    centroids = first_centroids(whole, k, seed)
    rows, before = whole.withColumn("cluster", F.lit(0)), None
    if not centroids:
        return rows.select("vec_id", "cluster", F.lit(0).cast("long").alias("distance")), []
    for number in range(rounds + 1):
        made = _assigned(rows, centroids)
        path = f"{shared_dir(spark)}/sort-means-{number}-{uuid.uuid4().hex}"
        made.write.parquet(path)
        table = spark.read.schema(made.schema).parquet(path)
        if before:
            _delete(spark, before)
        rows, before = table.filter("n is null"), path
        if number < rounds:
            centroids = _moved(table, centroids)
    spreads = {r["cluster"]: r for r in table.filter("n is not null").groupBy("cluster").agg(F.sum("spread").alias("spread"), F.sum("n").alias("n")).collect()}
    clusters = [{"centroid": c, "inertia": int(spreads[i]["spread"]) if i in spreads else 0, "n": spreads[i]["n"] if i in spreads else 0} for i, c in enumerate(centroids)]
    return rows.select("vec_id", "cluster", "distance"), clusters


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """Every vector with its cluster's inertia, the inertia of all and a digest of its centroid."""
    rows, clusters = sort_means(vectors, **options)
    inertia = F.array(*(F.lit(c["inertia"]).cast("long") for c in clusters)) if clusters else F.array(F.lit(0).cast("long"))
    digests = [hashlib.sha256(",".join(map(str, c["centroid"])).encode()).hexdigest() for c in clusters] or [""]
    own = F.col("cluster") + 1
    return rows.select(
        "vec_id", "cluster", "distance",
        F.element_at(inertia, own).alias("cluster_inertia"),
        F.lit(sum(c["inertia"] for c in clusters)).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), own).alias("centroid_sha256"),
    )
