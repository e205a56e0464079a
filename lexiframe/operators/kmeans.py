"""k-means clustering (Lloyd) over dense vector columns and over sparse term-weight tables.

One Lloyd iteration = assign every record to its nearest centroid, recompute the centroids as
member means, and measure the SSE of the records against the new centroids. The reference loop
stops when the SSE stops falling; a fixed number of iterations is also available (used for
reproducible checks).

Scale: the K centroids (K × dim values, bounded by parameters, not by the data) reach every
task as one array-valued literal or scalar subquery, so assignment is a map-only projection — no join of
records × centroids. A dense round is one pass: one aggregate with map-side partial sums gives the driver
the new centroids (K × dim rows) and the SSE. Nearest
centroid = smallest (squared distance, cluster id): the first wins on ties. Distances are compared
unrounded; a report rounds what it shows. Empty clusters keep their previous centroid.

Seeding: ``seeds_smallest_ids`` (deterministic) or ``kmeanspp_seeds`` (D² weighting: every
round takes the record with the smallest exponential key −ln(u)/D², a distributed weighted
draw without a global cumulative sum). Its u is a hash of seed, round and record id: the draw does
not depend on partitions or retries, and SQL can repeat it.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.functions.stats import sq_euclidean
from lexiframe.operators.sizing import broadcast_when, checkpoint_dir


FALL = 1e-10  # a relative fall of the SSE below this is rounding


@dataclass
class KMeansResult:
    assignments: DataFrame  # id, cluster, dist2
    centroids: DataFrame    # cluster, center ARRAY<DOUBLE>   (dense)  |  cluster, term, w (sparse)
    sse: DataFrame          # iteration, sse


def _as_double_array(col: str) -> Column:
    return F.col(col).cast("array<double>")


def seeds_smallest_ids(df: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``cluster, center``: the k records with the smallest ids, cluster numbers 0..k-1 by id."""
    top = df.select(id_col, _as_double_array(vec_col).alias("center")).orderBy(id_col).limit(k)
    return top.select((F.row_number().over(Window.orderBy(id_col)) - 1).cast("int").alias("cluster"), "center")


def _centers(centroids: DataFrame) -> Column:
    """Array of (cluster, center) structs as a scalar subquery (computed once, shipped to tasks)."""
    return centroids.select(F.sort_array(F.collect_list(F.struct("cluster", "center")))).scalar()


def _as_column(centroids: list[tuple]) -> Column:
    """The same array from (cluster, center) pairs on the driver, as a literal."""
    pairs = json.dumps([{"cluster": k, "center": c} for k, c in centroids])  # a call per number would take longer than the round
    return F.from_json(F.lit(pairs), "array<struct<cluster:int,center:array<double>>>")


def assign_nearest(df: DataFrame, centers: Column, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, vec, cluster, dist2`` — nearest centroid for every record, map-only."""
    # the centers (a scalar subquery) become a column first: subqueries may not sit inside lambdas
    staged = df.select(F.col(id_col), _as_double_array(vec_col).alias("vec"), centers.alias("_centers"))
    best = F.array_min(F.transform("_centers", lambda c: F.struct(
        sq_euclidean(F.col("vec"), c["center"]).alias("d"), c["cluster"].alias("cluster"))))
    return staged.select(id_col, "vec", best.alias("b")).select(
        id_col, "vec", F.col("b.cluster").alias("cluster"), F.col("b.d").alias("dist2"))


def _round_sums(assigned: DataFrame) -> DataFrame:
    """``cluster, pos, x, n, dist2, odd`` — of every cluster and dimension the members' mean, how many there
    are, Σ dist2 and the number of members whose dist2 is no finite number (both at position 0 only, so
    that they count once). Members without a dimension have a null position."""
    finite = F.coalesce(F.col("dist2") < F.lit(float("inf")), F.lit(False))
    rows = assigned.select("cluster", "dist2", (F.col("vec").isNotNull() & ~finite).alias("odd"), F.posexplode_outer("vec").alias("pos", "x"))
    once = F.coalesce(F.col("pos"), F.lit(0)) == 0
    return rows.groupBy("cluster", "pos").agg(
        F.avg("x").alias("x"), F.count(F.lit(1)).alias("n"), F.sum(F.when(once, F.col("dist2"))).alias("dist2"),
        F.sum(F.when(once, F.col("odd").cast("bigint"))).alias("odd"))


def _sse_against(assigned: DataFrame, centers: Column) -> DataFrame:
    """One row ``sse``: Σ squared distance of every record to the given center of its cluster."""
    staged = assigned.select("vec", "cluster", centers.alias("_centers"))
    own = F.element_at(F.filter("_centers", lambda s: s["cluster"] == F.col("cluster")), 1)["center"]
    return staged.select(sq_euclidean(F.col("vec"), own).alias("d2")) \
        .agg(F.sum("d2").alias("sse"))


def _lloyd_round(assigned: DataFrame, centroids: list[tuple]) -> tuple[list[tuple], float | None]:
    """The member means (an empty cluster keeps its center) and the SSE against them, from one pass.

    Of a cluster's n members Σ|x − new|² = Σ|x − old|² − n·|new − old|², so that the assignment's own
    distances give the SSE without a second pass. Where that loses digits (a fall to below a
    hundredth) or does not hold (vectors of other lengths, null or infinite values) it is summed up."""
    sums = _round_sums(assigned).collect()  # K × dim rows, bounded by the parameters
    means: dict[int, list] = {}
    for r in sorted((r for r in sums if r["pos"] is not None), key=lambda r: (r["cluster"], r["pos"])):
        means.setdefault(r["cluster"], []).append(r["x"])
    new = sorted([*means.items(), *((k, c) for k, c in centroids if k not in means)], key=lambda p: p[0])
    old = dict(centroids)
    dist2 = [r["dist2"] for r in sums if r["dist2"] is not None]
    if dist2 and len(old) == len(centroids) and not any(r["odd"] for r in sums):
        size = {r["cluster"]: r["n"] for r in sums if r["pos"] == 0}
        moved = [size[k] * math.fsum((a - b) ** 2 for a, b in zip(c, old[k])) for k, c in means.items()]
        total = math.fsum(dist2)
        sse = total - math.fsum(moved)
        if sse >= total / 100:
            return new, sse
    return new, _sse_against(assigned, _as_column(new)).first()["sse"]


def kmeans(df: DataFrame, k: int, iterations: int | None = 3, id_col: str = "vec_id", vec_col: str = "embedding",
           seeds: DataFrame | None = None) -> KMeansResult:
    """Lloyd's algorithm, one pass over the records per round.

    ``iterations=None``: stop when the SSE stops falling (or is no number that can fall), however many
    rounds that takes, else run exactly ``iterations`` rounds. The centroids and the SSE of a round are on
    the driver (K × dim values), so that no round depends on the plan of an earlier one.
    """
    spark = df.sparkSession
    start = seeds if seeds is not None else seeds_smallest_ids(df, k, id_col, vec_col)
    centroids = sorted(((r["cluster"], r["center"]) for r in start.collect()), key=lambda p: p[0])
    sse_rows: list[tuple] = []
    prev_sse = float("inf")
    for it in count(1) if iterations is None else range(1, iterations + 1):
        final_centers = _as_column(centroids)
        centroids, sse = _lloyd_round(assign_nearest(df, final_centers, id_col, vec_col), centroids)
        sse_rows.append((it, sse))
        if iterations is None:
            if sse is None or not prev_sse - sse > FALL * sse:
                break
            prev_sse = sse
    # assignments of the last round, against the centers that round used
    final = assign_nearest(df, final_centers, id_col, vec_col).select(id_col, "cluster", "dist2")
    return KMeansResult(final, spark.createDataFrame(centroids, "cluster int, center array<double>"),
                        spark.createDataFrame(sse_rows, "iteration int, sse double"))


def min_distance_to(df: DataFrame, centers: Column, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, min_dist2``: squared distance to the nearest of the given centers."""
    a = assign_nearest(df, centers, id_col, vec_col)
    return a.select(id_col, F.col("dist2").alias("min_dist2"))


def hashed_uniform(id_col: str, seed: int) -> Column:
    """A number in (0, 1) per id: the first 52 bits of the MD5 of ``id:seed``."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def kmeanspp_seeds(df: DataFrame, k: int, seed: int = 42, id_col: str = "vec_id",
                   vec_col: str = "embedding") -> DataFrame:
    """k-means++ seeding: first center uniformly, then each next one with probability ∝ D²."""
    checkpoint_dir(df.sparkSession)
    first = (df.select(id_col, _as_double_array(vec_col).alias("center"), hashed_uniform(id_col, seed).alias("u"))
             .orderBy("u", id_col).limit(1).select(F.lit(0).alias("cluster"), "center"))
    centroids = first.checkpoint(eager=True)
    for i in range(1, k):
        d = assign_nearest(df, _centers(centroids), id_col, vec_col)
        key = -F.log(hashed_uniform(id_col, seed + i)) / F.col("dist2")
        nxt = (d.where(F.col("dist2") > 0).select("vec", key.alias("key"), id_col)
               .orderBy("key", id_col).limit(1).select(F.lit(i).alias("cluster"), F.col("vec").alias("center")))
        centroids = centroids.unionByName(nxt).checkpoint(eager=True)
    return centroids


# ---- sparse vectors (doc_id, term, w) -------------------------------------------------------------

def sparse_kmeans(vectors: DataFrame, k: int, iterations: int, id_col: str = "doc_id",
                  ids: DataFrame | None = None) -> KMeansResult:
    """Lloyd on sparse vectors ``id, term, w``; seeds = the k smallest ids; fixed iterations.

    ``ids``: all records, where some have no term (they are zero vectors and stay in the result).

    dist²(d, c) = |d|² + |c|² − 2·d·c; the dot products come from a join on term (only shared
    terms meet), the K centroid norms travel as one small array, so no record × centroid pairs
    are formed by a join. The input vectors once and the centroids every round are checkpointed.
    """
    checkpoint_dir(vectors.sparkSession)
    ids = (ids if ids is not None else vectors).select(id_col).distinct()
    vectors = vectors.select(id_col, "term", "w").where(F.col("term").isNotNull()).checkpoint(eager=True)
    # a centroid holds at most the terms of its members (or its previous terms when it is empty),
    # so k × |vector rows| bounds the centroid table: one count instead of a probe per round
    n_rows = vectors.count()
    ids = ids.checkpoint(eager=True)
    seed_ids = ids.orderBy(id_col).limit(k).select(
        id_col, (F.row_number().over(Window.orderBy(id_col)) - 1).cast("int").alias("cluster"))
    seed_ids = seed_ids.checkpoint(eager=True)  # k rows
    clusters = seed_ids.select("cluster")
    centroids = vectors.join(F.broadcast(seed_ids), id_col).select("cluster", "term", "w")
    dnorm = ids.join(vectors.groupBy(id_col).agg(F.sum(F.col("w") * F.col("w")).alias("dn")), id_col, "left").select(
        id_col, F.coalesce("dn", F.lit(0.0)).alias("dn"))
    sse_parts = []
    assigned = None
    for it in range(1, iterations + 1):
        assigned = _sparse_assign(vectors, dnorm, centroids, clusters, id_col, k * n_rows)
        new_centroids = _sparse_recompute(vectors, assigned, centroids, id_col).checkpoint(eager=True)
        d2 = _sparse_dist_to_own(vectors, dnorm, assigned, new_centroids, clusters, id_col)
        sse_parts.append(d2.agg(F.sum("d2").alias("sse")).select(F.lit(it).alias("iteration"), "sse"))
        centroids = new_centroids
    sse = sse_parts[0]
    for p in sse_parts[1:]:
        sse = sse.unionByName(p)
    return KMeansResult(assigned, centroids, sse)


def _norms(centroids, clusters):
    """Squared norm of every cluster's centroid; 0 for one without terms."""
    some = centroids.groupBy("cluster").agg(F.sum(F.col("w") * F.col("w")).alias("cn"))
    return clusters.join(some, "cluster", "left").select("cluster", F.coalesce("cn", F.lit(0.0)).alias("cn"))


def _sparse_assign(vectors, dnorm, centroids, clusters, id_col, max_centroid_rows):
    cnorm = _norms(centroids, clusters)
    cn_arr = cnorm.select(F.sort_array(F.collect_list(F.struct("cluster", "cn")))).scalar()
    cent = broadcast_when(centroids.select("cluster", "term", F.col("w").alias("wc")), max_centroid_rows)
    dots = (vectors.join(cent, "term").groupBy(id_col, "cluster")
            .agg(F.sum(F.col("w") * F.col("wc")).alias("dot")))
    dot_maps = dots.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("cluster", "dot"))).alias("m"))
    per = dnorm.join(dot_maps, id_col, "left").withColumn("_cn", cn_arr)
    best = F.array_min(F.transform("_cn", lambda c: F.struct(
        (F.col("dn") + c["cn"] - 2.0 * F.coalesce(F.col("m")[c["cluster"]], F.lit(0.0))).alias("d"),
        c["cluster"].alias("cluster"))))
    return per.select(id_col, best["cluster"].alias("cluster"), best["d"].alias("dist2"))


def _sparse_recompute(vectors, assigned, previous, id_col):
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sums = (vectors.join(assigned.select(id_col, "cluster"), id_col)
            .groupBy("cluster", "term").agg(F.sum("w").alias("sw")))
    fresh = sums.join(F.broadcast(sizes), "cluster").select("cluster", "term", (F.col("sw") / F.col("size")).alias("w"))
    kept = previous.join(sizes.select("cluster"), "cluster", "left_anti")
    return fresh.unionByName(kept)


def _sparse_dist_to_own(vectors, dnorm, assigned, centroids, clusters, id_col):
    cnorm = _norms(centroids, clusters)
    own = (vectors.join(assigned.select(id_col, "cluster"), id_col)
           .join(centroids.select("cluster", "term", F.col("w").alias("wc")), ["cluster", "term"])
           .groupBy(id_col).agg(F.sum(F.col("w") * F.col("wc")).alias("dot")))
    return (assigned.select(id_col, "cluster").join(dnorm, id_col).join(F.broadcast(cnorm), "cluster")
            .join(own, id_col, "left")
            .select(id_col, (F.col("dn") + F.col("cn") - 2.0 * F.coalesce("dot", F.lit(0.0))).alias("d2")))


def kmeans_ml(df: DataFrame, k: int, seed: int = 42, max_iter: int = 20, id_col: str = "vec_id",
              vec_col: str = "embedding") -> KMeansResult:
    """Spark ML k-means (k-means|| seeding, Lloyd iterations) for large K or many records:
    ``id, cluster`` assignments and ``cluster, center`` centroids."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    feats = df.select(id_col, array_to_vector(_as_double_array(vec_col)).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(feats)
    assigned = model.transform(feats).select(id_col, F.col("cluster").cast("int").alias("cluster"))
    centers = model.clusterCenters()  # k × dim values, bounded by the parameters
    spark = df.sparkSession
    cent = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centers)],
                                 "cluster int, center array<double>")
    sse = spark.createDataFrame([(model.summary.numIter, float(model.summary.trainingCost))],
                                "iteration int, sse double")
    return KMeansResult(assigned, cent, sse)
