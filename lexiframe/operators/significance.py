"""Paired significance tests between two runs (per-topic metric values joined on topic id).

* paired t test: t = mean(d) / (sd(d)/sqrt(n)), df = n − 1, two-sided p from the exact
  Student-t series for integer df;
* Wilcoxon signed-rank: zero differences dropped, |d| ranked with average ranks for ties,
  W+ / W− rank sums, W = min(W+, W−),
  z = (W − n(n+1)/4) / sqrt(n(n+1)(2n+1)/24 − Σ(t³ − t)/48) over the sizes t of groups of ties, no
  continuity correction. Up to ``EXACT_N`` differences p is exact: a dynamic program over the
  doubled ranks counts the sign choices whose rank sum is at most W; beyond that p = 2 Φ(−|z|).
Decision: the null hypothesis is rejected when p < α.

Differences are rounded to 9 decimals before the sign / tie logic, so 0.6 − 0.6 and ties of
binary-inexact differences behave as exact decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.functions.stats import normal_cdf, student_t_two_sided_p
from lexiframe.operators.sizing import checkpoint_dir

DIFF_DECIMALS = 9
EXACT_N = 50  # 2^50 sign choices are still counted exactly by doubles


def paired_differences(x: DataFrame, y: DataFrame, value: str = "value", key: str = "query_id") -> DataFrame:
    """``query_id, x, y, d`` for topics present in both runs."""
    return (x.select(key, F.col(value).alias("x"))
            .join(y.select(key, F.col(value).alias("y")), key)
            .select(key, "x", "y", F.round(F.col("x") - F.col("y"), DIFF_DECIMALS).alias("d")))


def paired_t_test(diffs: DataFrame, alpha: float = 0.05, d: str = "d") -> DataFrame:
    """One row: ``n, mean, sd, t, df, p, reject``."""
    s = diffs.agg(F.count(F.lit(1)).alias("n"), F.avg(d).alias("mean"), F.stddev_samp(d).alias("sd"))
    t = F.when(F.col("sd") > 0, F.col("mean") / (F.col("sd") / F.sqrt(F.col("n"))))
    out = s.select("n", "mean", "sd", t.alias("t"), (F.col("n") - 1).alias("df"))
    out = out.withColumn("p", student_t_two_sided_p(F.col("t"), F.col("df")))
    return out.withColumn("reject", F.col("p") < F.lit(alpha))


def _ranked_groups(diffs: DataFrame, d: str) -> DataFrame:
    """``cnt, n_pos, avg_rank`` of every distinct |d| (zeros dropped).

    Ranks without a one-partition window over all differences: equal |d| values collapse
    first (one row per distinct |d| with its positive / negative counts); those rows are
    range-partitioned by |d|, numbered inside each partition, and shifted by the sizes of the
    preceding partitions (one row per partition, broadcast).
    """
    nz = diffs.where(F.col(d) != 0).select(F.abs(F.col(d)).alias("a"), (F.col(d) > 0).alias("pos"))
    groups = nz.groupBy("a").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.col("pos").cast("bigint")).alias("n_pos"))
    n = int(diffs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # range boundaries are sampled: two branches that plan their own exchange may get different
    # ones, so the numbered table is written once and both branches read it
    checkpoint_dir(diffs.sparkSession)
    ranged = groups.repartitionByRange(n, "a").withColumn("_pid", F.spark_partition_id()).checkpoint()
    w_local = Window.partitionBy("_pid").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_below", F.coalesce(F.sum("cnt").over(w_local), F.lit(0)))
    sizes = local.groupBy("_pid").agg(F.sum("cnt").alias("_n"))
    offs = sizes.withColumn("_off", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return local.join(F.broadcast(offs.select("_pid", "_off")), "_pid").select(
        "cnt", "n_pos",
        (F.col("_off") + F.col("_below") + (F.col("cnt") + 1) / 2.0).alias("avg_rank"))


def _sums(ranked: DataFrame, *more: Column) -> DataFrame:
    return ranked.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.sum(F.col("avg_rank") * F.col("n_pos")), F.lit(0.0)).alias("w_plus"),
        F.coalesce(F.sum(F.col("avg_rank") * (F.col("cnt") - F.col("n_pos"))), F.lit(0.0)).alias("w_minus"), *more)


def signed_rank_sums(diffs: DataFrame, d: str = "d") -> DataFrame:
    """One row ``n, w_plus, w_minus`` with average ranks for tied |d| (zeros dropped)."""
    return _sums(_ranked_groups(diffs, d))


def exact_signed_rank_p(ranks: Column, w: Column) -> Column:
    """Two-sided p of the rank sum ``w`` under all sign choices of ``ranks``, an array of doubled ranks
    (whole numbers also with ties). ``counts[s]`` is how many choices have the doubled sum s; each rank
    adds the counts shifted by it."""
    total = F.aggregate(ranks, F.lit(0), lambda a, r: a + r)
    start = F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), total))
    counts = F.aggregate(ranks, start, lambda acc, r: F.transform(
        acc, lambda c, s: c + F.when(s >= r, F.get(acc, s - r)).otherwise(0.0)))
    most = F.floor(2 * w).cast("int") + 1
    below = F.aggregate(F.slice(counts, F.lit(1), most), F.lit(0.0), lambda a, c: a + c)
    return F.least(F.lit(1.0), 2.0 * below / F.pow(F.lit(2.0), F.size(ranks)))


def wilcoxon_test(diffs: DataFrame, alpha: float = 0.05, d: str = "d") -> DataFrame:
    """One row: ``n, w_plus, w_minus, w, z, p, reject``; z and p are null without a difference."""
    checkpoint_dir(diffs.sparkSession)
    ranked = _ranked_groups(diffs, d).checkpoint()
    few = ranked.agg(F.sum("cnt")).scalar() <= EXACT_N  # the ranks come together only if they are few
    ranks = ranked.where(few).agg(F.flatten(F.collect_list(
        F.array_repeat((2 * F.col("avg_rank")).cast("int"), F.col("cnt").cast("int")))).alias("r"))
    cnt = F.col("cnt").cast("double")
    s = _sums(ranked, F.coalesce(F.sum(cnt * cnt * cnt - cnt), F.lit(0.0)).alias("ties")).withColumn("r", ranks.scalar())
    n = F.col("n").cast("double")
    mu = n * (n + 1) / 4.0
    sigma = F.sqrt(n * (n + 1) * (2 * n + 1) / 24.0 - F.col("ties") / 48.0)
    w = F.least("w_plus", "w_minus")
    z = F.when(F.col("n") > 0, (w - mu) / sigma)
    out = s.select("n", "w_plus", "w_minus", w.alias("w"), z.alias("z"), "r")
    p = F.when(F.col("n") == 0, F.lit(None)).when(F.col("n") <= EXACT_N, exact_signed_rank_p(F.col("r"), F.col("w"))).otherwise(
        2.0 * normal_cdf(-F.abs(F.col("z"))))
    return out.withColumn("p", p).drop("r").withColumn("reject", F.col("p") < F.lit(alpha))
