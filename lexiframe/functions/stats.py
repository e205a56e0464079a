"""Closed-form statistics as column expressions (evaluated on 1-row aggregates or per row).

No scipy: Student's t by the continued fraction of the incomplete beta function, the normal CDF by
a power series near 0 and a continued fraction in the tails; the work is the same for any input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    if isinstance(col, Column):
        return col
    if isinstance(col, str):
        return F.col(col)
    return F.lit(col)


STIRLING_SHIFT = 10
BETA_STEPS = 600  # the fraction settles in about the square root of df steps
NORMAL_FROM_DF = 100_000  # from here on t is turned into a normal deviate (relative error about 1 / df²)


def log_gamma(x) -> Column:
    """ln Γ(x) for x > 0: Stirling's series at x + 10, brought back by the recurrence."""
    x = _c(x).cast("double")
    y = x + STIRLING_SHIFT
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, 3.0)) + 1 / (1260 * F.pow(y, 5.0))
    back = F.log(x)
    for i in range(1, STIRLING_SHIFT):
        back = back + F.log(x + i)
    return series - back


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function (modified Lentz), a fixed number of steps
    whatever the data."""
    def safe(v: Column) -> Column:
        return F.when(F.abs(v) < 1e-300, F.lit(1e-300)).otherwise(v)

    d0 = 1.0 / safe(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        d1, c1 = 1.0 / safe(1.0 + even * s["d"]), safe(1.0 + even / s["c"])
        mid = F.struct(c1.alias("c"), d1.alias("d"), (s["h"] * d1 * c1).alias("h"))
        # a one-element array keeps the half step from being written out twice
        return F.element_at(F.transform(F.array(mid), lambda t: F.struct(
            safe(1.0 + odd / t["c"]).alias("c"), (1.0 / safe(1.0 + odd * t["d"])).alias("d"),
            (t["h"] / safe(1.0 + odd * t["d"]) * safe(1.0 + odd / t["c"])).alias("h"))), 1)

    return F.aggregate(F.sequence(F.lit(1), F.lit(BETA_STEPS)), start, step, lambda s: s["h"])


def student_t_two_sided_p(t, df) -> Column:
    """Two-sided p-value P(|T| >= |t|) for Student's t with ``df`` >= 1 degrees of freedom.

    p = I_x(df/2, 1/2) with x = df / (df + t²), by the continued fraction on the side where it
    converges; very large df by the normal distribution. Small p-values keep their size. NULL when
    df < 1 or t is NULL.
    """
    t, nu = _c(t).cast("double"), _c(df).cast("double")
    a, half = nu / 2.0, F.lit(0.5)
    x, y = nu / (nu + t * t), t * t / (nu + t * t)
    front = F.exp(log_gamma(a + 0.5) - log_gamma(a) - math.lgamma(0.5) + a * F.log(x) + 0.5 * F.log(y))
    p = F.when(x < (a + 1.0) / (a + 2.5), front * _beta_fraction(a, half, x) / a).otherwise(
        1.0 - front * _beta_fraction(half, a, y) / 0.5)
    z = F.abs(t) * (1.0 - 1.0 / (4.0 * nu)) / F.sqrt(1.0 + t * t / (2.0 * nu))
    p = F.when(t == 0, F.lit(1.0)).when(nu >= NORMAL_FROM_DF, 2.0 * normal_cdf(-z)).otherwise(p)
    return F.when((nu >= 1) & t.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))


NORMAL_SERIES_TERMS = 100
NORMAL_TAIL_FROM = 4.0  # the series loses digits beyond; the tail's fraction converges quickly there
NORMAL_TAIL_STEPS = 60


def normal_cdf(z) -> Column:
    """Standard normal CDF: 1/2 + phi(z) * sum_k z^(2k+1) / (2k+1)!! near 0; beyond |z| = 4 the
    continued fraction phi(z) / (z + 1/(z + 2/(z + ...))) of the tail, so that small probabilities
    keep their size (0 only where a double cannot hold them)."""
    z = _c(z).cast("double")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(NORMAL_SERIES_TERMS - 1)),
        F.struct(z.alias("a"), z.alias("s")),
        lambda acc, k: F.struct(
            (acc["a"] * z * z / (2 * k + 1)).alias("a"),
            (acc["s"] + acc["a"] * z * z / (2 * k + 1)).alias("s"),
        ),
        lambda acc: acc["s"],
    )
    phi = F.exp(-z * z / 2.0) / math.sqrt(2.0 * math.pi)
    far = F.greatest(F.abs(z), F.lit(1.0))
    tail = phi / F.aggregate(F.sequence(F.lit(NORMAL_TAIL_STEPS), F.lit(1), F.lit(-1)), far, lambda acc, k: far + k / acc)
    # NULL in, NULL out: greatest/least below skip NULLs and would turn it into 0 or 1
    return (
        F.when(z.isNull(), F.lit(None).cast("double"))
        .when(z <= -NORMAL_TAIL_FROM, tail)
        .when(z >= NORMAL_TAIL_FROM, 1.0 - tail)
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 + phi * series)))
    )


def sq_euclidean(a, b) -> Column:
    """Squared Euclidean distance of two numeric arrays; +inf when their lengths differ."""
    a, b = _c(a), _c(b)
    s = F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    return F.when(F.size(a) != F.size(b), F.lit(float("inf"))).otherwise(s)
