"""Tail probabilities of the drift tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ks_pvalue(statistic: Column, n_reference: Column, n_current: Column) -> Column:
    """Asymptotic two-sample Kolmogorov tail with the usual small-sample correction.

    Below lambda = 0.2 the alternating series does not converge within the summed terms and the
    tail is 1 to more than 12 digits.
    """
    a, b = n_reference.cast("double"), n_current.cast("double")
    root = F.sqrt(F.try_divide(a * b, a + b))
    lam = (root + F.lit(0.12) + F.try_divide(F.lit(0.11), root)) * statistic
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, j: total
        + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * j * j * lam * lam),
    )
    tail = F.least(F.greatest(terms * 2, F.lit(0.0)), F.lit(1.0))
    return F.when(statistic.isNull(), F.lit(None).cast("double")).when(lam < 0.2, F.lit(1.0)).otherwise(tail)


def chi2_pvalue(statistic: Column, degrees: Column) -> Column:
    """Upper tail of the chi-squared distribution for whole degrees of freedom.

    The tail is a finite sum: with h half the statistic and k degrees, exp(-h) times the sum of
    h^j / j! for j below k/2 when k is even; when k is odd, erfc(sqrt h) plus exp(-h) times the sum
    of h^(j - 1/2) / gamma(j + 1/2) for j up to (k - 1)/2. Terms are built from their logarithms,
    ln gamma growing by ln of the last argument from term to term.
    """
    half = statistic.cast("double") / 2
    even = degrees % 2 == 0
    terms = F.when(even, degrees / 2).otherwise((degrees - 1) / 2).cast("int")
    begin = F.when(even, F.lit(1.0)).otherwise(F.lit(1.5))  # the first argument of gamma
    log_gamma = F.when(even, F.lit(0.0)).otherwise(F.lit(-0.12078223763524522))  # ln gamma of it
    start = F.struct(F.lit(0.0).alias("sum"), log_gamma.alias("lg"))

    def add(acc, j):
        at = begin + (j - 1)
        term = F.exp((at - 1) * F.log(half) - half - acc["lg"])
        return F.struct((acc["sum"] + term).alias("sum"), (acc["lg"] + F.log(at)).alias("lg"))

    steps = F.when(terms > 0, F.sequence(F.lit(1), F.greatest(terms, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, start, add)["sum"]
    tail = F.least(total + F.when(even, F.lit(0.0)).otherwise(erfc(F.sqrt(half))), F.lit(1.0))
    known = statistic.isNotNull() & degrees.isNotNull() & ~F.isnan(half) & (degrees >= 1)
    return F.when(known, F.when(half <= 0, F.lit(1.0)).otherwise(tail))


def erfc(x: Column, steps: int = 100) -> Column:
    """Complementary error function of x >= 0: the series of erf up to 2, beyond it a continued fraction."""
    square = x * x
    term = F.struct(x.alias("t"), x.alias("sum"))

    def grow(acc, n):
        t = acc["t"] * square * 2 / (n * 2 + 1)
        return F.struct(t.alias("t"), (acc["sum"] + t).alias("sum"))

    root = 1.7724538509055159  # sqrt pi
    series = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), term, grow)["sum"]
    near = F.lit(1.0) - F.exp(-square) * series * 2 / root
    depth = F.sequence(F.lit(steps), F.lit(1), F.lit(-1))
    fraction = F.aggregate(depth, F.lit(0.0), lambda acc, n: n / F.lit(2.0) / (x + acc))
    far = F.exp(-square) / root / (x + fraction)
    return F.when(x < 2, near).otherwise(far)
