"""Rank tests, confidence intervals and regression on full data.

Rank tests work on the table of distinct values and their counts, so no sample
is drawn and rows are never sorted as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.operators.ranking import mid_ranks

OLS_FEATURES = ["temperature_2m", "precipitation", "is_weekend", "is_after_hours", "month", "hour"]


def _frequencies(df: DataFrame, value: str, group: str) -> DataFrame:
    known = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    return known.groupBy(F.col(value).alias("value"), F.col(group).alias("grp")).agg(F.count(F.lit(1)).alias("n"))


def _ranked(frequencies: DataFrame, blocks: int | None) -> DataFrame:
    """Distinct values with their total count and the mid-rank of each copy."""
    values = frequencies.groupBy("value").agg(F.sum("n").alias("copies"))
    return mid_ranks(values, "value", "copies", blocks)


def rank_sum(df: DataFrame, value: str, group: str, blocks: int | None = None) -> DataFrame:
    """Wilcoxon rank-sum test of a boolean group: false against true.

    One row: the statistic, the normal score with tie and continuity
    correction, its two-sided p-value, group sizes and means.  The score is null
    where all values are equal or a group is empty.
    """
    freq = _frequencies(df, value, group)
    pivot = freq.groupBy("value").agg(
        F.sum(F.when(~F.col("grp"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("grp"), F.col("n")).otherwise(0)).alias("b"),
        F.sum("n").alias("copies"),
    )
    ranked = mid_ranks(pivot, "value", "copies", blocks)
    a, b, t, v = (F.col(c).cast("double") for c in ("a", "b", "copies", "value"))
    sums = ranked.agg(
        F.sum(a).alias("n1"), F.sum(b).alias("n2"), F.sum(t * t * t - t).alias("ties"),
        F.sum(a * F.col("mid_rank")).alias("rank_total"), F.sum(a * v).alias("s1"), F.sum(b * v).alias("s2"),
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    w = F.col("rank_total") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1))))
    centred = F.col("w") - n1 * n2 / 2
    return (
        sums.withColumns({"w": w, "sd": sd})
        .withColumn("z", F.try_divide(centred - F.signum(centred) * 0.5, F.col("sd")))
        .select(
            F.col("w").alias("statistic"),
            "z",
            normal_two_sided(F.col("z")).alias("p_value"),
            n1.cast("long").alias("n_false"),
            n2.cast("long").alias("n_true"),
            F.try_divide("s1", n1).alias("mean_false"),
            F.try_divide("s2", n2).alias("mean_true"),
            (F.try_divide("s2", n2) - F.try_divide("s1", n1)).alias("mean_difference"),
        )
    )


def kruskal(df: DataFrame, value: str, group: str, blocks: int | None = None) -> DataFrame:
    """Kruskal-Wallis test over the groups: statistic with tie correction, degrees of freedom, p-value.

    The statistic is null where all values are equal or there are fewer than two rows.
    """
    freq = _frequencies(df, value, group)
    ranked = _ranked(freq, blocks)
    per_group = (
        freq.join(ranked.select("value", "mid_rank"), "value")
        .groupBy("grp")
        .agg(F.sum("n").cast("double").alias("size"), F.sum(F.col("n") * F.col("mid_rank")).alias("ranks"))
    )
    t = F.col("copies").cast("double")
    ties = ranked.agg(F.sum(t * t * t - t)).scalar()
    sums = per_group.agg(
        F.sum("size").alias("n"),
        F.sum(F.col("ranks") * F.col("ranks") / F.col("size")).alias("q"),
        (F.count(F.lit(1)) - 1).alias("degrees"),
    ).withColumn("ties", ties)
    n = F.col("n")
    spread = 1 - F.try_divide(F.col("ties"), n * n * n - n)
    h = F.try_divide(F.try_divide(F.col("q") * 12, n * (n + 1)) - 3 * (n + 1), spread)
    out = sums.withColumn("statistic", h)
    return out.select(
        "statistic", "degrees", chi_square_tail(F.col("statistic"), F.col("degrees")).alias("p_value"),
        n.cast("long").alias("rows"),
    )


def erfc(x: Column) -> Column:
    """Complementary error function by a published Chebyshev fit, relative error below 1.2e-7."""
    # Coefficients of the fit, highest power first.
    coefficients = [
        0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196,
        1.00002368, -1.26551223,
    ]
    z = F.abs(x)
    t = 1 / (1 + 0.5 * z)
    poly = F.lit(0.0)
    for c in coefficients:
        poly = poly * t + c
    tail = t * F.exp(-z * z + poly)
    return F.when(x >= 0, tail).otherwise(2 - tail)


def normal_two_sided(z: Column) -> Column:
    return erfc(F.abs(z) / math.sqrt(2))


def chi_square_tail(x: Column, degrees: Column) -> Column:
    """Upper tail for whole degrees of freedom, from its finite series in steps of two degrees."""
    half = x / 2
    odd = degrees % 2 == 1
    first = F.when(odd, F.sqrt(half / math.pi) * 2).otherwise(F.lit(1.0))
    terms = F.floor(degrees / 2).cast("int")
    step0 = F.when(odd, F.lit(1.5)).otherwise(F.lit(1.0))
    state = F.struct(F.lit(0.0).alias("total"), first.alias("term"), step0.alias("k"))
    summed = F.aggregate(
        F.sequence(F.lit(0), terms),
        state,
        lambda s, i: F.when(i == 0, s).otherwise(
            F.struct(
                (s["total"] + s["term"]).alias("total"),
                (s["term"] * half / s["k"]).alias("term"),
                (s["k"] + 1).alias("k"),
            )
        ),
        lambda s: s["total"],
    )
    return F.when(odd, erfc(F.sqrt(half))).otherwise(F.lit(0.0)) + F.exp(-half) * summed


def group_intervals(df: DataFrame, value: str, group: str) -> DataFrame:
    """Mean, spread, size and 95% interval of the mean per group."""
    out = df.groupBy(group).agg(
        F.avg(value).alias("mean"), F.stddev(value).alias("sd"), F.count(value).alias("n")
    )
    half = F.lit(1.96) * F.col("sd") / F.sqrt("n")
    return out.withColumns({"ci_low": F.col("mean") - half, "ci_high": F.col("mean") + half})


def regression_input(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Complete cases as doubles."""
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in (target, *features)])
    return typed.dropna()


def ols(df: DataFrame, target: str = "target_demand_count", features: Sequence[str] = tuple(OLS_FEATURES)) -> DataFrame:
    """Least squares with standard errors, t and p values, one row per term.

    The normal equations are summed on the executors; only the small matrix is
    solved on the driver.  A feature that is constant or follows
    from those before it has no estimate: its row holds nulls.  With no more
    complete rows than terms all estimates are null.
    """
    data = regression_input(df, target, features)
    names = [*features, "(Intercept)"]
    values = [*[F.col(c) for c in features], F.lit(1.0), F.col(target)]
    size = len(names)
    # Means first, then centred products: sums of raw products lose digits.
    means = data.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate([*features, target])]).first()
    rows = means["n"]
    schema = "term string, estimate double, std_error double, t_value double, p_value double, r2 double, rows long"
    empty = [(t, None, None, None, None, None, rows) for t in names]
    if rows == 0:
        return df.sparkSession.createDataFrame(empty, schema)
    centred = [v - F.lit(means[f"m{i}"]) for i, v in enumerate([*values[: size - 1], values[-1]])]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = data.agg(*[F.sum(centred[i] * centred[j]).alias(f"s{i}_{j}") for i, j in pairs]).first()
    products = np.zeros((size, size))
    for i, j in pairs:
        products[i, j] = products[j, i] = sums[f"s{i}_{j}"]
    used: list[int] = []
    for i in range(size - 1):  # what a feature adds to those before it
        rest = products[i, i]
        if used:
            rest -= products[i, used] @ np.linalg.solve(products[np.ix_(used, used)], products[used, i])
        if products[i, i] > 0 and rest > 1e-10 * products[i, i]:
            used.append(i)
    free = rows - len(used) - 1
    if free <= 0:
        return df.sparkSession.createDataFrame(empty, schema)
    inverse = np.linalg.inv(products[np.ix_(used, used)]) if used else np.zeros((0, 0))
    beta = inverse @ products[used, -1]
    total = products[-1, -1]
    residual = max(0.0, total - beta @ products[used, -1])
    variance = residual / free
    mean = np.array([means[f"m{i}"] for i in used])
    estimates = {i: (b, math.sqrt(variance * inverse[k, k])) for k, (i, b) in enumerate(zip(used, beta))}
    intercept = means[f"m{size - 1}"] - float(beta @ mean)
    estimates[size - 1] = (intercept, math.sqrt(variance * (1 / rows + mean @ inverse @ mean)))
    r2 = float(1 - residual / total) if total > 0 else None
    out = []
    for i, term in enumerate(names):
        if i not in estimates:
            out.append((term, None, None, None, None, r2, rows))
            continue
        estimate, error = map(float, estimates[i])
        t = estimate / error if error > 0 else None
        p = None if t is None else float(2 * student_tail(abs(t), free))
        out.append((term, estimate, error, t, p, r2, rows))
    return df.sparkSession.createDataFrame(out, schema)


def student_tail(t: float, degrees: int) -> float:
    """Upper tail of Student's t for whole degrees of freedom: half the incomplete beta function, by its fraction."""
    x = degrees / (degrees + t * t)
    a, b = degrees / 2, 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0
    if x >= 1:
        return 0.5

    def fraction(p: float, q: float, y: float) -> float:
        c, d = 1.0, 1 / max(1 - (p + q) * y / (p + 1), 1e-300)
        out = d
        for m in range(1, 10_000):
            for step in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
                d, c = 1 / ((1 + step * d) or 1e-300), (1 + step / c) or 1e-300
                out *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return out

    if x < (a + 1) / (a + b + 2):
        return front * fraction(a, b, x) / a / 2
    return (1 - front * fraction(b, a, 1 - x) / b) / 2


def ols_single(df: DataFrame, target: str, feature: str) -> DataFrame:
    """One-feature least squares as built-in aggregates, without a model fit."""
    data = regression_input(df, target, [feature])
    return data.agg(
        F.regr_slope(target, feature).alias("slope"),
        F.regr_intercept(target, feature).alias("intercept"),
        F.regr_r2(target, feature).alias("r2"),
        F.count(F.lit(1)).alias("rows"),
    )
