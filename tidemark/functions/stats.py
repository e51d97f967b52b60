"""Quantiles and tests as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def interpolated(values: Column, q: float) -> Column:
    """Quantile of an array without nulls, at position q (n - 1), between neighbours by a straight line; null of none."""
    ordered = F.array_sort(values)
    at = F.lit(q) * (F.size(values) - 1)
    low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
    a, b = F.get(ordered, low), F.get(ordered, high)
    return F.when(F.size(values) > 0, a + (b - a) * (at - low))


def quantile(value: str, q: float) -> Column:
    """Exact quantile of a group whose size is bounded (years of a day, months of a region)."""
    return interpolated(F.collect_list(F.col(value)), q)


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > |t|) for Student's distribution by the series of the incomplete beta function."""
    v = df.cast("double")
    a = v / 2
    x = v / (v + t * t)

    def series(p: Column, q: Column, z: Column) -> Column:
        step = F.aggregate(
            F.sequence(F.lit(0), F.lit(199)),
            F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
            lambda s, m: F.struct((s["term"] * z * (p + q + m) / (p + 1 + m)).alias("term"), (s["sum"] + s["term"]).alias("sum")),
            lambda s: s["sum"],
        )
        return F.pow(z, p) * F.pow(1 - z, q) / p * step

    half = F.lit(0.5)
    even = 2.0 * F.aggregate(F.when(v >= 4, F.sequence(F.lit(1), (v / 2).cast("int") - 1)).otherwise(F.array().cast("array<int>")), F.lit(1.0), lambda s, k: s * k / (k + 0.5))
    odd = F.lit(3.141592653589793) * F.aggregate(
        F.when(v >= 3, F.sequence(F.lit(0), ((v - 1) / 2).cast("int") - 1)).otherwise(F.array().cast("array<int>")), F.lit(1.0), lambda s, k: s * (k + 0.5) / (k + 1)
    )
    beta = F.when(v % 2 == 0, even).otherwise(odd)
    return F.when(t.isNull() | (v < 1), F.lit(None).cast("double")).when(t == 0, 1.0).when(x < 0.5, series(a, half, x) / beta).otherwise(1 - series(half, a, 1 - x) / beta)
