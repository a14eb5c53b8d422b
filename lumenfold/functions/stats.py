"""Statistics as column expressions: Student's t by table, Welch's test, sample sizes. Three kinds of percentile, never mixed."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Degrees of freedom and the two-sided 5 % point of Student's t.
T_TABLE = ((1, 12.706), (2, 4.303), (3, 3.182), (4, 2.776), (5, 2.571), (10, 2.228), (20, 2.086), (30, 2.042), (60, 2.000), (120, 1.980))
#: The normal distribution's point for each one-sided level.
Z_POINTS = {0.025: 1.96, 0.05: 1.645, 0.005: 2.576}


def t_critical(df: Column, alpha: float = 0.025) -> Column:
    """Linear between the table's rows for alpha 0.025; the normal point beyond it, and for other levels."""
    z = F.lit(Z_POINTS.get(alpha, 1.96))
    if alpha != 0.025:
        return z
    out = F.when(df > T_TABLE[-1][0], z)
    for (a, low), (b, high) in zip(T_TABLE, T_TABLE[1:], strict=False):
        out = out.when((df >= a) & (df <= b), F.lit(low) + (df - a) / (b - a) * (high - low))
    return out.otherwise(F.lit(T_TABLE[0][1]))


def p_value(t: Column, df: Column) -> Column:
    """A step function: 0.10, 0.03 or 0.005."""
    t = F.abs(t)
    return F.when(t < t_critical(df), 0.10).when(t < t_critical(df, 0.005), 0.03).otherwise(0.005)


def confidence_interval(value: Column) -> tuple[Column, Column]:
    """Aggregates: mean minus and plus t * s / sqrt(n); the value itself for n = 1."""
    n = F.count(value)
    half = F.when(n > 1, t_critical(n - 1) * F.stddev_samp(value) / F.sqrt(n)).otherwise(0.0)
    return F.avg(value) - half, F.avg(value) + half


def variation(value: Column) -> Column:
    """Aggregate: the population deviation over the mean; infinite for mean 0."""
    return F.when(F.avg(value) == 0, F.lit(float("inf"))).otherwise(F.stddev_pop(value) / F.avg(value))


def nearest_rank(value: Column, p: float) -> Column:
    """Aggregate: the element at floor(n * p) of the sorted values."""
    values = F.sort_array(F.collect_list(value))
    return F.get(values, F.least(F.floor(F.size(values) * p), F.size(values) - 1).cast("int"))


def required_sample_size(effect: Column, power_z: float = 0.84, alpha_z: float = 1.96) -> Column:
    return F.greatest(F.lit(2), F.ceil(2 * F.pow((alpha_z + power_z) / effect, F.lit(2.0))))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Clamped to 0 and 1; 0 if the range is empty."""
    return F.when(high <= low, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - low) / (high - low))))


def t_critical_sql(df: str) -> str:
    """``t_critical`` as SQL."""
    steps = " ".join(f"WHEN {df} BETWEEN {a} AND {b} THEN {low} + ({df} - {a}) / {float(b - a)} * ({high - low!r})" for (a, low), (b, high) in zip(T_TABLE, T_TABLE[1:], strict=False))
    return f"(CASE WHEN {df} > 120 THEN 1.96 {steps} ELSE 12.706 END)"


def t_critical_value(df: float) -> float:
    """``t_critical`` of a number, for tests."""
    if df > 120:
        return 1.96
    for (a, low), (b, high) in zip(T_TABLE, T_TABLE[1:], strict=False):
        if a <= df <= b:
            return low + (df - a) / (b - a) * (high - low)
    return 12.706 if df <= 1 or math.isnan(df) else 1.96
