"""Descriptive statistics of any table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.functions.reuse import shared
from opsloom.operators.ordering import exact_percentiles


def value_counts(df: DataFrame, column: str) -> DataFrame:
    known = df.where(F.col(column).isNotNull())
    return known.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def crosstab_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def rate_by_category(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Target percentage per value of each column, highest first."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category"))
                                for c in columns]))
    return (df.select(F.col(target).alias("_y"), pairs.alias("p")).where(F.col("p.category").isNotNull())
            .groupBy("p.column_name", "p.category")
            .agg((F.avg("_y") * 100).alias("rate_pct"), F.count(F.lit(1)).alias("n"))
            .orderBy("column_name", F.desc("rate_pct"), "category"))


def describe_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum, one row per column.

    One pass over the rows counts the values of all columns; every figure comes from these counts.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns]))
    counts = shared(df.select(pairs.alias("p")).where(F.col("p.v").isNotNull())
                    .groupBy("p.column_name", "p.v").agg(F.count(F.lit(1)).alias("n")))
    sums = counts.groupBy("column_name").agg(
        F.sum("n").alias("n"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"))
    means = F.broadcast(sums.select("column_name", F.col("n").alias("_all"), "mean"))  # a row per column
    squares = counts.join(means, "column_name").groupBy("column_name").agg(F.sqrt(F.try_divide(
        F.sum(F.col("n") * (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean"))), F.max("_all") - 1)).alias("std"))
    quartiles = exact_percentiles(counts, "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by=["column_name"], weight="n")
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "place int, column_name string")
    out = names.join(sums, "column_name", "left").join(squares, "column_name", "left").join(quartiles, "column_name", "left")
    return out.fillna(0, ["n"]).orderBy("place").select("column_name", "n", "mean", "std", "min", "p25", "p50", "p75", "max")


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Five-number summary per group."""
    return exact_percentiles(df, value, {"low": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "high": 1.0}, by=by)


def histogram(df: DataFrame, value: str, bins: int, clip_share: float | None = None) -> DataFrame:
    """Equal-width counts from the minimum to the maximum, or to a percentile above which values are clipped."""
    known = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    if clip_share is not None:
        limit = exact_percentiles(known, "v", {"limit": clip_share})
        known = known.withColumn("v", F.least("v", limit.scalar()))
    span = known.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s"))
    width = (F.col("s.hi") - F.col("s.lo")) / bins
    place = F.least(F.floor((F.col("v") - F.col("s.lo")) / width), F.lit(bins - 1)).cast("int")
    placed = known.withColumn("s", span.scalar()).withColumn("bin", F.when(width > 0, place).otherwise(0))
    return placed.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("s.lo") + F.col("bin") * width).alias("bin_start"))


def ols_trend(df: DataFrame, y: str, x: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def mean_by_flags(df: DataFrame, value: str, flags: Sequence[str]) -> DataFrame:
    """Mean of a value by each calendar column, stacked."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("effect"), F.col(c).cast("int").alias("level"))
                                for c in flags]))
    return df.select(F.col(value).cast("double").alias("_v"), pairs.alias("p")).groupBy("p.effect", "p.level").agg(
        F.avg("_v").alias("mean_value"), F.count(F.lit(1)).alias("n"))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson coefficients of column pairs from one pass; rows with a null in a pair are left out of it.

    Each row is expanded to its pairs and merged at once on the map side: one small aggregate
    runs compiled, where a wide one with a coefficient per pair is too large for that.
    """
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("double").alias("x"),
                              F.col(b).cast("double").alias("y")) for a, b in pairs])
    return df.select(F.explode(rows).alias("r")).groupBy("r.a", "r.b").agg(F.corr("r.x", "r.y").alias("corr"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All ordered pairs; each unordered pair is computed once and shown both ways."""
    names = list(columns)
    half = correlations(df, [(a, b) for i, a in enumerate(names) for b in names[i:]])
    here, there = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = F.when(F.col("a") == F.col("b"), F.array(here)).otherwise(F.array(here, there))
    return half.select(F.explode(both).alias("p"), "corr").select("p.a", "p.b", "corr")


def correlation_ranked(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    out = correlations(df, [(c, target) for c in columns]).select(F.col("a").alias("feature"), "corr")
    return out.orderBy(F.desc(F.abs("corr")), "feature")


def share_of_total(df: DataFrame, key: str, value: str) -> DataFrame:
    """Share of each key in the total; the total comes from the grouped rows."""
    sums = df.groupBy(key).agg(F.sum(value).cast("double").alias("_s"))
    return sums.withColumn("share", F.col("_s") / sums.agg(F.sum("_s")).scalar()).drop("_s")


def zero_filled_pivot(df: DataFrame, split: str, actual: str, predicted: str) -> DataFrame:
    """Counts of actual by predicted class per split, dense with zeros."""
    cells = {f"n_{a}{p}": F.count_if((F.col(actual) == a) & (F.col(predicted) == p)) for a in (0, 1) for p in (0, 1)}
    return df.groupBy(split).agg(*[c.alias(n) for n, c in cells.items()])
