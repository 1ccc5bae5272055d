"""Daily series: lags, rolling means, calendars, splits, decomposition and simple forecasts.

A daily series has one row per day (and service), so a window over it holds at most the days
of its span, whatever the size of the tables it came from. Row-level tables are split with
cut keys from `ordering`, never with a global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions.reuse import shared
from opsloom.operators.ordering import global_position, nth_key, tie_key

LAGS = (1, 7, 14, 30)


def series(by: Sequence[str] = ()):
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def lags(df: DataFrame, day: str, columns: Sequence[str], by: Sequence[str] = (), steps: Sequence[int] = LAGS) -> DataFrame:
    """Values some rows earlier in the series."""
    w = series(by).orderBy(day)
    return df.withColumns({f"{c}_lag_{n}": F.lag(c, n).over(w) for c in columns for n in steps})


def rolling_mean(df: DataFrame, day: str, columns: Sequence[str], by: Sequence[str] = (), rows: int = 7) -> DataFrame:
    """Mean of the last rows including this one; nulls are skipped, one value is enough."""
    w = series(by).orderBy(day).rowsBetween(-(rows - 1), 0)
    return df.withColumns({f"{c}_mean_{rows}": F.avg(c).over(w) for c in columns})


def tail_means(df: DataFrame, day: str, spans: Sequence[tuple[str, int]]) -> DataFrame:
    """Mean of the last n rows per (column, n), one row."""
    ranked = df.withColumn("_r", F.row_number().over(series().orderBy(F.desc(day))))
    return ranked.agg(*[F.avg(F.when(F.col("_r") <= n, F.col(c))).alias(f"{c}_last_{n}") for c, n in spans])


def recent_window(df: DataFrame, day: str, days: int | None) -> DataFrame:
    """Rows within some days of the latest date; everything for None."""
    if days is None:
        return df
    latest = df.agg(F.max(day))
    return df.where(F.col(day) >= F.date_sub(latest.scalar(), days))


def most_loaded_frequency(daily: DataFrame) -> DataFrame:
    """Days on which each service carried the highest load; zero for the others."""
    top = daily.where(F.col("load").isNotNull()).groupBy("day").agg(
        F.min(F.struct((-F.col("load")).alias("l"), "service")).alias("t"))
    leads = top.groupBy(F.col("t.service").alias("service")).agg(F.count(F.lit(1)).alias("days_in_lead"))
    return daily.select("service").distinct().join(leads, "service", "left").fillna(0, ["days_in_lead"])


def alert_streak(daily: DataFrame, span: int = 14) -> DataFrame:
    """Length of the current run of alert days within the last rows of each service."""
    back = F.row_number().over(series(["service"]).orderBy(F.desc("day")))
    recent = daily.withColumn("_r", back).where(F.col("_r") <= span)
    first_calm = F.min(F.when(F.col("alert") != 1, F.col("_r")))
    return recent.groupBy("service").agg(
        (F.coalesce(first_calm, F.max("_r") + 1) - 1).cast("bigint").alias("streak"))


def chrono_split(df: DataFrame, day: str, ties: Sequence[str | Column], train: float = 0.70, validation: float = 0.15) -> DataFrame:
    """First int(.70 n) rows by time, next int(.15 n), rest; label each row by two cut keys.

    The cut rows are found from counts, so the labelling itself is a filter-free projection.
    Equal copies of a row always fall on the same side.
    """
    keyed = df.withColumn("_tie", tie_key(*ties))
    total = df.agg(F.count(F.lit(1)).alias("n"))
    n_train = F.floor(total.scalar() * F.lit(train))
    n_both = n_train + F.floor(total.scalar() * F.lit(validation))
    first, second = nth_key(keyed, day, "_tie", n_train), nth_key(keyed, day, "_tie", n_both)
    here = F.struct(F.col(day).alias("d"), F.col("_tie").alias("t"))
    label = (F.when(here <= F.col("_k1"), "train").when(here <= F.col("_k2"), "validation").otherwise("test"))
    return keyed.withColumn("_k1", first.scalar()).withColumn("_k2", second.scalar()).withColumn(
        "split", label).drop("_tie", "_k1", "_k2")


def split_by_cutoff(df: DataFrame, day: str, train_end, validation_end) -> DataFrame:
    return df.withColumn("split", F.when(F.col(day) <= F.lit(train_end), "train")
                         .when(F.col(day) <= F.lit(validation_end), "validation").otherwise("test"))


def fold_rows(numbered: DataFrame, total: Column, window: int, ahead: int, position: str = "position") -> DataFrame:
    """Sliding folds: `window` training rows, then `ahead` rows to predict, moving by `ahead`.

    Every row joins at most window/ahead + 2 folds, whatever the length of the table.
    """
    columns, numbered = numbered.columns, numbered.withColumn("_n", total)
    p = F.col(position) - 1
    last = F.floor((F.col("_n") - window) / ahead) - 1
    low = F.greatest(F.floor((p - window) / ahead) + 1, F.lit(0))
    high = F.least(F.floor(p / ahead), last)
    train = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    ahead_fold = F.floor((p - window) / ahead)
    predict = F.when((p >= window) & (ahead_fold <= last), F.array(F.struct(
        ahead_fold.alias("fold"), F.lit("predict").alias("role")))).otherwise(
        F.array().cast("array<struct<fold:bigint,role:string>>"))
    members = F.concat(F.transform(train, lambda k: F.struct(k.alias("fold"), F.lit("train").alias("role"))), predict)
    return numbered.withColumn("_m", F.explode(members)).select(*columns, "_m.fold", "_m.role")


def walk_forward_folds(df: DataFrame, day: str, ties: Sequence[str | Column], window: int, ahead: int) -> DataFrame:
    keyed = df.withColumn("_tie", tie_key(*ties))
    numbered = global_position(keyed, day, "_tie").drop("_tie")
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return fold_rows(numbered, total.scalar(), window, ahead)


def time_series_cv(daily: DataFrame, day: str, folds: int = 5) -> DataFrame:
    """Forward folds: test size n div (folds + 1), training on everything before."""
    total = daily.agg(F.count(F.lit(1)).alias("n"))
    numbered = daily.withColumn("_p", F.row_number().over(series().orderBy(day)) - 1).withColumn("_n", total.scalar())
    size = F.floor(F.col("_n") / (folds + 1))
    start = F.col("_n") - size * (folds - F.col("fold"))
    rows = numbered.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    role = F.when(F.col("_p") < start, "train").when(F.col("_p") < start + size, "test")
    return rows.withColumn("role", role).where(F.col("role").isNotNull()).drop("_p", "_n")


def calendar_fill(daily: DataFrame, day: str, interpolate: Sequence[str], forward: Sequence[str] = ()) -> DataFrame:
    """Every day from first to last; targets by straight line, regressors by the last known value.

    Leading gaps stay null and trailing ones keep the last value.
    """
    span = daily.agg(F.sequence(F.min(day), F.max(day)).alias("s"))
    full = span.select(F.explode("s").alias(day)).join(daily, day, "left")
    past = series().orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    ahead = series().orderBy(day).rowsBetween(0, Window.unboundedFollowing)

    def line(c: str) -> Column:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col(day).alias("d"), F.col(c).cast("double").alias("v")))
        before, after = F.last(known, ignorenulls=True).over(past), F.first(known, ignorenulls=True).over(ahead)
        share = F.datediff(F.col(day), before["d"]) / F.datediff(after["d"], before["d"])
        return (F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(after["d"].isNull(), before["v"])
                .otherwise(before["v"] + (after["v"] - before["v"]) * share))

    filled = {c: line(c) for c in interpolate} | {c: F.last(c, ignorenulls=True).over(past) for c in forward}
    return full.withColumns(filled).select(day, *interpolate, *forward)


def acf(daily: DataFrame, day: str, value: str, max_lag: int = 21) -> DataFrame:
    """Autocorrelation at lags 0 to max_lag."""
    w = series().orderBy(day)
    mean = daily.agg(F.avg(value))
    centred = daily.withColumn("_x", F.col(value) - mean.scalar())
    shifted = centred.select("_x", *[F.lag("_x", k).over(w).alias(f"_x{k}") for k in range(1, max_lag + 1)])
    sums = shifted.agg(F.sum(F.col("_x") * F.col("_x")).alias("_s0"),
                       *[F.sum(F.col("_x") * F.col(f"_x{k}")).alias(f"_s{k}") for k in range(1, max_lag + 1)])
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), (F.col(f"_s{k}") / F.col("_s0")).alias("acf"))
                     for k in range(max_lag + 1)])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def seasonal_decompose(daily: DataFrame, day: str, value: str, period: int = 7) -> DataFrame:
    """Additive parts: centred mean, centred seasonal means by phase, and the rest."""
    half = period // 2
    w = series().orderBy(day)
    centred = w.rowsBetween(-half, half)
    rows = daily.select(
        day, F.col(value).alias("value"), ((F.row_number().over(w) - 1) % period).alias("phase"),
        F.when(F.count(value).over(centred) == period, F.avg(value).over(centred)).alias("trend"))
    phases = rows.groupBy("phase").agg(F.avg(F.col("value") - F.col("trend")).alias("_m"))
    phases = phases.select("phase", (F.col("_m") - F.avg("_m").over(series())).alias("seasonal"))
    return rows.join(phases, "phase").select(
        day, "value", "trend", "seasonal", (F.col("value") - F.col("trend") - F.col("seasonal")).alias("residual"))


def naive_forecasts(daily: DataFrame, day: str, value: str, week: int = 5, train: float = 0.70, validation: float = 0.15) -> DataFrame:
    """Error of four forecasts without a model on the test rows: MAE and MAPE (zeros skipped)."""
    w = series().orderBy(day)
    total = daily.agg(F.count(F.lit(1)).alias("n"))
    rows = daily.select(
        F.col(value).alias("y"), F.row_number().over(w).alias("_p"), F.lag(value, 1).over(w).alias("previous_day"),
        F.lag(value, week).over(w).alias("same_weekday"),
        F.avg(value).over(w.rowsBetween(-7, -1)).alias("mean_7")).withColumn("_n", total.scalar())
    n_train = F.floor(F.col("_n") * train)
    rows = shared(rows)
    train_mean = rows.where(F.col("_p") <= n_train).agg(F.avg("y"))
    test = rows.where(F.col("_p") > n_train + F.floor(F.col("_n") * validation)).withColumn("train_mean", train_mean.scalar())
    methods = ["train_mean", "previous_day", "same_weekday", "mean_7"]
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).alias("p")) for m in methods]))
    error = F.abs(F.col("y") - F.col("f.p"))
    return test.select("y", pairs.alias("f")).groupBy(F.col("f.method").alias("method")).agg(
        F.avg(error).alias("mae"), (F.avg(F.when(F.col("y") != 0, error / F.abs("y"))) * 100).alias("mape"))


def next_business_days(last: DataFrame, n: int) -> DataFrame:
    """The next n Monday-to-Friday days after the date of a one-row table, numbered from 1."""
    column = last.columns[0]
    span = F.sequence(F.date_add(F.col(column), 1), F.date_add(F.col(column), n + 2 * (n // 5 + 2)))
    days = last.select(F.explode(span).alias("day")).where(F.weekday("day") < 5)
    return days.withColumn("horizon", F.row_number().over(series().orderBy("day"))).where(F.col("horizon") <= n)


def reindex_forecast_dates(forecast: DataFrame, days: DataFrame) -> DataFrame:
    """Replace the date of each forecast row by the business day of its horizon number."""
    return forecast.drop("day").join(days.select("horizon", "day"), "horizon")
