"""Seasonal regression forecasts: one small linear model per series, stepped day by day.

A series has one row per day, so fitting and stepping it in one task is bounded by its span;
many series are spread over the tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.operators import folds

LAGS = (1, 7, 14, 30)
TAIL_ROWS = 30
FEATURES = (
    "intercept", *[f"lag_{n}" for n in LAGS], "mean_7", "sin_1", "cos_1", "sin_2", "cos_2",
    "is_month_end", "is_quarter_end", "is_august", "fte_lost", "announced_volume",
)
FORECAST_SCHEMA = "series string, horizon int, day date, forecast double, low double, high double"


def _calendar(days: pd.Series) -> dict[str, np.ndarray]:
    d = pd.to_datetime(days)
    angle = 2 * math.pi * d.dt.dayofweek.to_numpy() / 7
    return {
        "intercept": np.ones(len(d)), "sin_1": np.sin(angle), "cos_1": np.cos(angle), "sin_2": np.sin(2 * angle),
        "cos_2": np.cos(2 * angle), "is_month_end": (d.dt.day >= 25).to_numpy().astype(float),
        "is_quarter_end": d.dt.month.isin([3, 6, 9, 12]).to_numpy().astype(float),
        "is_august": (d.dt.month == 8).to_numpy().astype(float),
    }


def design(history: pd.DataFrame) -> pd.DataFrame:
    """Regressors of each day from the rows before it."""
    out = _calendar(history["day"]) | {f"lag_{n}": history["y"].shift(n).to_numpy() for n in LAGS}
    out["mean_7"] = history["y"].shift(1).rolling(7, min_periods=1).mean().to_numpy()
    out["fte_lost"], out["announced_volume"] = history["fte_lost"].to_numpy(), history["announced_volume"].to_numpy()
    return pd.DataFrame(out)[list(FEATURES)]


def _fit(history: pd.DataFrame) -> pd.DataFrame:
    history = history.sort_values("day").reset_index(drop=True)
    x, y = design(history), history["y"]
    known = (x.notna().all(axis=1) & y.notna()).to_numpy()
    split = int(len(history) * 0.85)
    early = known & (np.arange(len(history)) < split)
    late = known & ~early

    def solve(rows: np.ndarray) -> np.ndarray:
        # A light ridge keeps constant regressors (no event yet) at zero.
        a, b = x[rows].to_numpy(), y[rows].to_numpy()
        return np.linalg.solve(a.T @ a + 1e-6 * len(a) * np.eye(a.shape[1]), a.T @ b)

    if early.sum() < len(FEATURES) or late.sum() == 0:
        return pd.DataFrame({"series": [], "coefficients": [], "mae": [], "rmse": []})
    error = y[late].to_numpy() - x[late].to_numpy() @ solve(early)
    return pd.DataFrame({"series": [history["series"].iloc[0]], "coefficients": [solve(known).tolist()],
                         "mae": [float(np.abs(error).mean())], "rmse": [float(np.sqrt((error ** 2).mean()))]})


def train_seasonal_arx(daily: DataFrame) -> DataFrame:
    """Coefficients per series with MAE and RMSE on its last 15 %.

    `daily` has (series, day, y, fte_lost, announced_volume), one row per business day.
    """
    return daily.select("series", "day", "y", "fte_lost", "announced_volume").groupBy("series").applyInPandas(
        _fit, "series string, coefficients array<double>, mae double, rmse double")


def _step(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("day").reset_index(drop=True)
    weights, margin = np.asarray(rows["coefficients"].iloc[0]), float(rows["rmse"].iloc[0])
    past = rows.loc[rows["horizon"] == 0, "y"].tolist()
    ahead = rows[rows["horizon"] > 0].reset_index(drop=True)
    known = pd.DataFrame(_calendar(ahead["day"])).assign(
        fte_lost=ahead["fte_lost"].to_numpy(), announced_volume=ahead["announced_volume"].to_numpy())
    made = []
    for i in range(len(ahead)):
        step = known.iloc[i].to_dict() | {f"lag_{n}": past[-n] if len(past) >= n else past[0] for n in LAGS}
        step["mean_7"] = float(np.mean(past[-7:]))
        past.append(float(np.dot(weights, [step[f] for f in FEATURES])))
        made.append(past[-1])
    y = np.asarray(made)
    return pd.DataFrame({"series": rows["series"].iloc[0], "horizon": ahead["horizon"], "day": ahead["day"],
                         "forecast": np.round(y), "low": np.round(y - margin), "high": np.round(y + margin)})


def forecast_recursive(daily: DataFrame, fitted: DataFrame, ahead: DataFrame) -> DataFrame:
    """Next business days of every series; each step feeds its own lags.

    `ahead` has (series, horizon, day, fte_lost, announced_volume). Only the last 30 rows of a
    series are needed to start.
    """
    back = Window.partitionBy("series").orderBy(F.desc("day"))
    tail = daily.withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= TAIL_ROWS).select(
        "series", "day", F.lit(0).alias("horizon"), "y", "fte_lost", "announced_volume")
    future = ahead.select("series", "day", "horizon", F.lit(None).cast("double").alias("y"), "fte_lost", "announced_volume")
    rows = tail.unionByName(future).join(fitted.select("series", "coefficients", "rmse"), "series")
    return rows.groupBy("series").applyInPandas(_step, FORECAST_SCHEMA)


LOAD_FEATURES = (
    *[f"volume_lag_{n}" for n in LAGS], *[f"fte_lag_{n}" for n in LAGS], "volume_mean_7", "load_mean_7", "fte",
    "sin_1", "cos_1", "is_month_end", "is_quarter_end",
)
MEAN_ROWS, LEAST_FTE = 7, 0.1


def _load_design(rows: DataFrame) -> DataFrame:
    """Regressors of a day's load: calendar, staff of the day, and lags and means of the rows before it."""
    w = Window.partitionBy("series").orderBy("day")
    before = w.rowsBetween(-MEAN_ROWS, -1)
    angle = F.weekday("day") * (2 * math.pi / 7)
    return rows.withColumns(
        {f"{c}_lag_{n}": F.lag(F.col(c).cast("double"), n).over(w) for c in ("volume", "fte") for n in LAGS}
        | {"volume_mean_7": F.avg("volume").over(before), "load_mean_7": F.avg("load").over(before), "sin_1": F.sin(angle), "cos_1": F.cos(angle),
           "is_month_end": (F.day("day") >= 25).cast("double"), "is_quarter_end": F.month("day").isin(3, 6, 9, 12).cast("double")})


def train_load_model(daily: DataFrame, ridge: float = 1.0) -> DataFrame:
    """(series, train_rows, weights): a linear load model per series, the intercept first.

    `daily` has (series, day, volume, fte, load). The sums of all series are added up together; no series is gathered.
    """
    rows = _load_design(daily).select("series", F.xxhash64("series").alias("_k"), *[F.col(f).cast("double").alias(f) for f in LOAD_FEATURES], "load").na.drop()
    return folds.fits_by(rows, "series", LOAD_FEATURES, "load", ridge)


def load_forecast_recursive(daily: DataFrame, ahead: DataFrame, fitted: DataFrame) -> DataFrame:
    """Load of the next days of every series, by a model trained beforehand.

    `ahead` has (series, horizon, day, volume, fte, fte_lost). Volume and staff of the days ahead are known, so all terms but one are
    columns; the mean of the last seven loads is the state that the days are folded over, and it is fed with the
    forecasts themselves, never with the adjusted ones. Only the last 30 rows of a series are read. A series without so many
    rows has no forecast (null).
    """
    back = Window.partitionBy("series").orderBy(F.desc("day"))
    tail = daily.withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= TAIL_ROWS)
    w = Window.partitionBy("series").orderBy("day")

    def filled(c: str) -> Column:
        """A missing value is the last known one, else the next one."""
        before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
        return F.coalesce(F.last(F.col(c).cast("double"), ignorenulls=True).over(before), F.first(F.col(c).cast("double"), ignorenulls=True).over(after)).alias(c)

    known = tail.select("series", "day", F.lit(0).alias("horizon"), filled("volume"), filled("fte"), "load", F.lit(0.0).alias("fte_lost"))
    future = ahead.select("series", "day", "horizon", F.col("volume").cast("double").alias("volume"), "fte",
                          F.lit(None).cast("double").alias("load"), F.coalesce("fte_lost", F.lit(0.0)).alias("fte_lost"))
    rows = _load_design(known.unionByName(future)).join(fitted.select("series", "weights"), "series")
    at = {f: F.get("weights", F.lit(i)) for i, f in enumerate(LOAD_FEATURES, 1)}
    base = F.get("weights", F.lit(0))
    for f in LOAD_FEATURES:
        base = base + (at[f] * F.col(f) if f != "load_mean_7" else F.lit(0.0))
    reduced = F.when(F.col("fte_lost") > 0, F.greatest(F.col("fte") - F.col("fte_lost"), F.lit(LEAST_FTE))).otherwise(F.col("fte"))
    step = F.struct("horizon", "day", "fte", "volume", base.alias("base"), (base + at["fte"] * (reduced - F.col("fte"))).alias("adjusted"))
    gathered = rows.groupBy("series").agg(  # the tail and the days ahead of one series
        F.first(at["load_mean_7"]).alias("weight"),
        F.sort_array(F.collect_list(F.when(F.col("horizon") == 0, F.struct("day", "load")))).alias("tail"),
        F.sort_array(F.collect_list(F.when(F.col("horizon") > 0, step))).alias("steps"))

    def last(loads: Column) -> Column:
        return F.slice(loads, F.greatest(F.size(loads) - (MEAN_ROWS - 1), F.lit(1)), F.lit(MEAN_ROWS))

    def mean(loads: Column) -> Column:
        some = F.filter(loads, lambda x: x.isNotNull())
        return F.coalesce(F.try_divide(F.aggregate(some, F.lit(0.0), lambda t, x: t + x), F.size(some).cast("double")), F.lit(0.0))

    def advance(state: Column, x: Column) -> Column:
        carried = F.col("weight") * mean(state["loads"])
        made = F.struct(x["horizon"].alias("horizon"), x["day"].alias("day"), x["fte"].alias("fte"), x["volume"].alias("volume"),
                        (x["base"] + carried).alias("load_forecast"), (x["adjusted"] + carried).alias("load_adjusted"))
        return F.struct(last(F.concat(state["loads"], F.array(x["base"] + carried))).alias("loads"), F.concat(state["out"], F.array(made)).alias("out"))

    start = F.struct(last(F.transform("tail", lambda x: x["load"])).alias("loads"),
                     F.array().cast("array<struct<horizon:int,day:date,fte:double,volume:double,load_forecast:double,load_adjusted:double>>").alias("out"))
    return gathered.select("series", F.explode(F.aggregate("steps", start, advance, lambda s: s["out"])).alias("x")).select("series", "x.*")


def _lagged(daily: DataFrame) -> DataFrame:
    """Daily rows of one series with the regressors as columns, rows with a missing lag left out."""
    w = Window.partitionBy("series").orderBy("day")
    angle = F.weekday("day") * (2 * math.pi / 7)
    return daily.select(
        "series", "day", "y", *[F.lag("y", n).over(w).alias(f"lag_{n}") for n in LAGS],
        F.avg("y").over(w.rowsBetween(-7, -1)).alias("mean_7"), F.sin(angle).alias("sin_1"), F.cos(angle).alias("cos_1"),
    ).na.drop()


LAG_FEATURES = (*[f"lag_{n}" for n in LAGS], "mean_7", "sin_1", "cos_1")


def walk_forward_scores(daily: DataFrame, window: int = 120, ahead: int = 14) -> DataFrame:
    """Every day that a sliding window predicts: (day, y, fold, train_rows, score)."""
    scored = folds.walk_forward(_lagged(daily), "day", ["series"], LAG_FEATURES, "y", window, ahead)
    return scored.select("day", "y", "fold", "train_rows", "score")


def expanding_curve(daily: DataFrame, steps: int = 10) -> DataFrame:
    """Training and validation error of fits on growing leading parts of the training days."""
    return folds.growing_fits(_lagged(daily), "day", ["series"], LAG_FEATURES, "y", steps)


def forward_search(daily: DataFrame, ridges: tuple[float, ...] = (1e-3, 0.1, 1.0, 10.0, 100.0, 1000.0)) -> DataFrame:
    """Ridge of the lag model, chosen over five forward folds."""
    return folds.best_ridge(folds.forward_search(_lagged(daily), "day", ["series"], LAG_FEATURES, "y", ridges))
