"""Linear fits on many overlapping parts of a table without copying its rows.

The sums that a least-squares fit needs (of all products of regressors, target and one) are additive. Rows are cut into
the pieces between all fold edges and summed once per piece; a fold, a growing sample or a forward split is then a sum
of a few pieces, whatever its length. Rows are read once for the sums and once for the scores, and the second
pass is a projection over an equality join with one row per fold.

Regressors are shifted by their means before they are summed, so the sums lose no digits to large levels. A
fit standardises its regressors by its own rows and adds `ridge` to the diagonal; the intercept is free. Rows with a
missing regressor or target must have been left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.functions.reuse import shared
from opsloom.operators.ordering import global_position, tie_key


def _shifts(rows: DataFrame, features: Sequence[str]) -> np.ndarray:
    means = rows.agg(*[F.avg(F.col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(features)]).first()
    return np.array([m or 0.0 for m in means])


def piece_sums(rows: DataFrame, keys: dict[str, Column], features: Sequence[str], target: str, shifts: np.ndarray) -> DataFrame:
    """(keys, s): sums of the products of (1, regressors, target) for each piece, as one array."""
    names, wide = list(keys), len(features) + 2
    upper = np.triu_indices(wide)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = np.column_stack([np.ones(len(batch)), batch[list(features)].to_numpy(float) - shifts, batch[target].to_numpy(float)])
            out = []
            for key, places in batch.groupby(names, sort=False).indices.items():
                own = z[places]
                out.append((*(key if isinstance(key, tuple) else (key,)), (own.T @ own)[upper].tolist()))
            yield pd.DataFrame(out, columns=[*names, "s"])

    chosen = rows.select(*[c.cast("long").alias(n) for n, c in keys.items()],
                         *[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*features, target])])
    parts = chosen.mapInPandas(summed, ", ".join(f"{n} long" for n in names) + ", s array<double>")
    return _added(parts, names, len(upper[0]))


def _added(parts: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    sums = parts.groupBy(*keys).agg(*[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(size)])
    return sums.select(*keys, F.array(*[f"s{i}" for i in range(size)]).alias("s"))


def solved(sums: np.ndarray, wide: int, ridge: float) -> np.ndarray:
    """(rows, intercept, weights) of one array of sums, for shifted regressors."""
    full = np.zeros((wide, wide))
    full[np.triu_indices(wide)] = sums
    full = full + np.triu(full, 1).T
    n, mean = full[0, 0], full[0] / full[0, 0]
    centred = full - n * np.outer(mean, mean)
    a, b = centred[1:-1, 1:-1], centred[1:-1, -1]
    scale = np.sqrt(np.maximum(np.diag(a), 0.0) / n)
    scale[scale <= 1e-12 * (1.0 + np.abs(mean[1:-1]))] = 1.0  # a constant regressor has weight zero
    a = a / np.outer(scale, scale) + ridge * np.eye(len(a))
    weights = (np.linalg.solve(a, b / scale) if ridge > 0 else np.linalg.lstsq(a, b / scale, rcond=1e-12)[0]) / scale
    return np.concatenate([[n, mean[-1] - weights @ mean[1:-1]], weights])


def _fits(sums: DataFrame, key: str, wide: int, ridge: float) -> DataFrame:
    """(key, train_rows, weights): the intercept, then the weights."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [solved(np.array(s), wide, ridge) for s in batch["s"]]
            yield pd.DataFrame({key: batch[key], "train_rows": [int(f[0]) for f in found], "weights": [f[1:].tolist() for f in found]})

    return sums.mapInPandas(solve, f"{key} long, train_rows long, weights array<double>")


def _predicted(features: Sequence[str], shifts: np.ndarray, weights: str = "weights") -> Column:
    out = F.get(weights, F.lit(0))
    for i, (f, m) in enumerate(zip(features, shifts.tolist()), 1):
        out = out + F.get(weights, F.lit(i)) * (F.col(f).cast("double") - F.lit(m))
    return out


def numbered(rows: DataFrame, day: str, ties: Sequence[str | Column]) -> DataFrame:
    """Add `_p`, the place from 0 by day and ties, found without a global sort."""
    placed = global_position(rows.withColumn("_tie", tie_key(*ties)), day, "_tie", "_p").drop("_tie")
    return shared(placed.withColumn("_p", F.col("_p") - 1))


def walk_forward(rows: DataFrame, day: str, ties: Sequence[str | Column], features: Sequence[str], target: str, window: int, ahead: int,
                 ridge: float = 1e-3) -> DataFrame:
    """Every row that a sliding fold predicts, with `fold`, `train_rows` and `score`.

    Fold k is fitted on `window` rows from k * ahead on and scores the `ahead` rows behind them, as in `fold_rows`.
    """
    placed = numbered(rows, day, ties)
    last = placed.agg(F.floor((F.count(F.lit(1)) - window) / ahead) - 1).first()[0]
    shifts, wide = _shifts(placed, features), len(features) + 2
    p = F.col("_p")
    # Dealt by place: rows of a piece meet before they are summed, or nearly every row would send sums of its own.
    dealt = placed.repartition(F.floor(p / ahead)).sortWithinPartitions("_p")
    pieces = piece_sums(dealt, {"_a": F.floor(p / ahead), "_b": F.floor((p - window) / ahead)}, features, target, shifts)
    low, high = F.greatest(F.col("_b") + 1, F.lit(0)), F.least(F.col("_a"), F.lit(last))
    folds = pieces.where(low <= high).select(F.explode(F.sequence(low, high)).alias("fold"), "s")
    fits = _fits(_added(folds, ["fold"], wide * (wide + 1) // 2), "fold", wide, ridge)
    ahead_of = F.floor((p - window) / ahead)
    scored = placed.where((p >= window) & (ahead_of <= last)).withColumn("fold", ahead_of).join(fits, "fold")
    return scored.withColumn("score", _predicted(features, shifts)).drop("_p", "weights")


def _segment(cuts: Sequence[int]) -> Column:
    """Number of cuts at or below the place of a row."""
    out = F.lit(0)
    for c in cuts:
        out = out + (F.col("_p") >= F.lit(c)).cast("int")
    return out


def _prefix_fits(pieces: DataFrame, ends: Sequence[int], wide: int, ridges: Sequence[float]) -> list[list[np.ndarray]]:
    """For each number of leading segments, a fit per ridge; as many rows as segments reach the driver."""
    found = {int(r["_s"]): np.array(r["s"]) for r in pieces.collect()}
    out = []
    for end in ends:
        parts = [found[s] for s in range(end) if s in found]
        total = sum(parts) if parts else None
        out.append([solved(total, wide, ridge) if total is not None else None for ridge in ridges])
    return out


def _errors(rows: DataFrame, features: Sequence[str], target: str, shifts: np.ndarray, fits: list[np.ndarray], applies: Callable) -> dict:
    """Sums of absolute and squared errors of each fit over the rows it applies to: {(fit, part): (n, abs, square)}."""
    weights = np.array([f[1:] for f in fits]).reshape(len(fits), len(features) + 1)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.column_stack([np.ones(len(batch)), batch[list(features)].to_numpy(float) - shifts])
            error = batch[target].to_numpy(float)[:, None] - x @ weights.T
            out = []
            for fit in range(weights.shape[0]):
                for part, mask in applies(fit, batch["_p"].to_numpy()):
                    e = error[mask, fit]
                    out.append((fit, part, len(e), float(np.abs(e).sum()), float((e * e).sum())))
            yield pd.DataFrame(out, columns=["fit", "part", "n", "a", "q"])

    chosen = rows.select("_p", *[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*features, target])])
    sums = chosen.mapInPandas(judge, "fit int, part int, n long, a double, q double").groupBy("fit", "part").agg(
        F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("q").alias("q"))
    return {(r["fit"], r["part"]): (r["n"], r["a"], r["q"]) for r in sums.collect()}


def growing_fits(rows: DataFrame, day: str, ties: Sequence[str | Column], features: Sequence[str], target: str, steps: int = 10,
                 train: float = 0.70, validation: float = 0.15, ridge: float = 1e-3) -> DataFrame:
    """(size, train_mae, validation_mae) of fits on the first k / steps of the training rows, k = 1 to steps.

    Sizes follow from the data: int(.70 n) training rows by time, cut evenly; the next int(.15 n) rows validate.
    """
    placed = numbered(rows, day, ties)
    n = placed.count()
    n_train, n_held = int(n * train), int(n * validation)
    sizes = [n_train * k // steps for k in range(1, steps + 1)]
    shifts, wide = _shifts(placed, features), len(features) + 2
    pieces = piece_sums(placed.where(F.col("_p") < n_train), {"_s": _segment(sizes[:-1])}, features, target, shifts)
    kept = [(s, f[0]) for s, f in zip(sizes, _prefix_fits(pieces, range(1, steps + 1), wide, [ridge])) if s and f[0] is not None]

    def applies(fit: int, p: np.ndarray):
        return (0, p < kept[fit][0]), (1, (p >= n_train) & (p < n_train + n_held))

    found = _errors(placed, features, target, shifts, [f for _, f in kept], applies) if kept else {}
    mean = lambda key: found[key][1] / found[key][0] if found.get(key, (0,))[0] else None
    out = [(s, mean((k, 0)), mean((k, 1))) for k, (s, _) in enumerate(kept)]
    return placed.sparkSession.createDataFrame(out, "size long, train_mae double, validation_mae double")


def forward_search(rows: DataFrame, day: str, ties: Sequence[str | Column], features: Sequence[str], target: str, ridges: Sequence[float],
                   folds: int = 5) -> DataFrame:
    """(ridge, fold, train_rows, test_rows, mae, rmse) over forward folds; all grid points share one pass each way.

    Test size is n div (folds + 1), and each fold is fitted on everything before its test rows, as in `time_series_cv`.
    """
    placed = numbered(rows, day, ties)
    n = placed.count()
    size = n // (folds + 1)
    starts = [n - size * (folds - k) for k in range(folds)]
    shifts, wide = _shifts(placed, features), len(features) + 2
    pieces = piece_sums(placed, {"_s": _segment(starts)}, features, target, shifts)
    fits = _prefix_fits(pieces, range(1, folds + 1), wide, ridges) if size else []
    flat = [(r, k, f) for k, own in enumerate(fits) for r, f in zip(ridges, own) if f is not None]

    def applies(fit: int, p: np.ndarray):
        start = starts[flat[fit][1]]
        return ((0, (p >= start) & (p < start + size)),)

    found = _errors(placed, features, target, shifts, [f for *_, f in flat], applies) if flat else {}
    out = [(float(r), k, starts[k], found[i, 0][0], found[i, 0][1] / found[i, 0][0], float(np.sqrt(found[i, 0][2] / found[i, 0][0])))
           for i, (r, k, _) in enumerate(flat)]
    return placed.sparkSession.createDataFrame(out, "ridge double, fold long, train_rows long, test_rows long, mae double, rmse double")


def best_ridge(searched: DataFrame) -> DataFrame:
    """One row per grid point, best first: rank by mean MAE over the folds, then by the smaller ridge."""
    means = searched.groupBy("ridge").agg(F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"), F.count(F.lit(1)).alias("folds"))
    rows = sorted(means.collect(), key=lambda r: (r["mae"], r["ridge"]))  # one row per grid point
    return searched.sparkSession.createDataFrame(
        [(r["ridge"], r["mae"], r["rmse"], r["folds"], k) for k, r in enumerate(rows, 1)], "ridge double, mae double, rmse double, folds long, rank int")


def fits_by(rows: DataFrame, group: str, features: Sequence[str], target: str, ridge: float) -> DataFrame:
    """(group, train_rows, weights) of one fit per value of `group`; weights apply to the regressors as they are, intercept first."""
    shifts, wide = _shifts(rows, features), len(features) + 2
    fits = _fits(piece_sums(rows, {"_k": F.xxhash64(group)}, features, target, shifts), "_k", wide, ridge)
    plain = F.get("weights", F.lit(0))
    for i, m in enumerate(shifts.tolist(), 1):
        plain = plain - F.get("weights", F.lit(i)) * F.lit(m)
    named = rows.select(group, F.xxhash64(group).alias("_k")).distinct().join(fits, "_k")
    return named.select(group, "train_rows", F.concat(F.array(plain), F.slice("weights", 2, len(features))).alias("weights"))
