"""Fits from sums of pieces against a refit of every fold on its rows."""
import numpy as np
import pytest

from opsloom.operators import folds

N = 700


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(1e6, 3.0, N), rng.normal(0, 1e-3, N), np.full(N, 7.0), rng.integers(0, 2, N)])
    y = 3 + x[:, 0] * 0.5 - 200 * x[:, 1] + rng.normal(size=N)
    order = rng.permutation(N)
    rows = [(int(k // 3), int(k), *map(float, x[k]), float(y[k])) for k in order]  # three rows a day: ties
    return x, y, spark.createDataFrame(rows, "day long, id long, a double, b double, c double, d double, y double")


def refit(x, y, ridge):
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale <= 1e-12 * (1 + np.abs(mean)), 1, scale)
    z = (x - mean) / scale
    w = np.linalg.solve(z.T @ z + ridge * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    return lambda new: y.mean() + ((new - mean) / scale) @ w


FEATURES = ["a", "b", "c", "d"]


def _order(spark):
    from opsloom.operators.ordering import tie_key

    keyed = spark.createDataFrame([(k // 3, k) for k in range(N)], "day long, id long").withColumn("t", tie_key("id"))
    return [r["id"] for r in keyed.orderBy("day", "t").collect()]


@pytest.mark.parametrize("window, ahead", [(120, 14), (100, 100), (50, 33), (699, 5)])
def test_row_scores_equal_refits(spark, made, window, ahead):
    x, y, rows = made
    order = _order(spark)
    found = {r["id"]: (r["fold"], r["train_rows"], r["score"]) for r in folds.walk_forward(rows, "day", ["id"], FEATURES, "y", window, ahead).collect()}
    count = (N - window) // ahead
    assert len(found) == count * ahead
    for fold in range(count):
        known = order[fold * ahead:fold * ahead + window]
        guess = refit(x[known], y[known], 1e-3)
        for k in order[fold * ahead + window:(fold + 1) * ahead + window]:
            assert found[k][:2] == (fold, window) and found[k][2] == pytest.approx(guess(x[k]), rel=1e-9)


def test_growing_fits_and_forward_search(spark, made):
    x, y, rows = made
    order, n_train, n_held = _order(spark), int(N * 0.7), int(N * 0.15)
    for r in folds.growing_fits(rows, "day", ["id"], FEATURES, "y").collect():
        known, held = order[:r["size"]], order[n_train:n_train + n_held]
        guess = refit(x[known], y[known], 1e-3)
        assert r["train_mae"] == pytest.approx(np.abs(y[known] - guess(x[known])).mean(), rel=1e-8)
        assert r["validation_mae"] == pytest.approx(np.abs(y[held] - guess(x[held])).mean(), rel=1e-8)
    searched = folds.forward_search(rows, "day", ["id"], FEATURES, "y", [1e-3, 10.0, 1e5])
    size, seen = N // 6, {}
    for r in searched.collect():
        start = N - size * (5 - r["fold"])
        guess, test = refit(x[order[:start]], y[order[:start]], r["ridge"]), order[start:start + size]
        assert (r["train_rows"], r["test_rows"]) == (start, size)
        assert r["mae"] == pytest.approx(np.abs(y[test] - guess(x[test])).mean(), rel=1e-7)
        seen.setdefault(r["ridge"], []).append(r["mae"])
    best = folds.best_ridge(searched).where("rank = 1").first()
    assert best["ridge"] == min(seen, key=lambda r: np.mean(seen[r])) and best["folds"] == 5


def test_too_few_rows(spark, made):
    few = made[2].limit(3)
    assert folds.walk_forward(few, "day", ["id"], FEATURES, "y", 10, 5).collect() == []
    assert folds.forward_search(few, "day", ["id"], FEATURES, "y", [1.0]).collect() == []
    assert folds.growing_fits(few.limit(0), "day", ["id"], FEATURES, "y").collect() == []


def test_task_folds_cover_the_samples_at_both_windows(spark):
    import __spark_entry__ as entry_points

    found = {name: entry_points.queries()[name](spark, "/root/testdata/sf0.01").collect() for name in ("walk_forward_task_folds", "walk_forward_wide_task_folds")}
    for (rows, window, ahead) in ((found["walk_forward_task_folds"], 20000, 4000), (found["walk_forward_wide_task_folds"], 50000, 10000)):
        n = {(r["fold"], r["role"]): (r["n"], r["last_position"]) for r in rows}
        folds = max(f for f, _ in n) + 1
        assert n == {(f, role): (window, window + f * ahead) if role == "train" else (ahead, window + (f + 1) * ahead)
                     for f in range(folds) for role in ("train", "predict")}
    assert len(found["walk_forward_task_folds"]) >= 20
