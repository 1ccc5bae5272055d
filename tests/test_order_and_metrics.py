import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.operators import flights, metrics, ordering, timeseries, workload
from opsloom.operators.ordering import exact_percentiles, global_position, running_totals, tie_key


@pytest.mark.parametrize("seed", [1, 2])
def test_percentiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.normal(size=700), np.full(350, 0.25)])  # one value holds a third
    groups = rng.integers(0, 3, size=len(values))
    rows = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, values)] + [(None, 1.0), (1, None), (1, float("nan"))], "g int, v double")
    out = {r["g"]: (r["a"], r["b"]) for r in exact_percentiles(rows, "v", {"a": 0.75, "b": 0.02}, by=["g"]).collect()}
    for g in range(3):
        assert np.allclose(out[g], np.quantile(values[groups == g], [0.75, 0.02]))
    assert None not in out


def test_percentile_of_one_row_and_of_nothing(spark):
    rows = spark.createDataFrame([("a", 5.0), ("b", None)], "g string, v double")
    assert [tuple(r) for r in exact_percentiles(rows, "v", {"p": 0.75}, by=["g"]).collect()] == [("a", 5.0)]


def test_running_totals(spark):
    rows = spark.range(1, 501).select((F.col("id") * 1.0).alias("v"), F.col("id").alias("n"))
    up = {r["v"]: r["cum_n"] for r in running_totals(rows, "v", ["n"]).collect()}
    down = {r["v"]: r["cum_n"] for r in running_totals(rows, "v", ["n"], descending=True).collect()}
    assert up[10.0] == 55 and up[500.0] == 500 * 501 // 2 and down[500.0] == 500 and down[1.0] == up[500.0]


def test_global_position_is_a_permutation(spark):
    rows = spark.range(1000).select(F.expr("date_add(DATE '2024-01-01', CAST(id % 3 AS INT))").alias("d"), "id").withColumn("t", tie_key("id"))
    out = global_position(rows, "d", "t").orderBy("position").collect()
    assert [r["position"] for r in out] == list(range(1, 1001))
    assert [(r["d"], r["t"]) for r in out] == sorted((r["d"], r["t"]) for r in out)


def test_split_sizes_and_order_with_one_hot_day(spark):
    rows = spark.range(1000).select(F.expr("date_add(DATE '2024-01-01', CASE WHEN id < 400 THEN 5 ELSE CAST(id % 20 AS INT) END)").alias("d"), "id")
    split = timeseries.chrono_split(rows, "d", ["id"])
    sizes = {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"train": 700, "validation": 150, "test": 150}
    ends = {r["split"]: (r["a"], r["b"]) for r in split.groupBy("split").agg(F.min("d").alias("a"), F.max("d").alias("b")).collect()}
    assert ends["train"][1] <= ends["validation"][0] and ends["validation"][1] <= ends["test"][0]


def test_stratified_sizes(spark):
    rows = spark.range(400).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = metrics.stratified_split(rows, "y", ["id"]).groupBy("split", "y").count().collect()
    assert {(r["split"], r["y"]): r["count"] for r in out} == {
        ("test", 0): 54, ("validation", 0): 54, ("train", 0): 252, ("test", 1): 6, ("validation", 1): 6, ("train", 1): 28}


def test_every_label_value_is_split(spark):
    labels = F.when(F.col("id") < 300, 0).when(F.col("id") < 500, 1).when(F.col("id") < 600, 2)
    rows = spark.range(700).select("id", labels.alias("y"))
    out = metrics.stratified_split(rows, "y", ["id"]).groupBy("split", "y").count().collect()
    assert {(r["split"], r["y"]): r["count"] for r in out} == {
        (part, y): round(n * share) for y, n in ((0, 300), (1, 200), (2, 100), (None, 100))
        for part, share in (("test", 0.15), ("validation", 0.15), ("train", 0.70))}
    assert metrics.stratified_split(rows.limit(0), "y", ["id"]).count() == 0


def test_heat_map_keeps_hour_24(spark):
    rows = spark.createDataFrame([(0, 24, 1), (0, 24, 0), (0, 3, 0)], "weekday int, hour int, late int")
    row = flights.heatmap_weekday_hour(rows).first()
    assert (row["h24"], row["h03"], row["h05"]) == (50.0, 0.0, None)


def test_group_statistics_keep_null_keys(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, x double")
    out = workload.backjoin(rows, ["k"], mean=F.avg("x"))
    assert sorted((r["k"] or "", r["mean"]) for r in out.collect()) == [("", 2.0), ("", 2.0), ("a", 5.0)]


def curve(spark, pairs):
    return metrics.pr_curve(spark.createDataFrame(pairs, "s double, y int"), "s", "y")


def test_average_precision_is_not_a_trapezoid(spark):
    points = curve(spark, [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)])
    assert metrics.average_precision(points).first()[0] == pytest.approx(0.8333, abs=1e-4)


def test_thresholds(spark):
    points = curve(spark, [(0.9, 1), (0.8, 0), (0.7, 1), (0.2, 0), (0.1, 1)])
    assert metrics.threshold_by_recall(points, 0.6).first()[0] == 0.7
    assert metrics.threshold_by_recall(points, 1.0).first()[0] == 0.1
    assert metrics.threshold_by_recall(points, 1.5).first()[0] == 0.1  # out of reach: the lowest
    assert metrics.threshold_by_fbeta(curve(spark, [(0.0, 0), (0.0, 0)])).first()[0] == 0.0


def test_auc_with_ties_and_single_class(spark):
    rows = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.9, 1), (0.1, 0)], "s double, y int")
    assert metrics.roc_auc(rows, "s", "y").first()[0] == pytest.approx(0.875)
    assert metrics.roc_auc(rows.where("y = 1"), "s", "y").first()[0] is None


def test_report_without_predictions_is_zero(spark):
    rows = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    out = {r["class"]: r for r in metrics.class_report(rows, "y", "p").collect()}
    assert out[1]["precision"] == 0.0 and out[1]["recall"] == 0.0 and out[1]["f1"] == 0.0 and out[0]["accuracy"] == 0.5


def test_model_choice(spark):
    rows = spark.createDataFrame([(0, "a", 10.0), (1, "b", 10.0), (2, "p", 10.1)], "o int, m string, v double")
    assert metrics.select_highest(rows.where("m <> 'p'"), "m", "v", "o").first()["m"] == "a"
    assert metrics.select_lowest_with_preference(rows, "m", "v", "o", "p").first()["m"] == "p"
    far = rows.withColumn("v", F.when(F.col("m") == "p", 12.0).otherwise(F.col("v")))
    assert metrics.select_lowest_with_preference(far, "m", "v", "o", "p").first()["m"] == "a"


def test_mape_skips_zero_actuals(spark):
    rows = spark.createDataFrame([(0.0, 1.0), (10.0, 9.0)], "y double, p double")
    out = metrics.regression_metrics(rows, "y", "p").first()
    assert out["mape"] == pytest.approx(10.0) and out["zero_actuals"] == 1


def test_calendar_fill_edges(spark):
    rows = spark.sql("SELECT * FROM VALUES (DATE '2024-01-01', CAST(NULL AS DOUBLE)), (DATE '2024-01-02', 1.0), (DATE '2024-01-05', 4.0), (DATE '2024-01-06', NULL) t(d, v)")
    out = [r["v"] for r in timeseries.calendar_fill(rows, "d", ["v"]).orderBy("d").collect()]
    assert out == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_next_business_days_skip_weekends(spark):
    last = spark.sql("SELECT DATE '2024-03-01' AS d")  # a Friday
    days = [r["day"] for r in timeseries.next_business_days(last, 30).orderBy("horizon").collect()]
    assert len(days) == 30 and all(d.weekday() < 5 for d in days) and days[0].isoformat() == "2024-03-04"


def test_pieces_follow_the_data_and_stay_even(spark):
    rows = spark.range(2_000_000).select((F.pow(F.col("id") / 1e6, 3)).alias("v"), F.lit(1).alias("n"))  # far from uniform
    sizes = sorted(r["count"] for r in ordering.with_piece(rows, "v").groupBy("_piece").count().collect())
    assert len(sizes) == 20 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert ordering.with_piece(rows.limit(50), "v").select("_piece").distinct().count() == 1


def test_totals_and_percentiles_over_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(ordering, "PIECE_ROWS", 7)
    values = [None, float("nan"), float("-inf"), *[float(k * k % 101) for k in range(300)]]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None and v == v)
    found = exact_percentiles(rows, "v", {"a": 0.37, "b": 0.9}).first()
    assert found["a"] == pytest.approx(np.percentile(known, 37)) and found["b"] == pytest.approx(np.percentile(known, 90))
    counts = rows.where("v >= 0 AND NOT isnan(v)").groupBy("v").count()
    upto = {r["v"]: r["cum_count"] for r in running_totals(counts, "v", ["count"]).collect()}
    assert upto == {v: sum(k <= v for k in known[1:]) for v in set(known[1:])}


def test_a_long_event_costs_two_rows(spark, monkeypatch):
    from opsloom.operators import workload

    seen, real = [], workload.running_totals
    monkeypatch.setattr(workload, "running_totals", lambda df, *rest: seen.append(df.count()) or real(df, *rest))
    first = dt.date(2000, 1, 1)
    events = spark.createDataFrame([
        ("fte_incident", 0.1, None, first, 30_000), ("fte_incident", 0.2, None, first + dt.timedelta(days=5), 3), ("announcement", None, 7.5, first, 1),
        ("announcement", None, 1.0, None, 4), ("fte_incident", None, None, first, 2)], "kind string, fte_impact double, extra_volume double, event_date date, duration_days int")
    offsets = [-1, 0, 1, 5, 7, 8, 29_999, 30_000]
    days = spark.createDataFrame([(first + dt.timedelta(days=k),) for k in offsets] + [(None,)], "day date")
    out = {r["day"] and (r["day"] - first).days: (r["fte_lost"], r["announced_volume"]) for r in workload.active_events_per_day(days, events).collect()}
    assert out == {-1: (0, 0), 0: (0.1, 7.5), 1: (0.1, 0), 5: (0.3, 0), 7: (0.3, 0), 8: (0.1, 0), 29_999: (0.1, 0), 30_000: (0, 0), None: (0, 0)}
    assert seen[0] <= len(offsets) + 6
