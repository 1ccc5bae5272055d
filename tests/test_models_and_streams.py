import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsloom.operators import decisions, forecast, isolation, metrics, models
from opsloom.plans import learning  # noqa: F401
from opsloom.plans.catalogue import CATALOGUE, Tables
from opsloom.sources import tables
from opsloom.streaming import streams


@pytest.fixture(scope="module")
def tasks(spark):
    return spark.range(4000).select(
        "id", (F.rand(1) * 10 + 20).alias("minutes"), (F.rand(2) * 5 + 10).alias("volume")).withColumn(
        "items_per_hour", F.col("volume") / (F.col("minutes") / 60))


def test_forest_finds_injected_anomalies(spark, tasks):
    names = ["minutes", "volume", "items_per_hour"]
    nodes, cut = isolation.train_flagging(tasks, names, ["id"], 50, 0.02)
    assert nodes.groupBy("tree").count().agg(F.max("count")).first()[0] <= 511
    injected = metrics.inject_anomalies(tasks, ["id"]).where("injected = 1")
    assert injected.count() == 40
    found = isolation.flagged(isolation.score(injected, nodes, names), cut).agg(F.avg("is_anomaly")).first()[0]
    everyone = isolation.flagged(isolation.score(tasks, nodes, names), cut).agg(F.avg("is_anomaly")).first()[0]
    assert found >= 0.9 and everyone == pytest.approx(0.02, abs=0.005)


def test_forecast_dates_and_band(spark):
    days = [dt.date(2023, 1, 2) + dt.timedelta(days=i) for i in range(400)]
    rows = spark.createDataFrame([("s", d, 100.0 + 10 * d.weekday() + i * 0.1, 0.0, 0.0) for i, d in enumerate(days) if d.weekday() < 5],
                                 "series string, day date, y double, fte_lost double, announced_volume double")
    fitted = forecast.train_seasonal_arx(rows)
    ahead = spark.createDataFrame([("s", i + 1, dt.date(2024, 2, 5) + dt.timedelta(days=i), 0.0, 0.0) for i in range(5)],
                                  "series string, horizon int, day date, fte_lost double, announced_volume double")
    out = forecast.forecast_recursive(rows, fitted, ahead).orderBy("horizon").collect()
    assert [r["horizon"] for r in out] == [1, 2, 3, 4, 5] and all(r["low"] <= r["forecast"] <= r["high"] for r in out)
    spread = rows.agg(F.stddev_pop("y")).first()[0]
    assert fitted.first()["mae"] < spread  # better than the mean


def test_reallocation_moves_nothing_in_total(spark):
    rows = spark.createDataFrame([("a", 2.0, 50.0), ("b", 4.0, 20.0), ("c", 1.0, 20.0)], "service string, fte double, load double").withColumn(
        "day", F.lit(dt.date(2024, 1, 1)))
    out = decisions.balanced_reallocation(rows)
    assert out.agg(F.sum("delta_fte")).first()[0] == pytest.approx(0.0)
    assert decisions.balance_kpis(out).first()["least_loaded"] == "b"




def test_late_rows_are_dropped(spark, tmp_path):
    def part(rows):
        made = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    at = dt.datetime(2024, 1, 1, 12)
    part([(1, at, 1, "a", 1.0, "{}"), (2, at + dt.timedelta(days=3), 1, "a", 1.0, "{}")])
    state = str(tmp_path / "state")
    def run():
        stream = streams.velocity(streams.event_stream(spark, str(tmp_path / "in")))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", state).trigger(
            availableNow=True).start().awaitTermination()
        return {(r["day"].isoformat(), r["n"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    assert run() == {("2024-01-01", 1)}
    part([(3, at, 1, "a", 1.0, "{}"), (4, at + dt.timedelta(days=5), 1, "a", 1.0, "{}")])  # event 3 comes too late
    assert run() == {("2024-01-01", 1), ("2024-01-04", 1)}


def test_refresh_rewrites_touched_days_only(spark, tmp_path):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "day date, v int")
    path = str(tmp_path / "t")
    tables.overwrite_sink(rows, path, "day")
    tables.overwrite_sink(rows.where("v = 2").withColumn("v", F.lit(9)), path, "day")
    assert {r["v"] for r in spark.read.parquet(path).collect()} == {1, 9}


def test_html_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<html><script>x()</script><p>Caf&eacute; &amp; <b>thé</b></p></html>", encoding="utf-8")
    assert tables.read_documents(spark, str(tmp_path)).first()["text"] == "Caf&eacute; & thé"


def test_logistic_reads_every_loan(spark, monkeypatch):
    seen, real = [], models.train_logistic

    def watched(rows, features, label):
        missing = rows.filter(" OR ".join(f"{c} IS NULL" for c in [*features, label])).count()
        seen.append((rows.count(), missing))
        return real(rows, features, label, folds=2)

    monkeypatch.setattr(models, "train_logistic", watched)
    loans = Tables(spark, "/root/testdata/sf0.001")
    assert 0 <= CATALOGUE["train_logistic"].build(loans).first()["auc_mean"] <= 1
    everyone = loans.view("v_loans")
    assert everyone.na.drop().count() < everyone.count()
    assert seen == [(everyone.count(), 0)]  # before: loans with a null were dropped
