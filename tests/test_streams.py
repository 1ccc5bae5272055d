"""Streams against their batch queries: order, lateness, restarts and the end of state."""
import datetime as dt

import pytest

from opsloom.streaming import streams


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def streaks(spark, source, folder):
    schema = "service string, day date, alert int"
    with streams.ordered_state(spark):
        stream = streams.alert_streak(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source)), "3 days")
        out = streams.run_to_table(stream, "streaks", str(folder)).collect()
    return sorted((r["service"], (r["day"] - day(0)).days, r["alert"], r["streak"]) for r in out)


def test_streak_waits_for_days_out_of_order_and_goes_on_after_a_restart(spark, tmp_path):
    schema = "service string, day date, alert int"
    put(spark, tmp_path / "in", [("a", day(0), 1), ("a", day(2), 1), ("b", day(0), 1), ("b", day(1), 1), ("b", day(2), 1)], schema)
    put(spark, tmp_path / "in", [("a", day(1), 0), ("a", day(3), 1), ("b", day(3), 1)], schema)  # the calm day comes late
    put(spark, tmp_path / "in", [("a", day(6), 1), ("b", day(6), 0)], schema)
    first = streaks(spark, tmp_path / "in", tmp_path / "work")
    assert first == [("a", 0, 1, 1), ("a", 1, 0, 0), ("a", 2, 1, 1), ("b", 0, 1, 1), ("b", 1, 1, 2), ("b", 2, 1, 3)]
    put(spark, tmp_path / "in", [("a", day(0), 0), ("b", day(4), 1), ("a", day(11), 0)], schema)  # day 0 is final, day 4 still open
    assert streaks(spark, tmp_path / "in", tmp_path / "work") == sorted(first + [
        ("a", 3, 1, 2), ("a", 6, 1, 3), ("b", 3, 1, 4), ("b", 4, 1, 5), ("b", 6, 0, 0)])


def test_streak_state_ends_after_silence(spark, tmp_path):
    schema = "service string, day date, alert int"
    put(spark, tmp_path / "in", [("a", day(0), 1), ("b", day(0), 1)], schema)
    put(spark, tmp_path / "in", [("b", day(200), 1)], schema)
    put(spark, tmp_path / "in", [("a", day(201), 1), ("b", day(210), 1)], schema)
    put(spark, tmp_path / "in", [("b", day(300), 1)], schema)
    put(spark, tmp_path / "in", [("b", day(301), 1)], schema)
    assert streaks(spark, tmp_path / "in", tmp_path / "work") == [
        ("a", 0, 1, 1), ("a", 201, 1, 1), ("b", 0, 1, 1), ("b", 200, 1, 1), ("b", 210, 1, 2)]


EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def event(number, days, user):
    return number, dt.datetime(2024, 1, 1, 12) + dt.timedelta(days=days), user, "a", 1.0, "{}"


def test_late_rows_are_kept_apart_and_counted(spark, tmp_path):
    put(spark, tmp_path / "in", [event(1, 0, 1), event(2, 3, 1)], EVENT)
    put(spark, tmp_path / "in", [event(3, 0, 1), event(4, 0, 1), event(5, 3, 2), event(6, 5, 1)], EVENT)  # 3 and 4 come too late

    def run():
        stream = streams.event_stream(spark, str(tmp_path / "in"), files_at_once=1)
        counts, late = streams.velocity_and_late(stream, str(tmp_path / "work"))
        return ({((r["day"] - day(0)).days, r["user_id"], r["n"]) for r in counts.collect()},
                sorted((r["batch"], (r["day"] - day(0)).days, r["user_id"]) for r in late.collect()))

    assert run() == ({(0, 1, 1), (3, 1, 1), (3, 2, 1)}, [(1, 0, 1), (1, 0, 1)])
    put(spark, tmp_path / "in", [event(7, 3, 9), event(8, 9, 1)], EVENT)
    assert run() == ({(0, 1, 1), (3, 1, 1), (3, 2, 1), (5, 1, 1)}, [(1, 0, 1), (1, 0, 1), (2, 3, 9)])


def test_refresh_goes_on_after_a_restart(spark, tmp_path):
    put(spark, tmp_path / "in", [event(1, 0, 1), event(2, 3, 1)], EVENT)

    def run():
        table = streams.daily_refresh(streams.event_stream(spark, str(tmp_path / "in")), "refresh", str(tmp_path / "work"))
        return {((r["day"] - day(0)).days, r["n"]) for r in table.collect()}

    assert run() == {(0, 1), (3, 1)}
    put(spark, tmp_path / "in", [event(3, 3, 1)], EVENT)
    assert run() == {(0, 1), (3, 2)}
    assert len(list((tmp_path / "work" / "rows").glob("batch=*"))) == 2  # the first file was not read again


def test_scores_of_a_stream_are_those_of_the_batch(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(60).selectExpr("id AS event_id", "CAST(id AS double) AS x", "CAST(id > 30 AS int) AS label")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LogisticRegression(maxIter=5)]).fit(rows)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = {r["event_id"]: r["probability"] for r in streams.run_to_table(streams.score(stream, model, ["event_id"]), "scores", str(tmp_path / "w")).collect()}
    wanted = {r["event_id"]: float(r["probability"][1]) for r in model.transform(rows).collect()}
    assert found == pytest.approx(wanted)
