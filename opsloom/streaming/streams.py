"""Streams over an event table, each with the same result as its batch query on data in time.

Sources are folders of parquet files. Checkpoints and outputs live below a folder that the caller names, so a
restarted query goes on where it stopped; without one, a fresh folder of `work_folder` serves a single run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from opsloom.sources.tables import work_folder

LATENESS = "10 minutes"


def event_stream(spark: SparkSession, folder: str, files: str = "*.parquet", like: str | None = None, files_at_once: int | None = None) -> DataFrame:
    """Stream of the parquet files of a folder, event time as an instant; `files_at_once` limits a batch."""
    schema = spark.read.parquet(like or f"{folder}/{files}").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_at_once:
        raw = raw.option("maxFilesPerTrigger", files_at_once)
    return raw.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_table(stream: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Process everything available, append the final rows to the table in `folder` and read it back.

    A second run with the same folder goes on after the files that the first one has processed.
    """
    spark = stream.sparkSession
    folder = folder or work_folder(spark, name)
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def velocity(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Events per user and day; a day is final once the watermark has passed it."""
    daily = events.withWatermark("ts", lateness).groupBy(F.window("ts", "1 day"), "user_id").agg(
        F.count(F.lit(1)).alias("n"))
    return daily.select(F.to_date("window.start").alias("day"), "user_id", "n")


def velocity_and_late(events: DataFrame, folder: str, lateness: str = LATENESS) -> tuple[DataFrame, DataFrame]:
    """(velocity, late): events per user and final day, and the rows that came too late to be counted.

    A row is late when the watermark of its batch has reached the end of its day, the rule by which Spark's windows drop
    rows; here they go to a table of their own. Each batch writes its highest event time, its counts per user and day
    and its late rows under its own number, so a batch that runs twice, or a run that is started anew with the
    same folder, leaves the same tables. late: (batch, day, user_id, ts).
    """
    spark = events.sparkSession
    days = F.to_date("ts").alias("day")

    def keep(batch: DataFrame, number: int) -> None:
        rows = batch.select("ts", "user_id", days)
        rows.agg(F.max("ts").alias("seen")).write.mode("overwrite").parquet(f"{folder}/seen/batch={number}")
        before = _watermark(spark, folder, lateness, f"batch < {number}")
        is_late = F.coalesce(F.date_add("day", 1).cast("timestamp") <= F.lit(before), F.lit(False))
        marked = rows.withColumn("late", is_late)
        marked.where("late").drop("late").write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
        counted = marked.where("NOT late").groupBy("day", "user_id").agg(F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(f"{folder}/counts/batch={number}")

    events.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    final = _watermark(spark, folder, lateness, "true")
    counts = spark.read.option("basePath", f"{folder}/counts").parquet(f"{folder}/counts")
    done = counts.where(F.date_add("day", 1).cast("timestamp") <= F.lit(final)).groupBy("day", "user_id").agg(F.sum("n").alias("n"))
    return done, spark.read.option("basePath", f"{folder}/late").parquet(f"{folder}/late").select("batch", "day", "user_id", "ts")


def _watermark(spark: SparkSession, folder: str, lateness: str, batches: str) -> dt.datetime | None:
    """Highest event time of some batches, less the lateness; one number per batch is read."""
    seen = spark.read.option("basePath", f"{folder}/seen").parquet(f"{folder}/seen").where(batches)
    return seen.agg((F.max("seen") - F.expr(f"INTERVAL {lateness}")).alias("w")).first()["w"]


def load_sliding(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Seven-day totals per event type, moving by one day."""
    moving = events.withWatermark("ts", lateness).groupBy(F.window("ts", "7 days", "1 day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))
    return moving.select(F.to_date("window.start").alias("first_day"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "2 hours", lateness: str = LATENESS) -> DataFrame:
    """Bursts of a user: events less than the gap apart."""
    bursts = events.withWatermark("ts", lateness).groupBy(F.session_window("ts", gap), "user_id").agg(
        F.count(F.lit(1)).alias("n"))
    return bursts.select("user_id", F.col("session_window.start").alias("started"), "n")


def score(items: DataFrame, model: PipelineModel, columns: list[str]) -> DataFrame:
    """Apply a fitted pipeline to each arriving row."""
    from pyspark.ml.functions import vector_to_array

    return model.transform(items).select(*columns, vector_to_array("probability")[1].alias("probability"))


def dedupe(events: DataFrame, keys: list[str], lateness: str = "1 hour") -> DataFrame:
    """First event per key among those that arrive within the lateness of each other."""
    return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


def daily_refresh(events: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Keep a table of daily figures; each batch rewrites only the days it touches.

    A batch is stored under its own number and days are recomputed from the store, so a batch
    that runs twice after a failure gives the same table.
    """
    spark = events.sparkSession
    folder = folder or work_folder(spark, name)

    def refresh(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("day", F.to_date("ts")).select("day", "event_type", "value")
        rows.write.mode("overwrite").partitionBy("day").parquet(f"{folder}/rows/batch={number}")
        touched = spark.read.parquet(f"{folder}/rows/batch={number}").select("day").distinct()
        stored = spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")
        figures = stored.join(touched, "day", "left_semi").groupBy("day", "event_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))
        (figures.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day")
         .parquet(f"{folder}/out"))

    query = (events.writeStream.foreachBatch(refresh).option("checkpointLocation", f"{folder}/state")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


STREAK_ROW = "service string, day date, alert int, streak long"
#: a service without any row for so many days starts anew, and its state is freed
SILENCE_DAYS = 60
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = dt.date(1970, 1, 1)


def _millis(day: dt.date) -> int:
    return (day - EPOCH).days * 86_400_000


class _Streak(StatefulProcessor):
    """Days wait, in a map by day, until the watermark has passed them; then they lengthen or end the run in order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "day date", "alert int")
        self.run = handle.getValueState("run", "streak long, last date")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.run.get()[1] if self.run.exists() else None
        for batch in rows:
            for day, alert in zip(batch["day"], batch["alert"]):
                if last is None or day > last:  # an earlier day is final already
                    self.waiting.updateValue((day,), (int(alert),))
                    self.handle.registerTimer(_millis(day))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        due = sorted((d[0], a[0]) for d, a in self.waiting.iterator() if _millis(d[0]) < passed)
        run, last = self.run.get() if self.run.exists() else (0, None)
        out = []
        for day, alert in due:
            if last is not None and (day - last).days > SILENCE_DAYS:
                run = 0
            run, last = run + 1 if alert == 1 else 0, day
            out.append((key[0], day, alert, run))
            self.waiting.removeKey((day,))
        if out:
            self.run.update((run, last))
            self.handle.registerTimer(_millis(last + dt.timedelta(days=SILENCE_DAYS)))
            yield pd.DataFrame(out, columns=["service", "day", "alert", "streak"])
        elif last is not None and _millis(last + dt.timedelta(days=SILENCE_DAYS)) < passed and not list(self.waiting.keys()):
            self.run.clear()

    def close(self) -> None:
        pass


def alert_streak(daily: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Length of the run of alert days per service after each day, (service, day, alert, streak).

    Days may come in any order and in any batch up to `lateness` behind the latest one: a day is given out once the
    watermark has passed it, so the result is that of the batch query; a later day is dropped. The state of a service is its run
    and the days that wait; it ends after SILENCE_DAYS without a row. Start the stream within `ordered_state`.
    """
    timed = daily.select("service", "day", "alert", F.col("day").cast("timestamp").alias("at")).withWatermark("at", lateness)
    return timed.groupBy("service").transformWithStateInPandas(
        statefulProcessor=_Streak(), outputStructType=STREAK_ROW, outputMode="Append", timeMode="EventTime")


@contextmanager
def ordered_state(spark: SparkSession):
    """State variables and timers need this state store; the session's own choice is put back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before)
