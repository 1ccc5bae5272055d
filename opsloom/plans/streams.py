"""Queries that run a stream to its end and read its table."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from opsloom.plans.catalogue import Tables, query, rounded
from opsloom.sources.tables import work_folder
from opsloom.streaming import streams

WATERMARK = "(SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


def events(t: Tables):
    return streams.event_stream(t.spark, t.directory, "events.parquet")


@query("stream_velocity", f"""SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n FROM events GROUP BY 1, 2
HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= {WATERMARK}""")
def _(t: Tables):
    return streams.run_to_table(streams.velocity(events(t)), "velocity")


@query("stream_load_sliding", f"""SELECT first_day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM (
  SELECT *, CAST(CAST(ts AS DATE) - CAST(k AS INTEGER) AS DATE) AS first_day FROM events JOIN (SELECT unnest(range(7)) AS k) ON true) GROUP BY 1, 2
HAVING first_day + INTERVAL 7 DAY <= {WATERMARK}""")
def _(t: Tables):
    return streams.run_to_table(streams.load_sliding(events(t)), "sliding")


@query("stream_sessions", f"""WITH m AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM m)
SELECT user_id, min(ts) AS started, count(*) AS n FROM s GROUP BY user_id, s HAVING max(ts) + INTERVAL 2 HOUR <= {WATERMARK}""")
def _(t: Tables):
    out = streams.run_to_table(streams.sessions(events(t)), "sessions")
    return out.withColumn("started", F.col("started").cast("timestamp_ntz"))


@query("stream_score")
def _(t: Tables):
    rows = t.raw("events").withColumn("hour", F.hour("ts")).withColumn("label", (F.col("event_type") == "purchase").cast("int"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["value", "hour"], outputCol="features"),
                             LogisticRegression(maxIter=10, regParam=0.01)]).fit(rows)
    stream = events(t).withColumn("hour", F.hour("ts"))
    return rounded(streams.run_to_table(streams.score(stream, model, ["event_id"]), "scores"))


@query("stream_daily_refresh", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def _(t: Tables):
    return streams.daily_refresh(events(t), "refresh").select("day", "event_type", "n", "total")


_DAILY = "SELECT event_type AS service, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2"


@query("stream_alert_streak", f"""WITH d AS ({_DAILY}), a AS (SELECT service, day, CASE WHEN n > avg(n) OVER (PARTITION BY service) THEN 1 ELSE 0 END AS alert FROM d),
g AS (SELECT *, sum(1 - alert) OVER (PARTITION BY service ORDER BY day) AS g FROM a)
SELECT * FROM (SELECT service, day, alert, CAST(sum(alert) OVER (PARTITION BY service, g ORDER BY day) AS BIGINT) AS streak FROM g)
WHERE day < (SELECT max(day) FROM d) - INTERVAL 1 DAY""")
def _(t: Tables):
    daily = t.sql(_DAILY)
    mean = daily.groupBy("service").agg(F.avg("n").alias("_m"))
    alerts = daily.join(mean, "service").select("service", "day", (F.col("n") > F.col("_m")).cast("int").alias("alert"))
    folder = work_folder(t.spark, "alerts")
    # odd days come one batch before even ones of the next day: every service is out of order
    for part in range(2):
        alerts.where(F.pmod(F.datediff("day", F.lit("1970-01-01")) + part, F.lit(2)) == 0).coalesce(1).write.mode("append").parquet(folder)
    with streams.ordered_state(t.spark):
        late = streams.alert_streak(t.spark.readStream.schema(alerts.schema).parquet(folder))
        return streams.run_to_table(late, "streaks")


@query("stream_velocity_late", """WITH seen AS (SELECT max(ts) FILTER (event_id % 7 <> 0) - INTERVAL 10 MINUTE AS first, max(ts) - INTERVAL 10 MINUTE AS final FROM events),
marked AS (SELECT CAST(ts AS DATE) AS day, user_id, event_id % 7 = 0 AND CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT first FROM seen) AS late FROM events)
SELECT day, user_id, CAST(count(*) FILTER (NOT late AND day + INTERVAL 1 DAY <= (SELECT final FROM seen)) AS BIGINT) AS n, count(*) FILTER (late) AS late
FROM marked GROUP BY 1, 2 HAVING n > 0 OR count(*) FILTER (late) > 0""")
def _(t: Tables):
    """A seventh of the events comes in a second batch, most of it after its day has been closed."""
    folder = work_folder(t.spark, "late-events")
    for part in ("event_id % 7 <> 0", "event_id % 7 = 0"):
        t.raw("events").where(part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = streams.event_stream(t.spark, f"{folder}/in", files_at_once=1)
    counts, late = streams.velocity_and_late(stream, folder)
    dropped = late.groupBy("day", "user_id").agg(F.count(F.lit(1)).alias("late"))
    both = counts.join(dropped, ["day", "user_id"], "full")
    return both.select("day", "user_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("late", F.lit(0)).alias("late"))


@query("stream_dedupe", "SELECT event_id, user_id, event_type FROM events")
def _(t: Tables):
    again = events(t).unionByName(events(t))  # every event arrives twice
    return streams.run_to_table(streams.dedupe(again, ["event_id"], "60 days").select("event_id", "user_id", "event_type"), "dedupe")
