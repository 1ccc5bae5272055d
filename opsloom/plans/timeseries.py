"""Queries over daily series and row-level time splits."""

from pyspark.sql import functions as F

from opsloom.operators import folds, profile, timeseries, workload
from opsloom.plans import workload_sql as W
from opsloom.plans.catalogue import Tables, query, rounded
from opsloom.plans.workload import agent_days

BUSINESS = "business AS (SELECT d, n, CAST(volume AS DOUBLE) AS volume FROM v_daily WHERE isodow(d) <= 5)"


def business(t: Tables):
    return t.view("v_daily").where(F.weekday("d") < 5).select("d", "n", F.col("volume").cast("double").alias("volume"))


def load_global(t: Tables):
    return workload.load_per_day(t.once("v_tasks_clean"), agent_days(t, t.once("v_tasks_clean")))


def load_service(t: Tables):
    return workload.load_per_day_service(t.once("v_tasks_clean"), agent_days(t, t.once("v_tasks_clean")))


def _lag_sql(over: str) -> str:
    return ", ".join(f"{'r4(' if c == 'fte' else ''}lag({c}, {n}) OVER ({over}){')' if c == 'fte' else ''} AS {c}_lag_{n}"
                     for c in ("volume", "fte") for n in timeseries.LAGS)


@query("lags_global", f"WITH {W.LOADS} SELECT day, volume, {_lag_sql('ORDER BY day')} FROM load_day")
def _(t: Tables):
    return rounded(timeseries.lags(load_global(t), "day", ["volume", "fte"]).drop("n_tasks", "fte", "load"))


@query("lags_service", f"WITH {W.LOADS} SELECT day, service, volume, {_lag_sql('PARTITION BY service ORDER BY day')} FROM load_service")
def _(t: Tables):
    return rounded(timeseries.lags(load_service(t), "day", ["volume", "fte"], ["service"]).drop("n_tasks", "fte", "load"))


@query("rolling7", f"""WITH {W.LOADS} SELECT day, r4(avg(volume) OVER w) AS volume_mean_7, r4(avg(load) OVER w) AS load_mean_7 FROM load_day
WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _(t: Tables):
    return rounded(timeseries.rolling_mean(load_global(t), "day", ["volume", "load"]).select(
        "day", "volume_mean_7", "load_mean_7"))


@query("rolling7_service", f"""WITH {W.LOADS} SELECT day, service, r4(avg(volume) OVER w) AS volume_mean_7, r4(avg(load) OVER w) AS load_mean_7 FROM load_service
WINDOW w AS (PARTITION BY service ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _(t: Tables):
    return rounded(timeseries.rolling_mean(load_service(t), "day", ["volume", "load"], ["service"]).select(
        "day", "service", "volume_mean_7", "load_mean_7"))


@query("tail_means", f"""WITH {W.LOADS}, r AS (SELECT *, row_number() OVER (ORDER BY day DESC) AS rn FROM load_day)
SELECT r4(avg(volume) FILTER (WHERE rn <= 7)) AS volume_last_7, r4(avg(load) FILTER (WHERE rn <= 30)) AS load_last_30 FROM r""")
def _(t: Tables):
    return rounded(timeseries.tail_means(load_global(t), "day", [("volume", 7), ("load", 30)]))


@query("recent_window", "SELECT d, n FROM v_daily WHERE d >= (SELECT max(d) FROM v_daily) - INTERVAL 90 DAY")
def _(t: Tables):
    return timeseries.recent_window(t.view("v_daily").select("d", "n"), "d", 90)


@query("most_loaded_frequency", f"""WITH {W.LOADS}, top AS (SELECT service FROM (SELECT service, row_number() OVER (PARTITION BY day ORDER BY load DESC, service) AS rn
  FROM load_service WHERE load IS NOT NULL) WHERE rn = 1)
SELECT s.service, count(top.service) AS days_in_lead FROM (SELECT DISTINCT service FROM load_service) s LEFT JOIN top ON s.service = top.service GROUP BY 1""")
def _(t: Tables):
    return timeseries.most_loaded_frequency(load_service(t))


STREAK_SQL = """(SELECT service, CAST(coalesce(min(CASE WHEN alert <> 1 THEN rn END), max(rn) + 1) - 1 AS BIGINT) AS streak
FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY day DESC) AS rn FROM alert_service) WHERE rn <= 14 GROUP BY 1)"""


@query("alert_streak", f"WITH {W.LOADS} SELECT * FROM {STREAK_SQL}")
def _(t: Tables):
    return timeseries.alert_streak(workload.overload_alert(load_service(t), ["service"]))


def tie_sql(*columns: str) -> str:
    """The same text key as `tie_key` builds."""
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + "))"


TASK_TIES = ["task_id", "load_pos", "volume"]
CHRONO_SQL = f"""(SELECT *, CASE WHEN rn <= floor(n * 0.70::DOUBLE) THEN 'train' WHEN rn <= floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY created, {tie_sql(*TASK_TIES)}) AS rn, count(*) OVER () AS n FROM {{source}}))"""


@query("chrono_split", f"SELECT task_id, load_pos, created, split FROM {CHRONO_SQL.format(source='v_tasks_clean')}")
def _(t: Tables):
    return timeseries.chrono_split(t.view("v_tasks_clean"), "created", TASK_TIES).select(
        "task_id", "load_pos", "created", "split")


@query("split_by_cutoff", """SELECT d, n, CASE WHEN d <= DATE '1999-08-01' THEN 'train' WHEN d <= DATE '2000-08-01' THEN 'validation' ELSE 'test' END AS split FROM v_daily""")
def _(t: Tables):
    import datetime as dt

    return timeseries.split_by_cutoff(t.view("v_daily").select("d", "n"), "d", dt.date(1999, 8, 1), dt.date(2000, 8, 1))


_FOLDS = """SELECT fold, role, count(*) AS n, CAST(min(p) AS BIGINT) AS first_position, CAST(max(p) AS BIGINT) AS last_position FROM (
  SELECT f.fold, CASE WHEN p < {w} + f.fold * {a} THEN 'train' ELSE 'predict' END AS role, p + 1 AS p FROM numbered
  JOIN (SELECT unnest(range(CAST(floor((count(*) - {w}) / {a}) AS BIGINT))) AS fold FROM {src}) f
    ON p >= f.fold * {a} AND p < {w} + (f.fold + 1) * {a}) GROUP BY 1, 2"""


@query("walk_forward_folds", f"""WITH {BUSINESS}, numbered AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS p FROM business)
{_FOLDS.format(w=120, a=14, src='business')}""")
def _(t: Tables):
    parts = timeseries.walk_forward_folds(business(t), "d", ["n"], 120, 14)
    return workload.count_by(parts, ["fold", "role"], first_position=F.min("position"), last_position=F.max("position"))


@query("walk_forward_task_folds", f"""WITH numbered AS (SELECT task_id, row_number() OVER (ORDER BY created, {tie_sql(*TASK_TIES)}) - 1 AS p FROM v_tasks_clean)
{_FOLDS.format(w=20000, a=4000, src='v_tasks_clean')}""")
def _(t: Tables):
    parts = timeseries.walk_forward_folds(t.view("v_tasks_clean"), "created", TASK_TIES, 20000, 4000)
    return workload.count_by(parts, ["fold", "role"], first_position=F.min("position"), last_position=F.max("position"))


@query("walk_forward_wide_task_folds", f"""WITH numbered AS (SELECT task_id, row_number() OVER (ORDER BY created, {tie_sql(*TASK_TIES)}) - 1 AS p FROM v_tasks_clean)
{_FOLDS.format(w=50000, a=10000, src='v_tasks_clean')}""")
def _(t: Tables):
    parts = timeseries.walk_forward_folds(t.view("v_tasks_clean"), "created", TASK_TIES, 50000, 10000)
    return workload.count_by(parts, ["fold", "role"], first_position=F.min("position"), last_position=F.max("position"))


@query("time_series_cv", f"""WITH {BUSINESS}, r AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS p, count(*) OVER () AS n FROM business),
x AS (SELECT f.fold, d, CASE WHEN p < n - (n // 6) * (5 - f.fold) THEN 'train' WHEN p < n - (n // 6) * (5 - f.fold) + n // 6 THEN 'test' END AS role
  FROM r JOIN (SELECT CAST(unnest(range(5)) AS INTEGER) AS fold) f ON true)
SELECT fold, role, count(*) AS n, min(d) AS first_day, max(d) AS last_day FROM x WHERE role IS NOT NULL GROUP BY 1, 2""")
def _(t: Tables):
    parts = timeseries.time_series_cv(business(t).select("d"), "d")
    return workload.count_by(parts, ["fold", "role"], first_day=F.min("d"), last_day=F.max("d"))


#: the last value and one regressor without a ridge: the fits that SQL can do itself
_LAST = "last AS (SELECT d, volume AS y, lag(volume) OVER (ORDER BY d) AS x FROM business), placed AS (SELECT *, row_number() OVER (ORDER BY d) - 1 AS p, count(*) OVER () AS n FROM last WHERE x IS NOT NULL)"


def last_value(t: Tables):
    return timeseries.lags(business(t), "d", ["volume"], steps=[1]).select("d", F.col("volume").alias("y"), F.col("volume_lag_1").alias("x")).na.drop()


@query("walk_forward_last_value", f"""WITH {BUSINESS}, {_LAST}, f AS (SELECT unnest(range(CAST(floor((max(n) - 120) / 14) AS BIGINT))) AS fold FROM placed),
fits AS (SELECT fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS train_rows FROM placed JOIN f ON p >= fold * 14 AND p < fold * 14 + 120 GROUP BY fold)
SELECT d, fold, train_rows, r4(a + b * x) AS score FROM placed JOIN fits ON p >= fold * 14 + 120 AND p < (fold + 1) * 14 + 120""")
def _(t: Tables):
    scored = folds.walk_forward(last_value(t), "d", ["y"], ["x"], "y", 120, 14, ridge=0.0)
    return rounded(scored.select("d", "fold", "train_rows", "score"))


@query("expanding_last_value", f"""WITH {BUSINESS}, {_LAST}, sizes AS (SELECT (CAST(floor(max(n) * 0.70) AS BIGINT) * k) // 10 AS size, max(n) AS n FROM placed, (SELECT unnest(range(1, 11)) AS k) GROUP BY k),
fits AS (SELECT size, max(s.n) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM placed p JOIN sizes s ON p.p < size GROUP BY size)
SELECT size, r4(avg(CASE WHEN p < size THEN abs(y - a - b * x) END)) AS train_mae,
  r4(avg(CASE WHEN p >= floor(f.n * 0.70) AND p < floor(f.n * 0.70) + floor(f.n * 0.15) THEN abs(y - a - b * x) END)) AS validation_mae
FROM fits f, placed GROUP BY size""")
def _(t: Tables):
    return rounded(folds.growing_fits(last_value(t), "d", ["y"], ["x"], "y", ridge=0.0))


@query("forward_last_value", f"""WITH {BUSINESS}, {_LAST}, f AS (SELECT k AS fold, max(n) - (max(n) // 6) * (5 - k) AS start, max(n) // 6 AS size FROM placed, (SELECT unnest(range(5)) AS k) GROUP BY k),
fits AS (SELECT fold, start, size, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS train_rows FROM placed JOIN f ON p < start GROUP BY ALL)
SELECT 0.0::DOUBLE AS ridge, fold, train_rows, count(*) AS test_rows, r4(avg(abs(y - a - b * x))) AS mae, r4(sqrt(avg((y - a - b * x) * (y - a - b * x)))) AS rmse
FROM fits JOIN placed ON p >= start AND p < start + size GROUP BY fold, train_rows""")
def _(t: Tables):
    return rounded(folds.forward_search(last_value(t), "d", ["y"], ["x"], "y", [0.0]))


FILLED = """filled AS (SELECT d, CASE WHEN volume IS NOT NULL THEN volume WHEN ad IS NULL THEN bv ELSE bv + (av - bv) * ((d - bd)::DOUBLE / (ad - bd)) END AS volume, n FROM (
  SELECT c.d, b.volume, last_value(b.d IGNORE NULLS) OVER p AS bd, last_value(b.volume IGNORE NULLS) OVER p AS bv,
    first_value(b.d IGNORE NULLS) OVER f AS ad, first_value(b.volume IGNORE NULLS) OVER f AS av, last_value(b.n IGNORE NULLS) OVER p AS n
  FROM (SELECT CAST(unnest(generate_series((SELECT min(d) FROM business), (SELECT max(d) FROM business), INTERVAL 1 DAY)) AS DATE) AS d) c
  LEFT JOIN business b ON c.d = b.d
  WINDOW p AS (ORDER BY c.d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (ORDER BY c.d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))"""


def filled(t: Tables):
    return timeseries.calendar_fill(business(t), "d", ["volume"], ["n"])


@query("calendar_fill", f"WITH {BUSINESS}, {FILLED} SELECT d, r4(volume) AS volume, n FROM filled")
def _(t: Tables):
    return rounded(filled(t))


@query("acf", f"""WITH {BUSINESS}, {FILLED}, c AS (SELECT volume - (SELECT avg(volume) FROM filled) AS x, row_number() OVER (ORDER BY d) AS p FROM filled)
SELECT CAST(k AS INTEGER) AS lag, r4(sum(a.x * b.x) / (SELECT sum(x * x) FROM c)) AS acf
FROM (SELECT unnest(range(22)) AS k) l JOIN c a ON true JOIN c b ON b.p = a.p - k GROUP BY 1""")
def _(t: Tables):
    return rounded(timeseries.acf(filled(t), "d", "volume"))


@query("seasonal_decompose", f"""WITH {BUSINESS}, {FILLED}, r AS (SELECT d, volume AS value, (row_number() OVER (ORDER BY d) - 1) % 7 AS phase,
    CASE WHEN count(volume) OVER w = 7 THEN avg(volume) OVER w END AS trend FROM filled WINDOW w AS (ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
m AS (SELECT phase, avg(value - trend) AS m FROM r GROUP BY 1), s AS (SELECT phase, m - (SELECT avg(m) FROM m) AS seasonal FROM m)
SELECT d, r4(value) AS value, r4(trend) AS trend, r4(seasonal) AS seasonal, r4(value - trend - seasonal) AS residual FROM r JOIN s ON r.phase = s.phase""")
def _(t: Tables):
    return rounded(timeseries.seasonal_decompose(filled(t), "d", "volume"))


@query("naive_forecasts", f"""WITH {BUSINESS}, r AS (SELECT volume AS y, row_number() OVER w AS p, lag(volume, 1) OVER w AS previous_day, lag(volume, 5) OVER w AS same_weekday,
    avg(volume) OVER (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean_7, count(*) OVER () AS n FROM business WINDOW w AS (ORDER BY d)),
t AS (SELECT *, (SELECT avg(y) FROM r WHERE p <= floor(n * 0.7::DOUBLE)) AS train_mean FROM r WHERE p > floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE)) """
       + " UNION ALL ".join(f"SELECT '{m}' AS method, r4(avg(abs(y - {m}))) AS mae, r4(avg(abs(y - {m}) / nullif(abs(y), 0)) * 100) AS mape FROM t"
                            for m in ("train_mean", "previous_day", "same_weekday", "mean_7")))
def _(t: Tables):
    return rounded(timeseries.naive_forecasts(business(t), "d", "volume"))


NEXT_DAYS = """next_days AS (SELECT CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS horizon, day FROM (
  SELECT CAST(unnest(generate_series(m + INTERVAL 1 DAY, m + INTERVAL 60 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT max(d) AS m FROM v_daily))
  WHERE isodow(day) <= 5 QUALIFY row_number() OVER (ORDER BY day) <= 30)"""


def next_days(t: Tables, n: int = 30):
    return timeseries.next_business_days(t.view("v_daily").agg(F.max("d").alias("d")), n)


@query("next_business_days", f"WITH {NEXT_DAYS} SELECT horizon, day FROM next_days")
def _(t: Tables):
    return next_days(t)


# The forecast table: five times the historic mean of the weekday (the whole roster is at work), +- 10 %.
FORECAST = f"""{NEXT_DAYS}, weekday_mean AS (SELECT isodow(day) AS w, avg(volume) AS v FROM vol_day GROUP BY 1),
forecast AS (SELECT horizon, day, floor(v * 5) AS volume, floor(v * 4.5) AS volume_low, floor(v * 5.5) AS volume_high FROM next_days JOIN weekday_mean ON isodow(day) = w)"""


def forecast(t: Tables, load):
    means = load.groupBy(F.weekday("day").alias("w")).agg(F.avg("volume").alias("v"))
    days = next_days(t)
    return days.join(means, F.weekday(days.day) == means.w).select(
        "horizon", "day", F.floor(F.col("v") * 5).cast("double").alias("volume"),
        F.floor(F.col("v") * 4.5).cast("double").alias("volume_low"), F.floor(F.col("v") * 5.5).cast("double").alias("volume_high"))


@query("reindex_forecast_dates", f"""WITH {W.LOADS}, {FORECAST} SELECT horizon, day, volume, volume_low, volume_high FROM forecast""")
def _(t: Tables):
    made = forecast(t, load_global(t))
    shifted = made.withColumn("day", F.date_add("day", 400))  # dates of a late run, put right below
    return timeseries.reindex_forecast_dates(shifted, next_days(t))


_EFFECTS = ["is_month_end", "is_quarter_end", "is_august", "weekday", "month"]


@query("calendar_effects", f"WITH {BUSINESS}, c AS (SELECT volume, {W.columns(W.calendar('d'), _EFFECTS)} FROM business) " + " UNION ALL ".join(
    f"SELECT '{c}' AS effect, {c} AS level, r4(avg(volume)) AS mean_value, count(*) AS n FROM c GROUP BY 2" for c in _EFFECTS))
def _(t: Tables):
    days = workload.calendar_features(business(t), "d")
    return rounded(profile.mean_by_flags(days, "volume", _EFFECTS))
