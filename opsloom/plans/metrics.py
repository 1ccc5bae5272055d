"""Queries for metrics, thresholds, splits and model choice."""

from pyspark.sql import functions as F

from opsloom.operators import metrics, timeseries, workload
from opsloom.plans import workload_sql as W
from opsloom.plans.catalogue import Tables, query, rounded
from opsloom.plans.timeseries import BUSINESS, business, tie_sql

CURVE = """curve AS (SELECT threshold, pos, n, cum_pos, cum_n, cum_pos / cum_n AS precision, cum_pos / (SELECT sum(label) FROM v_scores) AS recall FROM (
  SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS cum_pos, CAST(sum(n) OVER w AS BIGINT) AS cum_n FROM (
    SELECT score::DOUBLE AS threshold, CAST(sum(label) AS BIGINT) AS pos, count(*) AS n FROM v_scores GROUP BY 1) WINDOW w AS (ORDER BY threshold DESC)))"""


def curve(t: Tables):
    return metrics.pr_curve(t.view("v_scores"), "score", "label")


@query("pr_curve", f"WITH {CURVE} SELECT threshold, pos, n, cum_pos, cum_n, r6(precision) AS precision, r6(recall) AS recall FROM curve")
def _(t: Tables):
    return rounded(curve(t), 6)


@query("threshold_by_recall", f"""WITH {CURVE}
SELECT target, threshold, r6(precision) AS precision, r6(recall) AS recall,
  (SELECT coalesce(max(threshold) FILTER (WHERE recall >= 0.8::DOUBLE), min(threshold)) FROM curve) AS chosen FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY abs(recall - target), threshold) AS rn
  FROM curve JOIN (SELECT unnest([0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE AS target) ON true) WHERE rn = 1""")
def _(t: Tables):
    points = curve(t)
    return rounded(metrics.recall_table(points).withColumn("chosen", metrics.threshold_by_recall(points).scalar()), 6)


@query("threshold_by_fbeta", f"""WITH {CURVE}, f AS (SELECT threshold, coalesce(5 * precision * recall / nullif(4 * precision + recall, 0), 0) AS fbeta FROM curve)
SELECT threshold, r6(fbeta) AS fbeta FROM f ORDER BY f.fbeta DESC, threshold LIMIT 1""")
def _(t: Tables):
    return rounded(metrics.threshold_by_fbeta(curve(t)), 6)


@query("average_precision", f"WITH {CURVE} SELECT r6(sum(pos * precision) / sum(pos)) AS average_precision FROM curve")
def _(t: Tables):
    return rounded(metrics.average_precision(curve(t)), 6)


@query("roc_auc", """WITH r AS (SELECT label, avg(rn) OVER (PARTITION BY score) AS rank FROM (SELECT *, row_number() OVER (ORDER BY score) AS rn FROM v_scores))
SELECT r6((sum(rank) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2)
  / (count(*) FILTER (WHERE label = 1)::DOUBLE * count(*) FILTER (WHERE label = 0))) AS roc_auc FROM r""")
def _(t: Tables):
    return rounded(metrics.roc_auc(t.view("v_scores"), "score", "label"), 6)


def _class_sql(c: int) -> str:
    o = 1 - c
    return f"""SELECT {c} AS class, coalesce(n{c}{c} / nullif(n{c}{c} + n{o}{c}, 0), 0) AS precision, coalesce(n{c}{c} / nullif(n{c}{c} + n{c}{o}, 0), 0) AS recall,
  n{c}{c} + n{c}{o} AS support, (n00 + n11) / (n00 + n01 + n10 + n11) AS accuracy, n00, n01, n10, n11 FROM cells"""


@query("class_report", f"""WITH cells AS (SELECT {", ".join(f"count(*) FILTER (WHERE late_actual = {a} AND late_predicted = {b}) AS n{a}{b}" for a in (0, 1) for b in (0, 1))} FROM v_risk)
SELECT class, r6(precision) AS precision, r6(recall) AS recall, support, r6(accuracy) AS accuracy, n00, n01, n10, n11,
  r6(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)) AS f1 FROM ({_class_sql(0)} UNION ALL {_class_sql(1)})""")
def _(t: Tables):
    return rounded(metrics.class_report(t.view("v_risk"), "late_actual", "late_predicted"), 6)


@query("detection_rate", "SELECT r6(sum(late_predicted * late_actual) / sum(late_actual) * 100) AS detection_pct FROM v_risk")
def _(t: Tables):
    return rounded(metrics.detection_rate(t.view("v_risk"), "late_predicted", "late_actual"), 6)


@query("regression_metrics", """WITH r AS (SELECT d, CAST(volume AS DOUBLE) AS y, lag(CAST(volume AS DOUBLE), 7) OVER (ORDER BY d) AS p FROM v_daily),
k AS (SELECT *, abs(y - p) / nullif(abs(y), 0) AS s FROM r WHERE p IS NOT NULL)
SELECT count(*) AS n, r4(avg(abs(y - p))) AS mae, r4(sqrt(avg((y - p) * (y - p)))) AS rmse, r2(avg((y - p) * (y - p))) AS mse,
  r4(1 - avg((y - p) * (y - p)) / var_pop(y)) AS r2, r4(avg(s) * 100) AS mape, count(*) FILTER (WHERE y = 0) AS zero_actuals,
  r4(avg(s) FILTER (WHERE isodow(d) <= 5) * 100) AS weekday_mape FROM k""")
def _(t: Tables):
    days = timeseries.lags(t.view("v_daily").select("d", F.col("volume").cast("double").alias("y")), "d", ["y"], steps=[7])
    out = metrics.regression_metrics(days, "y", "y_lag_7", "d")
    return rounded(rounded(out, 2, only=["mse"]), 4, only=["mae", "rmse", "r2", "mape", "weekday_mape"])


_KEY = tie_sql("42", "task_id", "load_pos", "volume", "minutes")


@query("stratified_split", f"""SELECT split, late_actual, count(*) AS n, sum(load_pos)::BIGINT AS checksum FROM (SELECT *, CASE
  WHEN rn <= floor(n * 0.15::DOUBLE + 0.5) THEN 'test' WHEN rn <= floor(n * 0.15::DOUBLE + 0.5) * 2 THEN 'validation' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY late_actual ORDER BY {tie_sql("42", "task_id", "load_pos", "risk_score")}) AS rn, count(*) OVER (PARTITION BY late_actual) AS n FROM
    (SELECT late_actual, task_id, load_pos, CAST(floor(risk_score * 10000 + 0.5) AS BIGINT) AS risk_score FROM v_risk))) GROUP BY 1, 2""")
def _(t: Tables):
    risk = t.view("v_risk").withColumn("risk_score", F.floor(F.col("risk_score") * 10000 + 0.5))
    split = metrics.stratified_split(risk, "late_actual", ["task_id", "load_pos", "risk_score"])
    return workload.count_by(split, ["split", "late_actual"], checksum=F.sum("load_pos"))


@query("union_train_val", f"""SELECT task_id, load_pos, created FROM (SELECT *, row_number() OVER (ORDER BY created, {tie_sql('task_id', 'load_pos', 'volume')}) AS rn,
  count(*) OVER () AS n FROM v_tasks_clean) WHERE rn <= floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE)""")
def _(t: Tables):
    split = timeseries.chrono_split(t.view("v_tasks_clean"), "created", ["task_id", "load_pos", "volume"])
    return metrics.union_train_val(split).select("task_id", "load_pos", "created")


_INJECT = tie_sql("42", "task_id", "load_pos", "volume")


@query("inject_anomalies", f"""WITH r AS (SELECT task_id, load_pos, minutes, volume, {W.RATE} AS items_per_hour, row_number() OVER (ORDER BY {_INJECT}) AS rn, count(*) OVER () AS n FROM v_tasks_clean)
SELECT task_id, load_pos, minutes, CASE WHEN hit THEN volume * 50 ELSE volume END AS volume, CASE WHEN hit THEN 1 ELSE 0 END AS injected,
  r4(CASE WHEN hit THEN volume * 50::DOUBLE / nullif(minutes / 60, 0) ELSE items_per_hour END) AS items_per_hour FROM (SELECT *, rn <= greatest(floor(n * 0.01::DOUBLE), 10) AS hit FROM r)""")
def _(t: Tables):
    tasks = workload.productivity(t.view("v_tasks_clean")).select("task_id", "load_pos", "minutes", "volume", "items_per_hour")
    return rounded(metrics.inject_anomalies(tasks, ["task_id", "load_pos", "volume"]), only=["items_per_hour"])


_BACK = f"""{BUSINESS}, preds AS (SELECT d, volume AS y, lag(volume, 5) OVER (ORDER BY d) AS pred_a, avg(volume) OVER (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS pred_b FROM business)"""


def two_forecasts(t: Tables):
    days = business(t)
    a = timeseries.lags(days, "d", ["volume"], steps=[5]).select("d", F.col("volume_lag_5").alias("pred_a")).na.drop()
    w = timeseries.series().orderBy("d").rowsBetween(-7, -1)
    b = days.select("d", F.avg("volume").over(w).alias("pred_b")).na.drop()
    return metrics.align_predictions(a, b, days.select("d", F.col("volume").alias("y")), "d")


@query("align_predictions", f"WITH {_BACK} SELECT d, r4(y) AS y, r4(pred_a) AS pred_a, r4(pred_b) AS pred_b, r4((pred_a + pred_b) / 2) AS ensemble FROM preds WHERE pred_a IS NOT NULL AND pred_b IS NOT NULL")
def _(t: Tables):
    return rounded(two_forecasts(t))


@query("ensemble_mean", f"""WITH {_BACK}, k AS (SELECT *, (pred_a + pred_b) / 2 AS e FROM preds WHERE pred_a IS NOT NULL AND pred_b IS NOT NULL)
SELECT count(*) AS n, r4(avg(abs(y - e))) AS mae, r4(sqrt(avg((y - e) * (y - e)))) AS rmse, r4(avg(abs(y - e) / nullif(y, 0)) * 100) AS mape FROM k""")
def _(t: Tables):
    return rounded(metrics.regression_metrics(two_forecasts(t), "y", "ensemble").select("n", "mae", "rmse", "mape"))


_CANDIDATES = [("quantity", "l_quantity"), ("discount", "l_discount"), ("tax", "l_tax")]


def _ap_sql(i: int, name: str, column: str) -> str:
    return f"""SELECT {i} AS o, '{name}' AS model, (SELECT sum(pos * (cp / cn)) / sum(pos) FROM (SELECT pos, sum(pos) OVER w AS cp, sum(n) OVER w AS cn FROM (
  SELECT {column} AS s, sum(label) AS pos, count(*) AS n FROM labelled GROUP BY 1) WINDOW w AS (ORDER BY s DESC))) AS ap"""


@query("select_model", f"""WITH {BUSINESS}, labelled AS (SELECT *, CASE WHEN l_quantity + l_discount * 200 > 45 THEN 1 ELSE 0 END AS label FROM lineitem),
m AS ({" UNION ALL ".join(_ap_sql(i, n, c) for i, (n, c) in enumerate(_CANDIDATES))}),
preds AS (SELECT volume AS y, lag(volume, 1) OVER (ORDER BY d) AS p1, lag(volume, 5) OVER (ORDER BY d) AS p2, avg(volume) OVER (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS p3 FROM business),
e AS (SELECT avg(abs(y - p1)) AS a, avg(abs(y - p2)) AS b, avg(abs(y - p3)) AS c FROM preds),
best AS (SELECT least(a, c) AS v, CASE WHEN a <= c THEN 'previous_day' ELSE 'mean_7' END AS m, b FROM e)
SELECT 'highest precision' AS rule, model, r6(ap) AS value FROM (SELECT * FROM m ORDER BY ap DESC, o LIMIT 1)
UNION ALL SELECT 'lowest error', CASE WHEN abs(b - v) / v * 100 < 2 OR b < v THEN 'same_weekday' ELSE m END, r6(CASE WHEN abs(b - v) / v * 100 < 2 OR b < v THEN b ELSE v END) FROM best""")
def _(t: Tables):
    labelled = t.raw("lineitem").withColumn("label", (F.col("l_quantity") + F.col("l_discount") * 200 > 45).cast("int"))
    scored = None
    for i, (name, column) in enumerate(_CANDIDATES):
        row = metrics.average_precision(metrics.pr_curve(labelled, column, "label")).select(
            F.lit(i).alias("o"), F.lit(name).alias("model"), F.col("average_precision").alias("value"))
        scored = row if scored is None else scored.unionByName(row)
    high = metrics.select_highest(scored, "model", "value", "o").withColumn("rule", F.lit("highest precision"))
    w = timeseries.series().orderBy("d")
    preds = business(t).select(F.col("volume").alias("y"), F.lag("volume", 1).over(w).alias("previous_day"),
                               F.lag("volume", 5).over(w).alias("same_weekday"),
                               F.avg("volume").over(w.rowsBetween(-7, -1)).alias("mean_7"))
    names = ["previous_day", "same_weekday", "mean_7"]
    errors = preds.agg(*[F.avg(F.abs(F.col("y") - F.col(n))).alias(n) for n in names]).select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("o"), F.lit(n).alias("model"), F.col(n).alias("value")) for i, n in enumerate(names)])).alias("r")).select("r.*")
    low = metrics.select_lowest_with_preference(errors, "model", "value", "o", "same_weekday").withColumn("rule", F.lit("lowest error"))
    return rounded(high.unionByName(low).select("rule", "model", "value"), 6)
