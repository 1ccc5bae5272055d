"""Queries that train, judge and apply models. Their checks are properties, not equal rows."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from opsloom.operators import accounts, cleaning, folds, forecast, isolation, metrics, models, timeseries, workload
from opsloom.operators.registry import Registry
from opsloom.plans import workload_sql as W
from opsloom.plans.catalogue import Tables, query, rounded
from opsloom.plans.timeseries import NEXT_DAYS, business, load_global, load_service, next_days, tie_sql
from opsloom.plans.workload import detail
from opsloom.sources.tables import staged, work_folder


def account_split(t: Tables):
    rows = staged(accounts.fill_null_inf(accounts.account_features(t.once("v_transactions"))), "accounts")
    split = staged(metrics.stratified_split(rows, "label", ["account_key"]), "account_split")
    return {name: split.where(F.col("split") == name) for name in ("train", "validation", "test")}


def forest(t: Tables, parts, depths=(8,)):
    return models.train_rf_classifier(parts["train"], parts["validation"], accounts.FEATURES, "label", depths)


@query("train_rf_classifier")
def _(t: Tables):
    return rounded(forest(t, account_split(t), (8, 12)).results)


@query("train_boosted_classifier")
def _(t: Tables):
    parts = account_split(t)
    return rounded(models.train_boosted_classifier(
        parts["train"], parts["validation"], accounts.FEATURES, "label").results)


@query("feature_importance")
def _(t: Tables):
    return rounded(models.feature_importance(forest(t, account_split(t)).model, accounts.FEATURES, t.spark, 12))


@query("score_accounts")
def _(t: Tables):
    parts = account_split(t)
    model = forest(t, parts).model
    held = models.probability(model.transform(parts["validation"]))
    threshold = metrics.threshold_by_recall(metrics.pr_curve(held, "score", "label")).first()[0]
    everyone = parts["train"].unionByName(parts["validation"]).unionByName(parts["test"])
    return models.score_accounts(model, everyone, threshold, "1", F.lit(dt.datetime(2024, 1, 1)))


GATE = 0.08
_CHALLENGERS = ("l_tax", "l_discount", "l_quantity", "l_extendedprice")
_AP = " UNION ALL ".join(f"""SELECT {k} AS place, (SELECT sum(pos * (cp / cn)) / sum(pos) FROM (SELECT pos, sum(pos) OVER w AS cp, sum(n) OVER w AS cn FROM (
  SELECT {c} AS s, sum(label) AS pos, count(*) AS n FROM labelled GROUP BY 1) WINDOW w AS (ORDER BY s DESC))) AS value""" for k, c in enumerate(_CHALLENGERS))


def challengers(t: Tables):
    """Average precision of four single columns as scores, one version each."""
    rows = t.raw("lineitem").withColumn("label", (F.col("l_quantity") + F.col("l_discount") * 200 > 45).cast("int"))
    values = [metrics.average_precision(metrics.pr_curve(rows, c, "label")).first()[0] for c in _CHALLENGERS]
    return [("risk", k, v) for k, v in enumerate(values, 1)]


@query("promote_if_better", f"""WITH RECURSIVE labelled AS (SELECT *, CASE WHEN l_quantity + l_discount * 200 > 45 THEN 1 ELSE 0 END AS label FROM lineitem),
judged AS ({_AP}),
run AS (SELECT -1 AS place, NULL::DOUBLE AS value, CAST(NULL AS VARCHAR) AS outcome, NULL::DOUBLE AS champion
  UNION ALL SELECT j.place, j.value, CASE WHEN j.value < {GATE} THEN 'below the minimum' WHEN j.value <= r.champion THEN 'not better' ELSE 'promoted' END,
    CASE WHEN j.value >= {GATE} AND (r.champion IS NULL OR j.value > r.champion) THEN j.value ELSE r.champion END
  FROM run r JOIN judged j ON j.place = r.place + 1)
SELECT place, 'risk' AS model, place + 1 AS version, r4(value) AS value, outcome FROM run WHERE place >= 0""")
def _(t: Tables):
    store = Registry(t.spark, work_folder(t.spark, "registry"))
    return rounded(models.promote_if_better(store, challengers(t), GATE))


@query("registry_history", f"""WITH labelled AS (SELECT *, CASE WHEN l_quantity + l_discount * 200 > 45 THEN 1 ELSE 0 END AS label FROM lineitem),
judged AS (SELECT * FROM ({_AP}) WHERE value >= {GATE}),
best AS (SELECT *, max(value) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS so_far FROM judged)
SELECT CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS generation, 'risk' AS model, place + 1 AS version, r4(value) AS value FROM best WHERE so_far IS NULL OR value > so_far""")
def _(t: Tables):
    store = Registry(t.spark, work_folder(t.spark, "registry"))
    models.promote_if_better(store, challengers(t), GATE)
    return rounded(store.history().drop("path"))


@query("account_model_card")
def _(t: Tables):
    """Forest or boosted trees, refitted and judged on the test accounts (fewer trees and rounds than in the grids above)."""
    parts = account_split(t)
    families = {
        "forest": lambda a, b: models.train_rf_classifier(a, b, accounts.FEATURES, "label", (8,), 100),
        "boosted": lambda a, b: models.train_boosted_classifier(a, b, accounts.FEATURES, "label", ((4, 0.1),), 30)}
    return rounded(models.settle(families, parts["train"], parts["validation"], parts["test"], "label").card)


RISK_FEATURES = ("complexity_rank", "contract_productivity", "agent_day_tasks", "agent_day_fte", "service_fte", "service_load",
                 "tenure_months", "pickup_days", "weekday", "month", "quarter", "week_of_month", "is_month_end",
                 "is_quarter_end", "is_monday", "is_friday", "absent", "service_alert")


def risk_rows(t: Tables):
    rows = staged(detail(t).select("task_id", "load_pos", "created", "service", "status", "handling_days", *RISK_FEATURES), "detail")
    late = workload.late_target(rows).na.drop(subset=list(RISK_FEATURES))
    return rows, staged(timeseries.chrono_split(late, "created", ["task_id", "load_pos"]), "risk")


def risk_tree(rows):
    return models.train_tree_classifier(rows.where("split = 'train'"), rows.where("split = 'validation'"), RISK_FEATURES, "late")


@query("train_tree_classifier")
def _(t: Tables):
    return rounded(risk_tree(risk_rows(t)[1]).results)


@query("score_open_items")
def _(t: Tables):
    tasks, rows = risk_rows(t)
    model = risk_tree(rows).model
    held = models.probability(model.transform(rows.where("split = 'validation'")))
    threshold = metrics.threshold_by_fbeta(metrics.pr_curve(held, "score", "late")).first()[0]
    return rounded(models.score_open_items(model, tasks.where("status = 'O'"), RISK_FEATURES, threshold, ["task_id", "load_pos", "service", "created"]))


@query("train_logistic")
def _(t: Tables):
    known = cleaning.impute_mode_median(t.view("v_loans"), ["employment"], ["loan_amount", "coapplicant_income"])
    loans = known.withColumn("income_log", F.log1p("applicant_income")).withColumn(
        "urgent", (F.col("employment") == "1-URGENT").cast("int")).withColumnRenamed("approved", "label")
    _, summary = models.train_logistic(loans, ["income_log", "loan_amount", "coapplicant_income", "urgent"], "label")
    return rounded(summary)


LOAD_FEATURES = [*[f"volume_lag_{n}" for n in timeseries.LAGS], *[f"fte_lag_{n}" for n in timeseries.LAGS], "volume_mean_7", "load_mean_7",
                 "weekday", "month", "quarter", "week_of_month", "is_month_end", "is_quarter_end", "is_monday", "is_friday", "fte",
                 "weekday_sin", "weekday_cos", "month_sin", "month_cos", "fte_lost", "announced_volume"]


def load_rows(t: Tables):
    days = timeseries.lags(load_global(t), "day", ["volume", "fte"])
    days = timeseries.rolling_mean(days, "day", ["volume", "load"])
    days = workload.active_events_per_day(days, t.view("v_events_mgr"))
    days = workload.cyclic_encode(workload.calendar_features(days, "day"))
    rows = days.select("day", *[F.col(c).cast("double").alias(c) for c in LOAD_FEATURES], "load").na.drop()
    return staged(timeseries.chrono_split(staged(rows, "load"), "day", ["volume_lag_1"]), "load_split")


def _parts(rows):
    return rows.where("split = 'train'"), rows.where("split = 'validation'")


@query("train_linear_regs")
def _(t: Tables):
    trained = models.train_linear_regs(*_parts(load_rows(t)), LOAD_FEATURES, "load")
    both = [m.results.withColumn("family", F.lit(name)) for name, m in trained.items()]
    return rounded(both[0].unionByName(both[1]))


@query("zeroed_features")
def _(t: Tables):
    train, held = _parts(load_rows(t))
    net = models.train_linear_regs(train, held, LOAD_FEATURES, "load")["elastic_net"]
    return models.zeroed_features(net.model, LOAD_FEATURES, t.spark)


@query("train_boosted_regressor")
def _(t: Tables):
    return rounded(models.train_boosted_regressor(*_parts(load_rows(t)), LOAD_FEATURES, "load").results)


@query("backtest_table")
def _(t: Tables):
    rows = load_rows(t)
    train, held = _parts(rows)
    ridge = models.train_linear_regs(train, held, LOAD_FEATURES, "load")["ridge"]
    cuts = rows.groupBy("split").agg(F.max("day").alias("d")).collect()  # three rows
    ends = {r["split"]: r["d"] for r in cuts}
    return rounded(models.backtest_table(ridge.model, rows.drop("split"), "day", "load", ends["train"], ends["validation"], "ridge"))


def volume_series(t: Tables):
    """Business-day volume in total and per service, with the event regressors."""
    parts = load_service(t).where(F.weekday("day") < 5).select("service", "day", F.col("volume").cast("double").alias("y"))
    total = parts.groupBy("day").agg(F.sum("y").alias("y")).withColumn("service", F.lit("ALL"))
    rows = parts.unionByName(total).withColumnRenamed("service", "series")
    return staged(workload.active_events_per_day(rows, t.view("v_events_mgr")), "volumes")


@query("train_seasonal_arx")
def _(t: Tables):
    fitted = forecast.train_seasonal_arx(volume_series(t))
    return rounded(fitted.select("series", F.size("coefficients").alias("n_coefficients"), "mae", "rmse"))


@query("forecast_recursive")
def _(t: Tables):
    rows = volume_series(t)
    names = rows.agg(F.collect_set("series").alias("s"))  # one entry per service
    days = workload.active_events_per_day(next_days(t), t.view("v_events_mgr"))
    ahead = days.withColumn("series", F.explode(names.scalar()))
    return rounded(forecast.forecast_recursive(rows, forecast.train_seasonal_arx(rows), ahead))


SHIFT_DAYS = 2403  # brings the sample's events into the days ahead


def service_outlook(t: Tables):
    """(daily, ahead): the load of each service so far, and its next 30 business days at its recent volume and staff."""
    daily = staged(load_service(t).select(F.col("service").alias("series"), "day", "volume", "fte", "load"), "service-days")
    back = Window.partitionBy("series").orderBy(F.desc("day"))
    recent = daily.withColumn("_r", F.row_number().over(back)).where("_r <= 30").groupBy("series").agg(
        F.avg("volume").alias("volume"), F.avg("fte").alias("fte"))
    names = recent.agg(F.collect_set("series").alias("s"))  # one entry per service
    events = t.view("v_events_mgr").withColumn("event_date", F.date_add("event_date", SHIFT_DAYS))
    days = workload.active_events_per_day(next_days(t), events).withColumn("series", F.explode(names.scalar()))
    return daily, staged(days.join(recent, "series").select("series", "horizon", "day", "volume", "fte", "fte_lost"), "service-ahead")


@query("load_forecast_recursive")
def _(t: Tables):
    daily, ahead = service_outlook(t)
    return rounded(forecast.load_forecast_recursive(daily, ahead, forecast.train_load_model(daily)))


@query("load_forecast_rows", f"""WITH {W.LOADS}, {NEXT_DAYS}, recent AS (SELECT service, avg(volume) AS volume, avg(fte) AS fte FROM (
  SELECT *, row_number() OVER (PARTITION BY service ORDER BY day DESC) AS r FROM load_service) WHERE r <= 30 GROUP BY service)
SELECT service AS series, horizon, n.day, r4(volume) AS volume, r4(fte) AS fte, true AS known, true AS same_chain, true AS adjusted_only_by_events
FROM recent, next_days n""")
def _(t: Tables):
    """What holds of every forecast: its days, its inputs, and that no event reaches the chain of forecasts."""
    daily, ahead = service_outlook(t)
    fitted = staged(forecast.train_load_model(daily), "load-model")
    with_events = forecast.load_forecast_recursive(daily, ahead, fitted)
    without = forecast.load_forecast_recursive(daily, ahead.withColumn("fte_lost", F.lit(0.0)), fitted).select(
        "series", "horizon", F.col("load_forecast").alias("calm"), F.col("load_adjusted").alias("calm_adjusted"))
    both = with_events.join(without, ["series", "horizon"]).join(ahead.select("series", "horizon", "fte_lost"), ["series", "horizon"])
    return rounded(both.select(
        "series", "horizon", "day", "volume", "fte", F.col("load_forecast").isNotNull().alias("known"), (F.col("load_forecast") == F.col("calm")).alias("same_chain"),
        ((F.col("calm_adjusted") == F.col("calm")) & ((F.col("fte_lost") > 0) | (F.col("load_adjusted") == F.col("load_forecast")))).alias("adjusted_only_by_events")))


def one_series(t: Tables):
    return business(t).select(F.lit("ALL").alias("series"), F.col("d").alias("day"), F.col("volume").alias("y"))


@query("walk_forward_scores")
def _(t: Tables):
    return rounded(forecast.walk_forward_scores(one_series(t)))


TASK_IDS = ["task_id", "load_pos"]
LATE_FEATURES = ["volume", "complexity_rank", "contract_productivity", "pickup_days", "weekday", "month"]


@query("walk_forward_late")
def _(t: Tables):
    """Late risk of each task by a linear model of the 20 000 tasks before its fold (the samples hold too few for 50 000)."""
    rows = workload.calendar_features(workload.ordinal_coefficients(workload.productivity(workload.duration_features(t.view("v_tasks_clean")))), "created")
    rows = staged(rows.select(*TASK_IDS, "created", "handling_days", *LATE_FEATURES), "late")  # read for the limit, the places and the rows
    late = workload.late_target(rows).select(*TASK_IDS, "created", *[F.col(c).cast("double").alias(c) for c in LATE_FEATURES], "late").na.drop()
    scored = folds.walk_forward(late, "created", TASK_IDS, LATE_FEATURES, "late", 20_000, 4_000)
    return rounded(scored.select(*TASK_IDS, "fold", "train_rows", "late", "score"), 6)


@query("forward_search")
def _(t: Tables):
    return rounded(forecast.forward_search(one_series(t)), 6)


@query("expanding_curve")
def _(t: Tables):
    return rounded(forecast.expanding_curve(one_series(t)))


ANOMALY_FEATURES = ("minutes", "volume", "items_per_hour", "handling_days", "pickup_days", "complexity_rank", "contract_productivity")
def anomaly_rows(t: Tables):
    rows = workload.ordinal_coefficients(workload.productivity(workload.duration_features(t.view("v_tasks_clean"))))
    rows = rows.select(*TASK_IDS, "service", "created", *[F.col(c).cast("double").alias(c) for c in ANOMALY_FEATURES])
    known = staged(rows.na.drop(subset=list(ANOMALY_FEATURES)), "anomaly")
    return staged(timeseries.chrono_split(known, "created", TASK_IDS), "anomaly_split")


@query("train_isolation_forest")
def _(t: Tables):
    nodes = isolation.train(anomaly_rows(t).where("split = 'train'"), ANOMALY_FEATURES, TASK_IDS)
    return nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n_nodes"), F.max("depth").alias("depth"),
                                     F.max(F.when(F.col("node") == 1, F.col("rows"))).alias("sample_rows"))


@query("score_isolation")
def _(t: Tables):
    rows = anomaly_rows(t)
    nodes, cut = isolation.train_flagging(rows.where("split = 'train'"), ANOMALY_FEATURES, TASK_IDS, 100, 0.02)
    scored = isolation.flagged(isolation.score(rows, nodes, ANOMALY_FEATURES), cut)
    return rounded(scored.select(*TASK_IDS, "service", "split", "anomaly_score", "decision", "is_anomaly"), 6)


@query("search_trees")
def _(t: Tables):
    rows = anomaly_rows(t)
    return rounded(isolation.search_trees(rows.where("split = 'train'"), rows.where("split = 'validation'").drop("split"),
                                          ANOMALY_FEATURES, TASK_IDS))


@query("anomaly_drivers")
def _(t: Tables):
    rows = anomaly_rows(t)
    nodes = staged(isolation.train(rows.where("split = 'train'"), ANOMALY_FEATURES, TASK_IDS), "nodes")
    return rounded(isolation.drivers(rows, nodes, ANOMALY_FEATURES, TASK_IDS), 6)


def router(t: Tables):
    return models.train_intent_router(t.raw("documents"), "text", "lang", ["doc_id"])


@query("train_intent_router", f"""WITH split AS (SELECT CASE WHEN lang IS NULL THEN 'unlabelled' WHEN rn <= floor(n * 0.15::DOUBLE + 0.5) THEN 'test'
  WHEN rn <= floor(n * 0.15::DOUBLE + 0.5) * 2 THEN 'validation' ELSE 'train' END AS split FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY {tie_sql("42", "doc_id")}) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents))
SELECT s AS split, (SELECT count(*) FROM split WHERE split = s) AS n, s <> 'unlabelled' AS accurate FROM (SELECT unnest(['train', 'validation', 'test', 'unlabelled']) AS s)""")
def _(t: Tables):
    found = router(t).report
    return found.select("split", "n", F.coalesce(F.col("accuracy") >= 0.9, F.lit(False)).alias("accurate"))


@query("route_messages")
def _(t: Tables):
    return models.route_messages(router(t), t.raw("conversations"), "text", ["conv_id", "turn"])
