"""Queries over tasks, agents, absences and manager events."""

from pyspark.sql import functions as F

from opsloom.functions import scalars as S
from opsloom.operators import workload
from opsloom.plans import workload_sql as W
from opsloom.plans.catalogue import Tables, query, rounded


def agent_days(t: Tables, tasks=None):
    return workload.agent_days(t.view("v_tasks_clean") if tasks is None else tasks, t.view("v_agents"), t.view("v_absences"))


def detail(t: Tables):
    return workload.feature_detail(t.once("v_tasks_clean"), t.view("v_agents"), t.view("v_absences"))


@query("duration_features", f"""SELECT task_id, load_pos, {W.PICKUP} AS pickup_days, {W.HANDLING} AS handling_days,
  {W.TOTAL} AS total_days FROM v_tasks_clean""")
def _(t: Tables):
    return workload.duration_features(t.view("v_tasks_clean")).select(
        "task_id", "load_pos", "pickup_days", "handling_days", "total_days")


@query("calendar_features", f"SELECT d, n, {W.columns(W.calendar('d'))} FROM v_daily")
def _(t: Tables):
    return workload.calendar_features(t.view("v_daily").select("d", "n"), "d")


@query("productivity", f"SELECT task_id, load_pos, r4({W.RATE}) AS items_per_hour FROM v_tasks_clean")
def _(t: Tables):
    return rounded(workload.productivity(t.view("v_tasks_clean")).select("task_id", "load_pos", "items_per_hour"))


@query("declared_vs_actual", f"SELECT task_id, load_pos, minutes - ({W.HANDLING}) * 480 AS minutes_gap FROM v_tasks_clean")
def _(t: Tables):
    return workload.declared_vs_actual(t.view("v_tasks_clean")).select("task_id", "load_pos", "minutes_gap")


_TENURE = "round_even((created - entered) / 30, 1)"
_AGENT_JOIN = "FROM v_tasks_clean t LEFT JOIN v_agents a ON t.agent_id = a.agent_id"


@query("tenure_months", f"""SELECT task_id, load_pos, CASE WHEN {_TENURE} >= 0 THEN {_TENURE} END AS tenure_months {_AGENT_JOIN}""")
def _(t: Tables):
    return workload.tenure_and_contract(t.view("v_tasks_clean"), t.view("v_agents")).select(
        "task_id", "load_pos", "tenure_months")


@query("contract_active", f"""SELECT task_id, load_pos, {W.ACTIVE.format(end='contract_end', day='created')} AS contract_active {_AGENT_JOIN}""")
def _(t: Tables):
    return workload.tenure_and_contract(t.view("v_tasks_clean"), t.view("v_agents")).select(
        "task_id", "load_pos", "contract_active")


@query("worktime_coeff", f"SELECT agent_id, {W.WORKTIME.format(c='worktime')} AS worktime_share FROM v_agents")
def _(t: Tables):
    return t.view("v_agents").select("agent_id", S.worktime_coeff("worktime").alias("worktime_share"))


@query("ordinal_coeff_maps", f"""SELECT task_id, load_pos, {W.RANK} AS complexity_rank, {W.CONTRACT} AS contract_productivity
FROM v_tasks_clean""")
def _(t: Tables):
    return workload.ordinal_coefficients(t.view("v_tasks_clean")).select(
        "task_id", "load_pos", "complexity_rank", "contract_productivity")


@query("cyclic_encode", """SELECT d, r4(sin((isodow(d) - 1) * 2 * pi() / 7)) AS weekday_sin, r4(cos((isodow(d) - 1) * 2 * pi() / 7)) AS weekday_cos,
  r4(sin(month(d) * 2 * pi() / 12)) AS month_sin, r4(cos(month(d) * 2 * pi() / 12)) AS month_cos FROM v_daily""")
def _(t: Tables):
    days = workload.calendar_features(t.view("v_daily").select("d"), "d")
    return rounded(workload.cyclic_encode(days).select("d", "weekday_sin", "weekday_cos", "month_sin", "month_cos"))


@query("interval_of_event", """SELECT id, event_date, CAST(event_date + INTERVAL 1 DAY * (greatest(coalesce(duration_days, 1), 1) - 1) AS DATE) AS end_date
FROM v_events_mgr""")
def _(t: Tables):
    return workload.interval_of_event(t.view("v_events_mgr")).select("id", "event_date", "end_date")


@query("backjoin_aggregate", f"""
WITH r AS (SELECT *, {W.RATE} AS rate FROM v_tasks_clean)
SELECT task_id, load_pos, count(*) OVER (PARTITION BY agent_id, created) AS agent_day_tasks,
  r4(avg(rate) OVER (PARTITION BY agent_id)) AS agent_mean_rate, r4(avg(minutes) OVER (PARTITION BY service)) AS service_mean_minutes,
  r4(minutes / avg(minutes) OVER (PARTITION BY service)) AS minutes_ratio FROM r""")
def _(t: Tables):
    return rounded(workload.backjoin_aggregate(t.view("v_tasks_clean")).select(
        "task_id", "load_pos", "agent_day_tasks", "agent_mean_rate", "service_mean_minutes", "minutes_ratio"))


@query("absence_days", f"WITH {W.ABSENT} SELECT agent_id, day FROM absent")
def _(t: Tables):
    return workload.absence_days(t.view("v_absences"))


@query("absence_flag", f"""WITH {W.ABSENT}
SELECT task_id, load_pos, CASE WHEN b.day IS NULL THEN 0 ELSE 1 END AS absent FROM v_tasks_clean t
LEFT JOIN absent b ON t.agent_id = b.agent_id AND t.created = b.day""")
def _(t: Tables):
    days = workload.absence_days(t.view("v_absences")).withColumnRenamed("day", "created").withColumn("absent", F.lit(1))
    return t.view("v_tasks_clean").join(days, ["agent_id", "created"], "left").select(
        "task_id", "load_pos", F.coalesce("absent", F.lit(0)).alias("absent"))


@query("active_events_per_day", """
WITH spans AS (SELECT kind, fte_impact, extra_volume, event_date AS s, CAST(event_date + INTERVAL 1 DAY * (greatest(coalesce(duration_days, 1), 1) - 1) AS DATE) AS e FROM v_events_mgr),
impact AS (SELECT d, sum(CASE WHEN kind = 'fte_incident' THEN fte_impact END) AS f, sum(CASE WHEN kind = 'announcement' THEN extra_volume END) AS v
  FROM (SELECT *, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM spans) GROUP BY d)
SELECT a.d AS day, coalesce(f, 0)::DOUBLE AS fte_lost, coalesce(v, 0)::DOUBLE AS announced_volume FROM v_daily a LEFT JOIN impact i ON a.d = i.d""")
def _(t: Tables):
    days = t.view("v_daily").select(F.col("d").alias("day"))
    return workload.active_events_per_day(days, t.view("v_events_mgr"))


@query("fte_per_day", f"""WITH {W.AGENT_DAYS}
SELECT day, service, r4(sum(fte)) AS fte FROM agent_days GROUP BY 1, 2 UNION ALL SELECT day, 'ALL', r4(sum(fte)) FROM agent_days GROUP BY 1""")
def _(t: Tables):
    parts = workload.fte_per_day_service(agent_days(t))
    # Days add up from the service rows, so the agent-day table is built once.
    total = parts.groupBy("day").agg(F.lit("ALL").alias("service"), F.sum("fte").alias("fte"))
    return rounded(parts.unionByName(total))


@query("load_per_fte", f"""WITH {W.LOADS}
SELECT day, 'ALL' AS service, n_tasks, volume, r4(fte) AS fte, r4(load) AS load FROM load_day
UNION ALL SELECT day, service, n_tasks, volume, r4(fte), r4(load) FROM load_service""")
def _(t: Tables):
    tasks = t.once("v_tasks_clean")
    days = agent_days(t, tasks)
    total = workload.load_per_day(tasks, days).withColumn("service", F.lit("ALL"))
    return rounded(total.unionByName(workload.load_per_day_service(tasks, days)))


@query("overload_alert", f"""WITH {W.LOADS}
SELECT day, 'ALL' AS service, r4(load) AS load, r4(threshold) AS threshold, alert FROM alert_day
UNION ALL SELECT day, service, r4(load), r4(threshold), alert FROM alert_service""")
def _(t: Tables):
    tasks = t.once("v_tasks_clean")
    days = agent_days(t, tasks)
    total = workload.overload_alert(workload.load_per_day(tasks, days)).withColumn("service", F.lit("ALL"))
    parts = workload.overload_alert(workload.load_per_day_service(tasks, days), ["service"])
    return rounded(total.unionByName(parts).select("day", "service", "load", "threshold", "alert"))


@query("daily_global", f"WITH {W.LOADS} {W.DAILY_GLOBAL}")
def _(t: Tables):
    return rounded(workload.daily_global(t.once("v_tasks_clean"), agent_days(t, t.once("v_tasks_clean"))))


@query("daily_service", f"WITH {W.LOADS} {W.DAILY_SERVICE}")
def _(t: Tables):
    return rounded(workload.daily_service(t.once("v_tasks_clean"), agent_days(t, t.once("v_tasks_clean"))))


DETAIL_SQL = f"""SELECT t.*, {W.PICKUP} AS pickup_days, {W.HANDLING} AS handling_days, {W.RATE} AS items_per_hour, {W.RANK} AS complexity_rank,
  {W.CONTRACT} AS contract_productivity, agent_day_tasks, absent, d.fte AS agent_day_fte, s.fte AS service_fte, s.load AS service_load, s.alert AS service_alert,
  l.fte AS day_fte, l.load AS day_load, l.alert AS day_alert,
  CASE WHEN round_even((created - entered) / 30, 1) >= 0 THEN round_even((created - entered) / 30, 1) END AS tenure_months
FROM v_tasks_clean t JOIN agent_days d ON t.agent_id = d.agent_id AND t.created = d.day
JOIN (SELECT day, service, fte, load, alert FROM alert_service) s ON t.created = s.day AND t.service = s.service JOIN (SELECT day, fte, load, alert FROM alert_day) l ON t.created = l.day"""


@query("feature_detail", f"""WITH {W.LOADS}, detail AS ({DETAIL_SQL})
SELECT task_id, load_pos, pickup_days, handling_days, r4(items_per_hour) AS items_per_hour, complexity_rank, contract_productivity, agent_day_tasks,
  absent, r4(agent_day_fte) AS agent_day_fte, r4(service_fte) AS service_fte, r4(service_load) AS service_load, service_alert, r4(day_fte) AS day_fte,
  r4(day_load) AS day_load, day_alert, r4(tenure_months) AS tenure_months FROM detail""")
def _(t: Tables):
    return rounded(detail(t).select(
        "task_id", "load_pos", "pickup_days", "handling_days", "items_per_hour", "complexity_rank", "contract_productivity",
        "agent_day_tasks", "absent", "agent_day_fte", "service_fte", "service_load", "service_alert", "day_fte",
        "day_load", "day_alert", "tenure_months"), only=[
        "items_per_hour", "agent_day_fte", "service_fte", "service_load", "day_fte", "day_load", "tenure_months"])


@query("agent_profile", f"""WITH {W.LOADS}, detail AS ({DETAIL_SQL})
SELECT agent_id, service, contract, count(*) AS n_tasks, r4(avg(items_per_hour)) AS mean_rate, r4(avg(handling_days)) AS mean_handling_days,
  r4(avg(pickup_days)) AS mean_pickup_days, r4(max(tenure_months)) AS tenure_months, r4(avg(service_load)) AS mean_load,
  CAST(sum(absent) AS BIGINT) AS absence_days FROM detail GROUP BY 1, 2, 3""")
def _(t: Tables):
    return rounded(workload.agent_profile(detail(t)))


@query("reconcile_totals", f"""WITH {W.LOADS}
SELECT count(*) AS n_days, r4(max(abs(a.fte - b.fte))) AS max_gap, count(*) FILTER (WHERE abs(a.fte - b.fte) > 0.01) AS days_with_gap
FROM load_day a JOIN (SELECT day, sum(fte) AS fte FROM load_service GROUP BY 1) b ON a.day = b.day""")
def _(t: Tables):
    tasks = t.once("v_tasks_clean")
    days = agent_days(t, tasks)
    return rounded(workload.reconcile_totals(
        workload.load_per_day(tasks, days), workload.load_per_day_service(tasks, days), ["day"], "fte"))


@query("sparse_export", """SELECT agent_id, status, CASE WHEN status = 'O' THEN task_id END AS task_id, CASE WHEN status = 'O' THEN load_pos END AS load_pos,
  CASE WHEN status = 'O' THEN created END AS created, CASE WHEN status = 'O' THEN volume END AS volume FROM v_tasks_clean""")
def _(t: Tables):
    tasks = t.view("v_tasks_clean").select("agent_id", "status", "task_id", "load_pos", "created", "volume")
    return workload.sparse_export(tasks, F.col("status") == "O", ["task_id", "load_pos", "created", "volume"])


LATE_SQL = f"""known AS (SELECT task_id, load_pos, service, contract, complexity, process, created, minutes, volume, {W.HANDLING} AS handling_days FROM v_tasks_clean WHERE {W.HANDLING} IS NOT NULL),
late AS (SELECT *, (SELECT quantile_cont(handling_days, 0.75) FROM known) AS limit_days,
  CASE WHEN handling_days > (SELECT quantile_cont(handling_days, 0.75) FROM known) THEN 1 ELSE 0 END AS late FROM known)"""


@query("late_target", f"WITH {LATE_SQL} SELECT task_id, load_pos, handling_days, limit_days, late FROM late")
def _(t: Tables):
    return workload.late_target(workload.duration_features(t.view("v_tasks_clean"))).select(
        "task_id", "load_pos", "handling_days", "limit_days", "late")
