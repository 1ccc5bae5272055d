"""Queries for staffing decisions."""

import datetime as dt

from pyspark.sql import functions as F

from opsloom.operators import decisions, profile, timeseries, workload
from opsloom.plans import workload_sql as W
from opsloom.plans.catalogue import Tables, query, rounded
from opsloom.plans.timeseries import (
    FORECAST, NEXT_DAYS, STREAK_SQL, forecast, load_global, load_service, next_days)

UNTIL = dt.date(2001, 8, 1)
# Leave records carry the contract of their agent and a day count of 0 to 90.
ABSENCES = """contract_absences AS (SELECT b.*, r.contract, CASE WHEN end_date - start_date + 1 BETWEEN 0 AND 90 THEN end_date - start_date + 1 END AS days
  FROM v_absences b LEFT JOIN v_roster r ON b.agent_id = r.agent_id)"""
RATES = """rates AS (SELECT coalesce(a.contract, b.contract) AS contract, least(greatest(coalesce(absence_days / active_days, 0.1::DOUBLE), 0.0), 0.9::DOUBLE) AS absence_rate FROM
  (SELECT contract, sum(days) AS absence_days FROM contract_absences WHERE contract IS NOT NULL GROUP BY 1) a FULL JOIN
  (SELECT contract, sum(greatest(least(coalesce(contract_end, DATE '2001-08-01'), DATE '2001-08-01') - entered, 0) + 1) AS active_days FROM v_roster GROUP BY 1) b
  ON a.contract = b.contract)"""


def absences(t: Tables):
    out = t.view("v_absences").join(t.view("v_roster").select("agent_id", "contract"), "agent_id", "left")
    days = F.datediff("end_date", "start_date") + 1
    return out.withColumn("days", F.when(days.between(0, 90), days))


def rates(t: Tables):
    known = absences(t).where(F.col("contract").isNotNull())
    return decisions.absence_rate_contract(t.view("v_roster"), known, UNTIL)


@query("absence_rate_contract", f"WITH {ABSENCES}, {RATES} SELECT contract, r4(absence_rate) AS absence_rate FROM rates")
def _(t: Tables):
    return rounded(rates(t))


# Target dates on both sides of the last known leave.
TARGETS = f"""{NEXT_DAYS}, targets AS (SELECT day FROM next_days UNION SELECT CAST(start_date AS DATE) FROM v_absences WHERE month(start_date) = 6 AND day(start_date) = 15)"""


def targets(t: Tables):
    past = t.view("v_absences").where((F.month("start_date") == 6) & (F.dayofmonth("start_date") == 15))
    return next_days(t).select("day").union(past.select("start_date")).distinct()


@query("roster_at_date", f"""WITH {TARGETS} SELECT day, agent_id, service FROM targets JOIN v_roster ON entered <= day AND (contract_end IS NULL OR contract_end >= day)""")
def _(t: Tables):
    return decisions.roster_at_date(targets(t), t.view("v_roster")).select("day", "agent_id", "service")


@query("absent_at_date", f"WITH {TARGETS} SELECT DISTINCT day, agent_id FROM targets JOIN v_absences ON start_date <= day AND end_date >= day")
def _(t: Tables):
    return decisions.absent_at_date(targets(t), t.view("v_absences"))


FTE = f"""{ABSENCES}, {RATES}, present AS (SELECT t.day, r.service, t.day <= (SELECT max(end_date) FROM v_absences) AS covered,
    {W.WORKTIME.format(c='r.worktime')} * CASE WHEN t.day <= (SELECT max(end_date) FROM v_absences) THEN CASE WHEN a.agent_id IS NULL THEN 1 ELSE 0 END
      ELSE 1 - coalesce(absence_rate, 0.1) END AS f
  FROM targets t JOIN v_roster r ON entered <= t.day AND (contract_end IS NULL OR contract_end >= t.day)
  LEFT JOIN (SELECT DISTINCT day, agent_id FROM targets JOIN v_absences ON start_date <= day AND end_date >= day) a ON a.day = t.day AND a.agent_id = r.agent_id
  LEFT JOIN rates x ON r.contract = x.contract),
fte AS (SELECT day, service, CAST(sum(CAST(f AS DECIMAL(24,12))) AS DOUBLE) AS fte, CAST(max(covered) AS INTEGER) AS covered FROM present GROUP BY 1, 2
  UNION ALL SELECT day, 'ALL', CAST(sum(CAST(f AS DECIMAL(24,12))) AS DOUBLE), CAST(max(covered) AS INTEGER) FROM present GROUP BY 1)"""


def fte(t: Tables, dates):
    return decisions.fte_projection(dates, t.view("v_roster"), t.view("v_absences"), rates(t))


@query("fte_projection", f"WITH {TARGETS}, {FTE} SELECT day, service, r4(fte) AS fte, covered FROM fte")
def _(t: Tables):
    return rounded(fte(t, targets(t)))


_TARGETS_AHEAD = "targets AS (SELECT day FROM next_days)"
SHARES = """shares AS (SELECT service, sum(volume) / (SELECT sum(volume) FROM vol_service) AS share FROM vol_service GROUP BY 1)"""
PROJECTED = f"""{W.LOADS}, {FORECAST}, {_TARGETS_AHEAD}, {FTE}, {SHARES},
projected AS (SELECT f.day, horizon, f.service, fte, share, volume * share / fte AS load FROM fte f JOIN forecast c ON f.day = c.day LEFT JOIN shares s ON f.service = s.service
  WHERE f.service <> 'ALL' AND fte > 0)"""
P75 = "p75 AS (SELECT service, quantile_cont(load, 0.75) AS p75 FROM load_service GROUP BY 1)"


def projected(t: Tables, daily=None):
    daily = load_service(t) if daily is None else daily
    totals = daily.groupBy("day").agg(F.sum("volume").alias("volume"))
    made = forecast(t, totals)
    return decisions.load_projection(made, daily, fte(t, made.select("day")))


@query("volume_share", f"WITH {W.LOADS}, {SHARES} SELECT service, r6(share) AS share FROM shares")
def _(t: Tables):
    daily = workload.volume_per_day_service(t.view("v_tasks_clean"))
    return rounded(profile.share_of_total(daily, "service", "volume"), 6)


@query("service_p75", f"WITH {W.LOADS}, {P75} SELECT service, r4(p75) AS p75 FROM p75")
def _(t: Tables):
    return rounded(decisions.service_p75(load_service(t)))


@query("load_projection", f"WITH {PROJECTED} SELECT day, horizon, service, r4(fte) AS fte, r4(share) AS share, r4(load) AS load FROM projected")
def _(t: Tables):
    return rounded(projected(t))


MOVES = """mean_load AS (SELECT day, sum(load * fte) / sum(fte) AS mean_load FROM projected GROUP BY 1),
moves AS (SELECT p.*, mean_load, fte * load / mean_load AS suggested_fte, fte * load / mean_load - fte AS delta_fte FROM projected p JOIN mean_load m ON p.day = m.day)"""


@query("balanced_reallocation", f"""WITH {PROJECTED}, {MOVES} SELECT day, horizon, service, r4(fte) AS fte, r4(share) AS share, r4(load) AS load, r4(mean_load) AS mean_load,
  r4(suggested_fte) AS suggested_fte, r4(delta_fte) AS delta_fte FROM moves""")
def _(t: Tables):
    return rounded(decisions.balanced_reallocation(projected(t)))


@query("balance_kpis", f"""WITH {PROJECTED}, {MOVES} SELECT day, r4(max(load)) AS max_load, r4(min(load)) AS min_load, arg_max(service, load) AS most_loaded, arg_min(service, load) AS least_loaded,
  r4(sum(greatest(delta_fte, 0))) AS fte_to_move, r4((max(load) / min(load) - 1) * 100) AS gap_pct FROM moves GROUP BY 1""")
def _(t: Tables):
    return rounded(decisions.balance_kpis(decisions.balanced_reallocation(projected(t))))


@query("sustained_overload", f"""WITH {PROJECTED}, {P75}, m AS (SELECT service, avg(load) AS mean_load, min(day) AS first_day, max(day) AS last_day FROM projected WHERE horizon BETWEEN 3 AND 16 GROUP BY 1)
SELECT m.service, r4(mean_load) AS mean_load, first_day, last_day, r4(p75) AS p75 FROM m JOIN p75 ON m.service = p75.service WHERE mean_load > p75""")
def _(t: Tables):
    daily = load_service(t)
    return rounded(decisions.sustained_overload(projected(t, daily), decisions.service_p75(daily), start=3))


@query("overload_alerts", f"""WITH {PROJECTED}, {P75} SELECT p.service, r4(load) AS load, r4(p75) AS p75,
  CASE WHEN streak > 0 THEN concat(CAST(streak AS VARCHAR), ' days so far, forecast to continue') ELSE 'new risk' END AS note
FROM projected p JOIN p75 ON p.service = p75.service LEFT JOIN {STREAK_SQL} s ON p.service = s.service WHERE horizon = 1 AND load > p75""")
def _(t: Tables):
    daily = load_service(t)
    streaks = timeseries.alert_streak(workload.overload_alert(daily, ["service"]))
    return rounded(decisions.overload_alerts(projected(t, daily), decisions.service_p75(daily), streaks, 1))


@query("service_forecast_table", f"""WITH {W.LOADS}, {FORECAST}, {SHARES} SELECT day, horizon, service, r4(volume_low * share) AS volume_low, r4(volume * share) AS volume,
  r4(volume_high * share) AS volume_high FROM forecast JOIN (SELECT service, share FROM shares UNION ALL SELECT 'ALL', 1.0) ON true WHERE horizon <= 7""")
def _(t: Tables):
    daily = workload.volume_per_day_service(t.view("v_tasks_clean"))
    made = forecast(t, daily.groupBy("day").agg(F.sum("volume").alias("volume")))
    return rounded(decisions.service_forecast_table(made, daily))


@query("event_adjusted_forecast", f"""WITH {W.LOADS}, {FORECAST}, {_TARGETS_AHEAD}, {FTE},
future AS (SELECT kind, fte_impact, extra_volume, event_date + 2403 AS s, duration_days FROM v_events_mgr),
impact AS (SELECT day, coalesce(sum(CASE WHEN kind = 'fte_incident' THEN fte_impact END), 0) AS fte_lost, coalesce(sum(CASE WHEN kind = 'announcement' THEN extra_volume END), 0) AS announced
  FROM next_days LEFT JOIN future ON day BETWEEN s AND s + greatest(coalesce(duration_days, 1), 1) - 1 GROUP BY 1)
SELECT c.day, horizon, volume, r4(volume + announced) AS volume_adjusted, r4(fte) AS fte, r4(CASE WHEN fte_lost <> 0 THEN greatest(fte - fte_lost, 0.1) ELSE fte END) AS fte_adjusted
FROM forecast c JOIN impact i ON c.day = i.day LEFT JOIN fte f ON c.day = f.day AND f.service = 'ALL'""")
def _(t: Tables):
    made = forecast(t, load_global(t))
    # The sample events end before the forecast starts; move them to cover it.
    future = t.view("v_events_mgr").withColumn("event_date", F.date_add("event_date", 2403))
    impact = workload.active_events_per_day(made.select("day"), future)
    return rounded(decisions.event_adjusted_forecast(made, impact, fte(t, made.select("day"))))
