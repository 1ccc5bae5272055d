"""SQL fragments that the checks of several workload queries share."""

from opsloom.functions import scalars as S

WORKTIME = """CASE WHEN {c} IS NULL THEN 1.0::DOUBLE
  WHEN TRY_CAST(replace(trim({c}), '%', '') AS DOUBLE) > 1 THEN TRY_CAST(replace(trim({c}), '%', '') AS DOUBLE) / 100
  WHEN TRY_CAST(replace(trim({c}), '%', '') AS DOUBLE) IS NOT NULL THEN TRY_CAST(replace(trim({c}), '%', '') AS DOUBLE)
  WHEN contains(lower({c}), 'plein') THEN 1.0 WHEN contains(lower({c}), 'partiel') THEN 0.8 ELSE 1.0 END"""
ACTIVE = "CASE WHEN {end} IS NULL THEN 1 WHEN {end} >= {day} THEN 1 ELSE 0 END"
RANK = "CASE complexity " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in S.COMPLEXITY_RANKS.items()) + f" ELSE {S.COMPLEXITY_RANK_DEFAULT} END"
CONTRACT = "CASE contract " + " ".join(
    f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in S.CONTRACT_PRODUCTIVITY.items()
) + f" ELSE {S.CONTRACT_PRODUCTIVITY_DEFAULT}::DOUBLE END"
PICKUP = "CASE WHEN taken - created BETWEEN 0 AND 60 THEN CAST(taken - created AS INTEGER) END"
HANDLING = "CASE WHEN closed - taken BETWEEN 1 AND 90 THEN CAST(closed - taken AS INTEGER) END"
TOTAL = "CASE WHEN closed - created >= 1 THEN CAST(closed - created AS INTEGER) END"
RATE = """CASE WHEN minutes > 0 AND volume > 0 AND volume::DOUBLE / (minutes / 60) <= 25
  THEN volume::DOUBLE / (minutes / 60) END"""


def calendar(d: str) -> dict[str, str]:
    return {
        "weekday": f"CAST(isodow({d}) - 1 AS INTEGER)", "day_name": f"dayname({d})", "month": f"CAST(month({d}) AS INTEGER)",
        "quarter": f"CAST(quarter({d}) AS INTEGER)", "iso_week": f"CAST(weekofyear({d}) AS INTEGER)",
        "year": f"CAST(year({d}) AS INTEGER)", "week_of_month": f"CAST((day({d}) - 1) // 7 + 1 AS INTEGER)",
        "is_month_end": f"CASE WHEN day({d}) >= 25 THEN 1 ELSE 0 END",
        "is_month_start": f"CASE WHEN day({d}) <= 5 THEN 1 ELSE 0 END",
        "is_monday": f"CASE WHEN isodow({d}) = 1 THEN 1 ELSE 0 END",
        "is_friday": f"CASE WHEN isodow({d}) = 5 THEN 1 ELSE 0 END",
        "is_quarter_end": f"CASE WHEN month({d}) IN (3, 6, 9, 12) THEN 1 ELSE 0 END",
        "is_august": f"CASE WHEN month({d}) = 8 THEN 1 ELSE 0 END",
    }


def columns(parts: dict[str, str], only: list[str] | None = None) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in parts.items() if only is None or k in only)


DAILY_CALENDAR = ["weekday", "month", "quarter", "is_month_end", "is_quarter_end", "is_monday", "is_friday",
                  "week_of_month"]
ABSENT = """absent AS (SELECT DISTINCT agent_id, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS day
  FROM v_absences WHERE end_date >= start_date AND end_date - start_date + 1 <= 90)"""
AGENT_DAYS = f"""{ABSENT}, agent_first AS (SELECT agent_id, created AS day, service, n FROM (
    SELECT *, row_number() OVER (PARTITION BY agent_id, created ORDER BY task_id, load_pos, volume NULLS FIRST, minutes NULLS FIRST) AS rn,
      count(*) OVER (PARTITION BY agent_id, created) AS n FROM v_tasks_clean) WHERE rn = 1),
agent_days AS (SELECT f.agent_id, f.day, f.service, f.n AS agent_day_tasks, g.entered, CASE WHEN b.day IS NULL THEN 0 ELSE 1 END AS absent,
    {WORKTIME.format(c='g.worktime')} * {ACTIVE.format(end='g.contract_end', day='f.day')} * CASE WHEN b.day IS NULL THEN 1 ELSE 0 END AS fte
  FROM agent_first f LEFT JOIN v_agents g ON f.agent_id = g.agent_id LEFT JOIN absent b ON f.agent_id = b.agent_id AND f.day = b.day)"""
LOADS = f"""{AGENT_DAYS},
fte_day AS (SELECT day, CAST(sum(CAST(fte AS DECIMAL(18,6))) AS DOUBLE) AS fte FROM agent_days GROUP BY 1),
fte_service AS (SELECT day, service, CAST(sum(CAST(fte AS DECIMAL(18,6))) AS DOUBLE) AS fte FROM agent_days GROUP BY 1, 2),
vol_service AS (SELECT created AS day, service, count(*) AS n_tasks, CAST(coalesce(sum(volume), 0) AS BIGINT) AS volume FROM v_tasks_clean GROUP BY 1, 2),
vol_day AS (SELECT day, CAST(sum(n_tasks) AS BIGINT) AS n_tasks, CAST(sum(volume) AS BIGINT) AS volume FROM vol_service GROUP BY 1),
load_day AS (SELECT v.day, n_tasks, volume, fte, CASE WHEN fte > 0 THEN volume::DOUBLE / fte END AS load
  FROM vol_day v LEFT JOIN fte_day f ON v.day = f.day),
load_service AS (SELECT v.day, v.service, n_tasks, volume, fte, CASE WHEN fte > 0 THEN volume::DOUBLE / fte END AS load
  FROM vol_service v LEFT JOIN fte_service f ON v.day = f.day AND v.service = f.service),
limit_day AS (SELECT quantile_cont(load, 0.75) AS threshold FROM v_tasks_clean t JOIN load_day l ON t.created = l.day),
limit_service AS (SELECT l.service, quantile_cont(load, 0.75) AS threshold FROM v_tasks_clean t
  JOIN load_service l ON t.created = l.day AND t.service = l.service GROUP BY 1),
alert_day AS (SELECT l.*, threshold, CASE WHEN load > threshold THEN 1 ELSE 0 END AS alert FROM load_day l, limit_day),
alert_service AS (SELECT l.*, threshold, CASE WHEN load > threshold THEN 1 ELSE 0 END AS alert FROM load_service l
  LEFT JOIN limit_service s ON l.service = s.service)"""


def daily(keys: list[str], alert: str) -> str:
    key = ", ".join(keys)
    on = " AND ".join(f"a.{k} = m.{k}" for k in keys)
    named = key.replace("day", "created AS day", 1)
    return f"""SELECT {", ".join("a." + k for k in keys)}, n_tasks, volume, r4(fte) AS fte, r4(load) AS load, alert, r4(mean_minutes) AS mean_minutes,
  r4(median_handling_days) AS median_handling_days, r4(mean_complexity) AS mean_complexity, {columns(calendar('a.day'), DAILY_CALENDAR)}
FROM {alert} a LEFT JOIN (SELECT {named}, avg(minutes) AS mean_minutes, avg({RANK}) AS mean_complexity,
  quantile_cont({HANDLING}, 0.5) AS median_handling_days FROM v_tasks_clean GROUP BY {", ".join(str(i + 1) for i in range(len(keys)))}) m ON {on}"""


DAILY_GLOBAL = daily(["day"], "alert_day")
DAILY_SERVICE = daily(["day", "service"], "alert_service")
