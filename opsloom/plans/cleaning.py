"""Queries that clean the raw task extracts and check the typed ones."""

from pyspark.sql import functions as F

from opsloom.functions import scalars as S
from opsloom.operators import cleaning
from opsloom.plans.catalogue import Tables, query, rounded


def _when(column: str, values: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {_lit(v)}" for k, v in values.items())
    return f"CASE {column} {arms} ELSE {default} END"


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


DATE_SQL = """CAST(coalesce(
  CASE WHEN regexp_matches({c}, '^[0-9]+/[0-9]+/[0-9]{{4}}$') THEN try_strptime({c}, '%d/%m/%Y') END,
  try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%d.%m.%Y'), try_strptime({c}, '%d-%m-%Y'),
  CASE WHEN regexp_matches({c}, '^[0-9]+/[0-9]+/[0-9]{{4}}$') THEN try_strptime({c}, '%m/%d/%Y') END,
  try_strptime({c}, '%d/%m/%y')) AS DATE)"""
STRIP_SQL = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
TOKENS = "CASE WHEN {c} IN ('', 'None', 'nan') THEN NULL ELSE {c} END"
RAW_COLUMNS = ["load_pos", "task_id", "agent_id", "created", "minutes", "volume", "status", "complexity", "contract",
               "source_file"]


@query("parse_mixed_dates", f"SELECT load_pos, task_id, {DATE_SQL.format(c='created')} AS created FROM v_raw_tasks")
def _(t: Tables):
    return cleaning.parse_dates(t.view("v_raw_tasks").select("load_pos", "task_id", "created"), ["created"])


@query("null_tokens", "SELECT load_pos, " + ", ".join(
    f"{TOKENS.format(c=c)} AS {c}" for c in RAW_COLUMNS[1:]) + " FROM v_raw_tasks")
def _(t: Tables):
    return cleaning.null_tokens(t.view("v_raw_tasks"))


@query("drop_missing_keys", f"""
SELECT count(*) AS n_in, count(*) FILTER (WHERE t IS NULL) AS dropped_task_id,
  count(*) FILTER (WHERE t IS NOT NULL AND a IS NULL) AS dropped_agent_id,
  count(*) FILTER (WHERE t IS NOT NULL AND a IS NOT NULL) AS n_kept
FROM (SELECT {TOKENS.format(c='task_id')} AS t, {TOKENS.format(c='agent_id')} AS a FROM v_raw_tasks)""")
def _(t: Tables):
    return cleaning.missing_key_counts(cleaning.null_tokens(t.view("v_raw_tasks")), ["task_id", "agent_id"])


_ORDER = "load_pos, volume NULLS FIRST, minutes NULLS FIRST, created"


@query("dedupe_key_first", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY {_ORDER}) AS rn FROM v_tasks) WHERE rn = 1""")
def _(t: Tables):
    return cleaning.dedupe_key_first(t.view("v_tasks"), "task_id", ["load_pos", "volume", "minutes", "created"])


@query("dedupe_rows", "SELECT DISTINCT agent_id, absence_type, start_date, end_date FROM v_absences")
def _(t: Tables):
    return cleaning.dedupe_rows(t.view("v_absences").drop("absence_id"))


_MAPS = {"status": (S.STATUS_LABELS, S.STATUS_DEFAULT), "complexity": (S.COMPLEXITY_LABELS, S.COMPLEXITY_DEFAULT),
         "contract": (S.CONTRACT_LABELS, S.CONTRACT_DEFAULT)}


@query("normalise_categories", "SELECT load_pos, task_id, " + ", ".join(
    f"{_when(STRIP_SQL.format(c=c), values, _lit(default))} AS {c}" for c, (values, default) in _MAPS.items())
    + " FROM v_raw_tasks")
def _(t: Tables):
    raw = t.view("v_raw_tasks").select("load_pos", "task_id", *_MAPS)
    return cleaning.normalise_categories(raw, _MAPS)


@query("coerce_numeric", """SELECT load_pos, TRY_CAST(minutes AS DOUBLE) AS minutes, TRY_CAST(volume AS DOUBLE) AS volume
FROM v_raw_tasks""")
def _(t: Tables):
    return cleaning.coerce_numeric(t.view("v_raw_tasks").select("load_pos", "minutes", "volume"), ["minutes", "volume"])


_RANGES = {"minutes": (0, None), "volume": (None, 500)}


@query("null_out_of_range", """
SELECT task_id, load_pos, CASE WHEN minutes >= 0 THEN minutes END AS minutes, CASE WHEN volume <= 500 THEN volume END AS volume,
  (SELECT count(*) FROM v_tasks WHERE minutes < 0) AS bad_minutes, (SELECT count(*) FROM v_tasks WHERE volume > 500) AS bad_volume
FROM v_tasks""")
def _(t: Tables):
    tasks = t.view("v_tasks").select("task_id", "load_pos", "minutes", "volume")
    bad = cleaning.out_of_range_counts(tasks, _RANGES).select(F.struct("bad_minutes", "bad_volume").alias("b"))
    return cleaning.null_out_of_range(tasks, _RANGES).withColumn("b", bad.scalar()).select(
        "task_id", "load_pos", "minutes", "volume", "b.bad_minutes", "b.bad_volume")


@query("null_absence_days", """
SELECT absence_id, CASE WHEN d BETWEEN 0 AND 90 THEN d END AS days
FROM (SELECT absence_id, CAST(end_date - start_date + 1 AS INTEGER) AS d FROM v_absences)""")
def _(t: Tables):
    spans = t.view("v_absences").select(
        "absence_id", (F.datediff("end_date", "start_date") + 1).alias("days"))
    return cleaning.null_out_of_range(spans, {"days": (0, 90)})


@query("null_inconsistent_dates", """SELECT task_id, load_pos, created,
  CASE WHEN closed < created THEN NULL ELSE closed END AS closed FROM v_tasks""")
def _(t: Tables):
    return cleaning.null_inconsistent_dates(
        t.view("v_tasks").select("task_id", "load_pos", "created", "closed"), "created", "closed")


@query("clean_tasks", f"""
WITH first_rows AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY task_id ORDER BY source_file, load_pos, agent_id, created, minutes, volume, status, complexity,
      contract NULLS FIRST) AS rn FROM v_raw_tasks) WHERE rn = 1),
known AS (SELECT {", ".join(f"{TOKENS.format(c=c)} AS {c}" for c in RAW_COLUMNS[1:])}, load_pos FROM first_rows),
numbers AS (SELECT *, TRY_CAST(minutes AS DOUBLE) AS m, TRY_CAST(volume AS DOUBLE) AS v FROM known)
SELECT load_pos, task_id, agent_id, {DATE_SQL.format(c='created')} AS created, CASE WHEN m >= 0 THEN m END AS minutes,
  CASE WHEN v <= 500 THEN v END AS volume, source_file, {", ".join(
    f"{_when(STRIP_SQL.format(c=c), values, _lit(default))} AS {c}" for c, (values, default) in _MAPS.items())}
FROM numbers WHERE task_id IS NOT NULL AND agent_id IS NOT NULL""")
def _(t: Tables):
    return cleaning.clean_tasks(t.view("v_raw_tasks"))


@query("join_dim_orphans", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE a.agent_name IS NULL) AS n_orphans
FROM v_absences b LEFT JOIN v_agents a ON b.agent_id = a.agent_id""")
def _(t: Tables):
    return cleaning.orphan_counts(
        cleaning.join_dimension(t.view("v_absences"), t.view("v_agents"), "agent_id"), "agent_name")


@query("missing_profile", """
WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE closed IS NULL) AS closed,
  count(*) FILTER (WHERE minutes IS NULL) AS minutes FROM v_tasks)
SELECT column_name, n_null, round_even(n_null / n * 100, 1) AS pct_null FROM (
  SELECT 'closed' AS column_name, closed AS n_null, n FROM c UNION ALL SELECT 'minutes', minutes, n FROM c)""")
def _(t: Tables):
    return cleaning.missing_profile(t.view("v_tasks"))


@query("quality_controls", """
SELECT count(*) AS total, count(*) FILTER (WHERE volume > 500) AS volume_out_of_range,
  count(*) FILTER (WHERE minutes < 0) AS minutes_negative, count(*) FILTER (WHERE closed < created) AS dates_inconsistent,
  round(100.0 * count(*) FILTER (WHERE minutes IS NULL) / count(*), 1) AS pct_minutes_missing,
  round(100.0 * count(*) FILTER (WHERE closed IS NULL) / count(*), 1) AS pct_closed_missing
FROM v_tasks""")
def _(t: Tables):
    return cleaning.quality_controls(t.view("v_tasks"), {
        "volume_out_of_range": F.col("volume") > 500, "minutes_negative": F.col("minutes") < 0,
        "dates_inconsistent": F.col("closed") < F.col("created")}, ["minutes", "closed"])


@query("impute_mode_median", """
WITH mode_value AS (SELECT employment AS v FROM v_loans WHERE employment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT loan_id, coalesce(employment, (SELECT v FROM mode_value)) AS employment,
  r4(coalesce(loan_amount, (SELECT quantile_cont(loan_amount, 0.5) FROM v_loans))) AS loan_amount
FROM v_loans""")
def _(t: Tables):
    loans = t.view("v_loans").select("loan_id", "employment", "loan_amount")
    return rounded(cleaning.impute_mode_median(loans, ["employment"], ["loan_amount"]))


@query("parse_capped_count", """SELECT loan_id, coalesce(TRY_CAST(replace(dependents, '+', '') AS INTEGER), 0) AS dependents
FROM v_loans""")
def _(t: Tables):
    return t.view("v_loans").select("loan_id", S.capped_count("dependents").alias("dependents"))


@query("binary_encode", """
SELECT loan_id, approved, CASE area WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 0 END AS area, employment
FROM (SELECT loan_id, approved, area, CASE employment WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 0 END AS employment FROM v_loans)
WHERE employment IS NOT NULL AND area IN ('BUILDING', 'MACHINERY')""")
def _(t: Tables):
    loans = t.view("v_loans").select("loan_id", "approved", "area", "employment")
    return cleaning.binary_encode(loans, {
        "area": {"BUILDING": 1, "MACHINERY": 0}, "employment": {"1-URGENT": 1, "5-LOW": 0, "3-MEDIUM": 0}})


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]  # MACHINERY and HOUSEHOLD stay unseen
_PRIORITIES = ["1-URGENT", "2-HIGH", "5-LOW", "9-NEW"]


@query("one_hot_align", "SELECT loan_id, " + ", ".join(
    [f"""CASE WHEN area = '{v}' THEN 1 ELSE 0 END AS "area_{v}\"""" for v in _SEGMENTS]
    + [f"""CASE WHEN employment = '{v}' THEN 1 ELSE 0 END AS "emp_{v}\"""" for v in _PRIORITIES]) + " FROM v_loans")
def _(t: Tables):
    return cleaning.one_hot_align(t.view("v_loans").select("loan_id", "area", "employment"), {
        "area": ("area", _SEGMENTS), "employment": ("emp", _PRIORITIES)})


@query("label_index", """
WITH idx AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS i
  FROM (SELECT DISTINCT employment AS v FROM v_loans WHERE approved = 1 AND employment IS NOT NULL))
SELECT loan_id, coalesce(i, 0) AS employment_idx FROM v_loans LEFT JOIN idx ON employment = v""")
def _(t: Tables):
    loans = t.view("v_loans")
    seen = cleaning.category_values(loans.where("approved = 1"), "employment")
    return cleaning.label_index(loans.select("loan_id", "employment"), seen, "employment", "employment_idx").drop("employment")


@query("zscore", """
WITH s AS (SELECT avg(loan_amount) AS ma, stddev_pop(loan_amount) AS sa, avg(applicant_income) AS mi,
  stddev_pop(applicant_income) AS si FROM v_loans WHERE approved = 1)
SELECT loan_id, r4((loan_amount - ma) / sa) AS loan_amount, r4((applicant_income - mi) / si) AS applicant_income
FROM v_loans, s""")
def _(t: Tables):
    loans = t.view("v_loans")
    return rounded(cleaning.zscore(loans.select("loan_id", "loan_amount", "applicant_income"),
                                   loans.where("approved = 1"), ["loan_amount", "applicant_income"]))
