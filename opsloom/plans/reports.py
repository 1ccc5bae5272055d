"""Queries behind the reports, and the readers and sinks."""

import datetime as dt

from pyspark.sql import functions as F

from opsloom.operators import profile, reports, timeseries
from opsloom.plans import workload_sql as W
from opsloom.plans.catalogue import Tables, query, rounded
from opsloom.plans.timeseries import tie_sql
from opsloom.plans.workload import DETAIL_SQL, detail
from opsloom.operators.workload import agent_profile
from opsloom.sources import tables

BY_AGENT = """SELECT agent_id, service, count(*) AS n_tasks, CAST(sum(is_anomaly) AS BIGINT) AS n_anomalies, avg(anomaly_score::DOUBLE) AS mean_score, min(anomaly_score::DOUBLE) AS min_score
FROM v_anomalies GROUP BY 1, 2"""


def anomalies(t: Tables):
    return t.view("v_anomalies").withColumn("anomaly_score", F.col("anomaly_score").cast("double"))


@query("anomaly_by_agent", f"SELECT * REPLACE (r4(mean_score) AS mean_score, r4(min_score) AS min_score) FROM ({BY_AGENT})")
def _(t: Tables):
    return rounded(reports.anomaly_by_agent(anomalies(t)))


RATE_AGENT = f"SELECT agent_id, CAST(sum(n_tasks) AS BIGINT) AS n_tasks, CAST(sum(n_anomalies) AS BIGINT) AS n_anomalies, sum(n_anomalies) / sum(n_tasks) * 100 AS rate_pct FROM ({BY_AGENT}) GROUP BY 1"


@query("anomaly_rate_agent", f"SELECT * REPLACE (r4(rate_pct) AS rate_pct) FROM ({RATE_AGENT})")
def _(t: Tables):
    return rounded(reports.anomaly_rate_agent(reports.anomaly_by_agent(anomalies(t))))


@query("anomaly_rate_service", """SELECT service, count(*) AS n_tasks, r4(avg(is_anomaly) * 100) AS rate_pct FROM v_anomalies GROUP BY 1
UNION ALL SELECT 'ALL', count(*), r4(avg(is_anomaly) * 100) FROM v_anomalies""")
def _(t: Tables):
    return rounded(reports.anomaly_rate_service(anomalies(t)))


@query("agent_scatter", f"""WITH {W.LOADS}, detail AS ({DETAIL_SQL}), p AS (SELECT agent_id, service, contract, count(*) AS n_tasks, avg(items_per_hour) AS mean_rate FROM detail GROUP BY 1, 2, 3)
SELECT p.agent_id, p.service, p.contract, p.n_tasks, r4(mean_rate) AS mean_rate, r4(coalesce(rate_pct, 0)) AS rate_pct, r4((SELECT avg(mean_rate) FROM p)) AS reference_rate
FROM p LEFT JOIN ({RATE_AGENT}) a ON p.agent_id = a.agent_id""")
def _(t: Tables):
    rates = reports.anomaly_rate_agent(reports.anomaly_by_agent(anomalies(t)))
    return rounded(reports.agent_scatter(agent_profile(detail(t)), rates).select(
        "agent_id", "service", "contract", "n_tasks", "mean_rate", "rate_pct", "reference_rate"))


@query("worst_anomalies", """SELECT task_id, load_pos, agent_id, service, created, process, complexity, minutes, volume, anomaly_score::DOUBLE AS anomaly_score
FROM v_anomalies WHERE is_anomaly = 1 ORDER BY v_anomalies.anomaly_score, task_id, load_pos LIMIT 200""")
def _(t: Tables):
    return reports.worst_anomalies(anomalies(t))


@query("confusion_by_split", "SELECT split, " + ", ".join(
    f"count(*) FILTER (WHERE late_actual = {a} AND late_predicted = {p}) AS n_{a}{p}" for a in (0, 1) for p in (0, 1)) + """
FROM (SELECT *, CASE WHEN created <= DATE '1999-08-01' THEN 'train' WHEN created <= DATE '2000-08-01' THEN 'validation' ELSE 'test' END AS split FROM v_risk) GROUP BY 1""")
def _(t: Tables):
    split = timeseries.split_by_cutoff(t.view("v_risk"), "created", dt.date(1999, 8, 1), dt.date(2000, 8, 1))
    return profile.zero_filled_pivot(split, "split", "late_actual", "late_predicted")


@query("score_summary", """SELECT count(*) AS total, r4(avg(late_actual) * 100) AS actual_pct, r4(avg(late_predicted) * 100) AS predicted_pct, r4(avg(risk_score::DOUBLE)) AS mean_score FROM v_risk""")
def _(t: Tables):
    risk = t.view("v_risk").withColumn("risk_score", F.col("risk_score").cast("double"))
    return rounded(reports.score_summary(risk, "late_actual", "late_predicted", "risk_score"))


_CATEGORIES = ["service", "complexity", "process"]


@query("rate_by_category", " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS category, r4(avg(late_actual) * 100) AS rate_pct, count(*) AS n FROM v_risk GROUP BY 2" for c in _CATEGORIES))
def _(t: Tables):
    return rounded(profile.rate_by_category(t.view("v_risk"), _CATEGORIES, "late_actual"))


@query("riskiest_open_items", """SELECT task_id, load_pos, agent_id, service, risk_score::DOUBLE AS risk_score, CAST(DATE '2001-08-01' - created AS INTEGER) AS days_open
FROM v_risk WHERE at_risk = 1 AND service = 'PROMO' AND status = 'O' ORDER BY v_risk.risk_score DESC, task_id, load_pos LIMIT 12""")
def _(t: Tables):
    risk = t.view("v_risk").where("status = 'O'").withColumn("risk_score", F.col("risk_score").cast("double"))
    return reports.riskiest_open_items(risk, F.lit(dt.date(2001, 8, 1)), "PROMO")


_OPEN = ["task_id", "load_pos", "agent_id", "service", "contract", "process", "created", "volume"]


@query("open_items_recent", f"SELECT {', '.join(_OPEN)} FROM v_tasks_clean WHERE status = 'O' AND created >= (SELECT max(created) FROM v_tasks_clean) - 30")
def _(t: Tables):
    return reports.open_items_recent(t.view("v_tasks_clean"), _OPEN, "O")


@query("point_read", "SELECT created, minutes, closed, complexity, status FROM v_tasks_clean WHERE agent_id = 42")
def _(t: Tables):
    return reports.point_read(t.view("v_tasks_clean"), 42, ["created", "minutes", "closed", "complexity", "status"])


@query("latest_events", """SELECT id, event_date, CASE kind WHEN 'fte_incident' THEN 'Staff incident' WHEN 'announcement' THEN 'Announcement' END AS kind_label, duration_days, fte_impact, extra_volume, entered_at
FROM v_events_mgr ORDER BY entered_at DESC, id DESC LIMIT 30""")
def _(t: Tables):
    return reports.latest_events(t.view("v_events_mgr"))


# Entries as a manager types them: some dates reversed, some figures negative or missing.
_ENTRIES = """SELECT id, event_date, CASE WHEN id % 9 = 0 THEN NULL ELSE concat('S', CAST(id % 6 AS STRING)) END AS service, kind,
  CASE WHEN id % 10 = 0 THEN NULL ELSE 'planned' END AS reason, CASE WHEN id % 8 = 0 THEN -1 ELSE fte_impact END AS fte_impact, duration_days,
  CASE WHEN id % 12 = 0 THEN -5 ELSE extra_volume END AS extra_volume, CAST(event_date + INTERVAL 1 DAY * (id % 7 - 1) AS DATE) AS end_date FROM v_events_mgr"""
_STORED = ["id", "event_date", "service", "kind", "reason", "fte_impact", "duration_days", "extra_volume"]


def _log_sql(where: str) -> str:
    return f"""SELECT id, event_date, service, kind, reason, CASE WHEN kind = 'fte_incident' THEN fte_impact END AS fte_impact,
  CASE WHEN kind = 'announcement' THEN CAST(end_date - event_date + 1 AS INTEGER) ELSE duration_days END AS duration_days, CASE WHEN kind = 'announcement' THEN extra_volume END AS extra_volume
FROM ({_ENTRIES}) WHERE service IS NOT NULL AND reason IS NOT NULL AND ((kind = 'fte_incident' AND fte_impact >= 0 AND duration_days > 0)
  OR (kind = 'announcement' AND end_date >= event_date AND extra_volume >= 0)) AND {where}"""


def _log(t: Tables):
    entries = t.sql(_ENTRIES)
    old = reports.valid_events(entries.where("event_date < DATE '1999-01-01'"))
    return reports.event_append(old, entries.where("event_date >= DATE '1999-01-01'"))


@query("event_append", f"SELECT {', '.join(_STORED)} FROM ({_log_sql('true')})")
def _(t: Tables):
    return _log(t).select(*_STORED)


def _removed(t: Tables):
    return t.raw("events").where("value < 3").select(F.col("event_id").alias("id"))


@query("event_remove", f"SELECT {', '.join(_STORED)} FROM ({_log_sql('id NOT IN (SELECT event_id FROM events WHERE value < 3)')})")
def _(t: Tables):
    return reports.event_remove(_log(t), _removed(t)).select(*_STORED)


@query("id_difference", f"SELECT id FROM ({_log_sql('id IN (SELECT event_id FROM events WHERE value < 3)')})")
def _(t: Tables):
    log = _log(t)
    return reports.id_difference(log, reports.event_remove(log, _removed(t)), "id")


_LAYERS = ["lineitem", "orders", "customer", "events", "documents"]


@query("table_inventory", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows, 0 AS missing FROM {n}" for n in _LAYERS)
       + " UNION ALL SELECT 'forecasts', NULL, 1")
def _(t: Tables):
    return reports.table_inventory({**{n: t.raw(n) for n in _LAYERS}, "forecasts": None})


@query("sample_rows", f"SELECT event_id, user_id, event_type, value FROM events ORDER BY {tie_sql('42', 'event_id')} LIMIT 3000")
def _(t: Tables):
    return reports.sample_rows(t.raw("events"), ["event_id"], 3000).select("event_id", "user_id", "event_type", "value")


_CLASSES = "SELECT DISTINCT label AS idx, concat('class ', CAST(label AS STRING)) AS class_name FROM embeddings"


@query("topk_classes", """WITH s AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(64)) AS idx FROM embeddings),
r AS (SELECT vec_id, CAST(idx AS INTEGER) AS idx, exp(x::DOUBLE) / sum(exp(x::DOUBLE)) OVER (PARTITION BY vec_id) AS score, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, idx DESC) AS rank FROM s)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, idx, r6(score) AS score, CASE WHEN idx IN (SELECT label FROM embeddings) THEN concat('class ', CAST(idx AS VARCHAR)) ELSE 'unknown class' END AS class_name
FROM r WHERE rank <= 3""")
def _(t: Tables):
    scores = t.raw("embeddings").select("vec_id", reports.softmax("embedding").alias("scores"))
    return rounded(reports.topk_classes(scores, "vec_id", "scores", t.sql(_CLASSES), "unknown class"), 6)


_BANDS = "SELECT doc_id, (n_chars % 101) * 1.0 AS pct, CASE WHEN quality = 1 THEN 'healthy' ELSE 'diseased' END AS status, severity FROM (SELECT d.doc_id, n_chars, quality, CASE WHEN toxic = 1 THEN 'Critique' WHEN n_chars % 2 = 0 THEN 'Élevée' ELSE 'Modérée' END AS severity FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


@query("confidence_band", f"""SELECT doc_id, CASE WHEN pct >= 80 THEN 'reliable' WHEN pct >= 50 THEN 'probable' ELSE 'unrecognised' END AS band,
  CASE WHEN status = 'healthy' THEN 'healthy' WHEN severity = 'Critique' THEN 'critical' WHEN severity = 'Élevée' THEN 'high' ELSE 'moderate' END AS level FROM ({_BANDS})""")
def _(t: Tables):
    return reports.confidence_band(t.sql(_BANDS), "pct", "status", "severity").select("doc_id", "band", "level")


# Sources and sinks.


@query("scan_table", "SELECT * FROM orders")
def _(t: Tables):
    return tables.scan_table(t.spark, f"{t.directory}/orders.parquet")


_SECOND = {"ID": "event_id", "Agent": "user_id", "TYPE": "event_type", "Valeur": "value"}


def _extracts(t: Tables):
    events = t.raw("events").select(*[F.col(c).cast("string") for c in ("event_id", "user_id", "event_type")])
    first = events.where("event_id % 2 = 0").withColumn("source_file", F.lit("first"))
    second = events.where("event_id % 2 = 1").select(
        F.col("event_id").alias("ID"), F.col("user_id").alias("Agent"), F.col("event_type").alias("TYPE"))
    blank = second.where("ID % 5 = 0").select(*[F.lit(None).cast("string").alias(c) for c in second.columns])
    return first, tables.conform_headers(second.union(blank), _SECOND).withColumn("source_file", F.lit("second"))


_UNION = "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, CASE WHEN event_id % 2 = 0 THEN 'first' ELSE 'second' END AS source_file FROM events"


@query("conform_headers", f"SELECT * FROM ({_UNION}) WHERE source_file = 'second'")
def _(t: Tables):
    return _extracts(t)[1]


@query("union_years", _UNION)
def _(t: Tables):
    return tables.union_years(*_extracts(t))


@query("read_raw_csv", "SELECT CAST(item_id AS VARCHAR) AS item_id, text AS raw_text, 'items.csv' AS source_file FROM benchmark")
def _(t: Tables):
    path = tables.work_folder(t.spark, "csv")
    t.raw("benchmark").select(F.col("item_id").cast("string").alias("Item ID"), F.col("text").alias("Raw Text")).write.csv(
        path, header=True, escape='"')
    return tables.read_raw_csv(t.spark, path, ["Item ID", "Raw Text"], "items.csv")


@query("read_raw_json", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CASE WHEN user_id % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id FROM events")
def _(t: Tables):
    path = tables.work_folder(t.spark, "json")
    records = t.raw("events").select("event_id", "event_type", F.when(F.col("user_id") % 7 == 0, "nan").otherwise(
        F.col("user_id").cast("string")).alias("user_id"))
    # Files that each hold one array of up to a few thousand records.
    files = records.groupBy((F.col("event_id") / 4096).cast("bigint").alias("f")).agg(
        F.to_json(F.collect_list(F.struct("event_id", "event_type", "user_id"))).alias("value"))
    files.select("value").repartition("value").write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_raw_json(t.spark, path, ["event_id", "event_type", "user_id"], whole_files=True)


@query("overwrite_sink", "SELECT event_id, event_type, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN 0.0::DOUBLE ELSE value END AS value, CAST(ts AS DATE) AS day FROM events")
def _(t: Tables):
    path = tables.work_folder(t.spark, "events")
    rows = t.raw("events").select("event_id", "event_type", "value", F.to_date("ts").alias("day"))
    tables.overwrite_sink(rows, path, "day")
    again = rows.where("day = DATE '2024-01-05'").withColumn("value", F.lit(0.0))
    tables.overwrite_sink(again, path, "day")  # replaces that day only
    return tables.scan_table(t.spark, path)


@query("truncate_append_sink", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(t: Tables):
    name = f"orders_{tables.work_folder(t.spark, 'x').rsplit('-', 1)[1]}"
    path = tables.work_folder(t.spark, "orders")
    t.raw("orders").select("o_orderkey", "o_orderstatus").write.option("path", path).saveAsTable(name)
    tables.truncate_append_sink(t.raw("orders").where("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey"), name)
    return t.spark.table(name)


@query("catalogue_to_docs", """SELECT p_partkey, concat('Product: ', coalesce(p_name, ''), ' | Category: ', coalesce(t, ''), ' | Brand: ', coalesce(p_brand, ''), ' | Size: ', CAST(p_size AS VARCHAR)) AS content
FROM (SELECT *, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS t FROM part)""")
def _(t: Tables):
    parts = t.raw("part").withColumn("p_type", F.when(F.col("p_size") % 5 != 0, F.col("p_type")))
    return tables.catalogue_to_docs(parts, {
        "Product": "p_name", "Category": "p_type", "Brand": "p_brand", "Size": "p_size"}).select("p_partkey", "content")


_PAGE = "html"
for _block in (r"(?is)<!--.*?-->", r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<[^>]*>"):
    _PAGE = f"regexp_replace({_PAGE}, '{_block}', ' ', 'g')"
for _entity, _char in tables.ENTITIES.items():
    _shown = _char.replace("'", "''")
    _PAGE = f"replace({_PAGE}, '{_entity}', '{_shown}')"


@query("extract_page_text", rf"SELECT page_id, url, trim(regexp_replace({_PAGE}, '\s+', ' ', 'g')) AS text FROM pages")
def _(t: Tables):
    return tables.extract_page_text(t.raw("pages"))
