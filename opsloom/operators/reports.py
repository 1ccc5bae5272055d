"""Tables behind the reports: anomalies, risk, manager events, inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.functions import scalars as S
from opsloom.operators.ordering import tie_key

KIND_LABELS = {"fte_incident": "Staff incident", "announcement": "Announcement"}


def anomaly_by_agent(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("agent_id", "service").agg(
        F.count(F.lit(1)).alias("n_tasks"), F.sum("is_anomaly").alias("n_anomalies"),
        F.avg("anomaly_score").alias("mean_score"), F.min("anomaly_score").alias("min_score"))


def anomaly_rate_agent(by_agent: DataFrame) -> DataFrame:
    return by_agent.groupBy("agent_id").agg(
        F.sum("n_tasks").alias("n_tasks"), F.sum("n_anomalies").alias("n_anomalies")).withColumn(
        "rate_pct", F.col("n_anomalies") / F.col("n_tasks") * 100)


def anomaly_rate_service(anomalies: DataFrame) -> DataFrame:
    """Flagged percentage per service and over all (service ALL)."""
    by_service = anomalies.groupBy("service").agg(F.sum("is_anomaly").alias("_a"), F.count(F.lit(1)).alias("n_tasks"))
    total = by_service.agg(F.lit("ALL").alias("service"), F.sum("_a").alias("_a"), F.sum("n_tasks").alias("n_tasks"))
    return by_service.unionByName(total).select(
        "service", "n_tasks", (F.col("_a") / F.col("n_tasks") * 100).alias("rate_pct"))


def agent_scatter(profile: DataFrame, rates: DataFrame) -> DataFrame:
    """Agent profile with its anomaly rate (0 when unknown) and the mean rate of all profile rows as reference."""
    mean = profile.agg(F.avg("mean_rate"))
    return profile.join(rates.select("agent_id", "rate_pct"), "agent_id", "left").fillna(0.0, ["rate_pct"]).withColumn(
        "reference_rate", mean.scalar())


def worst_anomalies(anomalies: DataFrame, k: int = 200) -> DataFrame:
    return anomalies.where(F.col("is_anomaly") == 1).select(
        "task_id", "load_pos", "agent_id", "service", "created", "process", "complexity", "minutes", "volume",
        "anomaly_score").orderBy("anomaly_score", "task_id", "load_pos").limit(k)


def riskiest_open_items(items: DataFrame, today, service: str | None = None, k: int = 12) -> DataFrame:
    """Flagged items of highest risk with the days they have been open."""
    at_risk = items.where(F.col("at_risk") == 1)
    if service is not None:
        at_risk = at_risk.where(F.col("service") == service)
    return at_risk.select("task_id", "load_pos", "agent_id", "service", "risk_score",
                          F.datediff(today, "created").alias("days_open")).orderBy(
        F.desc("risk_score"), "task_id", "load_pos").limit(k)


def open_items_recent(items: DataFrame, columns: Sequence[str], status: str, days: int = 30) -> DataFrame:
    """Open items created within some days of the latest date."""
    latest = items.agg(F.max("created"))
    return items.where((F.col("status") == status) & (F.col("created") >= F.date_sub(latest.scalar(), days))).select(*columns)


def point_read(items: DataFrame, agent_id, columns: Sequence[str]) -> DataFrame:
    """One agent's rows; the filter and the columns reach the scan."""
    return items.where(F.col("agent_id") == agent_id).select(*columns).orderBy("created")


def latest_events(events: DataFrame, k: int = 30) -> DataFrame:
    return events.select(
        "id", "event_date", S.mapped("kind", KIND_LABELS).alias("kind_label"), "duration_days", "fte_impact",
        "extra_volume", "entered_at").orderBy(F.desc("entered_at"), F.desc("id")).limit(k)


def valid_events(new: DataFrame) -> DataFrame:
    """Manager entries that may be stored, with the end date turned into a duration.

    An incident needs date, service, reason, lost FTE >= 0 and duration > 0; an announcement
    needs both dates in order, service, reason and extra volume >= 0.
    """
    named = F.col("event_date").isNotNull() & F.col("service").isNotNull() & F.col("reason").isNotNull()
    incident = (F.col("kind") == "fte_incident") & named & (F.col("fte_impact") >= 0) & (F.col("duration_days") > 0)
    announcement = ((F.col("kind") == "announcement") & named & (F.col("end_date") >= F.col("event_date"))
                    & (F.col("extra_volume") >= 0))
    span = F.datediff("end_date", "event_date") + 1
    return new.where(F.coalesce(incident | announcement, F.lit(False))).select(
        "id", "event_date", "service", "kind", "reason",
        F.when(F.col("kind") == "fte_incident", F.col("fte_impact")).alias("fte_impact"),
        F.when(F.col("kind") == "announcement", span).otherwise(F.col("duration_days")).alias("duration_days"),
        F.when(F.col("kind") == "announcement", F.col("extra_volume")).alias("extra_volume"))


def event_append(log: DataFrame, new: DataFrame) -> DataFrame:
    return log.unionByName(valid_events(new))


def event_remove(log: DataFrame, ids: DataFrame) -> DataFrame:
    return log.join(ids.select("id"), "id", "left_anti")


def id_difference(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Ids gone from one snapshot to the next."""
    return before.select(key).join(after.select(key), key, "left_anti")


def table_inventory(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per table; a table that does not exist yet has no count and is marked missing."""
    spark = next(df for df in tables.values() if df is not None).sparkSession
    out = None
    for name, df in tables.items():
        if df is None:
            row = spark.range(1).select(F.lit(name).alias("table_name"), F.lit(None).cast("bigint").alias("n_rows"),
                                        F.lit(1).alias("missing"))
        else:
            row = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.lit(0).alias("missing"))
        out = row if out is None else out.unionByName(row)
    return out


def score_summary(scored: DataFrame, actual: str, predicted: str, score: str) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("total"), (F.avg(actual) * 100).alias("actual_pct"),
                      (F.avg(predicted) * 100).alias("predicted_pct"), F.avg(score).alias("mean_score"))


def sample_rows(df: DataFrame, ids: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Seeded sample of n rows: the n lowest hashes, kept per task, so nothing is sorted whole."""
    key = tie_key(F.lit(seed), *ids)
    return df.withColumn("_k", key).orderBy("_k").limit(n).drop("_k")


def topk_classes(scores: DataFrame, ids: str, vector: str, classes: DataFrame, default: str, k: int = 3) -> DataFrame:
    """The k best entries of a score array per row with the class name, or a default.

    The array is sorted inside its own row; no shuffle is needed. Ties prefer the higher index.
    """
    pairs = F.transform(F.col(vector), lambda x, i: F.struct(x.cast("double").alias("score"), i.alias("idx")))
    top = F.slice(F.reverse(F.array_sort(pairs)), 1, k)
    rows = scores.select(ids, F.posexplode(top).alias("rank", "e")).select(
        ids, (F.col("rank") + 1).alias("rank"), "e.idx", "e.score")
    return rows.join(classes, "idx", "left").select(
        ids, "rank", "idx", "score", F.coalesce("class_name", F.lit(default)).alias("class_name"))


def softmax(c: str):
    """Positive shares that sum to one."""
    raised = F.transform(F.col(c), lambda x: F.exp(x.cast("double")))
    total = F.aggregate(raised, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(raised, lambda x: x / total)


def confidence_band(df: DataFrame, percent: str, status: str, severity: str) -> DataFrame:
    """Reliable from 80, probable from 50, otherwise unrecognised; and the display class."""
    band = F.when(F.col(percent) >= 80, "reliable").when(F.col(percent) >= 50, "probable").otherwise("unrecognised")
    level = (F.when(F.col(status) == "healthy", "healthy").when(F.col(severity) == "Critique", "critical")
             .when(F.col(severity) == "Élevée", "high").otherwise("moderate"))
    return df.withColumns({"band": band, "level": level})
