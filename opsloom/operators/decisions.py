"""Staffing decisions: projected FTE and load, reallocation, sustained overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.functions import scalars as S
from opsloom.functions.reuse import shared
from opsloom.operators.ordering import exact_percentiles
from opsloom.operators.profile import share_of_total

DEFAULT_ABSENCE = 0.1
MAX_ABSENCE = 0.9


def roster_at_date(dates: DataFrame, roster: DataFrame) -> DataFrame:
    """Agents under contract on each target date.

    Target dates are few (a forecast horizon), so they travel as one array beside each agent
    and are filtered there; no join compares every date with every agent.
    """
    span = dates.agg(F.collect_set("day").alias("days"))
    active = F.filter("_days", lambda d: (F.col("entered") <= d)
                      & (F.col("contract_end").isNull() | (F.col("contract_end") >= d)))
    return roster.where(F.col("entered").isNotNull()).withColumn("_days", span.scalar()).withColumn(
        "day", F.explode(active)).drop("_days")


def absent_at_date(dates: DataFrame, absences: DataFrame) -> DataFrame:
    """Distinct (day, agent) with an absence that covers the target date."""
    span = dates.agg(F.collect_set("day").alias("days"))
    covered = F.filter("_days", lambda d: (F.col("start_date") <= d) & (F.col("end_date") >= d))
    return absences.withColumn("_days", span.scalar()).select(
        F.explode(covered).alias("day"), "agent_id").distinct()


def absence_rate_contract(roster: DataFrame, absences: DataFrame, until) -> DataFrame:
    """Absence days over contract days per contract; .1 when unknown, kept in 0 to .9."""
    end = F.least(F.coalesce("contract_end", F.lit(until)), F.lit(until))
    active = roster.where(F.col("entered").isNotNull()).groupBy("contract").agg(
        F.sum(F.greatest(F.datediff(end, "entered"), F.lit(0)) + 1).alias("active_days"))
    absent = absences.groupBy("contract").agg(F.sum("days").alias("absence_days"))
    rate = F.coalesce(F.col("absence_days") / F.col("active_days"), F.lit(DEFAULT_ABSENCE))
    return absent.join(active, "contract", "full").select(
        "contract", F.least(F.greatest(rate, F.lit(0.0)), F.lit(MAX_ABSENCE)).alias("absence_rate"))


def fte_projection(dates: DataFrame, roster: DataFrame, absences: DataFrame, rates: DataFrame) -> DataFrame:
    """FTE per target date and service, and in total (service ALL).

    Dates up to the last known leave use the real leave; later ones the rate of the contract.
    """
    known_until = absences.agg(F.max("end_date"))
    present = (
        roster_at_date(dates, roster)
        .join(absent_at_date(dates, absences).withColumn("_absent", F.lit(1)), ["day", "agent_id"], "left")
        .join(rates, "contract", "left")
        .withColumn("covered", F.col("day") <= known_until.scalar())
        .withColumn("_share", F.when(F.col("covered"), 1 - F.coalesce("_absent", F.lit(0)))
                    .otherwise(1 - F.coalesce("absence_rate", F.lit(DEFAULT_ABSENCE))))
        .withColumn("_fte", S.worktime_coeff("worktime") * F.col("_share"))
    )
    by_service = shared(present.groupBy("day", "service").agg(
        F.sum(F.col("_fte").cast("decimal(24,12)")).alias("fte"), F.max("covered").alias("covered")))
    total = by_service.groupBy("day").agg(F.sum("fte").alias("fte"), F.max("covered").alias("covered"))
    return (by_service.where(F.col("service").isNotNull()).unionByName(total.withColumn("service", F.lit("ALL")))
            .withColumn("fte", F.col("fte").cast("double")).withColumn("covered", S.flag(F.col("covered"))))


def load_projection(forecast: DataFrame, daily: DataFrame, fte: DataFrame) -> DataFrame:
    """Forecast volume of a day split by historic share, over the FTE of the service."""
    shares = share_of_total(daily, "service", "volume")
    staffed = fte.where((F.col("service") != "ALL") & (F.col("fte") > 0))
    return (staffed.join(forecast.select("day", "horizon", "volume"), "day").join(shares, "service", "left")
            .withColumn("share", F.coalesce("share", F.lit(0.0)))
            .select("day", "horizon", "service", "fte", "share",
                    (F.col("volume") * F.col("share") / F.col("fte")).alias("load")))


def balanced_reallocation(projected: DataFrame) -> DataFrame:
    """FTE that would give every service the same load; the changes of a day add up to zero."""
    mean = projected.groupBy("day").agg(
        (F.sum(F.col("load") * F.col("fte")) / F.sum("fte")).alias("mean_load"))
    out = projected.join(mean, "day").withColumn("suggested_fte", F.when(
        F.col("mean_load") != 0, F.col("fte") * F.col("load") / F.col("mean_load")).otherwise(F.col("fte")))
    return out.withColumn("delta_fte", F.col("suggested_fte") - F.col("fte"))


def balance_kpis(reallocation: DataFrame) -> DataFrame:
    """Gap between the most and least loaded service and the FTE to move, per day."""
    out = reallocation.groupBy("day").agg(
        F.max("load").alias("max_load"), F.min("load").alias("min_load"),
        F.min(F.struct((-F.col("load")).alias("l"), "service")).getField("service").alias("most_loaded"),
        F.min(F.struct("load", "service")).getField("service").alias("least_loaded"),
        F.sum(F.greatest("delta_fte", F.lit(0.0))).alias("fte_to_move"))
    return out.withColumn("gap_pct", F.when(F.col("min_load") > 0, (F.col("max_load") / F.col("min_load") - 1) * 100))


def service_p75(daily: DataFrame) -> DataFrame:
    """P75 of the daily load per service, over days."""
    return exact_percentiles(daily, "load", {"p75": 0.75}, by=["service"])


def sustained_overload(projected: DataFrame, thresholds: DataFrame, start: int = 1, span: int = 14) -> DataFrame:
    """Services whose mean projected load over the window is above their P75."""
    window = projected.where(F.col("horizon").between(start, start + span - 1))
    mean = window.groupBy("service").agg(F.avg("load").alias("mean_load"), F.min("day").alias("first_day"),
                                         F.max("day").alias("last_day"))
    return mean.join(thresholds, "service").where(F.col("mean_load") > F.col("p75"))


def overload_alerts(projected: DataFrame, thresholds: DataFrame, streaks: DataFrame, horizon: int) -> DataFrame:
    """Services above their P75 on one day, with the running alert only for the next day."""
    hit = projected.where(F.col("horizon") == horizon).join(thresholds, "service").where(F.col("load") > F.col("p75"))
    note = (F.when(F.lit(horizon != 1), "single risk at this horizon")
            .when(F.col("streak") > 0, F.concat(F.col("streak").cast("string"), F.lit(" days so far, forecast to continue")))
            .otherwise("new risk"))
    return hit.join(streaks, "service", "left").select("service", "load", "p75", note.alias("note")).orderBy(
        F.desc("load"), "service")


def service_forecast_table(forecast: DataFrame, daily: DataFrame, days: int = 7) -> DataFrame:
    """Low, central and high forecast per service for the next days, and the total itself."""
    shares = share_of_total(daily, "service", "volume")
    packed = shares.agg(F.collect_list(F.struct("service", "share")).alias("s"))  # one entry per service
    rows = forecast.where(F.col("horizon") <= days).withColumn("_s", packed.scalar())
    everyone = F.array(F.struct(F.lit("ALL").alias("service"), F.lit(1.0).alias("share")))
    return rows.withColumn("p", F.explode(F.concat(everyone, F.col("_s")))).select(
        "day", "horizon", "p.service", *[(F.col(c) * F.col("p.share")).alias(c)
                                         for c in ("volume_low", "volume", "volume_high")])


def event_adjusted_forecast(forecast: DataFrame, impact: DataFrame, fte: DataFrame) -> DataFrame:
    """Forecast plus announced volume; FTE less the lost FTE, at least .1 when any is lost."""
    total = fte.where(F.col("service") == "ALL").select("day", "fte")
    lost = F.col("fte_lost") != 0
    return forecast.join(impact, "day").join(total, "day", "left").select(
        "day", "horizon", "volume", (F.col("volume") + F.col("announced_volume")).alias("volume_adjusted"), "fte",
        F.when(lost, F.greatest(F.col("fte") - F.col("fte_lost"), F.lit(0.1))).otherwise(F.col("fte")).alias("fte_adjusted"))
