"""Task, agent and day features of a back office."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.functions import scalars as S
from opsloom.functions.reuse import shared
from opsloom.operators.ordering import exact_percentiles, running_totals

MAX_ABSENCE_DAYS = 90
ALERT_SHARE = 0.75
MOST_SENT_DAYS = 500_000  # rows (day, service) that are sent to every task, about 120 bytes each


def duration_features(tasks: DataFrame) -> DataFrame:
    """Day differences; implausible ones are unknown."""
    return tasks.withColumns({
        "pickup_days": S.keep_between(F.datediff("taken", "created"), 0, 60),
        "handling_days": S.keep_between(F.datediff("closed", "taken"), 1, 90),
        "total_days": S.keep_between(F.datediff("closed", "created"), 1),
    })


def calendar_columns(day: str | Column) -> dict[str, Column]:
    """Calendar facts of a date; weekday 0 is Monday."""
    d = S.column(day)
    return {
        "weekday": F.weekday(d), "day_name": F.date_format(d, "EEEE"), "month": F.month(d),
        "quarter": F.quarter(d), "iso_week": F.weekofyear(d), "year": F.year(d),
        "week_of_month": F.floor((F.day(d) - 1) / 7).cast("int") + 1,
        "is_month_end": S.flag(F.day(d) >= 25), "is_month_start": S.flag(F.day(d) <= 5),
        "is_monday": S.flag(F.weekday(d) == 0), "is_friday": S.flag(F.weekday(d) == 4),
        "is_quarter_end": S.flag(F.month(d).isin(3, 6, 9, 12)), "is_august": S.flag(F.month(d) == 8),
    }


def calendar_features(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns(calendar_columns(day))


def productivity(tasks: DataFrame) -> DataFrame:
    return tasks.withColumn("items_per_hour", S.productivity("volume", "minutes"))


def declared_vs_actual(tasks: DataFrame) -> DataFrame:
    """Declared minutes less the handling days at eight hours."""
    return duration_features(tasks).withColumn("minutes_gap", F.col("minutes") - F.col("handling_days") * 480)


def ordinal_coefficients(tasks: DataFrame) -> DataFrame:
    return tasks.withColumns({
        "complexity_rank": S.mapped("complexity", S.COMPLEXITY_RANKS, S.COMPLEXITY_RANK_DEFAULT),
        "contract_productivity": S.mapped("contract", S.CONTRACT_PRODUCTIVITY, S.CONTRACT_PRODUCTIVITY_DEFAULT),
    })


def cyclic_encode(df: DataFrame) -> DataFrame:
    weekday_sin, weekday_cos = S.cyclic("weekday", 7)
    month_sin, month_cos = S.cyclic("month", 12)
    return df.withColumns({"weekday_sin": weekday_sin, "weekday_cos": weekday_cos,
                           "month_sin": month_sin, "month_cos": month_cos})


def tenure_and_contract(tasks: DataFrame, agents: DataFrame) -> DataFrame:
    """Tenure, contract state and working share of the agent on the day of the task."""
    dim = agents.select("agent_id", "worktime", "entered", "contract_end")
    return tasks.join(dim, "agent_id", "left").withColumns({
        "tenure_months": S.tenure_months("entered", "created"),
        "contract_active": S.contract_active("contract_end", "created"),
        "worktime_share": S.worktime_coeff("worktime"),
    })


def backjoin(detail: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """Attach group statistics to the detail rows.

    A window over the key would send a hot group to one task. The statistics are merged on the
    map side first; the join back is broadcast by Spark while they are small and otherwise a
    sort-merge join whose hot partitions adaptive execution splits.
    """
    merged = detail.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*[c.alias(n) for n, c in stats.items()])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])  # null is a group too
    return detail.join(merged, same, "left").drop(*[f"_{k}" for k in keys])


def backjoin_aggregate(tasks: DataFrame) -> DataFrame:
    """Tasks per agent-day, mean rate per agent, mean minutes per service and the ratio to it."""
    out = backjoin(productivity(tasks), ["agent_id", "created"], agent_day_tasks=F.count(F.lit(1)))
    out = backjoin(out, ["agent_id"], agent_mean_rate=F.avg("items_per_hour"))
    out = backjoin(out, ["service"], service_mean_minutes=F.avg("minutes"))
    return out.withColumn("minutes_ratio", F.when(
        F.col("service_mean_minutes") > 0, F.col("minutes") / F.col("service_mean_minutes")))


def absence_days(absences: DataFrame) -> DataFrame:
    """Distinct (agent, day) of every absence of 1 to 90 days; reversed ones are dropped.

    The 90-day rule bounds the expansion of a row.
    """
    valid = absences.where(
        F.col("agent_id").isNotNull() & (F.col("end_date") >= F.col("start_date"))
        & (F.datediff("end_date", "start_date") + 1 <= MAX_ABSENCE_DAYS))
    return valid.select("agent_id", F.explode(F.sequence("start_date", "end_date")).alias("day")).distinct()


def agent_days(tasks: DataFrame, agents: DataFrame, absences: DataFrame) -> DataFrame:
    """One row per agent and day: tasks, service of the first task, absence and FTE."""
    first = F.min(F.struct("task_id", "load_pos", "volume", "minutes", "service"))
    days = tasks.groupBy("agent_id", F.col("created").alias("day")).agg(
        F.count(F.lit(1)).alias("agent_day_tasks"), first.alias("_f"))
    dim = agents.select("agent_id", "worktime", "entered", "contract_end")
    absent = absence_days(absences).withColumn("absent", F.lit(1))
    return shared(
        days.select("agent_id", "day", "agent_day_tasks", F.col("_f.service").alias("service"))
        .join(absent, ["agent_id", "day"], "left").join(dim, "agent_id", "left")  # the first join finds its rows dealt already
        .withColumn("absent", F.coalesce("absent", F.lit(0)))
        .withColumn("fte", S.worktime_coeff("worktime") * S.contract_active("contract_end", "day")
                    * (1 - F.col("absent")))
    )


def exact_sum(c: str) -> Column:
    """Sum of shares with six decimals; the order in which rows arrive cannot change it."""
    return F.sum(F.col(c).cast("decimal(18,6)")).cast("double")


def fte_per_day(days: DataFrame) -> DataFrame:
    return days.groupBy("day").agg(exact_sum("fte").alias("fte"))


def fte_per_day_service(days: DataFrame) -> DataFrame:
    return days.groupBy("day", "service").agg(exact_sum("fte").alias("fte"))


def with_load(volumes: DataFrame, fte: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Volume per FTE; unknown without FTE. Both sides have one row per day (and service)."""
    return volumes.join(fte, list(keys), "left").withColumn(
        "load", F.when(F.col("fte") > 0, F.col("volume") / F.col("fte")))


def day_cells(tasks: DataFrame) -> DataFrame:
    """Counts and sums per day, service and handling time, from one pass over the tasks.

    Handling time has at most 91 values, so the table stays within days x services x 91 rows;
    every daily figure is rolled up from it.
    """
    rows = ordinal_coefficients(duration_features(tasks))
    return shared(rows.groupBy(F.col("created").alias("day"), "service", "handling_days").agg(
        F.count(F.lit(1)).alias("n_tasks"), F.sum("volume").alias("volume"), F.sum("minutes").alias("minutes"),
        F.count("minutes").alias("n_minutes"), F.sum("complexity_rank").alias("ranks")))


def volume_per_day_service(tasks: DataFrame) -> DataFrame:
    return day_cells(tasks).groupBy("day", "service").agg(
        F.sum("n_tasks").alias("n_tasks"), F.coalesce(F.sum("volume"), F.lit(0)).alias("volume"))


def load_per_day(tasks: DataFrame, days: DataFrame) -> DataFrame:
    volumes = volume_per_day_service(tasks).groupBy("day").agg(
        F.sum("n_tasks").alias("n_tasks"), F.sum("volume").alias("volume"))
    return with_load(volumes, fte_per_day(days), ["day"])


def load_per_day_service(tasks: DataFrame, days: DataFrame) -> DataFrame:
    return with_load(volume_per_day_service(tasks), fte_per_day_service(days), ["day", "service"])


def overload_alert(load: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """P75 of the load over task rows (each day weighs its tasks) and the strict excess flag."""
    threshold = exact_percentiles(load, "load", {"threshold": ALERT_SHARE}, by=by, weight="n_tasks")
    joined = (load.join(threshold, list(by), "left") if by
              else load.withColumn("threshold", threshold.scalar()))
    return joined.withColumn("alert", S.flag(F.col("load") > F.col("threshold")))


def _daily(tasks: DataFrame, load: DataFrame, keys: Sequence[str]) -> DataFrame:
    cells = day_cells(tasks)
    means = cells.groupBy(*keys).agg(
        F.try_divide(F.sum("minutes"), F.sum("n_minutes").cast("double")).alias("mean_minutes"),
        (F.sum("ranks") / F.sum("n_tasks")).alias("mean_complexity"))
    median = exact_percentiles(cells, "handling_days", {"median_handling_days": 0.5}, by=keys, weight="n_tasks")
    calendar = {k: v for k, v in calendar_columns("day").items() if k in (
        "weekday", "month", "quarter", "is_month_end", "is_quarter_end", "is_monday", "is_friday",
        "week_of_month")}
    out = load.join(means, list(keys), "left").join(median, list(keys), "left").withColumns(calendar)
    return out.select(
        *keys, "n_tasks", "volume", "fte", "load", "alert", "mean_minutes", "median_handling_days",
        "mean_complexity", *calendar)


def daily_global(tasks: DataFrame, days: DataFrame) -> DataFrame:
    """Sixteen figures per day."""
    return _daily(tasks, overload_alert(load_per_day(tasks, days)), ["day"])


def daily_service(tasks: DataFrame, days: DataFrame) -> DataFrame:
    """The same figures per day and service."""
    return _daily(tasks, overload_alert(load_per_day_service(tasks, days), ["service"]), ["day", "service"])


def feature_detail(tasks: DataFrame, agents: DataFrame, absences: DataFrame) -> DataFrame:
    """The wide feature table, one row per task.

    The figures per day and service do not grow with the tasks: up to MOST_SENT_DAYS rows go to the tasks, so that the wide
    rows are not dealt a second time; above that they are joined by size.
    """
    days = agent_days(tasks, agents, absences)
    service_load = shared(overload_alert(load_per_day_service(tasks, days), ["service"]).select(
        F.col("day").alias("created"), "service", F.col("fte").alias("service_fte"),
        F.col("load").alias("service_load"), F.col("alert").alias("service_alert")))
    if service_load.count() <= MOST_SENT_DAYS:
        service_load = F.broadcast(service_load)
    day_load = overload_alert(load_per_day(tasks, days)).select(
        F.col("day").alias("created"), F.col("fte").alias("day_fte"), F.col("load").alias("day_load"),
        F.col("alert").alias("day_alert"))
    per_agent_day = days.select(
        "agent_id", F.col("day").alias("created"), "agent_day_tasks", "absent", "entered",
        F.col("fte").alias("agent_day_fte"))
    rows = ordinal_coefficients(productivity(duration_features(tasks)))
    return (
        rows.join(per_agent_day, ["agent_id", "created"], "left")
        .join(service_load, ["created", "service"], "left").join(day_load, "created", "left")
        .withColumn("tenure_months", S.tenure_months("entered", "created"))
        .withColumn("minutes_gap", F.col("minutes") - F.col("handling_days") * 480)
        .withColumns(calendar_columns("created"))
    )


def active_events_per_day(days: DataFrame, events: DataFrame, day: str = "day") -> DataFrame:
    """FTE lost and volume announced on each day by the events that cover it; zero without any.

    A sweep line: an event adds its impact on its first day and takes it back on the day after its last, so it costs two
    rows however long it lasts. The changes are summed per day in decimals (nothing is left over when an event
    ends) and added up in the order of days; the interval test becomes an equality join with one row per day.
    """
    exact = "decimal(38,12)"
    lost = F.when(F.col("kind") == "fte_incident", F.col("fte_impact")).cast(exact)
    announced = F.when(F.col("kind") == "announcement", F.col("extra_volume")).cast(exact)

    def change(at: Column, sign: int) -> Column:
        return F.struct(at.alias("_day"), (lost * sign).cast(exact).alias("_lost"), (announced * sign).cast(exact).alias("_announced"))

    after = F.date_add(S.event_end("event_date", "duration_days"), 1)
    changes = events.where("event_date IS NOT NULL").select(F.explode(F.array(change(F.col("event_date"), 1), change(after, -1))).alias("c")).select("c.*")
    nothing = F.lit(0).cast(exact)
    asked = days.select(F.col(day).alias("_day"), nothing.alias("_lost"), nothing.alias("_announced")).where("_day IS NOT NULL").distinct()
    per_day = changes.unionByName(asked).groupBy(F.unix_date("_day").alias("_at")).agg(
        *[F.coalesce(F.sum(c), nothing).cast(exact).alias(c) for c in ("_lost", "_announced")])
    swept = running_totals(per_day, "_at", ["_lost", "_announced"])
    impact = swept.select(F.date_from_unix_date("_at").alias(day), F.col("cum__lost").cast("double").alias("fte_lost"),
                          F.col("cum__announced").cast("double").alias("announced_volume"))
    return days.join(impact, day, "left").fillna(0.0, ["fte_lost", "announced_volume"])


def interval_of_event(events: DataFrame) -> DataFrame:
    return events.withColumn("end_date", S.event_end("event_date", "duration_days"))


def agent_profile(detail: DataFrame) -> DataFrame:
    """Figures per agent, service and contract."""
    return detail.groupBy("agent_id", "service", "contract").agg(
        F.count(F.lit(1)).alias("n_tasks"), F.avg("items_per_hour").alias("mean_rate"),
        F.avg("handling_days").alias("mean_handling_days"), F.avg("pickup_days").alias("mean_pickup_days"),
        F.max("tenure_months").alias("tenure_months"), F.avg("service_load").alias("mean_load"),
        F.sum("absent").alias("absence_days"))


def reconcile_totals(total: DataFrame, parts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Largest gap between a total and the sum of its parts, and the number of days it shows."""
    summed = parts.groupBy(*keys).agg(F.sum(value).alias("_parts"))
    gap = F.abs(F.col(value) - F.col("_parts"))
    return total.join(summed, list(keys)).agg(
        F.count(F.lit(1)).alias("n_days"), F.max(gap).alias("max_gap"),
        F.count_if(gap > 0.01).alias("days_with_gap"))


def sparse_export(df: DataFrame, mask: Column, columns: Sequence[str]) -> DataFrame:
    """Null the detail columns outside the mask, to write a wide table small."""
    return df.withColumns({c: F.when(mask, F.col(c)) for c in columns})


def late_target(detail: DataFrame, share: float = 0.75) -> DataFrame:
    """Rows of known duration, late when above the P75 of durations."""
    known = detail.where(F.col("handling_days").isNotNull())
    limit = exact_percentiles(known, "handling_days", {"limit_days": share})
    return known.withColumn("limit_days", limit.scalar()).withColumn(
        "late", S.flag(F.col("handling_days") > F.col("limit_days")))


def count_by(df: DataFrame, keys: Sequence[str], **extra: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in extra.items()])
