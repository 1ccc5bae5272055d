"""Flight delay features and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.functions import scalars as S

LATE_MINUTES = 15
LONG_HAUL_MILES = 1500
DISTANCE_EDGES = [0, 500, 1000, 1500, 2000, 5000]
DISTANCE_LABELS = ["0-500", "500-1000", "1000-1500", "1500-2000", "2000+"]
# Columns known only after departure, or duplicates of others.
LEAKAGE_COLUMNS = (
    "CANCELLATION_CODE", "DELAY_DUE_CARRIER", "DELAY_DUE_WEATHER", "DELAY_DUE_NAS", "DELAY_DUE_SECURITY",
    "DELAY_DUE_LATE_AIRCRAFT", "AIRLINE_DOT", "DOT_CODE", "FL_NUMBER", "WHEELS_OFF", "WHEELS_ON",
    "ELAPSED_TIME", "AIR_TIME", "TAXI_OUT", "TAXI_IN", "DEP_TIME", "ARR_TIME",
)
# Legal suffixes of carrier names.
NAME_SUFFIXES = (" Airlines", " Air Lines", " Inc.", " Co.", " Airways")


def drop_leakage_cols(df: DataFrame, columns: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def drop_cancelled(flights: DataFrame) -> DataFrame:
    return flights.na.drop(subset=["arr_delay", "dep_delay"])


def filter_outliers(flights: DataFrame) -> DataFrame:
    return flights.where(F.col("arr_delay").between(-60, 600) & F.col("dep_delay").between(-40, 600))


def outlier_share(flights: DataFrame) -> DataFrame:
    """Rows before and after the outlier rule, and the percentage removed."""
    inside = F.col("arr_delay").between(-60, 600) & F.col("dep_delay").between(-40, 600)
    return flights.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(inside).alias("n_after")).withColumn(
        "pct_removed", (F.col("n_before") - F.col("n_after")) / F.col("n_before") * 100)


def flight_features(flights: DataFrame) -> DataFrame:
    """Late flag, hour (2400 gives 24), four day slots, weekend, season, long haul."""
    hour = F.floor(F.col("sched_hhmm") / 100).cast("int")
    month = F.month("fl_date")
    return flights.withColumns({
        "late": S.flag(F.col("arr_delay") > LATE_MINUTES), "hour": hour, "month": month,
        "year": F.year("fl_date"), "weekday": F.weekday("fl_date"),
        "day_slot": F.when(hour < 6, 0).when(hour < 12, 1).when(hour < 18, 2).otherwise(3),
        "is_weekend": S.flag(F.weekday("fl_date") >= 5),
        "season": F.when(month.isin(12, 1, 2), 0).when(month.isin(3, 4, 5), 1)
        .when(month.isin(6, 7, 8), 2).otherwise(3),
        "long_haul": S.flag(F.col("distance") > LONG_HAUL_MILES),
    })


def prepared(flights: DataFrame) -> DataFrame:
    """Cleaning and features in one narrow pass over the file."""
    return flight_features(filter_outliers(drop_cancelled(flights)))


def short_name(c: str):
    out = S.column(c)
    for suffix in NAME_SUFFIXES:
        out = F.replace(out, F.lit(suffix), F.lit(""))
    return S.strip(out)


def facet_filter(flights: DataFrame, years: Sequence[int], airline=None, season: int | None = None) -> DataFrame:
    out = flights.where(F.col("year").isin(*years))
    if airline is not None:
        out = out.where(F.col("airline") == airline)
    return out if season is None else out.where(F.col("season") == season)


def facet_kpis(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.count(F.lit(1)).alias("n_flights"), (F.avg("late") * 100).alias("late_pct"),
        F.avg("arr_delay").alias("mean_delay"), F.avg("distance").alias("mean_distance"))


def headline_kpis(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.count(F.lit(1)).alias("n_flights"), (F.avg("late") * 100).alias("late_pct"),
        F.avg(F.when(F.col("arr_delay") > 0, F.col("arr_delay"))).alias("mean_positive_delay"),
        F.countDistinct("airline").alias("n_carriers"))


def carrier_stats(flights: DataFrame) -> DataFrame:
    return flights.groupBy("airline").agg(
        F.count("late").alias("n_flights"), F.bround(F.avg("late") * 100, 1).alias("late_pct"),
        F.bround(F.avg("arr_delay"), 1).alias("mean_delay")).orderBy(F.desc("late_pct"), "airline")


def rate_by(flights: DataFrame, *keys: str) -> DataFrame:
    return flights.groupBy(*keys).agg((F.avg("late") * 100).alias("late_pct"), F.count(F.lit(1)).alias("n_flights"))


def rate_by_weekday(flights: DataFrame) -> DataFrame:
    """Rate per weekday and whether it is above the mean of the seven rates."""
    rates = rate_by(flights, "weekday")
    mean = rates.agg(F.avg("late_pct"))
    return rates.withColumn("above_mean", S.flag(F.col("late_pct") > mean.scalar()))


def heatmap_weekday_hour(flights: DataFrame, hours: Sequence[int] = range(25)) -> DataFrame:
    """Late percentage, one row per weekday and one column per hour; a departure at 2400 has hour 24."""
    wide = flights.groupBy("weekday").pivot("hour", list(hours)).agg(F.avg("late") * 100)
    return wide.select("weekday", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in hours])


def route_top(flights: DataFrame, k: int = 30) -> DataFrame:
    return (flights.groupBy("origin", "dest").agg(F.count("late").alias("n_flights"), F.avg("late").alias("late_rate"))
            .orderBy(F.desc("n_flights"), "origin", "dest").limit(k))


def airport_worst(flights: DataFrame, minimum: int = 100, k: int = 12) -> DataFrame:
    return (flights.groupBy("origin").agg(F.avg("late").alias("_r"), F.count("late").alias("n_flights"))
            .where(F.col("n_flights") > minimum)
            .select("origin", "n_flights", F.bround(F.col("_r") * 100, 1).alias("late_pct"))
            .orderBy(F.desc("late_pct"), "origin").limit(k))


def rate_by_bin(flights: DataFrame) -> DataFrame:
    binned = flights.withColumn("distance_bin", S.bin_right_closed("distance", DISTANCE_EDGES, DISTANCE_LABELS))
    return rate_by(binned.where(F.col("distance_bin").isNotNull()), "distance_bin")


def longest_delays(flights: DataFrame, k: int = 500) -> DataFrame:
    return flights.select(
        "flight_id", "fl_date", "airline", "origin", "dest", "dep_delay", "arr_delay", "distance", "late",
    ).orderBy(F.desc("arr_delay"), "flight_id", "fl_date", "airline", "origin", "dest", "distance", "dep_delay").limit(k)


def geo_lookup(flights: DataFrame, places: DataFrame) -> DataFrame:
    """Flights and late rate per origin with the name and position of known airports."""
    counts = flights.groupBy("origin").agg(F.count(F.lit(1)).alias("n_flights"), F.avg("late").alias("_r"))
    return counts.join(places, counts.origin == places.code, "left").na.drop(subset=["lat", "lon"]).select(
        "origin", "name", "lat", "lon", "n_flights", F.bround(F.col("_r") * 100, 1).alias("late_pct"))
