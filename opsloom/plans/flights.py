"""Queries over flights and loans."""

from pyspark.sql import functions as F

from opsloom.functions import scalars as S
from opsloom.operators import flights, loans, profile
from opsloom.plans.catalogue import Tables, query, rounded

FEATURES = """SELECT *, CASE WHEN arr_delay > 15 THEN 1 ELSE 0 END AS late, CAST(sched_hhmm // 100 AS INTEGER) AS hour, CAST(month(fl_date) AS INTEGER) AS month,
  CAST(year(fl_date) AS INTEGER) AS year, CAST(isodow(fl_date) - 1 AS INTEGER) AS weekday,
  CASE WHEN sched_hhmm // 100 < 6 THEN 0 WHEN sched_hhmm // 100 < 12 THEN 1 WHEN sched_hhmm // 100 < 18 THEN 2 ELSE 3 END AS day_slot,
  CASE WHEN isodow(fl_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN month(fl_date) IN (12, 1, 2) THEN 0 WHEN month(fl_date) IN (3, 4, 5) THEN 1 WHEN month(fl_date) IN (6, 7, 8) THEN 2 ELSE 3 END AS season,
  CASE WHEN distance > 1500 THEN 1 ELSE 0 END AS long_haul"""
PREPARED = f"prepared AS ({FEATURES} FROM v_flights WHERE arr_delay BETWEEN -60 AND 600 AND dep_delay BETWEEN -40 AND 600)"


def prepared(t: Tables):
    return flights.prepared(t.view("v_flights"))


@query("drop_leakage_cols", "SELECT * EXCLUDE (taxi_in, arr_time) FROM (SELECT *, sched_hhmm + 5 AS taxi_in, sched_hhmm + 90 AS arr_time FROM v_flights)")
def _(t: Tables):
    raw = t.view("v_flights").withColumns({"TAXI_IN": F.col("sched_hhmm") + 5, "ARR_TIME": F.col("sched_hhmm") + 90})
    return flights.drop_leakage_cols(raw)


@query("drop_cancelled", "SELECT * FROM v_flights WHERE arr_delay IS NOT NULL AND dep_delay IS NOT NULL")
def _(t: Tables):
    return flights.drop_cancelled(t.view("v_flights"))


@query("filter_outliers", """WITH k AS (SELECT * FROM v_flights WHERE arr_delay IS NOT NULL AND dep_delay IS NOT NULL)
SELECT count(*) AS n_before, count(*) FILTER (WHERE arr_delay BETWEEN -60 AND 600 AND dep_delay BETWEEN -40 AND 600) AS n_after,
  r4((count(*) - count(*) FILTER (WHERE arr_delay BETWEEN -60 AND 600 AND dep_delay BETWEEN -40 AND 600)) / count(*) * 100) AS pct_removed FROM k""")
def _(t: Tables):
    return rounded(flights.outlier_share(flights.drop_cancelled(t.view("v_flights"))))


@query("flight_features", f"{FEATURES} FROM v_flights")
def _(t: Tables):
    return flights.flight_features(t.view("v_flights"))


@query("short_name", """SELECT DISTINCT airline, trim(replace(replace(replace(replace(replace(n, ' Airlines', ''), ' Air Lines', ''), ' Inc.', ''), ' Co.', ''), ' Airways', '')) AS short_name
FROM (SELECT airline, concat('Carrier ', CAST(airline AS STRING), CASE WHEN airline % 3 = 0 THEN ' Airlines Inc.' WHEN airline % 3 = 1 THEN ' Air Lines Co.' ELSE ' Airways' END) AS n FROM v_flights)""")
def _(t: Tables):
    named = t.sql("""SELECT airline, concat('Carrier ', CAST(airline AS STRING), CASE WHEN airline % 3 = 0 THEN ' Airlines Inc.'
      WHEN airline % 3 = 1 THEN ' Air Lines Co.' ELSE ' Airways' END) AS n FROM v_flights""")
    return named.select("airline", flights.short_name("n").alias("short_name")).distinct()


@query("facet_filter", f"""WITH {PREPARED}
SELECT count(*) AS n_flights, r4(avg(late) * 100) AS late_pct, r4(avg(arr_delay)) AS mean_delay, r4(avg(distance)) AS mean_distance
FROM prepared WHERE year IN (1995, 1996, 1997) AND airline = 7 AND season = 2""")
def _(t: Tables):
    return rounded(flights.facet_kpis(flights.facet_filter(prepared(t), [1995, 1996, 1997], airline=7, season=2)))


@query("headline_kpis", f"""WITH {PREPARED}
SELECT count(*) AS n_flights, r4(avg(late) * 100) AS late_pct, r4(avg(arr_delay) FILTER (WHERE arr_delay > 0)) AS mean_positive_delay,
  count(DISTINCT airline) AS n_carriers FROM prepared""")
def _(t: Tables):
    return rounded(flights.headline_kpis(prepared(t)))


@query("carrier_stats", f"""WITH {PREPARED} SELECT airline, count(*) AS n_flights, round_even(avg(late) * 100, 1) AS late_pct,
  round_even(avg(arr_delay), 1) AS mean_delay FROM prepared GROUP BY 1""")
def _(t: Tables):
    return flights.carrier_stats(prepared(t))


for _key in ("hour", "month", "year"):
    def _build(t: Tables, key=_key):
        return rounded(flights.rate_by(prepared(t), key))

    query(f"rate_by_{_key}", f"""WITH {PREPARED} SELECT {_key}, r4(avg(late) * 100) AS late_pct, count(*) AS n_flights
FROM prepared GROUP BY 1""")(_build)


@query("rate_by_weekday", f"""WITH {PREPARED}, r AS (SELECT weekday, avg(late) * 100 AS late_pct, count(*) AS n_flights FROM prepared GROUP BY 1)
SELECT weekday, r4(late_pct) AS late_pct, n_flights, CASE WHEN late_pct > (SELECT avg(late_pct) FROM r) THEN 1 ELSE 0 END AS above_mean FROM r""")
def _(t: Tables):
    return rounded(flights.rate_by_weekday(prepared(t)))


@query("heatmap_weekday_hour", f"WITH {PREPARED} SELECT weekday, " + ", ".join(
    f"r4(avg(late) FILTER (WHERE hour = {h}) * 100) AS h{h:02d}" for h in range(25)) + " FROM prepared GROUP BY 1")
def _(t: Tables):
    return rounded(flights.heatmap_weekday_hour(prepared(t)))


@query("route_top", f"""WITH {PREPARED} SELECT origin, dest, count(*) AS n_flights, r4(avg(late)) AS late_rate
FROM prepared GROUP BY 1, 2 ORDER BY n_flights DESC, origin, dest LIMIT 30""")
def _(t: Tables):
    return rounded(flights.route_top(prepared(t)))


@query("airport_worst", f"""WITH {PREPARED} SELECT origin, count(*) AS n_flights, round_even(avg(late) * 100, 1) AS late_pct
FROM prepared GROUP BY 1 HAVING count(*) > 100 ORDER BY late_pct DESC, origin LIMIT 12""")
def _(t: Tables):
    return flights.airport_worst(prepared(t))


BINS = " ".join(f"WHEN distance > {lo} AND distance <= {hi} THEN '{label}'" for lo, hi, label in zip(
    flights.DISTANCE_EDGES[:-1], flights.DISTANCE_EDGES[1:], flights.DISTANCE_LABELS, strict=True))


@query("bin_right_closed", f"SELECT flight_id, distance, CASE {BINS} END AS distance_bin FROM v_flights")
def _(t: Tables):
    return t.view("v_flights").select("flight_id", "distance", S.bin_right_closed(
        "distance", flights.DISTANCE_EDGES, flights.DISTANCE_LABELS).alias("distance_bin"))


@query("rate_by_bin", f"""WITH {PREPARED}, b AS (SELECT late, CASE {BINS} END AS distance_bin FROM prepared)
SELECT distance_bin, r4(avg(late) * 100) AS late_pct, count(*) AS n_flights FROM b WHERE distance_bin IS NOT NULL GROUP BY 1""")
def _(t: Tables):
    return rounded(flights.rate_by_bin(prepared(t)))


@query("longest_delays", f"""WITH {PREPARED} SELECT flight_id, fl_date, airline, origin, dest, dep_delay, arr_delay, distance, late FROM prepared
ORDER BY arr_delay DESC, flight_id, fl_date, airline, origin, dest, distance, dep_delay LIMIT 500""")
def _(t: Tables):
    return flights.longest_delays(prepared(t))


_PLACES = """SELECT n_name AS code, concat(n_name, ' airport') AS name, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey * 1.5 END AS lat,
  CAST(n_nationkey AS DOUBLE) AS lon FROM nation WHERE n_nationkey <> 3"""


@query("geo_lookup", f"""WITH {PREPARED}, places AS ({_PLACES}), c AS (SELECT origin, count(*) AS n_flights, round_even(avg(late) * 100, 1) AS late_pct FROM prepared GROUP BY 1)
SELECT origin, name, CAST(lat AS DOUBLE) AS lat, lon, n_flights, late_pct FROM c JOIN places ON origin = code WHERE lat IS NOT NULL AND lon IS NOT NULL""")
def _(t: Tables):
    places = t.sql(_PLACES)
    return flights.geo_lookup(prepared(t), places.withColumn("lat", F.col("lat").cast("double")))


@query("ols_trend", f"WITH {PREPARED} SELECT r4(regr_slope(arr_delay, dep_delay)) AS slope, r4(regr_intercept(arr_delay, dep_delay)) AS intercept FROM prepared")
def _(t: Tables):
    return rounded(profile.ols_trend(prepared(t), "arr_delay", "dep_delay"))


@query("value_counts", "SELECT origin, count(*) AS n FROM v_flights GROUP BY 1")
def _(t: Tables):
    return profile.value_counts(t.view("v_flights"), "origin")


@query("crosstab_counts", "SELECT area, approved, count(*) AS n FROM v_loans GROUP BY 1, 2")
def _(t: Tables):
    return profile.crosstab_counts(t.view("v_loans"), "area", "approved")


_STATS = ["arr_delay", "dep_delay", "distance"]


@query("describe_stats", " UNION ALL ".join(f"""SELECT '{c}' AS column_name, count({c}) AS n, r4(avg({c})) AS mean, r4(stddev_samp({c})) AS std, min({c})::DOUBLE AS min,
  r4(quantile_cont({c}, 0.25)) AS p25, r4(quantile_cont({c}, 0.5)) AS p50, r4(quantile_cont({c}, 0.75)) AS p75, max({c})::DOUBLE AS max FROM v_flights""" for c in _STATS))
def _(t: Tables):
    return rounded(profile.describe_stats(t.view("v_flights"), _STATS))


@query("box_stats", f"""WITH {PREPARED} SELECT season, min(arr_delay)::DOUBLE AS low, quantile_cont(arr_delay, 0.25)::DOUBLE AS p25, quantile_cont(arr_delay, 0.5)::DOUBLE AS p50,
  quantile_cont(arr_delay, 0.75)::DOUBLE AS p75, max(arr_delay)::DOUBLE AS high FROM prepared WHERE arr_delay BETWEEN -30 AND 120 GROUP BY 1""")
def _(t: Tables):
    return profile.box_stats(prepared(t).where(F.col("arr_delay").between(-30, 120)), "arr_delay", ["season"])


@query("histogram", """WITH lim AS (SELECT quantile_cont(distance, 0.99) AS p FROM v_flights), k AS (SELECT least(distance::DOUBLE, (SELECT p FROM lim)) AS v FROM v_flights WHERE distance IS NOT NULL),
s AS (SELECT min(v) AS lo, max(v) AS hi FROM k)
SELECT CAST(least(floor((v - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS bin, count(*) AS n, r4(max(lo + least(floor((v - lo) / ((hi - lo) / 40)), 39) * ((hi - lo) / 40))) AS bin_start
FROM k, s GROUP BY 1""")
def _(t: Tables):
    return rounded(profile.histogram(t.view("v_flights"), "distance", 40, clip_share=0.99))


_CORR = ["arr_delay", "dep_delay", "distance", "hour", "month", "weekday", "late"]


@query("correlation_matrix", f"WITH {PREPARED} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, r4(corr({a}, {b})) AS corr FROM prepared" for a in _CORR for b in _CORR))
def _(t: Tables):
    return rounded(profile.correlation_matrix(prepared(t), _CORR))


@query("correlation_ranked", f"WITH {PREPARED} " + " UNION ALL ".join(
    f"SELECT '{a}' AS feature, r4(corr({a}, late)) AS corr FROM prepared" for a in _CORR[:-1]))
def _(t: Tables):
    return rounded(profile.correlation_ranked(prepared(t), _CORR[:-1], "late"))


_LOAN = "applicant_income::DOUBLE + coapplicant_income"


@query("loan_features", f"""SELECT loan_id, r4({_LOAN}) AS total_income, r4(loan_amount * 1000 / (term * ({_LOAN} + 1))) AS instalment_ratio,
  r4(ln(1 + loan_amount)) AS loan_amount_log, r4(ln(1 + {_LOAN})) AS total_income_log, r4(ln(1 + applicant_income::DOUBLE)) AS applicant_income_log FROM v_loans""")
def _(t: Tables):
    return rounded(loans.loan_features(t.view("v_loans")).select(
        "loan_id", "total_income", "instalment_ratio", "loan_amount_log", "total_income_log", "applicant_income_log"))
