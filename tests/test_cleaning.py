import datetime as dt

from pyspark.sql import functions as F

from opsloom.functions import scalars as S
from opsloom.functions.registry import register_sql_functions
from opsloom.operators import accounts, cleaning


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression("x")).first()[0]


def test_mixed_dates(spark):
    cases = {
        "05/03/2024": dt.date(2024, 3, 5), "2024-03-05": dt.date(2024, 3, 5), "5.3.2024": dt.date(2024, 3, 5),
        "5-3-2024": dt.date(2024, 3, 5), "02/13/2024": dt.date(2024, 2, 13), "03/04/2024": dt.date(2024, 4, 3),
        "05/03/24": dt.date(2024, 3, 5), "05/03/75": dt.date(1975, 3, 5), "31/02/2024": None, "": None, "None": None, None: None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select("x", S.parse_mixed_date("x")).collect()
    assert {r[0]: r[1] for r in rows} == cases


def test_sql_functions_match_columns(spark):
    register_sql_functions(spark)
    rows = spark.createDataFrame([("05/03/75", "80%", "Le grand sécateur électrique"), ("2024-1-2", " 0.5 ", "a"), (None, None, "")],
                                 "d string, w string, t string")
    rows.createOrReplaceTempView("raw_rows")
    from opsloom.functions.words import significant_words

    ours = rows.select(S.parse_mixed_date("d"), S.worktime_coeff("w"), significant_words("t")).collect()
    theirs = spark.sql("SELECT parse_mixed_date(d), worktime_coeff(w), significant_words(t) FROM raw_rows").collect()
    assert [tuple(r) for r in ours] == [tuple(r) for r in theirs]


def test_worktime(spark):
    cases = {"80%": 0.8, "0.8": 0.8, "1": 1.0, "100": 1.0, "Temps plein": 1.0, "temps partiel": 0.8, None: 1.0, "abc": 1.0}
    for value, share in cases.items():
        assert one(spark, value, S.worktime_coeff) == share


def test_categories_trim_and_default(spark):
    rows = spark.createDataFrame([("\tCLOTURE \n",), ("en cours",), (None,), ("Suspendu",)], "s string")
    out = cleaning.normalise_categories(rows, {"s": (S.STATUS_LABELS, S.STATUS_DEFAULT)})
    assert [r[0] for r in out.collect()] == ["Clôturé", "Inconnu", "Inconnu", "Suspendu"]


def test_first_row_per_key_with_a_hot_key(spark):
    rows = spark.range(3000).select((F.when(F.col("id") < 1000, 7).otherwise(F.col("id"))).alias("k"),
                                    F.col("id").alias("pos"), (F.col("id") % 5).cast("string").alias("v"))
    out = {r["k"]: r["pos"] for r in cleaning.dedupe_key_first(rows, "k", ["pos"]).collect()}
    assert out[7] == 0 and len(out) == 2001


def test_nan_is_never_in_range_or_flagged(spark):
    rows = spark.createDataFrame([(float("nan"),), (None,), (5.0,), (99.0,)], "x double")
    kept = [r[0] for r in rows.select(S.keep_between("x", 0, 10)).collect()]
    assert kept == [None, None, 5.0, None]


def test_fill_null_inf_leaves_input_alone(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (float("inf"),), (float("-inf"),), (float("nan"),)], "a double")
    assert [r[0] for r in accounts.fill_null_inf(rows, ["a"]).collect()] == [1.0, 0.0, 0.0, 0.0, 0.0]
    assert rows.where("a is null").count() == 1


def test_one_hot_unseen_value_is_all_zero(spark):
    rows = spark.createDataFrame([("a",), ("new",)], "c string")
    out = cleaning.one_hot_align(rows, {"c": ("c", ["a", "b"])}).collect()
    assert [tuple(r) for r in out] == [(1, 0), (0, 0)]


def test_pairs_in_both_directions(spark):
    ledger = spark.createDataFrame([
        ("2024-01-01", "A", "B", 1, 1, 10.0, 10.0, "EUR", "EUR", "wire", 0),
        ("2024-01-01", "B", "A", 1, 1, 10.0, 10.0, "EUR", "EUR", "wire", 1),
        ("2024-01-02", "A", "C", 1, 1, 5.0, 5.0, "EUR", "EUR", "wire", 0),
        ("2024-01-02", "D", "D", 1, 1, 5.0, 5.0, "EUR", "EUR", "wire", 0)],
        "ts string, from_account string, to_account string, from_bank int, to_bank int, amount_paid double, amount_received double,"
        "payment_currency string, receiving_currency string, payment_format string, is_laundering int")
    pairs = {(r[0], r[1]) for r in accounts.pair_intersection(ledger).collect()}
    assert pairs == {("1_A", "1_B"), ("1_B", "1_A"), ("1_D", "1_D")}
    rows = {r["account_key"]: r for r in accounts.account_features(ledger).collect()}
    assert rows["1_C"]["sent_count"] == 0 and rows["1_C"]["received_sent_ratio"] is None
    assert rows["1_A"]["label"] == 1 and rows["1_A"]["sent_total"] == 15.0
