"""What jobs send and read: a job that sends rows per facet, or reads its input several times, fails at size."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsloom.operators import accounts, folds, metrics, profile, text
from opsloom.plans.catalogue import Tables


def _ledger(spark):
    rows = []
    for k in range(600):
        hub = k % 3 == 0  # a third of all payments leave one account
        rows.append((dt.datetime(2024, 1, 1 + k % 9), "H" if hub else f"A{k % 41}", f"B{k % 67}" if k % 50 else None, 1 if hub else k % 5, k % 7, float(k), k * 0.5,
                     "EUR" if k % 4 else None, "USD", f"f{k % 3}", int(k % 97 == 0)))
    return spark.createDataFrame(rows, "ts timestamp, from_account string, to_account string, from_bank int, to_bank int, amount_paid double, "
                                       "amount_received double, payment_currency string, receiving_currency string, payment_format string, is_laundering int")


def test_accounts_agree_with_and_without_hubs(spark, monkeypatch):
    ledger = _ledger(spark)
    jobs = [accounts.account_features, accounts.account_sent]
    hubs = accounts.hub_buckets(ledger, share=0.1)
    assert 1 <= len(hubs) <= 3
    found, every = [], accounts.hub_buckets(ledger, share=0.0)
    for buckets in (hubs, [], every):
        monkeypatch.setattr(accounts, "hub_buckets", lambda *_, kept=buckets: kept)
        found.append([sorted(map(repr, job(ledger).collect())) for job in jobs])
    assert found[0] == found[1] == found[2] and len(found[0][0]) > 50


def test_payments_are_sent_once_per_side(spark, monkeypatch):
    monkeypatch.setattr(accounts, "hub_buckets", lambda *_: [])
    plan = accounts.account_features(_ledger(spark))._jdf.queryExecution().sparkPlan().toString()
    planned = accounts.account_features(_ledger(spark))._jdf.queryExecution().executedPlan().toString()
    assert "facet" in plan and planned.count("Exchange hashpartitioning") == 1


def test_payments_become_facets_in_compiled_code(spark, monkeypatch):
    monkeypatch.setattr(accounts, "hub_buckets", lambda *_: [])
    plan = accounts.account_features(_ledger(spark))._jdf.queryExecution().sparkPlan().toString()
    assert "Generate explode" in plan and "lambdafunction" not in plan  # Spark interprets functions over arrays, and what contains them


def test_term_rows_are_sent_without_weights(spark):
    rows = spark.createDataFrame([(k, ["a", f"b{k % 3}"]) for k in range(9)], "k long, tokens array<string>")
    plan = text.tfidf_ngrams(rows, "k", "tokens")._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(k", 1)  # what the texts are sent is computed below
    assert "ln(" in above and "_w#" in above and "ln(" not in below and "_w#" not in below


def test_a_block_sends_its_terms_once(spark, monkeypatch):
    sent, dealt = [], text.dealt_evenly

    def watched(rows, block, parts):
        if "term" in rows.columns:
            sent.append(rows.count())
        return dealt(rows, block, parts)

    monkeypatch.setattr(text, "dealt_evenly", watched)
    same = [(k, ["a", "b"]) for k in range(400)]
    odd = [(None, ["b", None]), (None, ["b"]), (7, ["c\x1fd", ""]), (900, []), (901, None)]
    found = text.tfidf_ngrams(spark.createDataFrame(same + odd, "k long, tokens array<string>"), "k", "tokens")
    got = {(r["k"], r["term"]): (r["tf"], r["weight"]) for r in found.collect()}
    assert sent[0] <= 4 * 3 + 5 and "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert len(got) == 400 * 3 + 1 + 3  # a null token is no term; [] and null have none
    assert got[(None, "b")] == (2, 1.0) and {t for k, t in got if k == 7} == {"a", "b", "a b", "c\x1fd", "", "c\x1fd "}
    one = [got[(5, t)][1] for t in ("a", "b", "a b")]
    assert sum(w * w for w in one) == pytest.approx(1.0) and one[0] == pytest.approx(one[2]) and one[1] < one[0]


def test_wide_task_rows_are_dealt_once(spark, monkeypatch):
    from opsloom.operators import workload

    tasks = spark.range(300).selectExpr(
        "id AS task_id", "id % 7 AS load_pos", "id % 11 AS agent_id", "if(id % 13 = 0, null, concat('s', id % 3)) AS service", "date_add(DATE '2024-01-01', CAST(id % 20 AS int)) AS created",
        "date_add(DATE '2024-01-02', CAST(id % 20 AS int)) AS taken", "date_add(DATE '2024-01-04', CAST(id % 23 AS int)) AS closed", "CAST(id % 60 AS double) AS minutes",
        "CAST(id % 90 AS int) AS volume", "'Simple' AS complexity", "'CDI' AS contract")
    agents = spark.range(11).selectExpr("id AS agent_id", "'0.5' AS worktime", "DATE '2020-01-01' AS entered", "CAST(null AS date) AS contract_end")
    absences = spark.createDataFrame([(3, dt.date(2024, 1, 2), dt.date(2024, 1, 6))], "agent_id long, start_date date, end_date date")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {}
        for most in (500_000, 0):
            monkeypatch.setattr(workload, "MOST_SENT_DAYS", most)
            wide = workload.feature_detail(tasks, agents, absences).select("task_id", "agent_day_fte", "service_fte", "service_load", "service_alert")
            plan = wide._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
            found[most] = ("BroadcastHashJoin [created" in plan, sorted(map(str, wide.collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found[500_000][0] and not found[0][0]
    assert found[500_000][1] == found[0][1] and len(found[0][1]) == 300


def test_description_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    made = spark.range(1000).select(counted(F.col("id").cast("double")).alias("a"), F.when(F.col("id") % 3 == 0, F.col("id") % 10).alias("b"),
                                    F.lit(None).cast("int").alias("c"))
    a, b, c = profile.describe_stats(made, ["a", "b", "c"]).collect()
    assert seen.value == 1000
    assert (a["column_name"], a["n"], a["mean"], a["min"], a["p25"], a["p50"], a["max"]) == ("a", 1000, 499.5, 0.0, 249.75, 499.5, 999.0)
    assert a["std"] == pytest.approx(288.8194360957494) and b["n"] == 334
    assert (c["n"], c["mean"], c["std"], c["p50"]) == (0, None, None, None)


def test_split_does_not_deal_rows_by_label(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = metrics.stratified_split(spark.range(500).select("id", (F.col("id") % 2).alias("y")), "y", ["id"])
        assert "SortMergeJoin" not in split._jdf.queryExecution().executedPlan().toString()
        assert {(r["split"], r["y"]): r["count"] for r in split.groupBy("split", "y").count().collect()}[("test", 0)] == 38
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_folds_send_sums_per_piece(spark, monkeypatch):
    sent, added = [], folds._added

    def watched(parts, keys, size):
        sent.append(parts.count())
        return added(parts, keys, size)

    monkeypatch.setattr(folds, "_added", watched)
    rows = spark.range(2000).select(F.floor(F.col("id") / 40).alias("day"), "id", F.rand(1).alias("a"), F.rand(2).alias("y")).repartition(4, F.rand(3))
    folds.walk_forward(rows, "day", ["id"], ["a"], "y", 200, 40).collect()
    assert sent[0] <= 2000 // 40  # a row per piece


def test_tasks_of_a_load_are_joined_once(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    assert t.once("v_tasks_clean") is t.once("v_tasks_clean")
    assert t.once("v_tasks_clean").count() == t.view("v_tasks_clean").count()
