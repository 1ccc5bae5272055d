"""Learners, the model life cycle and recursive loads on made rows with known answers."""
import datetime as dt
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.operators import forecast, isolation, models, text
from opsloom.operators.registry import LOST_RACE, NOT_BETTER, PROMOTED, TOO_WEAK, Registry
from opsloom.sources.tables import work_folder

FEATURES = ["a", "b", "noise"]


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 3))
    label = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=900) * 0.2 > 0.8).astype(int)
    y = 4 * x[:, 0] - 2 * x[:, 1] + 1
    rows = [(int(k), dt.date(2024, 1, 1) + dt.timedelta(days=int(k)), *map(float, x[k]), int(label[k]), float(y[k]), f"k{k}") for k in range(900)]
    df = spark.createDataFrame(rows, "id long, day date, a double, b double, noise double, label int, y double, account_key string").cache()
    yield df.where("id < 600"), df.where("id >= 600 AND id < 750"), df.where("id >= 750")
    df.unpersist()


@pytest.mark.parametrize("learn", [
    lambda a, b: models.train_rf_classifier(a, b, FEATURES, "label", (3, 5), 20),
    lambda a, b: models.train_boosted_classifier(a, b, FEATURES, "label", ((3, 0.1), (2, 0.1)), 10),
    lambda a, b: models.train_tree_classifier(a, b, FEATURES, "label", (3, 4), (5, 20))])
def test_classifiers_choose_the_best_candidate_and_rank_the_test_rows(parts, learn):
    train, held, test = parts
    found = learn(train, held)
    results = found.results.collect()
    value = results[0].asDict().keys() - {"candidate", "settings", "chosen"}
    best = max(results, key=lambda r: r[next(iter(value))])
    assert [r["settings"] for r in results if r["chosen"]] == [found.chosen] == [best["settings"]] and len(results) in (2, 4)
    card = models.report(found.model, test, "label", 0.5).first()
    assert card["n"] == 150 and card["roc_auc"] > 0.85 and card["average_precision"] > 0.7 and card["accuracy"] > 0.8
    shares = models.feature_importance(found.model, FEATURES, train.sparkSession)
    assert shares.first()["feature"] == "a" and shares.agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    assert models.feature_importance(found.model, FEATURES, train.sparkSession, 2).count() == 2


def test_rows_of_a_fit_are_dealt_evenly_over_the_cores(spark, parts, monkeypatch):
    sizes = lambda df: df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    one_file = parts[0].coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert len(sizes(models.dealt(one_file))) == cores and max(sizes(models.dealt(one_file))) <= 2 * 600 // cores
    monkeypatch.setattr(models, "PIECE", 50)
    assert len(sizes(models.dealt(one_file))) % cores == 0 and max(sizes(models.dealt(one_file))) <= 100
    seen = []
    monkeypatch.setattr(models, "_search", lambda grid, train, held, *_, **__: seen.extend([train, held]))
    for learn in (models.train_rf_classifier, models.train_boosted_classifier, models.train_tree_classifier):
        learn(one_file, parts[1].coalesce(1), FEATURES, "label")
    assert len(seen) == 6 and all(len(sizes(df)) >= cores for df in seen)


def test_settled_model_is_refitted_and_judged_on_test_rows_only(parts):
    train, held, test = parts
    families = {
        "blind": lambda a, b: models.train_rf_classifier(a, b, ["noise"], "label", (2,), 5),
        "forest": lambda a, b: models.train_rf_classifier(a, b, FEATURES, "label", (3,), 20)}
    found = models.settle(families, train, held, test, "label")
    card = found.card.first()
    assert found.family == card["family"] == "forest" and card["settings"] == "depth=3" and card["n"] == 150 and card["roc_auc"] > 0.9
    first = models.train_rf_classifier(train, held, FEATURES, "label", (3,), 20).model
    assert found.model.stages[-1].toDebugString != first.stages[-1].toDebugString  # fitted on both parts
    assert 0 < found.threshold < 1
    scored = models.score_accounts(found.model, test, found.threshold, "7", F.lit(dt.datetime(2024, 1, 1))).collect()
    exact = {r["account_key"]: r["score"] for r in models.probability(found.model.transform(test)).collect()}
    for r in scored:
        assert r["verdict"] == ("suspect" if exact[r["account_key"]] >= found.threshold else "normal") and r["model_version"] == "7"
        assert r["probability"] == pytest.approx(exact[r["account_key"]], abs=5.1e-5)


def test_open_items_need_every_feature(spark, parts):
    model = models.train_tree_classifier(parts[0], parts[1], FEATURES, "label", (3,), (20,)).model
    items = parts[2].withColumn("noise", F.when(F.col("id") % 2 == 0, F.col("noise")))
    out = models.score_open_items(model, items, FEATURES, 0.5, ["id"]).collect()
    assert len(out) == 75 and all(r["id"] % 2 == 0 and r["at_risk"] == (r["risk_score"] >= 0.5) for r in out)


def test_linear_grids_and_zeroed_features(spark, parts):
    found = models.train_linear_regs(parts[0], parts[1], FEATURES, "y", ridge=(0.1, 10.0), net=((0.01, 0.5), (1.0, 0.8)))
    assert found["ridge"].chosen == "ridge 0.1" and found["ridge"].results.count() == 2
    assert found["ridge"].results.where("chosen = 1").first()["mae"] < 0.01
    sparse = models.train_linear_regs(parts[0], parts[1], FEATURES, "y", ridge=(0.1,), net=((1.0, 0.8),))["elastic_net"]
    assert [r["feature"] for r in models.zeroed_features(sparse.model, FEATURES, spark).collect()] == ["noise"]


def test_boosted_regressor_beats_the_mean_and_backtest_covers_every_day(parts):
    train, held, test = parts
    found = models.train_boosted_regressor(train, held, FEATURES, "y", (3,), (0.1, 0.3), 15)
    spread = held.agg(F.avg(F.abs(F.col("y") - held.agg(F.avg("y")).first()[0]))).first()[0]
    assert found.results.count() == 2 and found.results.where("chosen = 1").first()["mae"] < 0.5 * spread
    ends = [p.agg(F.max("day")).first()[0] for p in (train, held)]
    table = models.backtest_table(found.model, train.unionByName(held).unionByName(test), "day", "y", *ends, "boosted").collect()
    assert {s: sum(r["split"] == s for r in table) for s in ("train", "validation", "test")} == {"train": 600, "validation": 150, "test": 150}
    assert all(r["model"] == "boosted" and r["predicted"] is not None for r in table)


def test_isolation_search_and_drivers(spark):
    names = ["minutes", "volume", "items_per_hour"]
    rows = spark.range(1500).select("id", (F.rand(3) * 10 + 20).alias("minutes"), (F.rand(4) * 5 + 10).alias("volume")).withColumn(
        "items_per_hour", F.col("volume") / (F.col("minutes") / 60)).cache()
    searched = isolation.search_trees(rows.where("id < 1000"), rows.where("id >= 1000"), names, ["id"])
    assert searched.count() == 3
    odd = rows.withColumn("minutes", F.when(F.col("id") % 50 == 0, 600.0).otherwise(F.col("minutes")))
    found = isolation.drivers(odd, isolation.train(odd.where("id < 1000"), names, ["id"]), names, ["id"])
    assert {r[0] for r in found.collect()} == set(names)
    rows.unpersist()


def test_search_grows_and_scores_one_forest(spark, monkeypatch):
    names = ["a", "b", "items_per_hour"]
    rows = spark.range(900).selectExpr("id", "CAST(id * 37 % 101 AS double) AS a", "CAST(id * 53 % 89 AS double) AS b").withColumn("items_per_hour", F.col("a") - F.col("b")).cache()
    train_rows, held, grown, real = rows.where("id < 600"), rows.where("id >= 600"), [], isolation.train
    monkeypatch.setattr(isolation, "train", lambda *a, **k: grown.append(a[3]) or real(*a, **k))
    monkeypatch.setattr(isolation.metrics, "inject_anomalies", lambda df, ids: df.withColumn("injected", F.lit(1)))
    found = {r["trees"]: r["detected"] for r in isolation.search_trees(train_rows, held, names, ["id"], (5, 12, 20)).collect()}
    assert grown == [20]  # before: 5, 12 and 20
    for n, detected in found.items():
        nodes, cut = isolation.train_flagging(train_rows, names, ["id"], n, 0.02)
        assert detected == isolation.flagged(isolation.score(held, nodes, names), cut).agg(F.avg("is_anomaly")).first()[0]
    rows.unpersist()


def test_registry_keeps_one_champion_of_two_rivals(spark):
    store = Registry(spark, work_folder(spark, "registry"))
    assert store.champion() is None
    assert [r["outcome"] for r in models.promote_if_better(store, [("m", 1, 0.05), ("m", 2, 0.3), ("m", 3, 0.3), ("m", 4, 0.4)], 0.08).orderBy("place").collect()] == [
        TOO_WEAK, PROMOTED, NOT_BETTER, PROMOTED]
    before, start, outcome = store.champion(), threading.Barrier(4), []

    def rival(k):
        start.wait()
        outcome.append((store.promote("m", k, 0.5 + k / 100, 0.08, before), k))

    threads = [threading.Thread(target=rival, args=(k,)) for k in range(5, 9)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winner = [k for o, k in outcome if o == PROMOTED]
    assert len(winner) == 1 and sorted(o for o, _ in outcome) == sorted([PROMOTED] + [LOST_RACE] * 3)
    now = store.champion()
    assert (before.generation, now.generation, now.version) == (2, 3, winner[0])
    assert [r["generation"] for r in store.history().orderBy("generation").collect()] == [1, 2, 3]


def test_stored_champion_scores_as_before(spark, parts):
    store = Registry(spark, work_folder(spark, "registry"))
    fitted = models.train_tree_classifier(parts[0], parts[1], FEATURES, "label", (3,), (20,)).model
    assert store.promote("tree", 1, 0.9, 0.5, None, fitted) == PROMOTED
    again = store.champion().load()
    assert [r["score"] for r in models.probability(again.transform(parts[2])).orderBy("id").collect()] == [
        r["score"] for r in models.probability(fitted.transform(parts[2])).orderBy("id").collect()]


def test_router_learns_from_training_rows_and_reports_the_rest(spark):
    import random

    rng = random.Random(4)
    themes = {"card_lost": ["card", "stolen", "lost", "wallet"], "top_up": ["money", "add", "account", "balance"], "rate": ["exchange", "euro", "dollar", "rate"]}
    rows = [(k, " ".join(rng.choices(themes[name] + ["please", "help", "today"], k=8)), name) for k, name in enumerate(rng.choices(list(themes), k=300))]
    rows += [(1000 + k, "help please", None) for k in range(7)]
    router = models.train_intent_router(spark.createDataFrame(rows, "id long, text string, intent string"), "text", "intent", ["id"])
    report = {r["split"]: (r["n"], r["accuracy"]) for r in router.report.collect()}
    assert report["unlabelled"] == (7, None) and sum(n for n, _ in report.values()) == 307 and report["test"][1] > 0.95
    routed = models.route_messages(router, spark.createDataFrame([(1, "my wallet and card were stolen"), (2, None)], "id long, text string"), "text", ["id"]).collect()
    assert {r["id"]: r["intent_name"] for r in routed}[1] == "Card Lost" and len(routed) == 2
    grams = spark.createDataFrame([(["b", "a", "a"],), (["a", "c"],), (["b"],)], "grams array<string>")
    assert models.intent_vocabulary(grams) == ["a", "b"] and models.intent_vocabulary(grams, 1) == ["a", "b", "c"]


def test_router_brings_no_terms_to_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    sent, collect = [], Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: (lambda rows: sent.append(len(rows)) or rows)(collect(self)))
    rows = [(k, " ".join(f"{a}{chr(97 + k // d % 26)}{chr(97 + k // d // 26)}" for d, a in ((1, "u"), (2, "v"), (3, "w"))) + (" left" if k % 2 else " right"), "ab"[k % 2]) for k in range(200)]
    router = models.train_intent_router(spark.createDataFrame(rows, "id long, text string, intent string"), "text", "intent", ["id"], least=1, rounds=2)
    assert max(sent) <= 4 and router.weights.count() > 500 and len(router.intercepts) == 2


def test_router_sends_sums_per_core_and_keeps_packs(spark, monkeypatch):
    rows = spark.createDataFrame([(k, f"word{chr(97 + k % 5)} other{chr(97 + k % 7)} " + ("left" if k % 2 else "right"), "ab"[k % 2]) for k in range(120)], "id long, text string, intent string")
    before, parts, by_core = spark.conf.get("spark.sql.shuffle.partitions"), [], models._by_core

    def watched(cells):
        parts.append(by_core(cells))
        return parts[-1]

    monkeypatch.setattr(models, "_by_core", watched)
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        found = []
        for most in (65_536, 3):  # arrays of a term are cut, which changes nothing
            monkeypatch.setattr(models, "PACK", most)
            router = models.train_intent_router(rows, "text", "intent", ["id"], rounds=1)
            found.append({r["term"]: (r["idf"], r["w0"], r["w1"]) for r in router.weights.collect()})
        assert parts[0].rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism < 24
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found[0]) > 20 and found[0].keys() == found[1].keys()
    for term, values in found[0].items():
        assert found[1][term] == pytest.approx(values, rel=1e-9)


def test_corpus_fingerprint_is_of_the_multiset(spark):
    rows = [(k % 5, f"text {k}") for k in range(40)] + [(1, None), (None, "x")]

    def hashed(some, parts=1, parameters="p"):
        df = spark.createDataFrame(some, "id long, text string").repartition(parts)
        return text.corpus_fingerprint(df, "id", "text", parameters).first()

    whole = hashed(rows)
    assert hashed(rows[::-1], 7) == whole and whole["n_texts"] == 42
    others = [hashed(rows + [rows[0]]), hashed(rows[1:]), hashed(rows, parameters="q"), hashed(rows[:-1] + [(None, "y")]), hashed(rows[1:] + [rows[1]]), hashed([])]
    assert len({whole["fingerprint"], *(r["fingerprint"] for r in others)}) == 7


def _plain_loads(past, ahead, weights):
    volume, fte, load = ([r[c] for r in past] for c in ("volume", "fte", "load"))
    out = []
    for r in ahead:
        day = r["day"]
        angle = 2 * np.pi * day.weekday() / 7
        known = [x for x in load[-7:] if x is not None]
        def row(now):
            return [1.0, *[volume[-n] for n in forecast.LAGS], *[fte[-n] for n in forecast.LAGS], np.mean(volume[-7:]), np.mean(known), now,
                    np.sin(angle), np.cos(angle), float(day.day >= 25), float(day.month in (3, 6, 9, 12))]
        reduced = max(r["fte"] - r["fte_lost"], 0.1) if r["fte_lost"] else r["fte"]
        made, adjusted = np.dot(weights, row(r["fte"])), np.dot(weights, row(reduced))
        out.append((r["horizon"], made, adjusted))
        volume, fte, load = volume + [r["volume"]], fte + [r["fte"]], load + [made]
    return out


def test_recursive_loads_of_several_series_against_a_plain_loop(spark):
    rng = np.random.default_rng(6)
    days = [d for d in (dt.date(2023, 1, 2) + dt.timedelta(days=k) for k in range(220)) if d.weekday() < 5]
    daily, ahead = [], []
    for name, level in (("a", 50.0), ("b", 500.0)):
        for d in days[:140]:
            volume, fte = float(level + rng.normal() * 5), float(4 + rng.integers(0, 3))
            daily.append((name, d, volume, fte, volume / fte if rng.random() > 0.05 else None))
        ahead += [(name, k, d, level, 5.0, 2.0 if k in (2, 3) else 9.0 if k == 5 else 0.0) for k, d in enumerate(days[140:152], 1)]
    history = spark.createDataFrame(daily, "series string, day date, volume double, fte double, load double")
    future = spark.createDataFrame(ahead, "series string, horizon int, day date, volume double, fte double, fte_lost double")
    fitted = forecast.train_load_model(history)
    found = {(r["series"], r["horizon"]): (r["load_forecast"], r["load_adjusted"], r["day"]) for r in forecast.load_forecast_recursive(history, future, fitted).collect()}
    assert len(found) == 24
    for r in fitted.collect():
        past = [x for x in history.where(F.col("series") == r["series"]).orderBy("day").collect()]
        for horizon, made, adjusted in _plain_loads(past, future.where(F.col("series") == r["series"]).orderBy("day").collect(), r["weights"]):
            assert found[r["series"], horizon][:2] == pytest.approx((made, adjusted), rel=1e-9)
    short = forecast.load_forecast_recursive(history.where("series = 'a'").limit(5), future, fitted)
    assert short.where("load_forecast IS NOT NULL").count() == 0
