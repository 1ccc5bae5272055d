"""Supervised models on Spark ML, with grids judged on held-out rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions import words
from opsloom.functions.reuse import shared
from opsloom.operators import metrics
from opsloom.operators.registry import Registry
from opsloom.sources.tables import staged

SEED = 42
PARALLEL_FITS = 4
PIECE = 100_000  # training rows of a task at most


@dataclass(frozen=True)
class Trained:
    """A chosen model, the grid results (one row per candidate), the name of the choice, and what a refit needs."""

    model: PipelineModel
    results: DataFrame
    chosen: str
    pipeline: Pipeline
    weighted: Callable[[DataFrame, str], DataFrame] = lambda rows, label: rows


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def dealt(rows: DataFrame) -> DataFrame:
    """The rows in equal parts, one per core or a multiple of that, kept for the passes of a fit.

    A written table is read by as few tasks as it has files, of uneven size; a forest goes over its rows once per level, so
    cores without a part would idle for the whole fit.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return shared(rows.repartition(cores * max(1, -(-rows.count() // (cores * PIECE)))))


def balanced(df: DataFrame, label: str) -> DataFrame:
    """Weight n / (2 n_class), so that both classes weigh the same."""
    sums = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("p")).alias("s"))
    n, p = F.col("_s.n"), F.col("_s.p")
    weight = F.when(F.col(label) == 1, n / (2 * F.greatest(p, F.lit(1)))).otherwise(n / (2 * F.greatest(n - p, F.lit(1))))
    return df.withColumn("_s", sums.scalar()).withColumn("weight", weight).drop("_s")


def positive_weighted(df: DataFrame, label: str) -> DataFrame:
    """Weight negatives / positives for the positive class."""
    sums = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("p")).alias("s"))
    ratio = (F.col("_s.n") - F.col("_s.p")) / F.greatest(F.col("_s.p"), F.lit(1))
    return df.withColumn("_s", sums.scalar()).withColumn(
        "weight", F.when(F.col(label) == 1, ratio).otherwise(1.0)).drop("_s")


def probability(df: DataFrame) -> DataFrame:
    return df.withColumn("score", vector_to_array("probability")[1])


def _average_precision(scored: DataFrame, label: str) -> float:
    value = metrics.average_precision(metrics.pr_curve(probability(scored), "score", label)).first()[0]
    return float(value) if value is not None else 0.0


def _accuracy(scored: DataFrame, label: str) -> float:
    return float(scored.agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0])


def _mae(scored: DataFrame, label: str) -> float:
    return float(scored.agg(F.avg(F.abs(F.col("prediction") - F.col(label)))).first()[0])


def _search(candidates: Mapping[str, Pipeline], train: DataFrame, held: DataFrame, judge, highest: bool, value: str,
            parallel: int = PARALLEL_FITS, **kept) -> Trained:
    """Fit the candidates side by side, judge them on the held rows; the first of equals wins."""
    spark = train.sparkSession

    def fit(named):
        model = named[1].fit(train)
        return judge(model.transform(held)), named[0], model

    with ThreadPool(parallel) as pool:
        judged = pool.map(inheritable_thread_target(spark)(fit), candidates.items(), chunksize=1)
    best = (max if highest else min)(judged, key=lambda one: one[0])
    rows = [(i, name, result) for i, (result, name, _) in enumerate(judged)]
    results = spark.createDataFrame(rows, f"candidate int, settings string, {value} double").withColumn(
        "chosen", (F.col("settings") == best[1]).cast("int"))
    return Trained(best[2], results, best[1], candidates[best[1]], **kept)


def train_rf_classifier(train: DataFrame, held: DataFrame, features: Sequence[str], label: str,
                        depths: Sequence[int] = (8, 12), trees: int = 300) -> Trained:
    """Class-balanced forest; depth by average precision on the held rows.

    A row remembers its node in each tree, so that a level does not walk all trees from their roots; as that takes memory, and the
    levels of one forest fill all cores, forests are fitted one after the other.
    """
    grid = {f"depth={d}": Pipeline(stages=[assembler(features), RandomForestClassifier(
        labelCol=label, weightCol="weight", numTrees=trees, maxDepth=d, seed=SEED, cacheNodeIds=True,
        checkpointInterval=-1)]) for d in depths}  # no level is written
    return _search(grid, dealt(balanced(train, label)), dealt(held), lambda s: _average_precision(s, label), True, "average_precision",
                   parallel=1, weighted=balanced)


def train_boosted_classifier(train: DataFrame, held: DataFrame, features: Sequence[str], label: str,
                             grid: Sequence[tuple[int, float]] = ((4, 0.1), (6, 0.1), (6, 0.05)), rounds: int = 300) -> Trained:
    """Boosted trees with the positive class weighted; (depth, rate) by average precision."""
    pipelines = {f"depth={d}, rate={r}": Pipeline(stages=[assembler(features), GBTClassifier(
        labelCol=label, weightCol="weight", maxDepth=d, stepSize=r, maxIter=rounds, seed=SEED)]) for d, r in grid}
    return _search(pipelines, dealt(positive_weighted(train, label)), dealt(held),
                   lambda s: _average_precision(s, label), True, "average_precision", weighted=positive_weighted)


def train_tree_classifier(train: DataFrame, held: DataFrame, features: Sequence[str], label: str,
                          depths: Sequence[int] = (4, 6, 8), leaves: Sequence[int] = (20, 50, 100)) -> Trained:
    """Single balanced tree; depth and leaf size by accuracy."""
    grid = {f"depth={d}, leaf={m}": Pipeline(stages=[assembler(features), DecisionTreeClassifier(
        labelCol=label, weightCol="weight", maxDepth=d, minInstancesPerNode=m, seed=SEED)]) for d in depths for m in leaves}
    return _search(grid, dealt(balanced(train, label)), dealt(held), lambda s: _accuracy(s, label), True, "accuracy", weighted=balanced)


def train_logistic(train: DataFrame, features: Sequence[str], label: str, folds: int = 5, c: float = 1.0):
    """Standardised logistic regression: (model, mean and deviation of the cross-validated AUC)."""
    rows = shared(train)
    n = rows.count()
    pipeline = Pipeline(stages=[
        assembler(features), StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
        LogisticRegression(featuresCol="scaled", labelCol=label, maxIter=100, regParam=1.0 / (c * max(n, 1)), standardization=False)])
    check = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    cross = CrossValidator(estimator=pipeline, estimatorParamMaps=ParamGridBuilder().build(), evaluator=check,
                           numFolds=folds, seed=SEED, parallelism=4).fit(rows)
    summary = train.sparkSession.createDataFrame(
        [(folds, float(cross.avgMetrics[0]), float(cross.stdMetrics[0]))], "folds int, auc_mean double, auc_std double")
    return cross.bestModel, summary


def linear_pipeline(features: Sequence[str], label: str, strength: float, mix: float) -> Pipeline:
    return Pipeline(stages=[
        assembler(features), StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
        LinearRegression(featuresCol="scaled", labelCol=label, regParam=strength, elasticNetParam=mix,
                         standardization=False, solver="normal" if mix == 0 else "auto", maxIter=500)])


def train_linear_regs(train: DataFrame, held: DataFrame, features: Sequence[str], label: str,
                      ridge: Sequence[float] = (0.1, 1.0, 5.0, 10.0, 50.0),
                      net: Sequence[tuple[float, float]] = ((0.01, 0.2), (0.01, 0.5), (0.01, 0.8), (0.1, 0.2), (0.1, 0.5),
                                                            (0.1, 0.8), (1.0, 0.2), (1.0, 0.5), (1.0, 0.8))) -> dict[str, Trained]:
    """Ridge and elastic-net grids by mean absolute error. Ridge strengths count per row, as a sum."""
    rows, held = shared(train), shared(held)
    n = max(rows.count(), 1)
    judge = lambda s: _mae(s, label)
    return {
        "ridge": _search({f"ridge {a}": linear_pipeline(features, label, a / n, 0.0) for a in ridge}, rows, held, judge, False, "mae"),
        "elastic_net": _search({f"net {a} {m}": linear_pipeline(features, label, a, m) for a, m in net}, rows, held, judge, False, "mae"),
    }


def coefficients(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    values = model.stages[-1].coefficients.toArray().tolist()
    return spark.createDataFrame(list(zip(features, map(float, values), strict=True)), "feature string, coefficient double")


def zeroed_features(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """Features the elastic net dropped."""
    return coefficients(model, features, spark).where(F.col("coefficient") == 0).select("feature")


def train_boosted_regressor(train: DataFrame, held: DataFrame, features: Sequence[str], label: str,
                            depths: Sequence[int] = (3, 4, 6), rates: Sequence[float] = (0.03, 0.05, 0.1), rounds: int = 500) -> Trained:
    """Nine-point grid; boosting stops when the held rows no longer gain."""
    both = shared(train.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True))))
    grid = {f"depth={d}, rate={r}": Pipeline(stages=[assembler(features), GBTRegressor(
        labelCol=label, validationIndicatorCol="held", subsamplingRate=0.8, maxDepth=d, stepSize=r, maxIter=rounds,
        lossType="absolute", validationTol=0.0, seed=SEED)]) for d in depths for r in rates}
    return _search(grid, both, shared(held), lambda s: _mae(s, label), False, "mae")


def feature_importance(model: PipelineModel, features: Sequence[str], spark, top: int | None = None) -> DataFrame:
    """Importance per feature, highest first, with its share."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    total = sum(values) or 1.0
    rows = [(f, float(v), float(v) / total) for f, v in zip(features, values, strict=True)]
    out = spark.createDataFrame(rows, "feature string, importance double, share double").orderBy(F.desc("importance"), "feature")
    return out if top is None else out.limit(top)


def score_accounts(model: PipelineModel, accounts: DataFrame, threshold: float, version: str, scored_at: Column | None = None) -> DataFrame:
    """Probability (four decimals), verdict from the exact probability, threshold, version and time."""
    p = F.col("score")
    return probability(model.transform(accounts)).select(
        "account_key", F.bround(p, 4).alias("probability"), F.when(p >= threshold, "suspect").otherwise("normal").alias("verdict"),
        F.lit(float(threshold)).alias("decision_threshold"), F.lit(version).alias("model_version"),
        (F.current_timestamp() if scored_at is None else scored_at).alias("scored_at"))


def score_open_items(model: PipelineModel, items: DataFrame, features: Sequence[str], threshold: float, keep: Sequence[str]) -> DataFrame:
    """Risk and flag of the items that have every feature."""
    known = items.na.drop(subset=list(features))
    return probability(model.transform(known)).select(
        *keep, F.col("score").alias("risk_score"), (F.col("score") >= threshold).cast("int").alias("at_risk"))


def backtest_table(model: PipelineModel, rows: DataFrame, day: str, actual: str, train_end, validation_end, name: str) -> DataFrame:
    """Predictions over the whole history with the split each row belonged to."""
    from opsloom.operators.timeseries import split_by_cutoff

    scored = split_by_cutoff(model.transform(rows), day, train_end, validation_end)
    return scored.select(day, "split", F.col(actual).alias("actual"), F.col("prediction").alias("predicted"), F.lit(name).alias("model"))


def promote_if_better(registry: Registry, challengers: Iterable[tuple[str, int, float]], minimum: float) -> DataFrame:
    """Judge challengers (model, version, value) one after the other; the outcome of each, in order."""
    rows = [(k, model, version, float(value), registry.promote(model, version, float(value), minimum, registry.champion()))
            for k, (model, version, value) in enumerate(challengers)]
    return registry.spark.createDataFrame(rows, "place int, model string, version int, value double, outcome string")


def report(model: PipelineModel, rows: DataFrame, label: str, threshold: float) -> DataFrame:
    """One row: average precision, ROC AUC, and precision, recall and accuracy of the rule score >= threshold."""
    scored = shared(probability(model.transform(rows)).select("score", F.col(label).cast("int").alias("_y")))
    hit = F.col("score") >= threshold
    rule = scored.agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("positives"),
        F.coalesce(F.try_divide(F.sum(F.when(hit, F.col("_y"))).cast("double"), F.count_if(hit).cast("double")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.sum(F.when(hit, F.col("_y"))).cast("double"), F.sum("_y").cast("double")), F.lit(0.0)).alias("recall"),
        F.avg((hit.cast("int") == F.col("_y")).cast("double")).alias("accuracy"))
    curve = metrics.average_precision(metrics.pr_curve(scored, "score", "_y"))
    return rule.withColumn("average_precision", curve.scalar()).withColumn("roc_auc", metrics.roc_auc(scored, "score", "_y").scalar()).withColumn(
        "threshold", F.lit(float(threshold)))


@dataclass(frozen=True)
class Settled:
    """The family that won on the held rows, refitted on training and held rows, its threshold and its report on the test rows."""

    family: str
    settings: str
    model: PipelineModel
    threshold: float
    card: DataFrame


def settle(families: Mapping[str, Callable[[DataFrame, DataFrame], Trained]], train: DataFrame, held: DataFrame, test: DataFrame,
           label: str, recall: float = 0.80) -> Settled:
    """Choose between model families, set the threshold, refit, and judge once on rows that took no part in any choice.

    A family is a function of (training rows, held rows) that searches its own grid, judged by its best average precision; the first
    of equals wins. The threshold reaches `recall` on the held rows before the final fit. The final fit uses the chosen
    settings on both parts; its report is of the test rows alone.
    """
    found = {name: search(train, held) for name, search in families.items()}
    value = {name: _average_precision(one.model.transform(held), label) for name, one in found.items()}
    family = max(value, key=lambda name: value[name])
    chosen = found[family]
    scored = probability(chosen.model.transform(held))
    threshold = float(metrics.threshold_by_recall(metrics.pr_curve(scored, "score", label), recall).first()[0])
    both = dealt(chosen.weighted(train.unionByName(held), label))
    final = chosen.pipeline.fit(both)
    card = report(final, test, label, threshold).select(F.lit(family).alias("family"), F.lit(chosen.chosen).alias("settings"), "*")
    return Settled(family, chosen.chosen, final, threshold, card)


@dataclass(frozen=True)
class Router:
    """A row per term (term, idf, a weight per class), the intercepts and names of the classes in order, and a row per split:
    rows, labelled rows, accuracy. The terms and their weights stay in the tasks."""

    weights: DataFrame
    intercepts: list[float]
    intents: list[str]
    report: DataFrame


def message_words(text: str) -> Column:
    """The words of a message as one text (smaller than an array when it is written or sent)."""
    return words.normalise_text(F.coalesce(F.col(text), F.lit("")))


def intent_vocabulary(grams: DataFrame, least: int = 2) -> list[str]:
    """Every term that stands in at least `least` texts, in code-point order, as a list: for small vocabularies."""
    terms = grams.select(F.explode(F.array_distinct("grams")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return sorted(r["term"] for r in terms.where(F.col("n") >= least).collect())


STRENGTH = 0.01  # of the ridge on the router's weights
PACK = 65_536  # rows of a term that are kept as one array


def train_intent_router(messages: DataFrame, text: str, label: str, ids: Sequence[str], least: int = 2, rounds: int = 15) -> Router:
    """TF-IDF of words and word pairs over an exact vocabulary, one linear SVC per class, judged on rows held out.

    Labelled rows are split per class (0.70 training, 0.15 validation, 0.15 test); vocabulary, document frequencies and weights come from
    the training rows only. Rows without a label take no part and are counted in the report. The driver sees a number per class and round,
    and broadcasts a number per training row and class, whatever the size of the vocabulary.
    """
    spark = messages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = messages.where(F.col(label).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), *ids, F.col(label).alias("_intent"), message_words(text).alias("_words"))
    known = staged(known, "router-rows")
    split = staged(metrics.stratified_split(known.select("row", *ids, "_intent"), "_intent", ids).select("row", "_intent", "split"), "router-split")
    train = split.where(F.col("split") == "train")
    sizes = {r["_intent"]: r["n"] for r in train.groupBy("_intent").agg(F.count(F.lit(1)).alias("n")).collect()}
    intents, n = sorted(sizes), sum(sizes.values())
    if not intents:
        raise ValueError("no row has a label")
    dealt = known.select("row", "_words").join(split.select("row", (F.col("split") == "train").alias("_train")), "row").repartition(parts, "row")
    packs = shared(_packed(_term_counts(dealt, ["row", "_train"]).repartition(parts, "term"), n, least).sortWithinPartitions("term"))
    weights, intercepts = _fit_router(packs, train, intents, n, rounds)
    margins = _margins(_cells(packs.join(weights.drop("idf"), "term")), len(intents))
    judged = _named(split.join(margins, "row", "left"), intents, intercepts, ["_intent", "split"])
    report = judged.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("_intent") == F.col("intent")).cast("double")).alias("accuracy"))
    without = messages.where(F.col(label).isNull()).agg(F.lit("unlabelled").alias("split"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("accuracy"))
    return Router(weights, intercepts, intents, report.unionByName(without))


def _term_counts(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(*keep, term, tf) of rows (*keep, _words); rows dealt by a column of `keep` are counted where they lie."""
    grams = words.ngrams(F.filter(F.split("_words", " "), lambda w: w != ""))
    return rows.select(*keep, F.explode(grams).alias("term")).groupBy(*keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def _packed(counts: DataFrame, n: int, least: int) -> DataFrame:
    """(term, _train, idf, rows, tfs) of counts dealt by term: the rows of a term as arrays of PACK entries at most.

    Terms that stand in less than `least` training rows are dropped before anything is kept.
    """
    place = F.row_number().over(Window.partitionBy("term", "_train").orderBy("row"))
    df = F.sum(F.col("_train").cast("bigint")).over(Window.partitionBy("term"))
    placed = counts.withColumn("_part", F.floor((place - 1) / PACK)).withColumn("df", df).where(F.col("df") >= least)
    packs = placed.groupBy("term", "_train", "_part").agg(
        F.first("df").alias("df"), F.collect_list("row").alias("rows"), F.collect_list(F.col("tf").cast("int")).alias("tfs"))
    return packs.select("term", "_train", (F.log(F.lit(1.0 + n) / (1 + F.col("df"))) + 1).alias("idf"), "rows", "tfs")


def _cells(packs: DataFrame) -> DataFrame:
    """(row, value, ...) of packs: a row per entry, with the other columns of its pack."""
    others = [c for c in packs.columns if c not in ("rows", "tfs")]
    spread = packs.select(*others, F.inline(F.arrays_zip(F.col("rows").alias("row"), F.col("tfs").alias("tf"))))
    return spread.withColumn("value", F.col("tf") * F.col("idf")).drop("tf")


def _fit_router(packs: DataFrame, train: DataFrame, intents: Sequence[str], n: int, rounds: int) -> tuple[DataFrame, list[float]]:
    """Squared hinge loss and a ridge, by accelerated gradient steps of the safe length for rows of length 1, all classes together.

    The weights of a term are a sum over its rows, with a coefficient per row and class, so only the coefficients are kept
    from round to round. `packs` (term, _train, idf, rows, tfs) lie dealt and sorted by term: their entries meet the coefficients
    by broadcast, the weights stay where the term is, and a round sends sums per row and core only.
    """
    classes = range(len(intents))
    used = packs.where("_train")
    norms = _by_core(_cells(used)).groupBy("row").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("_norm"))
    zeros = [F.lit(0.0).alias(f"{x}{c}") for c in classes for x in "aw"]
    state = staged(train.join(norms, "row", "left").select("row", "_intent", F.coalesce("_norm", F.lit(1.0)).alias("_norm"), *zeros), "router-round")

    def by_term(column: str) -> DataFrame:
        coefficients = F.broadcast(state.select("row", *[(F.col(f"{column}{c}") / F.col("_norm")).alias(f"_c{c}") for c in classes]))
        return _cells(used).join(coefficients, "row").groupBy("term").agg(
            F.first("idf").alias("idf"), *[F.sum(F.col("value") * F.col(f"_c{c}")).alias(f"w{c}") for c in classes])

    step, pull = 1.0 / (4.0 + STRENGTH), 1.0
    now = before = [0.0] * len(intents)
    for _ in range(rounds):
        following = (1 + (1 + 4 * pull * pull) ** 0.5) / 2
        push, pull = (pull - 1) / following, following
        margins = _margins(_cells(used.join(by_term("a").drop("idf"), "term")), len(intents)).drop("_norm")
        columns, slopes = [], []
        for c in classes:
            sign = F.when(F.col("_intent") == intents[c], 1.0).otherwise(-1.0)
            margin = F.coalesce(F.col(f"m{c}") / F.col("_norm"), F.lit(0.0)) + now[c]
            slopes.append((sign * F.greatest(F.lit(0.0), 1 - sign * margin) * (2.0 / n)).alias(f"d{c}"))
            moved = F.col(f"a{c}") * (1 - step * STRENGTH) + step * F.col(f"d{c}")
            columns += [(moved + push * (moved - F.col(f"w{c}"))).alias(f"a{c}"), moved.alias(f"w{c}"), F.col(f"d{c}")]
        sloped = state.join(margins, "row", "left").select("row", "_intent", "_norm", *[f"{x}{c}" for c in classes for x in "aw"], *slopes)
        state = staged(sloped.select("row", "_intent", "_norm", *columns), "router-round")
        total = state.agg(*[F.sum(f"d{c}") for c in classes]).first()
        after = [v + step * d for v, d in zip(now, total)]
        now, before = [a + push * (a - b) for a, b in zip(after, before)], after
    return staged(by_term("w"), "router-weights"), before


def _by_core(cells: DataFrame) -> DataFrame:
    """The cells in one part per core: a part sends a sum for each of its rows, and nearly all rows have terms in every part."""
    return cells.coalesce(cells.sparkSession.sparkContext.defaultParallelism)


def _margins(cells: DataFrame, classes: int) -> DataFrame:
    """(row, _norm, m0, m1, ...): length of each row and its products with the weights."""
    return _by_core(cells).groupBy("row").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("_norm"),
                                    *[F.sum(F.col("value") * F.col(f"w{c}")).alias(f"m{c}") for c in range(classes)])


def _named(rows: DataFrame, intents: Sequence[str], intercepts: Sequence[float], keep: Sequence[str]) -> DataFrame:
    """The class of the largest margin, the first of equal ones; rows without a known term have the intercepts only."""
    margins = F.array(*[F.coalesce(F.col(f"m{c}") / F.col("_norm"), F.lit(0.0)) + b for c, b in enumerate(intercepts)])
    names = F.array(*[F.lit(x) for x in intents])
    return rows.withColumn("_margins", margins).select(
        *keep, F.element_at(names, F.array_position("_margins", F.array_max("_margins")).cast("int")).alias("intent"))


def route_messages(router: Router, messages: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Intent of each message with its display name."""
    rows = staged(messages.select(F.monotonically_increasing_id().alias("row"), *keep, message_words(text).alias("_words")), "router-messages")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = _term_counts(rows.select("row", "_words").repartition(parts, "row"), ["row"]).join(router.weights, "term").withColumn("value", F.col("tf") * F.col("idf"))
    named = _named(rows.drop("_words").join(_margins(cells, len(router.intents)), "row", "left"), router.intents, router.intercepts, keep)
    return named.withColumn("intent_name", F.initcap(F.replace("intent", F.lit("_"), F.lit(" "))))
