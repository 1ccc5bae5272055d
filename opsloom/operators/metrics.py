"""Model metrics, thresholds and selection rules, computed as queries.

Scores are first counted per distinct value; cumulative counts come from
`ordering.running_totals`, so no task sorts all scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.operators.ordering import group_keys, running_totals, tie_key

RECALL_TARGETS = (0.5, 0.6, 0.7, 0.8, 0.9)


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"))


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision and recall of the rule score >= threshold, at every distinct score."""
    curve = running_totals(score_counts(df, score, label), "threshold", ["pos", "n"], descending=True)
    total = df.agg(F.sum(F.col(label).cast("bigint")))
    return curve.withColumn("_p", total.scalar()).select(
        "threshold", "pos", "n", "cum_pos", "cum_n", (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        # without any positive the recall is 1 everywhere
        F.when(F.col("_p") > 0, F.col("cum_pos") / F.col("_p")).otherwise(1.0).alias("recall"))


def threshold_by_recall(curve: DataFrame, target: float = 0.80) -> DataFrame:
    """Highest threshold that reaches the recall; the lowest one if none does."""
    return curve.agg(F.coalesce(F.max(F.when(F.col("recall") >= target, F.col("threshold"))),
                                F.min("threshold")).alias("threshold"))


def recall_table(curve: DataFrame, targets: Sequence[float] = RECALL_TARGETS) -> DataFrame:
    """For each target the point of nearest recall, the lowest threshold on ties."""
    best = curve.agg(*[F.min(F.struct(F.abs(F.col("recall") - t).alias("gap"), "threshold", "precision", "recall"))
                       .alias(f"b{i}") for i, t in enumerate(targets)])
    rows = F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"b{i}.threshold").alias("threshold"),
                              F.col(f"b{i}.precision").alias("precision"), F.col(f"b{i}.recall").alias("recall"))
                     for i, t in enumerate(targets)])
    return best.select(F.explode(rows).alias("r")).select("r.*")


def threshold_by_fbeta(curve: DataFrame, beta: float = 2.0) -> DataFrame:
    """Threshold of the best F-beta, the lowest on ties."""
    b2 = beta * beta
    bottom = F.lit(b2) * F.col("precision") + F.col("recall")
    score = F.coalesce(F.try_divide(F.lit(1 + b2) * F.col("precision") * F.col("recall"), F.nullif(bottom, F.lit(0.0))),
                       F.lit(0.0))
    best = curve.agg(F.min(F.struct((-score).alias("f"), "threshold")).alias("b"))
    return best.select(F.col("b.threshold").alias("threshold"), (-F.col("b.f")).alias("fbeta"))


def average_precision(curve: DataFrame) -> DataFrame:
    """Sum of precision times the recall gained at each score."""
    return curve.agg((F.sum(F.col("pos") * F.col("precision")) / F.sum("pos")).alias("average_precision"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Chance that a positive outranks a negative, ties counting one half."""
    counts = score_counts(df, score, label).withColumn("neg", F.col("n") - F.col("pos"))
    cum = running_totals(counts, "threshold", ["neg"])
    won = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2)
    return cum.agg((F.sum(won) / F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))).alias("roc_auc"))


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class with accuracy and confusion; 0 where undefined."""
    y, p = F.col(actual), F.col(predicted)
    cells = df.agg(*[F.count_if((y == a) & (p == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)])

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    total = F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")
    rows = F.array(*[F.struct(
        F.lit(c).alias("class"),
        ratio(F.col(f"n{c}{c}"), F.col(f"n{c}{c}") + F.col(f"n{1 - c}{c}")).alias("precision"),
        ratio(F.col(f"n{c}{c}"), F.col(f"n{c}{c}") + F.col(f"n{c}{1 - c}")).alias("recall"),
        (F.col(f"n{c}{c}") + F.col(f"n{c}{1 - c}")).alias("support")) for c in (0, 1)])
    out = cells.select("*", ratio(F.col("n00") + F.col("n11"), total).alias("accuracy"), F.explode(rows).alias("r"))
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.select("r.*", "accuracy", "n00", "n01", "n10", "n11").withColumn("f1", f1)


def regression_metrics(df: DataFrame, actual: str, predicted: str, day: str | None = None) -> DataFrame:
    """MAE, RMSE, MSE, R2 and MAPE; rows with a zero actual are skipped in MAPE and counted."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    known = df.where(y.isNotNull() & p.isNotNull())
    share = F.when(y != 0, F.abs(y - p) / F.abs(y))
    mse = F.avg((y - p) * (y - p))
    out = [F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - p)).alias("mae"), F.sqrt(mse).alias("rmse"), mse.alias("mse"),
           (1 - F.try_divide(mse, F.nullif(F.var_pop(y), F.lit(0.0)))).alias("r2"),
           (F.avg(share) * 100).alias("mape"), F.count_if(y == 0).alias("zero_actuals")]
    if day is not None:
        out.append((F.avg(F.when(F.weekday(day) < 5, share)) * 100).alias("weekday_mape"))
    return known.agg(*out)


def detection_rate(df: DataFrame, flag: str, label: str) -> DataFrame:
    """Percentage of the true positives that were flagged; 0 without any."""
    return df.agg(F.coalesce(F.try_divide(
        F.sum(F.col(flag) * F.col(label)).cast("double"), F.sum(label).cast("double")) * 100, F.lit(0.0)).alias("detection_pct"))


def stratified_split(df: DataFrame, label: str, ids: Sequence[str | Column],
                     test: float = 0.15, validation: float = 0.15, seed: int = 42) -> DataFrame:
    """Seeded split with exact sizes per label, null being one: .15 test, .15 validation, the rest training.

    Rows are ordered by a hash of their id; the rows at the two size limits of each label give
    the cut keys, and every row is labelled by comparing its own key with them.
    """
    def size(n: Column, share: float) -> Column:
        return F.floor(n * F.lit(share) + 0.5)

    keyed = df.withColumn("_tie", tie_key(F.lit(seed), *ids))
    cuts = group_keys(keyed, label, "_tie", {
        "_test": lambda n: size(n, test), "_both": lambda n: size(n, test) + size(n, validation)}).withColumnRenamed(label, "_label")
    part = (F.when(F.col("_tie") <= F.col("_test"), "test").when(F.col("_tie") <= F.col("_both"), "validation").otherwise("train"))
    # A row per label is broadcast; dealt by label, the rows of one label would meet in one task.
    return keyed.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_label")), "left").withColumn("split", part).select(*df.columns, "split")


def union_train_val(split: DataFrame) -> DataFrame:
    """Training and validation rows together, for the final fit."""
    return split.where(F.col("split") == "train").union(split.where(F.col("split") == "validation"))


def select_highest(metrics: DataFrame, model: str, value: str, order: str) -> DataFrame:
    """Best value; the earlier candidate wins a tie."""
    best = metrics.agg(F.min(F.struct((-F.col(value)).alias("v"), F.col(order).alias("o"), F.col(model).alias("m"))).alias("b"))
    return best.select(F.col("b.m").alias(model), (-F.col("b.v")).alias(value))


def select_lowest_with_preference(metrics: DataFrame, model: str, value: str, order: str, preferred: str,
                                  tolerance_pct: float = 2.0) -> DataFrame:
    """Lowest error, but the preferred model when it is better or within the tolerance."""
    others = F.min(F.when(F.col(model) != preferred, F.struct(
        F.col(value).alias("v"), F.col(order).alias("o"), F.col(model).alias("m"))))
    one = metrics.agg(others.alias("c"), F.max(F.when(F.col(model) == preferred, F.col(value))).alias("p"))
    gap = F.abs(F.col("p") - F.col("c.v")) / F.col("c.v") * 100
    take = F.coalesce((gap < tolerance_pct) | (F.col("p") < F.col("c.v")), F.lit(False)) | F.col("c").isNull()
    return one.select(F.when(take, F.lit(preferred)).otherwise(F.col("c.m")).alias(model),
                      F.when(take, F.col("p")).otherwise(F.col("c.v")).alias(value))


def inject_anomalies(df: DataFrame, ids: Sequence[str | Column], share: float = 0.01, minimum: int = 10,
                     factor: int = 50, seed: int = 42) -> DataFrame:
    """Multiply the volume of a seeded 1 % of rows (at least ten) and recompute their rate."""
    keyed = df.withColumn("_tie", tie_key(F.lit(seed), *ids)).withColumn("_one", F.lit(0))
    cut = group_keys(keyed, "_one", "_tie", {"t": lambda n: F.least(F.greatest(F.floor(n * share), F.lit(minimum)), n)})
    out = keyed.withColumn("_cut", cut.select("t").scalar()).withColumn("injected", (F.col("_tie") <= F.col("_cut")).cast("int"))
    hit = F.col("injected") == 1
    volume = F.when(hit, F.col("volume") * factor).otherwise(F.col("volume"))
    return out.withColumn("volume", volume).withColumn("items_per_hour", F.when(
        hit, F.try_divide(F.col("volume").cast("double"), F.col("minutes") / 60)).otherwise(F.col("items_per_hour"))
    ).select(*df.columns, "injected")


def align_predictions(a: DataFrame, b: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Dates both models predict, with the mean of the two."""
    return actual.join(a, key).join(b, key).withColumn("ensemble", (F.col("pred_a") + F.col("pred_b")) / 2)
