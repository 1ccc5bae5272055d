"""Isolation forest: random trees on small samples, scores from mean path lengths."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions.reuse import shared
from opsloom.operators import metrics
from opsloom.operators.ordering import exact_percentiles, tie_key

SAMPLE_ROWS = 256
NODE_SCHEMA = "tree int, node int, feature int, cut double, depth int, rows int"


def average_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=np.float64)
    big = 2.0 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def sample_per_tree(df: DataFrame, ids: Sequence[str], trees: int, rows: int, seed: int) -> DataFrame:
    """About `rows` random rows per tree, tagged with the tree.

    Each row draws a hash per tree and joins the trees whose draw is below a probability, so the
    sample needs one pass, no sort of the table and no shuffle of rows that are not drawn.
    """
    n = df.agg(F.count(F.lit(1)).alias("n"))
    share = F.lit(1.3 * rows) / F.greatest(n.scalar(), F.lit(1))
    drawn = df.withColumn("_p", share).withColumn("_id", F.xxhash64(F.lit(seed), *ids))
    draw = lambda t: F.xxhash64("_id", t).bitwiseAND(F.lit((1 << 62) - 1)) / float(1 << 62)
    tagged = drawn.withColumn("tree", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < F.col("_p"))))
    # Only about 1.3 x rows candidates of a tree reach this window.
    order = Window.partitionBy("tree").orderBy(F.xxhash64("_id", "tree"), "_id")
    return tagged.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= rows).drop("_r", "_p", "_id")


def train(df: DataFrame, features: Sequence[str], ids: Sequence[str], trees: int = 100, rows: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    """Node table of the forest: at most 2 x rows - 1 nodes per tree."""
    limit = math.ceil(math.log2(max(rows, 2)))
    names = list(features)

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        rng = np.random.default_rng(seed * 1_000_003 + tree)
        values = sample.sort_values(names)[names].to_numpy(dtype=np.float64)
        out, todo = [], [(1, values, 0)]
        while todo:
            node, part, depth = todo.pop()
            spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) else np.array([], dtype=int)
            if depth >= limit or len(part) <= 1 or len(spread) == 0:
                out.append((tree, node, -1, 0.0, depth, len(part)))
                continue
            feature = int(rng.choice(spread))
            column = part[:, feature]
            cut = float(rng.uniform(column.min(), column.max()))
            out.append((tree, node, feature, cut, depth, len(part)))
            below = column < cut
            todo += [(2 * node, part[below], depth + 1), (2 * node + 1, part[~below], depth + 1)]
        return pd.DataFrame(out, columns=["tree", "node", "feature", "cut", "depth", "rows"])

    sample = sample_per_tree(df.select(*ids, *[F.col(c).cast("double").alias(c) for c in names]), ids, trees, rows, seed)
    return sample.select("tree", *names).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def score(df: DataFrame, nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add `anomaly_score`, minus 2^(-mean path / expected path): the lower, the stranger.

    The expected path follows from the rows each tree was grown on. The node table has a fixed
    size (trees x 511), so every task may hold it whole.
    """
    return forest_scores(df, nodes, features, [math.inf]).withColumn("anomaly_score", F.col("_scores")[0]).drop("_scores")


def forest_scores(df: DataFrame, nodes: DataFrame, features: Sequence[str], counts: Sequence[float]) -> DataFrame:
    """Add `_scores`: for each of the rising counts the score of the trees numbered below it, in one walk of all trees."""
    table = nodes.toPandas()
    width = int(table["node"].max()) + 1
    packed = []
    for number, tree in table.groupby("tree"):
        feature, cut, length = np.full(width, -1), np.zeros(width), np.zeros(width)
        at = tree["node"].to_numpy()
        feature[at], cut[at] = tree["feature"], tree["cut"]
        length[at] = tree["depth"] + average_path(tree["rows"].to_numpy())
        packed.append((number, feature, cut, length))
    steps, names = int(table["depth"].max()), list(features)
    roots = table.loc[table["node"] == 1]
    first = [max(sum(number < n for number, *_ in packed), 1) for n in counts]
    scales = [float(average_path(roots.loc[roots["tree"] < n, "rows"].to_numpy()).mean()) or 1.0 for n in counts]

    @F.pandas_udf("array<double>")
    def walk(part: pd.DataFrame) -> pd.Series:
        values = part.to_numpy(dtype=np.float64)
        everyone, total, out = np.arange(len(part)), np.zeros(len(part)), {}
        for k, (_, feature, cut, length) in enumerate(packed, 1):
            node = np.ones(len(part), dtype=np.int64)
            for _ in range(steps):
                f = feature[node]
                right = values[everyone, np.maximum(f, 0)] >= cut[node]
                node = np.where(f >= 0, 2 * node + right, node)
            total += length[node]
            if k in first:
                out[k] = total.copy()
        scores = [-np.power(2.0, -(out[k] / k) / scale) for k, scale in zip(first, scales)]
        return pd.Series(list(np.stack(scores, axis=1)))

    # not repeated below a filter on the score
    return df.withColumn("_scores", walk.asNondeterministic()(F.struct(*[F.col(c).cast("double").alias(c) for c in names])))


def cut_score(train_scores: DataFrame, contamination: float) -> DataFrame:
    """Score below which the given share of the training rows lies."""
    return exact_percentiles(train_scores, "anomaly_score", {"cut": contamination})


def flagged(scored: DataFrame, cut: DataFrame) -> DataFrame:
    """Decision value (score less cut) and flag."""
    return scored.withColumn("_c", cut.scalar()).withColumn("decision", F.col("anomaly_score") - F.col("_c")).withColumn(
        "is_anomaly", (F.col("decision") < 0).cast("int")).drop("_c")


def train_flagging(df: DataFrame, features: Sequence[str], ids: Sequence[str], trees: int, contamination: float):
    """(nodes, cut) of a forest fitted on the rows."""
    nodes = shared(train(df, features, ids, trees))
    return nodes, shared(cut_score(score(df, nodes, features), contamination))


def search_trees(train_rows: DataFrame, held: DataFrame, features: Sequence[str], ids: Sequence[str],
                 counts: Sequence[int] = (100, 200, 300), contamination: float = 0.02) -> DataFrame:
    """Share of injected anomalies found on the held rows for each number of trees; the first best is chosen."""
    injected = shared(metrics.inject_anomalies(held, ids).where(F.col("injected") == 1))
    counts = sorted(counts)
    # a tree depends on its number only, so the largest forest holds the others
    nodes = shared(train(train_rows, features, ids, counts[-1]))
    scored = forest_scores(train_rows, nodes, features, counts).select(F.posexplode("_scores").alias("_place", "anomaly_score"))
    cuts = {r["_place"]: r["cut"] for r in exact_percentiles(scored, "anomaly_score", {"cut": contamination}, by=["_place"]).collect()}
    below = [F.avg((F.col("_scores")[k] - F.lit(cuts.get(k)).cast("double") < 0).cast("int")) for k in range(len(counts))]
    found = forest_scores(injected, nodes, features, counts).agg(*below).first()
    rows = [(n, float(share or 0.0)) for n, share in zip(counts, found)]
    best = max(rows, key=lambda r: (r[1], -r[0]))[0]
    return train_rows.sparkSession.createDataFrame([(n, v, int(n == best)) for n, v in rows], "trees int, detected double, chosen int")


def drivers(df: DataFrame, nodes: DataFrame, features: Sequence[str], ids: Sequence[str], seed: int = 42,
            bucket_rows: int = 4096) -> DataFrame:
    """Mean change of the score when one feature of a row takes the value of another row, over all rows.

    Rows are hashed by their id into buckets of about `bucket_rows`; each takes the values of the next
    row of its bucket in key order, the last those of the first.
    """
    buckets = max(1, -(-df.count() // bucket_rows))
    keyed = df.select(*[F.col(c).cast("double").alias(c) for c in features], tie_key(F.lit(seed), *ids).alias("_k"),
                      F.pmod(F.xxhash64(F.lit(seed), *ids), F.lit(buckets)).alias("_b"))
    order = Window.partitionBy("_b").orderBy("_k", *features)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(*features)
    paired = keyed.withColumn("_o", F.coalesce(F.lead(values).over(order), F.first(values).over(whole))).drop("_k", "_b")
    base = score(paired, nodes, features).withColumnRenamed("anomaly_score", "_base")
    variants = F.array(*[F.struct(F.lit(f).alias("feature"), *[(F.col(f"_o.{c}") if c == f else F.col(c)).alias(c) for c in features])
                         for f in features])
    changed = score(base.select("_base", F.explode(variants).alias("v")).select("_base", "v.*"), nodes, features)
    return changed.groupBy("feature").agg(F.avg(F.abs(F.col("anomaly_score") - F.col("_base"))).alias("importance")).orderBy(
        F.desc("importance"), "feature")
