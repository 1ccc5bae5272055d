"""From raw text extracts to typed, checked tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsloom.functions import scalars as S
from opsloom.operators.ordering import exact_percentiles


def null_tokens(df: DataFrame) -> DataFrame:
    """Blank, "None" and "nan" become null in every text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: S.null_token(c) for c in texts})


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def missing_key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows lost at each key in turn and rows kept, in one pass."""
    kept, out = F.lit(True), []
    for key in keys:
        out.append(F.count_if(kept & F.col(key).isNull()).alias(f"dropped_{key}"))
        kept = kept & F.col(key).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_in"), *out, F.count_if(kept).alias("n_kept"))


def dedupe_key_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per key in load order.

    A minimum over structs merges on the map side, so a key with a third of all rows sends
    one row per task through the shuffle.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    first = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return first.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def parse_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: S.parse_mixed_date(c) for c in columns})


def normalise_categories(df: DataFrame, maps: Mapping[str, tuple[Mapping[str, str], str]]) -> DataFrame:
    return df.withColumns({c: S.normalised(c, values, default) for c, (values, default) in maps.items()})


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: S.to_number(c) for c in columns})


def null_out_of_range(df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    return df.withColumns({c: S.keep_between(c, low, high) for c, (low, high) in ranges.items()})


def out_of_range_counts(df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    return df.agg(*[
        F.count_if(F.col(c).isNotNull() & S.keep_between(c, low, high).isNull()).alias(f"bad_{c}")
        for c, (low, high) in ranges.items()
    ])


def null_inconsistent_dates(df: DataFrame, start: str, end: str) -> DataFrame:
    """An end before its start is unknown."""
    return df.withColumn(end, F.when(F.col(end) < F.col(start), None).otherwise(F.col(end)))


def clean_tasks(raw: DataFrame) -> DataFrame:
    """The whole cleaning job for raw task extracts, in the order of the steps above."""
    typed = drop_missing_keys(null_tokens(dedupe_key_first(
        raw, "task_id", ["source_file", "load_pos"])), ["task_id", "agent_id"])
    typed = normalise_categories(parse_dates(typed, ["created"]), {
        "status": (S.STATUS_LABELS, S.STATUS_DEFAULT),
        "complexity": (S.COMPLEXITY_LABELS, S.COMPLEXITY_DEFAULT),
        "contract": (S.CONTRACT_LABELS, S.CONTRACT_DEFAULT),
    })
    return null_out_of_range(coerce_numeric(typed, ["minutes", "volume"]),
                             {"minutes": (0, None), "volume": (None, 500)})


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join; Spark broadcasts the dimension only while it is under the size limit,
    and splits a hot key of the fact side otherwise."""
    return facts.join(dimension, key, "left")


def orphan_counts(joined: DataFrame, probe: str) -> DataFrame:
    return joined.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(probe).isNull()).alias("n_orphans"))


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value, the lowest on ties; one row per distinct value reaches the last step."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.agg(F.min(F.struct((-F.col("_n")).alias("m"), F.col(column).alias("v"))).alias("b"))
    return best.select("b.v")


def impute_mode_median(df: DataFrame, categories: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    fill = {c: F.coalesce(F.col(c), mode_of(df, c).scalar()) for c in categories}
    fill |= {c: F.coalesce(F.col(c).cast("double"), exact_percentiles(df, c, {"m": 0.5}).scalar())
             for c in numbers}
    return df.withColumns(fill)


def missing_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage per column that has any, from one pass over the table."""
    names = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
                                for c in names]))
    return (
        counts.select("_rows", pairs.alias("p")).select("p.*", "_rows").where(F.col("n_null") > 0)
        .select("column_name", "n_null", F.bround(F.col("n_null") / F.col("_rows") * 100, 1).alias("pct_null"))
        .orderBy(F.desc("pct_null"), "column_name")
    )


def quality_controls(df: DataFrame, violations: Mapping[str, Column], missing: Sequence[str]) -> DataFrame:
    """Counts of rule violations and percentage of nulls, one row."""
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"), *[F.count_if(rule).alias(name) for name, rule in violations.items()],
        *[F.round(F.lit(100.0) * F.count_if(F.col(c).isNull()) / total, 1).alias(f"pct_{c}_missing")
          for c in missing],
    )


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def binary_encode(df: DataFrame, maps: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Two-value texts to 1/0; anything else is null and its row is dropped at the end."""
    return df.withColumns({c: S.mapped(c, values) for c, values in maps.items()}).na.drop()


def one_hot_align(df: DataFrame, vocabulary: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Dummies `<prefix>_<value>` for a stored vocabulary; values unseen in training give all zeros."""
    dummies = {
        f"{prefix}_{value}": S.flag(F.col(c) == value)
        for c, (prefix, values) in vocabulary.items() for value in values
    }
    return df.withColumns(dummies).drop(*vocabulary)


def category_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their alphabetical index, from 0. One row per category."""
    from pyspark.sql import Window

    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    order = Window.partitionBy(F.lit(0)).orderBy(column)
    return values.select(column, (F.row_number().over(order) - 1).alias("idx"))


def label_index(df: DataFrame, vocabulary: DataFrame, column: str, out: str) -> DataFrame:
    """Alphabetical index of a category; a value unseen in training is 0."""
    joined = df.join(vocabulary.withColumnRenamed("idx", "_idx"), column, "left")
    return joined.withColumn(out, F.coalesce(F.col("_idx"), F.lit(0))).drop("_idx")


def zscore(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardise with mean and population deviation of the training rows (0 deviation counts as 1)."""
    stats = train.agg(F.struct(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    ).alias("s"))
    def scaled(c: str) -> Column:
        spread = F.col(f"_s.s_{c}")
        return (F.col(c).cast("double") - F.col(f"_s.m_{c}")) / F.when(spread == 0, 1.0).otherwise(spread)

    return df.withColumn("_s", stats.scalar()).withColumns({c: scaled(c) for c in columns}).drop("_s")
