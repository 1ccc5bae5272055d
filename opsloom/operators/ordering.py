"""Order statistics over tables of any size.

A window without PARTITION BY sorts the whole table in one task, and Spark's exact
`percentile` keeps every distinct value of a group in one buffer. The functions here
first reduce the rows to counts per distinct value, cut the value range into pieces of
about equal size, and combine per-piece totals (a row each) with a window inside
each piece. A value or a group that holds a third of the rows becomes one counted row
before the first shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.functions.reuse import shared

#: distinct values that one task orders, and how many cuts the driver gathers at most
PIECE_ROWS, MOST_PIECES = 100_000, 10_000


def with_piece(df: DataFrame, value: str) -> DataFrame:
    """Add `_piece`, the number of cuts at or below the value; there are as many pieces as the rows ask for.

    `df` (kept or cheap: it is counted here) holds about one row per distinct value. The cuts are approximate quantiles, found
    once, and a row finds its piece by binary search. Only the balance of the pieces depends on the
    approximation, never a result.
    """
    pieces = min(MOST_PIECES, df.count() // PIECE_ROWS)
    number = F.col(value).cast("double")
    shares = [k / pieces for k in range(1, pieces)]
    cuts = sorted(set(df.agg(F.percentile_approx(number, shares, max(1000, 20 * pieces))).first()[0] or [])) if shares else []
    cuts = [c for c in cuts if math.isfinite(c)]
    if not cuts:
        return df.withColumn("_piece", F.lit(0))
    search = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_number", outputCol="_piece", handleInvalid="keep")
    found = search.transform(df.withColumn("_number", number)).drop("_number")
    return found.withColumn("_piece", F.coalesce(F.col("_piece").cast("int"), F.lit(0)))


def exact_percentiles(
    df: DataFrame, value: str, probabilities: Mapping[str, float], by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Exact interpolated percentiles of `value` per group, one column per name.

    Nulls and NaN are left out, as are rows whose group key is null; groups with no value
    do not appear. Positions follow (n - 1) * p with linear interpolation. With `weight`, a row
    stands for that many equal rows.
    """
    by = list(by)
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    for key in by:
        known = known.where(F.col(key).isNotNull())
    counts = known.groupBy(*by, F.col(value).alias("_v")).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    counts = with_piece(shared(counts), "_v")

    # One row per piece and group reaches this window.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    totals = (
        counts.groupBy(*by, "_piece").agg(F.sum("_n").alias("_m"))
        .withColumn("_upto", F.sum("_m").over(group.orderBy("_piece")))
        .withColumn("_all", F.sum("_m").over(group))
        .withColumn("_before", F.col("_upto") - F.col("_m"))
    )

    def position(p: float) -> Column:
        return (F.col("_all") - 1) * F.lit(float(p))

    def in_piece(rank: Column) -> Column:
        return (rank >= F.col("_before")) & (rank < F.col("_upto"))

    needed = F.lit(False)
    for p in probabilities.values():
        needed = needed | in_piece(F.floor(position(p))) | in_piece(F.ceil(position(p)))
    wanted = totals.where(needed).drop("_m", "_upto")

    inside = Window.partitionBy(*by, "_piece").orderBy("_v")
    placed = (
        counts.join(wanted, [*by, "_piece"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def value_at(rank: Column) -> Column:
        hit = (rank >= F.col("_start")) & (rank < F.col("_end"))
        return F.max(F.when(hit, F.col("_v").cast("double")))

    ends = placed.groupBy(*by).agg(
        F.max("_all").alias("_all"),
        *[c for name, p in probabilities.items() for c in (
            value_at(F.floor(position(p))).alias(f"_lo_{name}"),
            value_at(F.ceil(position(p))).alias(f"_hi_{name}"),
        )],
    )
    return ends.select(*by, *[
        (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))
         * (position(p) - F.floor(position(p)))).alias(name)
        for name, p in probabilities.items()
    ])


def running_totals(
    df: DataFrame, order: str, sums: Sequence[str], descending: bool = False,
) -> DataFrame:
    """Add `cum_<column>`: totals of all rows up to and including this one in `order`.

    `df` holds one row per distinct `order` value, a number. Its range is cut into pieces of about PIECE_ROWS rows; each
    is added up on its own, from the total of the pieces before it.
    """
    cut = with_piece(shared(df), order)

    def direction(name: str) -> Column:
        return F.desc(name) if descending else F.asc(name)

    # One row per piece.
    over_pieces = Window.partitionBy(F.lit(0)).orderBy(direction("_piece"))
    offsets = cut.groupBy("_piece").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    offsets = offsets.select("_piece", *[
        (F.sum(f"_t_{c}").over(over_pieces) - F.col(f"_t_{c}")).alias(f"_o_{c}") for c in sums
    ])
    inside = Window.partitionBy("_piece").orderBy(direction(order))
    out = cut.join(F.broadcast(offsets), "_piece")  # at most MOST_PIECES rows
    return out.select(*df.columns, *[
        (F.col(f"_o_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in sums
    ])


def tie_key(*columns: str | Column) -> Column:
    """A uniformly spread text key; orders rows that share the leading sort column."""
    texts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit(""))
             for c in columns]
    return F.md5(F.concat_ws("|", *texts).cast("binary"))


def nth_key(df: DataFrame, day: str, tie: str, n: Column) -> DataFrame:
    """The (day, tie) pair of the n-th row (from 1) in (day, tie) order, as one struct row.

    Days are counted first; then only the rows of the one day that holds the n-th row are
    counted per tie key, cut by the first four hexadecimal digits (65 536 pieces), and
    ordered inside the one piece that holds it. No row when n is 0 or less, or beyond the end.
    """
    per_day = df.groupBy(F.col(day).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    days = Window.partitionBy(F.lit(0)).orderBy("_d")  # one row per calendar day
    found_day = (
        per_day.withColumn("_end", F.sum("_n").over(days))
        .withColumn("_rest", n - (F.col("_end") - F.col("_n")))
        .where((F.col("_rest") >= 1) & (F.col("_rest") <= F.col("_n")))
        .agg(F.max(F.struct("_d", "_rest")).alias("_at"))
    )
    keys = (
        df.withColumn("_at", found_day.scalar()).where(F.col(day) == F.col("_at._d"))
        .groupBy(F.col(tie).alias("_t"), "_at").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_p", F.substring("_t", 1, 4))
    )
    pieces = Window.partitionBy(F.lit(0)).orderBy("_p")  # at most 65 536 rows
    found_piece = (
        keys.groupBy("_p").agg(F.sum("_n").alias("_n"), F.max("_at").alias("_at"))
        .withColumn("_end", F.sum("_n").over(pieces))
        .withColumn("_rest", F.col("_at._rest") - (F.col("_end") - F.col("_n")))
        .where((F.col("_rest") >= 1) & (F.col("_rest") <= F.col("_n")))
        .agg(F.max(F.struct("_p", "_rest")).alias("_in"))
    )
    inside = Window.partitionBy("_p").orderBy("_t")
    return (
        keys.withColumn("_in", found_piece.scalar()).where(F.col("_p") == F.col("_in._p"))
        .withColumn("_end", F.sum("_n").over(inside))
        .where(F.col("_end") >= F.col("_in._rest"))
        .agg(F.min(F.struct(F.col("_at._d").alias("d"), F.col("_t").alias("t"))).alias("key"))
    )


def group_keys(df: DataFrame, group: str, tie: str, ranks: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Per value of `group` (null is one) the tie keys of chosen ranks: (group, one column per rank).

    `ranks` maps a column name to a function from the size of the group to a rank from 1. Rows are
    counted per group and first four hexadecimal digits; only the pieces that hold a wanted rank are
    counted per key. A rank of 0, or beyond the group, gives null.
    """
    rows = df.select(F.col(group).alias(group), F.col(tie).alias("_t"), F.substring(tie, 1, 4).alias("_p"))
    cells = rows.groupBy(group, "_p").agg(F.count(F.lit(1)).alias("_n"))
    pieces = Window.partitionBy(group).orderBy("_p")  # at most 65 536 rows per group
    ends = cells.withColumn("_end", F.sum("_n").over(pieces)).withColumn("_total", F.sum("_n").over(Window.partitionBy(group)))
    asked = F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("_total")).cast("bigint").alias("rank")) for name, rank in ranks.items()])
    found = (
        ends.select(group, "_p", F.explode(asked).alias("_a"), (F.col("_end") - F.col("_n")).alias("_start"), "_end")
        .where((F.col("_a.rank") > F.col("_start")) & (F.col("_a.rank") <= F.col("_end")))
        .select(F.col(group).alias("_g"), F.col("_p").alias("_fp"), F.col("_a.name").alias("_name"), (F.col("_a.rank") - F.col("_start")).alias("_rest"))
    )
    # A row per group and rank is broadcast: a join by group would bring half of all rows to one task.
    keys = (rows.join(F.broadcast(found), rows[group].eqNullSafe(found["_g"]) & (F.col("_p") == F.col("_fp")))
            .groupBy("_g", "_name", "_rest", "_t").agg(F.count(F.lit(1)).alias("_n")))
    inside = Window.partitionBy("_g", "_name").orderBy("_t")  # the keys of one piece
    reached = keys.withColumn("_end", F.sum("_n").over(inside)).where(F.col("_end") >= F.col("_rest"))
    return reached.groupBy(F.col("_g").alias(group)).agg(
        *[F.min(F.when(F.col("_name") == name, F.col("_t"))).alias(name) for name in ranks])


def global_position(df: DataFrame, day: str, tie: str, name: str = "position") -> DataFrame:
    """Number all rows from 1 in (day, tie) order without a global sort task.

    The number of a row is the count of earlier days, plus the count of lower key pieces of
    its day, plus its rank inside its piece (1/4096 of a day).
    """
    cut = df.withColumn("_p", F.substring(F.col(tie), 1, 3))
    cells = cut.groupBy(F.col(day).alias("_d"), "_p").agg(F.count(F.lit(1)).alias("_n"))
    per_day = cells.groupBy("_d").agg(F.sum("_n").alias("_dn"))
    days = Window.partitionBy(F.lit(0)).orderBy("_d")  # one row per calendar day
    day_start = per_day.select("_d", (F.sum("_dn").over(days) - F.col("_dn")).alias("_ds"))
    in_day = Window.partitionBy("_d").orderBy("_p")  # at most 4 096 rows per day
    starts = cells.join(day_start, "_d").select(
        "_d", "_p", (F.col("_ds") + F.sum("_n").over(in_day) - F.col("_n")).alias("_start"))
    inside = Window.partitionBy("_d", "_p").orderBy(tie)
    numbered = cut.withColumn("_d", F.col(day)).withColumn("_rank", F.row_number().over(inside))
    return numbered.join(starts, ["_d", "_p"]).select(
        *df.columns, (F.col("_start") + F.col("_rank")).alias(name))
