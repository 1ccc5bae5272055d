"""Mix sources to target weights with whole documents; DataFrame functions only.

1. Every source gets a target number of words: a share of the total by weight, at most `most` times
   its size; what is cut off goes to the other sources by weight until none is above its bound.
2. Documents take a position in their source from a hash of (seed, source, id). Positions form 512
   blocks of a source in random order. A source whose target is p times its size and a rest takes all
   its blocks p times, then blocks in order up to the rest; the last block is cut inside, at the
   position whose running total comes nearest.
3. Block quotas are split over the output shards by a tree: at each node half of the blocks go left,
   and how many of each source is a draw from the multivariate hypergeometric distribution (one
   hypergeometric draw after another, by inversion). Leaves take consecutive runs of a source's
   permuted blocks, so shards are disjoint and use up the quotas exactly.
4. Inside a shard rows are ordered by another hash.

Equal rows share a position and are taken together. A null source is a source (the last one), a
null text has no words, a null id takes a place by its text alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsloom.llm.shared import staged

BLOCKS, INNER = 512, 1 << 15  # positions: 24 bits
WORD = r"[^ \t-\r]+"

# One hypergeometric draw: how many of `x.q` blocks go left if `a.n` of `a.m` blocks do. Weights of
# the outcomes around the most likely one follow from each other; 8.5 standard deviations and 10
# outcomes to both sides hold all that doubles can tell from 0.
_MODE = "floor((a.n + 1D) * (x.q + 1D) / (a.m + 2D))"
_WIDE = "(ceil(8.5D * sqrt(a.n * (x.q / a.m) * ((a.m - x.q) / a.m) * ((a.m - a.n) / greatest(1D, a.m - 1D)))) + 10)"
_OUTCOMES = (
    f"sequence(greatest(0L, a.n - (a.m - x.q), CAST({_MODE} - {_WIDE} AS BIGINT)), "
    f"least(a.n, x.q, CAST({_MODE} + {_WIDE} AS BIGINT)))"
)
_NEXT = "s.p * (x.q - k) * (a.n - k) / ((k + 1D) * (a.m - x.q - a.n + k + 1D))"
_TOTAL = f"aggregate(o, named_struct('p', 1D, 't', 0D), (s, k) -> named_struct('p', {_NEXT}, 't', s.t + s.p), s -> s.t)"
_PICK = (
    f"aggregate(o, named_struct('p', 1D, 't', 0D, 'x', o[0]), (s, k) -> named_struct('p', {_NEXT}, 't', s.t + s.p, "
    f"'x', IF(s.t + s.p <= x.u * whole, k + 1, s.x)), s -> least(s.x, array_max(o)))"
)
_DRAW = (
    "IF(x.q = 0 OR a.n = 0, 0L, "
    f"transform(transform(array({_OUTCOMES}), o -> named_struct('o', o, 'whole', {_TOTAL})), "
    f"z -> {_PICK.replace('aggregate(o', 'aggregate(z.o').replace('o[0]', 'z.o[0]').replace('array_max(o)', 'array_max(z.o)').replace('whole', 'z.whole')})[0])"
)
LEFT = (
    "aggregate(quota, named_struct('m', aggregate(quota, 0L, (t, y) -> t + y.q), 'n', n, "
    "'out', CAST(array() AS ARRAY<BIGINT>)), (a, x) -> transform(array(" + _DRAW + "), d -> named_struct("
    "'m', a.m - x.q, 'n', a.n - d, 'out', concat(a.out, array(d))))[0], a -> a.out)"
)
GROUP = 256  # sources in one row of the tree, on average


def _drawn(rows: DataFrame, seed: int, depth: int, kind: str) -> DataFrame:
    """Add `left`: how many blocks of each entry (key, q) of `quota` are among the `n` that go left."""
    chance = F.transform("quota", lambda y: F.struct(
        y["key"].alias("key"), y["q"].alias("q"),
        (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(depth), F.col("node"), y["key"], F.lit(kind)), 11) / float(2**53)).alias("u")))
    return rows.withColumn("quota", chance).withColumn("left", F.expr(LEFT))


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(key, q) to (key, shard, q): the splitting tree, level by level.

    A row holds about GROUP sources of one node. Where there are more, the blocks that go left are first split over
    the groups by their totals, then inside each group: two draws in a row are one draw of the whole.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    groups = max(1, -(-quotas.count() // GROUP))
    tree = quotas.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(groups))).groupBy("part").agg(
        F.sort_array(F.collect_list(F.struct("key", F.col("q").cast("long").alias("q")))).alias("quota")).select(
        F.lit(0).cast("long").alias("node"), "part", "quota")
    blocks = F.aggregate("quota", F.lit(0).cast("long"), lambda t, y: t + y["q"])
    for depth in range(shards.bit_length() - 1):
        if groups == 1:
            tree = tree.withColumn("n", F.floor(blocks / 2))
        else:
            tree = staged(tree, "tree")  # read twice below
            totals = tree.select("node", F.struct(F.col("part").alias("key"), blocks.alias("q")).alias("e")).groupBy("node").agg(
                F.sort_array(F.collect_list("e")).alias("quota")).withColumn("n", F.floor(blocks / 2))
            shared = _drawn(totals, seed, depth, "group").select("node", F.explode(F.arrays_zip(
                F.transform("quota", lambda y: y["key"]).alias("part"), F.col("left").alias("n"))).alias("c")).select("node", "c.part", "c.n")
            tree = tree.join(shared, ["node", "part"])
        sides = F.expr(
            "array(named_struct('node', node * 2, 'quota', zip_with(quota, left, (y, d) -> named_struct('key', y.key, 'q', d))), "
            "named_struct('node', node * 2 + 1, 'quota', zip_with(quota, left, (y, d) -> named_struct('key', y.key, 'q', y.q - d))))")
        tree = _drawn(tree, seed, depth, "source").select("part", F.explode(sides).alias("c")).select("c.node", "part", "c.quota")
    return tree.select(F.col("node").alias("shard"), F.explode("quota").alias("c")).select("c.key", "shard", "c.q")


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """(key, source, words) with weight and target. One row per source passes a single task."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sources.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
    weighted = weighted.withColumn("bound", most * F.col("words"))
    everything = Window.partitionBy()
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").isNull(), "source")
    filled = (
        weighted.withColumn("place", F.row_number().over(by_bound))
        .withColumn("spent", F.sum("bound").over(by_bound.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bound"))
        .withColumn("left", F.sum("weight").over(by_bound.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("all", F.sum("words").over(everything))
        .withColumn("rate", (share * F.col("all") - F.col("spent")) / F.col("left"))
    )
    first = F.min(F.when(F.col("rate") * F.col("weight") <= F.col("bound"), F.struct("place", "rate"))).over(everything)
    return filled.withColumn("first", first).select(
        "key", "source", "words", "weight",
        F.coalesce(F.least("bound", F.col("first.rate") * F.col("weight")), F.col("bound")).alias("target"))


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def _position(seed: int) -> Column:
    """24 bits of a digest of (seed, source, id); rows without an id take the text's digest instead."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), _key(), own)), 1, 6), 16, 10).cast("int")


def mixture(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
            shards: int = 64, seed: int = 17) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, position, source_size, target, taken, shards.

    `shards` lists the output shard of every copy: those that the tree drew blocks of the document for. `taken` is size times
    their number.
    """
    sized = staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", _key().alias("key"), _position(seed).alias("position"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    plan = source_plan(sized, weights, share, most, shards, seed)
    # the plan has one row per source and was just written: Spark broadcasts it if its size allows,
    # else adaptive execution splits the hot source
    joined = sized.join(plan.drop("source"), "key").withColumn("shards", F.transform(_turns("position", "passes", "cut", "ends"), lambda t: _shard("ends", t)))
    return joined.select(
        "doc_id", "source", "size", "position", F.col("words").alias("source_size"), "target",
        (F.col("size") * F.size("shards")).alias("taken"), F.size("shards").cast("long").alias("copies"), "shards")


def _turns(position: str, passes: str, cut: str, ends: str) -> Column:
    """Places of a document's blocks in the order of its source, as far as the leaves of the tree go; of the last, cut pass only up
    to the cut."""
    drawn, block = F.array_max(ends), F.floor(F.col(position) / INNER)
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.col(passes)), lambda p: p * BLOCKS + block)
    return F.filter(every, lambda t: (t < drawn) & ((F.floor(t / BLOCKS) < F.col(passes)) | (F.col(position) <= F.col(cut))))


def _shard(ends: str, turn: Column) -> Column:
    return F.size(F.filter(ends, lambda e: e <= turn))


def source_plan(sized: DataFrame, weights: Sequence[int], share: float, most: float, shards: int, seed: int) -> DataFrame:
    """Per source: words, target, passes, cut (last position of the rest) and ends (blocks up to each shard)."""
    block = F.floor(F.col("position") / INNER)
    blocks = staged(sized.groupBy("key", block.alias("block")).agg(
        F.sum("size").alias("words"), F.max("source").alias("source")), "blocks")
    aims = staged(
        targets(blocks.groupBy("key").agg(F.sum("words").alias("words"), F.max("source").alias("source")), weights, share, most)
        .withColumn("passes", F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("words")), "targets")
    upto = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    opened = (
        blocks.select("key", "block", "words", F.sum("words").over(upto).alias("upto"))
        .join(aims.select("key", "rest"), "key").filter(F.col("upto") > F.col("rest"))
        .groupBy("key").agg(F.min(F.struct("block", (F.col("upto") - F.col("words")).alias("before"), "rest")).alias("o"))
        .select("key", "o.*")
    )
    inner = (
        sized.withColumn("block", block).join(opened, ["key", "block"])
        .groupBy("key", "block", "position", "before", "rest").agg(F.sum("size").alias("words"))
    )
    by_place = Window.partitionBy("key").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    half = F.col("before") + F.sum("words").over(by_place) - F.col("words") / 2
    inside = (
        inner.withColumn("half", half).filter((F.col("half") <= F.col("rest")) & (F.col("rest") > 0))
        .groupBy("key").agg(F.max("position").alias("inside"))
    )
    plan = staged(
        aims.join(opened.select("key", "block"), "key", "left").join(inside, "key", "left")
        # no block passes the rest only where the source has no words: nothing is taken then
        .withColumn("cut", F.when(F.col("rest") > 0, F.coalesce(F.col("inside"), F.col("block") * INNER - 1)).otherwise(-1).cast("long"))
        .withColumn("cut", F.coalesce("cut", F.lit(-1)))
        .withColumn("q", F.col("passes") * BLOCKS + F.ceil((F.col("cut") + 1) / INNER)), "source-plan")
    upto_shard = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        split_quotas(plan.select("key", "q"), shards, seed)
        .select("key", "shard", F.sum("q").over(upto_shard).alias("end"))
        .groupBy("key").agg(F.sort_array(F.collect_list("end")).alias("ends"))
    )
    return staged(plan.select("key", "source", "words", "weight", "target", "passes", "cut", "q").join(ends, "key"), "shard-plan")


def mixed_rows(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
               shards: int = 64, seed: int = 17) -> DataFrame:
    """The mix itself: every column of `docs`, once per copy taken, with mix_shard and mix_order.

    Texts are not shuffled: positions follow from the row, and only the plan of the sources is joined.
    """
    sized = docs.select(
        "source", _key().alias("key"), _position(seed).alias("position"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    plan = source_plan(staged(sized, "sizes"), weights, share, most, shards, seed)
    rows = docs.withColumns({"_mix_key": _key(), "_mix_position": _position(seed)})
    plan = plan.select(F.col("key").alias("_mix_key"), F.col("passes").alias("_mix_passes"), F.col("cut").alias("_mix_cut"), F.col("ends").alias("_mix_ends"))
    turns = _turns("_mix_position", "_mix_passes", "_mix_cut", "_mix_ends")
    out = rows.join(plan, "_mix_key").withColumn("_mix_turn", F.explode(turns))
    out = out.withColumns({
        "mix_shard": _shard("_mix_ends", F.col("_mix_turn")),
        "mix_order": F.xxhash64(F.lit(seed), "_mix_position", "_mix_turn", F.col("doc_id")),
    })
    return out.drop("_mix_key", "_mix_position", "_mix_passes", "_mix_cut", "_mix_ends", "_mix_turn")


def shuffled(mixed: DataFrame, shards: int = 64, pieces: int = 1) -> DataFrame:
    """The mix dealt by shard, rows in random order within each of a shard's `pieces`."""
    piece = F.pmod(F.col("mix_order"), F.lit(pieces))
    return mixed.repartition(shards * pieces, "mix_shard", piece).sortWithinPartitions("mix_shard", "mix_order")


def write_shards(mixed: DataFrame, folder: str, shards: int = 64, pieces: int = 1) -> None:
    """Write the mix, one folder per shard."""
    shuffled(mixed, shards, pieces).write.partitionBy("mix_shard").parquet(folder)


CHECK_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS k,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('17|' || coalesce('=' || source, '') || '|' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 6) AS BIGINT) AS position
  FROM documents),
sources AS (
  SELECT k, sum(size)::BIGINT AS words, 2.0::DOUBLE * sum(size) AS bound,
    CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY max(source) IS NULL, max(source)) - 1) % 3] AS DOUBLE) AS weight
  FROM sized GROUP BY k),
filled AS (
  SELECT *, row_number() OVER w AS place,
    (1.5::DOUBLE * sum(words) OVER () - (sum(bound) OVER (w ROWS UNBOUNDED PRECEDING) - bound))
      / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM sources WINDOW w AS (ORDER BY bound / weight, k = '', k)),
chosen AS (SELECT *, min(CASE WHEN rate * weight <= bound THEN place END) OVER () AS first FROM filled),
aims AS (
  SELECT *, coalesce(least(bound, max(CASE WHEN place = first THEN rate END) OVER () * weight), bound) AS target FROM chosen),
parted AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END AS passes FROM aims),
places AS (
  SELECT k, position, sum(size) AS here, sum(sum(size)) OVER (PARTITION BY k ORDER BY position) AS upto
  FROM sized GROUP BY k, position)
SELECT s.doc_id, s.size, a.words AS source_size, a.target,
  CAST(s.size * (a.passes + CASE WHEN a.target - a.passes * a.words > 0 AND p.upto - p.here / 2.0::DOUBLE <= a.target - a.passes * a.words
    THEN 1 ELSE 0 END) AS BIGINT) AS taken,
  CAST(a.passes + CASE WHEN a.target - a.passes * a.words > 0 AND p.upto - p.here / 2.0::DOUBLE <= a.target - a.passes * a.words
    THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM sized s JOIN parted a ON s.k = a.k JOIN places p ON s.k = p.k AND s.position = p.position
"""
