"""Targets and taken words against plain loops; the splitting tree against its invariants and mean."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from opsloom.llm import mixing as mx
from opsloom.llm.shared import shared_folder


def plain(rows, weights=(3, 1, 2), share=1.5, most=2.0, seed=17):
    sized = []
    for doc_id, text, source in rows:
        key = "" if source is None else "=" + source
        own = str(doc_id) if doc_id is not None else hashlib.md5((text or "").encode()).hexdigest()
        place = int(hashlib.md5(f"{seed}|{key}|{own}".encode()).hexdigest()[:6], 16)
        sized.append((doc_id, key, place, len(re.findall(r"[^ \t-\r]+", text or ""))))
    words = Counter()
    for _, key, _, n in sized:
        words[key] += n
    names = sorted(words, key=lambda k: (k == "", k))
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(words.values())
    while open_:
        rate = left / sum(weight[k] for k in open_)
        over = {k for k in open_ if rate * weight[k] > most * words[k]}
        for k in over or open_:
            target[k] = most * words[k] if over else rate * weight[k]
        if not over:
            break
        left -= sum(target[k] for k in over)
        open_ -= over
    at = defaultdict(int)
    for _, key, place, n in sized:
        at[key, place] += n
    chosen = set()
    for key in names:
        rest, upto = target[key] - (target[key] // words[key] * words[key] if words[key] else 0), 0
        for (_, place), n in sorted((kp, n) for kp, n in at.items() if kp[0] == key):
            if rest > 0 and upto + n / 2 <= rest:
                chosen.add((key, place))
            upto += n
    for doc_id, key, place, n in sized:
        passes = target[key] // words[key] if words[key] else 0
        yield doc_id, n, words[key], target[key], int(n * (passes + ((key, place) in chosen)))


ROWS = [
    [(k, "w " * (k % 17 + 1), f"s{k * k % 7}") for k in range(200)] + [(900, None, "s1"), (901, "", None), (902, "a b c", None), (903, "", "empty")],
    [], [(1, "", "a"), (2, None, "b")], [(1, "x y", "a")] * 5, [(None, "one two", "z"), (None, "three", "z"), (5, "a\x1cb\x0b c d", "é")],
    [(k, "word " * (5000 if k == 3 else 2), "big" if k % 3 else "small") for k in range(60)],
]


@pytest.mark.parametrize("rows", ROWS)
def test_mix_equals_plain_loop(spark, rows):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, key int")
    got = [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mx.mixture(docs, shards=8).collect()]
    near = lambda row: tuple(round(x, 6) if isinstance(x, float) else x for x in row)
    assert sorted(map(str, map(near, got))) == sorted(map(str, map(near, plain(rows))))
    assert all(r[4] <= 2 * r[1] for r in got)


def test_rows_and_shards(spark, tmp_path):
    docs = spark.createDataFrame([(*r, "extra") for r in ROWS[0]], "doc_id long, text string, source string, more string")
    mix, rows = mx.mixture(docs, shards=8).collect(), mx.mixed_rows(docs, shards=8)
    assert rows.columns == docs.columns + ["mix_shard", "mix_order"]
    dealt = Counter((r.doc_id, r.mix_shard) for r in rows.collect())
    assert dealt == Counter((r.doc_id, s) for r in mix for s in r.shards)
    folder = shared_folder(spark, "mix")
    mx.write_shards(rows, folder, 8)
    assert spark.read.parquet(folder).count() == sum(dealt.values())


def test_tree_uses_up_quotas_in_even_shards(spark):
    quotas = spark.createDataFrame([("a", 700), ("b", 0), ("c", 1), ("d", 323)], "key string, q long")
    left = Counter()
    for seed in range(40):
        tree = mx.split_quotas(quotas, 4, seed).collect()
        per_key, per_shard = Counter(), Counter()
        for r in tree:
            assert r.q >= 0
            per_key[r.key] += r.q
            per_shard[r.shard] += r.q
        assert per_key == Counter({"a": 700, "b": 0, "c": 1, "d": 323}) and set(per_shard.values()) == {256}
        left["a"] += sum(r.q for r in tree if r.key == "a" and r.shard < 2)
    # mean 350, standard deviation sqrt(512 * 700/1024 * 324/1024 * 512/1023) = 7.4; of 40 draws 1.2
    assert abs(left["a"] / 40 - 350) < 6


def test_reruns_agree(spark):
    docs = spark.createDataFrame([(*r,) for r in ROWS[0]], "doc_id long, text string, source string")
    one, two = (mx.mixture(docs.repartition(n)).select("doc_id", "taken", F.col("shards").cast("string")).collect() for n in (2, 5))
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_many_sources_are_split_in_groups(spark, monkeypatch):
    monkeypatch.setattr(mx, "GROUP", 4)
    quotas = spark.createDataFrame([(f"s{k}", (k * 37) % 90) for k in range(40)], "key string, q long")
    rows = mx.split_quotas(quotas, 8, 3).collect()
    total, by_shard, by_key = sum((k * 37) % 90 for k in range(40)), Counter(), Counter()
    for r in rows:
        assert r.q >= 0
        by_shard[r.shard] += r.q
        by_key[r.key] += r.q
    assert by_key == Counter({f"s{k}": (k * 37) % 90 for k in range(40)}) and sum(by_shard.values()) == total
    assert max(by_shard.values()) - min(by_shard.values()) <= 1
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, mx.split_quotas(quotas, 8, 3).collect()))
    counts = [sum(r.q for r in mx.split_quotas(spark.createDataFrame([("a", 30), *[(f"b{k}", 10) for k in range(9)]], "key string, q long"), 2, seed).collect()
                  if r.key == "a" and r.shard == 0) for seed in range(40)]
    assert 12 < sum(counts) / 40 < 18 and len(set(counts)) > 4  # 15 on average


def test_twenty_thousand_sources(spark):
    import time

    docs = spark.range(40_000).selectExpr("id AS doc_id", "concat('host', id % 20000) AS source", "repeat('w ', CAST(1 + id % 7 AS int)) AS text")
    start = time.time()
    mix = mx.mixture(docs, shards=16).agg(F.sum("taken").alias("t"), F.sum("size").alias("s"), F.max(F.col("taken") / F.col("size")).alias("most"),
                                          F.sum(F.when(F.col("taken") != F.col("size") * F.size("shards"), 1).otherwise(0)).alias("off"),
                                          F.min(F.array_min("shards")).alias("low"), F.max(F.array_max("shards")).alias("high")).first()
    assert time.time() - start < 120  # four partitions here
    assert mix.off == 0 and mix.most <= 2 and abs(mix.t / mix.s - 1.5) < 0.1 and (mix.low, mix.high) == (0, 15)


def test_leaves_of_the_tree_decide_what_is_taken(spark, monkeypatch):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "'one two three' AS text")
    whole = mx.mixture(docs, shards=4).agg(F.sum("taken")).first()[0]
    real = mx.split_quotas
    monkeypatch.setattr(mx, "split_quotas", lambda q, n, seed: real(q, n, seed).withColumn("q", F.when(F.col("shard") == 3, 0).otherwise(F.col("q"))))
    assert mx.mixture(docs, shards=4).agg(F.sum("taken")).first()[0] < 0.9 * whole


def test_shards_are_shuffled(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "'one two three' AS text")
    mixed = mx.mixed_rows(docs, shards=4)
    found = mx.shuffled(mixed, 4).withColumn("part", F.spark_partition_id()).collect()
    assert len({(r.part, r.mix_shard) for r in found}) == len({r.mix_shard for r in found}) == 4
    for shard in range(4):
        ids = [r.doc_id for r in found if r.mix_shard == shard]
        assert ids != sorted(ids)
