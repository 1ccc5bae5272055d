"""Every stage on what the stage before kept, against plain loops."""

import random
from collections import Counter

import numpy as np
from test_decontamination import distance_to_best_run
from test_mixing import plain as plain_mix
from test_tokens import expected as plain_tokens

import corpus_pipeline as cp
from opsloom.llm import languages as ln


def corpus(spark):
    rng = random.Random(12)
    tongues = {"en": "the of and house river walk green with stone", "de": "der die und haus fluss gehen mit stein auf"}
    prose = lambda lang, n: " ".join(rng.choice(tongues[lang].split()) + ("" if rng.random() < 0.3 else str(rng.randrange(60))) for _ in range(n))
    items = [(k, prose("en", 20)) for k in range(4)]
    rows = []
    for k in range(120):
        lang = "en" if k % 3 else "de"
        rows.append((k, prose(lang, rng.randrange(6, 90)), lang, f"s{k % 5}" if k % 7 else None))
    for k in range(120, 150):  # near and exact copies
        words = rows[k - 100][1].split()
        if k % 2 and len(words) > 60:
            words[30] = "other"
        rows.append((k, " ".join(words), rows[k - 100][2], "s1"))
    rows += [(200 + k, prose("en", 10) + " " + items[k][1].upper() + " " + prose("en", 9), "en", "s2") for k in range(4)]
    rows += [(300, None, "en", "s1"), (301, "", None, "s1"), (302, "12 34 %%", "en", "s2"), (303, "qqxz jjkv wwpq zzxq " * 30, None, None)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(items, "item_id long, text string")


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_stages_against_plain_loops(spark, tmp_path):
    docs, items = corpus(spark)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for name, stage in cp.STAGES[:-1]:
        before = kept.orderBy("doc_id").collect()
        after = stage(spark, kept, folder)
        assert after.columns == docs.columns
        rows = after.collect()
        if name == "language":
            told = {r.doc_id for r in ln.identify(ln.of_documents(kept), ln.trigram_model(kept)).collect() if r.accepted}
            assert {r.doc_id for r in rows} == told == {r.doc_id for r in before} - {300, 301, 302, 303}
        elif name == "near_copies":
            sets, group = {r.doc_id: shingles(r.text) for r in before}, {r.doc_id: r.doc_id for r in before}
            for a in sorted(sets):
                for b in sorted(sets):
                    if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        old, new = max(group[a], group[b]), min(group[a], group[b])
                        group = {k: new if g == old else g for k, g in group.items()}
            assert sorted(r.doc_id for r in rows) == sorted(set(group.values())) and len(rows) < len(before)
        elif name == "decontamination":
            known = [r.text.lower().split() for r in items.collect()]
            clean = [r.doc_id for r in before if all(distance_to_best_run(i, r.text.lower().split()) > len(i) // 5 for i in known)]
            assert sorted(r.doc_id for r in rows) == clean and len(clean) == len(before) - 4
        else:
            taken = {d: (size, t) for d, size, _, _, t in plain_mix([(r.doc_id, r.text, r.source) for r in before])}
            assert Counter(r.doc_id for r in rows) == Counter({d: t // size for d, (size, t) in taken.items() if t})
        after.write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
    got = sorted((tuple(r) for r in cp.STAGES[-1][1](spark, kept, folder).collect()), key=lambda r: r[1])
    assert got == [r[:4] for r in plain_tokens([(r.doc_id, r.text) for r in kept.collect()])]
    whole = sorted((tuple(r) for r in cp.run(spark, folder).collect()), key=lambda r: r[1])
    assert whole == got and np.sum([r[2] for r in whole]) > 0
