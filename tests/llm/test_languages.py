"""Language decisions on the sample tables, against a plain Bayes formula, and on edge rows."""

import math
import random
import re
from collections import Counter

import numpy as np

from opsloom.llm import languages as ln
from opsloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_sample_tables(spark):
    got = QUERIES["op4_language_id"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").count()
    assert sum(r.kind == "document" for r in got) == len(docs) and sum(r.kind == "page" for r in got) == pages
    own = [r for r in got if r.kind == "document"]
    assert np.mean([r.language == docs[r.doc_id].lang for r in own]) > 0.97
    labels = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1}
    assert all(r.accepted for r in own if r.doc_id in labels)
    assert np.mean([r.language == r.declared for r in got if r.kind == "page"]) > 0.9


def test_trigrams_stay_in_rows():
    raw = "The catÉ..12 x".encode()
    bins, row = ln.trigrams(np.frombuffer(raw * 2, np.uint8), np.array([0, len(raw), 2 * len(raw)]))
    alone, _ = ln.trigrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert bins[row == 0].tolist() == alone.tolist() == bins[row == 1].tolist()
    assert len(ln.trigrams(np.frombuffer(b"12 34", np.uint8), np.array([0, 5]))[0]) == 0


def test_edges_and_fusion(spark):
    train = spark.createDataFrame(
        [(k, "the house and the river of this town", "en", "a.example.com") for k in range(30)]
        + [(50 + k, "der fluss und das haus in dieser stadt", "DE", "b.example.de") for k in range(30)], "doc_id long, text string, lang string, source string")
    model = ln.trigram_model(train)
    rows = train.unionByName(spark.createDataFrame([
        (100, None, "en", "a.example.com"), (101, "", None, None), (102, "12 $$", "de", "x"), (103, "the town", None, None),
        (104, "xq", "de", "b.example.de"), (104, "xq", "de", "b.example.de"), (None, "und das haus", "en-US", ""), (106, "zzqx kkvw jjpq " * 40, None, None),
    ], train.schema))
    got = {}
    for r in ln.identify(ln.of_documents(rows), model).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [got[k][0].language for k in (100, 101, 102, 103, None, 106)] == ["und", "und", "und", "en", "de", "und"]
    assert len(got[104]) == 2 and got[104][0].language == "de" and not got[106][0].accepted and got[None][0].accepted
    kept = ln.accepted_documents(rows.selectExpr("*", "1 AS _extra", "'q' AS declared"))
    assert sorted(str(r.doc_id) for r in kept.collect() if r.doc_id is None or r.doc_id >= 100) == ["103", "104", "104", "None"]
    assert ln.accepted_documents(rows.limit(0)).count() == 0
    assert math.isclose(got[100][0].probability, 1.0)


def plain_bayes(docs, rows):
    """(language, probability) of each row, by the formula of the module's description, with plain loops."""
    tag = lambda x: (re.match(r" *([A-Za-z]+)", x or "") or ["", ""])[1].lower()
    code = lambda b: b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32

    def bins(text):
        raw = [code(b) for b in (text or "").encode()]
        for a, b, c in zip(raw, raw[1:], raw[2:]):
            if (a, b, c) != (32, 32, 32):
                yield ((a | b << 8 | c << 16) * 0x9E3779B97F4A7C15 % 2**64) >> 64 - ln.BITS

    declared = Counter(tag(d[2]) for d in docs if d[1] is not None)
    langs = sorted((t for t in declared if 2 <= len(t) <= 3 and t not in ln.NO_LANGUAGE), key=lambda t: (-declared[t], t))
    trained = {c: Counter(b for d in docs if tag(d[2]) == c for b in bins(d[1])) for c in langs}
    mass = {c: sum(trained[c].values()) + 0.5 * (1 << ln.BITS) for c in langs}

    def text_logs(text):
        found = list(bins(text))
        scale = min(len(found), ln.EVIDENCE) / max(len(found), 1)
        return [scale * sum(math.log((trained[c][b] + 0.5) / mass[c]) for b in found) for c in langs] + [-scale * len(found) * ln.BITS * math.log(2)]

    split = lambda h: (h, ".".join(h.split(".")[-2:]), h.split(".")[-1] if "." in h else None) if h else (None, None, None)
    seen = []
    for _, text, said, host in rows:
        logs = text_logs(text) if any(code(b) != 32 for b in (text or "").encode()) else None
        said = tag(said) and (tag(said) if tag(said) in langs else "other")
        seen.append((logs, said or None, *split((host or "").lower())))
    first = [(langs[s[0].index(max(s[0]))], *s[1:]) for s in seen if s[0] and max(s[0]) > s[0][-1]]
    n = lambda c, k, key: sum(f[0] == c and f[k] == key for f in first)
    share = {c: (sum(f[0] == c for f in first) + 1) / (len(first) + len(langs)) for c in langs}
    smooth = lambda k, key, prior: {c: (n(c, k, key) + ln.SMOOTHING * prior[c]) / (sum(n(x, k, key) for x in langs) + ln.SMOOTHING) for c in langs}
    suffixes = {f[4] for f in first if f[4]}
    for logs, said, host, domain, suffix in seen:
        if logs is None:
            yield "und", 1.0
            continue
        known = any(f[2] == host for f in first) if host else False
        prior = smooth(2, host, smooth(3, domain, share)) if known else share
        out = []
        for k, c in enumerate(langs):
            value = logs[k] + math.log(prior[c] * (1 - ln.UND_PRIOR))
            if said:
                value += math.log((n(c, 1, said) + 1) / (sum(f[0] == c and f[1] is not None for f in first) + len(langs) + 1))
            if suffix in suffixes:
                value += math.log((n(c, 4, suffix) + 1) / (sum(f[0] == c and f[4] is not None for f in first) + len(suffixes)))
            out.append(value)
        out.append(logs[-1] + math.log(ln.UND_PRIOR) - (math.log(len(langs) + 1) if said else 0) - (math.log(len(suffixes)) if suffix in suffixes else 0))
        best = max(out)
        yield [*langs, "und"][out.index(best)], 1 / sum(math.exp(x - best) for x in out)


PHRASES = {
    "en": "the house and the river of this town are old", "de": "der fluss und das haus in dieser stadt sind alt", "pt": "a casa e o rio desta cidade são muito antigos",
    "fil": "ang bahay at ang ilog ng bayang ito ay luma na", "pl": "dom i rzeka w tym mieście są bardzo stare",
}


def test_plain_formula_over_declared_languages(spark):
    rng, rows = random.Random(5), []
    for k in range(150):
        c = rng.choice(list(PHRASES))
        words = PHRASES[c].split()
        text = " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 12, 60])))
        said = rng.choice([c, c, c, c.upper() + "-XX", None, "und", "klingon", rng.choice(list(PHRASES))])
        rows.append((k, text, said, rng.choice([f"www.a.{c}", f"b.{c}", f"{c}.shared.org", "hub.shared.org", "plain", None, ""])))
    rows += [(200, None, "en", "b.en"), (201, "", "mul", None), (202, "17 $ 4", "de", "b.de"), (203, "q", None, "new.example.net"), (203, "q", None, "new.example.net"),
             (204, "zzqx kkvw jjpq " * 40, "zxx", "b.pl"), (205, "der fluss " * 20_000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = ln.trigram_model(docs)
    assert set(model.languages) == set(PHRASES)
    got = sorted((r.doc_id, r.language, r.probability) for r in ln.identify(ln.of_documents(docs), model).collect())
    plain = sorted((r[0], c, p) for r, (c, p) in zip(rows, plain_bayes(rows, rows)))
    assert [g[:2] for g in got] == [p[:2] for p in plain]
    assert np.allclose([g[2] for g in got], [p[2] for p in plain], atol=1e-3)  # logarithms are kept in 32 bits
    assert {c for _, c, _ in got} >= set(PHRASES) | {"und"}


def test_no_languages_and_no_pages(spark):
    docs = spark.createDataFrame([(1, "the town", None, "x"), (2, "der fluss", "und", None), (3, None, "en", "y")], "doc_id long, text string, lang string, source string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    got = ln.identified(docs, pages).collect()
    assert [(r.language, r.accepted) for r in got] == [("und", False)] * 3 and ln.accepted_documents(docs).count() == 0
