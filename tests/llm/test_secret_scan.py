"""Secret scan: patterns against plain regular expressions, models against a plain Markov chain and held-out strings."""
import hashlib
import math
import random
import re
import string
from collections import defaultdict

import numpy as np

from opsloom.llm import secret_scan as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


PARTS = ["get", "set", "user", "response", "header", "value", "internal", "count", "parse", "buffer", "index", "Manager", "Handler", "config", "service", "stream"]


def _ordinary(made):
    words = [made.choice(PARTS) for _ in range(made.randrange(3, 6))]
    return made.choice(["_", "-", ""]).join(words) if made.random() < 0.6 else "".join(w.title() for w in words)


def _base(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


def _free(text, least):
    base = _base(text)
    return [m.span() for m in re.finditer(r"[A-Za-z0-9+/_-]+", text) if len(m.group()) >= least and all(m.end() <= a or b <= m.start() for _, a, b in base)]


def _plain_model(texts):
    """log P(random) - log P(ordinary) of a string, by dictionaries."""
    counts = [[defaultdict(lambda: defaultdict(int)) for _ in range(3)] for _ in range(2)]
    triples = [defaultdict(int), defaultdict(int)]

    def add(label, run):
        for k, c in enumerate(run):
            triples[label][(run[k - 2] if k > 1 else "^") + (run[k - 1] if k else "^") + c] += 1

    once = set()
    for text in texts:
        for a, b in _free(text, S.ORDINARY_LEAST):
            if re.search("[0-9][^0-9]", text[a:b]):
                continue
            if b - a >= 16:
                once.add((0, text[a:b]))
            else:
                add(0, text[a:b])
        covered = set()
        cuts = set()
        for m in ASSIGN.finditer(text):
            if len(m.group(2)) >= 12:
                covered |= set(range(*m.span(2)))
                cuts |= set(m.span(2))
        for kind, a, b in _base(text):
            if kind != "assign":
                covered |= set(range(a, b))
                cuts |= {a, b}
        run = ""
        for k in range(len(text) + 1):
            if k == len(text) or k in cuts or k not in covered or text[k] not in S.SYMBOLS:
                if len(run) >= 2:
                    once.add((1, run))
                run = ""
            if k < len(text) and k in covered and text[k] in S.SYMBOLS:
                run += text[k]

    for label, run in once:
        add(label, run)

    for label, seen in enumerate(triples):
        for triple, n in seen.items():
            for order in range(3):
                counts[label][order][triple[2 - order:2]][triple[2]] += n if label else n - 1

    def p(label, context, c, order=2):
        below = 1 / 66 if order == 0 else p(label, context[1:] if order == 2 else "", c, order - 1)
        own = counts[label][order][context]
        return (own[c] + S.SMOOTHING * below) / (sum(own.values()) + S.SMOOTHING)

    def ratio(run):
        out = 0.0
        for k, c in enumerate(run):
            context = (run[k - 2] if k > 1 else "^") + (run[k - 1] if k else "^")
            out += math.log((1 - S.UNIFORM_SHARE) * p(1, context, c) + S.UNIFORM_SHARE / 66) - math.log(p(0, context, c))
        return out

    return ratio


def _expected(rows):
    ratio = _plain_model([t for _, t in rows if t])
    out = []
    for doc_id, text in rows:
        text = text or ""
        base = _base(text)
        scored = [(("random", a, b), ratio(text[a:b])) for a, b in _free(text, 16)]
        assert all(abs(r - S.THRESHOLD) > 1e-3 for _, r in scored)
        spans = sorted(base + [s for s, r in scored if r >= S.THRESHOLD], key=lambda s: (s[1], S.KINDS.index(s[0])))
        write = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
        out.append((doc_id, *(sum(s[0] == k for s in base) for k in S.KINDS[:3]), hashlib.sha256(write(base).encode()).hexdigest(), write(spans)))
    return sorted(out, key=str)


def _found(df):
    assert df.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_sample_against_plain_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert _found(S.secret_report(docs)) == _expected([tuple(r) for r in docs.collect()])


def test_patterns_and_special_rows(spark):
    made = random.Random(2)
    blob = "".join(made.choice(string.ascii_letters + string.digits) for _ in range(40))
    rows = [
        (1, "Token: abcdefghijkl API_KEY='x.y=z/0123456789' password=short secret: api_key: abcdefghijklmnop"),
        (2, "é AKIAABCDEFGHIJKLMN é AKIAAKIAABCDEFGHI AKIAABC " + "deadbeef" * 3), (3, None), (3, ""), (None, "toKen = \"0123456789abcdef0123\" ü"),
        (4, f"internal_user_config parseHeaderValue {blob} next"), (4, f"internal_user_config parseHeaderValue {blob} next"),
        (5, "ſecret=abcdefghijklmnop paſſword=abcdefghijklmnop toKen=abcdefghijklmnop"), (6, "word " * 400_000 + "0123456789abcdef" * 2),
    ] + [(10 + k, " ".join(_ordinary(made) for _ in range(200))) for k in range(30)]
    frame = _frame(spark, rows).selectExpr("*", "'x' AS spans", "1 AS label", "2 AS n")
    found = _found(S.secret_report(frame))
    assert found == _expected(rows)
    assert any("random" in r[-1] for r in found if r[0] == 4) and not any("random" in r[-1] for r in found if (r[0] or 0) >= 10)
    assert S.secret_report(_frame(spark, [])).collect() == []


def test_labelled_samples_tell_held_out_strings(spark):
    made = random.Random(3)
    def blob():
        kind = made.choice([string.hexdigits.lower()[:16], string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, string.ascii_letters + string.digits + "+/"])
        return "".join(made.choice(kind) for _ in range(made.randrange(20, 41)))

    samples = spark.createDataFrame([(_ordinary(made), 0) for _ in range(600)] + [(blob(), 1) for _ in range(600)] + [("unlabelled", None), (None, 1)], "text string, label int")
    ratio = S.fit(S.counts_from_samples(samples))
    held = [(k, _ordinary(made) + "Value", 0) for k in range(300)] + [(300 + k, blob(), 1) for k in range(300)]
    found = {r.doc_id: r.spans for r in S.scan(spark.createDataFrame(held, "doc_id long, text string, label int"), ratio).collect()}
    caught = [bool(found[k]) == bool(label) for k, text, label in held if len(text) >= 16]
    assert np.mean(caught) > 0.98
