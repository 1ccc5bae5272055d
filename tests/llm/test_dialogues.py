"""Conversation repair against a search over all edits, row by row."""
import hashlib
import re
import zlib
from functools import lru_cache

from pyspark.sql import Row

from opsloom.llm import dialogues

BLANKS = " \t\n\x0b\x0c\r"


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        fault = ""
        if not text.strip(BLANKS):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif text.rstrip(BLANKS)[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def _cheapest(rows, faults):
    """(cost, audit, repaired rows) by trying every edit at every place; insertions up to two in a row."""
    shape = re.compile(r"(s?(ua)+)?\Z")
    could = re.compile(r"(s?(ua)*u?)?\Z")

    @lru_cache(None)
    def best(i, sofar, inserted):
        found = []
        if i == len(rows) and shape.match(sofar):
            found.append((0, "", ()))
        def then(cost, edit, row, i, sofar, inserted):
            if could.match(sofar):
                for c, a, r in [best(i, _short(sofar), inserted)]:
                    if c is not None:
                        found.append((cost + c, edit + a, ((row,) if row else ()) + r))
        if inserted < 2:
            for name in ("user", "assistant"):
                then(5, "I", (name, ""), i, sofar + name[0], inserted + 1)
        if i < len(rows):
            role, text = rows[i]
            then(2, "D", None, i + 1, sofar, 0)
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                if role[0] in "sua":
                    then(extra, "K", rows[i], i + 1, sofar + role[0], 0)
                for name in ("user", "assistant"):
                    then(extra + 1, "R", (name, text), i + 1, sofar + name[0], 0)
        return min(found, key=lambda f: f[:2]) if found else (None, "", ())

    def _short(sofar):  # whole pairs in the middle may go: they change nothing
        head = "s" if sofar[:1] == "s" else ""
        rest = sofar[len(head):]
        return head + (("uau" if len(rest) % 2 else "ua") if len(rest) > 2 else rest)

    return best(0, "", 0)


def _expected(rows):
    damaged, ids = [], []
    for conv, turn, role, text in rows:
        ids.append(conv)
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text, role = " " if text is None else text, " " if role is None else role
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        role = "user" if lot == 4 else role or " "
        damaged += [(conv, turn, role, text)] * (2 if lot == 3 else 1)
    out = {}
    for conv in set(ids):
        own = sorted((r for r in damaged if r[0] == conv),
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        pairs = [r[2:] for r in own]
        faults = _faults(pairs)
        cost, audit, kept = _cheapest(tuple(pairs), tuple(faults))
        turns = {r[1] for r in own if r[1] is not None}
        initials = [r[0][0] for r in pairs]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def _found(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_sample_against_all_edits(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = dialogues.damage_and_repair(_frame(spark, rows))
    assert result.columns == ["conv_id", *dialogues.COUNTS, "cost", "audit", "repaired_sha256"]
    assert _found(result) == _expected(rows)


def test_mixed_roles_faults_and_lengths(spark):
    import random

    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "uncle", None, ""]), rng.choice(["Hi.", "No", "", " \t", None, "So?", "x!\n", "Long. text"]))
            for c in range(150) for t in rng.sample(range(12), rng.randrange(1, 9))]
    assert _found(dialogues.damage_and_repair(_frame(spark, rows))) == _expected(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [(None, None, "user", "Hi."), (None, None, "user", "Hi."), (None, 3, None, None), (7, 1, "user", "a."), (7, 1, "assistant", "b."),
            (7, 1, "assistant", "b."), (7, None, "system", "c."), (8, None, "user", None), (9, 5, "assistant", "x" * 300_000)]
    frame = _frame(spark, rows).selectExpr("*", "'x' AS audit", "1 AS place", "2 AS kind")
    assert _found(dialogues.damage_and_repair(frame)) == _expected(rows)


def test_empty_table(spark):
    assert dialogues.damage_and_repair(_frame(spark, [])).collect() == []


def test_long_conversation_and_repaired_rows(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(5000)] + [(2, 0, "assistant", "Lost"), (3, 0, "tool", "Use.")]
    turns = _frame(spark, rows)
    audited = dialogues.audits(dialogues.signatures(turns)).cache()
    assert {r.conv_id: (r.cost, r.audit) for r in audited.collect()} == {1: (0, "K" * 5000), 2: (2, "D"), 3: (2, "D")}
    repaired = dialogues.repaired_turns(turns, audited)
    assert [(r.turn, r.text) for r in repaired.orderBy("turn").collect()] == [(t, f"turn {t}.") for t in range(5000)]
    assert all(isinstance(r, Row) and r.conv_id == 1 for r in repaired.collect())
    audited.unpersist()


def test_one_stack_for_shared_ends():
    automaton = dialogues.Automaton()
    words = sorted(w[::-1] for w in ("su", "ssu", "ua", "sua", "uaua", "xua", "Uo", ""))
    first = [automaton.read(w) for w in words]
    assert first == [dialogues.Automaton().read(w) for w in words]
    assert dict(zip(words, first))["au"] == (0, "KK")
