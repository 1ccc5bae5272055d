"""Repair of the role structure of conversations.

A conversation is legal when its role initials form (s?(ua)+)?: an optional system turn, then pairs of
user and assistant. Every conversation is written as a signature, one letter per row for its role and its
fault. Signatures are shared from their ends: equal remaining signatures are one node of an automaton, and
the cheapest cost to the end is worked out once per node and grammar state for all conversations
that pass through it.

Handling of special rows, for every function here: a null role or text counts as one space (so such a
text is blank, and such a role must be changed or deleted); an empty role counts as one space too; rows
without conv_id form one conversation; rows without turn come first. Rows of one turn stand by role, then by
the digest of their text, so equal rows are adjacent and the later ones are duplicates. Further columns are
ignored. An empty table gives an empty result. Texts may be of any length: they are only hashed and copied.

The audit of a conversation is one value of one row, and the SHA-256 of its repaired text is sequential, so
the last step reads a conversation in one task, as a sorted stream; of the rows it keeps one
letter each in memory. Duplicates, faults and the sorting are spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsloom.llm.shared import LOWEST, staged, tasks

BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, RETRUNCATED, REROLE = 2, 5, 5, 1
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
LEGAL = frozenset({"su", "ua", "au"})
#: grammar states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
NAMES = {"u": "user", "a": "assistant"}
#: letters of a range key: a longer signature is only sorted by all of it inside its task
KEY_LETTERS = 64


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) after damage, and `present`, false for dropped rows.

    The unsigned crc32 of `conv_id:turn` modulo 20 decides: 0 drops the row, 1 empties its text, 2 removes
    its `.`, `!` and `?`, 3 repeats it, 4 makes it a user turn. Nulls count as one space.
    """
    lot = F.crc32(F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn"))).cast("binary")) % 20
    text, role = _text(F.col("text")), _text(F.col("role"))
    rows = turns.select(
        "conv_id", "turn",
        F.when(lot == 4, "user").otherwise(role).alias("role"),
        F.when(lot == 1, "").when(lot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (lot != 0).alias("present"),
        F.explode(F.when(lot == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def _prepared(turns: DataFrame) -> DataFrame:
    role = _text(F.col("role"))
    return turns.select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(LOWEST)).alias("place"),
        F.when(role == "", " ").otherwise(role).alias("role"), _text(F.col("text")).alias("text")
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))


def signatures(turns: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, signature.

    `others` holds conv_ids that belong to the result even if `turns` has no row of them. The first fault of a
    row counts: blank, duplicate of an earlier row in role and text, truncated (its last character other than
    blanks is none of `.!?`). Letters of a signature: x for rows that must go, else s, u, a or o (any
    other initial), upper case where the row is truncated.
    """
    rows = _prepared(turns)
    trimmed = F.rtrim("text", F.lit(BLANKS))
    light = rows.select("conv_id", "place", "role", "digest", (trimmed == "").alias("blank"),
                        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    # few rows repeat: the earliest place of those that do is joined, a hot one is split by adaptive execution
    repeated = light.filter("not blank").groupBy("conv_id", "role", "digest").agg(
        F.min("place").alias("first"), F.count("*").alias("copies")).filter("copies > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    joined = light.join(repeated, light.conv_id.eqNullSafe(repeated.c) & (light.role == repeated.r) & (light.digest == repeated.d), "left")
    joined = joined.select("conv_id", "place", "role", "digest", "blank", "truncated", "first", F.lit(True).alias("present"))
    if others is not None:
        joined = joined.unionByName(others.select("conv_id").distinct().select(
            "conv_id", F.lit(LOWEST).alias("place"), F.lit(" ").alias("role"), F.lit(None).cast("binary").alias("digest"),
            F.lit(True).alias("blank"), F.lit(True).alias("truncated"), F.lit(None).cast("long").alias("first"),
            F.lit(False).alias("present")))
    kind = turns.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("signature", T.StringType())])
    dealt = joined.repartition(tasks(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "place", "role", "digest")
    return dealt.mapInArrow(_signed(_arrow(kind)), schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class _Tally:
    """Counts and letters of one conversation, row by row."""

    def __init__(self, conv):
        self.conv, self.letters = conv, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.before = self.row = None

    def add(self, place, role, digest, blank, truncated, first) -> None:
        initial = role[0]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        if place != LOWEST and place != self.high:
            self.turns += 1
            self.low = place if self.low is None else self.low
            self.high = place
        row = (place, role, digest)
        letter = initial if initial in "sua" else "o"
        if blank:
            self.blank, letter = self.blank + 1, "x"
        elif first is not None and (place > first or row == self.row):
            self.duplicate, letter = self.duplicate + 1, "x"
        elif truncated:
            self.truncated, letter = self.truncated + 1, letter.upper()
        self.row = row
        self.letters.append(ord(letter))

    def result(self) -> tuple:
        gaps = min(self.high - self.low + 1 - self.turns, 2**63 - 1) if self.turns else 0
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.letters.decode()


def _signed(kind: pa.DataType):
    names = ["conv_id", *COUNTS, "signature"]
    types = [kind, *[pa.int64()] * len(COUNTS), pa.string()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, done, letters = None, [], 0
        for batch in batches:
            for conv, *row, present in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns))):
                if tally is None or conv != tally.conv:
                    if tally is not None:
                        done.append(tally.result())
                        letters += len(tally.letters) + 100
                    tally = _Tally(conv)
                if present:
                    tally.add(*row)
            if letters > 1 << 22:
                yield table(done)
                done, letters = [], 0
        if tally is not None:
            yield table([*done, tally.result()])

    return run


class Automaton:
    """The nodes on the way from the end of the present signature to its start.

    Signatures come in the order of their reversed letters; what two neighbours share from the end
    stays on the stack, so a node is worked out once. A node holds, per grammar state, the cheapest cost to the
    end and the first edit of the ASCII-least cheapest audit; the edits of one node and state differ in their
    letters, so the least letter at each step gives the least audit. Nodes whose costs differ by a constant
    share one entry of `known`.
    """

    def __init__(self):
        self.known: dict[tuple, tuple] = {}
        self.letters = ""
        costs, edits = self._closed((0, None, None, 0), [(), (), (), ()])
        self.costs, self.edits = [costs], [edits]
        self.last: tuple[int, str] | None = None

    @staticmethod
    def _closed(base, options) -> tuple[tuple, tuple]:
        """Add insertions to the costs without one; keep the least letter among the cheapest."""
        far = 10**9
        base = [far if b is None else b for b in base]
        costs = list(base)
        costs[2], costs[3] = min(base[2], INSERT + base[3]), min(base[3], INSERT + base[2])
        costs[0], costs[1] = min(base[0], INSERT + costs[2]), min(base[1], INSERT + costs[2])
        edits = []
        for state in range(4):
            after = AFTER[WANTED[state]][state]
            ways = [(letter, to) for cost, letter, to in options[state] if cost == costs[state]]
            if INSERT + costs[after] == costs[state]:
                ways.append(("I", after))
            edits.append(min(ways) if ways else None)
        return tuple(costs), tuple(edits)

    def _node(self, letter: str, below: tuple) -> tuple[tuple, tuple]:
        lowest = min(below)
        key = (letter, *(c - lowest for c in below))
        if key not in self.known:
            options = []
            for state in range(4):
                ways = [(DELETE + key[1 + state], "D", state)]
                if letter != "x":
                    extra = RETRUNCATED if letter.isupper() else 0
                    if state in AFTER.get(letter.lower(), {}):
                        to = AFTER[letter.lower()][state]
                        ways.append((extra + key[1 + to], "K", to))
                    to = AFTER[WANTED[state]][state]
                    ways.append((REROLE + extra + key[1 + to], "R", to))
                options.append(ways)
            self.known[key] = self._closed([min(w)[0] for w in options], options)
        costs, edits = self.known[key]
        return tuple(c + lowest for c in costs), edits

    def read(self, reverse: str) -> tuple[int, str]:
        """Cost and audit of a signature given from its end."""
        if reverse == self.letters and self.last:
            return self.last
        shared = sum(1 for _ in takewhile(lambda p: p[0] == p[1], zip(reverse, self.letters)))
        del self.costs[shared + 1:], self.edits[shared + 1:]
        for letter in reverse[shared:]:
            costs, edits = self._node(letter, self.costs[-1])
            self.costs.append(costs)
            self.edits.append(edits)
        self.letters = reverse
        audit, depth, state = [], len(reverse), 0
        while (edit := self.edits[depth][state]) is not None:
            audit.append(edit[0])
            state = edit[1]
            depth -= edit[0] != "I"
        self.last = self.costs[-1][0], "".join(audit)
        return self.last


def audits(signed: DataFrame) -> DataFrame:
    """Add cost and audit to the rows of `signatures`.

    Rows are dealt by ranges of their reversed signatures, so conversations that end alike meet in one
    task; a signature that very many conversations share is split over several by conv_id.
    """
    spark = signed.sparkSession
    rows = signed.withColumn("reverse", F.reverse("signature")).drop("signature")
    dealt = rows.repartitionByRange(tasks(spark), F.substring("reverse", 1, KEY_LETTERS), F.xxhash64("conv_id"))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "reverse"])
    schema = schema.add("cost", T.LongType()).add("audit", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            found = [automaton.read(r) for r in batch.column("reverse").to_pylist()]
            kept = batch.select([f.name for f in schema.fields if f.name not in ("cost", "audit")])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                names=schema.fieldNames())

    return dealt.sortWithinPartitions("reverse").mapInArrow(run, schema)


def _edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Roles and texts after the edits of an audit; reads `rows` as it goes."""
    state = 0
    for edit in audit:
        if edit == "I":
            name, text = NAMES[WANTED[state]], ""
        else:
            name, text = next(rows)
            if edit == "D":
                continue
            if edit == "R":
                name = NAMES[WANTED[state]]
        state = AFTER[name[0]][state]
        yield name, text


def _followed(batches: Iterator[pa.RecordBatch], results: list[str]) -> Iterator[tuple[tuple, Iterator]]:
    """(result columns, repaired rows) per conversation of a stream sorted by (conv_id, kind, ...)."""

    def stream():
        for batch in batches:
            columns = batch.select(["kind", "role", "text"]).to_pydict()
            heads = batch.select(results)
            for k, (kind, role, text) in enumerate(zip(columns["kind"], columns["role"], columns["text"])):
                if kind == 0:
                    yield 0, tuple(heads.column(c)[k].as_py() for c in results), None
                else:
                    yield 1, role, text

    rows = stream()
    head = next(rows, None)
    while head is not None:
        following = [None]

        def turns():
            for row in rows:
                if row[0] == 0:
                    following[0] = row
                    return
                yield row[1], row[2]

        own = turns()
        result = head[1]
        yield result, _edited(result[results.index("audit")], own)
        for _ in own:  # rows after the last edit: none, unless the reader stopped early
            pass
        head = following[0]


def _together(turns: DataFrame, audited: DataFrame) -> tuple[DataFrame, list[str]]:
    results = audited.columns
    heads = audited.select(*results, F.lit(0).alias("kind"), F.lit(LOWEST).alias("place"), F.lit("").alias("role"),
                           F.lit("").alias("text"), F.lit(None).cast("binary").alias("digest"))
    rows = _prepared(turns).withColumn("kind", F.lit(1))
    both = heads.unionByName(rows, allowMissingColumns=True)
    dealt = both.repartition(tasks(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "kind", "place", "role", "digest")
    return dealt.select("kind", "role", "text", *results), results


def repaired_turns(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired rows themselves: conv_id, turn (0, 1, ... anew), role, text. `audited` comes from `audits`."""
    dealt, results = _together(turns, audited)
    kind = turns.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("turn", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    arrow = pa.schema([("conv_id", _arrow(kind)), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for result, rows in _followed(batches, results):
            for turn, (role, text) in enumerate(rows):
                out.append({"conv_id": result[0], "turn": turn, "role": role, "text": text})
                size += len(text) + 50
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return dealt.mapInArrow(run, schema)


def repair_digests(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """The rows of `audited` and repaired_sha256 of the repaired `role:text` lines, joined by newlines."""
    dealt, results = _together(turns, audited)
    schema = T.StructType([*audited.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    types = [_arrow(f.dataType) for f in schema.fields]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for result, rows in _followed(batches, results):
            digest, between = hashlib.sha256(), b""
            for role, text in rows:
                digest.update(between + role.encode() + b":")
                digest.update(text.encode())
                between = b"\n"
            done.append((*result, digest.hexdigest()))
            if len(done) >= 4096:
                yield table(done)
                done = []
        if done:
            yield table(done)

    return dealt.mapInArrow(run, schema)


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """Damage every row by its crc32, then repair: one row per original conv_id."""
    rows = damaged(conversations)
    turns, dropped = rows.filter("present").drop("present"), rows.filter("not present")
    signed = staged(signatures(turns, dropped), "signatures")
    return repair_digests(turns, audits(signed))
