"""Language of a text by Bayesian fusion of several kinds of evidence.

The languages are those that the table itself declares: primary tags of two or three letters, but for
those that name no single language. What a task holds grows with their number (64 kB each), not with
the rows; tags of other forms are no languages.

- text: naive Bayes over hashed byte trigrams, counted over all documents with a declared language;
  at most 60 trigrams' worth of evidence, because neighbouring trigrams depend on each other
- declared markup language (`lang`): how often texts of a language declare it, from the table itself
- address suffix (last label of the host): how often texts of a language stand under it
- host prior: shares of languages per host, smoothed with those of its domain (last two labels), and
  these with those of the whole table

The class `und` (none of the languages) has an even trigram distribution, a small prior and says
nothing about the other evidence. A row is accepted if a language is likelier than `und` and all
others together. Missing evidence changes nothing; a row without any letter is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.arrays import U, slices
from opsloom.llm.shared import staged
from opsloom.sources.tables import page_text

#: tags for texts without a language, of several, of none that has a code, or not told
NO_LANGUAGE = ("und", "mul", "mis", "zxx")
BITS, EVIDENCE, UND_PRIOR, SMOOTHING = 14, 60, 0.01, 20.0

# letters in lower case; everything else in ASCII is a blank
_LETTER = np.zeros(256, np.uint8) + 32
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the byte trigrams that hold a letter and do not cross rows, and the row of each."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = _LETTER[data].astype(U)
    value = code[:-2] | code[1:-1] << U(8) | code[2:] << U(16)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = (value != U(0x202020)) & (row[:-2] == row[2:])
    bins = (value[keep] * U(0x9E3779B97F4A7C15)) >> U(64 - BITS)
    return bins.astype(np.int64), row[:-2][keep]


def _tag(col: Column) -> Column:
    """Primary part of a language tag, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.trim(col), r"^([A-Za-z]+)", 1)), F.lit(""))


def declared_languages(docs: DataFrame) -> list[str]:
    """The languages that rows of a table declare, most rows first, then by name."""
    tags = docs.filter(F.col("text").isNotNull()).groupBy(_tag(F.col("lang").cast("string")).alias("tag")).agg(F.count(F.lit(1)).alias("n"))
    wanted = tags.filter(F.length("tag").between(2, 3) & ~F.col("tag").isin(*NO_LANGUAGE))
    return [r["tag"] for r in wanted.orderBy(F.desc("n"), "tag").collect()]  # at most the tags of two or three letters


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # log probabilities (language, bin)


def trigram_model(docs: DataFrame) -> Model:
    """Log probabilities from all rows that declare a language."""
    languages = declared_languages(docs)
    if not languages:
        return Model([], np.zeros((0, 1 << BITS), np.float32))
    place = F.array_position(F.lit(languages), _tag(F.col("lang").cast("string"))) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), 1 << BITS), np.int64)
        for batch in batches:
            labels = np.asarray(batch.column(0))
            for first, data, offsets in slices(batch.column(1)):
                bins, row = trigrams(data, offsets)
                counts += np.bincount(labels[first + row] << BITS | bins, minlength=counts.size).reshape(counts.shape)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"cell": used, "n": counts.reshape(-1)[used]})

    rows = docs.select(place.cast("long").alias("place"), F.col("text").cast("string").alias("text")).filter("place >= 0")
    cells = rows.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # languages x bins at most
    counts = np.full(len(languages) << BITS, 0.5)
    for r in cells:
        counts[r["cell"]] += r["n"]
    counts = counts.reshape(len(languages), -1)
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    logs[counts.max(axis=1) < 1] -= 1  # a language without any text must not win by its other evidence alone
    return Model(languages, logs.astype(np.float32))


def text_evidence(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """Replace the column `text` by `evidence`: tempered log likelihoods of the languages and `und`; null without letters."""
    table = np.concatenate([model, np.full((1, model.shape[1]), -BITS * np.log(2), np.float32)])
    kept = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text") + ", evidence array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in slices(batch.column(rows_text)):
                bins, row = trigrams(data, offsets)
                n = len(offsets) - 1
                seen = np.bincount(row, minlength=n)
                scale = np.minimum(seen, EVIDENCE) / np.maximum(seen, 1)
                sums = np.stack([np.bincount(row, weights=logs[bins], minlength=n) * scale for logs in table], 1)
                letters = np.concatenate([[0], np.cumsum(_LETTER[data] != 32)])[offsets]
                told = (np.diff(letters) > 0).tolist()  # a letter or two without a trigram leave all languages even
                values = pa.array([s if k else None for s, k in zip(sums.tolist(), told)], pa.list_(pa.float64()))
                own = [batch.column(c).slice(first, n) for c in kept_places]
                yield pa.RecordBatch.from_arrays(own + [values], kept + ["evidence"])

    rows_text = rows.columns.index("text")
    kept_places = [k for k, c in enumerate(rows.columns) if c != "text"]
    return rows.mapInArrow(run, schema)


def _known(col: Column, languages: Sequence[str]) -> Column:
    """Primary part of a language tag if it is one of the languages, else `other`; null if empty."""
    tag = _tag(col)
    return F.when(F.length(tag) == 0, None).when(F.array_contains(F.lit(list(languages)), tag), tag).otherwise("other")


def _doubles(values) -> Column:
    return F.lit([float(v) for v in values]).cast("array<double>")


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """Add language, probability and accepted to rows (ids..., text, declared, host); drops the text.

    Hosts are split at dots; a host without dots is its own domain and has no suffix. Null and empty texts, and
    all texts where there are no languages, are `und`; ties go to the language that more rows declare;
    repeated rows give repeated rows, further columns stay (but none called text, declared, host).
    """
    languages, size = model.languages, len(model.languages)
    classes = [*languages, "und"]
    labels = F.split(F.lower("host"), r"\.")
    dotted = F.size(labels) >= 2
    keyed = rows.withColumns({
        "declared": _known(F.col("declared"), languages),
        "host": F.when(F.length("host") > 0, F.lower("host")),
        "domain": F.when(dotted, F.concat_ws(".", F.slice(labels, -2, 2))).when(F.length("host") > 0, F.lower("host")),
        "suffix": F.when(dotted, F.element_at(labels, -1)),
    })
    scored = text_evidence(keyed, model.logs)
    best = F.array_position("evidence", F.array_max("evidence")).cast("int") - 1
    scored = staged(scored.withColumn("best", best), "evidence")
    if not languages:
        return scored.select(*[c for c in rows.columns if c not in ("text", "declared", "host")], F.lit("und").alias("language"),
                             F.lit(1.0).alias("probability"), "declared", "host", F.lit(False).alias("accepted"))
    # a text that fits no language better than `und` (a letter or two) says nothing about its host
    telling = F.array_max("evidence") > F.get("evidence", F.lit(size))
    cells = staged(scored.filter(telling).groupBy("declared", "host", "domain", "suffix", "best").agg(
        F.count(F.lit(1)).alias("n")), "language-counts")

    def counts(*by: str) -> DataFrame:
        """Rows per language as an array, for each known key."""
        one = cells.filter(F.col(by[0]).isNotNull()).groupBy(*by, "best").agg(F.sum("n").cast("double").alias("n"))
        held = one.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("m"))  # an entry for each language
        return held.select(*by, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.coalesce(F.try_element_at("m", k), F.lit(0.0))).alias("n"))

    def smoothed(n: str, prior: Column) -> Column:
        total = F.aggregate(n, F.lit(0.0), lambda t, x: t + x) + SMOOTHING
        return F.transform(F.arrays_zip(F.col(n).alias("n"), prior.alias("p")), lambda x: (x["n"] + SMOOTHING * x["p"]) / total)

    # (languages + 1) x languages rows at most
    said = {(r["declared"], r["best"]): r["n"] for r in cells.groupBy("declared", "best").agg(F.sum("n").alias("n")).collect()}
    overall = np.zeros(size)
    tags = {t: np.ones(size) for t in [*languages, "other"]}
    for (tag, k), n in said.items():
        overall[k] += n
        if tag is not None:
            tags[tag][k] += n
    share = (overall + 1) / (overall.sum() + size)
    known = sum(tags.values())
    said_logs = rows.sparkSession.createDataFrame(  # a row for each language
        [(t, [float(x) for x in np.log(n / known)]) for t, n in tags.items()], "declared string, said array<double>")

    domains = counts("domain").select("domain", smoothed("n", _doubles(share)).alias("p_domain"))
    hosts = counts("host", "domain").join(domains, "domain").select("host", smoothed("n", F.col("p_domain")).alias("p_host"))
    hosts = staged(hosts, "hosts")
    suffixes = counts("suffix")
    kinds = suffixes.count()
    per_language = np.full(size, float(kinds))
    for r in cells.filter(F.col("suffix").isNotNull()).groupBy("best").agg(F.sum("n").alias("n")).collect():  # a row for each language
        per_language[r["best"]] += r["n"]
    suffixes = staged(suffixes.select("suffix", F.transform(
        F.arrays_zip("n", _doubles(per_language).alias("all")), lambda x: F.log((x["n"] + 1) / x["all"])).alias("s_host")), "suffixes")

    # ids and numbers only; a host with a third of all rows is split by adaptive execution unless its table is small
    joined = (scored.join(hosts, "host", "left").join(suffixes, "suffix", "left").join(F.broadcast(said_logs), "declared", "left"))
    none = F.lit([0.0] * size).cast("array<double>")
    parts = F.arrays_zip(
        F.slice("evidence", 1, size).alias("text"), F.coalesce("p_host", _doubles(share)).alias("host"),
        F.coalesce("said", none).alias("said"), F.coalesce("s_host", none).alias("suffix"))
    told = F.transform(parts, lambda x: F.log(x["host"] * (1 - UND_PRIOR)) + x["said"] + x["suffix"] + x["text"])
    und = (F.get("evidence", F.lit(size)) + float(np.log(UND_PRIOR)) + F.when(F.col("said").isNotNull(), -float(np.log(size + 1))).otherwise(0.0)
           + F.when(F.col("s_host").isNotNull(), -float(np.log(max(1, kinds)))).otherwise(0.0))
    out = joined.withColumn("logs", F.concat(told, F.array(und)))
    out = out.withColumn("top", F.array_max("logs")).withColumn(
        "probability", 1 / F.aggregate("logs", F.lit(0.0), lambda t, x: t + F.exp(x - F.col("top"))))
    language = F.get(F.lit(classes), F.array_position("logs", F.col("top")).cast("int") - 1)
    kept = [c for c in rows.columns if c not in ("text", "declared", "host")]
    return out.select(
        *kept, F.when(F.col("evidence").isNull(), "und").otherwise(language).alias("language"),
        F.when(F.col("evidence").isNull(), 1.0).otherwise(F.col("probability")).alias("probability"),
        "declared", "host",
    ).withColumn("accepted", (F.col("language") != "und") & (F.col("probability") >= 0.5))


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as evidence rows: lang is the declared language, source the host."""
    return docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"),
                       F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("declared"), F.col("source").cast("string").alias("host"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Pages as evidence rows: visible text, language of the html element, host of the address."""
    return pages.select(
        F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"),
        page_text("html").alias("text"), F.regexp_extract("html", r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1).alias("declared"),
        F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1).alias("host"))


def identified(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Languages of all documents and pages: (kind, doc_id, page_id, language, probability, declared, host, accepted)."""
    return identify(of_documents(docs).unionByName(of_pages(pages)), trigram_model(docs))


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The documents whose language is identified, with their columns; rejected rows go.

    Rows with a null id are decided by their own evidence too: the decision is joined by the row's
    digest of (id, text, lang, source), equal rows having equal decisions.
    """
    key = F.xxhash64("doc_id", "text", "lang", "source")
    rows = of_documents(docs).withColumn("_row", F.xxhash64("doc_id", "text", "declared", "host"))
    # written first, so that Spark knows its size and broadcasts it only if that is small
    rejected = staged(identify(rows, trigram_model(docs)).filter(~F.col("accepted")).select("_row").distinct(), "rejected")
    return docs.withColumn("_row", key).join(rejected, "_row", "left_anti").drop("_row")
