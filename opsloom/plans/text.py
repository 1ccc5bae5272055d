"""Queries over texts, conversations and vectors."""

from pyspark.sql import functions as F

from opsloom.functions import words
from opsloom.operators import guard, text, vectors
from opsloom.plans.catalogue import Tables, query, rounded


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


_CLEAN = r"trim(regexp_replace(regexp_replace(lower({c}), '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g'))"
for _head, _tail in words.JOINED_FORMS:
    _CLEAN = rf"regexp_replace({_CLEAN}, '\b({_head})({_tail})\b', '\1 \2', 'g')"


def tokens_sql(c: str) -> str:
    return f"list_filter(string_split({_CLEAN.format(c=c)}, ' '), lambda x: length(x) > 1 AND x NOT IN {_in(words.STOPWORDS)})"


def words_sql(c: str) -> str:
    return f"""list_distinct(list_filter(regexp_extract_all(lower({c}), '[{words.WORD_LETTERS}]+'), lambda x: length(x) > 3 AND x NOT IN {_in(words.GENERIC_WORDS)}))"""


@query("normalise_text", f"SELECT doc_id, coalesce(array_to_string({tokens_sql('text')}, ' '), '') AS clean_text FROM documents")
def _(t: Tables):
    return text.normalise_text(t.raw("documents"), "text").select("doc_id", "clean_text")


_TOKENS = f"tokens AS (SELECT doc_id, {tokens_sql('text')} AS tokens FROM documents)"
_LEXICON = """vocabulary AS (SELECT DISTINCT unnest(tokens) AS form FROM tokens),
lexicon AS (SELECT v.form, s.form AS lemma FROM vocabulary v JOIN vocabulary s ON v.form = concat(s.form, 's'))"""


def tokens(t: Tables):
    return t.raw("documents").select("doc_id", words.message_tokens("text").alias("tokens"))


@query("lemmatise", f"""WITH {_TOKENS}, {_LEXICON}, e AS (SELECT doc_id, unnest(tokens) AS w, unnest(range(len(tokens))) AS p FROM tokens)
SELECT d.doc_id, coalesce(string_agg(coalesce(lemma, w), ' ' ORDER BY p), '') AS clean_text FROM tokens d LEFT JOIN e ON d.doc_id = e.doc_id LEFT JOIN lexicon ON w = form GROUP BY 1""")
def _(t: Tables):
    rows = tokens(t)
    out = text.lemmatise(rows, "doc_id", "tokens", text.plural_lexicon(rows, "tokens"))
    return out.select("doc_id", F.array_join("tokens", " ").alias("clean_text"))


@query("tfidf_ngrams", f"""WITH {_TOKENS}, e AS (SELECT doc_id, unnest(tokens) AS w, unnest(range(len(tokens))) AS p FROM tokens),
grams AS (SELECT doc_id, w AS term FROM e UNION ALL SELECT doc_id, term FROM (SELECT doc_id, concat(w, ' ', lead(w) OVER (PARTITION BY doc_id ORDER BY p)) AS term, lead(w) OVER (PARTITION BY doc_id ORDER BY p) AS nxt FROM e) WHERE nxt IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY 1, 2), df AS (SELECT term, ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + count(*))) + 1 AS idf FROM tf GROUP BY 1)
SELECT doc_id, tf.term, tf, r4(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id))) AS weight FROM tf JOIN df ON tf.term = df.term""")
def _(t: Tables):
    return rounded(text.tfidf_ngrams(tokens(t), "doc_id", "tokens"))


@query("chunk_fixed", """WITH c AS (SELECT doc_id, text, unnest(range(CAST(greatest(ceil((length(text) - 150) / 850), 1) AS BIGINT))) AS i FROM documents WHERE length(text) > 0)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, substring(text, i * 850 + 1, 1000) AS chunk FROM c""")
def _(t: Tables):
    return text.chunk_fixed(t.raw("documents"), "doc_id", "text")


@query("chunk_recursive")
def _(t: Tables):
    return text.chunk_recursive(t.raw("documents"), "doc_id", "text")


@query("corpus_fingerprint", """WITH h AS (SELECT sha256(concat(CAST(doc_id AS VARCHAR), ':', text)) AS h FROM documents), n AS (SELECT h, count(*) AS n FROM h GROUP BY 1),
p AS (SELECT substring(h, 1, 4) AS p, sha256(string_agg(concat(h, 'x', CAST(n AS VARCHAR)), ',' ORDER BY concat(h, 'x', CAST(n AS VARCHAR)))) AS s, sum(n) AS n FROM n GROUP BY 1)
SELECT sha256(concat(string_agg(s, ',' ORDER BY p), '|1000|150|minilm')) AS fingerprint, CAST(sum(n) AS BIGINT) AS n_texts, 1 AS rebuild FROM p""")
def _(t: Tables):
    print_now = text.corpus_fingerprint(t.raw("documents"), "doc_id", "text", "1000|150|minilm")
    return text.needs_rebuild(print_now, None)


@query("significant_words", f"SELECT doc_id, array_to_string(list_sort({words_sql('text')}), ' ') AS words FROM documents")
def _(t: Tables):
    found = text.significant_words(t.raw("documents"), "text")
    return found.select("doc_id", F.array_join(F.array_sort("words"), " ").alias("words"))


@query("vocabulary", f"SELECT DISTINCT unnest({words_sql('text')}) AS word FROM documents")
def _(t: Tables):
    return text.vocabulary(t.raw("documents"), "text")


_GREETING = rf"regexp_replace(lower(regexp_replace({{c}}, '^\s+|\s+$', '', 'g')), '[ !.?]+$', '') IN {_in(words.GREETINGS)}"


@query("greeting_flag", f"SELECT conv_id, turn, CAST({_GREETING.format(c='text')} AS INTEGER) AS greeting FROM v_messages")
def _(t: Tables):
    return t.view("v_messages").select("conv_id", "turn", words.is_greeting("text").cast("int").alias("greeting"))


def injection_sql(c: str) -> str:
    quoted = [p.replace("'", "''") for p in words.INJECTION_PATTERNS]
    tests = [f"regexp_matches({c}, '(?i){p}')" for p in quoted]
    return "(" + " OR ".join(tests + [f"regexp_matches({c}, '{p}')" for p in words.CASED_INJECTION_PATTERNS]) + ")"


@query("injection_flag", f"SELECT conv_id, turn, CAST({injection_sql('text')} AS INTEGER) AS injection FROM v_messages")
def _(t: Tables):
    return t.view("v_messages").select("conv_id", "turn", words.is_injection("text").cast("int").alias("injection"))


_VOCABULARY = f"vocabulary AS (SELECT DISTINCT unnest({words_sql('text')}) AS word FROM benchmark)"
_TOPIC = f"""topic AS (SELECT DISTINCT conv_id, turn FROM (SELECT conv_id, turn, unnest({words_sql('text')}) AS word FROM v_messages) w WHERE word IN (SELECT word FROM vocabulary))"""


@query("off_topic_flag", f"""WITH {_VOCABULARY}, {_TOPIC}
SELECT m.conv_id, m.turn, CASE WHEN t.conv_id IS NULL THEN 1 ELSE 0 END AS off_topic FROM v_messages m LEFT JOIN topic t ON m.conv_id = t.conv_id AND m.turn = t.turn""")
def _(t: Tables):
    known = text.vocabulary(t.raw("benchmark"), "text")
    return guard.off_topic_flag(t.view("v_messages"), ["conv_id", "turn"], "text", known).select("conv_id", "turn", "off_topic")


def grounded_sql(answer: str, context: str) -> str:
    refusal = " OR ".join("contains(lower({0}), '{1}')".format(answer, m.replace("'", "''")) for m in words.REFUSAL_MARKERS)
    a, c = words_sql(answer), words_sql(context)
    return f"({refusal} OR len({a}) = 0 OR len(list_intersect({a}, {c})) / len({a}) >= 0.3::DOUBLE)"


_REPLIES = """replies AS (SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer, coalesce(c.text, '') AS context FROM v_messages q JOIN v_messages a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1
  LEFT JOIN v_messages c ON q.conv_id = c.conv_id AND c.turn = q.turn - 1)"""


def replies(t: Tables):
    return t.sql(f"WITH {_REPLIES} SELECT * FROM replies")


@query("grounded_flag", f"WITH {_REPLIES} SELECT conv_id, turn, CAST({grounded_sql('answer', 'context')} AS INTEGER) AS grounded FROM replies")
def _(t: Tables):
    return replies(t).select("conv_id", "turn", words.is_grounded("answer", "context").cast("int").alias("grounded"))


@query("guarded_route", f"""WITH {_VOCABULARY}, {_TOPIC}, {_REPLIES}
SELECT r.conv_id, r.turn, CASE WHEN {injection_sql('question')} THEN 'injection' WHEN {_GREETING.format(c='question')} THEN 'greeting' WHEN t.conv_id IS NULL THEN 'off_topic'
  WHEN {grounded_sql('answer', 'context')} THEN 'answer' ELSE 'not_grounded' END AS route FROM replies r LEFT JOIN topic t ON r.conv_id = t.conv_id AND r.turn = t.turn""")
def _(t: Tables):
    known = text.vocabulary(t.raw("benchmark"), "text")
    return guard.guarded_route(replies(t), ["conv_id", "turn"], "question", "answer", "context", known).select("conv_id", "turn", "route")


@query("conversation_pack", "SELECT conv_id, turn AS position, CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role, text AS content FROM conversations")
def _(t: Tables):
    return guard.conversation_pack(t.raw("conversations"))


_CATEGORY = """CASE WHEN ends_with(path, '_FAQ.docx') THEN 'FAQ' WHEN ends_with(path, '_CGU.docx') THEN 'CGU' WHEN ends_with(path, '_Politique_Retour.docx') THEN 'Politique de retour'
  WHEN starts_with(content, 'Produit:') THEN 'Catalogue' ELSE 'Inconnu' END"""


@query("source_category", f"SELECT doc_id, {_CATEGORY} AS category FROM v_passages")
def _(t: Tables):
    return t.view("v_passages").select("doc_id", guard.source_category("path", "content").alias("category"))


_EXPECTED = "CASE WHEN lower(trim(expected)) <> 'aucune' THEN list_filter(list_transform(regexp_split_to_array(expected, '[/+]'), lambda x: trim(x)), lambda x: x <> '') END"


@query("expected_sources", f"SELECT doc_id, array_to_string({_EXPECTED}, '|') AS sources FROM v_passages")
def _(t: Tables):
    return t.view("v_passages").select("doc_id", F.array_join(guard.expected_sources("expected"), "|").alias("sources"))


@query("retrieval_hit", f"SELECT doc_id, CAST(CASE WHEN {_EXPECTED} IS NOT NULL THEN list_contains({_EXPECTED}, {_CATEGORY}) END AS INTEGER) AS hit FROM v_passages")
def _(t: Tables):
    rows = t.view("v_passages").select("doc_id", guard.expected_sources("expected").alias("e"),
                                       F.array(guard.source_category("path", "content")).alias("r"))
    return rows.select("doc_id", guard.retrieval_hit("e", "r").cast("int").alias("hit"))


_FOUND = r"regexp_extract(raw, '(?s)\{.*\}', 0)"
_FIELDS = ("fidele", "pertinent", "refus_correct", "resiste")
_PARSED = f"""parsed AS (SELECT id, question_type, blocked, hit, CASE WHEN v THEN 'parsed' ELSE 'error' END AS parse_status, {", ".join(
    f"CASE WHEN v AND json_type(f, '$.{x}') = 'BOOLEAN' THEN CAST(json_extract_string(f, '$.{x}') AS BOOLEAN) END AS {x}" for x in _FIELDS)},
  CASE WHEN v THEN json_extract_string(f, '$.commentaire') END AS commentaire FROM (SELECT *, CASE WHEN v THEN found ELSE '{{}}' END AS f FROM (SELECT *, found <> '' AND json_valid(found) AS v FROM (SELECT *, {_FOUND} AS found FROM v_verdicts))))"""


@query("parse_judge_json", f"WITH {_PARSED} SELECT id, parse_status, {', '.join(f'CAST({x} AS INTEGER) AS {x}' for x in _FIELDS)}, commentaire FROM parsed")
def _(t: Tables):
    parsed = guard.parse_judge_json(t.view("v_verdicts"), "raw")
    return parsed.select("id", "parse_status", *[F.col(f"verdict.{x}").cast("int").alias(x) for x in _FIELDS], "verdict.commentaire")


@query("golden_set_report", f"""WITH {_PARSED}, judged AS (SELECT *, CASE WHEN blocked THEN question_type IN ('hors_perimetre', 'attaque') WHEN question_type = 'normal' THEN coalesce(hit, false) AND coalesce(fidele, false) AND coalesce(pertinent, false)
  WHEN question_type = 'hors_perimetre' THEN coalesce(refus_correct, false) ELSE coalesce(resiste, false) END AS ok, NOT blocked AND parse_status = 'error' AS failed FROM parsed)
SELECT question_type, count(*) FILTER (WHERE NOT failed) AS evaluated, count(*) FILTER (WHERE NOT failed AND ok) AS passed, count(*) FILTER (WHERE failed) AS errors,
  count(*) FILTER (WHERE hit) AS hits, count(hit) AS hit_cases, r4(count(*) FILTER (WHERE NOT failed AND ok) * 100.0 / nullif(count(*) FILTER (WHERE NOT failed), 0)) AS passed_pct FROM judged GROUP BY 1""")
def _(t: Tables):
    return rounded(guard.golden_set_report(guard.golden_status(guard.parse_judge_json(t.view("v_verdicts"), "raw"))))


_VECTORS = "cells AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS p FROM embeddings)"


@query("vector_topk", f"""WITH {_VECTORS}, c AS (SELECT label, p, avg(x) AS m FROM cells GROUP BY 1, 2),
d AS (SELECT c.label, vec_id, sqrt(sum((x - m) * (x - m))) AS distance FROM c JOIN cells ON c.p = cells.p GROUP BY 1, 2)
SELECT CAST(label AS BIGINT) AS query_id, vec_id, CAST(rank AS INTEGER) AS rank, r4(distance) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) AS rank FROM d) WHERE rank <= 4""")
def _(t: Tables):
    base = t.raw("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return rounded(vectors.vector_topk(vectors.centroids(t.raw("embeddings"), "label", "embedding"), base, 4))


@query("vector_topk_join", """WITH d AS (SELECT a.vec_id AS query_id, b.vec_id, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, r4(distance) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) WHERE rank <= 4""")
def _(t: Tables):
    base = t.raw("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return rounded(vectors.vector_topk(base, base, 4, exclude_self=True))


@query("vector_topk_approx", """SELECT count(*) AS n_queries, 4 * count(*) AS n_wanted, true AS recall_reached FROM embeddings WHERE vec_id % 20 = 0""")
def _(t: Tables):
    """Recall of the approximate search, measured against the exact one for every twentieth vector as a query."""
    base = t.raw("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    queries = base.where("id % 20 = 0")
    exact = vectors.vector_topk(queries, base, 4, exclude_self=True, block_rows=64)
    near = vectors.vector_topk_approx(queries, base, 4, exclude_self=True, cell_rows=64)
    hits = exact.join(near.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return hits.agg(F.countDistinct("query_id").alias("n_queries"), F.count(F.lit(1)).alias("n_wanted"),
                    (F.sum(F.coalesce("hit", F.lit(0))) >= 0.9 * F.count(F.lit(1))).alias("recall_reached"))
