"""Word lists and text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsloom.functions.scalars import column, strip

# The common English function words of the NLTK list.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had having do does did doing a an the and but
if or because as until while of at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don don't should
should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
weren weren't won won't wouldn wouldn't
""".split()
# Negations that carry the meaning of a message and therefore stay.
KEPT_NEGATIONS = ("not", "no", "never", "without", "wrong", "failed")
STOPWORDS = [w for w in ENGLISH_STOPWORDS if w not in KEPT_NEGATIONS]

# Joined forms that the word tokeniser separates.
JOINED_FORMS = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"))

# Letters of a word, and words too common to mark a subject.
WORD_LETTERS = "a-zàâäéèêëïîôöùûüç"
GENERIC_WORDS = """
le la les de des du et un une est dans pour ne pas que qui sur avec ce cette ces au aux en il elle ils elles je tu
vous nous son sa ses leur leurs plus fait peut sont vos votre notre nos mais ou donc car tout tous toute toutes par
si etre avoir a ete sans entre apres avant depuis jusqu ainsi comme cet meme autre bien quel quels quelle quelles
comment combien pourquoi quoi avez suis puis
""".split()

# Messages that are only a greeting.
GREETINGS = ("bonjour", "salut", "hello", "coucou", "hey", "bonsoir", "merci", "merci beaucoup", "au revoir",
             "ça va", "ca va", "cc")

# Signs of an attempt to redirect the assistant; the second list minds the case.
INJECTION_PATTERNS = (
    r"ignor(e|ez).{0,25}(instruction|consigne)",
    r"ignore.{0,20}(previous|above).{0,20}instruction",
    r"(répète|repete|révèle|revele|donne|montre).{0,30}(instruction|prompt|consigne).{0,20}(système|systeme)",
    r"system prompt",
    r"tu (es|n'es plus).{0,25}(maintenant|DAN)",
    r"sans (aucune )?restriction",
    r"disregard.{0,20}(previous|above).{0,20}instruction",
    r"pretend (you are|to be)",
)
CASED_INJECTION_PATTERNS = (r"\bDAN\b",)

# Phrases of an answer that declines.
REFUSAL_MARKERS = ("ne sais pas", "ne dispose pas", "n'ai pas cette information", "pas d'information",
                   "hors de mon domaine", "hors sujet")


def message_tokens(c: str | Column) -> Column:
    """Lower-case words of two letters or more, without function words, in order."""
    text = F.regexp_replace(F.lower(column(c)), r"[^a-z\s]", " ")
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    for head, tail in JOINED_FORMS:
        text = F.regexp_replace(text, rf"\b({head})({tail})\b", "$1 $2")
    return F.filter(F.split(text, " "), lambda w: (F.length(w) > 1) & ~w.isin(*STOPWORDS))


def normalise_text(c: str | Column) -> Column:
    return F.array_join(message_tokens(c), " ")


def ngrams(tokens: str | Column) -> Column:
    """All words and all pairs of neighbours."""
    t = column(tokens)
    pairs = F.zip_with(F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0))),
                       F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(t) > 1, F.concat(t, pairs)).otherwise(t)


def significant_words(c: str | Column) -> Column:
    """Distinct words of more than three letters that are not generic."""
    found = F.regexp_extract_all(F.lower(column(c)), F.lit(f"([{WORD_LETTERS}]+)"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) > 3) & ~w.isin(*GENERIC_WORDS)))


def is_greeting(c: str | Column) -> Column:
    return F.regexp_replace(F.lower(strip(c)), r"[ !.?]+$", "").isin(*GREETINGS)


def is_injection(c: str | Column) -> Column:
    """Any of the patterns; `.` stops at a line feed only, and accents fold with case."""
    out = F.lit(False)
    for pattern in INJECTION_PATTERNS:
        out = out | column(c).rlike(f"(?iud){pattern}")
    for pattern in CASED_INJECTION_PATTERNS:
        out = out | column(c).rlike(f"(?d){pattern}")
    return out


def is_grounded(answer: str | Column, context: str | Column, minimum: float = 0.3) -> Column:
    """A refusal, an answer without words, or enough words shared with the context."""
    lowered = F.lower(column(answer))
    refusal = F.lit(False)
    for marker in REFUSAL_MARKERS:
        refusal = refusal | lowered.contains(marker)
    words = significant_words(answer)
    shared = F.size(F.array_intersect(words, significant_words(context)))
    return refusal | (F.size(words) == 0) | (shared / F.size(words) >= minimum)
