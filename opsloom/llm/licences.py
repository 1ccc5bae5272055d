"""Find known licence texts by the digest of their canonical form; DataFrame functions only.

Canonical form: lower case, copyright lines removed, every run of ASCII marks and blanks made one
blank, equivalent spellings made one. Whole texts, lines that name a licence, and the words that follow the
first two words of a known notice are looked up by a hash join of their digests with those of the known texts.
Further texts come as a table (`digests_of`).
"""

from __future__ import annotations

import hashlib
import re
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings (second form is kept).
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("licencee", "licensee"), ("sublicence", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"), ("catalogue", "catalog"),
    ("centre", "center"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"),
    ("modelled", "modeled"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("https", "http"),
)

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# Public licence texts and notices by their usual identifiers.
KNOWN = (
    ("MIT", "text", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software "
     'and associated documentation files (the "Software"), to deal in the Software without restriction, including without '
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
     "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above "
     "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
     + _WARRANTY),
    ("ISC", "text", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC),
    ("0BSD", "text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted.\n\n" + _ISC),
    ("BSD-2-Clause", "text", _BSD + _BSD_END),
    ("BSD-3-Clause", "text", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission.\n\n" + _BSD_END),
    ("Apache-2.0", "notice", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
     "language governing permissions and limitations under the License."),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "notice", "Released under the MIT License."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
)

# Usual headings of the texts above; a text is known with each of them and without any.
HEADINGS = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "License: MIT", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD", "ISC License", "Zero Clause BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", "BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD License",
                     "BSD 3-Clause \"New\" or \"Revised\" License"),
}
# SHA-256 of the canonical forms of whole public licence texts, as `python -m opsloom.llm.licences FOLDER` prints them.
DIGESTS = (
    ("Apache-2.0", "045649cdaf85384ba827242062f2f3b36409835c98d297e25177cb1faf7c2847"),
    ("Artistic", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "fcb579371133afd771fed87cd5d8c6dc5648746c9945d4adf08ec5c79aba5c61"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ“”‘’–—", "abcdefghijklmnopqrstuvwxyz\"\"''--"
#: a copyright statement is a line that begins with a mark and a year, a sign or a body of authors; "copyright notice" or
#: "copyright holders" at the head of a wrapped line is none
_SIGN = "([(]c[)]|©|[(]r[)])"
COPYRIGHT = (
    "(^|\n)[^\na-z0-9]*("
    f"copyright[ \t:,]*({_SIGN}|by |[0-9][0-9][0-9][0-9]|<year|.year|.yyyy)|{_SIGN}|all rights reserved"
    "|copyright [^\n]*(authors|foundation|inc[.]|llc|ltd|gmbh|project))[^\n]*"
)
MARKS = "[^a-z0-9\u0080-\U0010ffff]+"
NAMED = "licen"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def plain_form(text: str) -> str:
    """The canonical form of a constant."""
    lowered = re.sub(COPYRIGHT, "\n", text.translate(str.maketrans(UPPER, LOWER)))
    spelt = dict(SPELLINGS)
    return " ".join(spelt.get(w, w) for w in re.sub(MARKS, " ", lowered).split())


def known_forms() -> list[tuple[str, str]]:
    """(licence, canonical form) of every known text and notice, texts with and without their headings."""
    out = set()
    for name, kind, text in KNOWN:
        body = plain_form(text)
        for heading in HEADINGS.get(name, ()) if kind == "text" else ():
            own = plain_form(heading) + " "
            body = body.removeprefix(own) if body.startswith(own + "permission") else body
        out.add((name, body))
        if kind == "text":
            out |= {(name, f"{plain_form(h)} {body}") for h in HEADINGS[name]}
    return sorted(out)


def passages() -> list[tuple[str, list[str]]]:
    """(licence, words) of what is also looked for inside texts: notices, and licence texts without heading."""
    headed = {(n, f) for n, f in known_forms() if any(f.startswith(plain_form(h) + " ") for h in HEADINGS.get(n, ()))}
    return [(n, f.split(" ")) for n, f in known_forms() if (n, f) not in headed]


def canonical_sql(text: str) -> str:
    """SQL of the canonical form (the same in Spark and in DuckDB but for the flag that means all matches)."""
    lowered = f"translate({text}, {_quoted(UPPER)}, {_quoted(LOWER)})"
    out = f"regexp_replace(regexp_replace({lowered}, {_quoted(COPYRIGHT)}, '\n'), {_quoted(MARKS)}, '  ')"
    out = f"concat(' ', {out}, ' ')"  # two blanks between words: every word has blanks of its own
    for found, kept in SPELLINGS:
        out = f"replace({out}, ' {found} ', ' {kept} ')"
    return f"trim(replace({out}, '  ', ' '))"


def digests_of(texts: DataFrame) -> DataFrame:
    """(licence, digest) of a table (licence, text) of whole licence texts, to be given to `licence_scan`."""
    return texts.select("licence", F.sha2(F.expr(canonical_sql("text")), 256).alias("digest")).distinct()


def known_digests(spark: SparkSession) -> DataFrame:
    """(licence, digest) of all known texts and notices: a constant list."""
    forms = [(n, hashlib.sha256(f.encode()).hexdigest()) for n, f in known_forms()]
    rows = F.array(*[F.struct(F.lit(n).alias("licence"), F.lit(d).alias("digest")) for n, d in sorted({*forms, *DIGESTS})])
    return spark.range(1).select(F.explode(rows).alias("k")).select("k.*")


def licence_scan(docs: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Rows (doc_id, scope, line, word, digest, licence).

    Scope `text`: one row per document (line 0), licence null where the whole text is no known one, digest
    null where the canonical form is empty (also null texts). Scope `notice`: one row for each line
    (numbered from 1) that holds "licen" in any case and is a known text. Scope `passage`: one row for each place (the
    number of its first word in the canonical form, from 1) where the words of a known notice or text stand inside a
    document, over any number of lines and between any marks; a notice that begins another one is reported with it.
    `more` (licence, digest) adds whole texts to the known ones. Repeated rows give repeated rows; null ids stay; other
    columns are ignored; a very long text is canonicalised once, and its words are looked at one by one only if it
    holds the first two words of a known passage.
    """
    units = F.expr(f"""
        array_append(
          filter(transform(split(body, '\n'), (l, i) -> named_struct('line', i + 1, 'unit', l)),
                 x -> contains(translate(x.unit, 'LICEN', 'licen'), '{NAMED}')),
          named_struct('line', 0, 'unit', body))""")
    starts = sorted({(" ".join(w[:2]), len(w)) for _, w in passages()})
    heads = sorted({h for h, _ in starts})
    hinted = " OR ".join(f"contains(form, {_quoted(h)})" for h in heads)
    listed = ", ".join(_quoted(h) for h in heads)
    sizes = ", ".join(f"named_struct('head', {_quoted(h)}, 'n', {n})" for h, n in starts)
    inside = F.expr(f"""
        CASE WHEN line = 0 AND ({hinted}) THEN flatten(flatten(transform(array(split(form, ' ')), w -> transform(
          filter(sequence(1, greatest(size(w) - 1, 1)), i -> concat_ws(' ', slice(w, i, 2)) IN ({listed})),
          i -> transform(filter(array({sizes}), s -> s.head = concat_ws(' ', slice(w, i, 2)) AND i + s.n - 1 <= size(w)),
                         s -> named_struct('word', i, 'digest', sha2(concat_ws(' ', slice(w, i, s.n)), 256))))))) END""")
    parted = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
        .select("doc_id", F.explode(units).alias("u"))
        .select("doc_id", "u.line", F.expr(canonical_sql("u.unit")).alias("form"))
    )
    own = F.struct(F.lit(None).cast("int").alias("word"), F.when(F.col("form") != "", F.sha2("form", 256)).alias("digest"))
    found = parted.select("doc_id", "line", F.explode(F.array_append(F.coalesce(inside, F.array().cast("array<struct<word:int,digest:string>>")), own)).alias("f")).select(
        "doc_id", "line", "f.word", "f.digest")
    known = known_digests(docs.sparkSession)  # a constant list of a few rows: broadcast
    joined = found.join(F.broadcast(known), "digest", "left")
    if more is not None:
        extra = more.select(F.col("licence").alias("_more"), "digest").join(known, "digest", "left_anti").distinct()
        joined = joined.join(extra, "digest", "left").withColumn("licence", F.coalesce("licence", "_more"))
    whole = (F.col("line") == 0) & F.col("word").isNull()
    return joined.filter(whole | F.col("licence").isNotNull()).select(
        "doc_id", F.when(F.col("word").isNotNull(), "passage").when(F.col("line") == 0, "text").otherwise("notice").alias("scope"),
        F.when(F.col("word").isNull(), F.col("line")).cast("int").alias("line"), "word", "digest", "licence")


def check_sql() -> str:
    """An independent form: words as lists, spellings by a case per word, passages by comparing lists of words."""
    def words(text: str) -> str:
        lowered = f"translate({text}, {_quoted(UPPER)}, {_quoted(LOWER)})"
        spelt = " ".join(f"WHEN {_quoted(a)} THEN {_quoted(b)}" for a, b in SPELLINGS)
        split = f"string_split(regexp_replace(regexp_replace({lowered}, {_quoted(COPYRIGHT)}, chr(10), 'g'), {_quoted(MARKS)}, ' ', 'g'), ' ')"
        return f"list_transform(list_filter({split}, lambda x: x <> ''), lambda x: CASE x {spelt} ELSE x END)"

    forms = ", ".join(f"({_quoted(n)}, {_quoted(f)})" for n, f in known_forms())
    digests = ", ".join(f"({_quoted(n)}, {_quoted(d)})" for n, d in DIGESTS)
    inner = ", ".join(f"({_quoted(n)}, {_quoted(' '.join(w))})" for n, w in passages())
    return f"""
WITH known AS (SELECT licence, sha256(form) AS digest FROM (VALUES {forms}) AS v(licence, form) UNION SELECT * FROM (VALUES {digests}) AS d(licence, digest)),
inner_forms AS (SELECT licence, string_split(form, ' ') AS k, form FROM (VALUES {inner}) AS v(licence, form)),
units AS (
  SELECT doc_id, 0 AS line, coalesce(text, '') AS unit FROM documents
  UNION ALL
  SELECT doc_id, i AS line, unit FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS unit, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i
    FROM documents) WHERE contains(translate(unit, 'LICEN', 'licen'), '{NAMED}')),
listed AS (SELECT doc_id, line, {words("unit")} AS w FROM units),
parted AS (SELECT doc_id, line, w, CASE WHEN len(w) > 0 THEN sha256(array_to_string(w, ' ')) END AS digest FROM listed),
places AS (SELECT doc_id, licence, form, k, w, unnest(generate_series(1, len(w))) AS i FROM parted JOIN inner_forms ON line = 0 AND contains(array_to_string(w, ' '), form))
SELECT doc_id, CASE WHEN line = 0 THEN 'text' ELSE 'notice' END AS scope, CAST(line AS INTEGER) AS line, CAST(NULL AS INTEGER) AS word, p.digest, licence
FROM parted p LEFT JOIN known k ON p.digest = k.digest WHERE line = 0 OR licence IS NOT NULL
UNION ALL
SELECT doc_id, 'passage', NULL, CAST(i AS INTEGER), sha256(form), licence FROM places WHERE list_slice(w, i, i + len(k) - 1) = k
"""


def _print_digests(folder: str) -> None:
    """The digests of a folder with one whole licence text per file, named by the licence."""
    session = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
    rows = [(f.name, f.read_text(errors="replace")) for f in sorted(Path(folder).iterdir()) if f.is_file() and not f.is_symlink()]
    for row in digests_of(session.createDataFrame(rows, "licence string, text string")).orderBy("licence").collect():
        print(f'    ("{row.licence}", "{row.digest}"),')


if __name__ == "__main__":
    _print_digests(sys.argv[1])
