"""Canonical forms and digests of licence texts."""

import hashlib

from opsloom.llm import licences as li

MIT = next(text for name, kind, text in li.KNOWN if (name, kind) == ("MIT", "text"))


def rows_of(spark, texts):
    docs = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], "doc_id long, text string, digest string, licence string")
    return sorted((r.doc_id, r.scope, r.line, r.licence, r.digest) for r in li.licence_scan(docs).collect() if r.scope != "passage")


def test_variants_are_found(spark):
    varied = "Copyright (c) 2001 A. Body\n(C) 2002 B\nCOPYRIGHT 2003\n" + MIT.upper().replace(" ", "\t  ").replace('"', "“").replace("SUBLICENSE", "sublicence")
    got = rows_of(spark, [MIT, varied, MIT + " and more", MIT.replace("MIT License", "MIT licence licence")])
    assert [g[3] for g in got if g[1] == "text"] == ["MIT", "MIT", None, None]
    assert got[0][4] == got[1][4]


def test_notices_edges_and_repeats(spark):
    got = rows_of(spark, [None, "", "***\n!!", "prose\nReleased under the MIT Licence\nmore", "RELEASED UNDER THE MIT LICENSE.", "licence"])
    assert [(g[0], g[1], g[3]) for g in got] == [
        (0, "text", None), (1, "text", None), (2, "text", None), (3, "notice", "MIT"), (3, "text", None),
        (4, "notice", "MIT"), (4, "text", "MIT"), (5, "text", None)]
    assert [g[4] for g in got[:3]] == [None] * 3 and got[-1][4] == hashlib.sha256(b"license").hexdigest()
    assert got[3][2] == 2
    assert rows_of(spark, []) == []


def test_known_texts_differ(spark):
    digests = li.known_digests(spark).collect()
    assert len({(r.digest) for r in digests if r.licence not in ("0BSD", "ISC", "BSD-2-Clause", "BSD-3-Clause")}) >= 20
    by_digest = {}
    for r in digests:
        by_digest.setdefault(r.digest, set()).add(r.licence)
    assert all(len(names) == 1 for names in by_digest.values())


def body(name):
    form = next(text for n, kind, text in li.KNOWN if (n, kind) == (name, "text"))
    return form.split("\n\n", 1)[1] if name in ("MIT", "ISC") else form


def wrapped(text, width, mark=""):
    import textwrap

    return "\n".join(mark + line for part in text.split("\n\n") for line in [*textwrap.wrap(part, width), ""])


def test_headings_wraps_and_copyright_lines(spark):
    owner = "Copyright (c) 2020-2024 A. Body <a@b.org>\nCopyright 2019 Some Company. All rights reserved.\n\n"
    texts = [(f"{h}\n\n{owner}{wrapped(body(n), w)}", n) for n in ("MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause")
             for h in ("", *li.HEADINGS[n]) for w in (40, 76)]
    texts += [(f"Copyright The Some Authors\n{body('MIT')}", "MIT"), (f"© 2022 B\n{body('ISC')}", "ISC"),
              (wrapped(body("BSD-3-Clause"), 30), "BSD-3-Clause"), (body("MIT").replace("copyright notice", "notice"), None)]
    got = rows_of(spark, [t for t, _ in texts])
    assert [g[3] for g in got if g[1] == "text"] == [n for _, n in texts]


def test_passages_against_plain_search(spark):
    apache = next(t for n, k, t in li.KNOWN if n == "Apache-2.0" and "IS\" BASIS" in t)
    texts = [
        "int a;\n" + wrapped(apache, 60, " * ") + "\nint b;", "# x\n" + wrapped(body("MIT"), 50, "# ") + "# y", "see below.\nReleased under\nthe MIT\nLicence. Released under the MIT license, too",
        "Released under the MIT", "licensed under " * 50, None, "", "x " * 300_000 + apache, "permission is hereby granted", apache]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(None, texts[2], 1)], "doc_id long, text string, word int")
    found = sorted(((r.doc_id, r.word, r.licence) for r in li.licence_scan(docs).collect() if r.scope == "passage"), key=str)
    expected = []
    for doc_id, text, _ in docs.collect():
        words = li.plain_form(text or "").split(" ")
        expected += [(doc_id, i + 1, n) for n, w in li.passages() for i in range(len(words) - len(w) + 1) if words[i] == w[0] and words[i:i + len(w)] == w]
    assert found == sorted(expected, key=str) and {f[0] for f in found} == {0, 1, 2, 7, 9, None}


def test_further_texts_from_a_table(spark):
    more = li.digests_of(spark.createDataFrame([("House", "House licence\n\nCopyright 2020 X\nDo as you organise."), ("MIT", MIT)], "licence string, text string"))
    docs = spark.createDataFrame([(1, "HOUSE LICENSE: do as you organize"), (2, MIT), (3, "other")], "doc_id long, text string")
    assert sorted((r.doc_id, r.licence) for r in li.licence_scan(docs, more).collect() if r.scope == "text") == [(1, "House"), (2, "MIT"), (3, None)]
    import os

    if os.path.exists("/usr/share/common-licenses/GPL-3"):
        gpl = spark.createDataFrame([(1, open("/usr/share/common-licenses/GPL-3").read().replace("\n", "\r\n"))], "doc_id long, text string")
        assert [r.licence for r in li.licence_scan(gpl).collect() if r.scope == "text"] == ["GPL-3"]
