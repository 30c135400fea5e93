import numpy as np
from pyspark.sql import functions as F

from lexiforge.llm import common, langid, licenses, toxicity
from lexiforge.llm.common import crc_mod

TEN = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{TEN}/documents.parquet")
    model = langid.learn(docs, crc_mod(F.col("doc_id"), 3) != 1)
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(crc_mod(F.col("doc_id"), 3) == 1).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    assert 0.05 <= model.temperature <= 20


def test_language_of_odd_rows(odd, empty):
    model = langid.learn(odd, F.lit(True))
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {3, 4, 5}
    assert {r.lang_pred for r in langid.predict(odd, langid.learn(empty, F.lit(True))).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_sparse_weights():
    rows = [(np.array([0, 2]), np.array([0.7, 0.7]), 0), (np.array([1, 2]), np.array([0.7, 0.7]), 1)] * 20
    w, b = langid.fit(rows, 2, 4)
    assert w[0, 0] > w[0, 1] and w[1, 1] > w[1, 0]
    assert (w[3] == 0).all()


def test_calibration_softens_overconfident_scores():
    logits = np.array([[8.0, 0.0]] * 10)
    assert langid.calibrated(logits, np.array([0] * 7 + [1] * 3)) > 4


def test_toxicity_of_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{TEN}/documents.parquet"), spark.read.parquet(f"{TEN}/labels.parquet")
    model = toxicity.learn(docs, labels, crc_mod(F.col("id"), 4) != 2)
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter(crc_mod(F.col("doc_id"), 4) == 2).collect()
    caught = [r.predicted for r in rows if r.toxic]
    wrong = [r.predicted for r in rows if not r.toxic]
    assert np.mean(caught) > 0.6 and np.mean(wrong) < 0.05
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def lev(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        e = [i]
        for j, y in enumerate(b, 1):
            e.append(min(d[j] + 1, e[-1] + 1, d[j - 1] + (x != y)))
        d = e
    return d[-1]


def test_automaton_against_edit_distances():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abc"), rng.integers(2, 12))) for _ in range(600)]
    lexicon = {w: False for w in words[:25]}
    a = toxicity.Automaton(lexicon)
    for w in words:
        near = [lev(w, t) for t in lexicon if lev(w, t) <= toxicity.Automaton.budget(t, False)]
        want = None if not near else toxicity.EXACT if min(near) == 0 else toxicity.FUZZY
        assert a.match(w) == want, w


def test_stems_take_any_ending():
    a = toxicity.Automaton({"lostra": True, "idiot": False})
    assert a.match("lostrabc") == toxicity.STEM
    assert a.match("lostxabc") == toxicity.FUZZY
    assert a.match("idiott") == toxicity.FUZZY and a.match("idiot") == toxicity.EXACT
    assert a.match("other") is None and a.match("") is None


def test_quotation_weighs_less_than_abuse():
    m = toxicity.Model({"idiot": False})
    abuse, quote = m.features("you are such an idiot today"), m.features('he said "idiot" was the word she used')
    assert abuse[0] > quote[0] and quote[3] > abuse[3]


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (6, 0)], "doc_id long, toxic int")
    model = toxicity.learn(odd, labels, F.lit(True))
    assert toxicity.score(odd, model).count() == odd.count()
    none = toxicity.learn(odd, labels.limit(0), F.lit(True))
    assert {r.predicted for r in toxicity.score(odd, none).collect()} == {0}
    assert toxicity.drop_toxic(odd, none).columns == odd.columns
    assert toxicity.drop_toxic(odd, none).count() == odd.count()
    assert toxicity.score(empty, model).count() == 0


FILES = [
    ("repo/LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("repo/src/a.py", "print(1)"),
    ("repo/src/b.py", "# Licensed under the Apache License, Version 2.0\nprint(2)"),
    ("repo/vendor/COPYING", "GNU General Public License Version 3, 29 June 2007"),
    ("repo/vendor/deep/er/c.c", "int x;"),
    ("repo/vendored/d.c", None),
    ("other/e.c", ""),
    (None, "no path"),
    ("repo/src/a.py", "print(1)"),
    ("repo/src/talk.md", "We asked for permission; the licence of the poet is another matter."),
]


def test_licenses_and_inheritance(spark, empty):
    df = spark.createDataFrame(FILES, "path string, text string").withColumns({n: F.lit(1) for n in ("id", "dir", "own", "score", "n")})
    rows = licenses.license_scan(df).collect()
    got = {r.path: (r.license, r.via, r.license_dir) for r in rows}
    assert len(rows) == len(FILES)
    assert got == {
        "repo/LICENSE": ("MIT", "file", None),
        "repo/src/a.py": ("MIT", "inherited", "repo/"),
        "repo/src/b.py": ("Apache-2.0", "header", None),
        "repo/vendor/COPYING": ("GPL-3.0", "file", None),
        "repo/vendor/deep/er/c.c": ("GPL-3.0", "inherited", "repo/vendor/"),
        "repo/vendored/d.c": ("MIT", "inherited", "repo/"),
        "other/e.c": (None, "none", None),
        None: (None, "none", None),
        "repo/src/talk.md": ("MIT", "inherited", "repo/"),
    }
    assert licenses.license_scan(empty).count() == 0


def test_license_statements_of_documents(spark):
    docs = spark.read.parquet(f"{TEN}/documents.parquet")
    rows = licenses.license_scan(docs.selectExpr("doc_id", "text", "concat(source, '/', doc_id) AS path"), id_col="doc_id").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    lines = {"MIT": "Released under the MIT License", "Apache-2.0": "Apache License, Version 2.0", "GPL-3.0": "GNU General Public License, version 3", "CC-BY-NC-4.0": "CC BY-NC 4.0"}
    for r in rows:
        assert (r.license in [n for n, x in lines.items() if x.lower() in texts[r.doc_id].lower()]) == (r.license is not None)
        assert r.license or not any(x.lower() in texts[r.doc_id].lower() for x in lines.values())


HEADERS = {
    "// SPDX-License-Identifier: MIT": "MIT",
    "# SPDX-License-Identifier: Apache-2.0\n": "Apache-2.0",
    "/* SPDX-License-Identifier: GPL-3.0-only */ int x;": "GPL-3.0",
    "SPDX-License-Identifier: LGPL-3.0-or-later": "LGPL-3.0",
    "spdx-license-identifier: BSD-3-Clause": "BSD-3-Clause",
    "This file is part of X. It is released under the GPLv3.": "GPL-3.0",
    "License: CC-BY-SA-4.0": "CC-BY-SA-4.0",
    "You may obtain a copy. Licensed under the Apache License, Version 2.0 (the \"License\");": "Apache-2.0",
    "Mozilla Public License, version 2.0": "MPL-2.0",
    "The weather is nice and nobody asked for permission.": None,
    "Mit freundlichen Grüßen, der Apache und die Mozilla": None,
}


def test_headers_in_other_words_than_the_templates(spark):
    df = spark.createDataFrame([(f"{k}.c", t) for k, t in enumerate(HEADERS)], "path string, text string")
    got = {r.path: r.license for r in licenses.license_scan(df).collect()}
    assert [got[f"{k}.c"] for k in range(len(HEADERS))] == list(HEADERS.values())


def test_whole_licence_files(spark):
    """A copy with a copyright line and other line breaks; a long file that opens like a licence; a very long text."""
    rows = [
        ("a/LICENSE", "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + licenses._MIT_TEXT.replace(",", ",\n")),
        ("b/COPYING", "BSD\n\nCopyright 2019\n" + licenses._BSD_3_TEXT),
        ("c/LICENSE.txt", "Apache License Version 2.0, January 2004\n" + "definitions of terms and more of them " * 3000),
        ("d/x.txt", "word " * 100_000 + "Released under the MIT License." + " word" * 100_000),
        ("a/src/y.txt", None),
        ("c/deep/z.txt", ""),
    ]
    got = {r.path: (r.license, r.via) for r in licenses.license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {"a/LICENSE": ("MIT", "file"), "b/COPYING": ("BSD-3-Clause", "file"), "c/LICENSE.txt": ("Apache-2.0", "file"), "d/x.txt": ("MIT", "header"), "a/src/y.txt": ("MIT", "inherited"), "c/deep/z.txt": ("Apache-2.0", "inherited")}


def test_license_query_against_brute_force(spark):
    """op3 on sf0.01: each file's own licence by the scan of its text alone, inheritance by walking up its directories."""
    import re

    from lexiforge.llm import queries

    docs = queries.paths(spark.read.parquet(f"{TEN}/documents.parquet"))
    files = [(r.doc_id, r.path, r.text) for r in docs.collect()]
    t = licenses.Templates(licenses.TEMPLATES, licenses.term_weights(docs, "text"))
    own, granted = {}, {}
    for i, path, text in files:
        folder, _, name = path.rpartition("/")
        is_file = bool(re.match(licenses.FILE_NAME, name))
        found, score = t.scan(text, whole=is_file)
        own[i] = (found if score >= licenses.THRESHOLD else None, is_file)
        if is_file and own[i][0]:
            granted.setdefault(folder, []).append((-score, path, found))
    want = {}
    for i, path, _ in files:
        found, is_file = own[i]
        if found:
            want[i] = (found, "file" if is_file else "header")
            continue
        at = path.rpartition("/")[0]
        while at and at not in granted:
            at = at.rpartition("/")[0]
        want[i] = (min(granted[at])[2], "inherited") if at in granted else (None, "none")
    got = {r.doc_id: (r.license, r.via) for r in queries.op3(spark, TEN).collect()}
    assert got == want
    assert {v for _, v in got.values()} == {"file", "header", "inherited", "none"}


def test_language_query_against_brute_force(spark):
    """op1 on sf0.01: every row's prediction is the model's for its text alone; scores are as sure as they are right."""
    from lexiforge.llm import queries

    docs = spark.read.parquet(f"{TEN}/documents.parquet")
    model = langid.learn(docs, crc_mod(F.col("doc_id"), 3) != 1)
    texts = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    rows = queries.op1(spark, TEN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        lang, score = model.predict(texts[r.doc_id][0])
        assert r.lang_pred == lang and abs(r.score - score) < 1e-6
    held = [r for r in rows if r.held_out]
    right = np.mean([r.lang_pred == texts[r.doc_id][1] for r in held])
    assert abs(np.mean([r.score for r in held]) - right) < 0.01


def test_toxicity_query_against_brute_force(spark):
    """op5 on sf0.01: evidence, contexts and features are those of plain loops over the texts; scores are the model's."""
    from collections import Counter

    from lexiforge.llm import queries

    docs, labels = spark.read.parquet(f"{TEN}/documents.parquet"), spark.read.parquet(f"{TEN}/labels.parquet")
    rows = docs.join(labels, "doc_id").select(F.col("text").alias("t"), F.col("toxic").cast("int").alias("y")).filter("t is not null and y is not null").limit(150)
    plain = [(r.t, r.y) for r in rows.collect()]
    rows = spark.createDataFrame(plain, "t string, y int")
    want = Counter()
    for t, y in plain:
        for (term, stem), n in toxicity.terms(set(toxicity.WORD.findall(t.lower()))).items():
            want[term, stem, "toxic" if y else "clean"] += 1
            want[term, stem, "toxic2" if y else "clean2"] += n > 1
    got = {(r.term, r.stem, k): r[k] for r in toxicity.evidence(rows).collect() for k in ("toxic", "toxic2", "clean", "clean2") if r[k]}
    assert got == {k: n for k, n in want.items() if n}
    model = toxicity.learn(docs, labels, crc_mod(F.col("id"), 4) != 2)
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = queries.op5(spark, TEN).collect()
    assert len(out) == len(texts)
    assert all(abs(r.score - model.score(texts[r.doc_id])) < 1e-6 and r.predicted == (r.score >= 0.3) for r in out)


def plain_lexicon(rows):
    """(entries, weak stems) by loops over whole dictionaries of (term, is a stem)."""
    import math

    forms_of = lambda t: toxicity.WORD.findall(t.lower())
    stems_of = lambda w: [w[:n] for n in toxicity.STEMS if len(w) > n]
    n = {1: sum(y for _, y in rows), 0: sum(1 - y for _, y in rows)}
    least = max(toxicity.CONTEXTS, math.ceil(toxicity.EVIDENCE / math.log1p(n[0] / n[1])))
    texts, twice, around, forms = ({} for _ in range(4))
    for t, y in rows:
        words = forms_of(t)
        own = {}
        for w in set(words):
            if len(w) >= 3:
                own.setdefault((w, False), set()).add(w)
            for s in stems_of(w):
                own.setdefault((s, True), set()).add(w)
        for x, ws in own.items():
            texts[x, y] = texts.get((x, y), 0) + 1
            twice[x, y] = twice.get((x, y), 0) + (len(ws) > 1)
        if y:
            padded = ["", *words, ""]
            for a, w, z in zip(padded, padded[1:], padded[2:], strict=False):
                for x in ((w, False), *((s, True) for s in stems_of(w))):
                    around.setdefault(x, set()).add((a, z))
                    forms.setdefault(x, set()).add(w)
    share = n[1] / n[0]
    terms = {x for x, y in texts if y}
    pure = {x for x in terms if texts[x, 1] >= least and texts.get((x, 0), 0) * share <= toxicity.IMPURE * texts[x, 1]}
    weak = {x for x in terms - pure if x[1] and twice[x, 1] >= least and twice.get((x, 0), 0) * share <= toxicity.WEAK_IMPURE * twice[x, 1] and len(forms[x]) >= toxicity.FORMS and len(around[x]) >= least}
    related = lambda a, b: a.startswith(b) or b.startswith(a)
    loose = []
    for s, _ in sorted(weak, key=lambda x: (-twice[x, 1], len(x[0]), x[0])):
        if not any(related(s, o) for o in loose):
            loose.append(s)
    strong = sorted((x for x in pure if len(around[x]) >= least and not any(x[0].startswith(s) for s in loose)), key=lambda x: (-len(around[x]), x))
    words = {w: len(around[w, False]) for w, stem in strong if not stem}
    stems = []
    for s, stem in strong:
        if stem and len(forms[s, True]) >= 3 and not any(w.startswith(s) and c > len(around[s, True]) / 2 for w, c in words.items()) and not any(related(s, o) for o in stems):
            stems.append(s)
    return dict.fromkeys(stems, True) | {w: False for w in words if not any(w.startswith(s) for s in stems)}, frozenset(loose)


def test_lexicon_against_plain_loops(spark):
    """All labelled rows of sf0.1: the same terms as by loops over every term, however many there are."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    found = docs.join(labels, "doc_id").filter("text is not null").groupBy("text").agg(F.max("toxic").cast("int").alias("y")).select(F.col("text").alias("t"), "y")
    rows = common.cut(found)
    got = toxicity.lexicon(rows)
    assert got == plain_lexicon([(r.t, r.y) for r in rows.collect()])
    assert len(got[0]) > 10


def test_toxicity_recall(spark):
    """Held-out rows of sf0.1; some labels are noise: toxic rows without any toxic word."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.learn(docs, labels, crc_mod(F.col("id"), 4) != 2)
    held = docs.join(labels, "doc_id").filter(crc_mod(F.col("doc_id"), 4) == 2)
    rows = toxicity.score(held, model).join(labels, "doc_id").collect()
    assert np.mean([r.predicted for r in rows if r.toxic]) >= 0.9
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.01


def test_misspelled_terms_with_signs():
    m = toxicity.Model({"idiot": False, "moron": False})
    assert [k for *_, k in m.hits("an id1ot and a mor*n met an idiot")[0]] == [toxicity.FUZZY, toxicity.FUZZY, toxicity.EXACT]


def test_weak_stems_count_by_their_forms():
    m = toxicity.Model({}, frozenset({"achl"}))
    one, three = m.features("das achlich ist achlich"), m.features("achlich achlung achlos")
    assert one[7] == np.log1p(1) and one[8] == 0
    assert three[7] == np.log1p(3) and three[8] == np.log1p(2)
