import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiforge.llm import fim, queries

PATTERNS = {
    "code points": (fim.CODE_POINTS, r"(?s)."),
    "runs": (fim.RUNS, r"[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+"),
    "lines": (fim.LINES, r"\n|[^\n]+"),
    "threes": (fim.Units(" ", 2, 3), r"(?s) {1,2}|[^ ]{1,3}"),
}


@given(st.text(alphabet="ab \n\t<PSM>é日\U0001f600\x1c", max_size=60), st.sampled_from(sorted(PATTERNS)))
@settings(max_examples=400, deadline=None)
def test_ranks_against_a_plain_cut(text, name):
    units, pattern = PATTERNS[name]
    pieces = re.findall(pattern, text)
    ranks = fim.Ranks(text, fim.automaton(units), units)
    assert ranks.n == len(pieces)
    assert [ranks.place(k) for k in range(len(pieces) + 1)] == [len("".join(pieces[:k])) for k in range(len(pieces) + 1)]
    assert ranks.marked == any(s in text for s in fim.SENTINELS)


def plain(doc_id, text):
    t = text or ""
    s = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(s[k : k + 8], 16) for k in range(0, 32, 8))
    n = len(t)
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, t
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, z - a, f"<S>{t[z:]}<P>{t[:a]}<M>{t[a:z]}"
    return doc_id, n, "psm", a, z - a, f"<P>{t[:a]}<S>{t[z:]}<M>{t[a:z]}"


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(map(str, r)))


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = fim.fill_in_middle(odd)
    assert got.columns == ["doc_id", "n", "form", "prefix_units", "middle_units", "output"]
    assert key(got.collect()) == key([plain(*r) for r in rows])
    assert fim.fill_in_middle(empty).collect() == []


def test_texts_with_marks_and_edges(spark):
    texts = ["<P>", "a<S>b", "<", "<P", "P>", "<<P", "S><M", "日本語 <S", "x\x00y", "<M<M", "é \U0001f600", "\n", "<P<S<M"]
    rows = [(k, t) for k, t in enumerate(texts * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim.fill_in_middle(df)
    assert key(out.collect()) == key([plain(*r) for r in rows])
    back = out.join(df, "doc_id").select("text", fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(back) == len(rows) and all(r.text == r.back for r in back)
    assert {r.form for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_other_units_and_marks(spark):
    rows = [(k, " ".join(f"w{j}" for j in range(k)) + "\nend") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = ("[[pre]]", "[[suf]]", "{{mid.*}}")
    out = fim.fill_in_middle(df, units=fim.RUNS, sentinels=marks, seed=9, fim_percent=100, spm_percent=50)
    got = out.join(df, "doc_id").withColumn("back", fim.restored(F.col("output"), F.col("form"), marks)).collect()
    for r in got:
        pieces = re.findall(r"\s+|\S+", r.text)
        a, z = r.prefix_units, r.prefix_units + r.middle_units
        p, m, s = "".join(pieces[:a]), "".join(pieces[a:z]), "".join(pieces[z:])
        assert r.n == len(pieces) and r.back == r.text
        assert r.output == (marks[0] + p + marks[1] + s + marks[2] + m if r.form == "psm" else marks[1] + s + marks[0] + p + marks[2] + m)


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "bc", "x"), ("aa", "b", "c"), ("<P>", "x<P>y", "<M>"), ("aba", "x", "y")])
def test_marks_that_overlap_are_refused(marks):
    with pytest.raises(ValueError):
        fim.check_sentinels(marks)


def test_query_against_brute_force(spark):
    where = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{where}/documents.parquet").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(*plain(d.doc_id, d.text)[:5], sha(plain(d.doc_id, d.text)[5]), sha(d.text or "")) for d in docs]
    assert key(queries.op11(spark, where).collect()) == key(want)
