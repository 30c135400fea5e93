from lexiforge.functions import fixed as X
from lexiforge.operators import export, temporal, tokenize

LAWS = "ord int, id string, name string, type string, effective_date date, expiry_date date, status string"


def laws(spark):
    import datetime as d

    rows = [(0, "1/2020/QH14", "one", "Luật", d.date(2020, 1, 1), None, "active"), (1, "2/2010/QH12", "two", "Luật", d.date(2010, 1, 1), d.date(2025, 12, 1), "expired"), (2, "3/2026/QH15", "three", "Luật", d.date(2027, 1, 1), None, "pending"), (3, "4/2021/NĐ-CP", "four", "Nghị định", d.date(2025, 12, 1), d.date(2025, 12, 2), "active")]
    return spark.createDataFrame(rows, LAWS)


def pairs(spark, *answers):
    return spark.createDataFrame([(k, "q?", a) for k, a in enumerate(answers)], "seq int, question string, answer string")


def test_status_on_boundary_days(spark):
    got = {r.id: r.status for r in temporal.law_status(laws(spark), "2025-12-01").collect()}
    assert got == {"1/2020/QH14": "active", "2/2010/QH12": "expired", "3/2026/QH15": "expired", "4/2021/NĐ-CP": "active"}


def test_strict_and_lenient(spark):
    df = pairs(spark, "1/2020/QH14 2/2010/QH12", "2/2010/QH12", "9/1999/QH1", None)
    of = lambda strict: [r._validation.is_valid for r in temporal.validated(df, laws(spark), "2025-12-01", strict).orderBy("seq").collect()]
    assert of(True) == [False, False, True, True] and of(False) == [True, False, True, True]
    checked = temporal.validated(df, laws(spark), "2025-12-01")
    assert temporal.validity_stats(checked).first().valid_rate == 50
    assert {(r.law_id, r.kind): r.n for r in temporal.law_usage(checked).collect()} == {("2/2010/QH12", "expired"): 2}
    assert [c for c in temporal.without_private(checked).columns if c[0] == "_"] == []


def test_citations_in_order_and_cut_at_special_letters(spark):
    df = pairs(spark, "TT 59/2024/TT-BLĐTBXH, 5/2024/QH15 và 5/2024/QH15, 12/QĐ-BHXH").select(temporal.citations("answer").alias("c"))
    assert df.first().c == ["5/2024/QH15", "59/2024/TT-BL", "12/QĐ-BHXH"]


def test_each_row_on_its_own_date(spark, monkeypatch):
    """Versions of one law, boundaries of intervals, dates of many buckets, hot laws, rows without a date or an answer."""
    import datetime as d
    import random

    rng, day = random.Random(3), lambda k: d.date(2010, 1, 1) + d.timedelta(days=k)
    versions = [(k, f"{k % 9 + 1}/2010/QH1", "n", "Luật", day(a := rng.randint(0, 4000)), None if k % 4 == 0 else day(a + rng.randint(0, 2000))) for k in range(40)]
    versions += [(41, "77/2010/QH1", "n", "Luật", None, None)]
    registry = spark.createDataFrame(versions, "ord int, id string, name string, type string, effective_date date, expiry_date date")
    rows = [(k, "q?", " ".join(f"{rng.randint(1, 11) if k % 3 else 1}/2010/QH1" for _ in range(rng.randint(0, 4))), day(rng.choice([v[4] for v in versions[:-1]]).toordinal() - day(0).toordinal() if k % 2 else rng.randint(-500, 7000))) for k in range(300)]
    rows += [(900, "q?", "1/2010/QH1", None), (901, None, None, day(5)), (902, "q?", "77/2010/QH1 99/1999/QH1", day(5))]
    df = spark.createDataFrame(rows, "seq int, question string, answer string, day date")

    def status(id_, on):
        if on is None:
            return "unknown"
        own = [(a, z) for _, i, _, _, a, z in versions if i == id_]
        return "unknown" if not own else "active" if any(a and a <= on and (z is None or z > on) for a, z in own) else "expired"

    want = {}
    for k, q, a, on in rows:
        cited = list(dict.fromkeys((f"{q or ''}\n{a or ''}").split()))
        cited = [c for c in cited if c.endswith("/QH1")]
        by = {n: [c for c in cited if status(c, on) == n] for n in ("active", "expired", "unknown")}
        want[k] = (not by["expired"], len(cited), by["active"], by["expired"], by["unknown"])
    for hot in (temporal.HOT, 3):
        monkeypatch.setattr(temporal, "HOT", hot)
        got = {r.seq: tuple(r._validation) for r in temporal.validated_on(df, registry, "day", "seq").collect()}
        assert got == want
    lenient = {r.seq: r._validation.is_valid for r in temporal.validated_on(df, registry, "day", "seq", strict=False).collect()}
    assert lenient == {k: bool(a) or not e for k, (_, _, a, e, _) in want.items()}
    assert temporal.validated_on(df.limit(0), registry, "day", "seq").collect() == []
    assert {r._validation.unknown == [] for r in temporal.validated_on(df.filter("seq < 300"), registry.limit(0), "day", "seq").collect()} == {True, False}


def test_context(spark):
    r = temporal.add_context(pairs(spark, "1/2020/QH14 4/2021/NĐ-CP 2/2010/QH12"), laws(spark), "2025-12-01").first()
    assert r.question == "### Ngày tham chiếu: 01/12/2025\n### Văn bản áp dụng: 1/2020/QH14\n\n### Câu hỏi:\nq?"
    assert sorted(r.applicable_laws) == ["1/2020/QH14", "4/2021/NĐ-CP"]


def test_export_layouts(spark):
    df = spark.createDataFrame([("", "i?", "a", "s")], "question string, instruction string, answer string, source string")
    chat = export.formatted(df, "chat", source=True).first()
    assert [m.role for m in chat.messages] == ["system", "user", "assistant"] and chat.messages[1].content == "i?" and chat.source == "s"
    assert export.formatted(df, "instruction").columns == ["instruction", "input", "output"]


def test_templates(spark):
    df = pairs(spark, "a {user} $1")
    for name, (before, after) in X.CHAT_TEMPLATES.items():
        want = before.replace("{system}", "S").replace("{user}", "q?") + "a {user} $1" + after
        assert df.select(export.chat_text("question", "answer", name, "S").alias("t")).first().t == want


def test_prompt_names_at_most_three_documents(spark):
    df = pairs(spark, " ".join(f"Nghị định {k}/2021/NĐ-CP" for k in (4, 5, 6, 7)), "none")
    rows = export.with_system_prompt(df, laws(spark)).orderBy("seq").collect()
    assert "- Nghị định số 4/2021/NĐ-CP (active)\n- NGHỊ ĐỊNH số 5/2021/NĐ-CP\n- NGHỊ ĐỊNH số 6/2021/NĐ-CP\n" in rows[0].system_prompt
    assert "7/2021" not in rows[0].system_prompt and rows[1].system_prompt.endswith(X.PROMPT_GENERAL)


def test_labels(spark):
    t = tokenize.tokenized(pairs(spark, "ans", ""), template="chatml", system="S", max_length=120)
    r = t.first()
    assert t.count() == 1 and len(r.input_ids) == len(r.labels) == len(r.attention_mask) == 120
    prompt = len(X.CHAT_TEMPLATES["chatml"][0].format(system="S", user="q?"))
    assert r.labels[:prompt] == [-100] * prompt and r.labels[prompt] == r.input_ids[prompt]
    assert all(x == -100 for x, m in zip(r.labels, r.attention_mask, strict=True) if m == 0)


def test_registries_have_a_bound(spark):
    import pytest

    from lexiforge.operators import temporal

    laws = spark.range(20).selectExpr("cast(id AS string) AS id")
    assert temporal.bounded(laws, 20) is laws
    with pytest.raises(ValueError, match="registry"):
        temporal.bounded(laws, 19)
