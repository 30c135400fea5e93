import re

from pyspark.sql import functions as F

from lexiforge.functions import fixed as X
from lexiforge.operators import metadata, rescue

DOCS = "seq int, file_name string, content string"


def docs(spark, *rows):
    return metadata.extract_metadata(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], DOCS))


def test_metadata_of_headers(spark):
    rows = [
        ("a", "CHÍNH PHỦ\nSố:  143/2018/NĐ - CP\nHà Nội, ngày 5 tháng 7 năm 2025\nNGHỊ ĐỊNH\nngắn\nNGHỊ ĐỊNH\nQuy định chi tiết thi hành luật\nChính phủ ban hành"),
        ("b", "Số: 12/2025/NĐ về\nHà Nội, ngày 31 tháng 2 năm 2024 và ngày 1 tháng 12 năm 2024"),
        ("c", "luật số: 41/2024/qh15"),
        ("d", ""),
        ("e", None),
    ]
    got = {r.file_name: r.metadata for r in docs(spark, *rows).collect()}
    assert got["a"].doc_number == "Nghị định số 143/2018/NĐ-CP" and got["a"].issued_date == "05/07/2025"
    assert got["a"].title == "Quy định chi tiết thi hành luật" and got["a"].issued_by == "Chính phủ"
    assert got["b"].doc_number_short == "12/2025/NĐ-CP" and got["b"].issued_date is None
    assert got["c"].doc_type == "Luật số"
    assert got["d"].doc_number is None and got["e"].title is None


def test_numbers_from_files(spark):
    names = ["11_2025_TT-BNV_663712.txt", "274_2025_ND-CP_653507.txt", "74_2025_QH15_530912.txt", "2222_QD-BHXH_667488.txt", "x.txt", None]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(metadata.number_from_file("n").alias("x")).collect()
    assert [r.x and r.x.number for r in got] == ["11/2025/TT-BNV", "274/2025/NĐ-CP", "74/2025/QH15", "2222/QD-BHXH", None, None]


EXAMPLES = [
    ("Theo Điều 7 của văn bản không có số hiệu, ...", "Theo Điều 7 của Nghị định số 1/2020/NĐ-CP ngày 01/02/2020, ..."),
    ("áp dụng của văn bản không có số hiệu.", "áp dụng của Nghị định số 1/2020/NĐ-CP ngày 01/02/2020."),
    ("Căn cứ Điều 5 của Nghị định, mức", "Căn cứ Điều 5 của Nghị định số 1/2020/NĐ-CP, mức"),
    ("Căn cứ Điều 21, Khoản 2 Thông tư này, mức", "Căn cứ Điều 21, Khoản 2 Nghị định số 1/2020/NĐ-CP, mức"),
    ("Căn cứ Điều 9: mức", "Căn cứ Điều 9 Nghị định số 1/2020/NĐ-CP: mức"),
    ("Căn cứ quy định tại Chương II", "Căn cứ quy định tại Nghị định số 1/2020/NĐ-CP, Chương II"),
    ("Nghị định chưa rõ số hiệu", "Nghị định số 1/2020/NĐ-CP"),
    ("Căn cứ Điều 1: x. Căn cứ Điều 2: y", "Căn cứ Điều 1 Nghị định số 1/2020/NĐ-CP: x. Căn cứ Điều 2: y"),
    ("không trích dẫn", None),
]


def test_rewrites(spark):
    d = docs(spark, ("s", "Số: 1/2020/NĐ-CP\nngày 1 tháng 2 năm 2020"))
    qa = spark.createDataFrame([("s", a) for a, _ in EXAMPLES], "source_doc string, answer string")
    good, bad = rescue.rescue(qa, d)
    assert sorted(r.answer for r in good.collect()) == sorted(x for _, x in EXAMPLES if x)
    assert [r.answer for r in bad.collect()] == ["không trích dẫn"]
    assert {(r.rescued, r.doc_added, r.eval_score) for r in good.collect()} == {(True, "1/2020/NĐ-CP", 10.0)}


def test_gates(spark):
    d = docs(spark, ("s", "Số: 1/2020/NĐ-CP"))
    rows = [("s", "Căn cứ Điều 9: theo 2/2019/TT-BYT"), ("s", "Căn cứ Điều 9: phần chế độ"), ("t", "Căn cứ Điều 9: mức"), ("s", None)]
    good, bad = rescue.rescue(spark.createDataFrame(rows, "source_doc string, answer string"), d)
    assert good.count() == 0 and bad.count() == 4


def test_special_characters_in_numbers_are_literal(spark):
    qa = spark.createDataFrame([("Căn cứ Điều 9: mức",)], "answer string").withColumn("doc_info", F.struct(F.lit(r"1/2020/A$1\x").alias("number"), F.lit("K").alias("kind"), F.lit(None).cast("string").alias("issued_date"), F.lit(None).cast("string").alias("issued_by")))
    assert rescue.rewritten(qa).first()._new == r"Căn cứ Điều 9 K 1/2020/A$1\x: mức"


def test_every_rule_applies_first_to_something(spark):
    """The rules against Python's re on all the examples above: the first that matches is the one that is applied."""
    every = X.RESCUE_RULES
    assert len(every) == 56
    d = docs(spark, ("s", "Số: 1/2020/NĐ-CP"))
    starts = ["Theo điểm a khoản 1 Điều 2 của văn bản không có số hiệu", "ban hành kèm theo văn bản không có số hiệu", "của Luật chưa rõ số hiệu", "Theo Khoản 1 Điều 2 của Luật ,", "Phụ lục II kèm theo Thông tư này", "Theo khoản 3 của văn bản", "Theo hướng dẫn tại mục 1.2,", "Căn cứ Điều 16.2, Luật này", "Theo Điều 3 Luật này", "Căn cứ Phụ lục kèm theo Nghị định", "Căn cứ khoản 2 Điều 4:", "Căn cứ điểm a khoản 2:", "Theo Điều 4, khoản 1,", "Căn cứ Ví dụ 3 Điều 4 thì", "Căn cứ mục 2 Hướng dẫn:", "Căn cứ Phần II.1a:"]
    out = {r.answer0: r._new for r in rescue.rewritten(rescue.resolve_numbers(spark.createDataFrame([("s", a, a) for a in starts], "source_doc string, answer string, answer0 string"), d)).collect()}
    for a in starts:
        pattern, lead, tail, _ = next(r for r in every if re.search(r[0], a))
        m = re.search(pattern, a)
        groups = m.groups()
        want = a[: m.start()] + (groups[0] if groups else "") + lead + "Nghị định số 1/2020/NĐ-CP" + tail + (groups[1] if len(groups) > 1 else "") + a[m.end() :]
        assert out[a] == want


def test_the_plan_compiles(spark):
    """Without its fallback Spark raises where generated code is too large for the JVM."""
    assert all(p.lstrip("(?:[")[0] in X.RESCUE_LETTERS for p, *_ in X.RESCUE_RULES)
    d = docs(spark, ("s", "Số: 1/2020/NĐ-CP"))
    good, _ = rescue.rescue(spark.createDataFrame([("s", a) for a, _ in EXAMPLES], "source_doc string, answer string"), d)
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert len(good.collect()) == len(EXAMPLES) - 1
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
