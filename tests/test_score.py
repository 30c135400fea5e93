import pytest

from lexiforge.functions import fixed as X
from lexiforge.operators.score import ScoreRules, filter_low_quality, rule_score

N, A, C, G = "41/2024/QH15", "Điều 5", "Khoản 2", "thông tư"
TAIL = " người lao động được hưởng chế độ theo năm 30 ngày kể từ khi nghỉ việc, xin xem thêm chi tiết"
Q = "Tôi được nghỉ bao nhiêu ngày trong một năm?"

CASES = [
    ("", Q, 10 - 6, X.REASON_NOTHING),
    (f"{A} {G} ", Q, 5, X.REASON_ARTICLE_ONLY),
    (f"{G} ", Q, 6, X.REASON_WORDS_ONLY),
    (f"{N} ", Q, 9, X.REASON_NUMBER_ONLY),
    (f"{N} {A} {C} ", Q, 10, X.REASON_ALL),
    (f"{A} ", Q, 10, X.REASON_OK),  # an article alone costs nothing
    (f"{N} {A} ", "Gì a?", 8, X.REASON_SHORT_QUESTION),
    (f"{N} {A} ", "Thông tư này quy định những nội dung nào?", 5, X.REASON_VAGUE),
    (f"{N} {A} ", "Tôi hỏi thông tư này quy định những gì?", 10, X.REASON_ALL),
    (f"{N} {A} ", "Tôi được nghỉ bao nhiêu ngày", 9.5, X.REASON_NO_MARK),
    (f"{A} luật này ", Q, 10 - 5 - 2, f"{X.REASON_ARTICLE_ONLY}; {X.REASON_REFERENCE}"),
]


def test_branches(spark):
    rows = [(k, q, head + TAIL.replace("theo", "của")) for k, (head, q, _, _) in enumerate(CASES)]
    got = {r.seq: r for r in rule_score(spark.createDataFrame(rows, "seq int, question string, answer string"), ScoreRules()).collect()}
    for k, (_, _, points, reason) in enumerate(CASES):
        assert (got[k].eval_score, got[k].eval_reason) == (pytest.approx(points), reason), k


def test_scores_stay_within_bounds(spark):
    df = spark.createDataFrame([(None, None), ("", "..."), ("?", "a" * 9000)], "question string, answer string")
    assert all(0 <= r.eval_score <= 10 for r in rule_score(df).collect())


def test_case_and_white_space_are_pythons(spark):
    df = spark.createDataFrame([(Q, f"\u00a0 SỐ\u00a041/2024 ĐIỀU\u00a07" + TAIL)], "question string, answer string")
    assert rule_score(df).first().eval_reason == X.REASON_ALL


def test_low_quality_questions(spark):
    rows = [("Trong văn bản này, BHXH được viết tắt cho cụm từ gì?",), ("Văn bản này quy định về gì?",), ("Tôi đóng bao lâu?",), (None,)]
    kept, removed = filter_low_quality(spark.createDataFrame(rows, "question string"))
    assert kept.count() == 2 and removed.count() == 2
