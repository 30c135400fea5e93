import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexiforge.operators import dedup

PAIRS = st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from(["x", "y", "zz", "zz ", "www"])), min_size=1, max_size=12)


def fold(pairs):
    """The fold, pair by pair: question -> (opener, kept)."""
    slots, answers = {}, set()
    for k, (q, a) in enumerate(pairs):
        if q in slots:
            if len(a) > len(pairs[slots[q][1]][1]):
                slots[q] = (slots[q][0], k)
        elif a.strip().lower() not in answers:
            slots[q] = (k, k)
            answers.add(a.strip().lower())
    return sorted(slots.values())


@given(PAIRS)
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_matching_equals_the_fold(spark, pairs):
    df = spark.createDataFrame([(k, q, a) for k, (q, a) in enumerate(pairs)], "seq long, question string, answer string")
    assert sorted((r.opener, r.seq) for r in dedup.fold_pairs(df).filter("kept").collect()) == fold(pairs)


def test_long_chains(spark):
    pairs = [(f"q{(k + 1) // 2}", f"a{k // 2 + 1}") for k in range(16)]
    df = spark.createDataFrame([(k, q, a) for k, (q, a) in enumerate(pairs)], "seq long, question string, answer string")
    assert sorted((r.opener, r.seq) for r in dedup.fold_pairs(df).filter("kept").collect()) == fold(pairs)


def test_question_hash_keeps_the_first(spark):
    df = spark.createDataFrame([(2, "A  b"), (1, " a B "), (3, None), (4, "")], "seq long, question string")
    assert sorted(r.seq for r in dedup.dedup_question_hash(df).collect()) == [1, 3]


def test_neighbours_within_the_band(spark):
    base = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k, base + ("!" if k == 99 else "?" if k == 100 else "") if k in (0, 99, 100) else f"{k:05d}{k * 7:06d}") for k in range(101)]
    got = {(r.i, r.j) for r in dedup.near_pairs(spark.createDataFrame(rows, "seq long, question string")).collect()}
    assert (0, 99) in got and (0, 100) not in got and (99, 100) in got


def test_equal_and_short_questions_are_no_near_pairs(spark):
    df = spark.createDataFrame([(0, "same"), (1, "same"), (2, "ab"), (3, "ab")], "seq long, question string")
    assert dedup.near_pairs(df).count() == 0


def test_near_dup_queries_compare_all_rows(spark, tmp_path):
    import __spark_entry__ as entry

    text = "the quick brown fox jumps over the lazy dog while nobody looks "
    rows = [(k, hashlib.md5(str(k).encode()).hexdigest() * 2) for k in range(2300) if k not in (2202, 2209)]
    rows += [(2202, text[:59] + "x"), (2209, text[:59] + "y")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    q = entry.queries()
    assert [(r.i, r.j) for r in q["near_dup_pairs"](spark, str(tmp_path)).collect()] == [(2202, 2209)]
    assert q["full_report"](spark, str(tmp_path)).first().near_duplicates == 1
