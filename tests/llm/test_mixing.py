import pytest

from lexiforge.llm import mixing


def water(sizes, share=1.5, epochs=2):
    """Targets by the procedure in words: cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > epochs * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: float(epochs * sizes[s]) for s in over}


def test_targets_and_whole_epochs(spark, sample):
    rows = mixing.mix_counts(sample).withColumnRenamed("id", "doc_id").join(sample.select("doc_id", "source"), "doc_id").collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = water(sizes)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert own[0].target == pytest.approx(want[s])
        assert own[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r["size"] for r in own) / 2 + 1e-6
        assert min(r.copies for r in own) >= min(2, int(want[s] // sizes[s]))
        assert max(r.copies for r in own) - min(r.copies for r in own) <= 1
        assert all(r.taken <= 2 * r["size"] for r in own)


def test_the_smallest_keys_are_taken(spark, sample):
    rows = mixing._applied(k := mixing._keyed(sample, "doc_id", "source", "text", None, 7), mixing.plan_mix(k)).withColumnRenamed("id", "i").collect()
    keys = {r.id: r.key for r in k.collect()}
    src = {r.id: r.source for r in k.collect()}
    for s in set(src.values()):
        own = [r for r in rows if src[r.i] == s]
        more = [keys[r.i] for r in own if r.copies == max(x.copies for x in own)]
        less = [keys[r.i] for r in own if r.copies < max(x.copies for x in own)]
        assert not less or max(more) < min(less)


def test_steps_do_not_change_the_result(spark, sample, monkeypatch):
    a = sorted((r.id, r.taken) for r in mixing.mix_counts(sample).collect())
    monkeypatch.setattr(mixing, "STEP_ROWS", 3)
    assert sorted((r.id, r.taken) for r in mixing.mix_counts(sample).collect()) == a


def test_quality_weights_prefer_good_documents(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'one two three' AS text", "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS source")
    labels = spark.range(4000).selectExpr("id AS doc_id", "CAST(id % 4 < 2 AS int) AS quality")
    rows = mixing.mix_counts(docs, mixing.quality_weights(labels), share=1.25).collect()
    b = [r for r in rows if r.id % 2]
    taken = lambda good: sum(r.copies for r in b if (r.id % 4 < 2) == good)
    assert taken(True) > 1.2 * taken(False)


def test_odd_rows(odd, empty):
    rows = mixing.mix_counts(odd).collect()
    assert len(rows) == odd.count()
    assert {r.id: r["size"] for r in rows}[3] == 0
    assert mixing.mix_counts(empty).count() == 0
    wide = mixing.mix_sources(odd).select("row.*")
    assert wide.columns == odd.columns and wide.count() == odd.count()
    assert mixing.mix_counts(odd.filter("text is null or text = ''")).agg({"taken": "sum"}).first()[0] == 0


def test_the_budget_may_end_among_repeated_rows(spark):
    """One id has 900 of 2,000 rows of 20 words; the target is met to within a document's half, by the SQL too."""
    import duckdb

    from lexiforge.llm.queries import OP4_SQL

    docs = spark.createDataFrame([(5 if k < 900 else k, "wort " * 20, None if k % 4 == 0 else "a") for k in range(2000)], "doc_id long, text string, source string")
    for share in (0.45, 1.5):
        rows = mixing.mix_counts(docs, share=share).collect()
        assert len(rows) == 2000
        for target in {r.target for r in rows}:
            assert abs(sum(r.taken for r in rows if r.target == target) - target) <= 10 + 1e-6
        wide = mixing.mix_sources(docs, share=share).filter("copies > 0").collect()
        assert sum(r.taken for r in wide) == sum(r.taken for r in rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT)")
    want = sorted(con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({OP4_SQL})").fetchall())
    assert sorted((r.id, r["size"], r.source_size, r.target, r.taken) for r in rows) == want


def test_many_weights_do_not_move_documents_without_one(spark, sample, odd, monkeypatch):
    """Weights met by a filter of their ids give the same mix as broadcast ones."""
    from lexiforge.llm import common

    labels = spark.createDataFrame([(k, k % 3 % 2) for k in range(0, 200, 3)] + [(7, None), (None, 1)], "doc_id long, quality int")
    for docs in (sample, odd):
        key = lambda: sorted((str(r.id), r.copies, r.taken, round(r.target, 6)) for r in mixing.mix_sources(docs, mixing.quality_weights(labels)).drop("row").collect())  # noqa: E731, B023
        want = key()
        with monkeypatch.context() as m:
            m.setattr(common, "BROADCAST_BYTES", -1)
            assert key() == want
