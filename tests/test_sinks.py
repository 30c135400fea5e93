import json

from lexiforge.__main__ import main
from lexiforge.operators import dedup, score, split, temporal
from lexiforge.sources import files, sinks


def test_sinks_round_trip(spark, tmp_path):
    out = str(tmp_path)
    df = spark.createDataFrame([(0, "q?", "a", "d0"), (1, "q?", "long answer", "d1")], "seq long, question string, answer string, source_doc string")
    scored = score.routed(score.rule_score(df))
    sinks.write_evaluated(scored, out)
    assert files.read_jsonl(spark, f"{out}/evaluated").count() == 2
    assert files.read_jsonl(spark, f"{out}/evaluation_stats").first().total == 2
    unique, dup = dedup.dedup_pairs(df)
    sinks.write_duplicates(dup, out)
    assert unique.count() == 1 and files.read_jsonl(spark, f"{out}/qa_duplicates").count() == 1
    sinks.write_splits(split.split_by_document(df), out)
    assert {r.overlap for r in files.read_jsonl(spark, f"{out}/leakage").collect()} == {0}
    sinks.append_status(spark, out, "generate", 1, 4)
    sinks.append_status(spark, out, "generate", 3, 4)
    assert sinks.latest_status(spark, out).first().percent == 75


def test_validate_command(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    qa, laws = tmp_path / "qa.json", tmp_path / "laws.json"
    qa.write_text(json.dumps([{"question": "q", "answer": "theo 1/2020/QH14"}, {"question": "q", "answer": "theo 2/2010/QH12"}]))
    laws.write_text(json.dumps({"documents": [{"id": "1/2020/QH14", "name": "n", "type": "Luật", "effective_date": "2020-01-01"}, {"id": "2/2010/QH12", "name": "n", "type": "Luật", "effective_date": "2010-01-01", "expiry_date": "2020-01-01"}]}))
    assert main(["validate", "--input", str(qa), "--output", str(tmp_path / "out"), "--registry", str(laws), "--date", "2025-12-01"]) == 0
    clean = files.read_jsonl(spark, str(tmp_path / "out" / "clean"))
    assert clean.count() == 1 and clean.first().question.startswith("### Ngày tham chiếu: 01/12/2025")
    assert main(["check", "--file", str(qa)]) == 0


def test_temporal_filter_keeps_unknown(spark):
    laws = spark.createDataFrame([(0, "1/2020/QH14", "n", "Luật", None, None)], "ord int, id string, name string, type string, effective_date date, expiry_date date")
    df = spark.createDataFrame([("q", "9/2020/QH14")], "question string, answer string")
    good, bad = temporal.filter_by_validity(df, laws, "2025-12-01")
    assert good.count() == 1 and bad.count() == 0


def test_json_arrays_and_missing_splits(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", None), (2, "ç", 0.5)], "x long, s string, d double")
    files.write_json(df.repartition(2), str(tmp_path / "j"))
    assert sorted(map(tuple, files.read_json(spark, str(tmp_path / "j"), df.schema).collect())) == sorted(map(tuple, df.collect()))
    for part in (tmp_path / "j").glob("part-*"):
        assert isinstance(json.loads(part.read_text()), list)
    qa = spark.createDataFrame([("q?", "a", "d0")], "question string, answer string, source_doc string")
    sinks.write_splits(qa.selectExpr("*", "'train' AS split"), str(tmp_path / "o"))
    assert files.read_split(spark, str(tmp_path / "o"), "train").count() == 1
    assert files.read_split(spark, str(tmp_path / "o"), "test").count() == 0


def test_earlier_results_and_legacy_export(spark, tmp_path):
    out = str(tmp_path)
    df = spark.createDataFrame([(k, f"q{k}?", "a", "d0") for k in range(30)], "seq long, question string, answer string, source_doc string")
    assert sinks.read_rescued(spark, out).count() == 0
    sinks.write_rescued(df.limit(3), df.limit(0), out)
    assert sinks.read_rescued(spark, out).count() == 3
    for kind, column in (("instruction", "instruction"), ("chat", "messages")):
        sinks.write_legacy(df, out, kind)
        got = files.read_jsonl(spark, f"{out}/legacy_{kind}")
        assert got.count() == 30 and column in got.columns
    sinks.write_final(df, out)
    assert files.read_json(spark, f"{out}/dataset_final_json").count() == files.read_jsonl(spark, f"{out}/dataset_final_jsonl").count() == 30
    assert sinks.status(spark, out).count() == 0
    df.write.parquet(f"{out}/generate")
    assert [(r.step, r.processed) for r in sinks.status(spark, out).collect()] == [("generate", 30)]
    sinks.append_status(spark, out, "generate", 1, 4)
    assert [(r.step, r.percent) for r in sinks.status(spark, out).collect()] == [("generate", 25.0)]


def test_tokenizer_files():
    import pytest

    from lexiforge.operators.tokenize import FileTokenizer

    public = pytest.importorskip("public_tokenizers")
    text = "Căn cứ Điều 1, mức hưởng là 75%."
    whole = FileTokenizer(public.path("byte_bpe_50k.json"), begin=50256)
    ranks = FileTokenizer(public.path("byte_bpe_50k.tiktoken"), pattern=public.PATTERN)
    pieces = FileTokenizer(public.path("piece_bpe_32k.model"), begin=1)
    assert whole.encode(text, True) == [50256, *whole.encode(text, False)]
    assert whole.encode(text, False) == ranks.encode(text, True)
    assert pieces.encode(text, True)[0] == 1 and len(pieces.encode(text, False)) > 5
    with pytest.raises(ValueError, match="unknown kind"):
        FileTokenizer("x.bin").encode("x", False)
