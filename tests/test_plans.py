import json
import zipfile

import pytest

from lexiforge.operators import generate, parse, report
from lexiforge.plans.curate import Curation
from lexiforge.plans.providers import HttpProvider, available_providers, make_provider, make_providers
from lexiforge.plans.settings import ConfigurationError, Settings
from lexiforge.sources import files


def settings(tmp_path, **more):
    tree = {"general": {"input_dir": str(tmp_path / "in"), "output_dir": str(tmp_path / "out")}, "llm": {"provider": "ollama", "providers": {"ollama": {"model": "m"}}}, "processing": {"chunk_size": 600, "chunk_overlap": 50}, "quality": {"max_iterations": 2}}
    return Settings(tree | more)


def test_settings_find_what_is_wrong(tmp_path):
    (tmp_path / "in").mkdir()
    assert settings(tmp_path).check().is_valid
    bad = Settings({"processing": {"chunk_size": -100, "chunk_overlap": 5000}, "output": {"train_ratio": 0.7, "val_ratio": 0.5, "test_ratio": 0.3}})
    assert {f.field for f in bad.check().errors} >= {"processing.chunk_size", "processing.chunk_overlap", "output.ratios", "llm.provider"}
    with pytest.raises(ConfigurationError):
        bad.require()
    assert bad.get("a.b", 3) == 3 and bad.get("output.seed") == 42


def test_providers():
    assert isinstance(make_provider("ollama", {}), HttpProvider)
    assert make_provider("mine", {"base_url": "http://x/v1/"}).base_url == "http://x/v1"
    with pytest.raises(ConfigurationError):
        make_provider("mine", {})
    assert len(make_providers({"name": "groq", "api_keys": ["a", "b"]})) == 2 and len(available_providers()) == 15


def test_requests_of_each_kind():
    answers = {"openai": {"choices": [{"message": {"content": "x"}}]}, "anthropic": {"content": [{"text": "x"}]}, "gemini": {"candidates": [{"content": {"parts": [{"text": "x"}]}}]}}
    for name, answer in answers.items():
        p, sent = make_provider(name, {"api_key": "k", "model": "m"}), []
        p.send = lambda *a, answer=answer, sent=sent: sent.append(a) or answer
        assert p.call("hello") == "x" and "hello" in str(sent[0][1]) and "k" in str(sent[0][2])
        assert ("temperature" in str(sent[0][1])) == (name != "anthropic")


def test_retries():
    class Fails:
        name, calls = "f", 0

        def __init__(self, *outcomes):
            self.outcomes = list(outcomes)

        def call(self, _):
            self.calls += 1
            x = self.outcomes.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

    waits = []
    r = generate.Retries(4, 1.0, waits.append)
    assert r.run(p := Fails(Exception("429 too many"), "", "ok"), "x") == ("ok", None, 3) and p.calls == 3 and len(waits) == 1
    assert r.run(p := Fails(Exception("401 unauthorized"), "ok"), "x")[0] is None and p.calls == 1
    assert [generate.error_kind(m) for m in ("timed out", "503", "connection reset", "?")] == [("timeout", True), ("server_error", True), ("connection_error", True), ("unknown", True)]


def test_parsing():
    assert parse.qa_pairs('```json\n[{"question": " q ", "answer": "a"}, {"question": "x"}]\n```') == [{"question": "q", "answer": "a"}]
    assert parse.qa_pairs("[]") is None and parse.qa_pairs("nothing") is None and parse.qa_pairs(None) is None
    assert parse.verdict('so {"score": 7, "reason": "r"} end') == {"score": 7.0, "reason": "r"}
    assert parse.verdict("x") == {"score": 5.0, "reason": "Parse error"} and parse.verdict("{}") == {"score": 5.0, "reason": "N/A"}
    assert json.loads(parse.json_list('a [1, 2] b')) == [1, 2]


def test_file_sources(spark, tmp_path):
    d = tmp_path / "docs"
    d.mkdir()
    (d / "a.txt").write_bytes("﻿Số: 1/2020/NĐ-CP\n".encode())
    (d / "b.txt").write_bytes("caf\xe9".encode("latin-1"))
    (d / "blank.txt").write_text(" \n")
    (d / "skip_me.txt").write_text("x")
    with zipfile.ZipFile(d / "c.docx", "w") as z:
        w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:r><w:t>one</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>two</w:t></w:r></w:p></w:body></w:document>')
    (d / "broken.docx").write_bytes(b"no zip")
    got = {r.file_name: r for r in files.read_documents(spark, str(d), ignore=("skip*",)).collect()}
    assert set(got) == {"a.txt", "b.txt", "c.docx", "broken.docx"}
    assert got["b.txt"].content == "café" and got["c.docx"].content == "one\ntwo" and got["broken.docx"].error
    assert got["a.txt"].metadata.doc_number_short == "1/2020/NĐ-CP" and got["a.txt"].content[0] == "﻿"
    (tmp_path / "keys").write_text("# c\n\n k1 \nk2\n")
    assert sorted(r.key for r in files.read_keys(spark, str(tmp_path / "keys")).collect()) == ["k1", "k2"]
    (tmp_path / "laws.json").write_text(json.dumps({"documents": [{"id": "1", "name": "n", "type": "Luật", "effective_date": "2020-01-01"}]}))
    law = files.read_registry(spark, str(tmp_path / "laws.json")).first()
    assert (law.ord, law.id, law.expiry_date) == (0, "1", None)


def test_cache_expires(spark):
    cache = spark.createDataFrame([("k", "2025-11-01", "a"), ("k", "2025-11-30", "b"), ("l", "2025-10-01", "c")], "cache_key string, at string, model string").selectExpr("cache_key", "CAST(at AS timestamp) AS created_at", "model")
    assert [(r.cache_key, r.model) for r in generate.fresh(cache, 30, "2025-12-01").collect()] == [("k", "b")]
    assert generate.expired(cache, 30, "2025-12-01").count() == 2
    assert generate.invalidated(cache, cache.filter("cache_key = 'l'")).count() == 2


def test_whole_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(6):
        (tmp_path / "in" / f"{k}.txt").write_text(f"Luật số: {k + 1}/2024/QH15\nLUẬT\nQuy định chung số {k}\n" + "Điều 1. Nội dung quy định về mức hưởng 30 ngày. " * 30)
    run = Curation(spark, settings(tmp_path))
    assert run.run() == ["extract", "generate", "evaluate", "split", "export"]
    assert run.run() == []  # all is done
    assert run.run(["split", "unknown"]) == ["split"]
    assert run.read("extract").count() == 6
    assert run.read("evaluate").groupBy("source_doc").count().count() <= 6
    assert {r.overlap for r in run.read("leakage").collect()} <= {0}
    assert run.summary().first().qa_total > 0
    assert run.retry_failed().count() == run.read("generate").count()
    written = {p.name for p in (tmp_path / "out" / "json").iterdir()}
    assert written >= {"qa_generated", "failed_chunks", "evaluated", "evaluation_stats", "qa_duplicates", "qa_rescued", "qa_still_bad", "chunks_to_regenerate"}
    assert run.read("dataset_final").count() == run.read("split").count()
    assert run.read("report").first().near_duplicates is not None


class Marked:
    """Answers with its key's mark in the question; the first answer of key c fails once for good."""

    paced = False

    def __init__(self, name, key):
        self.name, self.key = name, key

    def call(self, prompt):
        return json.dumps([{"question": f"{self.key} {hash(prompt)}?", "answer": "Căn cứ Điều 1, Khoản 2 Luật số 41/2024/QH15, mức hưởng là 75% trong 30 ngày. " * 2 + prompt[-40:]}])


def test_every_key_is_called(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "keys.txt").write_text("# keys\nb\n\nc\n")
    for k in range(12):
        (tmp_path / "in" / f"{k}.txt").write_text(f"Luật số: {k + 1}/2024/QH15\n" + f"Điều {k}. Mức hưởng 30 ngày. " * 20)
    s = settings(tmp_path, llm={"provider": "own", "providers": {"own": {"base_url": "http://x", "api_key": "a", "api_keys_file": str(tmp_path / "keys.txt")}}})
    keys = s.provider()["api_keys"]
    assert keys == ["a", "b", "c"] and [p.api_key for p in make_providers(s.provider())] == keys
    run = Curation(spark, s, [Marked("own", k) for k in keys])
    assert run.calls["threads"] == 15 and run.calls["retries"].attempts == 5
    run.run(["extract", "generate"])
    assert {r.question[0] for r in run.read("generate").collect()} == {"a", "b", "c"}
    asked = run.cache.read().count()
    run.run(["generate"])  # all from the cache
    assert run.cache.read().count() == asked and {r.from_cache for r in run.read("generate").collect()} == {True}
    some = run.read("generate").select("source_doc", "chunk_id").limit(1)
    assert not run.generate_again(some, "again").first().from_cache
    assert run.cache.read().count() == asked
    assert run.cache.drop_expired(30, "2999-01-01") == asked and run.cache.read().count() == 0
    run.cache.clear()
    assert run.cache.read() is None


def test_the_rate_is_the_whole_runs(spark):
    df = spark.range(6).selectExpr("cast(id AS string) AS prompt")
    out = generate.asked(df, generate.TemplateProvider(), rpm=1).collect()
    assert all(r.calls == 1 and r.error is None for r in out)
    stats = generate.call_stats(generate.asked(df, generate.TemplateProvider())).first()
    assert (stats.requests, stats.calls, stats.errors, stats.success_rate) == (6, 6, 0, 100.0)


def test_earlier_results_and_export_without_splits(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(8):
        (tmp_path / "in" / f"{k}.txt").write_text(f"Luật số: {k + 1}/2024/QH15\n" + f"Điều {k}. Mức hưởng 30 ngày. " * 20)
    run = Curation(spark, settings(tmp_path), [Marked("own", "k")])
    run.run(["extract", "generate", "evaluate"])
    good = run.read("evaluate").filter("label = 'good'").count()
    assert good and run.export().count() == good and run.read("evaluate").count() >= good
    later = Curation(spark, settings(tmp_path), [Marked("own", "k")])
    assert later.rescued().count() == run.rescued().count()
    assert later.run() == ["split", "export"] and later.read("dataset_final").count() == later.read("split").count()


def test_order_of_pairs_is_unique(spark):
    """200,000 documents: no two share an order, which 31 bits of a hash could not promise."""
    pairs = spark.range(200_000).selectExpr("concat('d', id) AS source_doc", "cast(id % 3 AS int) AS chunk_id", "cast(0 AS int) AS place")
    assert Curation.with_seq(pairs).select("seq").distinct().count() == 200_000


def test_ties_keep_the_order_of_appearance(spark):
    df = spark.createDataFrame([(3, "b"), (1, "c"), (2, "b"), (0, "c"), (4, "a")], "seq long, source_doc string")
    assert [r.source_doc for r in report.by_source(df).collect()] == ["c", "b", "a"]
