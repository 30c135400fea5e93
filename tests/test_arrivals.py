import os

import pytest
from pyspark.sql import functions as F

from lexiforge.plans.curate import Curation
from lexiforge.sources import files
from lexiforge.sources.arrivals import Documents

from .test_plans import settings


def put(folder, name, text, at):
    (folder / name).write_text(text)
    os.utime(folder / name, (at, at))


def noted(folder):
    """Readers that note each file they open."""
    folder.mkdir()

    def read(raw):
        (folder / f"{len(os.listdir(folder))}-{os.getpid()}-{id(raw)}").write_bytes(raw)
        return files.decode(raw)

    return {".txt": read}


def content(d):
    return {r.file_name: r.content for r in d.documents().collect()}


def test_a_second_run_reads_the_one_file_that_changed(spark, tmp_path):
    where, calls = tmp_path / "in", tmp_path / "calls"
    (where / "sub").mkdir(parents=True)
    readers = noted(calls)
    for k in range(5):
        put(where, f"{k}.txt", f"text {k}", 1000 + k)
    put(where, "blank.txt", " \n", 1000)
    put(where, "other.csv", "x", 1000)
    d = Documents(spark, str(tmp_path / "docs"), str(where), batch=3, readers=readers)
    assert d.documents().count() == 0 and d.update() == 6
    assert content(d) == {f"{k}.txt": f"text {k}" for k in range(5)}
    opened = len(os.listdir(calls))
    assert d.update() == 0 and len(os.listdir(calls)) == opened == 6
    put(where, "2.txt", "new 2", 2000)
    assert d.update() == 1 and len(os.listdir(calls)) == opened + 1
    put(where, "2.txt", "new X", 3000)  # the same length
    put(where / "sub", "7.txt", "text 7", 1000)
    os.remove(where / "0.txt")
    assert d.update() == 2
    assert content(d) == {"1.txt": "text 1", "2.txt": "new X", "3.txt": "text 3", "4.txt": "text 4", "7.txt": "text 7"}
    assert sorted(map(str, d.documents().columns)) == sorted(files.read_documents(spark, str(where)).columns)


def test_a_stop_between_batches_reads_nothing_twice(spark, tmp_path):
    where, calls = tmp_path / "in", tmp_path / "calls"
    where.mkdir()
    readers = noted(calls)
    for k in range(6):
        put(where, f"{k}.txt", f"text {k}", 1000 + k)
    d, seen = Documents(spark, str(tmp_path / "docs"), str(where), batch=2, readers=readers), []

    def before(step):
        seen.append(step)
        if step == "run" and seen.count("run") == 3:
            raise RuntimeError("stopped")

    d.before = before
    with pytest.raises(RuntimeError):
        d.update()
    first = d.documents().count()
    assert 2 <= first < 6
    again = Documents(spark, str(tmp_path / "docs"), str(where), batch=2, readers=readers)
    assert again.update() == 6 - first and len(content(again)) == 6 and len(os.listdir(calls)) == 6


def test_the_runs_extraction_is_incremental(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        put(tmp_path / "in", f"{k}.txt", f"Luật số: {k + 1}/2024/QH15\nĐiều {k}. Mức hưởng.", 1000)
    run = Curation(spark, settings(tmp_path))
    assert not run.done("extract") and run.run(["extract"]) == ["extract"] and run.done("extract")
    assert run.seen["rows"] == 3 and run.read("extract").count() == 3
    put(tmp_path / "in", "3.txt", "Luật số: 9/2024/QH15\nĐiều 3. Mức hưởng.", 1000)
    run.run(["extract"])
    assert run.seen["rows"] == 1 and run.read("extract").filter(F.col("metadata.doc_number_short").isNotNull()).count() == 4
