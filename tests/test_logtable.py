import random

import pytest

from lexiforge.sources.logtable import ConcurrentWrite, LogTable


class Stopped(RuntimeError):
    pass


def table(spark, path):
    return LogTable(spark, str(path), "k string, at timestamp, v int", "k", "at")


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t int, v int").selectExpr("k", "timestamp_seconds(t) AS at", "v")


def content(t):
    df = t.read()
    return None if df is None else {r.k: (int(r.at.timestamp()), r.v) for r in df.collect()}


def test_newest_row_of_the_latest_run_counts(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.read() is None and t.drop_before(5) == 0 and not t.compact()
    t.append(frame(spark, [("a", 5, 1), ("a", 9, 2), ("b", 5, 3), (None, 5, 9)]))
    assert content(t) == {"a": (9, 2), "b": (5, 3), None: (5, 9)}
    t.append(frame(spark, [("a", 1, 4)]))  # an older time, but a later run
    t.drop_keys(frame(spark, [("b", 0, 0), ("nowhere", 0, 0)]))
    assert content(t) == {"a": (1, 4), None: (5, 9)}
    assert t.drop_before(1_000_000) == 1 and content(t) == {None: (5, 9)}
    t.append(frame(spark, [("b", 1, 5), ("a", 2, 6)]))  # rows of after the cut stay, whatever their time
    assert content(t) == {None: (5, 9), "b": (1, 5), "a": (2, 6)}
    t.compact(all_=True)
    assert content(t) == {None: (5, 9), "b": (1, 5), "a": (2, 6)} and len(t.state()[1]["entries"]) == 1
    assert t.size_mb() > 0 and t.vacuum() > 0 and content(t) == {None: (5, 9), "b": (1, 5), "a": (2, 6)}
    t.clear()
    assert t.read() is None


def test_random_changes_against_a_dictionary(spark, tmp_path):
    rng, t, want = random.Random(1), table(spark, tmp_path), {}
    for step in range(24):
        kind = rng.choice(["append", "append", "append", "keys", "before", "compact", "vacuum"])
        if kind == "append":
            rows = [(rng.choice("abcdefgh"), rng.randint(0, 30), 1000 * step + j) for j in range(rng.choice([1, 2, 9]))]
            rows = list({(k, a): (k, a, v) for k, a, v in rows}.values())
            t.append(frame(spark, rows))
            for k, a, v in sorted(rows, key=lambda r: r[1]):
                want[k] = (a, v)
        elif kind == "keys":
            keys = rng.sample("abcdefgh", 2)
            t.drop_keys(frame(spark, [(k, 0, 0) for k in keys]))
            for k in keys:
                want.pop(k, None)
        elif kind == "before":
            limit = rng.randint(0, 20)
            old = [k for k, (a, _) in want.items() if a <= limit]
            assert t.drop_before(limit * 1_000_000) == len(old)
            for k in old:
                del want[k]
        elif kind == "compact":
            t.compact(all_=True)
        else:
            t.vacuum()
        assert (content(t) or {}) == want, (step, kind)
    assert sum("run" in e for e in t.state()[1]["entries"]) <= 6


CHANGES = {
    "append": lambda s, t: t.append(frame(s, [("a", 9, 9), ("z", 1, 1)])),
    "drop_keys": lambda s, t: t.drop_keys(frame(s, [("a", 0, 0)])),
    "drop_before": lambda s, t: t.drop_before(3_000_000),
    "compact": lambda s, t: t.compact(all_=True),
    "clear": lambda s, t: t.clear(),
    "vacuum": lambda s, t: t.vacuum(),
}


@pytest.mark.parametrize("name", sorted(CHANGES))
def test_a_stop_before_any_write_leaves_the_old_or_the_new_state(spark, tmp_path, name):
    """The change is stopped before its first write, its second, and so on until it goes through."""

    def fresh(path):
        t = table(spark, path)
        t.append(frame(spark, [(k, j, j) for j, k in enumerate("abcdefgh")]))
        t.drop_keys(frame(spark, [("h", 0, 0)]))
        t.append(frame(spark, [("b", 2, 20)]))
        return t

    whole = fresh(tmp_path / "whole")
    old = content(whole)
    CHANGES[name](spark, whole)
    new, stops = content(whole), 0
    while True:
        t, seen = fresh(tmp_path / str(stops)), []

        def before(step, stop=stops, seen=seen):
            seen.append(step)
            if len(seen) > stop:
                raise Stopped(step)

        t.before = before
        try:
            CHANGES[name](spark, t)
        except Stopped:
            again = table(spark, tmp_path / str(stops))  # a new process
            assert content(again) in (old, new), (name, seen)
            CHANGES[name](spark, again)
            assert content(again) == new
            again.append(frame(spark, [("new", 7, 7)]))
            assert content(again) == {**(new or {}), "new": (7, 7)}
            stops += 1
            continue
        assert content(t) == new
        break
    assert stops >= (3 if name in ("append", "drop_keys", "compact") else 2 if name != "vacuum" else 1)


def test_batches_are_added_once(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.append(frame(spark, [("a", 1, 1)]), "q", 0) and not t.append(frame(spark, [("a", 1, 2)]), "q", 0)
    assert t.append(frame(spark, [("a", 1, 3)]), "other", 0) and t.append(frame(spark, [("b", 1, 4)]), "q", 1)
    t.compact(all_=True)
    assert not t.append(frame(spark, [("c", 1, 1)]), "q", 1) and content(t) == {"a": (1, 3), "b": (1, 4)}


def test_a_second_writer_is_told(spark, tmp_path):
    t, other = table(spark, tmp_path), table(spark, tmp_path)
    t.append(frame(spark, [("a", 1, 1)]))
    t.before = lambda step: step == "rename" and other.append(frame(spark, [("b", 1, 2)]))
    with pytest.raises(ConcurrentWrite):
        t.append(frame(spark, [("c", 1, 3)]))
    assert content(table(spark, tmp_path)) == {"a": (1, 1), "b": (1, 2)}


def test_runs_at_least_double(spark, tmp_path):
    t = table(spark, tmp_path)
    for k in range(9):
        t.append(frame(spark, [(f"k{k}", k, k)]))
        sizes = [e["rows"] for e in t.state()[1]["entries"]]
        assert all(a > b for a, b in zip(sizes, sizes[1:], strict=False)) and sum(sizes) == k + 1
