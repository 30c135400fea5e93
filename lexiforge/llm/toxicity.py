"""Toxicity: Levenshtein automata intersected with a lexicon trie, scores of the context, logistic regression.

The lexicon (words, and stems that any ending may follow) is learned from a bounded sample of labelled rows, whose words
are counted where the rows are; only terms that passed every test and the fitted rows' features reach the driver. Stems that
clean texts have by chance, but hardly ever in two forms, are weak: they count by their different forms. A word is matched
by walking the intersection of the trie and the Levenshtein automaton of each entry; its states are made when they are first met and remembered, so that most words die after a few characters. The window around each hit says
whether the term is quoted or aimed at somebody, and a document's score is a logistic function of its hits by kind.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, cut, release, remove, small, written_at

THRESHOLD = 0.3
#: Bound of the labelled sample: about so many rows of label 1 and CLEAN times as many of label 0, of any length.
PER_LABEL, CLEAN = 3000, 3
#: A term needs so many different contexts in toxic texts at least, and so many that chance, which would put each into a
#: clean text with their share, has a probability of exp(-EVIDENCE); and at most so many clean texts for each toxic one.
CONTEXTS, EVIDENCE, IMPURE = 5, 12.0, 0.02
#: The same share for a weak stem, of texts with two forms of it; its forms at least.
WEAK_IMPURE, FORMS = 0.05, 5
STEMS = (4, 5, 6, 7)
#: Terms that a task counts before it passes them on.
COUNTED = 500_000
#: Words on each side of a hit that make up its context.
WINDOW = 6
WORDS_KEPT = 200_000
#: Letters; digits and signs that stand for a letter inside a word.
WORD = re.compile(r"[^\W\d_]+(?:[\d*@$]{1,2}[^\W\d_]+)*")
# Quotation marks; words that report speech; words that address somebody (English, German, French, Spanish).
QUOTES = set("\"“”„«»‹›‟")
REPORTING = frozenset("said says say called calls call quoted quote quotes wrote writes word words term sagte sagt nannte wort dit disait appelé mot dijo dice llamó palabra".split())
ADDRESS = frozenset("you your youre du dich ihr tu toi vous eres tú usted".split())
EXACT, STEM, FUZZY, WEAK = 0, 1, 2, 3
FEATURES = 9


class Automaton:
    """Trie of the lexicon met with the Levenshtein automata of its entries, made deterministic as far as it is needed.

    entries: term -> open (a stem). Terms of 5 letters or more may have one edit, of 10 or more two; stems of 6 or more one.
    """

    def __init__(self, entries: dict[str, bool]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[bool, int] | None] = [None]
        self.reach = [0]  # most edits that an entry below allows
        for term, is_stem in sorted(entries.items()):
            budget, node = self.budget(term, is_stem), 0
            self.reach[0] = max(self.reach[0], budget)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], budget)
            if self.ends[node] is None or is_stem:
                self.ends[node] = (is_stem, budget)
        self.start = self._closed({0: 0})
        self.steps: dict[frozenset, dict[str, frozenset]] = defaultdict(dict)
        self.verdicts: dict[frozenset, tuple[int | None, bool]] = {}

    @staticmethod
    def budget(term: str, is_stem: bool) -> int:
        return int(len(term) >= 6) if is_stem else 2 if len(term) >= 10 else int(len(term) >= 5)

    def _closed(self, state: dict[int, int]) -> frozenset:
        """With letters of the entry left out."""
        todo = list(state.items())
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e + 1 <= self.reach[child] and state.get(child, 99) > e + 1:
                    state[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(state.items())

    def step(self, state: frozenset, c: str) -> frozenset:
        nxt: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.reach[node] and nxt.get(node, 99) > e:
                nxt[node] = e

        for node, e in state:
            put(node, e + 1)  # a letter too many
            for letter, child in self.children[node].items():
                put(child, e + (letter != c))
        return self._closed(nxt)

    def _verdict(self, state: frozenset) -> tuple[int | None, bool]:
        """Kind of the best whole match in a state; whether a stem is complete, which nothing after it can undo."""
        best, stem = None, False
        for node, e in state:
            end = self.ends[node]
            if end and e <= end[1]:
                kind = FUZZY if e else STEM if end[0] else EXACT
                best = kind if best is None else min(best, kind)
                stem = stem or (end[0] and e == 0)
        return best, stem

    def match(self, word: str) -> int | None:
        """EXACT, STEM, FUZZY or None."""
        state, steps, verdicts = self.start, self.steps, self.verdicts
        fuzzy_stem = False
        for c in word:
            nxt = steps[state].get(c)
            if nxt is None:
                if len(steps) > 50_000:
                    steps.clear()
                nxt = steps[state][c] = self.step(state, c)
            if not nxt:
                return FUZZY if fuzzy_stem else None
            state = nxt
            if state not in verdicts:
                if len(verdicts) > 50_000:
                    verdicts.clear()
                verdicts[state] = (*self._verdict(state), any(self.ends[n] and self.ends[n][0] and e <= self.ends[n][1] for n, e in state))
            _, stem, near = verdicts[state]
            if stem:
                return STEM
            fuzzy_stem = fuzzy_stem or near
        kind = verdicts[state][0] if word else None
        return kind if kind is not None else FUZZY if fuzzy_stem else None


@dataclass
class Model:
    entries: dict[str, bool] = field(default_factory=dict)
    weak: frozenset = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))
    _automaton: Automaton | None = None
    _known: dict = field(default_factory=dict)

    def __getstate__(self):
        return {"entries": self.entries, "weak": self.weak, "weights": self.weights, "_automaton": None, "_known": {}}

    def forget(self) -> None:
        """Drops what was remembered of words, at the end of a task."""
        self._known.clear()
        release()

    def hits(self, text: str) -> tuple[list[tuple[str, int, int]], int]:
        """(word, position among the words, kind) of every hit, and the number of words."""
        if self._automaton is None:
            self._automaton = Automaton(self.entries)
        known, words = self._known, WORD.findall(text.lower())
        new = {w for w in set(words) if w not in known}
        if new:
            if len(known) + len(new) > WORDS_KEPT:
                known.clear()
                new = set(words)
            match, weak = self._automaton.match, self.weak
            for w in new:
                kind = match(w)
                known[w] = WEAK if kind is None and any(w[:n] in weak for n in STEMS if len(w) > n) else kind
        kinds = list(map(known.__getitem__, words))
        return [(words[k], k, x) for k, x in enumerate(kinds) if x is not None], len(words)

    def features(self, text: str | None) -> np.ndarray:
        """By kind the weighed hits in abuse, those in quotations, hits by words; the weighed different forms of weak stems, and those beyond one."""
        out = np.zeros(FEATURES)
        if not text or not (self.entries or self.weak):
            return out
        found, n = self.hits(text)
        if not found:
            return out
        lower = text.lower()
        spans = list(WORD.finditer(lower))
        words = [m.group() for m in spans]
        strong, forms = 0, {}
        for word, k, kind in found:
            a, z = max(0, k - WINDOW), min(len(words), k + WINDOW + 1)
            before, after = lower[spans[a].start() : spans[k].start()], lower[spans[k].end() : spans[z - 1].end() + 2]
            around = words[a:k] + words[k + 1 : z]
            quoted = not QUOTES.isdisjoint(before) and not QUOTES.isdisjoint(after)
            told = not REPORTING.isdisjoint(around)
            aimed = not ADDRESS.isdisjoint(around)
            abuse = min(1.0, max(0.0, 1 - 0.6 * quoted - 0.3 * told + 0.4 * aimed))
            if kind == WEAK:
                forms[word] = max(forms.get(word, 0.0), abuse)
            else:
                strong += 1
                out[kind] += abuse
                out[3 + kind] += 1 - abuse
        out[:6] = np.log1p(out[:6])
        out[6] = np.log1p(100 * strong / n)
        weak = sum(forms.values())
        out[7:] = np.log1p(weak), np.log1p(max(0.0, weak - 1))
        return out

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights[:-1] + self.weights[-1], -30, 30))))


def terms(words: set[str]) -> dict[tuple[str, bool], int]:
    """(term, whether it is a stem) -> different words of a text that have it."""
    out = {(w, False): 1 for w in words if len(w) >= 3}
    for w in words:
        for n in STEMS:
            if len(w) > n:
                out[w[:n], True] = out.get((w[:n], True), 0) + 1
    return out


def evidence(rows: DataFrame) -> DataFrame:
    """term, stem, toxic, toxic2, clean, clean2: texts of each label that have it, and that have it in two words; rows: t, y."""
    import pyarrow as pa

    def passed(counts: dict) -> pa.RecordBatch:
        keys, n = list(counts), np.array(list(counts.values()), np.int64).reshape(-1, 4)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), *[pa.array(n[:, i]) for i in range(4)]], names=["term", "stem", "toxic", "toxic2", "clean", "clean2"])

    def run(batches: Iterator) -> Iterator:
        counts: dict = defaultdict(lambda: [0, 0, 0, 0])
        for b in batches:
            for t, y in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                at = 0 if y else 2
                for x, n in terms(set(WORD.findall(t.as_py().lower()))).items():
                    own = counts[x]
                    own[at] += 1
                    own[at + 1] += n > 1
                if len(counts) > COUNTED:
                    yield passed(counts)
                    counts.clear()
        yield passed(counts)

    counted = rows.select("t", "y").mapInArrow(run, "term string, stem boolean, toxic long, toxic2 long, clean long, clean2 long")
    return counted.groupBy("term", "stem").agg(*[F.sum(n).alias(n) for n in ("toxic", "toxic2", "clean", "clean2")])


def contexts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """term, stem, contexts, forms: different neighbours and different words of the wanted (term, stem) in toxic texts."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            for t in b.column(0):
                words = ["", *WORD.findall(t.as_py().lower()), ""]
                found = set()
                for k in range(1, len(words) - 1):
                    w = words[k]
                    around = (words[k - 1], words[k + 1], w)
                    found.add((w, False, *around))
                    for n in STEMS:
                        if len(w) > n:
                            found.add((w[:n], True, *around))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["term", "stem", "before", "after", "word"])

    found = rows.filter("y = 1").select("t").mapInArrow(run, "term string, stem boolean, before string, after string, word string")
    found = found.join(small(wanted, wanted.count(), 48), ["term", "stem"], "left_semi").distinct()
    return found.groupBy("term", "stem").agg(F.count_distinct("before", "after").alias("contexts"), F.count_distinct("word").alias("forms"))


def lexicon(rows: DataFrame) -> tuple[dict[str, bool], frozenset]:
    """(term -> is a stem, weak stems) from rows (t, y) of different texts.

    A term stands in at least CONTEXTS different contexts of toxic texts (so near copies of one text count as one) and
    in at most IMPURE clean texts for each toxic one. A stem is a beginning that several such words share. A weak stem is
    one for which this holds of the texts that have two forms of it.
    """
    sizes = {r.y: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1):
        return {}, frozenset()
    clean = sizes.get(0, 0)
    least = max(CONTEXTS, math.ceil(EVIDENCE / math.log1p(clean / sizes[1])) if clean else CONTEXTS)
    even = sizes[1] / max(1, clean)
    pure = (F.col("toxic") >= least) & (F.col("clean") * even <= IMPURE * F.col("toxic"))
    weak = F.col("stem") & (F.col("toxic2") >= least) & (F.col("clean2") * even <= WEAK_IMPURE * F.col("toxic2"))
    found = cut(evidence(rows).withColumns({"pure": pure, "weak": weak}).filter("pure or weak"))
    passed = found.join(contexts(rows, found.select("term", "stem")), ["term", "stem"]).filter(F.col("contexts") >= least).filter(F.col("pure") | (F.col("forms") >= FORMS))
    # Terms that passed every test: some of those of the bounded sample.
    found = {(r.term, r.stem): r for r in passed.collect()}
    near = {x: (r.contexts, r.forms) for x, r in found.items()}
    loose: list[str] = []
    for _, n, term in sorted((-r.toxic2, len(r.term), r.term) for x, r in found.items() if r.weak and not r.pure and near[x][1] >= FORMS):
        if not any(term.startswith(s) or s.startswith(term) for s in loose):
            loose.append(term)
    strong = sorted(((near[x][0], x) for x, r in found.items() if r.pure), key=lambda s: (-s[0], s[1]))
    strong = [(n, x) for n, x in strong if not any(x[0].startswith(s) for s in loose)]  # a form of a weak stem is weak
    words = {x[0]: n for n, x in strong if not x[1]}
    stems: list[str] = []
    for n, (term, is_stem) in strong:
        if is_stem and near[term, True][1] >= 3 and not any(w.startswith(term) and words[w] > n / 2 for w in words):
            if not any(term.startswith(s) or s.startswith(term) for s in stems):
                stems.append(term)
    out = dict.fromkeys(stems, True)
    for w in sorted(words, key=lambda w: (-words[w], w)):
        if not any(w.startswith(s) for s in stems):
            out.setdefault(w, False)
    return out, frozenset(loose)


def features(rows: DataFrame, model: Model) -> DataFrame:
    """y and x, the features of t."""
    import pyarrow as pa

    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([shared.value.features(t.as_py()).tolist() for t in b.column(0)], pa.list_(pa.float64()))], names=["y", "x"])
        shared.value.forget()

    return rows.select("t", "y").mapInArrow(run, "y int, x array<double>")


def regress(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05, steps: int = 40) -> np.ndarray:
    """Logistic regression with an intercept by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-4
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + penalty * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 4 / max(1e-9, float(np.abs(step).max())))
    return w


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic", per_label: int = PER_LABEL) -> Model:
    """A model from labelled rows for which may_learn (a condition on the column `id`) holds.

    The rows are chosen by a hash of their id, about per_label of label 1 and CLEAN times as many of label 0; an id with
    several labels has the highest, and so has a text that stands under several ids: each text is learned from once. Rows of
    any length count. Texts stay where they are: their words are counted, and their features made, in tasks. Without toxic
    rows the model says 0 everywhere.
    """
    marked = labels.select(col(labels, label_id).alias("id"), col(labels, label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)").filter(may_learn)
    marked = cut(marked.groupBy("id").agg(F.max("y").alias("y")))
    sizes = {r.y: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    none = Model(weights=np.r_[np.zeros(FEATURES), -30.0])
    if not sizes.get(1):
        return none
    share = F.when(F.col("y") == 1, F.lit(min(1.0, per_label / sizes[1]))).otherwise(F.lit(min(1.0, CLEAN * per_label / max(1, sizes.get(0, 0)))))
    lot = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("toxic"), F.col("id").cast("string"))), 1, 8), 16, 10).cast("double") / float(2**32)
    chosen = cut(marked.filter(lot < share))
    own = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t")).filter("t is not null")
    found = own.join(small(chosen, chosen.count(), 32), "id")
    rows, path = written_at(found.groupBy(F.md5("t").alias("h")).agg(F.first("t").alias("t"), F.max("y").alias("y")).select("t", "y"), "toxic-rows")
    model = Model(*lexicon(rows))
    fitted = features(rows, model).collect()  # FEATURES numbers for each of the sample's rows, bounded by per_label
    remove(docs.sparkSession, path)
    y = np.array([r.y for r in fitted], float)
    if not y.any():
        return none
    order = np.lexsort((*np.array([r.x for r in fitted]).T, y))  # the same sums in the same order each time
    x, y = np.array([r.x for r in fitted])[order], y[order]
    prior = sizes[1] / (sizes[1] + sizes.get(0, 0))
    weight = np.where(y == 1, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum())) * len(y)
    model.weights = regress(x, y, weight)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, score (0 to 1), predicted (1 from the threshold on). Null and empty texts get the score
    of a text without hits. Only the text is used; null and repeated ids give rows of their own."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)  # terms of the bounded sample

    def run(batches: Iterator) -> Iterator:
        own = shared.value
        for b in batches:
            got = [own.score(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64()), pa.array([int(s >= threshold) for s in got], pa.int32())], names=["id", "score", "predicted"])
        own.forget()

    ids = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t"))
    return ids.mapInArrow(run, f"id {ids.schema['id'].dataType.simpleString()}, score double, predicted int").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that the model does not reject."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            yield b.filter(pa.array([shared.value.score(x.as_py()) < threshold for x in b.column(at)], pa.bool_()))
        shared.value.forget()

    return docs.mapInArrow(run, docs.schema)
