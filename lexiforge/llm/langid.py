"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies cover all documents that may be learned from. The weights are fitted with follow-the-regularised-
leader (per-coordinate rates, elastic-net penalties) on a bounded sample of PER_LANG documents a language, and the
temperature of the probabilities on a fifth of that sample which the weights have not seen. Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, cut

#: Hashed n-grams of 1 to NGRAM characters, 2**HASH_BITS features.
NGRAM, HASH_BITS = 3, 15
#: Bound of the sample that the weights are fitted on: about so many documents of each language.
PER_LANG = 600
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.002, 0.001, 3
#: Most languages of a model.
MOST = 1000
UNDETERMINED = "und"

_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000))
    return _TABLE[0]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and how often each occurs; what isn't a letter counts as a gap."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where((c >= 0x10000) | _letters()[np.minimum(c, 0xFFFF)], c, 32).astype(np.uint32)
    c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]] if len(c) else c  # one gap between words
    c = np.concatenate([[32], c, [32]]).astype(np.uint32)
    h, parts = c * np.uint32(0x9E3779B1), []
    for n in range(1, NGRAM + 1):
        if n > 1:
            if len(c) < n:
                break
            h = (h[:-1] ^ np.uint32(0x5BD1E995 * n & 0xFFFFFFFF)) * np.uint32(0x01000193) + c[n - 1 :] * np.uint32(0x85EBCA6B)
        own = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - HASH_BITS)
        parts.append(own[c != 32] if n == 1 else own)
    counts = np.bincount(np.concatenate(parts).astype(np.int64), minlength=1 << HASH_BITS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, n = grams(text)
        x = (1 + np.log(n)) * self.idf[at]
        size = np.sqrt(x @ x)
        return at, x / size if size else x

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNDETERMINED, 0.0
        p = softmax(self.logits(*self.vector(text)) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for the multinomial loss; a row is (features, values, class). Returns weights and bias."""
    z, n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))

    def weights(at) -> np.ndarray:
        over = np.abs(z[at]) > L1
        return np.where(over, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, x, y = rows[k]
            at, x = np.append(at, features), np.append(x, 1.0)
            w = weights(at)
            error = softmax(x @ w)
            error[y] -= 1
            g = x[:, None] * error
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    w = weights(np.arange(features + 1))
    return w[:-1], w[-1]


def calibrated(logits: np.ndarray, classes: np.ndarray) -> float:
    """The temperature of least log loss, between 1/20 and 20, on rows that were not fitted.

    The labels are smoothed by the error rate that these rows show (half an error more, as Jeffreys' prior has it): where all of them are right, the
    plain loss would be least at the least temperature and call every prediction certain.
    """
    if not len(logits) or logits.shape[1] < 2:
        return 1.0
    wrong = ((logits.argmax(axis=1) != classes).sum() + 0.5) / (len(logits) + 1)
    target = np.full(logits.shape, wrong / (logits.shape[1] - 1))
    target[np.arange(len(logits)), classes] = 1 - wrong

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - (target * z).sum(axis=1)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(np.exp(a)) < loss(np.exp(b)) else (a, high)
    return float(np.exp((low + high) / 2))


def learn(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> Model:
    """A model from rows where may_learn holds (a condition on columns of docs) and text and language are not null; at most MOST languages."""
    import pyarrow as pa

    size = 1 << HASH_BITS
    own = docs.filter(may_learn).select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t"), col(docs, lang_col).alias("y")).filter("t is not null and y is not null")

    def frequencies(batches: Iterator) -> Iterator:
        df, docs_seen = np.zeros(size, np.int64), 0
        for b in batches:
            for x in b.column(0):
                df[grams(x.as_py())[0]] += 1
                docs_seen += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"feature": pa.array(np.append(at, -1).astype(np.int32)), "df": pa.array(np.append(df[at], docs_seen))})

    found = own.select("t").mapInArrow(frequencies, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df")).toPandas()  # 2**HASH_BITS + 1 rows at most
    df = np.zeros(size)
    total = float(found.loc[found.feature < 0, "df"].sum())
    found = found[found.feature >= 0]
    df[found.feature.to_numpy()] = found.df.to_numpy()
    idf = np.log((1 + total) / (1 + df)) + 1

    sizes = cut(own.groupBy("y").agg(F.count("*").alias("n")))
    if (n := sizes.count()) > MOST:
        raise ValueError(f"{n} languages: the model has 2**{HASH_BITS} weights for each, which is meant for {MOST} at most")
    langs = sorted(r.y for r in sizes.collect())
    if not langs:
        return Model([], idf)
    shares = F.broadcast(sizes.select(F.col("y").alias("s_y"), F.least(F.lit(1.0), F.lit(per_lang) / F.col("n")).alias("share")))  # MOST rows at most
    lot = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("lang"), F.coalesce(F.col("id").cast("string"), "t"))), 1, 8), 16, 10).cast("double") / float(2**32)
    sample = own.withColumn("lot", lot).join(shares, F.col("y") == F.col("s_y")).filter("lot < share")
    model = Model(langs, idf)

    def vectors(batches: Iterator) -> Iterator:
        for b in batches:
            got = [model.vector(x.as_py()) for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array([a.astype("<u4").tobytes() for a, _ in got]), pa.array([x.astype("<f4").tobytes() for _, x in got])], names=["y", "lot", "at", "x"])

    rows = sorted(sample.select("t", "y", "lot").mapInArrow(vectors, "y string, lot double, at binary, x binary").collect(), key=lambda r: (r.lot, r.y, r["at"]))  # bounded by per_lang
    rows = [(np.frombuffer(r["at"], "<u4").astype(np.int64), np.frombuffer(r.x, "<f4").astype(float), langs.index(r.y)) for r in rows]
    later = [k % 5 == 4 for k in range(len(rows))]
    model.weights, model.bias = fit([r for r, z in zip(rows, later, strict=True) if not z], len(langs), size)
    held = [r for r, z in zip(rows, later, strict=True) if z]
    model.temperature = calibrated(np.array([model.logits(a, x) for a, x, _ in held]).reshape(len(held), len(langs)), np.array([y for *_, y in held], int))
    model.weights = model.weights.astype(np.float32)
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score. Only the text is used; `und` and 0 if it is null or has no letter.

    A model that was learned from no row says `und` everywhere. Null and repeated ids give rows of their own.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**HASH_BITS weights a language

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            got = [shared.value.predict(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["id", "lang_pred", "score"])

    ids = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t"))
    return ids.mapInArrow(run, f"id {ids.schema['id'].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("id", id_col)
