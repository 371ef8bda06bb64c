"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the hashed byte n-grams of two and three bytes, ASCII letters in lower case.
A feature weighs the part of the text's n-grams that it makes up, times its inverse
document frequency. Document frequencies are counted over all training rows. Weights are
learnt by follow-the-regularised-leader with an L1 and an L2 penalty, on at most
`FIT_ROWS` training rows (a documented bound: those different ones with the smallest hash
of text and label), of which one in `HELD_BACK` is kept back to fit the temperature that calibrates the
probabilities. The model has a fixed size: `FEATURES` weights per language.

Cases: a text that is null or has no letter is `und` with score 0, as is every text when
there is nothing to learn from. Ties between languages go to the first by name. Long
texts are scored whole, in pieces. Repeated rows get equal predictions; extra columns are
not looked at. Only text and the label of training rows are learnt from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm import texts

FEATURES = 1 << 16
ORDERS = (2, 3)
#: Rows that the model is fitted on, at most.
FIT_ROWS = 6_000
#: Bytes of a fitting row that are looked at together; a longer text is fitted whole, in rows of this size.
FIT_BYTES = 1 << 14
HELD_BACK = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
UNKNOWN = "und"


def features(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of each n-gram that begins in `body`, and the place where it begins."""
    x = texts.LOWER[body].astype(np.uint32)
    found, at = [], []
    for order in ORDERS:
        n = max(0, len(x) - order + 1)
        h = np.full(n, order, np.uint32)
        for j in range(order):
            h = (h ^ x[j : j + n]) * np.uint32(0x01000193)
        found.append((h ^ (h >> np.uint32(15))) & np.uint32(FEATURES - 1))
        at.append(np.arange(n))
    return np.concatenate(found), np.concatenate(at)


def _count_documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen, rows = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, bool), 0
    for batch in batches:
        body, at = texts.flat(batch.column(0))
        for first, last in zip(at[:-1], at[1:], strict=True):
            for piece in range(first, last, texts.SLICE_BYTES):
                seen[features(body[piece : min(last, piece + texts.SLICE_BYTES + 2)])[0]] = True
            total += seen
            seen[:] = False
            rows += 1
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], rows))], ["feature", "n"])


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Rows of `train` (text) that have each feature, and all rows. One number per feature comes to the driver."""
    rows = train.select("text").mapInArrow(_count_documents, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    counts = rows[rows.feature >= 0]
    out = np.zeros(FEATURES)
    out[counts.feature.to_numpy()] = counts.n.to_numpy()
    return out, int(rows[rows.feature < 0].n.sum())


def tfidf(text: str, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and values of a text; of a long one, of each of its pieces."""
    body = np.frombuffer(text.encode(), np.uint8)
    for first in range(0, max(1, len(body)), FIT_BYTES):
        found = features(body[first : first + FIT_BYTES])[0]
        if len(found):
            index, n = np.unique(found, return_counts=True)
            yield index, n / len(found) * idf[index]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Weights (features, classes) after a few passes, each update on one row."""
    z, n = np.zeros((FEATURES, classes)), np.zeros((FEATURES, classes))

    def weights(i):
        own = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0, own)

    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            index, value, label = rows[k]
            w = weights(index)
            p = softmax(value @ w)
            p[label] -= 1
            g = np.outer(value, p)
            sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA
            z[index] += g - sigma * w
            n[index] += g * g
    return weights(slice(None))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least loss."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.02, 50, 200)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _fit(names: list[str], idf: np.ndarray) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        label = {x: i for i, x in enumerate(names)}
        sample = sample.sort_values(["tie", "text", "lang"]).reset_index(drop=True)
        rows, back = [], []
        for i, (text, lang) in enumerate(zip(sample.text, sample.lang, strict=True)):
            (back if i % HELD_BACK == HELD_BACK - 1 else rows).extend((*x, label[lang]) for x in tfidf(text, idf))
        w = fit_ftrl(rows, len(names))
        logits = np.array([v @ w[i] for i, v, _ in back]).reshape(-1, len(names))
        t = fit_temperature(logits, np.array([x for *_, x in back], int))
        return pd.DataFrame({"weights": [(w * idf[:, None] / t).astype(np.float32).tobytes()]})

    return fit


class Model:
    """The languages, in order of name, and the weight of each feature for each of them (frequencies and temperature included)."""

    def __init__(self, names: list[str], weights: np.ndarray):
        self.names, self.weights = names, weights

    def probabilities(self, column: pa.Array) -> np.ndarray:
        body, at = texts.flat(column)
        logits = np.zeros((len(at) - 1, len(self.names)))
        for i, j in texts.slices(at):
            for first in range(at[i], at[j], texts.SLICE_BYTES):  # more than one only for a long text
                last = min(at[j], first + texts.SLICE_BYTES)
                upto = min(at[j], last + max(ORDERS) - 1)
                found, begin = features(body[first:upto])
                order = np.repeat(ORDERS, [max(0, upto - first - o + 1) for o in ORDERS])
                begin = begin + first
                row = np.searchsorted(at, begin, "right") - 1
                own = (begin + order <= at[row + 1]) & (begin < last)  # an n-gram that runs into the next text is none
                found, row = found[own], row[own]
                for k in range(len(self.names)):
                    logits[i:j, k] += np.bincount(row - i, self.weights[:, k][found], j - i)
        size = np.diff(at)
        n = np.maximum(1, sum(np.maximum(0, size - o + 1) for o in ORDERS))
        return softmax(logits / n[:, None])

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        if not self.names:
            return [UNKNOWN] * len(column), [0.0] * len(column)
        p = self.probabilities(column)
        best = p.argmax(axis=1)
        known = [text is not None and any(map(str.isalpha, text)) for text in column.to_pylist()]
        return ([self.names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
                [float(p[i, b]) if k else 0.0 for i, (b, k) in enumerate(zip(best, known, strict=True))])


def train(rows: DataFrame) -> Model:
    """`rows`: text, lang. Rows without a text or a label teach nothing."""
    rows = rows.select("text", F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect())  # one row per language
    if not names:
        return Model([], np.zeros((FEATURES, 0), np.float32))
    df, total = document_frequencies(rows)
    idf = np.log((1 + total) / (1 + df)) + 1
    hashed = rows.withColumn("tie", F.xxhash64("text", "lang"))
    last = hashed.select("tie").distinct().orderBy("tie").limit(FIT_ROWS).agg(F.max("tie")).first()[0]
    sample = hashed.filter(F.col("tie") <= last).groupBy("tie").agg(F.first("text").alias("text"), F.first("lang").alias("lang"))  # equal rows once
    fitted = sample.groupBy().applyInPandas(_fit(names, idf), "weights binary").first()["weights"]
    return Model(names, np.frombuffer(fitted, np.float32).reshape(FEATURES, len(names)).copy())


def predictor(model: Model) -> Callable[[Column], Column]:
    """A column function: text to (lang_pred, score)."""
    @F.arrow_udf("lang_pred string, score double")
    def predict(column: pa.Array) -> pa.Array:
        names, scores = model.predict(column)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score. The model is learnt from the rows of `docs` that are not held out."""
    out = held_out(F.col("doc_id"))
    model = train(docs.filter(~out).select("text", "lang"))
    return docs.select("doc_id", out.alias("held_out"), predictor(model)(F.col("text")).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")
