"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters in lower case, everything else one space; n-grams of 1 to 4 characters
are hashed into ``FEATURES`` columns. Document frequencies come from all
training rows. Weights are fitted by follow-the-regularised-leader (proximal)
with L1 and L2 penalties on a sample of at most ``SAMPLE_ROWS`` training rows,
spread evenly over the labels and chosen by a hash of the key; every fifth of
them is held back, and one temperature that divides all logits is fitted on
those. Features and predictions are computed where the rows are; the driver
sees the document frequencies (one number a column) and the sample's features.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.bpe_fst import LETTER, char_classes
from tickloom.llm.common import blocks_of, release, text_bytes

FEATURES = 1 << 16
NGRAMS = 4
#: The most training rows that weights and temperature are fitted on.
SAMPLE_ROWS = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
UNKNOWN = "und"
#: Characters taken at once of a long text.
PART = 1 << 20
#: Bytes of text taken at once.
BLOCK = 2 << 20


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Columns and counts of a text's n-grams; none if it has no letter."""
    cp = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    letter = char_classes()[cp] == LETTER
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    plain = np.where(letter, cp, np.uint32(32))
    keep = np.ones(len(plain), bool)
    keep[1:] = letter[1:] | letter[:-1]
    plain = np.concatenate([[32], plain[keep], [32]]).astype(np.uint32)
    total = None
    for begin in range(0, len(plain), PART):
        part = plain[begin : begin + PART + NGRAMS - 1]
        columns, gram = [], np.zeros(len(part) + 1, np.uint32)
        for n in range(NGRAMS):
            gram = gram[:-1] * np.uint32(0x01000193) + part[n:] + np.uint32(n + 1)
            mixed = (gram ^ gram >> np.uint32(15)) * np.uint32(0x9E3779B1)
            columns.append((mixed >> np.uint32(16))[:PART])
            if len(gram) == 0:
                break
        all_columns = np.concatenate(columns)
        if total is None and len(plain) <= 1024:
            return np.unique(all_columns, return_counts=True)
        counts = np.bincount(all_columns, minlength=FEATURES)
        total = counts if total is None else total + counts
    used = np.flatnonzero(total)
    return used, total[used]


@dataclass
class LanguageModel:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (columns, labels)
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts, dtype=np.float64) * self.idf[columns]
        return x / (np.sqrt((x * x).sum()) or 1.0)

    def probabilities(self, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        logits = (self.vector(columns, counts) @ self.weights[columns] + self.bias) / self.temperature
        e = np.exp(logits - logits.max())
        return e / e.sum()

    def predict(self, text: bytes) -> tuple[str, float]:
        columns, counts = features(text)
        if not len(columns) or not self.labels:
            return UNKNOWN, 0.0
        p = self.probabilities(columns, counts)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def fit_weights(
    rows: list[tuple[int, np.ndarray, np.ndarray]], labels: int, vector: Callable[[np.ndarray, np.ndarray], np.ndarray] = lambda columns, values: values
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over (label, columns, values): weights (columns, labels) and biases; the last column is the bias.

    ``vector`` makes the values of a row from its columns and counts each time
    the row is met, so that the sample is held as counts only.
    """
    z, n = np.zeros((FEATURES + 1, labels)), np.zeros((FEATURES + 1, labels))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    order = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            label, columns, values = rows[k]
            at, x = np.append(columns, FEATURES), np.append(vector(columns, values), 1.0)[:, None]
            own_z, own_n = z[at], n[at]
            w = weights(own_z, own_n)
            logits = (w * x).sum(0)
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            g = x * p
            z[at] = own_z + g - (np.sqrt(own_n + g * g) - np.sqrt(own_n)) / ALPHA * w
            n[at] = own_n + g * g
    w = weights(z, n)
    return w[:-1].astype(np.float32), w[-1]


def fit_temperature(model: LanguageModel, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> float:
    """The temperature with the least log loss on rows (label, columns, counts) the weights have not seen.

    Targets are smoothed as if each label had been drawn once more, so that
    separable rows do not ask for certainty.
    """
    if not rows:
        return 1.0
    logits = np.array([model.vector(c, n) @ model.weights[c] + model.bias for _, c, n in rows])
    target = np.full(logits.shape, 1.0 / (len(rows) + logits.shape[1]))
    target[np.arange(len(rows)), [k for k, _, _ in rows]] += len(rows) / (len(rows) + logits.shape[1])

    def loss(t: float) -> float:
        scaled = logits / t
        top = scaled.max(1, keepdims=True)
        return float((np.log(np.exp(scaled - top).sum(1)) + top[:, 0] - (scaled * target).sum(1)).mean())

    return float(min(np.exp(np.linspace(-3, 3, 121)), key=loss))


def train_language_model(docs: DataFrame, training: Column, label: str = "lang", key: str = "doc_id", text: str = "text") -> LanguageModel:
    """Learn from the rows where ``training`` holds and the label is not null; without such rows nothing is ever recognised."""
    rows = docs.filter(training & F.col(label).isNotNull()).select(F.col(label).alias("label"), F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(1 << 30)).alias("draw"), text_bytes(text).alias("text"))
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    labels = sorted(sizes)
    if not labels:
        return LanguageModel([], np.zeros(FEATURES), np.zeros((FEATURES, 0), np.float32), np.zeros(0))

    def frequencies(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        df, docs = np.zeros(FEATURES, np.int64), 0
        for part in parts:
            for (data,) in (row for block in blocks_of(part, BLOCK) for row in block):
                df[features(data)[0]] += 1
                docs += 1
        used = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.append(used, -1)), pa.array(np.append(df[used], docs))], names=["feature", "df"])

    found = rows.select("text").mapInArrow(frequencies, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df")).collect()
    counts = {r.feature: r.df for r in found}  # one a column
    total = counts.pop(-1)
    df = np.zeros(FEATURES)
    df[list(counts)] = list(counts.values())
    idf = np.log((1 + total) / (1 + df)) + 1

    share = max(1, SAMPLE_ROWS // len(labels))
    below = F.create_map(*[F.lit(x) for k in labels for x in (k, min(1 << 30, (1 << 30) * share // sizes[k]))])

    def vectors(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            got = [features(data) for data in part.column(2).to_pylist()]
            columns = [c.astype("<u2").tobytes() for c, _ in got]
            counts = [np.minimum(n, 65535).astype("<u2").tobytes() for _, n in got]
            yield pa.record_batch([part.column(0), part.column(1), pa.array(columns, pa.binary()), pa.array(counts, pa.binary())], names=["label", "draw", "columns", "counts"])

    sampled = rows.filter(F.col("draw") < below[F.col("label")]).mapInArrow(vectors, "label string, draw long, columns binary, counts binary")
    number = {name: k for k, name in enumerate(labels)}
    # the smallest draws of each label, so that equal draws of one crowd out no other; no more than SAMPLE_ROWS rows
    place = F.row_number().over(Window.partitionBy("label").orderBy("draw", "columns", "counts"))
    sampled = sampled.withColumn("place", place).filter(F.col("place") <= share)
    sample = sorted((r.draw, number[r.label], r.columns, r.counts) for r in sampled.orderBy("draw", "label").limit(SAMPLE_ROWS).collect())
    # views of four bytes a feature: what the driver holds is what it was sent
    decoded = [(k, np.frombuffer(c, "<u2"), np.frombuffer(n, "<u2")) for _, k, c, n in sample if c]
    model = LanguageModel(labels, idf, np.zeros((FEATURES, len(labels)), np.float32), np.zeros(len(labels)))
    fit = [row for k, row in enumerate(decoded) if k % 5]
    model.weights, model.bias = fit_weights(fit or decoded, len(labels), model.vector)
    model.temperature = fit_temperature(model, decoded[::5])
    return model


def language_column(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """A struct of ``lang_pred`` and ``score``, the calibrated probability; ``und`` and 0 without a letter."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # one number a column and label

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        release()
        return pd.DataFrame([held.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text_bytes(text))


def predict_languages(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row, from the whole text alone.

    Null, empty and letterless texts are ``und`` with score 0. Equal
    probabilities go to the label that sorts first. Rows with repeated or null
    keys keep their own predictions. Other columns are ignored.
    """
    return docs.select(key, language_column(docs, model, text).alias("found")).select(key, "found.lang_pred", "found.score")


def recognised(docs: DataFrame, model: LanguageModel, least: float, text: str = "text") -> DataFrame:
    """The rows whose language is recognised with a score of ``least`` or more, as they are."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(*columns, language_column(docs, model, text).alias("__found"))
    return marked.filter((F.col("__found.lang_pred") != UNKNOWN) & (F.col("__found.score") >= least)).select(*columns)
