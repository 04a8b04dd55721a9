"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with an elastic-net
penalty, then calibrated by a temperature.

Document frequencies count every labelled training document; the weights are
fitted on at most ``MAX_TRAIN`` of them, the same number of each language,
chosen by a hash of the id. Only text and label are learned from, and only text
is an input of a prediction, always the whole of it.

Defined cases: a null text, or one without letters, is ``und`` with score 0, as
is every text if there was nothing to learn from; ties go to the first label in
order; rows without label are not learned from; a null id counts as an empty
one when rows are held out; repeated rows are predicted row by row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import CHUNK_BYTES, add_tables, bounded_sample, chunks, give_back
from ledgerlens.llm.linear import Ftrl, fit_temperature, softmax

FEATURES = 1 << 14       # hashed n-grams of 1 to 3 characters; 0 is not used
MAX_TRAIN = 3000         # rows the weights are fitted on, over all languages
CALIBRATE = 5            # every fifth of them is kept back for the temperature
SEGMENT = 1 << 10
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point, or a space if it is no letter."""
    every = [*range(0xD800), *range(0xE000, 0x110000)]
    table = np.full(0x110000, 32, np.uint32)
    table[[c for c in every if chr(c).isalpha()]] = [c for c in every if chr(c).isalpha()]
    return table


def counts_of(texts: list[str]) -> Iterator[np.ndarray]:
    """Counts of hashed character n-grams of each lower-cased text, words
    bounded by single spaces; index 0 collects n-grams without a letter."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("  ".join(["", *low, ""]).encode("utf-32-le"), np.uint32)
    u = _letters()[points]
    a = u * _MIX[0]
    one = (a ^ (a >> np.uint32(15))) * _MIX[1]
    two = ((a[:-1] * np.uint32(31) + a[1:]) ^ _MIX[2]) * _MIX[1]
    two ^= two >> np.uint32(13)
    three = ((a[:-2] * np.uint32(961) + a[1:-1] * np.uint32(31) + a[2:]) ^ _MIX[3]) * _MIX[2]
    three ^= three >> np.uint32(13)
    blank = u == 32
    grams = []
    for h, none in ((one, blank), (two, blank[:-1] & blank[1:]), (three, blank[1:-1] & (blank[:-2] | blank[2:]))):
        f = (h >> np.uint32(7)) % np.uint32(FEATURES - 1) + np.uint32(1)
        f[none] = 0
        grams.append(f.astype(np.int64))
    start = 2
    for t in low:
        n = len(t)
        # from the space before the text to the one after it
        cut = np.concatenate([grams[0][start:start + n], grams[1][start - 1:start + n], grams[2][start - 1:start + n]])
        yield np.bincount(cut, minlength=FEATURES)
        start += n + 2


def has_letters(counts: np.ndarray) -> bool:
    return bool(counts[1:].any())


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


# --------------------------------------------------------------- training
def document_frequencies(rows: DataFrame) -> np.ndarray:
    """Documents that have each feature (index 0: all documents), over all of
    ``rows`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(FEATURES, np.int32)
        for _, text in chunks(batches):
            for c in counts_of(text.to_pylist()):
                df += c > 0
                df[0] += 0 if c[0] else 1
        parts = df.reshape(-1, SEGMENT)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()),
                                          pa.array([p.tobytes() for p in parts], pa.binary())],
                                         names=["segment", "counts"])

    return add_tables(rows.mapInArrow(run, "segment int, counts binary"), SEGMENT, FEATURES)


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their TF-IDF values, of length one."""
    at = np.flatnonzero(counts[1:]) + 1
    x = (1.0 + np.log(counts[at])) * idf[at]
    return at, x / max(float(np.sqrt(x @ x)), 1e-12)


class Model:
    """Predicts (language, calibrated probability) of texts."""

    def __init__(self, labels: list[str], weights: np.ndarray, bias: np.ndarray, idf: np.ndarray, temperature: float):
        self.labels, self.idf, self.temperature = labels, idf, temperature
        self.weights, self.bias = np.ascontiguousarray(weights.T.astype(np.float32)), bias

    def predict(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        for counts in counts_of(texts):
            if not self.labels or not has_letters(counts):
                yield "und", 0.0
                continue
            at, x = vector(counts, self.idf)
            p = softmax((x @ self.weights[at] + self.bias) / self.temperature)
            best = int(p.argmax())
            yield self.labels[best], float(p[best])


def train(docs: DataFrame, max_train: int = MAX_TRAIN, epochs: int = 4) -> Model:
    """Fit on the labelled rows of ``docs`` that are not held out."""
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
            .filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))))
    labels = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if not labels:
        return Model([], np.zeros((0, FEATURES)), np.zeros(0), np.ones(FEATURES), 1.0)
    df = document_frequencies(rows.select("doc_id", "text"))
    idf = np.log((1.0 + df[0]) / (1.0 + df)) + 1.0

    quota = max(1, max_train // len(labels))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    chosen = bounded_sample(rows.select("doc_id", "lang", "digest"), "lang", quota)  # at most max_train rows
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("of_id"), F.col("lang").alias("of_lang"), F.col("digest").alias("of_digest")))
    sample = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("lang") == F.col("of_lang"))
                       & (F.col("digest") == F.col("of_digest")), "left_semi")
    sample = sample.dropDuplicates(["doc_id", "lang", "digest"]).select("doc_id", "text", "lang")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, n = [], []
            for t in b.column(1).to_pylist():  # one text at a time: a sampled row may be long
                c = next(counts_of([t]))
                i = np.flatnonzero(c[1:]) + 1
                at.append(i.astype("<i4").tobytes())
                n.append(c[i].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(at, pa.binary()),
                                              pa.array(n, pa.binary())], names=["doc_id", "lang", "at", "n"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(features, f"doc_id {doc_type}, lang string, at binary, n binary").collect()
    got.sort(key=lambda r: (str(r.doc_id), r.lang, bytes(r.at), bytes(r.n)))
    vectors, y = [], []
    for r in got:
        c = np.zeros(FEATURES, np.int64)
        c[np.frombuffer(r.at, "<i4")] = np.frombuffer(r.n, "<i4")
        if has_letters(c):
            vectors.append(vector(c, idf))
            y.append(labels.index(r.lang))
    y = np.array(y, np.int64)
    back = np.arange(len(y)) % CALIBRATE == 0
    model = Ftrl(len(labels), FEATURES, alpha=1.0, l1=0.02, l2=0.02)
    model.fit([v for v, b in zip(vectors, back) if not b], y[~back], epochs)
    weights, bias = model.weights()
    scores = np.array([weights[:, at] @ x + bias for (at, x), b in zip(vectors, back) if b])
    return Model(labels, weights, bias, idf, fit_temperature(scores, y[back]))


# -------------------------------------------------------------- prediction
def predictor(docs: DataFrame, **options):
    """Train on ``docs`` and return a column function: text -> (lang, score)."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, **options))

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for texts in batches:
            out, run, size = [], [], 0
            for t in [*texts, None]:
                if run and (t is None or size > CHUNK_BYTES):
                    out.extend(model.predict(run))
                    run, size = [], 0
                if t is not None:
                    run.append(t)
                    size += len(t)
            yield pd.DataFrame(out, columns=["lang", "score"])
            del texts, out, run
        give_back()

    return lambda text: predict(F.coalesce(text, F.lit("")))


def identify(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score."""
    predict = predictor(docs, **options)
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text")).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))


def drop_unidentified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """``docs`` (all its columns) without texts that have no letters or whose
    best language is less likely than ``least``."""
    predict = predictor(docs)
    return (docs.withColumn("__lang", predict(F.col("text")))
            .filter((F.col("__lang.lang") != "und") & (F.col("__lang.score") >= least)).drop("__lang"))
