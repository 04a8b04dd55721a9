"""Toxicity by a classifier chain.

Categories are predicted one after another by sparse logistic regressions
(follow-the-regularised-leader, elastic net) on the words of the whole text; each later model also sees the probabilities of the earlier categories.
While training, those are out-of-fold predictions, so a later model meets
earlier ones as unsure as they will be on new texts. The last category is the
decision, with the threshold that is best on its own out-of-fold predictions.

The models are fitted on at most ``MAX_TRAIN`` labelled rows (half of them toxic
if there are as many), chosen by a hash of the id; every text is predicted.
The earlier categories are label columns that the caller names, then ``KINDS``
kinds of toxic row, found among the training rows themselves: the words (of at least ``MARK_ROWS`` toxic rows) whose
share in toxic rows is at least ``MARK_ODDS`` times that in the others mark
them, and toxic rows are clustered by the marking words they hold. No word list
is built in.

Defined cases: null and empty texts have no words and get the intercept's
probability; unlabelled rows are only predicted; without labels of both kinds
everything has probability 0; a null in a category column counts as 0; a
category without positive training rows has a probability near 0 everywhere and
so leaves the later models as they are; repeated rows are predicted row by row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import bounded_sample
from ledgerlens.llm.linear import Ftrl, Row, softmax

MAX_TRAIN = 4000
FOLDS = 3
MIN_ROWS = 3             # a word is a feature if so many training rows have it
ALPHA, L1, L2 = 1.0, 3.0, 0.02
BEGINNINGS = (5, 7)      # letters of word beginnings
KINDS = 2                # kinds of toxic row
MARK_ODDS = 8.0          # of a marking word, and the toxic rows that hold it
MARK_ROWS = 8
ROUNDS = 20              # of the clustering, at most
DECISION = "toxic"

# ASCII capitals to small letters; ASCII characters that are no letter or digit to spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))


def features(text: str) -> dict[str, float]:
    """Distinct words (value 1) and word beginnings (log of the number of
    distinct words), which reach words that training has not seen."""
    words = set(text.lower().encode().translate(_FOLD).decode().split())
    begin: Counter[str] = Counter()
    for w in words:
        for k in BEGINNINGS:
            if len(w) > k:
                begin[w[:k] + "*"] += 1
    out = dict.fromkeys(words, 1.0)
    out.update((b, float(np.log2(1 + n))) for b, n in begin.items())
    return out


class Chain:
    """A vocabulary, and for each category a weight per word, a weight per
    earlier category, and an intercept."""

    def __init__(self, categories: list[str], words: list[str], weights: np.ndarray, links: np.ndarray,
                 bias: np.ndarray, threshold: float):
        used = np.flatnonzero(np.abs(weights).sum(axis=0))
        self.categories, self.links, self.bias, self.threshold = categories, links, bias, threshold
        self.number = {words[i]: n for n, i in enumerate(used)}
        self.weights = weights[:, used]

    def predict_all(self, texts: Sequence[str]) -> np.ndarray:
        """Probabilities, texts x categories."""
        row, at, x = [], [], []
        for i, text in enumerate(texts):
            own = features(text)
            found = [w for w in own if w in self.number]
            row += [i] * len(found)
            at += [self.number[w] for w in found]
            x += [own[w] for w in found]
        row, at, x = np.array(row, np.int64), np.array(at, np.int64), np.array(x)
        out = np.zeros((len(texts), len(self.categories)))
        for k in range(len(self.categories)):
            z = np.bincount(row, self.weights[k, at] * x, len(texts)) + self.bias[k] + out[:, :k] @ self.links[k, :k]
            out[:, k] = 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))
        return out

    def predict(self, text: str) -> list[float]:
        return self.predict_all([text])[0].tolist()


def _fit(rows: list[Row], y: np.ndarray, features: int) -> tuple[np.ndarray, float]:
    """Weights and intercept of the log-odds."""
    w, b = Ftrl(2, features, alpha=ALPHA, l1=L1, l2=L2).fit(rows, y.astype(int)).weights()
    return w[1] - w[0], float(b[1] - b[0])


def _score(rows: list[Row], w: np.ndarray, b: float) -> np.ndarray:
    z = np.array([w[at] @ x for at, x in rows]) + b if rows else np.zeros(0)
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold of the best F1, in the middle of the gap it lies in."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + max(1, y.sum()))
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal scores fall on one side
    i = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][i + 1] if i + 1 < len(p) else 0.0
    return float((p[order][i] + below) / 2)


def train_chain(texts: list[str], labels: dict[str, np.ndarray], folds: int = FOLDS) -> Chain:
    """Fit the chain on texts and a 0/1 array per category, in chain order."""
    rows_with: Counter[str] = Counter()
    for t in texts:  # features are made twice rather than kept for all rows
        rows_with.update(features(t).keys())
    words = sorted(w for w, n in rows_with.items() if n >= MIN_ROWS)
    number = {w: i for i, w in enumerate(words)}
    names = list(labels)
    del rows_with
    base = []
    for t in texts:
        row = sorted((number[w], x) for w, x in features(t).items() if w in number)
        base.append((np.array([a for a, _ in row], np.int32), np.array([x for _, x in row], np.float32)))
    fold = np.arange(len(texts)) % folds
    total = len(words) + len(names)
    weights, links, bias = np.zeros((len(names), len(words))), np.zeros((len(names), len(names))), np.zeros(len(names))
    earlier = np.zeros((len(texts), 0))
    threshold = 0.5
    for k, name in enumerate(names):
        extra = len(words) + np.arange(k)
        rows = [(np.append(at, extra), np.append(x, earlier[i])) for i, (at, x) in enumerate(base)]
        y = labels[name]
        own = np.zeros(len(texts))
        for f in range(folds):
            inside = [i for i in range(len(texts)) if fold[i] != f]
            w, b = _fit([rows[i] for i in inside], y[inside], total)
            outside = np.flatnonzero(fold == f)
            own[outside] = _score([rows[i] for i in outside], w, b)
        w, b = _fit(rows, y, total)
        weights[k], links[k, :k], bias[k] = w[:len(words)], w[extra], b
        earlier = np.column_stack([earlier, own])
        threshold = best_threshold(own, y)
    return Chain(names, words, weights, links, bias, threshold)


def toxic_kinds(texts: list[str], y: np.ndarray, kinds: int = KINDS, odds: float = MARK_ODDS) -> list[np.ndarray]:
    """A 0/1 array per kind: spherical k-means of the toxic rows over their
    marking words, the largest kind first. Toxic rows without a marking word are
    of no kind. Starts from the row with the most marks and goes on with those
    least like the centres before, so the same rows give the same kinds."""
    rows = [set(t.lower().encode().translate(_FOLD).decode().split()) for t in texts]
    inside = Counter(w for r, f in zip(rows, y) if f for w in r)
    outside = Counter(w for r, f in zip(rows, y) if not f for w in r)
    bad, good = max(1, int(y.sum())), max(1, int(len(y) - y.sum()))
    marks = sorted(w for w, n in inside.items()
                   if n >= MARK_ROWS and n / bad >= odds * (outside[w] + 0.5) / good)
    number = {w: i for i, w in enumerate(marks)}
    none = [np.zeros(len(texts), np.int64) for _ in range(kinds)]
    of = [i for i in np.flatnonzero(y) if not rows[i].isdisjoint(number)]
    if len(of) < kinds:
        return none
    x = np.zeros((len(of), len(marks)))
    for r, i in enumerate(of):
        x[r, [number[w] for w in rows[i] if w in number]] = 1.0
    first = int(x.sum(axis=1).argmax())
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = x[[first]]
    while len(centres) < kinds:
        centres = np.vstack([centres, x[int((x @ centres.T).max(axis=1).argmin())]])
    kind = np.full(len(of), -1)
    for _ in range(ROUNDS):
        new = (x @ centres.T).argmax(axis=1)
        if (new == kind).all():
            break
        kind = new
        sums = np.array([x[kind == k].sum(axis=0) for k in range(kinds)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    for place, k in enumerate(np.argsort(-np.bincount(kind, minlength=kinds), kind="stable")):
        none[place][np.array(of)[kind == k]] = 1
    return none


def _names(categories: Sequence[str]) -> list[str]:
    return [*categories, *[f"kind_{k + 1}" for k in range(KINDS)], DECISION]


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, categories: Sequence[str] = ()) -> Chain:
    """Chain from a bounded sample of labelled rows (``labels``: doc_id, toxic,
    and the 0/1 columns ``categories``)."""
    names = _names(categories)
    flag = (labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id")
            .agg(F.max("toxic").alias("flag"),
                 F.array(*[F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)) for c in categories])
                 .cast("array<int>").alias("given")))
    chosen = bounded_sample(flag.withColumn("digest", F.lit(0)), "flag", max_train // 2)
    # at most max_train rows
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("__id"), "flag", "given"))
    words = F.array_distinct(F.split(F.lower(F.regexp_replace(
        "text", "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", " ")), " "))
    # of rows with one id, that with the least hash of its text
    got = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, F.col("doc_id") == F.col("__id"))
           .groupBy("doc_id", "flag", "given").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
           .select("doc_id", "flag", "given", words.alias("words")).collect())
    got.sort(key=lambda r: (str(r.doc_id), r.words))
    y = np.array([int(r.flag == 1) for r in got], np.int64)
    if not len(y) or y.min() == y.max():
        return Chain(names, [], np.zeros((len(names), 0)), np.zeros((len(names),) * 2), np.full(len(names), -50.0), 0.5)
    texts = [" ".join(r.words) for r in got]
    given = np.array([r.given for r in got], np.int64).reshape(len(got), len(categories))
    del got
    return train_chain(texts, dict(zip(names, [*given.T, *toxic_kinds(texts, y), y])))


def classify(docs: DataFrame, labels: DataFrame, *, categories: Sequence[str] = (), **options) -> DataFrame:
    """Per row of ``docs``: doc_id, a probability per category, toxic (the decision)."""
    chain = train(docs, labels, categories=categories, **options)
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    names = _names(categories)

    @F.pandas_udf(", ".join(f"c{i} double" for i in range(len(names))) + ", decision boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        chain = sent.value
        for texts in batches:
            out = pd.DataFrame(chain.predict_all(texts.tolist()), columns=[f"c{i}" for i in range(len(names))])
            out["decision"] = out.iloc[:, -1] > chain.threshold
            yield out

    return (docs.select("doc_id", predict(F.coalesce("text", F.lit(""))).alias("p"))
            .select("doc_id", *[F.col(f"p.c{i}").alias(f"p_{n}") for i, n in enumerate(names)],
                    F.col("p.decision").alias("toxic")))
