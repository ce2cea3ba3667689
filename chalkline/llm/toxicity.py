"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another. The model of a category is a logistic regression on
the words and word beginnings that tell it apart best (chi-square), and on the log-odds of all
earlier categories. For training, those of a document come from models that have not seen it
(out-of-fold); for prediction, from the models of all folds together.

The model is fitted on a bounded sample of labelled documents (``SAMPLE``), half of it spread over
all of them and the rest over the positive ones of each category; weights undo that. All other
work covers every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, session, ship, written

#: Labelled documents that the model is fitted on, at most.
SAMPLE = 16_000
#: Features that a category's model uses, at most.
FEATURES = 2_048
FOLDS = 4
SPACE = 1 << 22
#: Lengths of word beginnings that are features beside the words.
PREFIXES = (4, 5, 6)
#: Documents of a class that a feature must be in to be used.
LEAST_DOCS = 3
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Hashes, below ``SPACE``, of a lower-case word and its beginnings."""
    names = [word] + [f"{word[:k]}*" for k in PREFIXES if len(word) >= k]
    return [xxhash.xxh32_intdigest(n.encode("utf-8", "surrogatepass"), 7) % SPACE for n in names]


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class Linear:
    """A logistic model: weights of hashed features, of earlier categories' log-odds, and a constant."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    constant: float


@dataclass
class Chain:
    """Categories in order, the models of each, and the score from which a document has the category."""

    categories: list[str]
    models: list[list[Linear]] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_linear(rows: np.ndarray, cols: np.ndarray, space: int, y: np.ndarray, weight: np.ndarray, extra: np.ndarray, *, steps: int = 150, l2: float = 1e-4) -> Linear:
    """``rows``/``cols``: document and feature, below ``space``, of each occurrence. Adam on the whole sample."""
    n = len(y)
    total = np.maximum(weight.sum(), 1e-12)
    base = float(np.clip((weight * y).sum() / total, 1e-4, 1 - 1e-4))
    start = float(np.log(base / (1 - base)))
    if y.min(initial=1) >= y.max(initial=0):
        return Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(extra.shape[1]), start)
    seen = np.bincount(cols, minlength=space)
    hit = np.bincount(cols, weights=y[rows], minlength=space)
    expected = seen * (y.sum() / n)
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (hit - expected) ** 2 / expected + (hit - expected) ** 2 / (seen - expected)
        chi /= 1 - seen / (n + 1)
    chi[(np.maximum(hit, seen - hit) < LEAST_DOCS) | (seen == n)] = 0
    chi = np.nan_to_num(chi)
    chosen = np.sort(np.argsort(-chi, kind="stable")[:FEATURES])
    chosen = chosen[chi[chosen] > 0]
    index = np.full(space, -1, np.int32)
    index[chosen] = np.arange(len(chosen))
    local = index[cols]
    r, c = rows[local >= 0], local[local >= 0]
    w = np.zeros(len(chosen) + extra.shape[1] + 1)
    w[-1] = start
    k = len(chosen)
    m, v = np.zeros_like(w), np.zeros_like(w)
    share = weight / total
    for step in range(1, steps + 1):
        z = np.bincount(r, weights=w[:k][c], minlength=n) + extra @ w[k:-1] + w[-1]
        d = (_sigmoid(z) - y) * share
        g = np.concatenate([np.bincount(c, weights=d[r], minlength=k), extra.T @ d, [d.sum()]])
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Linear(chosen, w[:k], w[k:-1], float(w[-1]))


def _score(model: Linear, rows: np.ndarray, cols: np.ndarray, space: int, n: int, extra: np.ndarray) -> np.ndarray:
    index = np.zeros(space)
    index[model.features] = model.weights
    return np.bincount(rows, weights=index[cols], minlength=n) + extra @ model.earlier + model.constant


def best_threshold(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Log-odds that give the best weighted F1, half-way to the next document below; none are enough where labels are of one kind."""
    if not (y > 0).any() or (y > 0).all():
        return np.inf
    order = np.argsort(-z, kind="stable")
    zs, found = z[order], np.cumsum((weight * y)[order])
    f1 = 2 * found / (np.cumsum(weight[order]) + found[-1])
    f1[:-1][zs[:-1] == zs[1:]] = -1
    at = int(np.argmax(f1))
    return float(zs[at] if at + 1 == len(zs) else (zs[at] + zs[at + 1]) / 2)


def fit_chain(categories: list[str], ids: np.ndarray, features: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> Chain:
    """``labels`` (NaN where none is given) and ``weights`` (documents x categories); documents lie in order of their ids.

    The list ``features`` is used up, so that the features are held once.
    """
    n = len(ids)
    chain = Chain(categories)
    if n == 0:
        none = Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), -10.0)
        for k in range(len(categories)):
            chain.models.append([Linear(none.features, none.weights, np.zeros(k), none.constant)])
            chain.thresholds.append(np.inf)
        return chain
    # features of enough documents, numbered anew; most are of one document alone
    counts = np.zeros(SPACE, np.int32)
    for f in features:
        counts[f] += 1  # a document names a feature once
    known = np.nonzero(counts >= LEAST_DOCS)[0]
    number = np.full(SPACE, -1, np.int32)
    number[known] = np.arange(len(known))
    for i, f in enumerate(features):
        features[i] = number[f[counts[f] >= LEAST_DOCS]]
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in features])
    cols = np.concatenate(features)
    features.clear()
    space = len(known)
    del counts, number
    fold = np.array([xxhash.xxh32_intdigest(str(i).encode(), 3) % FOLDS for i in ids])
    extra = np.zeros((n, 0))
    for k in range(len(categories)):
        y, w = labels[:, k].astype(float), weights[:, k]
        models, z, given = [], np.zeros(n), ~np.isnan(y)
        for f in range(FOLDS):
            train, test = (fold != f) & given, fold == f
            back = np.cumsum(train, dtype=np.int32) - 1
            mine = train[rows]
            models.append(fit_linear(back[rows[mine]], cols[mine], space, y[train], w[train], extra[train]))
            z[test] = _score(models[-1], rows, cols, space, n, extra)[test]
        chain.models.append([Linear(known[m.features], m.weights, m.earlier, m.constant) for m in models])
        chain.thresholds.append(best_threshold(z[given], y[given], w[given]))
        extra = np.column_stack([extra, np.clip(z, -8, 8)])
    return chain


class Predictor:
    """Scores texts with a chain; words are looked up in a memo of the features that the models use."""

    MEMO = 400_000

    def __init__(self, chain: Chain) -> None:
        self.chain = chain
        used = sorted({int(f) for models in chain.models for m in models for f in m.features})
        self.place = {f: i for i, f in enumerate(used)}
        self.tables = []
        for models in chain.models:
            table = np.zeros((len(used), len(models)))
            for j, m in enumerate(models):
                table[[self.place[int(f)] for f in m.features], j] = m.weights
            self.tables.append(table)
        self.memo: dict[str, tuple] = {}

    def _known(self, word: str) -> tuple:
        if len(self.memo) >= self.MEMO:
            self.memo.clear()
        found = tuple(self.place[f] for f in word_features(word) if f in self.place)
        self.memo[word] = found
        return found

    def log_odds(self, text: str | None) -> list[float]:
        memo, places = self.memo, set()
        for word in text_words(text):
            known = memo.get(word)
            if known is None:
                known = self._known(word)
            if known:
                places.update(known)
        at = np.fromiter(places, np.int64, len(places))
        at.sort()
        out: list[float] = []
        for table, models in zip(self.tables, self.chain.models):
            base = table[at].sum(axis=0)
            z = [base[j] + float(np.dot(m.earlier, np.clip(out, -8, 8))) + m.constant for j, m in enumerate(models)]
            out.append(float(np.mean(z)))
        return out


def _picked(labels: DataFrame, categories: list[str], sample: int) -> tuple[list, dict[str, tuple[float, float]]]:
    """Sampled label rows, and for each category the labelled documents a sampled one stands for: (negative, positive)."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    rows = {r.doc_id: r for r in labels.orderBy(*order).limit(sample // 2).collect()}
    for c in categories:
        for r in labels.where(F.col(c) == 1).orderBy(*order).limit(sample // (2 * len(categories))).collect():
            rows[r.doc_id] = r
        # negative ones may be few where other documents are labelled for other categories
        if sum(r[c] == 0 for r in rows.values()) < sample // (2 * len(categories)):
            for r in labels.where(F.col(c) == 0).orderBy(*order).limit(sample // (2 * len(categories))).collect():
                rows[r.doc_id] = r
    whole = labels.agg(*[F.sum((F.col(c) == v).cast("long")) for c in categories for v in (0, 1)]).first()
    weights = {}
    for k, c in enumerate(categories):
        had = [sum(r[c] == v for r in rows.values()) for v in (0, 1)]
        weights[c] = tuple((whole[2 * k + v] or 0) / max(had[v], 1) for v in (0, 1))
    return sorted(rows.values(), key=lambda r: r.doc_id), weights


def train(docs: DataFrame, labels: DataFrame, categories: list[str], *, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit the chain on labelled documents, each category on those that are labelled for it.

    A label counts as given if it is 0 or 1; documents with several label rows have a category if
    any row says so; a label of an unknown document, or with a null id, is not used. Of rows that
    share an id the text that sorts first is used. Without labelled documents nothing is toxic.
    """
    spark = session(docs)
    ship(spark)
    named = labels.select(F.col(id_col).alias("doc_id"), *[F.when(F.col(c).isin(0, 1), F.col(c)).alias(c) for c in categories]).where(F.col("doc_id").isNotNull())
    one = written(named.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in categories]).dropna("all", subset=categories), "labels")
    rows, weight = _picked(one, categories, sample)
    remove(spark, one)
    if not rows:
        return fit_chain(categories, np.zeros(0), [], np.zeros((0, len(categories))), np.zeros((0, len(categories))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, list[int]] = {}
        for batch in batches:
            out = []
            for text in batch.column(1):
                found: set[int] = set()
                for word in text_words(text.as_py()):
                    if word not in memo:
                        if len(memo) > 200_000:
                            memo.clear()
                        memo[word] = word_features(word)
                    found.update(memo[word])
                out.append(np.array(sorted(found), np.int32))
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32), np.concatenate(out) if out else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "text", "features"])

    wanted = F.broadcast(spark.createDataFrame([(r.doc_id,) for r in rows], "wanted long"))  # at most 1.5 times ``sample``
    known = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi")
    known = known.mapInArrow(work, "doc_id long, text string, features array<int>").groupBy("doc_id").agg(F.min_by("features", "text").alias("features"))
    # a document without text has no features and is left out
    table = written(known.where(F.col("features").isNotNull()), "features")
    got = table.toArrow()
    ids = got["doc_id"].to_numpy()
    lists = got["features"].combine_chunks() if got.num_rows else None
    order = np.argsort(ids, kind="stable")
    features = []
    if lists is not None:
        flat, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
        features = [flat[bounds[i] : bounds[i + 1]].copy() for i in order.tolist()]
        del flat, bounds
    del got, lists  # the copies are what the chain uses up
    pa.default_memory_pool().release_unused()
    remove(spark, table)
    by_id = {r.doc_id: r for r in rows}
    y = np.array([[by_id[i][c] for c in categories] for i in ids[order].tolist()], float).reshape(-1, len(categories))
    w = np.array([[0.0 if np.isnan(y[i, k]) else weight[c][int(y[i, k])] for k, c in enumerate(categories)] for i in range(len(y))], float).reshape(-1, len(categories))
    return fit_chain(categories, ids[order], features, y, w)


def score(docs: DataFrame, chain: Chain, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, and for each category C a probability C_score and a boolean C_flag.

    Null and empty texts have the models' constants for a score and no category; repeated rows each
    give a row; an empty table gives none; other columns are not read.
    """
    spark = session(docs)
    ship(spark)
    sent = spark.sparkContext.broadcast(chain)  # FOLDS times FEATURES weights a category, at most
    names = [x for c in chain.categories for x in (f"{c}_score", f"{c}_flag")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(sent.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            z = np.array([predictor.log_odds(t) for t in texts], float).reshape(len(texts), len(chain.categories))
            has = np.array([bool(t) for t in texts], bool)
            cols = [batch.column(0)]
            for k, limit in enumerate(chain.thresholds):
                cols += [pa.array(_sigmoid(z[:, k])), pa.array((z[:, k] > limit) & has)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *names])

    schema = "doc_id long, " + ", ".join(f"`{c}_score` double, `{c}_flag` boolean" for c in chain.categories)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(work, schema)


def reject(docs: DataFrame, labels: DataFrame, categories: list[str], rejecting: str, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that get the category ``rejecting``; all columns stay as they are.

    Null and empty texts are kept, repeated rows judged alike, a very long text judged whole; an empty table stays empty,
    and column names may be any.
    """
    spark = session(docs)
    chain = train(docs, labels, categories, id_col=id_col, text_col=text_col, **options)
    sent = spark.sparkContext.broadcast(chain)
    at = categories.index(rejecting)

    @F.pandas_udf("boolean")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predictor = Predictor(sent.value)  # once a task
        for texts in batches:
            yield pd.Series([bool(t) and predictor.log_odds(t)[at] > sent.value.thresholds[at] for t in texts], dtype=bool)

    return docs.where(~toxic(docs[text_col]))
