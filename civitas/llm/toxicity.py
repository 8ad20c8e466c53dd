"""Toxicity by a chain of linear classifiers.

The categories are label columns, predicted in order.  Every link of the chain
is a logistic regression over the words of a text (each word, its first four
and first five letters, hashed), three measures of its shape, and the
probabilities of all earlier links.  While a link is fitted, the probabilities
it reads are out of fold: they come from models that have not seen the
document, so later links meet inputs like those of unseen texts.

The chain is fitted on at most ``sample`` labelled documents (those whose id
hashes lowest), which bounds what reaches the driver; every document is scored.

Defined results: null text is empty; documents whose label is null or absent
only get scored; a category that has one class in the sample, or none, gets that
class's rate (0 without labels) as its probability; an id labelled twice counts
by its highest labels; repeated documents are scored one by one; empty tables
give no rows; further columns, also those named like the results, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.common import clean_text
from civitas.llm.tiling import bare

SAMPLE = 8_000
FOLDS = 3
DIMENSIONS = 1 << 18
SHAPES = 3
EPOCHS = 6
RATE = 0.2
DECAY = 1e-5
BATCH = 64
PRIOR_DOCUMENTS = 10.0
THRESHOLD = 0.5
CACHED_WORDS = 400_000


def word_features(word: str) -> list[int]:
    """Hashed features of one raw lower-case word; none without a letter."""
    word = bare(word)
    if not word:
        return []
    keys = {"w" + word, "4" + word[:4], "5" + word[:5]}
    return [zlib.crc32(k.encode("utf-8", "surrogatepass")) % DIMENSIONS for k in sorted(keys)]


def shape(text: str, words: int, distinct: int) -> tuple[float, float, float]:
    return (
        np.log1p(words) / 10,
        distinct / words if words else 1.0,
        min(1.0, text.count("!") / words) if words else 0.0,
    )


class Link:
    """One logistic regression: sparse words, dense shapes and earlier links."""

    def __init__(self, dense: int):
        self.sparse, self.dense, self.bias = np.zeros(DIMENSIONS), np.zeros(dense), 0.0
        self.rate: float | None = None

    def fit(self, ids: list[np.ndarray], dense: np.ndarray, target: np.ndarray) -> Link:
        """Adagrad in a fixed order of mini-batches."""
        if not len(target) or target.min() == target.max():
            self.rate = float(target.mean()) if len(target) else 0.0
            return self
        scale = self._scale(ids, target)
        # the rarer class weighs as much as the other
        rate = target.mean()
        importance = np.where(target > 0.5, 0.5 / rate, 0.5 / (1 - rate))
        squares, dense_squares, bias_square = np.full(DIMENSIONS, 1e-2), 1e-2, 1e-2
        order = np.random.default_rng(17)
        for _ in range(EPOCHS):
            for rows in np.array_split(
                order.permutation(len(target)), max(1, len(target) // BATCH)
            ):
                flat = np.concatenate([ids[r] for r in rows])
                counts = np.asarray([len(ids[r]) for r in rows])
                owner = np.repeat(np.arange(len(rows)), counts)
                margin = np.bincount(owner, self.sparse[flat] * scale[flat], len(rows))
                margin += dense[rows] @ self.dense + self.bias
                error = (_sigmoid(margin) - target[rows]) * importance[rows] / len(rows)
                slope = np.bincount(flat, error[owner], DIMENSIONS) * scale
                slope += DECAY * self.sparse
                squares += slope**2
                self.sparse -= RATE * slope / np.sqrt(squares)
                slope = error @ dense[rows] + DECAY * self.dense
                dense_squares = dense_squares + slope**2
                self.dense -= RATE * slope / np.sqrt(dense_squares)
                bias_square += error.sum() ** 2
                self.bias -= RATE * error.sum() / np.sqrt(bias_square)
        self.sparse *= scale
        return self

    @staticmethod
    def _scale(ids: list[np.ndarray], target: np.ndarray) -> np.ndarray:
        """Size of each feature's log-odds, drawn to 0 for features of few documents."""
        counts = np.zeros((2, DIMENSIONS))
        for own, label in zip(ids, target, strict=True):  # no copy of all ids on the driver
            if label in (0, 1):
                counts[int(label), np.unique(own)] += 1
        rate = target.mean()
        odds = (counts[1] + PRIOR_DOCUMENTS * rate) / (counts[0] + PRIOR_DOCUMENTS * (1 - rate))
        return np.abs(np.log(odds * (1 - rate) / rate))

    def predict(self, sums: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Probabilities from the sums of word weights and the dense inputs."""
        if self.rate is not None:
            return np.full(len(sums), self.rate)
        return _sigmoid(sums + dense @ self.dense + self.bias)

    def sums(self, ids: list[np.ndarray]) -> np.ndarray:
        return np.asarray([self.sparse[i].sum() for i in ids])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _features(text: str) -> tuple[np.ndarray, tuple[float, float, float]]:
    words = text.lower().split()
    distinct = set(words)
    ids = [f for w in sorted(distinct) for f in word_features(w)]
    return np.asarray(ids, np.int32), shape(text, len(words), len(distinct))


def fit_chain(texts: list[str], labels: np.ndarray, folds: int = FOLDS) -> list[Link]:
    """Links for the columns of ``labels`` (NaN: not labelled) in order."""
    made = [_features(t) for t in texts]
    dense = np.asarray([m[1] for m in made], float).reshape(len(made), SHAPES)
    return _fit_features([m[0] for m in made], dense, labels, folds)


def _fit_features(
    ids: list[np.ndarray], dense: np.ndarray, labels: np.ndarray, folds: int = FOLDS
) -> list[Link]:
    links = []
    for target in labels.T:
        known = np.flatnonzero(~np.isnan(target))

        def fitted(rows: np.ndarray, dense=dense, target=target) -> Link:
            link = Link(dense.shape[1])
            return link.fit([ids[r] for r in rows], dense[rows], target[rows])

        links.append(fitted(known))
        if len(links) == labels.shape[1]:
            break
        outside = np.zeros(len(ids))
        fold = np.arange(len(ids)) % folds
        for f in range(folds):
            rows = np.flatnonzero(fold == f)
            link = fitted(known[fold[known] != f])
            outside[rows] = link.predict(link.sums([ids[r] for r in rows]), dense[rows])
        dense = np.column_stack([dense, outside])
    return links


class _Weights(dict):
    """Per raw word the summed weights of its features in every link."""

    def __init__(self, links: Sequence[Link]):
        super().__init__()
        self.table = np.stack([link.sparse for link in links])

    def __missing__(self, word: str) -> np.ndarray:
        ids = word_features(word)
        weights = tuple(self.table[:, ids].sum(axis=1).tolist()) if ids else (0.0,) * len(self.table)
        if len(self) < CACHED_WORDS:
            self[word] = weights
        return weights


def train(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], sample: int = SAMPLE
) -> list[Link]:
    """Fit the chain on at most ``sample`` labelled documents.

    Texts stay in the tasks; the driver gets four bytes a feature.
    """
    wanted = [F.max(F.col(c).cast("double")).alias(c) for c in categories]
    chosen = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(*wanted)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text().alias("text"))
    # broadcast: ``chosen`` has ``sample`` short rows at most
    joined = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", *categories)
        .agg(F.max("text").alias("text"))
        .select("text", "doc_id", F.array(*categories).alias("labels"))
    )
    found = "doc_id long, labels array<double>, ids binary, dense array<double>"
    rows = joined.mapInArrow(_feature_rows, found).collect()
    rows.sort(key=lambda r: r.doc_id)
    labels = [[np.nan if v is None else v for v in r.labels] for r in rows]
    return _fit_features(
        [np.frombuffer(r.ids, np.int32) for r in rows],
        np.asarray([r.dense for r in rows], float).reshape(len(rows), SHAPES),
        np.asarray(labels, float).reshape(len(rows), len(categories)),
    )


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [_features(t.as_py()) for t in batch.column("text")]
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("labels"),
                pa.array([m[0].tobytes() for m in made], pa.binary()),
                pa.array([m[1] for m in made], pa.list_(pa.float64())),
            ],
            names=["doc_id", "labels", "ids", "dense"],
        )


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = ("quality", "toxic"),
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id``, ``p_<category>`` for each link, ``rejected`` by the last."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, categories, sample), categories)
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[f"p_{c}" for c in categories],
        (F.col(f"p_{categories[-1]}") >= threshold).alias("rejected"),
    )


def score(docs: DataFrame, links: Sequence[Link], categories: Sequence[str]) -> DataFrame:
    """The documents, every column kept, with ``p_<category>`` for each link."""
    shared = docs.sparkSession.sparkContext.broadcast(list(links))
    names = [f"p_{c}" for c in categories]
    kept = docs.select(*[c for c in docs.columns if c not in names])
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
        + [f"`{n}` double" for n in names]
    )
    at = kept.columns.index("text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        weights = _Weights(chain)
        for batch in batches:
            sums = np.zeros((batch.num_rows, len(chain)))
            dense = np.zeros((batch.num_rows, SHAPES))
            for row, text in enumerate(batch.column(at)):
                text = text.as_py() or ""
                words = text.lower().split()
                distinct = set(words)
                dense[row] = shape(text, len(words), len(distinct))
                if distinct:
                    sums[row] = list(map(sum, zip(*map(weights.__getitem__, sorted(distinct)), strict=True)))
            found = []
            for number, link in enumerate(chain):
                found.append(link.predict(sums[:, number], dense))
                dense = np.column_stack([dense, found[-1]])
            yield pa.record_batch(
                [*batch.columns, *map(pa.array, found)], names=[*batch.schema.names, *names]
            )

    return kept.mapInArrow(judge, schema)
