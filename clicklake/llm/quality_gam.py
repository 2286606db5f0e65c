"""Quality of texts by a generalised additive model with pairwise interactions.

Each feature of a text falls into a bin, and the model is a sum of table entries: one table per
feature and one per chosen pair of features. The tables are learnt by cyclic boosting: again and
again, for one feature after the other, a shallow tree over its bins is fitted to what the sum
leaves unexplained, and added to the table at a small rate. Scoring looks bins up and adds.

Training happens on the driver from at most ``MAX_ROWS`` labelled rows, of which only the features
travel. Scoring is one pass over the texts, without a shuffle.

Defined results: null and empty texts have all features 0 and are scored by them; rows with equal
texts have equal scores; null or conflicting labels: null ones are left out, others each count;
without labels of both kinds every score is the share of label 1 (0.5 without any label).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from clicklake.llm.common import SPACE, free_name, id_remainder, steps, text_bytes

# Labelled rows to learn from, chosen by a hash of the id: at most 20,000 x 15 numbers reach the driver.
MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 120
PAIR_ROUNDS = 60
RATE = 0.15
RIDGE = 2.0

FEATURES = (
    "log_bytes",
    "log_words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "bars",
    "exclaims",
    "stops",
    "beyond_ascii",
    "line_ends",
    "distinct_words",
    "top_word",
    "distinct_lines",
    "same_as_previous_word",
)


def _classes() -> np.ndarray:
    """For each byte, which of the counted kinds it is."""
    of = np.zeros((256, 8))
    for column, members in enumerate(
        (
            range(ord("A"), ord("Z") + 1),
            range(ord("0"), ord("9") + 1),
            b"#$%&*@^~<>[]{}\\=+_",
            b"|",
            b"!",
            b".,;:?'\"-()",
            range(128, 256),
            b"\n",
        )
    ):
        of[list(members), column] = 1
    return of


CLASSES = _classes()


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of :data:`FEATURES` per text, over the whole text."""
    data, starts, ends = text_bytes(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    for row, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
        size = end - start
        if not size:
            continue
        part = data[start:end]
        kinds = np.bincount(part, minlength=256) @ CLASSES / size
        raw = part.tobytes()
        words = raw.split()
        counted = Counter(words)
        lines = [line for line in raw.split(b"\n") if line]
        n = max(1, len(words))
        out[row, 0] = np.log1p(size)
        out[row, 1] = np.log1p(len(words))
        out[row, 2] = (size - np.count_nonzero(SPACE[part])) / n
        out[row, 3:11] = kinds
        out[row, 11] = len(counted) / n
        out[row, 12] = max(counted.values(), default=0) / n
        out[row, 13] = len(set(lines)) / max(1, len(lines))
        out[row, 14] = sum(map(bytes.__eq__, words, words[1:])) / n
    return out


@dataclass
class Gam:
    """Bin edges and tables of a fitted model."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margin(self, features: np.ndarray) -> np.ndarray:
        total = np.full(len(features), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], features[:, j], side="right")]
        coarse = [np.searchsorted(e, features[:, j], side="right") for j, e in enumerate(self.pair_edges)]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return total

    def score(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(features))


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts at quantiles; equal values share a bin."""
    cuts = np.unique(np.quantile(values, np.arange(1, bins) / bins))
    return cuts[cuts > values.min()]


def _best_cut(gradient: np.ndarray, weight: np.ndarray) -> int:
    """Where to cut a run of bins in two, or 0 if no cut gains anything."""
    left_g, left_w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    right_g, right_w = gradient.sum() - left_g, weight.sum() - left_w
    gain = left_g**2 / (left_w + RIDGE) + right_g**2 / (right_w + RIDGE)
    whole = gradient.sum() ** 2 / (weight.sum() + RIDGE)
    return int(np.argmax(gain)) + 1 if len(gain) and gain.max() > whole else 0


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a tree of at most ``depth`` levels over ordered bins."""
    cut = _best_cut(gradient, weight) if depth else 0
    if cut:
        return np.concatenate(
            [_tree(gradient[:cut], weight[:cut], depth - 1), _tree(gradient[cut:], weight[cut:], depth - 1)]
        )
    return np.full(len(gradient), gradient.sum() / (weight.sum() + RIDGE))


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cross cut of a two-way table: its gain, and the values of the four parts."""
    g, w = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(gradient)

    def parts(c: np.ndarray) -> list[np.ndarray]:
        inner, right, low, all_ = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [inner, right - inner, low - inner, all_ - right - low + inner]

    gs, ws = parts(g), parts(w)
    gain = sum(a**2 / (b + RIDGE) for a, b in zip(gs, ws))
    i, k = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = [a[i, k] / (b[i, k] + RIDGE) for a, b in zip(gs, ws)]
    out = np.empty_like(gradient)
    out[: i + 1, : k + 1], out[: i + 1, k + 1 :], out[i + 1 :, : k + 1], out[i + 1 :, k + 1 :] = value
    return float(gain[i, k]), out


def fit_gam(features: np.ndarray, labels: np.ndarray) -> Gam:
    """Learn the tables; 0/1 labels."""
    if not len(labels):
        return Gam(0.0)
    share = float(np.clip(labels.mean(), 1e-4, 1 - 1e-4))
    model = Gam(float(np.log(share / (1 - share))))
    if labels.min() == labels.max():
        return model
    columns = range(features.shape[1])
    model.edges = [_edges(features[:, j], BINS) for j in columns]
    model.pair_edges = [_edges(features[:, j], PAIR_BINS) for j in columns]
    bins = [np.searchsorted(e, features[:, j], side="right") for j, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, features[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    margin = np.full(len(labels), model.base)
    for _ in range(ROUNDS):
        for j in columns:
            p = _sigmoid(margin)
            size = len(model.tables[j])
            step = RATE * _tree(
                np.bincount(bins[j], labels - p, size), np.bincount(bins[j], p * (1 - p), size)
            )
            model.tables[j] += step
            margin += step[bins[j]]

    def two_way(a: int, b: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        size = shape[0] * shape[1]
        return (
            cell,
            np.bincount(cell, labels - p, size).reshape(shape),
            np.bincount(cell, p * (1 - p), size).reshape(shape),
        )

    p = _sigmoid(margin)
    gains = [(_quadrants(*two_way(a, b, p)[1:])[0], (a, b)) for a in columns for b in columns if a < b]
    model.pairs = [pair for gain, pair in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    model.pair_tables = [
        np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in model.pairs
    ]
    for _ in range(PAIR_ROUNDS):
        for (a, b), pair_table in zip(model.pairs, model.pair_tables):
            cell, gradient, weight = two_way(a, b, _sigmoid(margin))
            step = RATE * _quadrants(gradient, weight)[1]
            pair_table += step
            margin += step.ravel()[cell]
    return model


def train_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Gam:
    """Fit on labelled documents whose crc32 remainder modulo 4 is not 2.

    ``labels``: doc_id and quality. At most ``max_rows`` label rows are used, those lowest by a hash
    of the id, so that is also the bound of the broadcast. Where ids repeat, at most four times as many
    texts are learnt from, those lowest by the same hash, then by their features: reruns give the same model.
    """
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder("doc_id", 4) != 2))
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .withColumn("spread", F.xxhash64("doc_id", F.lit("quality")))
        .orderBy("spread", "doc_id", "quality")
        .limit(max_rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    kind = StructType([StructField("spread", LongType()), StructField("x", ArrayType(DoubleType())), StructField("quality", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            rows = text_features(step.column("text"))
            yield pa.RecordBatch.from_arrays(
                [step.column("spread"), pa.array(list(rows), pa.list_(pa.float64())), step.column("quality").cast(pa.float64())],
                names=["spread", "x", "quality"],
            )

    got = texts.mapInArrow(run, kind).orderBy("spread", "x", "quality").limit(4 * max_rows).toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = got.column("quality").to_numpy()
    order = np.lexsort([*x.T, y])  # rows arrive in any order; sums must not depend on it
    return fit_gam(x[order], y[order])


def score_quality(docs: DataFrame, model: Gam, text: str = "text", score: str = "score") -> DataFrame:
    """Add the score of each whole text. All other columns are kept."""
    score = free_name(docs, score)
    schema = StructType([*docs.schema.fields, StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, text):
            scores = model.score(text_features(step.column(text)))
            yield pa.RecordBatch.from_arrays([*step.columns, pa.array(scores)], names=[*step.schema.names, score])

    return docs.mapInArrow(run, schema)
