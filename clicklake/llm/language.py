"""Language of texts by averaged hashed subword embeddings under a linear softmax.

A text's letters are read as lower-cased bytes, everything else as one blank kind. Its runs of two to
four bytes are hashed to ``BUCKETS`` rows of an embedding table, the text is the mean of its rows, and a
linear layer with softmax tells the language. Table and layer are learnt together by stochastic
gradient descent in numpy on the driver, from at most ``MAX_DOCS`` documents with ``MAX_COUNTS``
buckets, of which only these counts travel. Equal rows are learnt from once.

A part of these documents calibrates: a temperature makes the probabilities honest, and the confidence
is found below which predictions have to be rejected, so that of the accepted ones at most
``ERROR_RATE`` are wrong.

Scoring needs only the product of table and layer, one number per bucket and language, and is one pass
over whole texts without a shuffle.

Defined results: a text that is null or has no letter is ``und`` at score 0 and rejected; so is every
text if nothing could be learnt; equal texts have equal predictions; among equal scores the language
that sorts first is given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from clicklake.llm.common import free_name, id_remainder, steps, text_bytes

UNKNOWN = "und"
BITS = 15
BUCKETS = 1 << BITS
GRAMS = (2, 3, 4)
DIMENSIONS = 16
# Documents to learn from, chosen by a hash of the id. Each has BUCKETS counts at most.
MAX_DOCS = 3000
MAX_COUNTS = 12_000_000  # 8 bytes each; so many buckets at most, and those of one document
EPOCHS = 6
UPDATES = 1500  # at least so many steps, so that few documents are gone through more often
BATCH = 16
RATE = 4.0
ERROR_RATE = 0.01

_KIND = np.full(256, 32, np.uint64)
_KIND[128:] = np.arange(128, 256)
_KIND[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_KIND[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def gram_buckets(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each length of run, the bucket that starts at each byte; where texts start and end.

    Runs that reach into the next text have the bucket ``BUCKETS``.
    """
    data, starts, ends = text_bytes(texts)
    codes = _KIND[data]
    found = []
    for length in GRAMS:
        hashed = np.full(len(codes), length, np.uint64)
        for k in range(length):
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15)
            hashed[: max(0, len(codes) - k)] ^= codes[k:]
        buckets = ((hashed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int32)
        for k in range(1, length):
            buckets[np.maximum(ends - k, starts)[ends > starts]] = BUCKETS
        found.append(buckets)
    return found, starts, ends


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # (BUCKETS + 1, languages), the last row is 0
    bias: np.ndarray
    temperature: float = 1.0
    accept_from: float = 0.0

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        found, starts, ends = gram_buckets(texts)
        total = np.zeros((len(starts), len(self.languages)))
        some = ends > starts
        count = np.zeros(len(starts))
        for buckets in found:
            if some.any():
                total[some] += np.add.reduceat(self.table[buckets], starts[some], axis=0)
                count[some] += np.add.reduceat(buckets < BUCKETS, starts[some])
        return _softmax((total / np.maximum(1, count)[:, None] + self.bias) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_language(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], seed: int = 7) -> LanguageModel:
    """Learn from bags of (buckets, counts); a fifth of them is kept for calibration."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(bags))
    held, used = (order[: len(order) // 5], order[len(order) // 5 :]) if len(order) >= 10 else (order, order)
    table = draw.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    weights = [(c / c.sum()).astype(np.float32) for _, c in bags]
    batches = -(-len(used) // BATCH)
    epochs = max(EPOCHS, -(-UPDATES // batches))
    rounds, done = epochs * batches, 0
    for _ in range(epochs):
        used = draw.permutation(used)
        for begin in range(0, len(used), BATCH):
            rate = RATE * (1 - done / rounds)
            done += 1
            rows = used[begin : begin + BATCH]
            at = np.concatenate([bags[r][0] for r in rows])
            w = np.concatenate([weights[r] for r in rows])[:, None]
            lengths = [len(bags[r][0]) for r in rows]
            hidden = np.add.reduceat(table[at] * w, np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0)
            wrong = _softmax(hidden @ layer + bias)
            wrong[np.arange(len(rows)), y[rows]] -= 1
            back = np.repeat(wrong @ layer.T, lengths, axis=0)
            layer -= rate / len(rows) * hidden.T @ wrong
            bias -= rate / len(rows) * 0.1 * wrong.sum(axis=0)
            np.add.at(table, at, -rate * w * back)
    product = np.vstack([table @ layer, np.zeros((1, len(languages)), np.float32)])
    model = LanguageModel(languages, product, bias)
    logits = np.array([(product[bags[r][0]] * weights[r][:, None]).sum(axis=0) + bias for r in held])
    _calibrate(model, logits, y[held])
    return model


def _calibrate(model: LanguageModel, logits: np.ndarray, y: np.ndarray) -> None:
    scales = np.geomspace(0.05, 5, 41)
    losses = [-np.log(np.maximum(1e-12, _softmax(logits / t)[np.arange(len(y)), y])).mean() for t in scales]
    model.temperature = float(scales[int(np.argmin(losses))])
    p = _softmax(logits / model.temperature)
    order = np.argsort(-p.max(axis=1), kind="stable")
    wrong = np.cumsum(p.argmax(axis=1)[order] != y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(wrong <= ERROR_RATE)
    model.accept_from = float(p.max(axis=1)[order[good[-1]]]) if len(good) else 1.0


def train_language(docs: DataFrame, max_docs: int = MAX_DOCS, max_counts: int = MAX_COUNTS) -> LanguageModel | None:
    """Learn from ``text`` and non-null ``lang`` of documents whose crc32 remainder modulo 3 is not 1.

    The documents lowest by a hash of the id are taken, until there are ``max_docs``, or their texts may
    have ``max_counts`` buckets; reruns take the same ones.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (id_remainder("doc_id", 3) != 1))
    usable = usable.select("doc_id", "text", "lang", F.xxhash64("text").alias("t"))
    buckets = F.least(F.octet_length("text") * len(GRAMS), F.lit(BUCKETS)).cast("bigint")
    keys = ["h", "doc_id", "lang", "t"]
    first = usable.select(F.xxhash64("doc_id", F.lit("language")).alias("h"), "doc_id", "lang", "t", buckets.alias("n"))
    first = first.orderBy(*keys).limit(max_docs).distinct()
    # One task orders these rows, of which there are max_docs.
    before = F.sum("n").over(Window.orderBy(*keys)) - F.col("n")
    chosen = first.withColumn("before", before).filter(F.col("before") < max_counts).select("doc_id", "lang", "t")
    texts = usable.join(F.broadcast(chosen), ["doc_id", "lang", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            found, starts, ends = gram_buckets(step.column("text"))
            bags = []
            for start, end in zip(starts.tolist(), ends.tolist()):
                every = np.concatenate([b[start:end] for b in found])
                bags.append(np.unique(every[every < BUCKETS], return_counts=True))
            columns = [
                step.column("doc_id").cast(pa.string()),
                step.column("lang"),
                step.column("t"),
                *(pa.array([b[k].astype(np.int32) for b in bags], pa.list_(pa.int32())) for k in (0, 1)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lang", "t", "buckets", "counts"])

    bags_ = texts.mapInArrow(run, "id string, lang string, t bigint, buckets array<int>, counts array<int>")
    got = bags_.dropDuplicates(["id", "lang", "t"]).toArrow()
    got = got.combine_chunks().sort_by([("id", "ascending"), ("lang", "ascending"), ("t", "ascending")])
    bags, labels = [], []
    for lang, buckets, counts in zip(got.column("lang"), got.column("buckets"), got.column("counts")):
        if len(buckets):
            bags.append((buckets.values.to_numpy(), counts.values.to_numpy()))
            labels.append(lang.as_py())
    return fit_language(bags, labels) if bags else None


def predict_language(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``accepted`` of each whole text."""
    names = [free_name(docs, n) for n in ("lang_pred", "score", "accepted")]
    kinds = (StringType(), DoubleType(), BooleanType())
    schema = StructType([*docs.schema.fields, *(StructField(n, k) for n, k in zip(names, kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, text):
            known = np.array([has_letter(t) for t in step.column(text).to_pylist()])
            if model is None:
                tongue, score, sure = [UNKNOWN] * len(known), np.zeros(len(known)), np.zeros(len(known), bool)
            else:
                p = model.probabilities(step.column(text))
                best = p.argmax(axis=1)
                tongue = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
                score = np.where(known, p.max(axis=1), 0.0)
                sure = known & (score >= model.accept_from)
            made = [pa.array(tongue, pa.string()), pa.array(score, pa.float64()), pa.array(sure, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*step.columns, *made], names=[*step.schema.names, *names])

    return docs.mapInArrow(run, schema)
