"""Fingerprints of texts whose likeness follows edit distance, by a randomised edit embedding.

A pointer walks over the characters of a text. At each output position it writes the character it
stands on and then, by a random bit that all texts share for this position and character, stays or
goes on. Two walks over nearly equal texts fall into step again soon after an edit, so the outputs
differ in few positions: edit distance has become Hamming distance. The bits repeat with ``PERIOD``
positions, and characters fall into 64 kinds.

An output is about twice as long as its text. A fingerprint samples ``SAMPLES`` fixed positions of two
ranges of it, the smallest power of two that holds it and the next one, so texts of up to about twice
each other's length have a range in common. Likeness is the share of sampled positions that agree,
of those where one of the two texts still has characters.

Near pairs come from banding: runs of sampled positions are keys, and what shares a key is verified on all
samples. Runs are as long as the threshold allows: a pair at the threshold shares a key with a probability of
``RECALL`` or more, if positions agree independently.

Defined results: null counts as empty; equal texts have equal fingerprints; two empty texts are alike
(1.0), an empty and another text are not (0.0); texts without a common range have likeness 0.0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clicklake.llm.common import free_name, runs, seeded, steps
from clicklake.session import shuffle_partitions

KINDS = 64
PERIOD = 4096
SAMPLES = 256
RECALL = 0.99
BLOCK = 512
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BEYOND = "."  # a position after the end of the walk


def _stays() -> list[list[int]]:
    """For each kind and position, how many outputs the pointer writes before it goes on."""
    bits = (seeded(21, KINDS * PERIOD) >> np.uint64(40) & np.uint64(1)).reshape(KINDS, PERIOD).astype(bool)
    bits[:, -1] = True
    twice = np.concatenate([bits, bits], axis=1)
    at = np.where(twice, np.arange(2 * PERIOD), 2 * PERIOD)
    following = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1]
    return (following[:, :PERIOD] - np.arange(PERIOD) + 1).tolist()


STAYS = _stays()
PLACES = np.sort((seeded(22, SAMPLES) >> np.uint64(11)).astype(float) / 2.0**53)
_SHUFFLED = np.argsort(seeded(23, SAMPLES), kind="stable")


def kinds_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((points + 37 * (points >> 6)) & (KINDS - 1)).astype(np.uint8)


def walk(kinds: np.ndarray, begin: int = 0) -> np.ndarray:
    """Where in the output the pointer leaves each character, having started at ``begin``."""
    at, left = begin, []
    leave = left.append
    for stays in map(STAYS.__getitem__, kinds.tolist()):
        at += stays[at & (PERIOD - 1)]
        leave(at)
    return np.array(left, np.int64)


_SYMBOLS = np.frombuffer((LETTERS + BEYOND).encode(), np.uint8)


def fingerprint_of(kinds: np.ndarray, left: np.ndarray) -> str:
    """The sampled symbols of a walk, behind the power of two of its smaller range."""
    if not len(kinds):
        return "0:"
    power = max(6, int(2 * len(kinds)).bit_length())
    places = np.concatenate([PLACES * (1 << power), PLACES * (2 << power)]).astype(np.int64)
    found = np.append(kinds, KINDS)[np.searchsorted(left, places, side="right")]
    return f"{power}:{_SYMBOLS[found].tobytes().decode()}"


def fingerprint(text: str | None) -> str:
    kinds = kinds_of(text or "")
    return fingerprint_of(kinds, walk(kinds))


def likeness(one: str, other: str) -> float:
    """Share of agreeing positions in the range that both fingerprints have."""
    (p, a), (q, b) = one.split(":"), other.split(":")
    if not a or not b:
        return float(a == b)
    p, q = int(p), int(q)
    if abs(p - q) > 1:
        return 0.0
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    common = max(p, q)
    x, y = x[(common - p) * SAMPLES :][:SAMPLES], y[(common - q) * SAMPLES :][:SAMPLES]
    some = (x != ord(BEYOND)) | (y != ord(BEYOND))
    return float(((x == y) & some).sum() / some.sum()) if some.any() else 0.0


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each whole text."""
    name = free_name(docs, name)
    schema = StructType([*docs.schema.fields, StructField(name, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, text):
            made = pa.array([fingerprint(value) for value in step.column(text).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*step.columns, made], names=[*step.schema.names, name])

    return docs.mapInArrow(run, schema)


def band_width(threshold: float, recall: float = RECALL) -> int:
    """Samples of a key: the largest power of two up to 32 by which a pair at ``threshold`` is found often enough."""
    for width in (32, 16, 8, 4, 2):
        if (1 - threshold**width) ** (SAMPLES // width) <= 1 - recall:
            return width
    return 1


def near_pairs(prints: DataFrame, threshold: float, node: str = "doc_id", name: str = "fingerprint") -> DataFrame:
    """``a, b, likeness``: links that connect all that is near through a shared band.

    Equal fingerprints are folded to their least id, linked to the others. Of different ones, those with
    an equal band in a common range meet in a bucket; large buckets are cut into pairs of blocks. Each
    piece verifies all its pairs in arrays and gives a spanning forest of those at ``threshold`` or more,
    so buckets of copies never list their pairs.
    """
    kind = prints.schema[node].dataType.simpleString()
    width = band_width(threshold)
    rows = prints.select(F.col(node).alias("doc"), F.col(name).alias("print")).filter("doc is not null and print is not null")
    folded = rows.groupBy("print").agg(F.min("doc").alias("doc"))
    equal = rows.join(folded.withColumnRenamed("doc", "a"), "print").filter("doc <> a").select(
        "a", F.col("doc").alias("b"), F.lit(1.0).alias("likeness")
    )

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys, ranges = [], [], []
            for row, value in enumerate(batch.column("print").to_pylist()):
                power, symbols = value.split(":")
                for half in (0, 1) if symbols else ():
                    part = np.frombuffer(symbols.encode(), np.uint8)[half * SAMPLES :][:SAMPLES][_SHUFFLED]
                    for band in range(0, SAMPLES, width):
                        piece = part[band : band + width]
                        if (piece != ord(BEYOND)).any():
                            mark = b"%d:%d:" % (int(power) + half, band) + piece.tobytes()
                            keys.append(int.from_bytes(hashlib.blake2b(mark, digest_size=8).digest(), "little", signed=True))
                            at.append(row), ranges.append(int(power) + half)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(keys, pa.int64()), pa.array(ranges, pa.int32())], names=["print", "doc", "token", "range"]
            )

    lists = folded.mapInArrow(bands, f"print string, doc {kind}, token bigint, range int")
    sizes = lists.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    sizes = sizes.select("token", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    pieces = (
        lists.join(sizes, "token")
        .withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select("token", "low", "high", "block", "doc", "print", "range")
        .repartition("token", "low", "high")
        .sortWithinPartitions("token", "low", "high", "doc")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in runs(batches, ["token", "low", "high"]):
            doc, block = piece.column("doc").to_numpy(), piece.column("block").to_numpy()
            parts, powers = [], []
            for value, range_ in zip(piece.column("print").to_pylist(), piece.column("range").to_pylist()):
                power, symbols = value.split(":")
                powers.append(int(power))
                parts.append(np.frombuffer(symbols.encode(), np.uint8)[(range_ - int(power)) * SAMPLES :][:SAMPLES])
            signs, smaller = np.array(parts), np.array(powers)
            compared = piece.column("range")[0].as_py()
            group = np.arange(len(doc))
            ends: list[tuple] = []
            for i in range(len(doc)):
                some = (signs != ord(BEYOND)) | (signs[i] != ord(BEYOND))
                like = ((signs == signs[i]) & some).sum(axis=1) / np.maximum(1, some.sum(axis=1))
                # Two texts are compared in the smallest range that both have, as by likeness().
                near = (like >= threshold) & (group != group[i]) & (np.maximum(smaller, smaller[i]) == compared)
                if piece.column("low")[0].as_py() != piece.column("high")[0].as_py():
                    near &= block != block[i]
                while near.any():
                    k = int(np.argmax(np.where(near, like, -1)))
                    ends.append((min(doc[i], doc[k]), max(doc[i], doc[k]), float(like[k])))
                    group[group == group[k]] = group[i]
                    near &= group != group[i]
            columns = list(zip(*ends)) or [()] * 3
            kinds = [piece.column("doc").type, piece.column("doc").type, pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "b", "likeness"])

    found = pieces.mapInArrow(verify, f"a {kind}, b {kind}, likeness double").distinct()
    return found.unionByName(equal)


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Each document (``doc_id``, ``text``) beside its edited text and the next document.

    The next document has the next smaller id; after the smallest comes the largest. The edited text has
    the last half (rounded down) of the characters replaced by as many of the next document's first, or
    all it has. Rows that share an id are ordered by text; a null id counts as the smallest.

    Documents are cut into slices of ids at quantiles, four for a shuffle partition, and one further row
    ends each slice: the largest document below it. So each slice is on its own, and texts are dealt once.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("at"))
    slices = 4 * shuffle_partitions(spark)
    shares = F.array(*[F.lit(k / slices) for k in range(1, slices)])
    cuts = rows.agg(F.percentile_approx("at", shares, F.lit(10_000))).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def slice_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, at.to_numpy(), side="left").astype(np.int32))

    sliced = rows.withColumn("slice", slice_of("at")).withColumn("border", F.lit(False))
    # At most one row per slice, whose number is a setting.
    tops = sorted(tuple(r) for r in sliced.groupBy("slice").agg(F.max("at")).collect())
    targets = [(at, tops[(k + 1) % len(tops)][0]) for k, (_, at) in enumerate(tops)] or [(0, 0)]
    ends = spark.createDataFrame(targets, "at bigint, slice int")
    borders = rows.join(F.broadcast(ends), "at").withColumn("border", F.lit(True)).select(sliced.columns)
    dealt = sliced.unionByName(borders).repartition("slice").sortWithinPartitions("slice", "border", F.desc("at"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: tuple | None = None
        for step in steps(batches, "text"):
            out: list[tuple] = []
            columns = (step.column(c).to_pylist() for c in ("doc_id", "text", "slice", "border"))
            for doc, text, slice_, border in zip(*columns):
                if border and (pending is None or pending[3] != slice_ or pending[4]):
                    continue  # copies of the border row
                text = text or ""
                kinds = kinds_of(text)
                left = walk(kinds)
                print_ = fingerprint_of(kinds, left)
                if pending is not None and pending[3] == slice_ and not pending[4]:
                    out.append(_told(pending, text, kinds, print_))
                pending = (doc, text, (kinds, left, print_), slice_, border)
            columns = list(zip(*out)) or [()] * 7
            types = [step.schema.field("doc_id").type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, types)],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return dealt.mapInArrow(
        run,
        f"doc_id {id_type.simpleString()}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def _told(row: tuple, next_text: str, next_kinds: np.ndarray, next_print: str) -> tuple:
    doc, text, (kinds, left, print_) = row[:3]
    half = len(text) // 2
    kept = len(text) - half
    edited = text[:kept] + next_text[:half]
    # The walk over what both texts begin with is the same.
    tail = next_kinds[:half]
    edited_kinds = np.concatenate([kinds[:kept], tail])
    edited_left = np.concatenate([left[:kept], walk(tail, int(left[kept - 1]) if kept else 0)])
    edited_print = fingerprint_of(edited_kinds, edited_left)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc, len(text), digest, print_, edited_print, likeness(print_, edited_print), likeness(print_, next_print))
