"""Near-duplicate texts by an inverted join over the coordinates of MinHash signatures.

A text is its set of distinct 5-word shingles. A signature has ``COORDINATES`` minima, and each
coordinate-value pair is a token with a posting list of documents. Two documents whose signatures
agree in ``MATCHES`` coordinates or more are candidates, and candidates are confirmed on full sets.

- Equal sets are folded first: one representative per set goes on.
- Prefix: tokens of one document only are dropped, and the rest of each document's tokens are ordered
  by rarity. Documents that agree in ``MATCHES`` tokens must share one of all but the last
  ``MATCHES - 1``, so only that prefix is posted. Boilerplate tokens are frequent and fall outside it.
- Collisions are counted as array comparisons in a task, in blocks of about ``BLOCK`` documents; a long
  list is many blocks. A pair that meets in several lists is looked at in one of them only.
- The first pass compares each block of a list in itself and with about ``HUBS`` documents of the whole
  list, so its work is in step with the list, and a group of near copies is mostly joined by it. Later passes
  compare all pairs of blocks, but documents of one component never meet: a component with more than ``BLOCK``
  documents in a list has blocks of its own there, which are not paired with each other.
- Bound: a pair with enough collisions goes on if its sets, hashed into bits, leave room for the
  similarity asked for. The bound never falls below the true value, so nothing is lost by it.
- Skip: of the pairs that pass in a block only a maximum spanning forest is put forward. It is
  confirmed on full sets, and posting lists whose documents are by then all in one component can add
  nothing and are skipped. This goes over the rarest tokens first, then over all posted tokens. A last
  pass puts forward *all* pairs that pass between different components. Those are few: only what a
  refuted forest link has left open.

So every pair with enough matches is either confirmed, refuted, or already joined by confirmed links,
and the pairs of a group are never listed. A pair at a similarity of 0.75 agrees in 48 of 64
coordinates on average; it falls below ``MATCHES`` with a probability under 1 in 10,000 and more similar
pairs far more rarely. Shingles are compared as 64-bit hashes.

Defined results: texts without a word and null texts have 0 shingles and are linked with nothing;
repeated rows have equal sets and so are linked; rows that share an id are one node; a null id takes
part in nothing, its component is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clicklake.llm.common import SPACE, mixed, runs, seeded, steps, text_bytes, written
from clicklake.llm.components import components

WORDS = 5
COORDINATES = 64
MATCHES = 34
BLOCK = 512
HUBS = 32
NUMERATOR, DENOMINATOR = 75, 100

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = seeded(1, 256)
_ROOT = int(seeded(2, 1)[0]) | 1
_ROOT_INVERSE = pow(_ROOT, -1, 1 << 64)
_PLACE = seeded(3, WORDS) | np.uint64(1)
_FACTOR = seeded(4, COORDINATES) | np.uint64(1)
_SHIFT = seeded(5, COORDINATES)


def _powers(root: int, size: int) -> np.ndarray:
    out = np.full(size, root, np.uint64)
    if size:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each lower-cased word of all texts in order, and the text each is from."""
    data, starts, _ = text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    edges = starts[(starts > 0) & (starts < len(data))]
    begins[edges] = inside[edges]
    finishes[edges - 1] = inside[edges - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(finishes)
    # Sum of byte values times powers of an odd root: a word's hash is a difference of running sums.
    total = np.cumsum(_BYTE[_LOWER[data]] * _powers(_ROOT, len(data)), dtype=np.uint64)
    before = np.where(first > 0, total[first - 1], np.uint64(0))
    words = mixed((total[last] - before) * _powers(_ROOT_INVERSE, len(data))[first])
    return words, np.searchsorted(starts, first, side="right") - 1


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each whole text."""
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if len(words) >= WORDS:
        whole = sum(words[k : len(words) - WORDS + 1 + k] * _PLACE[k] for k in range(WORDS))
        whole = mixed(whole)
    sets = []
    for row, n in enumerate(counts.tolist()):
        begin = bounds[row]
        if n >= WORDS:
            sets.append(np.unique(whole[begin : begin + n - WORDS + 1]))
        elif n:
            part = words[begin : begin + n] * _PLACE[:n]
            sets.append(mixed(np.array([part.sum(dtype=np.uint64) + np.uint64(n)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each coordinate's hash over the shingles, as 32-bit integers."""
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(shingles), 4096):
        part = shingles[begin : begin + 4096]
        np.minimum(out, (_FACTOR[:, None] * part[None, :] + _SHIFT[:, None]).min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _forest(weights: np.ndarray) -> list[tuple[int, int]]:
    """Links of a maximum spanning forest over positive weights."""
    n = len(weights)
    best, source = np.zeros(n, np.int64), np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    links = []
    for _ in range(n):
        node = int(np.argmax(np.where(open_, best, -1)))
        if best[node] > 0:
            links.append((int(source[node]), node))
        open_[node] = False
        better = open_ & (weights[node] > best)
        best[better], source[better] = weights[node][better], node
    return links


_FEATURES = "doc_id {id}, n_shingles bigint, set_id binary, signature array<int>"


def _features(docs: DataFrame) -> DataFrame:
    """Set size, an identity of the set (128 bits), and the signature of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            sets = shingle_sets(step.column("text"))
            ids = [
                np.array([s.sum(dtype=np.uint64), mixed(s).sum(dtype=np.uint64)]).tobytes() if len(s) else None
                for s in sets
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    step.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int32())),
                ],
                names=["doc_id", "n_shingles", "set_id", "signature"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, _FEATURES.format(id=docs.schema["doc_id"].dataType.simpleString()))


def _near_blocks(lists: DataFrame) -> DataFrame:
    """Rows ``token, doc`` of posting lists dealt to blocks, some documents (the list's hubs) to all of its blocks.

    Which documents are hubs goes by a hash, so lists of about the same documents share them.
    """
    sizes = lists.groupBy("token").agg(F.count(F.lit(1)).alias("docs")).filter("docs > 1")
    blocks = F.ceil(F.col("docs") / BLOCK).cast("int")
    place = F.shiftrightunsigned(F.xxhash64("doc", F.lit("hub")), 11) / float(1 << 53)
    dealt = F.when(place * F.col("docs") < HUBS, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array("block"))
    numbered = lists.join(sizes, "token").withColumn("block", F.pmod(F.xxhash64("doc"), blocks).cast("int"))
    return numbered.select("token", "doc", "block", F.explode(dealt).alias("low")).withColumn("high", F.col("low"))


def _paired_blocks(lists: DataFrame) -> DataFrame:
    """Rows ``token, doc, component`` of posting lists dealt to all pairs of blocks that hold different components.

    A large component of a list has blocks of its own, after those that the others share.
    """
    counts = lists.groupBy("token", "component").agg(F.count(F.lit(1)).alias("docs"))
    counts = counts.withColumn("own", F.when(F.col("docs") > BLOCK, F.ceil(F.col("docs") / BLOCK).cast("int")))
    totals = counts.groupBy("token").agg(
        F.coalesce(F.ceil(F.sum(F.when(F.col("own").isNull(), F.col("docs"))) / BLOCK).cast("int"), F.lit(0)).alias("small"),
        F.coalesce(F.sum("own").cast("int"), F.lit(0)).alias("large"),
    )
    earlier = Window.partitionBy("token").orderBy("component").rowsBetween(Window.unboundedPreceding, -1)
    large = counts.filter("own is not null").select(
        "token", "component", "own", F.coalesce(F.sum("own").over(earlier).cast("int"), F.lit(0)).alias("before")
    )
    placed = lists.join(totals, "token").join(large, ["token", "component"], "left")
    first, own, small = F.col("small") + F.col("before"), F.col("own"), F.col("small")
    block = F.when(own.isNull(), F.pmod(F.xxhash64("doc"), F.greatest(small, F.lit(1)))).otherwise(
        first + F.pmod(F.xxhash64("doc"), own)
    )
    everyone = F.sequence(F.lit(0), small + F.col("large") - 1)
    others = F.when(own.isNull(), everyone).otherwise(F.filter(everyone, lambda o: (o < first) | (o >= first + own)))
    paired = placed.select("token", "doc", block.cast("int").alias("block"), F.explode(others).alias("other"))
    return paired.select("token", "doc", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def _bits(values: pa.Array, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set, given by 16 bits of its hashes, as a row of packed bits; and how many of it share one."""
    width = 1 << int(np.clip(np.ceil(np.log2(16 * size.max())), 10, 16))
    rows = np.zeros((len(size), width), bool)
    for row, value in enumerate(values):
        rows[row, np.frombuffer(value.as_buffer(), np.uint16) & (width - 1)] = True
    return np.packbits(rows, axis=1).view(np.uint64), size - rows.sum(axis=1)


def _may_be_similar(bits: np.ndarray, spare: np.ndarray, size: np.ndarray, i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """For pairs of rows, whether the sets can be similar enough: no more can be common than this."""
    passed = np.zeros(len(i), bool)
    step = max(1, (8 << 20) // bits.shape[1] // 8)
    for begin in range(0, len(i), step):
        x, y = i[begin : begin + step], k[begin : begin + step]
        common = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64) + np.minimum(spare[x], spare[y])
        passed[begin : begin + step] = DENOMINATOR * common >= NUMERATOR * (size[x] + size[y] - common)
    return passed


def _candidates(dealt: DataFrame, owned: DataFrame, forest: bool) -> DataFrame:
    """Pairs ``(a, b)`` of different components that may be links: a forest of each piece, or all.

    ``dealt``: token, doc, block, low, high. ``owned``, a row for each document: doc, component, n, signature,
    posted (a bit for each posted coordinate), hashed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in runs(batches, ["token", "low", "high"]):
            owner = piece.column("component").to_numpy()
            if owner.min() == owner.max():
                continue
            doc, size = piece.column("doc").to_numpy(), piece.column("n").to_numpy()
            block, posted = piece.column("block").to_numpy(), piece.column("posted").to_numpy()
            signs = piece.column("signature").combine_chunks().flatten().to_numpy().reshape(len(doc), COORDINATES)
            here = (piece.column("token")[0].as_py() + (1 << 31)) >> 32
            agree = np.zeros((len(doc), len(doc)), np.uint8)
            earlier = np.zeros(agree.shape, bool)
            for at in range(COORDINATES):
                same = signs[:, at, None] == signs[None, :, at]
                agree += same
                if at < here:
                    on = (posted >> at & 1).astype(bool)
                    earlier |= same & on[:, None] & on[None, :]
            fits = (agree >= MATCHES) & ~earlier & (owner[:, None] != owner[None, :])
            if piece.column("low")[0].as_py() != piece.column("high")[0].as_py():
                fits &= block[:, None] != block[None, :]
            i, k = np.nonzero(np.triu(fits, 1))
            near = DENOMINATOR * np.minimum(size[i], size[k]) >= NUMERATOR * np.maximum(size[i], size[k])
            i, k = i[near], k[near]
            if not len(i):
                continue
            used, at = np.unique(np.concatenate([i, k]), return_inverse=True)
            hashed = piece.column("hashed").combine_chunks().take(pa.array(used))
            bits, spare = _bits(hashed, size[used])
            passed = _may_be_similar(bits, spare, size[used], at[: len(i)], at[len(i) :])
            i, k = i[passed], k[passed]
            if forest and len(i) > 1:
                weights = np.zeros(agree.shape, np.uint8)
                weights[i, k] = weights[k, i] = agree[i, k]
                i, k = np.array(_forest(weights), np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(doc[i], doc[k])), pa.array(np.maximum(doc[i], doc[k]))], names=["a", "b"]
            )

    kind = dealt.schema["doc"].dataType.simpleString()
    carried = owned.select("doc", "component", "n", "signature", "posted", "hashed")
    pieces = dealt.join(carried, "doc").repartition("token", "low", "high").sortWithinPartitions("token", "low", "high", "doc")
    return pieces.mapInArrow(run, f"a {kind}, b {kind}").filter("a <> b").distinct()


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The full sets of the documents in ``wanted``, and 16 bits of each hash."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            sets = shingle_sets(step.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    step.column("doc_id"),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([(s >> np.uint64(20)).astype(np.uint16).tobytes() for s in sets], pa.binary()),
                ],
                names=["doc", "shingles", "hashed"],
            )

    # Both sides grow with the input, so neither is to be broadcast.
    chosen = docs.select("doc_id", "text").join(wanted.hint("merge"), "doc_id")
    return written(chosen.mapInArrow(run, f"doc {kind}, shingles binary, hashed binary"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    kind = sets.schema["doc"].dataType.simpleString()
    full = sets.select("doc", "shingles")
    both = pairs.join(full.toDF("a", "left_set"), "a").join(full.toDF("b", "right_set"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left_set"), batch.column("right_set")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return written(both.select("a", "b", "left_set", "right_set").mapInArrow(compare, f"a {kind}, b {kind}").distinct(), "links")


_POSTED = "aggregate({tokens}, 0L, (a, t) -> a | shiftleft(1L, cast(shiftright(t + 2147483648L, 32) as int)))"


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (doc_id, text)."""
    features = written(_features(docs), "features")
    sized = features.filter("set_id is not null and doc_id is not null")
    folded = sized.groupBy("set_id", "n_shingles").agg(F.min("doc_id").alias("doc"))
    # One row per class: its signature is that of its least document.
    signed = sized.join(folded.select("set_id", "n_shingles", F.col("doc").alias("doc_id")), ["set_id", "n_shingles", "doc_id"])
    classes = signed.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "signature").distinct()

    postings = classes.select("doc", F.posexplode("signature").alias("at", "value")).select(
        "doc", (F.shiftleft(F.col("at").cast("bigint"), 32) + F.col("value").cast("bigint")).alias("token")
    )
    shared = postings.groupBy("token").agg(F.count(F.lit(1)).alias("docs")).filter("docs > 1")
    ordered = (
        postings.join(shared, "token")
        .groupBy("doc")
        .agg(F.array_sort(F.collect_set(F.struct("docs", "token"))).alias("tokens"))
        .filter(F.size("tokens") >= MATCHES)
        .select("doc", F.slice("tokens", F.lit(1), F.size("tokens") - (MATCHES - 1))["token"].alias("prefix"))
    )
    ordered = written(ordered, "prefixes")
    sets = _sets(docs, ordered.select(F.col("doc").alias("doc_id")))
    active = written(ordered.join(classes, "doc").join(sets.select("doc", "hashed"), "doc"), "active")

    few = F.array_distinct(F.concat(F.slice("prefix", 1, 3), F.slice("prefix", -1, 1)))
    first = active.withColumn("component", F.col("doc")).withColumn("few", few)
    first = first.withColumn("posted", F.expr(_POSTED.format(tokens="few")))
    found = components(_confirmed(_candidates(_near_blocks(first.select(F.explode("few").alias("token"), "doc")), first, True), sets))
    for forest in (True, False):
        owners = found.select(F.col("node").alias("doc"), "component")
        owned = active.drop("component").join(owners, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        owned = written(owned.withColumn("posted", F.expr(_POSTED.format(tokens="prefix"))), "owned")
        tokens = owned.select("doc", "component", F.explode("prefix").alias("token"))
        ends = tokens.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        open_lists = tokens.join(ends.filter("low <> high").select("token"), "token")
        more = _confirmed(_candidates(_paired_blocks(open_lists), owned, forest), sets)
        if not more.isEmpty():
            # What is joined goes on as stars around the least documents, which takes fewer rounds than its links.
            found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    classes_found = folded.join(found.withColumnRenamed("node", "doc"), "doc", "left").select(
        "set_id", "n_shingles", F.coalesce("component", "doc").alias("component_id")
    )
    with_words = sized.select("doc_id", "n_shingles", "set_id").join(classes_found, ["set_id", "n_shingles"])
    without = features.filter("set_id is null or doc_id is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return (
        with_words.select(columns)
        .unionByName(without.select(columns))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
