"""Exact range join of embeddings by cosine, and the components of its links.

On unit vectors a cosine of c is a distance of sqrt(2 - 2c), which is a metric. Pivots, a bounded sample
of the vectors, cut space into cells: a vector's home is the cell of its nearest pivot. By the
triangle inequality a vector x within ``eps`` of a vector at home in cell q has
``d(x, q) <= d(x, home) + 2 eps``. Of unit vectors the distance to the plane between two pivots is known
as well, which rules out more cells.

Vectors are dealt by label and home and packed into blocks of up to ``BLOCK``, which go into files in that
order. A block notes the homes of its vectors and the cells that links of them may lead to, so two blocks are
compared only if they share a label and each has a home that the other may reach. No vector is copied for
that: a task holds a group of blocks and reads the files of the later ones that share a label with it, so what is
shuffled and written is in proportion to the input, however many blocks are compared. A hot label or cell
is many blocks, and its pairs of groups are tasks of their own.

Products are taken in single precision first; pairs that rounding may hide are compared again in double
precision. A task gives counts of links per vector and a spanning forest of the links, never the list of all pairs.

Equal vectors of a label are folded first and counted by their number.

The join is exact whatever the pivots. In high dimensions, where distances concentrate, cells overlap
and the comparisons tend to all pairs of a label, as for every exact method.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those
without a label or id, link with nothing (a null id has a null component and is kept); vectors of
different lengths do not link; rows that share an id are one node, each row with its own count.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from clicklake.llm.common import text_bytes, written
from clicklake.llm.components import components
from clicklake.session import scratch_path

# One pivot for so many vectors, and at most MAX_PIVOTS: with 64 doubles each, 128 kB in all.
ROWS_PER_PIVOT = 4096
MAX_PIVOTS = 256
# Vectors of a block, and bytes of them; blocks of a file.
BLOCK = 8192
BLOCK_BYTES = 4 << 20
FILE = 4
# Blocks that a task holds while others go by, 64 MB at most; groups of blocks that one plan joins.
GROUP = 16
ROUND = 16
ROWS_AT_ONCE = 128  # of a block, against all of another: 4 MB of cosines
LINKS_AT_ONCE = 16384  # compared again: 8 MB of doubles on each side, of 64 dimensions
# More than the rounding of a distance between unit vectors, for bounds only.
SLACK = 1e-9


def _kind(vectors: DataFrame, embedding: str) -> str:
    """Single precision is kept as such, anything else as doubles."""
    return "<f4" if vectors.schema[embedding].dataType.elementType.simpleString() == "float" else "<f8"


def _prepared(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """``vec_id, label, key, raw``; key and raw, the components as bytes, are null for vectors that cannot link."""
    id_kind = vectors.schema[vec_id].dataType.simpleString()
    label_kind = vectors.schema[label].dataType.simpleString()
    kind = _kind(vectors, embedding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            width = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # null is NaN
            start = np.cumsum(width) - width
            some = np.flatnonzero(width)
            largest = np.zeros(batch.num_rows)
            if len(some):
                largest[some] = np.maximum.reduceat(np.abs(values), start[some])
            usable = pc.and_(pc.is_valid(batch.column(0)), pc.is_valid(batch.column(1))).to_numpy(zero_copy_only=False)
            usable &= np.isfinite(largest) & (largest > 0)
            keys: list[bytes | None] = [None] * batch.num_rows
            raws: list[bytes | None] = [None] * batch.num_rows
            for row in np.flatnonzero(usable):
                raw = values[start[row] : start[row] + width[row]]
                keys[row] = hashlib.blake2b(raw.tobytes(), digest_size=16).digest()
                raws[row] = raw.astype(kind).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())],
                names=["vec_id", "label", "key", "raw"],
            )

    schema = f"vec_id {id_kind}, label {label_kind}, key binary, raw binary"
    return vectors.select(vec_id, label, embedding).mapInArrow(run, schema)


def _floats(raws: pa.Array, kind: str, width: int) -> np.ndarray:
    """The vectors of one width, a row each, in double precision."""
    return text_bytes(raws)[0].view(kind).astype(np.float64).reshape(-1, width)


def _units(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


class _Cells:
    """Cells of pivots of one width; vectors of other widths have one cell."""

    def __init__(self, pivots: np.ndarray, eps: float):
        self.pivots, self.eps, self.width = pivots, eps, pivots.shape[1] if len(pivots) else -1
        # Homes come from whole numbers, whose products and sums are exact: equal vectors have one home wherever they are.
        self.scale = 2.0 ** min(20, (52 - math.ceil(math.log2(max(2, self.width)))) // 2)
        self.whole = np.rint(pivots * self.scale).T
        # By so much a home may have a lower cosine than the nearest pivot.
        self.off = 2 * math.sqrt(max(1, self.width)) / self.scale
        self.between = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))

    def homes(self, x: np.ndarray) -> np.ndarray:
        return np.argmax(np.rint(x / np.abs(x).max(axis=1, keepdims=True) * self.scale) @ self.whole, axis=1)

    def near(self, x: np.ndarray, home: np.ndarray) -> np.ndarray:
        """The cells that links of some of the vectors may lead to."""
        reached = np.zeros(len(self.pivots), bool)
        for begin in range(0, len(x), 2048):
            own = home[begin : begin + 2048]
            square = np.maximum(0, 2 - 2 * _units(x[begin : begin + 2048]) @ self.pivots.T)
            at = square[np.arange(len(own)), own][:, None]
            fits = np.sqrt(square) <= np.sqrt(at) + 2 * self.eps + math.sqrt(2 * self.off) + SLACK
            fits &= square - at <= 2 * self.eps * self.between[own] + 2 * self.off + SLACK
            reached |= fits.any(axis=0)
        return np.flatnonzero(reached)


def _least(docs: pa.Array, starts: np.ndarray) -> pa.Array:
    """The least of each run of ids that begins at ``starts``."""
    ends = np.append(starts[1:], len(docs))
    found = docs.take(pa.array(starts))
    several = np.flatnonzero(ends - starts > 1)
    if len(several):
        ids = found.to_pylist()
        for k in several.tolist():
            ids[k] = min(docs.slice(starts[k], ends[k] - starts[k]).to_pylist())
        found = pa.array(ids, docs.type)
    return found


def _dealt(usable: DataFrame, cells: _Cells, kind: str) -> DataFrame:
    """``doc, label, key, copies, raw, width, cell, place``; equal vectors of a label are folded within each batch."""
    kinds = {f.name: f.dataType.simpleString() for f in usable.schema.fields}
    size = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key, label = (pc.dictionary_encode(batch.column(c)).indices.to_numpy().astype(np.int64) for c in ("key", "label"))
            both = key * (label.max() + 1) + label
            order = np.argsort(both, kind="stable")
            starts = np.flatnonzero(np.append(True, np.diff(both[order]) != 0))
            docs = _least(batch.column("vec_id").take(pa.array(order)), starts)
            batch = batch.take(pa.array(order[starts]))
            raws = batch.column("raw")
            width = pc.binary_length(raws).to_numpy() // size
            cell = np.zeros(batch.num_rows, np.int32)
            mine = np.flatnonzero(width == cells.width)
            if len(mine):
                cell[mine] = cells.homes(_floats(raws.take(pa.array(mine)), kind, cells.width))
            copies = pa.array(np.diff(np.append(starts, len(order))).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [docs, batch.column("label"), batch.column("key"), copies, raws, pa.array(width.astype(np.int32)), pa.array(cell)],
                names=["doc", "label", "key", "copies", "raw", "width", "cell"],
            )

    schema = f"doc {kinds['vec_id']}, label {kinds['label']}, key binary, copies bigint, raw binary, width int, cell int"
    return usable.mapInArrow(run, schema).withColumn("place", F.xxhash64("label", "width"))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order, each vector of a label once: its least id and the number of its copies."""

    def fold(table: pa.Table, starts: np.ndarray) -> pa.Table:
        made = table.take(pa.array(starts))
        copies = np.add.reduceat(table.column("copies").to_numpy(), starts)
        made = made.set_column(made.schema.get_field_index("copies"), "copies", pa.array(copies))
        docs = _least(table.column("doc").combine_chunks(), starts)
        return made.set_column(made.schema.get_field_index("doc"), "doc", docs)

    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.concat_tables([*held, pa.Table.from_batches([batch])]).combine_chunks()
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for name in ("width", "place", "label", "key"):
            column = table.column(name).combine_chunks()
            codes = column if name in ("width", "place") else pc.dictionary_encode(column).indices
            new[1:] |= np.diff(codes.to_numpy()) != 0
        starts = np.flatnonzero(new)
        last = int(starts[-1])
        if last:
            yield fold(table.slice(0, last), starts[:-1])
        held = [fold(table.slice(last), np.zeros(1, np.int64))]
    yield from held


def _cut(tables: Iterator[pa.Table], size: int) -> Iterator[pa.Table]:
    """Blocks of rows of one width."""
    held, rows, last = [], 0, None
    for table in tables:
        widths = table.column("width").to_numpy()
        begin = 0
        while begin < len(widths):
            width = int(widths[begin])
            most = min(BLOCK, max(1, BLOCK_BYTES // (width * size)))
            if held and (width != last or rows >= most):
                yield pa.concat_tables(held).combine_chunks()
                held, rows = [], 0
            end = min(begin + most - rows, int(np.searchsorted(widths, width, side="right")))
            held.append(table.slice(begin, end - begin))
            rows, last, begin = rows + end - begin, width, end
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _packed(dealt: DataFrame, files: int, cells: _Cells, kind: str) -> DataFrame:
    """Blocks in the order of label and cell, written to folders named by that order."""
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    order = ["width", "place", "cell", "key"]
    sorted_ = dealt.repartitionByRange(files, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    size = np.dtype(kind).itemsize
    listed = ["doc", "label", "key", "copies", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in enumerate(_cut(_folded(batches), size)):
            width = block.column("width")[0].as_py()
            raws = block.column("raw").combine_chunks()
            home = block.column("cell").to_numpy()
            near = cells.near(_floats(raws, kind, width), home) if width == cells.width else np.zeros(1, int)
            place = block.column("place").to_numpy()
            scalars = [block.column("part")[0].as_py(), number, width, int(place[0]), int(place[-1])]
            ends = pa.array([0, block.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([v], k) for v, k in zip(scalars, [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()])),
                    *(pa.array([v.tolist()], pa.list_(pa.int32())) for v in (np.unique(home), near)),
                    *(pa.ListArray.from_arrays(ends, block.column(c).combine_chunks()) for c in listed),
                    pa.array([text_bytes(raws)[0].tobytes()], pa.binary()),
                ],
                names=["part", "number", "width", "first", "last", "homes", "near", *listed, "raw"],
            )

    arrays = ", ".join(f"{c} array<{kinds[c]}>" for c in listed)
    schema = f"part int, number bigint, width int, first bigint, last bigint, homes array<int>, near array<int>, {arrays}, raw binary"
    blocks = sorted_.mapInArrow(run, schema)
    path = scratch_path(dealt.sparkSession, "blocks")
    blocks.write.partitionBy("part").parquet(path)
    return dealt.sparkSession.read.schema(blocks.schema).parquet(path)


class _Links:
    """Counts of links and a spanning forest of them, over the blocks that a task meets."""

    def __init__(self):
        self.begins: dict[tuple, int] = {}
        self.docs: list[pa.Array] = []
        self.counts: dict[tuple, np.ndarray] = {}
        self.parent = np.zeros(0, np.int64)
        self.ends = array("q")  # of the forest, two for each link

    def place(self, block: tuple, docs: pa.Array) -> int:
        """Where the rows of a block begin among all."""
        if block not in self.begins:
            self.begins[block] = len(self.parent)
            self.docs.append(docs.take(pa.array(np.arange(len(docs)))))  # a copy: the batch is let go
            self.parent = np.append(self.parent, np.arange(len(self.parent), len(self.parent) + len(docs)))
            self.counts[block] = np.zeros(len(docs), np.int64)
        return self.begins[block]

    def _roots(self, nodes: np.ndarray) -> np.ndarray:
        up = self.parent[nodes]
        while True:
            over = self.parent[up]
            if np.array_equal(over, up):
                self.parent[nodes] = up
                return up
            up = over

    def _root(self, node: int) -> int:
        while (up := int(self.parent[node])) != node:
            node = up
        return node

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links between rows a and b: each tree takes one link to another until none is left, so trees halve at least."""
        while True:
            tree, other = self._roots(a), self._roots(b)
            across = tree != other
            if not across.any():
                return
            a, b, tree, other = a[across], b[across], tree[across], other[across]
            some = np.union1d(np.unique(tree, return_index=True)[1], np.unique(other, return_index=True)[1])
            for k in some.tolist():
                low, high = sorted((self._root(int(tree[k])), self._root(int(other[k]))))
                if low != high:
                    self.parent[high] = low
                    self.ends.extend((int(a[k]), int(b[k])))

    def batches(self) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "links"]
        for docs, counts in zip(self.docs, self.counts.values()):
            some = np.flatnonzero(counts)
            if len(some):
                own = docs.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([own, own, pa.array(counts[some])], names=names)
        if self.ends:
            docs = pa.concat_arrays(self.docs)
            both = np.array(self.ends, np.int64).reshape(-1, 2)
            for begin in range(0, len(both), BLOCK):
                a, b = (docs.take(pa.array(both[begin : begin + BLOCK, k])) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([a, b, pa.array(np.zeros(len(a), np.int64))], names=names)


def _matches(x: np.ndarray, y: np.ndarray, single: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with a product of ``threshold`` or more; ``single`` has the same rows in single precision."""
    # More than the rounding of a product in single precision.
    low = threshold - (x.shape[1] + 8) * 2.0**-23
    a, b = np.divmod(np.flatnonzero(single[0] @ single[1].T >= low), len(y))
    if len(a) > len(x) * len(y) // 8:
        fits = (x @ y.T)[a, b] >= threshold
    else:
        fits = np.zeros(len(a), bool)
        for begin in range(0, len(a), LINKS_AT_ONCE):
            some = slice(begin, begin + LINKS_AT_ONCE)
            fits[some] = np.einsum("ij,ij->i", x[a[some]], y[b[some]]) >= threshold
    return a[fits], b[fits]


def _joined(pairs: DataFrame, threshold: float, kind: str) -> DataFrame:
    """``a, links`` (links of a within a task, a = b) and ``a, b`` (a spanning forest), from pairs of blocks."""
    doc_kind = pairs.schema["l_doc"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = _Links()
        kept: tuple = (None,)  # the block on the left comes many times in a row

        def name(batch: pa.RecordBatch, row: int, at: str) -> tuple:
            return batch.column(f"{at}_part")[row].as_py(), batch.column(f"{at}_number")[row].as_py()

        def side(batch: pa.RecordBatch, row: int, at: str) -> tuple:
            x = _units(_floats(batch.column(f"{at}_raw").slice(row, 1), kind, batch.column("l_width")[row].as_py()))
            place = batch.column(f"{at}_place")[row].values.to_numpy()
            places, begins = np.unique(place, return_index=True)
            return name(batch, row, at), x, x.astype(np.float32), places, begins, np.append(begins[1:], len(place))

        for batch in batches:
            for row in range(batch.num_rows):
                if kept[0] != name(batch, row, "l"):
                    kept = side(batch, row, "l")
                block, x, x32, places, begins, ends = kept
                twin = block == name(batch, row, "r")
                other, y, y32, o_places, o_begins, o_ends = kept if twin else side(batch, row, "r")
                at, o_at = (links.place(b, batch.column(f"{s}_doc")[row].values) for b, s in ((block, "l"), (other, "r")))
                counts, o_counts = links.counts[block], links.counts[other]
                copies, o_copies = (batch.column(f"{s}_copies")[row].values.to_numpy() for s in ("l", "r"))
                labels = pa.concat_arrays([batch.column(f"{s}_label")[row].values for s in ("l", "r")])
                codes = pc.dictionary_encode(labels).indices.to_numpy()
                _, run_, o_run = np.intersect1d(places, o_places, assume_unique=True, return_indices=True)
                for i, j in zip(run_.tolist(), o_run.tolist()):
                    for begin in range(begins[i], ends[i], ROWS_AT_ONCE):
                        end = min(begin + ROWS_AT_ONCE, ends[i])
                        # Of a block with itself each pair is met once, in the rows from this one on.
                        o_begin, o_end = begin if twin else o_begins[j], o_ends[j]
                        a, b = _matches(x[begin:end], y[o_begin:o_end], (x32[begin:end], y32[o_begin:o_end]), threshold)
                        a, b = a + begin, b + o_begin
                        fits = codes[a] == codes[len(x) + b]  # labels differ if two places have one hash
                        if twin:
                            fits &= a < b
                        if fits.any():
                            a, b = a[fits], b[fits]
                            counts += np.bincount(a, o_copies[b], len(x)).astype(np.int64)
                            o_counts += np.bincount(b, copies[a], len(y)).astype(np.int64)
                            links.tie(at + a, o_at + b)
        yield from links.batches()

    return pairs.mapInArrow(run, f"a {doc_kind}, b {doc_kind}, links bigint")


def _pairs(blocks: DataFrame, first: int, last: int, end: int) -> DataFrame:
    """Blocks of the files ``first`` to ``last`` beside themselves and the later ones up to file ``end``, if links are possible."""
    columns = ["part", "number", "width", "first", "last", "homes", "near", "doc", "label", "copies", "place", "raw"]
    held = blocks.filter(F.col("part").between(first, last)).select(*[F.col(c).alias(f"r_{c}") for c in columns]).coalesce(1)
    others = blocks.filter(F.col("part").between(first, end)).select(*[F.col(c).alias(f"l_{c}") for c in columns])
    later = (F.col("l_part") > F.col("r_part")) | ((F.col("l_part") == F.col("r_part")) & (F.col("l_number") >= F.col("r_number")))
    # Blocks are in order, so these mean: of one width, and with a label in both.
    shared = (F.col("l_width") <= F.col("r_width")) & (F.col("l_first") <= F.col("r_last"))
    reached = F.arrays_overlap("l_near", "r_homes") & F.arrays_overlap("r_near", "l_homes")
    # A product of the files as they are: each task reads its two sides, and nothing is shuffled.
    both = others.hint("shuffle_replicate_nl").join(held, later & shared & reached)
    sides = [f"{s}_{c}" for s in ("l", "r") for c in ("part", "number", "doc", "label", "copies", "place", "raw")]
    return both.select("l_width", *sides)


def _groups(blocks: DataFrame) -> list[tuple[int, int, int]]:
    """Files of a group of blocks, first and last, and the last file with a label of the group."""
    edge = [F.struct("width", F.col(c).alias("place")) for c in ("first", "last")]
    files = blocks.groupBy("part").agg(F.count(F.lit(1)), F.min(edge[0]), F.max(edge[1])).orderBy("part").collect()
    tasks = 2 * blocks.sparkSession.sparkContext.defaultParallelism
    most = min(GROUP, max(1, sum(f[1] for f in files) // tasks))
    found, begin = [], 0
    while begin < len(files):
        end, size = begin + 1, files[begin][1]
        while end < len(files) and size + files[end][1] <= most:
            end, size = end + 1, size + files[end][1]
        until = end
        while until < len(files) and tuple(files[until][2]) <= tuple(files[end - 1][3]):
            until += 1
        found.append((files[begin][0], files[end - 1][0], files[until - 1][0]))
        begin = end
    return found


def _found(blocks: DataFrame, threshold: float, kind: str) -> DataFrame:
    """What :func:`_joined` gives for all pairs of blocks, written by one plan for each round of groups."""
    groups = _groups(blocks)
    path = scratch_path(blocks.sparkSession, "found")
    schema = _joined(_pairs(blocks, 0, 0, 0), threshold, kind).schema
    if not groups:
        return blocks.sparkSession.createDataFrame([], schema)
    for begin in range(0, len(groups), ROUND):
        pairs = reduce(DataFrame.unionAll, [_pairs(blocks, *group) for group in groups[begin : begin + ROUND]])
        _joined(pairs, threshold, kind).write.mode("append").parquet(path)
    return blocks.sparkSession.read.schema(schema).parquet(path)


def _pivots(usable: DataFrame, count: int, kind: str) -> np.ndarray:
    """Some of the different vectors, by hash; those of the greatest width among them."""
    wanted = max(1, min(MAX_PIVOTS, count // ROWS_PER_PIVOT))
    # Some 16 rows for each, of which copies are dropped.
    some = usable.select("key", "raw").filter(F.pmod(F.xxhash64("key"), F.lit(max(1, count // (16 * wanted)))) == 0)
    sample = some.dropDuplicates(["key"]).orderBy(F.xxhash64("key"), "key").limit(wanted).select("raw").collect()
    x = [np.frombuffer(row.raw, kind).astype(float) for row in sample]
    width = max(map(len, x), default=1)
    x = [v for v in x if len(v) == width]
    return _units(np.array(x)) if x else np.zeros((0, width))


def range_join(
    vectors: DataFrame,
    threshold: float = 0.93,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row: links at a cosine of ``threshold`` or more."""
    kind = _kind(vectors, embedding)
    rows = written(_prepared(vectors, vec_id, embedding, label), "vectors")
    usable = rows.filter(F.col("key").isNotNull())
    count = usable.count()
    cells = _Cells(_pivots(usable, count, kind), float(np.sqrt(2 - 2 * threshold)))
    blocks = _packed(_dealt(usable, cells, kind), max(1, math.ceil(count / (FILE * BLOCK))), cells, kind)
    found = _found(blocks, threshold, kind)
    counts = found.filter("a = b").groupBy("a").agg(F.sum("links").alias("links"))
    owners = components(found.filter("a <> b").select("a", "b"))

    told = (
        blocks.select(F.inline(F.arrays_zip("label", "key", "doc", "copies")))
        .join(counts.withColumnRenamed("a", "doc"), "doc", "left")
        .join(owners.withColumnRenamed("node", "doc"), "doc", "left")
        .select(
            "label",
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "doc").alias("component_id"),
        )
    )
    linked = usable.join(told, ["label", "key"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(F.col("key").isNull()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
