"""The trie of conversations by their first turns, with totals over every subtree.

1. **Nodes.** The turns of a conversation are dealt in order, by ranges, so a long conversation is cut into
   several slices. A slice folds the turns it has into polynomial hashes modulo two primes of 61 bits. At most
   one conversation goes on from the slice before; what it brings along is one short row for each slice, and hashes
   of a prefix follow from those of its parts. A node is a prefix, named by both hashes (122 bits).
2. **Counts.** Members, smallest member, children and so on are aggregates by node, combined before they are shuffled.
3. **Depth bands.** The nodes of ``BAND`` successive depths are a band. A node adds its own value to its ancestors in its band
   only, so it explodes to less than ``BAND`` rows. The top nodes of bands are a trie themselves, whose parents are the
   tops of the bands above and whose values are the totals of the bands: it is rolled up in the same way, in bands
   of bands. Once the top nodes of a level are complete, each adds its total to its ancestors in the band
   above, which completes the level below. Depth d takes twice log d to the base ``BAND`` rounds.

No step brings the rows of a node, a conversation or a depth to one task, but for one list: the ids of the
conversations that end at a node, of which a digest is taken. These ids are sorted by ranges and written into pieces of
up to ``PIECE`` characters by the tasks that hold them, and only the pieces of a list are digested in order.

Defined results: a null turn comes first, turns that are equal are ordered by the md5 of role and text, a null role or
text is empty; rows whose conversation id is null name no conversation and are left out; repeated rows are
turns of their own; an empty table has no nodes; only the four named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.llm.common import written
from clicklake.llm.sliced import batch_of, groups, slices

BAND = 16
PIECE = 1 << 16
MAX_HEAD = 3

# Two primes below 2**61, and the bases of the hashes.
PRIMES = (2**61 - 1, 2**61 - 31)
BASES = (0x1B873593CC9E2D51 % PRIMES[0], 0x0F5A79D13E8C6B27 % PRIMES[1])
ROOT = (0, 0)


def shared_head(conv: Column) -> Column:
    """How many first turns a conversation takes from its base: crc32 of its decimal id, modulo 4."""
    return (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")


def base_of(conv: Column) -> Column:
    """The conversation whose first turns are taken."""
    return conv - conv % 20


def turns_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, x, words``: a turn's digest and the number of words of its text."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.md5(F.concat_ws("", F.length(role_).cast("string"), F.lit(":"), role_, text_).cast("binary")))
    # Words of the rule: what is left between single bytes of white space.
    words = F.regexp_count(text_, F.lit(r"[^\x20\x09-\x0D]+"))
    return rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), digest.alias("x"), words.cast("bigint").alias("words")
    )


def _place() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("x")]


def rebuilt_heads(turns: DataFrame) -> DataFrame:
    """For each conversation how many of its own first turns go, and those that stand for them: ``conv_id, skip, head``.

    The first h turns of conversation c, h by :func:`shared_head`, give way to those of conversation ``c - c % 20``.

    Spark limits the window to the first rows of a base and task before its shuffle.
    """
    first = F.row_number().over(Window.partitionBy("conv_id").orderBy(*_place()))
    firsts = (
        turns.filter("conv_id % 20 = 0").withColumn("n", first).filter(F.col("n") <= MAX_HEAD)
        .groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("n", "x", "words"))).alias("first"))
    )
    convs = turns.select("conv_id").distinct().select("conv_id", base_of(F.col("conv_id")).alias("base"), shared_head(F.col("conv_id")).alias("skip"))
    none = F.slice(F.array(F.struct(F.lit(0).alias("n"), F.lit(b"").alias("x"), F.lit(0).cast("bigint").alias("words"))), 1, 0)
    taken = F.when(F.col("skip") > 0, F.slice("first", F.lit(1), F.greatest("skip", F.lit(1))))
    return convs.join(firsts, "base", "left").select("conv_id", "skip", F.coalesce(taken, none).alias("head"))


# -- nodes ---------------------------------------------------------------------------------------


def _hashed(state: tuple[int, int], x: bytes) -> tuple[int, int]:
    a, b = int.from_bytes(x[:8], "little"), int.from_bytes(x[8:], "little")
    return (state[0] * BASES[0] + a + 1) % PRIMES[0], (state[1] * BASES[1] + b + 1) % PRIMES[1]


def _joined(state: tuple[int, int], count: int, part: tuple[int, int]) -> tuple[int, int]:
    """The hash of a sequence from that of its beginning and that of its last ``count`` turns."""
    return (
        (state[0] * pow(BASES[0], count, PRIMES[0]) + part[0]) % PRIMES[0],
        (state[1] * pow(BASES[1], count, PRIMES[1]) + part[1]) % PRIMES[1],
    )


_PATH = {
    "conv_id": pa.int64(), "depth": pa.int64(), "n1": pa.int64(), "n2": pa.int64(), "p1": pa.int64(), "p2": pa.int64(),
    "words": pa.int64(), "last": pa.bool_(), "slice": pa.int32(), "seen": pa.int64(), "xs": pa.list_(pa.binary()),
}
_PATH_SCHEMA = (
    "conv_id bigint, depth bigint, n1 bigint, n2 bigint, p1 bigint, p2 bigint, words bigint, last boolean, slice int, "
    "seen bigint, xs array<binary>"
)


def paths(turns: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """Every prefix of every conversation, rebuilt with ``heads`` if given: ``conv_id, depth, n1, n2, p1, p2, words, last``.

    ``n`` names the node, ``p`` its parent; ``words`` are those of the last turn; ``last`` marks the whole conversation.
    """
    rows = turns.select("conv_id", F.lit(1).alias("kind"), "turn", "x", "words", F.lit(0).alias("skip"), F.lit(None).cast(_HEAD).alias("head"))
    if heads is None:
        heads = turns.select("conv_id").distinct().select("conv_id", F.lit(0).alias("skip"), F.from_json(F.lit("[]"), _HEAD).alias("head"))
    first = heads.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit(b"").alias("x"),
        F.lit(0).cast("bigint").alias("words"), "skip", F.col("head").cast(_HEAD),
    )
    dealt = slices(first.unionByName(rows), [F.col("conv_id"), F.col("kind"), *_place()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of conversations that begin in the slice are final. Others hold what the slice knows of them:
        ``depth`` counts turns and ``n`` hashes them from the slice's first on, ``seen`` is -1."""
        number = TaskContext.get().partitionId()
        made: list[tuple] = []
        conv = held = None
        begun, skip, depth, state = False, 0, 0, ROOT
        for key, begins, c in groups(batches, "conv_id", {}):
            at = 0
            if begins:
                if held is not None:
                    made.append((*held, True, number, 0, None))
                conv, held, depth, state = key, None, 0, ROOT
                begun = c["kind"][0] == 0
                if begun:
                    at, skip = 1, c["skip"][0]
                    held = (conv, 0, *ROOT, 0, 0, 0)
                    for head in c["head"][0]:
                        made.append((*held, False, number, 0, None))
                        before, state, depth = state, _hashed(state, head["x"]), depth + 1
                        held = (conv, depth, *state, *before, head["words"])
            for x, words in zip(c["x"][at:], c["words"][at:]):
                if begun and skip:
                    skip -= 1
                    continue
                if held is not None:
                    made.append((*held, False, number, 0, None))
                before, state, depth = state, _hashed(state, x), depth + 1
                held = (conv, depth, *state, *before, words)
                if not begun:
                    # The first turns of a slice may have to be skipped; their digests tell it apart.
                    made.append((*held, False, number, -1, [x] if depth <= MAX_HEAD else None))
                    held = None
            while len(made) >= 10_000:
                yield batch_of(made[:10_000], _PATH)
                made = made[10_000:]
        if held is not None:
            # What follows in later slices has to know where this conversation stands.
            made.append((*held, True, number, skip, None))
        if made:
            yield batch_of(made, _PATH)

    found = written(dealt.mapInArrow(run, _PATH_SCHEMA), "paths")
    begun = found.filter("seen >= 0")
    goes_on = _carried(found)
    return begun.select(_NODE) if not goes_on else _corrected(found, goes_on)


_HEAD = "array<struct<n:int,x:binary,words:bigint>>"
_NODE = ["conv_id", "depth", "n1", "n2", "p1", "p2", "words", "last"]


def _carried(found: DataFrame) -> dict[int, tuple]:
    """For each slice that goes on with a conversation: ``(conversation, skip, depth, state, turns)`` before it.

    One short row for each slice is read by the driver: their number is the setting of shuffle partitions.
    """
    open_ = found.filter("seen < 0")
    ends = (
        open_.groupBy("slice").agg(
            F.first("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
            F.max_by(F.struct("n1", "n2"), "depth").alias("state"),
            F.array_sort(F.collect_list(F.when(F.col("xs").isNotNull(), F.struct("depth", "xs")))).alias("xs"),
        ).orderBy("slice").collect()
    )
    if not ends:
        return {}
    convs = [row.conv_id for row in ends]
    starts = {r.conv_id: r for r in found.filter("last").filter(F.col("conv_id").isin(sorted(set(convs)))).collect()}
    carried: dict[int, tuple] = {}
    states: dict[int, tuple] = {}
    for row in ends:
        if row.conv_id not in states:
            start = starts[row.conv_id]
            states[row.conv_id] = (start.seen, start.depth, (start.n1, start.n2))
        skip, depth, state = states[row.conv_id]
        xs = [x.xs[0] for x in row.xs]
        carried[row.slice] = (row.conv_id, skip, depth, state, xs)
        gone = min(skip, row.depth)
        # The part's own hash without the turns that are skipped.
        dropped = reduce(_hashed, xs[:gone], ROOT)
        n = row.depth - gone
        part = _without((row.state.n1, row.state.n2), dropped, n)
        states[row.conv_id] = (skip - gone, depth + n, _joined(state, n, part))
    return carried


def _without(whole: tuple[int, int], begin: tuple[int, int], count: int) -> tuple[int, int]:
    """The hash of the last ``count`` turns of a sequence, from its own and that of what comes before them."""
    return tuple((w - b * pow(base, count, prime)) % prime for w, b, base, prime in zip(whole, begin, BASES, PRIMES))


def _corrected(found: DataFrame, carried: dict[int, tuple]) -> DataFrame:
    """Final rows from those that know their own slice only."""
    ends = {}
    for number in sorted(carried):
        ends[carried[number][0]] = number  # the last slice of a conversation

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                conv, skip, depth, state, xs = carried[row["slice"]]
                if row["depth"] <= skip:
                    continue
                dropped = reduce(_hashed, xs[:skip], ROOT)

                def at(n: int, whole: tuple[int, int]) -> tuple[int, int]:
                    return _joined(state, n, _without(whole, dropped, n))

                n = row["depth"] - min(skip, row["depth"])
                node, parent = at(n, (row["n1"], row["n2"])), at(n - 1, (row["p1"], row["p2"]))
                made.append((conv, depth + n, *node, *parent, row["words"]))
            if made:
                yield batch_of(made, {k: _PATH[k] for k in _NODE[:-1]})

    rest = found.filter("seen < 0").mapInArrow(run, "conv_id bigint, depth bigint, n1 bigint, n2 bigint, p1 bigint, p2 bigint, words bigint")
    long = sorted(ends)
    # The last row of a conversation that goes on is its deepest one.
    whole = found.filter("seen >= 0").select(*_NODE[:-1]).filter(F.col("conv_id").isin(long)).unionByName(rest)
    deepest = whole.groupBy("conv_id").agg(F.max("depth").alias("depth"), F.lit(True).alias("last"))
    told = whole.join(deepest, ["conv_id", "depth"], "left").select(*_NODE[:-1], F.coalesce("last", F.lit(False)).alias("last"))
    return found.filter("seen >= 0").filter(~F.col("conv_id").isin(long)).select(_NODE).unionByName(told)


# -- totals --------------------------------------------------------------------------------------

NODE = ["n1", "n2"]


def nodes_of(paths: DataFrame) -> DataFrame:
    """``n1, n2, depth, conv_id, n_convs, words, p1, p2``, one row for each node."""
    return paths.groupBy("n1", "n2", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )


def _links(paths: DataFrame, band: int) -> DataFrame:
    """``n1, n2, crosses, up``: each node's ancestors in its band; and, where it tops a band, those in the band above."""
    depth = F.col("depth")
    bands = F.when((depth % band == 0) & (depth > 0), F.array(F.expr(f"depth div {band}"), F.expr(f"depth div {band} - 1")))
    rows = paths.select("conv_id", "depth", "n1", "n2", F.explode(F.coalesce(bands, F.array(F.expr(f"depth div {band}")))).alias("band"))
    # At most one row more than the band is high; conversations that share a band share the array.
    whole = rows.groupBy("conv_id", "band").agg(F.sort_array(F.collect_list(F.struct("depth", "n1", "n2"))).alias("path")).select("path").distinct()
    ids = F.transform("path", lambda s: F.struct(s["n1"].alias("n1"), s["n2"].alias("n2")))
    placed = whole.select(ids.alias("ids")).select("ids", F.posexplode("ids").alias("i", "node")).filter("i > 0")
    links = placed.select("node.n1", "node.n2", (F.col("i") == band).alias("crosses"), F.slice("ids", F.lit(1), F.col("i")).alias("up"))
    return links.groupBy("n1", "n2", "crosses").agg(F.first("up").alias("up"))


def _added(values: DataFrame, links: DataFrame) -> DataFrame:
    """For each node the sum of the values of the nodes that name it as an ancestor: ``n1, n2, leaves, saved``."""
    shares = values.join(links, NODE).select(F.explode("up").alias("a"), "leaves", "saved")
    return shares.groupBy(F.col("a.n1").alias("n1"), F.col("a.n2").alias("n2")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _sum(values: DataFrame, more: DataFrame) -> DataFrame:
    added = more.select("n1", "n2", F.col("leaves").alias("l"), F.col("saved").alias("s"))
    return values.join(added, NODE, "left").select(
        "n1", "n2", "depth", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")
    )


def subtree_totals(paths: DataFrame, values: DataFrame, deepest: int, band: int = BAND) -> DataFrame:
    """``values`` (``n1, n2, depth, leaves, saved``) summed over every node's subtree, itself included.

    ``paths`` has the nodes of each conversation by depth, as :func:`paths` gives them.
    """
    links = _links(paths, band)
    if deepest < band:
        return _sum(values, _added(values, links))
    links = written(links, "links")
    inside = written(_sum(values, _added(values, links.filter("not crosses").drop("crosses"))), "band")

    def tops(df: DataFrame) -> DataFrame:
        return df.filter(F.col("depth") % band == 0).withColumn("depth", F.expr(f"depth div {band}"))

    above = subtree_totals(tops(paths), tops(inside), deepest // band, band)
    return _sum(inside, _added(above, links.filter("crosses").drop("crosses")))


def _ends(paths: DataFrame) -> DataFrame:
    """``n1, n2, ends_sha256`` of the nodes at which conversations end."""
    kinds = {"n1": pa.int64(), "n2": pa.int64(), "first": pa.int64(), "piece": pa.string()}

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        held: list | None = None  # node, first id, ids, characters

        def done() -> None:
            made.append((*held[0], held[1], ",".join(held[2])))

        for batch in batches:
            for n1, n2, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held is None or held[0] != (n1, n2) or held[3] >= PIECE:
                    if held is not None:
                        done()
                    held = [(n1, n2), conv, [], 0]
                held[2].append(str(conv))
                held[3] += len(held[2][-1]) + 1
            if len(made) >= 5000:
                yield batch_of(made, kinds)
                made.clear()
        if held is not None:
            done()
            yield batch_of(made, kinds)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = {"n1": pa.int64(), "n2": pa.int64(), "ends_sha256": pa.string()}
        made: list[tuple] = []
        node = digest = None
        for batch in batches:
            for n1, n2, _, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (n1, n2):
                    if node is not None:
                        made.append((*node, digest.hexdigest()))
                    node, digest = (n1, n2), hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            if len(made) >= 5000:
                yield batch_of(made, told)
                made = []
        if node is not None:
            made.append((*node, digest.hexdigest()))
        if made:
            yield batch_of(made, told)

    order = [F.col(c) for c in ("n1", "n2", "conv_id")]
    pieces = slices(paths.filter("last").select("n1", "n2", "conv_id"), order).mapInArrow(listed, "n1 bigint, n2 bigint, first bigint, piece string")
    dealt = pieces.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "first")
    return dealt.mapInArrow(digested, "n1 bigint, n2 bigint, ends_sha256 string")


def trie(turns: DataFrame, heads: DataFrame | None = None, band: int = BAND) -> DataFrame:
    """One row for each node of the trie of ``turns``, as :func:`turns_of` gives them.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent (null at the root), ``n_convs`` the number
    of members, ``n_children`` that of children, ``n_leaves`` that of childless nodes in the subtree, ``saved_tokens`` the
    words that members after the first repeat, over the subtree, and ``ends_sha256`` the digest of the ids that end here.
    """
    found = written(paths(turns, heads), "nodes")
    nodes = written(nodes_of(found), "trie")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    children = nodes.filter("depth > 0").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = written(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "counted")
    values = counted.select(
        "n1", "n2", "depth", (F.col("n_children") == 0).cast("bigint").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    )
    totals = subtree_totals(found, values, deepest, band).drop("depth")
    parents = counted.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    told = counted.join(totals, NODE).join(_ends(found), NODE, "left").join(parents, ["p1", "p2"], "left")
    return told.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
