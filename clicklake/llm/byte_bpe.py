"""Byte-level BPE encoding and decoding with a table of ranks.

A text is cut into words, the matches of the splitting pattern, and each word is encoded by itself: it starts
as single bytes, and the neighbouring pair of lowest rank is joined, the leftmost of several, until no pair
has a rank. All words are encoded by one fold of Spark's higher-order functions: a word is an array of the ids
of its pieces with the ranks of its pairs, and each step of the fold joins one pair.

1. The commonest words of a sample of about ``SAMPLE_DOCS`` documents, at most ``COMMON_WORDS`` of them, are
   encoded once for all texts.
2. A task replaces the words of each text by their places in that list; the distinct words of a text that are not
   in it stand beside it, with their bytes as numbers.
3. The fold encodes these, row by row, and a task puts the ids of the whole text together.

The rank tables are a scalar subquery: lists of keys and of values, picked by a hash, so that a lookup reads a few
entries; plans name the subquery and do not print it. A fold is quadratic in the length of its word, so a single word
of more than ``LONGEST_FOLDED`` bytes is joined by the same rule with a heap. Decoding is native: ids are mapped to their
pieces, and the pieces are concatenated.

There is no shuffle of texts. List and rank tables are bounded.

Defined results: null and empty texts have no ids; special tokens are ordinary text; every text
decodes to its own UTF-8 bytes; an unknown or null id makes the decoded value null.
"""

from __future__ import annotations

import base64
import json
import zlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from clicklake.llm.common import free_name, steps, text_bytes, written

SAMPLE_DOCS = 16_000
COMMON_WORDS = 200_000
LONGEST_COMMON = 64  # bytes
LONGEST_FOLDED = 4096
BUCKETS = 8192
PAIR_BUCKETS = 65_521  # a prime, as pairs are dealt by remainder


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 piece and its rank on each line; read on the driver."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(pair[0]): int(pair[1]) for pair in pairs if pair}


# A piece with the pair it begins is one number: rank of the pair, place of its first byte, id. The least one is joined next.
# A pair that is looked up has the id of its right piece where the rank will be.
_ID, _PLACE = 26, 13
_PLACES = (1 << _PLACE) - 1 << _ID
_OWN = (1 << _ID + _PLACE) - 1  # place and id
_NO_PAIR = (1 << 24) - 1 << _ID + _PLACE
_END = (1 << 24) + 256  # id of what stands before the first and after the last piece; bytes without a rank are below
_LAST, _EDGE = 1 << 16, (1 << 16) + 256  # codes of a last byte, less the byte, and of the two ends; other bytes are coded with the next one


def _dealt(buckets: np.ndarray, n: int, keys: pa.Array, values: pa.Array) -> pa.Array:
    """One list of ``n`` maps; each key and value in the map of its bucket."""
    order = pa.array(np.argsort(buckets, kind="stable"))
    offsets = np.append(0, np.cumsum(np.bincount(buckets, minlength=n)))
    maps = pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), keys.take(order), values.take(order))
    return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), maps)


def _rank_table(ranks: dict[bytes, int]) -> pa.Table:
    """A row with the ranks of whole words, the numbers of coded bytes, and the ranks of pairs of pieces by their ids."""
    first = [ranks.get(bytes([i]), (1 << 24) + i) for i in range(256)]
    known = {**{bytes([i]): id_ for i, id_ in enumerate(first)}, **ranks}
    pairs, of_pairs = array("q"), array("q")
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = known.get(piece[:cut]), known.get(piece[cut:])
            if left is not None and right is not None:
                key = (right << _ID + _PLACE) + left
                pairs.append(key - (1 << 64) if key >> 63 else key)
                of_pairs.append(rank << _ID + _PLACE)
    coded = [ranks.get(bytes([i, j])) for i in range(256) for j in range(256)]
    numbers = [(_NO_PAIR if rank is None else rank << _ID + _PLACE) + first[i >> 8] for i, rank in enumerate(coded)]
    numbers += [_NO_PAIR + id_ for id_ in (*first, _END)]
    pairs = np.frombuffer(pairs, np.int64)
    crcs = np.fromiter(map(zlib.crc32, ranks), np.int64, len(ranks)) & (BUCKETS - 1)
    lists = {
        "words": _dealt(crcs, BUCKETS, pa.array(list(ranks), pa.binary()), pa.array(list(ranks.values()), pa.int32())),
        "numbers": pa.array([numbers], pa.list_(pa.int64())),
        "pairs": _dealt(pairs % PAIR_BUCKETS, PAIR_BUCKETS, pa.array(pairs), pa.array(np.frombuffer(of_pairs, np.int64))),
    }
    return pa.table({"ranks": pa.StructArray.from_arrays(lists.values(), names=list(lists))})


def _rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal, which plans print whole."""
    lists = _rank_table(ranks)["ranks"][0].as_py()
    words = [{"k": [word.hex() for word, _ in bucket], "v": [rank for _, rank in bucket]} for bucket in lists["words"]]
    pairs = [{"k": [pair for pair, _ in bucket], "v": [rank for _, rank in bucket]} for bucket in lists["pairs"]]
    kind = "words array<struct<k: array<string>, v: array<int>>>, numbers array<bigint>, pairs array<struct<k: array<bigint>, v: array<bigint>>>"
    read = F.from_json(F.lit(json.dumps({"words": words, "numbers": lists["numbers"], "pairs": pairs})), kind)
    of_words = F.transform(read["words"], lambda bucket: F.map_from_arrays(F.transform(bucket["k"], F.unhex), bucket["v"]))
    of_pairs = F.transform(read["pairs"], lambda bucket: F.map_from_arrays(bucket["k"], bucket["v"]))
    return read.withField("words", of_words).withField("pairs", of_pairs)


def _with_ranks(df: DataFrame, ranks: dict[bytes, int], name: str) -> DataFrame:
    """The ranks as a column, which the expression that uses it takes from a scalar subquery; to be used once."""
    return df.withColumn(name, df.sparkSession.createDataFrame(_rank_table(ranks)).scalar())


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bound(state: Column, value: Column, body) -> Column:
    """``body(state, value)`` with the value computed once; in place of ``_let`` where the result is as the state, which is not copied."""
    return F.aggregate(F.array(value), state, body)


def encoded_word(word: Column, rank_map: Column) -> Column:
    """Ids of one word, given as binary. The map stands in the expression once, bound to a variable."""
    return _let(rank_map, lambda bound: _encoded_word(word, _codes(word), bound))


def _codes(word: Column) -> Column:
    """The bytes of a word, each coded with the next one, between two ends."""

    def codes(text: Column) -> Column:
        byte = lambda i: F.ascii(F.substr(text, i, F.lit(1)))
        code = lambda i: F.when(i < F.length(text), byte(i) * 256 + byte(i + 1)).otherwise(byte(i) + _LAST)
        inner = F.when(text != "", F.transform(F.sequence(F.lit(1), F.length(text)), code)).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.array(F.array(F.lit(_EDGE)), inner, F.array(F.lit(_EDGE))))

    return _let(F.decode(word, "ISO-8859-1"), codes)


def _byte_codes(words: list[bytes]) -> pa.Array:
    """What ``_codes`` gives, for words of at least one byte in a task."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
    codes = (data << 8) + np.append(data[1:], 0)
    lasts = np.cumsum(sizes) - 1
    codes[lasts] = data[lasts] + _LAST
    offsets = np.append(0, np.cumsum(sizes + 2))
    made = np.full(offsets[-1], _EDGE, np.int32)
    made[np.arange(len(data)) + 2 * np.repeat(np.arange(len(words)), sizes) + 1] = codes
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(made))


def _encoded_word(word: Column, codes: Column, rank_map: Column) -> Column:
    """Ids of one word. Each node of an expression costs time for each byte or join, so they are few."""

    def known(word: Column) -> Column:
        return F.try_element_at(rank_map["words"][F.crc32(word).bitwiseAND(BUCKETS - 1)], word)

    def number(pair: Column) -> Column:
        key = pair.bitwiseAND(~_PLACES)
        rank = F.try_element_at(rank_map["pairs"][F.pmod(key, F.lit(PAIR_BUCKETS))], key)
        return F.coalesce(rank, F.lit(_NO_PAIR)).bitwiseOR(pair.bitwiseAND(_OWN))

    def join_at(pieces: Column, i: Column, least: Column) -> Column:
        """Join pieces i and i + 1, counted from 0, and renew the ranks beside them."""
        before = pieces[i - 2].bitwiseAND(_OWN).bitwiseOR(least.bitwiseAND(_NO_PAIR))
        after = F.shiftleft(pieces[i + 1], _ID + _PLACE).bitwiseOR(least.bitwiseAND(_PLACES)).bitwiseOR(F.shiftright(least, _ID + _PLACE))
        renewed = F.transform(F.array(before, after), number)
        return F.flatten(F.array(F.slice(pieces, F.lit(1), i - 2), renewed, F.slice(pieces, i + 2, LONGEST_FOLDED)))

    def step(pieces: Column, _: Column) -> Column:
        def at_least(pieces: Column, least: Column) -> Column:
            i = F.array_position(pieces, least).cast("int")
            return F.when(least >= _NO_PAIR, pieces).otherwise(_bound(pieces, i, lambda pieces, i: join_at(pieces, i, least)))

        return _bound(pieces, F.array_min(pieces), at_least)

    def ids_of(pieces: Column) -> Column:
        return F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 2), lambda piece: piece.bitwiseAND((1 << _ID) - 1).cast("int"))

    def folded(codes: Column) -> Column:
        start = F.transform(codes, lambda code, i: rank_map["numbers"][code].bitwiseOR(F.shiftleft(i.cast("bigint"), _ID)))
        return F.aggregate(F.sequence(F.lit(1), F.size(codes) - 3), start, step, ids_of)

    return _let(known(word), lambda id_: F.when(id_.isNotNull(), F.array(id_)).otherwise(_let(codes, folded)))


def folded_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long word, joined in the task: the open pair of lowest rank, leftmost first, from a heap."""
    if word in ranks:
        return [ranks[word]]
    size = len(word)
    end = list(range(1, size + 1))  # of the piece that starts at a byte; 0 once it is joined to another
    before = list(range(-1, size))  # start of the piece before
    heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = end[i]
        if not middle or middle >= size or end[middle] != stop:
            continue  # one of the two has been joined since
        end[i], end[middle] = stop, 0
        if stop < size:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        if i and (r := ranks.get(word[before[i] : stop])) is not None:
            heappush(heap, (r, before[i], stop))
    out, i = [], 0
    while i < size:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class _Places(dict):
    """Places of the common words; a word of a text that is missing gets the next negative number."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__((word.decode(), i) for i, word in enumerate(words))
        self.rest: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        return self.rest.setdefault(word, -1 - len(self.rest))


def common_words(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> pa.Table:
    """``word, ids`` of the words that most parts of a sample of the documents have; the list saves work and decides no result."""
    spark = docs.sparkSession
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        for step in steps(batches, text):
            found = set(chain.from_iterable(find(value or "") for value in step.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([w.encode() for w in found], pa.binary())], names=["word"])

    counted = docs.select(text).sample(share, 1).mapInArrow(words, "word binary").groupBy("word").agg(F.count(F.lit(1)).alias("steps"))
    short = counted.filter(F.octet_length("word") <= LONGEST_COMMON)
    chosen = written(short.orderBy(F.desc("steps"), "word").limit(COMMON_WORDS).select("word"), "words")
    dealt = chosen.repartition(4 * spark.sparkContext.defaultParallelism)
    return _with_ranks(dealt, ranks, "ranks").select("word", encoded_word(F.col("word"), F.col("ranks")).alias("ids")).toArrow()


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids", packed: str = "packed"
) -> DataFrame:
    """The columns other than ``text``, and the ids of each whole text.

    ``packed`` holds the ids as files of tokens do: unsigned 32-bit integers, least byte first.
    """
    ids, packed = free_name(docs, ids), free_name(docs, packed)
    held = [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in held]
    codes, rest, folded, map_ = (free_name(docs, name) for name in ("__codes", "__rest", "__folded", "__ranks"))
    common = common_words(docs, ranks, pattern, text)
    context = docs.sparkSession.sparkContext
    words, of_words = context.broadcast(common.select(["word"])), context.broadcast((common.select(["ids"]), ranks))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        places = _Places(words.value.column("word").to_pylist())
        for step in steps(batches, text):
            found, missing = [], []
            for value in step.column(text).to_pylist():
                places.rest = {}
                matches = find(value or "")
                found.append(np.fromiter(map(places.__getitem__, matches), np.int32, len(matches)).tobytes())
                missing.append([word.encode() for word in places.rest])
            flat = list(chain.from_iterable(missing))
            parts = pa.StructArray.from_arrays([pa.array(flat, pa.binary()), _byte_codes(flat)], names=["word", "codes"])
            ends = np.append(0, np.cumsum([len(words) for words in missing]))
            made = [pa.array(found, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)]
            yield pa.RecordBatch.from_arrays([*(step.column(name) for name in names), *made], names=[*names, codes, rest])

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, ranks = of_words.value
        known = _flat(table.column("ids").combine_chunks())
        for step in steps(batches, codes):
            data, starts, ends = text_bytes(step.column(codes))
            places = np.frombuffer(data, np.int32)
            sizes = (ends - starts) // 4
            of_rest = step.column(folded).flatten()
            if of_rest.null_count:
                pairs = zip(step.column(rest).flatten().field("word").to_pylist(), of_rest.to_pylist())
                made = [folded_word(word, ranks) if ids_ is None else ids_ for word, ids_ in pairs]
                of_rest = pa.array(made, pa.list_(pa.int32()))
            values, lengths = (np.concatenate(both) for both in zip(known, _flat(of_rest)))
            n_rest = step.column(folded).value_lengths().to_numpy()
            before = np.repeat(len(known[1]) + np.cumsum(n_rest) - n_rest, sizes)
            places = np.where(places < 0, before - 1 - places, places)
            begins, n_ids = (np.cumsum(lengths) - lengths)[places], lengths[places]
            reached = np.cumsum(n_ids)
            flat = values[np.repeat(begins - reached + n_ids, n_ids) + np.arange(n_ids.sum())]
            offsets = np.append(0, reached)[np.append(0, np.cumsum(sizes))]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            bounds = pa.py_buffer((4 * offsets).astype(np.int32))
            binary = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, bounds, pa.py_buffer(flat.astype("<u4"))])
            yield pa.RecordBatch.from_arrays([*(step.column(name) for name in names), lists, binary], names=[*names, ids, packed])

    of_word = StructType([StructField("word", BinaryType()), StructField("codes", ArrayType(IntegerType()))])
    between = StructType([*held, StructField(codes, BinaryType()), StructField(rest, ArrayType(of_word))])
    schema = StructType([*held, StructField(ids, ArrayType(IntegerType())), StructField(packed, BinaryType())])

    def fold(ranks: Column) -> Column:
        short = lambda word: F.octet_length(word["word"]) <= LONGEST_FOLDED
        return F.transform(rest, lambda word: F.when(short(word), _encoded_word(word["word"], word["codes"], ranks)))

    looked_up = _with_ranks(docs.mapInArrow(look_up, between), ranks, map_)
    quoted = ["`" + name.replace("`", "``") + "`" for name in (*names, codes, rest)]
    return looked_up.select(*quoted, _let(F.col(map_), fold).alias(folded)).mapInArrow(put_together, schema)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The elements of all lists, one after the other, and the length of each list."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def decoded(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that ids stand for; null if an id is null or unknown.

    The pieces of the ids, as hexadecimal digits from a literal array, are joined and made binary.
    """
    pieces: list[str | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    known = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    joined = F.array_join(F.transform(ids, lambda i: F.coalesce(F.get(known, i), F.lit("?"))), "")
    return F.when(~F.contains(joined, F.lit("?")), F.unhex(joined))
