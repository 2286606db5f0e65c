"""Packing documents into sequences of a fixed number of tokens, balanced by attention cost.

A sequence costs its length, for the layers that see each place by itself and also those not filled yet, and
``quadratic * n * n`` for attention within each piece of n tokens in it. Documents are taken by descending
cost, and each goes to the sequence of lowest cost so far that has room for it. Where none has, the
document is cut: the sequence of lowest cost with any room is filled up, and the rest of the document goes
on by the same rule. So documents longer than a sequence fill whole ones.

Each task reads its own rows and packs them in lots of ``LOT`` tokens; no text is shuffled and nothing is gathered,
so no source, id or length can overload a task. A lot has exactly as many sequences as its tokens fill; what is left
over, less than a sequence, is packed with the next lot. The last lot of a task cuts its remainder into
sequences whose lengths are powers of two, which need no padding. Memory is bounded by a lot, or by
one document if that is longer.

Ids come from the given tokenizer. Its normaliser and splitter never reach across white space, so a text is cut at
spaces and line feeds, and each distinct chunk is encoded once per worker and kept, up to ``CACHED`` of them.

Defined results: null and empty texts are the end id alone; repeated rows are packed each by itself; ties of
cost keep the order of reading; columns of the input other than the text are kept, and a new column whose name is
taken gets underscores before it; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from clicklake.llm.common import free_name, steps

CAPACITY = 4096
END_ID = 2
# Attention beside the other layers of a model of width 4096, whose work for a token is 6 x 4096 times that of a pair.
QUADRATIC = 1 / 24_576
LOT = 4 << 20  # tokens
CACHED = 1_600_000  # in two generations, of some 200 bytes each
LONGEST_CACHED = 48  # characters
_PLAIN_ENDS = ".,;:!?"
# Fixed value: how the tokenizer marks the last piece of a word.
_WORD_END = "</w>"

NEW = ("start", "length", "doc_tokens", "sequence_id", "offset")


class Encoder:
    """Ids of texts as little-endian 32-bit integers, by a tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        ends = [i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith(_WORD_END)]
        self.word_end = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.word_end[ends] = True

    def _singles(self, chunks: list[str]) -> Iterator[bytes]:
        for encoded in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False):
            yield np.array(encoded.ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of chunks of letters, each one word: they are encoded together and cut behind each word's end."""
        for begin in range(0, len(words), 20_000):
            some = words[begin : begin + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.word_end[ids]) + 1
            if len(cuts) != len(some) or cuts[-1] != len(ids):
                yield from self._singles(some)
                continue
            held, last = ids.tobytes(), 0
            for cut in (4 * cuts).tolist():
                yield held[last:cut]
                last = cut

    def _learn(self, chunks: list[str]) -> None:
        """Take chunks in that are not known. Letters before plain marks are a word by themselves, as they are split there."""
        known, older = self.known, self.older
        words, singles, joined = {}, [], []
        for c in chunks:
            if (ids := older.get(c)) is not None:
                known[c] = ids
                continue
            word = c.rstrip(_PLAIN_ENDS)
            tail = c[len(word) :]
            if word.isascii() and word.isalpha():
                word = word.lower()  # as the tokenizer would; other letters it lowers in its own way
            elif not (word.isalpha() and word.lower().isalpha()):
                singles.append(c)
                continue
            if word not in known:
                words[word] = None
            if tail and tail not in known:
                singles.append(tail)
            joined.append((c, word, tail))
        words = list(words)
        known.update(zip(words, self._words(words)))
        singles = list(dict.fromkeys(singles))
        known.update(zip(singles, self._singles(singles)))
        for c, word, tail in joined:
            known[c] = known[word] + known[tail]

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text. What is known is kept while it is among the latest; very long chunks are not kept."""
        if len(self.known) > CACHED // 2:
            self.older, self.known = self.known, {"": b""}
        chunks = [(t or "").replace("\n", " ").split(" ") for t in texts]
        known = self.known
        new = [c for c in set().union(*chunks) if c not in known]
        self._learn(new)
        encoded = [b"".join(map(known.__getitem__, words)) for words in chunks]
        for c in new:
            if len(c) > LONGEST_CACHED:
                known.pop(c, None)
                known.pop(c.rstrip(_PLAIN_ENDS).lower(), None)
        return encoded


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """One encoder for all tasks of a worker process."""
    return Encoder(path)


@dataclass
class Item:
    """What is still to be placed of a document: its ids from ``start`` on."""

    row: int
    start: int
    ids: bytes
    total: int

    @property
    def size(self) -> int:
        return len(self.ids) >> 2


def place(items: list[Item], capacities: list[int], quadratic: float = QUADRATIC) -> tuple[list[tuple[Item, int, int, int]], list[Item]]:
    """``(item, tokens, sequence, offset)`` of each piece, and what finds no room any more."""
    room = np.array(capacities, np.int64)
    size = room.copy()
    spent = room.astype(float)
    pieces, left = [], []
    for item in sorted(items, key=lambda i: -i.size):
        while True:
            fits = np.flatnonzero(room >= item.size)
            if not len(fits):
                fits = np.flatnonzero(room)
                if not len(fits):
                    left.append(item)
                    break
            at = int(fits[spent[fits].argmin()])
            taken = min(item.size, int(room[at]))
            pieces.append((item, taken, at, int(size[at] - room[at])))
            room[at] -= taken
            spent[at] += quadratic * taken * taken
            if taken == item.size:
                break
            item = Item(item.row, item.start + taken, item.ids[4 * taken :], item.total)
    return pieces, left


def _powers(n: int) -> list[int]:
    """The powers of two that add up to ``n``, highest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    quadratic: float = QUADRATIC,
    lot: int = LOT,
    ids: str | None = "ids",
) -> DataFrame:
    """One row for each piece, instead of each document.

    ``start`` is the number of the document's ids before the piece, ``length`` its own ids, ``doc_tokens`` all of the
    document with the end id, ``sequence_id`` its sequence and ``offset`` its place there. ``ids`` names the column of the
    piece's ids as little-endian unsigned 32-bit integers; None leaves them out and gives their crc32 as ``ids_crc32``.
    ``capacity`` must be a power of two, or what a task has left over is padded.
    """
    kept = [c for c in docs.columns if c != text]
    frame = docs.select(*[f"`{c}`" for c in [text, *kept]])
    names = {}
    for name in (*NEW, ids or "ids_crc32"):
        names[name] = free_name(frame.drop(text), name)
    made = [StructField(names[n], LongType()) for n in NEW]
    made.append(StructField(names[ids], BinaryType()) if ids else StructField(names["ids_crc32"], LongType()))
    schema = StructType([f for f in frame.schema.fields[1:]] + made)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        first = TaskContext.get().partitionId() << 33
        count = 0
        items: list[Item] = []
        held: list[pa.RecordBatch] = []
        rows = tokens = 0

        def packed(capacities: list[int]) -> Iterator[pa.RecordBatch]:
            nonlocal items, held, rows, tokens, count
            pieces, left = place(items, capacities, quadratic)
            # Columns that are kept are put together once and taken by row number.
            whole = pa.Table.from_batches(held).combine_chunks()
            for begin in range(0, len(pieces), 10_000):
                some = pieces[begin : begin + 10_000]
                at = pa.array([p[0].row for p in some], pa.int64())
                columns = [whole.column(i).take(at).combine_chunks() for i in range(1, whole.num_columns)]
                for values in (
                    [p[0].start for p in some],
                    [p[1] for p in some],
                    [p[0].total for p in some],
                    [first + count + p[2] for p in some],
                    [p[3] for p in some],
                ):
                    columns.append(pa.array(values, pa.int64()))
                cut = [p[0].ids[: 4 * p[1]] for p in some]
                columns.append(pa.array(cut, pa.binary()) if ids else pa.array(map(zlib.crc32, cut), pa.int64()))
                columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            count += len(capacities)
            rest = whole.take(pa.array([i.row for i in left], pa.int64())).combine_chunks()
            held, rows = rest.to_batches(), len(left)
            items = [Item(n, i.start, i.ids, i.total) for n, i in enumerate(left)]
            tokens = sum(i.size for i in items)

        for batch in batches:
            for step in steps(iter([batch]), text):
                for n, encoded in enumerate(encoder.texts(step.column(0).to_pylist())):
                    item = Item(rows + n, 0, encoded + end, len(encoded) // 4 + 1)
                    items.append(item)
                    tokens += item.size
                # The number stands for the text, which is not needed any more.
                held.append(pa.RecordBatch.from_arrays([pa.nulls(step.num_rows), *step.columns[1:]], names=step.schema.names))
                rows += step.num_rows
                if tokens >= max(lot, capacity):
                    yield from packed([capacity] * (tokens // capacity))
        if items:
            whole, rest = divmod(tokens, capacity)
            yield from packed([capacity] * whole + _powers(rest))

    return frame.mapInArrow(run, schema)
