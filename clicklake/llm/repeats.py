"""Exact removal of byte strings of ``LENGTH`` that also start earlier, by suffix sorting.

A string that starts in several places is found in five steps.

1. Anchors: of each window of ``LENGTH`` bytes the ``GRAM``-byte strings with the least hash are anchors.
   Whether a string is one depends on its window alone, so equal windows have equal anchors at equal
   places. A row per anchor goes by its hash to a task that sees all anchors of that hash. Anchors
   that a sample of the documents shows to be common are dealt by anchor and fragment, so those of a
   passage in a third of all documents are spread over many tasks.
2. Copies: the fragment of an anchor holds every window around it. If a fragment equals an earlier one,
   all its windows start earlier, and it is done. Of a fragment that stands in thousands of
   documents one row is left. Copies within one step of a task do not wait for that: they are dealt
   at random, so no anchor gathers the rows of all documents that share it.
3. Only where fragments of one anchor differ, their bytes are fetched by a join with the documents.
4. Suffix sorting of these fragments, column by column: in each round one symbol of every fragment, of
   ``SYMBOL`` bytes, is inserted, from the last to the first, and the Burrows-Wheeler transform and the lengths of
   common prefixes are brought up to date in a pass over them (:func:`sorted_suffixes`). Suffixes
   that share ``LENGTH`` bytes are then neighbours; all but the earliest start are marked.
5. The ranges of each document are joined to it and cut out.

An anchor with more than ``CROWDED`` different fragments is not sorted in one task: its windows are
compared as rows, by an aggregate and a join.

The passes of step 4 are over arrays in a task's memory, not over external files: a task sorts
fragments of a bounded total (``SORTED_FRAGMENTS``), and executors share no local files.

Defined results: null and empty texts have no bytes and nothing removed; of exact copies the one with
the smallest id stays (shorter ones than ``LENGTH`` all stay); rows that share an id count as one
document, so what one of them repeats of the other at the same place is not earlier; a null id takes part
in nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from clicklake.llm.common import free_name, mixed, runs, seeded, steps, text_bytes, written

LENGTH = 100
GRAM = 16
SORTED_FRAGMENTS = 2048
CROWDED = 100_000  # different fragments of one anchor that a task may sort: 18 MB of text
SYMBOL = 10  # bytes; LENGTH is a multiple
# Common anchors stand in COMMON_DOCS of SAMPLED_DOCS documents; one that is missed costs time, not rows.
SAMPLED_DOCS, COMMON_DOCS, MAX_COMMON = 2000, 10, 10_000

_BYTE = seeded(11, 256)
_ROOT = int(seeded(12, 1)[0]) | 1
_ROOT_INVERSE = pow(_ROOT, -1, 1 << 64)
_AROUND = LENGTH - GRAM  # an anchor may be so far from the start of its window


def _powers(root: int, size: int) -> np.ndarray:
    out = np.full(size, root, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _slide(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of each ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        values = best(values[:-have], values[have:])
        have *= 2
    return best(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


def anchors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor and of its fragment, the text it is in, and its place there."""
    data, starts, ends = text_bytes(texts)
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_ROOT, n), out=total[1:])
    inverse = _powers(_ROOT_INVERSE, n + 1)
    grams = mixed((total[GRAM:] - total[:-GRAM]) * inverse[: n - GRAM + 1])
    least = _slide(grams, _AROUND + 1, np.minimum)
    # Windows that lie within one text.
    last = np.maximum(ends - LENGTH + 1, starts)
    change = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(last, minlength=n + 1)[: n + 1]
    least[np.cumsum(change)[: len(least)] == 0] = 0
    pad = np.zeros(_AROUND, np.uint64)
    of_some_window = _slide(np.concatenate([pad, least, pad]), _AROUND + 1, np.maximum)
    at = np.flatnonzero(of_some_window[: len(grams)] == grams)
    owner = np.searchsorted(starts, at, side="right") - 1
    low, high = np.maximum(starts[owner], at - _AROUND), np.minimum(ends[owner], at + LENGTH)
    shape = (at - low).astype(np.uint64) * np.uint64(1_000_003) + (high - at).astype(np.uint64)
    fragments = mixed(((total[high] - total[low]) * inverse[low]) ^ mixed(shape))
    return grams[at], fragments, owner, at - starts[owner]


def _common_anchors(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of anchors in many of the documents that a hash of the id puts first.

    At most ``MAX_COMMON`` numbers reach the driver. They say how rows are dealt, not which there are.
    """
    spread = F.xxhash64("doc_id", F.lit("anchors"))
    sampled = docs.filter("doc_id is not null").select(spread.alias("h")).orderBy("h").limit(SAMPLED_DOCS)
    last = sampled.agg(F.max("h")).first()[0]
    if last is None:
        return np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            gram, _, owner, _ = anchors(step.column("text"))
            order = np.lexsort((owner, gram))
            gram, owner = gram[order], owner[order]
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(gram[new].view(np.int64))], names=["gram"])

    grams = docs.filter(spread <= last).select("text").mapInArrow(run, "gram bigint")
    counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON_DOCS)
    found = counted.orderBy(F.desc("n"), "gram").limit(MAX_COMMON).collect()
    return np.sort(np.array([r.gram for r in found], np.int64).view(np.uint64))


def _anchor_rows(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """``gram, fragment, doc, place, common``; ``place`` is ``-1 - place`` for a copy of one in the same step."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            step = step.filter(step.column("doc_id").is_valid())
            if not step.num_rows:
                continue
            gram, fragment, owner, place = anchors(step.column("text"))
            doc = step.column("doc_id").to_numpy()[owner]
            order = np.lexsort((place, doc, fragment, gram))
            gram, fragment, doc, place = gram[order], fragment[order], doc[order], place[order]
            same = np.zeros(len(gram), bool)
            same[1:] = (gram[1:] == gram[:-1]) & (fragment[1:] == fragment[:-1])
            again = same.copy()  # one place of two rows that share an id
            again[1:] &= (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
            same &= ~again
            key = np.where(same, mixed(gram ^ mixed(doc.astype(np.uint64)) ^ place.astype(np.uint64)), gram)
            columns = [key.view(np.int64), np.where(same, 0, fragment.view(np.int64)), doc, np.where(same, -1 - place, place)]
            often = np.isin(gram, common) & ~same
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[~again]) for c in (*columns[:3], columns[3].astype(np.int32), often)],
                names=["gram", "fragment", "doc", "place", "common"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"gram bigint, fragment bigint, doc {kind}, place int, common boolean"
    )


def _marked(rows: DataFrame) -> DataFrame:
    """``doc, mark, n``: ``2 * place`` of copies, ``2 * place + 1`` of fragments whose bytes are wanted.

    Rows come sorted, so a fragment's first row is its earliest. Bytes are wanted of first rows whose
    anchor has another fragment; where a batch ends within an anchor's rows, of its first rows anyway.
    Of a common anchor a task sees some of the fragments only, so all first rows are wanted.
    Rows without a document tell ``n`` fragments of an anchor, marked with its hash: in parts for common
    anchors, else the whole number where it is above ``CROWDED``.
    """
    kind = rows.schema["doc"].dataType.simpleString()
    id_type = pa.int32() if kind == "int" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        carried = 0  # fragments so far of the anchor that the last batch ended in

        def told(grams: list[int], counts: list[int]) -> pa.RecordBatch:
            columns = [pa.nulls(len(grams), id_type), pa.array(grams, pa.int64()), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["doc", "mark", "n"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            gram, fragment, doc, place = (batch.column(c).to_numpy() for c in ("gram", "fragment", "doc", "place"))
            common = batch.column("common").to_numpy(zero_copy_only=False)
            local = place < 0
            new_gram, new_fragment, again = np.ones(n, bool), np.ones(n, bool), np.zeros(n, bool)
            new_gram[1:] = gram[1:] != gram[:-1]
            new_fragment[1:] = new_gram[1:] | (fragment[1:] != fragment[:-1])
            again[1:] = ~new_fragment[1:] & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
            if before is not None and before[0] == gram[0]:
                new_fragment[0] = before[1] != fragment[0]
                again[0] = not new_fragment[0] and before[2:] == (doc[0], place[0])
            run_of = np.cumsum(new_gram)
            first = new_fragment & ~local
            firsts = np.bincount(run_of, first & ~common, minlength=run_of[-1] + 1)
            ends = np.append(np.flatnonzero(new_gram)[1:], n) - 1  # last row of each anchor
            sums = firsts[1:].astype(np.int64)
            if before is not None and before[0] == gram[0]:
                sums[0] += carried
            elif before is not None and carried > CROWDED:
                yield told([before[0]], [carried])
            over = np.flatnonzero(sums[:-1] > CROWDED)
            if len(over):
                yield told(gram[ends[over]].tolist(), sums[over].tolist())
            if common.any():
                part = np.bincount(run_of, first & common, minlength=run_of[-1] + 1)[1:].astype(np.int64)
                yield told(gram[ends[part > 0]].tolist(), part[part > 0].tolist())
            carried = int(sums[-1])
            wanted = first & (common | (firsts[run_of] > 1) | (run_of == run_of[0]) | (run_of == run_of[-1]))
            copies = (local | ~new_fragment) & ~again
            at = np.where(local, -1 - place, place).astype(np.int64)
            keep = copies | wanted
            before = (int(gram[-1]), int(fragment[-1]), doc[-1], place[-1])
            columns = [pa.array(doc[keep]), pa.array((2 * at + wanted)[keep]), pa.nulls(int(keep.sum()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "mark", "n"])
        if before is not None and carried > CROWDED:
            yield told([before[0]], [carried])

    dealt = rows.repartition("gram", F.when(F.col("common"), F.col("fragment")))
    sorted_rows = dealt.sortWithinPartitions("gram", "fragment", "doc", "place")
    return sorted_rows.mapInArrow(run, f"doc {kind}, mark bigint, n bigint")


def sorted_suffixes(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sort all suffixes of a collection of symbol arrays by inserting a column of symbols in each round.

    Returns the row of each suffix, as an array (text, length of the suffix), -1 where there is none; and
    for each row how many symbols it shares with the row before, at most 255. A suffix that is the
    start of another comes first; equal ones are in the order of the texts. Symbols are 1 or more.

    ``last[r]`` is the symbol before the suffix of row r, the Burrows-Wheeler transform. Rows that
    start with a symbol are in the order of that symbol's places in it, so a stable sort of the transform
    says where the new suffixes belong, and what two of them share is one more than the least of what
    the rows between their places share.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    column = np.zeros((int(sizes.max(initial=0)) + 1, len(texts)), np.int64)
    for k, text in enumerate(texts):
        column[: len(text), k] = text[::-1]
    return _insert_columns(column, sizes)


def _insert_columns(column: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`sorted_suffixes` of texts given by columns, from their ends; 0 ends a text."""
    m, longest = len(sizes), int(sizes.max(initial=0))
    column = column.astype(np.uint16 if column.max(initial=0) < 1 << 16 else np.uint32)
    row_of = np.full((m, longest + 1), -1, np.int64)
    last, shared = column[0].copy(), np.zeros(m, np.uint8)
    at, active = np.arange(m), np.arange(m)
    for size in range(1, longest + 1):
        going = sizes[active] >= size
        at, active = at[going], active[going]
        order = np.argsort(last, kind="stable")
        order = order[np.count_nonzero(last == 0) :]
        place = np.empty(len(last), np.int64)
        place[order] = np.arange(len(order))
        new = place[at]
        inserted = np.zeros(m + len(order) + 1, bool)
        inserted[m + new] = True
        # What a new row and the row after it share with the row before.
        touched = np.flatnonzero(inserted[m:] | np.concatenate([[False], inserted[m:-1]]))
        touched = touched[(touched > 0) & (touched < len(order))]
        low, high = order[touched - 1], order[touched]
        alike = last[low] == last[high]
        value = np.zeros(len(touched), np.uint8)
        value[alike] = np.minimum(_least(shared, low[alike] + 1, high[alike]), 254) + 1
        old = ~inserted[:-1]
        grown_last, grown_shared = np.empty(len(old), last.dtype), np.zeros(len(old), np.uint8)
        grown_last[old], grown_shared[old] = last, shared
        grown_last[m + new] = column[size, active]
        grown_shared[m + touched] = value
        if inserted[m]:
            grown_shared[m] = 0
        last, shared = grown_last, grown_shared
        at = m + new
    # Walk from each text's end through the finished transform.
    order = np.argsort(last, kind="stable")
    order = order[np.count_nonzero(last == 0) :]
    place = np.empty(len(last), np.int64)
    place[order] = m + np.arange(len(order))
    at, active = np.arange(m), np.arange(m)
    row_of[:, 0] = at
    for size in range(1, longest + 1):
        going = sizes[active] >= size
        at, active = place[at[going]], active[going]
        row_of[active, size] = at
    return row_of, shared


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``values[low..high]``, both included, for many ranges."""
    level = np.zeros(len(low), np.int64)
    span = high - low + 1
    np.log2(span, out=(exact := np.empty(len(low))))
    level = exact.astype(np.int64)
    out = np.empty(len(low), values.dtype)
    table, width = values, 1
    for k in range(int(level.max(initial=0)) + 1):
        here = level == k
        out[here] = np.minimum(table[low[here]], table[high[here] - width + 1])
        table = np.minimum(table[:-width], table[width:]) if len(table) > width else table
        width *= 2
    return out


def _numbered(symbols: np.ndarray) -> np.ndarray:
    """Numbers from 1 on for rows of ``SYMBOL`` bytes, equal for equal ones."""
    head = np.ascontiguousarray(symbols[:, :8]).view("<u8").ravel()
    tail = np.ascontiguousarray(symbols[:, 8:]).view("<u2").ravel()
    known = np.unique(head, return_inverse=True)[1] * 65536 + tail
    return np.unique(known, return_inverse=True)[1] + 1


def _repeated(
    doc: np.ndarray, start: np.ndarray, anchor: np.ndarray, fragments: list[bytes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges ``(fragment, first, last)`` of offsets at which a string starts that also starts earlier.

    Equal windows of fragments stand alike to the anchor. So fragments are laid out with their anchors
    below each other, and those starts are sorted together that have the same distance to it modulo
    ``SYMBOL``, the number of bytes of a symbol of the sort.
    """
    m, need, width = len(fragments), LENGTH // SYMBOL, _AROUND + LENGTH
    left = _AROUND - anchor
    right = left + np.array([len(f) for f in fragments])
    laid = np.zeros((m, width), np.uint8)
    for k, fragment in enumerate(fragments):
        laid[k, left[k] : right[k]] = np.frombuffer(fragment, np.uint8)
    rank = np.unique(doc, return_inverse=True)[1]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for phase in range(SYMBOL):
        n = (width - phase) // SYMBOL
        numbers = _numbered(laid[:, phase : phase + n * SYMBOL].reshape(m * n, SYMBOL)).reshape(m, n)
        begin, end = np.maximum(0, -((phase - left) // SYMBOL)), np.minimum(n, (right - phase) // SYMBOL)
        count = np.maximum(0, end - begin)
        from_end = np.arange(n + 1)[:, None]
        column = np.where(from_end < count, numbers[np.arange(m), np.clip(end - 1 - from_end, 0, n - 1)], 0)
        row_of, shared = _insert_columns(column, count)
        fragment, length = np.nonzero(row_of[:, need:] >= 0)
        length += need
        group = np.cumsum(shared < need)[row_of[fragment, length]]
        crowded = np.bincount(group, minlength=1)[group] > 1
        fragment, length, group = fragment[crowded], length[crowded], group[crowded]
        at = phase + SYMBOL * (end[fragment] - length) - left[fragment]
        place, owner = start[fragment] + at, rank[fragment]
        order = np.lexsort((place, owner, group))
        group, owner, place = group[order], owner[order], place[order]
        head = np.ones(len(group), bool)
        head[1:] = group[1:] != group[:-1]
        first = np.maximum.accumulate(np.where(head, np.arange(len(group)), 0))
        later = (owner != owner[first]) | (place != place[first])
        found.append((fragment[order][later], at[order][later]))
    fragment, at = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((at, fragment))
    fragment, at = fragment[order], at[order]
    cut = np.ones(len(fragment), bool)
    cut[1:] = (fragment[1:] != fragment[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(fragment))[: len(begin)] - 1
    return fragment[begin], at[begin], at[end]


def _comparable(fragments: list[bytes], places: list[int]) -> list[int]:
    """Which fragments of one anchor can share a window with another.

    A window reaches half of its other bytes beyond the anchor on one side at least, so two that share
    one agree in the anchor with that half on the left, or on the right.
    """
    half = (_AROUND + 1) // 2
    left = [f[p - half : p + GRAM] if p >= half else None for f, p in zip(fragments, places)]
    right = [f[p : p + GRAM + half] if len(f) >= p + GRAM + half else None for f, p in zip(fragments, places)]
    counts: dict = {}
    for side, keys in enumerate((left, right)):
        for key in keys:
            if key is not None:
                counts[side, key] = counts.get((side, key), 0) + 1
    return [k for k in range(len(fragments)) if max(counts.get((0, left[k]), 0), counts.get((1, right[k]), 0)) > 1]


def _ranges(fragments: DataFrame) -> DataFrame:
    """``doc, first, last``: starts of strings that also start earlier, from fragments of one anchor."""
    kind = fragments.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc: list[np.ndarray] = []
        start: list[np.ndarray] = []
        anchor: list[int] = []
        held: list[bytes] = []

        def sort() -> pa.RecordBatch:
            docs, starts = np.concatenate(doc), np.concatenate(start)
            fragment, first, last = _repeated(docs, starts, np.array(anchor), held)
            out = [docs[fragment], starts[fragment] + first, starts[fragment] + last]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["doc", "first", "last"])

        for run_ in runs(batches, ["gram"]):
            if run_.num_rows < 2:
                continue
            pieces = run_.column("bytes").to_pylist()
            places = (run_.column("place").to_numpy() - run_.column("start").to_numpy()).tolist()
            chosen = _comparable(pieces, places)
            if not chosen:
                continue
            doc.append(run_.column("doc").to_numpy()[chosen])
            start.append(run_.column("start").to_numpy()[chosen])
            anchor.extend(places[k] for k in chosen)
            held.extend(pieces[k] for k in chosen)
            if len(held) >= SORTED_FRAGMENTS:
                yield sort()
                doc, start, anchor, held = [], [], [], []
        if held:
            yield sort()

    dealt = fragments.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, f"doc {kind}, first bigint, last bigint")


def _ranges_by_window(fragments: DataFrame) -> DataFrame:
    """The same for anchors with so many fragments that one task is not to sort them.

    Every window is a row with a hash of 128 bits. The earliest start of each hash is found by an
    aggregate, which combines before its shuffle, and joined back, where Spark splits what is skewed.
    """
    kind = fragments.schema["doc"].dataType.simpleString()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, start, raw in zip(batch.column("doc"), batch.column("start").to_pylist(), batch.column("bytes").to_pylist()):
                n = max(0, len(raw) - LENGTH + 1)
                hashes = [hashlib.blake2b(raw[k : k + LENGTH], digest_size=16).digest() for k in range(n)]
                columns = [pa.array(hashes, pa.binary()), pa.array([doc.as_py()] * n, doc.type), pa.array(range(start, start + n), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["window", "doc", "first"])

    every = fragments.select("doc", "start", "bytes").mapInArrow(windows, f"window binary, doc {kind}, first bigint")
    earliest = every.groupBy("window").agg(F.min(F.struct("doc", "first")).alias("earliest"))
    later = every.join(earliest, "window").filter(F.struct("doc", "first") != F.col("earliest"))
    return later.select("doc", "first", F.col("first").alias("last")).distinct()


def _fetched(with_marks: DataFrame) -> DataFrame:
    """``gram, doc, place, start, bytes`` of the fragments whose bytes are wanted."""
    kind = with_marks.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            rows = []
            for doc, text, marks in zip(step.column("doc_id"), step.column("text"), step.column("marks")):
                if not marks.is_valid or not text.is_valid:
                    continue
                raw = text.as_buffer().to_pybytes()
                wanted = marks.values.to_numpy()
                places = wanted[wanted % 2 == 1] // 2
                data = np.frombuffer(raw, np.uint8)[places[:, None] + np.arange(GRAM)]
                grams = mixed((_BYTE[data] * _powers(_ROOT, GRAM)).sum(axis=1, dtype=np.uint64)).view(np.int64)
                for gram, place in zip(grams.tolist(), places.tolist()):
                    start = max(0, place - _AROUND)
                    rows.append((gram, doc.as_py(), place, start, raw[start : place + LENGTH]))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), step.column("doc_id").type, pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["gram", "doc", "place", "start", "bytes"]
            )

    return with_marks.mapInArrow(run, f"gram bigint, doc {kind}, place bigint, start bigint, bytes binary")


def without_repeats(docs: DataFrame, text: str = "text", kept: str = "kept", as_text: bool = False) -> DataFrame:
    """Add ``kept`` (binary), ``n_removed`` and ``n_spans`` to the documents (``doc_id``, ``text``).

    ``kept`` holds the bytes that are left. A cut may go through a character; ``as_text`` leaves out what
    is left of such a character and gives a string.
    """
    texts = docs.select("doc_id", F.col(text).alias("text"))
    marks = written(_marked(_anchor_rows(texts, _common_anchors(texts))), "marks")
    by_doc = marks.filter("doc is not null").groupBy("doc").agg(F.collect_list("mark").alias("marks"))
    # Both joins deal whole documents by id, in the same way, so that Spark deals them once. Neither
    # side is bounded: no broadcast.
    marked = docs.join(by_doc.hint("merge"), docs["doc_id"] == by_doc["doc"], "left")
    marked = marked.select(docs["doc_id"], docs[text].alias("text"), by_doc["marks"])
    fragments = _fetched(marked)
    counted = marks.filter("doc is null").groupBy(F.col("mark").alias("gram")).agg(F.sum("n").alias("n"))
    crowded = counted.filter(F.col("n") > CROWDED).select("gram")
    if crowded.isEmpty():
        ranges = _ranges(fragments)
    else:
        ranges = _ranges(fragments.join(crowded, "gram", "left_anti"))
        ranges = ranges.unionByName(_ranges_by_window(fragments.join(crowded, "gram", "left_semi")))
    copies = marks.filter("doc is not null and mark % 2 = 0").select(
        "doc", (F.col("mark") / 2).cast("bigint").alias("first"), F.lit(-1).cast("bigint").alias("last")
    )
    cuts = ranges.unionByName(copies).groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("cuts"))
    joined = docs.join(cuts.hint("merge"), docs["doc_id"] == cuts["doc"], "left").select(docs["*"], cuts["cuts"])
    names = [free_name(docs, n) for n in (kept, "n_removed", "n_spans")]
    schema = StructType(
        [*docs.schema.fields, *(StructField(n, k) for n, k in zip(names, (StringType() if as_text else BinaryType(), LongType(), LongType())))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, text):
            left, removed, spans = [], [], []
            for value, found in zip(step.column(step.schema.names.index(text)), step.columns[-1]):
                raw = value.as_buffer().to_pybytes() if value.is_valid else b""
                gone = _covered(found.values, len(raw)) if found.is_valid else np.zeros(len(raw), bool)
                left.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            columns = step.columns[:-1]
            rest = pa.array([x.decode(errors="ignore") for x in left], pa.string()) if as_text else pa.array(left, pa.binary())
            made = [rest, pa.array(removed, pa.int64()), pa.array(spans, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*step.schema.names[:-1], *names])

    return joined.mapInArrow(run, schema)


def _covered(cuts: pa.StructArray, size: int) -> np.ndarray:
    """Which bytes the cuts take. A cut is a run of starts, or a whole fragment around an anchor."""
    first, last = cuts.field("first").to_numpy(), cuts.field("last").to_numpy()
    whole = last < 0
    begin = np.minimum(np.where(whole, np.maximum(0, first - _AROUND), first), size)
    end = np.minimum(np.where(whole, first, last) + LENGTH, size)
    change = np.bincount(begin, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    return np.cumsum(change)[:size] > 0
