"""Repair of conversations by weighted parsing of their rows.

A good conversation reads ``(system? (user assistant)+)?``. Rows may be kept, given another role or deleted, and
rows may be inserted; the cheapest list of edits that gives a good conversation is its audit.

The grammar is in Chomsky normal form. Its nonterminals are pairs ``pq`` of what stands before a span
and what stands at its end (nothing yet, a system, user or assistant row), its rules ``pq -> pr rq``, its terminals
edits of a single row. A cell of a span has for each nonterminal the least ``(cost, audit)``, the audit being
compared as ASCII text. Insertions take no row: they are rules without a terminal, and their closure is
multiplied to both sides of each row's cell, so that longer spans need no rule for them. Cells are combined
bottom-up by span length: rows, pairs of rows, spans of four, and so on. Joining cells is associative, so every split of
a span gives the same cell and one split for each is enough; n rows have n - 1 joins.

(Least by text is right although audits are concatenated: two audits of one span have a letter for each row besides
their insertions, so one can only begin with the other at a higher cost.)

Work at scale:

1. Rows are reduced to a few bytes each. Duplicates come from an aggregate over (conversation, digest of role and
   text); only digests that occur more than once are joined back.
2. A range shuffle by (conversation, turn, digest) cuts these rows into even slices, so a conversation may span
   many of them. Each slice parses its own part of each conversation.
3. The cells of a conversation's parts, at most one for each slice, are combined in order, again bottom-up.
4. Texts are shuffled once, when edits are applied; a conversation's rows stream through a task in order and are
   not held. (A digest of all its text has to be computed in that order in any case.)

Defined results: a null role or text counts as one space, a null turn comes first, a null conversation id is a
conversation of its own; rows of one turn are ordered by the md5 of their role and text, so copies stand beside
each other; repeated rows are duplicates; a conversation without rows has an empty audit; gaps beyond a bigint are
the largest bigint; only the four named columns are read, and their names are free, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from clicklake.llm.common import written
from clicklake.llm.sliced import batch_of, groups, slices

# The costs of edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"s": "system", "u": "user", "a": "assistant"}
SPACES = " \t\n\x0b\x0c\r"
MAX_LONG = 2**63 - 1

# What stands at the end of what was read: nothing, system, user, assistant. A role leads on as listed.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
GOOD_ENDS = (START, ASSISTANT)
# Nonterminals: the pairs that rows can lead through. Rules: the places of both parts of a pair.
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
AT = {pair: i for i, pair in enumerate(PAIRS)}
RULES = [[(AT[p, r], AT[r, q]) for r in range(4) if (p, r) in AT and (r, q) in AT] for p, q in PAIRS]

Cell = tuple  # for each nonterminal (cost, audit), or None


def join(left: Cell, right: Cell) -> Cell:
    """The cell of a span from those of its two parts."""
    made = []
    for rules in RULES:
        best = None
        for i, j in rules:
            x, y = left[i], right[j]
            if x is not None and y is not None:
                cost = x[0] + y[0]
                if best is None or cost < best[0]:
                    best = (cost, x[1] + y[1])
                elif cost == best[0]:
                    best = min(best, (cost, x[1] + y[1]))
        made.append(best)
    return tuple(made)


def _closure() -> Cell:
    """Insertions only: from each state to each other by the fewest rows, users and assistants in turn."""
    cells = {(p, p): (0, "") for p in range(4)}
    for p in range(4):
        at, text = p, ""
        for _ in range(3):
            at = USER if at in NEXT["u"] else ASSISTANT
            text += "I"
            cells.setdefault((p, at), (INSERT * len(text), text))
    return tuple(cells.get(pair) for pair in PAIRS)


CLOSURE = _closure()

# A row's code: which role it begins with (none of them: 3), and whether it is truncated; or that it must go.
INITIALS = "sua"
MUST_GO = 8


@lru_cache(None)
def leaf(code: int) -> Cell:
    """The cell of one row: its edits between insertions."""
    edits: dict[tuple[int, int], tuple[int, str]] = {(p, p): (DELETE, "D") for p in range(4)}
    if code != MUST_GO:
        extra = TRUNCATED if code & 4 else 0
        for role in "ua":
            for p, q in NEXT[role].items():
                edits[p, q] = (REROLE + extra, "R")
        if code & 3 < 3:
            for p, q in NEXT[INITIALS[code & 3]].items():
                edits[p, q] = (extra, "K")
    return join(join(CLOSURE, tuple(edits.get(pair) for pair in PAIRS)), CLOSURE)


@lru_cache(50_000)
def _short(codes: bytes) -> Cell:
    return leaf(codes[0]) if len(codes) == 1 else join(_short(codes[: len(codes) // 2]), _short(codes[len(codes) // 2 :]))


def bottom_up(cells: list[Cell]) -> Cell:
    """Neighbours are joined until one cell is left."""
    while len(cells) > 1:
        cells = [join(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else CLOSURE


def parse(codes: bytes) -> Cell:
    """The cell of all rows of these codes."""
    return bottom_up([_short(codes[i : i + 4]) for i in range(0, len(codes), 4)])


def best(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the cheapest repair."""
    return min(cell[AT[START, q]] for q in GOOD_ENDS if cell[AT[START, q]] is not None)


# -- rows ----------------------------------------------------------------------------------------


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws("", F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def numbered_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, gone: Column | None) -> DataFrame:
    """The columns that all steps read, under fixed names. ``gone`` marks rows that only name their conversation."""
    role_, text_ = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    return rows.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        role_.alias("role"),
        text_.alias("text"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
    ).withColumn("h", _digest(F.col("role"), F.col("text")))


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("h")]


def _pieces(rows: DataFrame) -> DataFrame:
    """For each conversation and slice the faults counted and the cell of the rows there."""
    ending = F.substr(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(-1), F.lit(1))
    narrow = rows.select(
        "conv_id", "turn", "h", "gone",
        F.when(F.startswith("role", F.lit("s")), 0).when(F.startswith("role", F.lit("u")), 1)
        .when(F.startswith("role", F.lit("a")), 2).otherwise(3).alias("initial"),
        F.when(ending == "", 2).when(ending.isin(".", "!", "?"), 0).otherwise(1).alias("fault"),
    )
    # A null turn is before all others; the flag keeps it apart from the least number.
    place = F.struct(F.col("turn").isNotNull().alias("a"), F.coalesce("turn", F.lit(0)).alias("b"))
    first = (
        narrow.filter("not gone and fault <> 2").groupBy(F.col("conv_id").alias("c"), F.col("h").alias("g"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    )
    known = narrow.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h") == F.col("g")) & ~F.col("gone"), "left")
    later = F.coalesce(place > F.col("first"), F.lit(False))
    known = known.select("conv_id", "turn", "h", "gone", "initial", "fault", later.alias("later"))

    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        kinds: dict[str, pa.DataType] = {}
        made: list[tuple] = []
        part: _Part | None = None
        for conv, begins, columns in groups(batches, "conv_id", kinds):
            if begins:
                if part is not None:
                    made.append(part.told(number))
                part = _Part(conv)
            part.add(columns)
            if len(made) >= 5000:
                yield batch_of(made, {"conv_id": kinds["conv_id"], **_PIECE})
                made = []
        if part is not None:
            made.append(part.told(number))
            yield batch_of(made, {"conv_id": kinds["conv_id"], **_PIECE})

    return slices(known, _order()).mapInArrow(
        run,
        f"conv_id {kind}, piece int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_role int, "
        "last_role int, first_turn bigint, last_turn bigint, low bigint, high bigint, turns bigint, costs array<bigint>, audits array<string>",
    )


_PIECE = {
    "piece": pa.int32(),
    **{n: pa.int64() for n in ("blank", "duplicate", "truncated", "illegal")},
    **{n: pa.int32() for n in ("first_role", "last_role")},
    **{n: pa.int64() for n in ("first_turn", "last_turn", "low", "high", "turns")},
    "costs": pa.list_(pa.int64()),
    "audits": pa.list_(pa.string()),
}

# Neighbours that may follow each other.
LEGAL = {(0, 1), (1, 2), (2, 1)}


class _Part:
    """The rows of a conversation in one slice, as they come."""

    def __init__(self, conv: object):
        self.conv = conv
        self.codes = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role = self.last_role = self.first_turn = self.last_turn = self.last_h = None

    def add(self, columns: dict[str, list]) -> None:
        names = ("turn", "h", "gone", "initial", "fault", "later")
        for turn, h, gone, initial, fault, later in zip(*(columns[n] for n in names)):
            if gone:
                continue
            first = not self.codes
            if turn is not None and turn != self.last_turn:
                self.turns += 1
                self.last_turn = turn
                if self.first_turn is None:
                    self.first_turn = turn
                again = False
            else:
                again = not first and h == self.last_h
            self.last_h = h
            if first:
                self.first_role = initial
            else:
                self.illegal += (self.last_role, initial) not in LEGAL
            self.last_role = initial
            code = initial
            if fault == 2:
                self.blank += 1
                code = MUST_GO
            elif later or again:
                self.duplicate += 1
                code = MUST_GO
            elif fault == 1:
                self.truncated += 1
                code |= 4
            self.codes.append(code)

    def told(self, number: int) -> tuple:
        cell = parse(bytes(self.codes))
        return (
            self.conv, number, self.blank, self.duplicate, self.truncated, self.illegal, self.first_role, self.last_role,
            self.first_turn, self.last_turn, self.first_turn, self.last_turn, self.turns,
            [c and c[0] for c in cell], [c and c[1] for c in cell],
        )


def _together(pieces: DataFrame) -> DataFrame:
    """One row for each conversation from its pieces in order."""
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[str, pa.DataType] = {}
        made: list[tuple] = []
        held: list[dict] = []
        for conv, begins, c in groups(batches, "conv_id", kinds):
            if begins and held:
                made.append(_audit(held))
                held = []
            held += [dict(zip(c, values)) for values in zip(*c.values())]
            if len(made) >= 5000:
                yield batch_of(made, {"conv_id": kinds["conv_id"], **_AUDIT})
                made = []
        if held:
            made.append(_audit(held))
            yield batch_of(made, {"conv_id": kinds["conv_id"], **_AUDIT})

    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    counts = ", ".join(f"{n} bigint" for n in _AUDIT if n != "audit")
    return dealt.mapInArrow(run, f"conv_id {kind}, {counts}, audit string")


_AUDIT = {**{n: pa.int64() for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}, "audit": pa.string()}


def _audit(pieces: list[dict]) -> tuple:
    held = [p for p in pieces if p["first_role"] is not None]
    illegal = sum((a["last_role"], b["first_role"]) not in LEGAL for a, b in zip(held, held[1:]))
    dated = [p for p in held if p["low"] is not None]
    gaps = 0
    if dated:
        # A turn cut between two slices is counted by both.
        distinct = sum(p["turns"] for p in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
        gaps = min(dated[-1]["high"] - dated[0]["low"] + 1 - distinct, MAX_LONG)
    cells = [tuple(None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"])) for p in held]
    cost, audit = best(bottom_up(cells))
    counts = [sum(p[n] for p in held) for n in ("blank", "duplicate", "truncated")]
    return (pieces[0]["conv_id"], gaps, *counts, illegal + sum(p["illegal"] for p in held), cost, audit)


# -- the operator --------------------------------------------------------------------------------


def prepared(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: Column | None = None
) -> DataFrame:
    """The rows under fixed names, as :func:`audits` and :func:`repaired` take them. ``gone`` marks rows that only
    name their conversation, which then has an audit even if it has no other rows."""
    return numbered_rows(rows, conv, turn, role, text, gone)


def audits(rows: DataFrame) -> DataFrame:
    """For each conversation the faults found and the cheapest repair: ``conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit``. The first fault of each row counts; ``illegal`` counts neighbours out of turn."""
    return _together(_pieces(rows))


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: ``conv_id, place, edit, turn, role, text``; inserted ones have no turn.

    A conversation's rows stand together and in order.
    """
    columns = ["conv_id", "audit", "turn", "h", "role", "text"]
    heads = audits.select("conv_id", "audit", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in columns[2:]])
    texts = rows.filter("not gone").select("conv_id", F.lit(None).cast("string").alias("audit"), *columns[2:])
    dealt = (
        heads.unionByName(texts).repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "h")
    )
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[str, pa.DataType] = {}
        edits: _Edits | None = None
        for conv, begins, c in groups(batches, "conv_id", kinds):
            made: list[tuple] = []
            if begins:
                if edits is not None:
                    made += edits.last()
                edits = _Edits(conv, c["audit"][0])
            at = 1 if begins else 0
            for turn, role, text in zip(c["turn"][at:], c["role"][at:], c["text"][at:]):
                made += edits.row(turn, role, text)
            if made:
                yield batch_of(made, {"conv_id": kinds["conv_id"], **_REPAIRED})
        if edits is not None and (made := edits.last()):
            yield batch_of(made, {"conv_id": kinds["conv_id"], **_REPAIRED})

    return dealt.mapInArrow(run, f"conv_id {kind}, place bigint, edit string, turn bigint, role string, text string")


_REPAIRED = {"place": pa.int64(), "edit": pa.string(), "turn": pa.int64(), "role": pa.string(), "text": pa.string()}


class _Edits:
    """An audit carried out row by row."""

    def __init__(self, conv: object, audit: str):
        self.conv, self.audit, self.at, self.place, self.state = conv, audit, 0, 0, START

    def _put(self, edit: str, turn: int | None, role: str | None, text: str) -> tuple:
        if edit == "K":
            self.state = NEXT[role[0]][self.state]
        else:
            self.state = USER if self.state in NEXT["u"] else ASSISTANT
            role = ROLES["u" if self.state == USER else "a"]
        self.place += 1
        return (self.conv, self.place - 1, edit, turn, role, text)

    def _inserted(self) -> list[tuple]:
        made = []
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            made.append(self._put("I", None, None, ""))
        return made

    def row(self, turn: int | None, role: str, text: str) -> list[tuple]:
        made = self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            made.append(self._put(edit, turn, role, text))
        return made

    def last(self) -> list[tuple]:
        return self._inserted()


def digests(repaired: DataFrame) -> DataFrame:
    """sha256 of each conversation's ``role:text`` lines; reads the rows as :func:`repaired` gives them, in their order."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[str, pa.DataType] = {}
        made: list[tuple] = []
        digest = last = None
        for conv, begins, c in groups(batches, "conv_id", kinds):
            lines = "\n".join(map("{}:{}".format, c["role"], c["text"]))
            if begins:
                if digest is not None:
                    made.append((last, digest.hexdigest()))
                digest, last = hashlib.sha256(), conv
                digest.update(lines.encode("utf-8", "surrogatepass"))
            else:
                digest.update(b"\n" + lines.encode("utf-8", "surrogatepass"))
            if len(made) >= 5000:
                yield batch_of(made, {"conv_id": kinds["conv_id"], "sha256": pa.string()})
                made = []
        if digest is not None:
            made.append((last, digest.hexdigest()))
            yield batch_of(made, {"conv_id": kinds["conv_id"], "sha256": pa.string()})

    return repaired.mapInArrow(run, f"conv_id {kind}, sha256 string")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Audits of all conversations, and the rows of the repaired ones."""
    read = prepared(rows, conv, turn, role, text)
    told = written(audits(read), "audits")
    return told, repaired(read, told)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations damaged by crc32 of ``conv_id:turn`` modulo 20: 0 marks the row as ``gone``, 1 empties the text, 2 removes its
    full stops, exclamation and question marks, 3 repeats the row, 4 makes it the user's. Nulls count as one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    hit = F.crc32(key.cast("binary")) % 20
    copies = F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.coalesce("text", space)
    return rows.select("conv_id", "turn", "role", "text", hit.alias("hit")).select(
        "conv_id",
        "turn",
        F.when(F.col("hit") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (F.col("hit") == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")
