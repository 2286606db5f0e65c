"""Packing, repair of conversations, and the trie of their first turns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clicklake.llm import packing, prefix_trie, queries, repair, sliced
from conftest import SMALL

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n", "é", "é", "İ,,", "AΣ. Σ", "don't, I'LL!", "a\x1cb\x85c", "\x00", "<|endoftext|>", "a" * 60_000, "word " * 30_000, "x", "x"]


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(TOKENIZER)
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


# -- packing -------------------------------------------------------------------------------------


def test_encoder_is_the_tokenizer(tokenizer):
    draw = random.Random(0)
    letters = "aAbB'stl.,;:!?  \n\t\r\x1c\x85 é́ΣσİßǅÅñ1٣中。—‍🙂<|"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(3000)] + [t for t in ODD if t]
    encoder = packing.Encoder(TOKENIZER)
    for begin in range(0, len(texts), 100):
        some = texts[begin : begin + 100]
        assert encoder.texts(some) == [np.array(ids_of(tokenizer, t)[:-1], "<u4").tobytes() for t in some]
    assert max(map(len, encoder.known)) <= packing.LONGEST_CACHED


def check_pieces(rows, texts, tokenizer, capacity):
    """Pieces give every document's ids once, and fill their sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = np.array(ids_of(tokenizer, texts[doc]), "<u4")
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == [0, *itertools.accumulate(r.length for r in pieces)][:-1]
        assert sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [0, *itertools.accumulate(r.length for r in pieces)][:-1]
        filled = sum(r.length for r in pieces)
        assert filled <= capacity
        padding += 0 if filled & (filled - 1) == 0 else capacity - filled
    assert padding == 0


def test_packing_of_a_table(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    check_pieces(queries.op11_packing(spark, SMALL).collect(), texts, tokenizer, 4096)


@pytest.mark.parametrize("lot", [256, 4096, 1 << 20])
def test_packing_of_odd_texts(spark, tokenizer, lot):
    rows = [(i, text, i) for i, text in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `offset` bigint").repartition(3)
    made = packing.pack(docs, TOKENIZER, capacity=256, lot=lot, ids=None)
    assert made.columns == ["doc_id", "offset", "start", "length", "doc_tokens", "sequence_id", "_offset", "ids_crc32"]
    assert made.filter("doc_id <> offset").count() == 0
    check_pieces(made.drop("offset").withColumnRenamed("_offset", "offset").collect(), dict(enumerate(ODD)), tokenizer, 256)
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0
    ids = b"".join(r.ids for r in packing.pack(docs.filter("doc_id = 8"), TOKENIZER).orderBy("start").collect())
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, ODD[8])


def plain_placing(sizes, capacities):
    """Documents by descending size into the cheapest sequence with room, cut where none holds the whole."""
    room, spent, placed, left = list(capacities), list(capacities), [], []
    for doc in sorted(range(len(sizes)), key=lambda d: -sizes[d]):
        rest = sizes[doc]
        while rest:
            some = [i for i in range(len(room)) if room[i] >= rest] or [i for i in range(len(room)) if room[i]]
            if not some:
                left.append((doc, rest))
                break
            at = min(some, key=lambda i: spent[i])
            n = min(rest, room[at])
            placed.append((doc, n, at, capacities[at] - room[at]))
            room[at] -= n
            spent[at] += packing.QUADRATIC * n * n
            rest -= n
    return placed, left


def test_placing_by_a_plain_loop():
    draw = random.Random(1)
    for _ in range(40):
        sizes = [int(draw.lognormvariate(4, 1.5)) + 1 for _ in range(draw.randrange(1, 60))]
        whole, rest = divmod(sum(sizes), 256)
        capacities = [256] * whole + (packing._powers(rest) if draw.random() < 0.5 else [])
        items = [packing.Item(i, 0, bytes(4 * n), n) for i, n in enumerate(sizes)]
        pieces, left = packing.place(items, capacities)
        assert ([(p[0].row, *p[1:]) for p in pieces], [(i.row, i.size) for i in left]) == plain_placing(sizes, capacities)


def test_costs_are_balanced():
    draw = random.Random(2)
    sizes = [int(draw.lognormvariate(6, 0.3)) + 1 for _ in range(4000)]
    items = [packing.Item(i, 0, bytes(4 * n), n) for i, n in enumerate(sizes)]
    pieces, _ = packing.place(items, [4096] * (sum(sizes) // 4096))

    def spread(found):
        costs = defaultdict(float)
        for size, sequence in found:
            costs[sequence] += size * size
        values = np.array(list(costs.values()))
        return values.std() / values.mean(), values.max()

    in_order, at = [], 0
    for n in sizes:
        while n:
            step = min(n, 4096 - at % 4096)
            in_order.append((step, at // 4096))
            at, n = at + step, n - step
    deviation, most = spread((p[1], p[2]) for p in pieces)
    plain_deviation, plain_most = spread(in_order)
    assert deviation < 0.5 * plain_deviation and most < plain_most, (deviation, plain_deviation, most, plain_most)


# -- repair --------------------------------------------------------------------------------------

WHITE = " \t\n\x0b\x0c\r"


def whole_parse(codes):
    """CYK over all spans and all their splits: least (cost, audit)."""
    n = len(codes)
    cells = {(i, i + 1): repair.leaf(c) for i, c in enumerate(codes)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            splits = [repair.join(cells[i, k], cells[k, i + size]) for k in range(i + 1, i + size)]
            cells[i, i + size] = tuple(min((s[p] for s in splits if s[p] is not None), default=None) for p in range(len(repair.PAIRS)))
    return repair.best(cells[0, n] if n else repair.CLOSURE)


def all_edits(rows):
    """Cheapest audit by trying every edit of every row, with up to two rows inserted at any place."""
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        for inserted in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * k + e for k, e in zip(inserted, [*letters, ""]))
            cost, text, fits = 2 * sum(inserted), "", True
            for k, e, row in zip(inserted, [*letters, ""], [*rows, None]):
                text += "?" * k
                if e == "D":
                    cost += 3
                elif e:
                    fits &= row != "gone"
                    cost += (2 if e == "R" else 0) + (row[1:] == "t")
                    text += "?" if e == "R" else row[0]
            # Rows inserted or given a role may be either role.
            if fits and re.fullmatch(r"(s?([u?][a?])+)?", text) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_parse_against_all_edits():
    kinds = {"s": 0, "st": 4, "u": 1, "ut": 5, "a": 2, "at": 6, "x": 3, "gone": repair.MUST_GO}
    draw = random.Random(3)
    for size in range(5):
        for _ in range(12):
            rows = [draw.choice(list(kinds)) for _ in range(size)]
            codes = bytes(kinds[r] for r in rows)
            assert repair.best(repair.parse(codes)) == whole_parse(codes) == all_edits(rows), rows


def test_parse_of_long_spans():
    draw = random.Random(4)
    for size in (7, 16, 23):
        codes = bytes(draw.choice([0, 1, 2, 3, 5, 6, 8]) for _ in range(size))
        cut = draw.randrange(1, size)
        parts = [repair.parse(codes[:cut]), repair.parse(codes[cut:])]
        assert repair.best(repair.parse(codes)) == whole_parse(codes) == repair.best(repair.bottom_up(parts))


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest(*r[1:])))


def damaged(rows):
    made = defaultdict(list)
    for conv, turn, role, text in rows:
        made[conv]
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        made[conv] += [(turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return {conv: in_order(rows) for conv, rows in made.items()}


def plain_repair(rows):
    """Row by row: for each state the cheapest edits so far and the rows they give."""
    seen, faults = set(), []
    for turn, role, text in rows:
        last = text.strip(WHITE)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    names = {"": "user", "s": "user", "a": "user", "u": "assistant"}

    def inserted(ways):
        for _ in range(3):
            for state, (cost, audit, lines) in list(ways.items()):
                offer(ways, names[state][0], (cost + 2, audit + "I", [*lines, names[state] + ":"]))
        return ways

    def offer(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    ways = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, lines) in ways.items():
            offer(after, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            cost += fault == "truncated"
            name = names[state]
            offer(after, name[0], (cost + 2, audit + "R", [*lines, f"{name}:{text}"]))
            if role[:1] == name[0] or (role[:1] == "s" and state == ""):
                offer(after, role[0], (cost, audit + "K", [*lines, f"{role}:{text}"]))
        ways = inserted(after)
    cost, audit, lines = min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])
    gaps = min(max(turns) - min(turns) + 1 - len(set(turns)), 2**63 - 1) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_repair_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()]
    got = {r[0]: tuple(r)[1:] for r in queries.op12_repair(spark, "/root/testdata/sf0.01").collect()}
    assert got == {conv: plain_repair(rows) for conv, rows in damaged(rows).items()}


ODD_TURNS = (
    [(1, t, "user" if t % 2 == 0 else "assistant", "Same words again.") for t in range(300)]
    + [(2, t, random.Random(t).choice(["system", "user", "assistant", "tool", "", None, "s", "u"]), random.Random(t).choice(["Yes.", "No", " ", "", None, "x!"])) for t in range(400)]
    + [(None, None, None, None), (None, 3, "user", "Hello."), (None, 3, "user", "Hello."), (None, None, "system", "Be short.")]
    + [(4, 2**63 - 1, "user", "a" * 100_000), (4, -(2**63), "assistant", "Word. " * 20_000)]
    + [(5, 1, "user", "Hi.")] * 40 + [(60, t, "user", "Hi.") for t in range(3)] + [(61 + k, t, "assistant", f"{t}.") for k in range(19) for t in range(3)]
)


def write_turns(spark, folder, rows):
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    # Columns that are called as the results are.
    turns.withColumn("audit", F.lit("x")).withColumn("n_convs", F.lit("x")).repartition(5).write.parquet(f"{folder}/conversations.parquet")


def test_repair_of_odd_rows_cut_into_slices(spark, folder):
    write_turns(spark, folder, ODD_TURNS)
    got = {r[0]: tuple(r)[1:] for r in queries.op12_repair(spark, folder).collect()}
    want = {conv: plain_repair(rows) for conv, rows in damaged(ODD_TURNS).items()}
    assert got == want
    pieces = repair._pieces(repair.prepared(spark.read.parquet(f"{folder}/conversations.parquet")))
    assert pieces.filter("conv_id = 2").count() > 1  # cut between slices
    write_turns(spark, f"{folder}/none", [])
    assert queries.op12_repair(spark, f"{folder}/none").count() == 0


def test_repaired_rows(spark):
    rows = [(7, 1, "system", "Be brief."), (7, 2, "assistant", "Hi."), (7, 3, "assistant", "Hi."), (7, 4, "tool", "Done")]
    audits, made = repair.repair(spark.createDataFrame(rows, "c int, t int, r string, x string"), "c", "t", "r", "x")
    assert [tuple(r) for r in audits.collect()] == [(7, 0, 0, 1, 1, 3, 8, "KIKDD")]
    assert [tuple(r)[1:] for r in made.collect()] == [
        (0, "K", 1, "system", "Be brief."), (1, "I", None, "user", ""), (2, "K", 2, "assistant", "Hi."),
    ]


# -- trie ----------------------------------------------------------------------------------------


def plain_trie(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn, role or "", text or ""))
    by = {conv: [r[1:] for r in in_order(turns)] for conv, turns in by.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv in sorted(by):
        h = zlib.crc32(str(conv).encode()) % 4
        turns = tuple(by.get(conv - conv % 20, [])[:h] + by[conv][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
            if d:
                children[turns[: d - 1]].add(turns[:d])
        ends[turns].append(conv)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
    return [
        (
            members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),
        )
        for n in members
    ]


def rows_of_trie(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_trie_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()]
    assert rows_of_trie(queries.op13_prefix_trie(spark, "/root/testdata/sf0.01")) == sorted(plain_trie(rows), key=str)


def test_trie_of_odd_rows_cut_into_slices(spark, folder):
    deep = [(20 * k, t, "user", f"{t // (300 - 40 * k)} x") for k in range(4) for t in range(300)]
    for number, rows in enumerate((ODD_TURNS, deep + ODD_TURNS, [])):
        write_turns(spark, f"{folder}/{number}", rows)
        assert rows_of_trie(queries.op13_prefix_trie(spark, f"{folder}/{number}")) == sorted(plain_trie(rows), key=str)


@pytest.mark.parametrize("band", [2, 3])
def test_bands_of_bands(spark, band):
    rows = [(k, t, "user", f"{'same' if t < 9 * k % 23 else k} {t}") for k in range(1, 9) for t in range(23)]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    heads = prefix_trie.rebuilt_heads(turns)
    assert rows_of_trie(prefix_trie.trie(turns, heads, band)) == sorted(plain_trie(rows), key=str)
    whole = prefix_trie.trie(turns, None, band).filter("depth = 0").collect()
    assert len(whole) == 1 and whole[0].n_convs == 8


def test_slices_that_begin_with_turns_to_skip(spark, monkeypatch):
    """Every slice is a row or two, so first turns that give way stand in several."""
    monkeypatch.setattr(sliced, "shuffle_partitions", lambda _: 200)
    rows = [(c, t, "user", f"{c if t % 2 else 0} {t}") for c in (20, 21, 22, 23, 25, 40, 41) for t in range(8)]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert rows_of_trie(prefix_trie.trie(turns, prefix_trie.rebuilt_heads(turns))) == sorted(plain_trie(rows), key=str)


def test_lists_of_ends_in_pieces(spark, monkeypatch):
    rows = [(c, 0, "user", "Hi.") for c in range(3000)]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = prefix_trie.trie(turns).filter("depth = 1").collect()
    assert [r.n_convs for r in got] == [3000]
    assert got[0].ends_sha256 == hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
