"""Components, near-duplicates, range join and repeats against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklake.llm import components as graph
from clicklake.llm import metric_join, minhash_join, repeats

ASCII = {65 + i: 97 + i for i in range(26)}


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(1000, 1060)]  # a chain
    links += [(5000, 5001 + i) for i in range(300)]  # a hub
    links += [(draw.randrange(200), draw.randrange(200)) for _ in range(120)]
    links += links[:5] + [(7, 7)]
    df = spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")
    got = {r.node: r.component for r in graph.components(df).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == least_reachable(linked, links)
    assert graph.components(df.limit(0)).count() == 0


# -- near-duplicates -----------------------------------------------------------------------------


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_by_force(rows):
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(shingles(text))
    docs = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(docs)
        for b in docs[:i]
        if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])
    ]
    return least_reachable(docs, links)


def edited(draw, words, share):
    return " ".join(f"e{draw.randrange(99)}" if draw.random() < share else w for w in words)


def near_rows():
    draw = random.Random(5)
    rows = []
    for group in range(4):
        base = [f"w{draw.randrange(5000)}" for _ in range(150)]
        rows += [" ".join(base).title()] * 3
        rows += [edited(draw, base, draw.choice([0.01, 0.02, 0.04])) for _ in range(25)]
    rows += [" ".join(f"u{draw.randrange(9999)}" for _ in range(60)) for _ in range(30)]
    rows += [None, "", " \t\n", "one two", "ONE  two", "one two three", "É a b c d", "é a b c d", "x" * 100_000]
    rows += [" ".join(f"long{i % 20_000}" for i in range(40_000))] * 2
    return [(7 * i + 3, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_join, "BLOCK", block)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumnRenamed("text", "text").repartition(5)
    got = {r.doc_id: r for r in minhash_join.near_duplicates(docs).collect()}
    assert {d: r.component_id for d, r in got.items()} == near_by_force(rows)
    assert all(r.n_shingles == len(shingles(text)) for d, text in rows for r in [got[d]])
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("strays", [0, 2])
def test_work_grows_in_step_with_a_cluster(spark, monkeypatch, strays):
    """Near copies of one text, each with a date of its own, beside texts that share posting lists with them."""
    monkeypatch.setattr(minhash_join, "BLOCK", 16)
    monkeypatch.setattr(minhash_join, "HUBS", 8)
    dealt = []

    def counted(deal):
        def run(lists):
            made = deal(lists)
            dealt[-1] += made.count()
            return made

        return run

    for name in ("_near_blocks", "_paired_blocks"):
        monkeypatch.setattr(minhash_join, name, counted(getattr(minhash_join, name)))
    body = [f"word{i}" for i in range(120)]
    for size in (150, 600):
        dealt.append(0)
        rows = [(i, " ".join(body) + f" on day {i} of the year") for i in range(size)]
        rows += [(size + s, " ".join(body[:100] + [f"other{s}x{i}" for i in range(20)])) for s in range(strays)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(docs).collect()}
        assert got == {i: i if i >= size else 0 for i, _ in rows}
    print(dealt)
    assert dealt[1] <= 6 * dealt[0], dealt


def test_near_duplicates_of_odd_tables(spark):
    kind = "doc_id bigint, text string, token string, component bigint"
    assert minhash_join.near_duplicates(spark.createDataFrame([], kind)).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text, "t", 1), (None, None, "t", 1), (4, text, "t", 1), (4, text, "t", 1), (9, text, "t", 1)]
    got = [tuple(r) for r in minhash_join.near_duplicates(spark.createDataFrame(rows, kind)).collect()]
    assert sorted(got, key=repr) == sorted(
        [(None, 36, None, True), (None, 0, None, True), (4, 36, 4, True), (4, 36, 4, True), (9, 36, 4, False)], key=repr
    )


def test_bound_is_never_below_the_overlap():
    draw = np.random.default_rng(1)
    import pyarrow as pa

    sets = [np.unique(draw.integers(0, 1 << 63, n).astype(np.uint64)) for n in (5, 60, 900)]
    sets += [np.concatenate([s[: int(len(s) * 0.9)], sets[1][:3]]) for s in sets]
    hashed = pa.array([(s >> np.uint64(20)).astype(np.uint16).tobytes() for s in sets], pa.binary())
    size = np.array([len(s) for s in sets])
    bits, spare = minhash_join._bits(hashed, size)
    i, k = np.triu_indices(len(sets), 1)
    passed = minhash_join._may_be_similar(bits, spare, size, i, k)
    for a, b, ok in zip(i, k, passed):
        common = len(np.intersect1d(sets[a], sets[b]))
        assert ok or 100 * common < 75 * (size[a] + size[b] - common)


# -- range join ----------------------------------------------------------------------------------


def vectors():
    draw = np.random.default_rng(2)
    rows = []
    for label in (0, 1, 2):
        centres = draw.normal(size=(6, 8))
        for i in range(90):
            x = centres[draw.integers(6)] + draw.normal(size=8) * draw.choice([0.05, 0.3, 2.0])
            rows.append((x.tolist(), label))
    rows += [(rows[0][0], 0)] * 4 + [([2 * v for v in rows[1][0]], 0)]
    rows += [(None, 1), ([], 1), ([0.0] * 8, 1), ([float("nan")] + [1.0] * 7, 1), ([float("inf")] * 8, 1)]
    rows += [([None] + [1.0] * 7, 1), (rows[5][0], None), ([1.0, 0.0], 1), ([1.0, 0.01], 1), ([1e200] * 8, 2), ([1e-200] * 8, 2)]
    return [(3 * i, x, label) for i, (x, label) in enumerate(rows)]


@pytest.mark.parametrize("block, per_pivot", [(1024, 4096), (16, 20)])
def test_range_join(spark, monkeypatch, block, per_pivot):
    monkeypatch.setattr(metric_join, "BLOCK", block)
    monkeypatch.setattr(metric_join, "ROWS_PER_PIVOT", per_pivot)
    rows = vectors()
    usable = {
        i: (label, np.array(x, float) / np.abs(np.array(x, float)).max())
        for i, x, label in rows
        if label is not None and x and None not in x and np.isfinite(x).all() and any(x)
    }
    links = [
        (a, b)
        for a, (la, x) in usable.items()
        for b, (lb, y) in usable.items()
        if a < b and la == lb and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93
    ]
    kind = "vec_id bigint, embedding array<double>, label int"
    got = {r.vec_id: r for r in metric_join.range_join(spark.createDataFrame(rows, kind)).collect()}
    assert {i: r.component_id for i, r in got.items()} == least_reachable([r[0] for r in rows], links)
    assert {i: r.n_links for i, r in got.items()} == {i: sum(i in link for link in links) for i in got}
    assert sum(r.n_links for r in got.values()) > 100


def test_range_join_of_odd_tables(spark):
    kind = "vec_id bigint, embedding array<float>, label int, key int, unit string"
    assert metric_join.range_join(spark.createDataFrame([], kind)).count() == 0
    one = [(None, [1.0, 0.0], 1, 1, ""), (4, [1.0, 0.0], 1, 1, ""), (4, [1.0, 0.0], 1, 1, "")]
    got = sorted((tuple(r) for r in metric_join.range_join(spark.createDataFrame(one, kind)).collect()), key=repr)
    assert got == sorted([(None, 0, None, True), (4, 1, 4, True), (4, 1, 4, True)], key=repr)


def test_range_join_copies_no_vector(spark, monkeypatch):
    """Each vector is in one block, whatever the cells and blocks; blocks are compared as the files have them, without a shuffle."""
    for name, value in (("BLOCK", 16), ("ROWS_PER_PIVOT", 20), ("FILE", 2), ("GROUP", 4), ("ROUND", 2)):
        monkeypatch.setattr(metric_join, name, value)
    draw = np.random.default_rng(8)
    x = draw.normal(size=(300, 6)).astype(np.float32)
    x[150:] = x[:150] + draw.normal(size=(150, 6)) * draw.choice([0.0, 0.05, 0.3], size=(150, 1))
    label = ["a" if i % 3 else "b" for i in range(150)] * 2
    made, joined = [], metric_join._joined
    monkeypatch.setattr(metric_join, "_joined", lambda pairs, *rest: made.append(pairs) or joined(pairs, *rest))
    found = metric_join._found
    monkeypatch.setattr(metric_join, "_found", lambda blocks, *rest: made.insert(0, blocks) or found(blocks, *rest))
    table = spark.createDataFrame([(f"v{i:03}", x[i].tolist(), label[i]) for i in range(300)], "vec_id string, embedding array<float>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in metric_join.range_join(table).collect()}

    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    fits = (unit @ unit.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None, :]) & ~np.eye(300, dtype=bool)
    least = least_reachable(range(300), [(int(a), int(b)) for a, b in np.argwhere(fits)])
    assert got == {f"v{i:03}": (int(fits[i].sum()), f"v{least[i]:03}") for i in range(300)}

    blocks, plans = made[0], [p._jdf.queryExecution().executedPlan().toString() for p in made[1:]]
    assert blocks.count() > 12 and blocks.selectExpr("sum(size(doc))").first()[0] == len(np.unique(x, axis=0))
    assert len(plans) > 2 and all("CartesianProduct" in p and "Exchange" not in p for p in plans)


# -- repeats -------------------------------------------------------------------------------------


def test_range_join_beside_columns_of_its_names(spark):
    kind = "vec_id bigint, embedding array<double>, label string, n_links string, component_id string, kept int, key int, unit int"
    rows = [(1, [1.0, 0.0], "a", "x", "y", 1, 2, 3), (2, [1.0, 0.01], "a", "x", "y", 1, 2, 3), (3, [0.0, 1.0], "a", "x", "y", 1, 2, 3)]
    made = metric_join.range_join(spark.createDataFrame(rows, kind), 0.93)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in made.collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def repeats_by_force(rows, length=100):
    seen, out = {}, {}
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = True
            seen.setdefault(raw[p : p + length], (doc, p))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[doc] = (int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeat_rows():
    draw = random.Random(8)
    passages = ["".join(draw.choice("abc d é") for _ in range(n)) for n in (90, 99, 100, 101, 150, 400, 700)]
    rows = []
    for _ in range(60):
        parts = []
        for _ in range(draw.randrange(6)):
            passage = draw.choice(passages)
            cut = draw.randrange(len(passage) // 3)
            parts.append(draw.choice([passage, passage[cut:], passage[: len(passage) - cut]]))
            parts.append("".join(draw.choice("xyz ß") for _ in range(draw.randrange(60))))
        rows.append("".join(parts))
    rows += ["a" * 350, "a" * 99, "ab" * 200, "a\0" * 80, None, "", rows[0], rows[0], "line of text here\n" * 300, "日本語" * 60]
    return [(11 * i, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize("common", [10, 2, 10**6])
@pytest.mark.parametrize("held, crowded", [(2048, 100_000), (5, 100_000), (2048, 6)])
def test_repeats(spark, monkeypatch, held, crowded, common):
    monkeypatch.setattr(repeats, "SORTED_FRAGMENTS", held)
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    monkeypatch.setattr(repeats, "COMMON_DOCS", common)
    rows = repeat_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = {
        r.doc_id: (r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
        for r in repeats.without_repeats(docs).collect()
    }
    assert got == repeats_by_force(rows)


def test_a_common_passage_is_dealt_over_tasks(spark):
    """600 different surroundings of one passage: its rows do not meet in one task."""
    draw = random.Random(3)
    passage = "".join(draw.choice("licence line ") for _ in range(130))
    rows = [(i, "".join(draw.choice("abcdefgh ") for _ in range(150)) + passage + "".join(draw.choice("ijklmnop ") for _ in range(150))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    common = repeats._common_anchors(docs)
    assert 0 < len(common) < 60
    anchors_ = repeats._anchor_rows(docs, common)
    most = anchors_.groupBy("gram").count().agg(F.max("count")).first()[0]
    parts = anchors_.groupBy("gram", F.when(F.col("common"), F.col("fragment"))).count().agg(F.max("count")).first()[0]
    assert most == 600 and parts < 60
    assert repeats.without_repeats(docs).agg(F.min(F.when(F.col("doc_id") > 0, F.col("n_removed")))).first()[0] >= 130
    assert len(repeats._common_anchors(docs.limit(0))) == 0


def test_repeats_of_odd_tables(spark):
    kind = "doc_id bigint, text string, kept int, n_spans int, marks int"
    assert repeats.without_repeats(spark.createDataFrame([], kind)).count() == 0
    text = "".join(chr(97 + i * i % 23) + chr(65 + i * 7 % 19) for i in range(200))
    rows = [(None, text, 1, 1, 1), (5, text, 1, 1, 1), (5, text, 1, 1, 1), (6, "é" + text[:150], 1, 1, 1)]
    made = repeats.without_repeats(spark.createDataFrame(rows, kind), as_text=True)
    assert made.columns == ["doc_id", "text", "kept", "n_spans", "marks", "_kept", "n_removed", "_n_spans"]
    got = sorted((r.doc_id or 0, r.n_removed, r._kept) for r in made.collect())
    assert got == [(0, 0, text), (5, 0, text), (5, 0, text), (6, 150, "é")]


def test_sorted_suffixes():
    draw = np.random.default_rng(4)
    texts = [draw.integers(1, 4, n) for n in (0, 1, 7, 30, 30, 12)]
    texts.append(texts[3].copy())
    row_of, shared = repeats.sorted_suffixes(texts)
    every = sorted((tuple(t[len(t) - n :]), k, n) for k, t in enumerate(texts) for n in range(len(t) + 1))
    for row, (suffix, k, n) in enumerate(every):
        assert row_of[k, n] == row
        if row:
            before = every[row - 1][0]
            common = next((i for i, (a, b) in enumerate(zip(before, suffix)) if a != b), min(len(before), len(suffix)))
            assert shared[row] == common
