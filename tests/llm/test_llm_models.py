"""Quality, language and reputation models, mixing, and text operators."""

import hashlib
import random
import tracemalloc
from collections import Counter

import duckdb
import glob
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from clicklake.llm import byte_bpe, edit_fingerprints, language, main_text, mixing, quality_gam, queries, reputation
from check_sql import comparable
from conftest import SMALL

ODD = [None, "", " ", "\n", "é", "a" * 200_000, "word " * 30_000, "123 !!!", "a", "a"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_against_sql(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    kinds, rows = comparable(queries.QUERIES[name](spark, SMALL).toArrow())
    want_kinds, want = comparable(duck.execute(queries.SQL[name]).to_arrow_table())
    assert kinds == want_kinds
    assert rows == want


# -- quality -------------------------------------------------------------------------------------


def test_pairs_learn_what_single_features_cannot():
    draw = np.random.default_rng(0)
    x = draw.uniform(size=(4000, len(quality_gam.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = quality_gam.fit_gam(x[:3000], y[:3000])
    assert (2, 5) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_quality_scores_by_a_plain_loop():
    """Scores as the sum of table entries, each bin found by counting the edges up to the value."""
    draw = np.random.default_rng(1)
    x = np.round(draw.uniform(size=(600, len(quality_gam.FEATURES))), 2)
    model = quality_gam.fit_gam(x, ((x[:, 1] > 0.4) ^ (x[:, 3] > 0.6)).astype(float))
    assert model.pairs
    for row, score in zip(x[:80], model.score(x[:80])):
        total = model.base
        for value, edges, table in zip(row, model.edges, model.tables):
            total += table[sum(edge <= value for edge in edges)]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[sum(e <= row[a] for e in model.pair_edges[a])][sum(e <= row[b] for e in model.pair_edges[b])]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12


def test_quality_on_held_out_rows(spark):
    base = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{base}/labels.parquet")
    rows = queries.op10_quality(spark, base).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_quality_of_odd_texts(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, None), (None, 1)], "doc_id bigint, quality int")
    docs = spark.createDataFrame([(i, ODD[i % len(ODD)], "kept") for i in range(40)], "doc_id bigint, text string, score string")
    model = quality_gam.train_quality(docs, labels)
    made = quality_gam.score_quality(docs, model)
    assert made.columns == ["doc_id", "text", "score", "_score"]
    rows = made.collect()
    assert len(rows) == 40 and all(0 <= r._score <= 1 and r.score == "kept" for r in rows)
    assert len({r._score for r in rows if r.text == "a"}) == 1
    assert quality_gam.score_quality(docs.limit(0), model).count() == 0
    nothing = quality_gam.train_quality(docs, labels.limit(0))
    assert quality_gam.score_quality(docs, nothing).filter("_score <> 0.5").count() == 0


# -- language ------------------------------------------------------------------------------------


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = queries.op3_language(spark, SMALL).join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


def test_language_of_odd_texts(spark):
    model = language.fit_language([(np.array([1, 2]), np.array([3, 1])), (np.array([5]), np.array([2]))], ["de", "fr"])
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string").withColumn("score", F.lit("x"))
    got = {r.doc_id: r for r in language.predict_language(docs, model).collect()}
    for i, text in enumerate(ODD):
        letter = text is not None and any(c.isalpha() for c in text)
        assert (got[i].lang_pred in ("de", "fr")) if letter else (got[i].lang_pred, got[i]._score, got[i].accepted) == ("und", 0, False)
    assert language.predict_language(docs.limit(0), model).count() == 0
    assert language.train_language(docs.limit(0).withColumn("lang", F.lit("de"))) is None
    assert {r.lang_pred for r in language.predict_language(docs, None).collect()} == {"und"}


def test_confidence_is_calibrated():
    model = language.LanguageModel(["a", "b"], np.zeros((language.BUCKETS + 1, 2)), np.zeros(2))
    draw = np.random.default_rng(1)
    logits = draw.normal(size=(3000, 2)) * 5
    y = np.where(draw.uniform(size=3000) < 1 / (1 + np.exp(-(logits[:, 1] - logits[:, 0]) / 3)), 1, 0)
    language._calibrate(model, logits, y)
    assert 2 < model.temperature < 4.5
    p = language._softmax(logits / model.temperature)
    sure = p.max(axis=1) >= model.accept_from
    assert 0.1 < sure.mean() < 0.9 and (p.argmax(axis=1) != y)[sure].mean() <= language.ERROR_RATE


# -- reputation ----------------------------------------------------------------------------------


def test_rules_and_parts(spark):
    cases = {
        "http://www.Example.com/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://b.example.com/en/x": ("b.example.com", "/en/x", "example.com/en/", "block"),
        "x://notexample.com/en/x": ("notexample.com", "/en/x", "com/", "allow"),
        "https://é.net/fr/": ("é.net", "/fr/", "net/fr/", "block"),
        "https://a.net": ("a.net", "", None, "allow"),
        "https://a.net?q=/fr/": ("a.net", "", None, "allow"),
        "no url": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id bigint, url string").withColumn("host", F.lit(1))
    outcomes = spark.createDataFrame([], "page_id bigint, good int")
    judged = reputation.judge(pages, outcomes, queries.RULES)
    assert judged.columns == ["page_id", "url", "host", "_host", "path", "rule", "verdict"]
    assert {r.url: (r._host, r.path, r.rule, r.verdict) for r in judged.collect()} == cases
    assert reputation.judge(pages.limit(0), outcomes, queries.RULES).count() == 0


def test_suffixes_of_a_file(spark, folder):
    path = f"{folder}/suffixes.txt"
    os.makedirs(folder, exist_ok=True)
    with open(path, "w") as file:
        file.write("// remark\n\ncom\nuk\nCo.uk  more\ngithub.io\n*.ck\n!www.ck\n")
    hosts = {
        "a.b.com": ("b.com", "com"),
        "com": ("com", "com"),
        "x.y.co.uk": ("y.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk"),
        "me.github.io": ("me.github.io", "github.io"),
        "a.b.c.ck": ("b.c.ck", "c.ck"),
        "www.ck": ("www.ck", "ck"),
        "z.www.ck": ("www.ck", "ck"),
        "ck": ("ck", "ck"),
        "one.two.zz": ("two.zz", "zz"),
        "": ("", ""),
    }
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = reputation.placed_hosts(rows, reputation.read_suffixes(spark, path)).collect()
    assert {r.host: (r.domain, r.suffix) for r in found} == hosts and len(found) == len(hosts)
    nothing = spark.createDataFrame([], "suffix string")
    assert {r.host: r.suffix for r in reputation.placed_hosts(rows, nothing).collect()}["x.y.co.uk"] == "uk"
    pages = spark.createDataFrame([(k, h) for k, h in enumerate(hosts)], "page_id bigint, host string")
    outcomes = spark.createDataFrame([(k, k % 2) for k in range(11)], "page_id bigint, good int")
    assert reputation.host_reputation(pages, outcomes, reputation.read_suffixes(spark, path)).count() == len(hosts)


def test_training_is_bounded_and_repeats(spark):
    """Copies of an id count once for the language, and reruns learn from the same rows."""
    texts = ["the cat and the dog", "der Hund und die Katze"]
    rows = [(i % 30, texts[i % 2] + " " + "abcdefgh"[i % 8], ("en", "de")[i % 2]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    models = [language.train_language(docs.repartition(n)) for n in (1, 7)]
    assert np.array_equal(models[0].table, models[1].table)
    few = language.train_language(docs, max_counts=1)
    assert len(few.languages) == 1  # the first document alone
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, quality int")
    scores = []
    for n in (1, 7):
        model = quality_gam.train_quality(docs.repartition(n), labels, max_rows=20)
        scores.append(model.score(quality_gam.text_features(pa.array(texts))).tolist())
    assert scores[0] == scores[1]


def test_language_scores_by_a_plain_loop():
    """Scores of a table, bucket by bucket of each run of bytes."""
    draw = np.random.default_rng(5)
    table = draw.normal(size=(language.BUCKETS + 1, 3))
    table[-1] = 0
    model = language.LanguageModel(["a", "b", "c"], table, draw.normal(size=3), temperature=0.7)
    texts = ["Hello, World 42", "é à", "ab", "x", "", "the the the"]
    got = model.probabilities(pa.array(texts))
    for text, row in zip(texts, got):
        codes = [b | 32 if 65 <= b <= 90 or 97 <= b <= 122 else b if b >= 128 else 32 for b in text.encode()]
        total, n = np.zeros(3), 0
        for length in (2, 3, 4):
            for at in range(len(codes) - length + 1):
                value = length
                for code in codes[at : at + length]:
                    value = (value * 0x9E3779B97F4A7C15 % 2**64) ^ code
                total += table[value * 0xD6E8FEB86659FD93 % 2**64 >> 64 - language.BITS]
                n += 1
        logits = (total / max(1, n) + model.bias) / 0.7
        assert np.allclose(row, np.exp(logits) / np.exp(logits).sum())


def test_shrinkage(spark):
    """A host with many bad pages is blocked, one with two is not, and a new host takes its domain's mean."""
    rows, good = [], []
    hosts = [("bad.spam.org", 300, 0.05), ("few.rare.org", 2, 0.0), ("new.spam.org", 0, 0), *((f"h{i}.fine.org", 40, 0.9) for i in range(12))]
    for host, n, share in hosts:
        for k in range(max(1, n)):
            rows.append((len(rows), host))
            if n:
                good.append((len(rows) - 1, int(k < share * n)))
    pages = spark.createDataFrame(rows, "page_id bigint, host string")
    known = {r.host: r for r in reputation.host_reputation(pages, spark.createDataFrame(good, "page_id bigint, good int")).collect()}
    assert known["bad.spam.org"].high < 0.5 < known["few.rare.org"].high
    assert known["new.spam.org"].mean < known["h1.fine.org"].mean
    assert known["bad.spam.org"].high - known["bad.spam.org"].low < known["few.rare.org"].high - known["few.rare.org"].low


# -- mixing --------------------------------------------------------------------------------------


def filled_by_loop(sizes, weights, epochs=3):
    caps, total = [epochs * s for s in sizes], sum(sizes)
    capped, target = set(), [0.0] * len(sizes)
    while True:
        rest = total - sum(caps[i] for i in capped)
        open_ = [i for i in range(len(sizes)) if i not in capped]
        for i in range(len(sizes)):
            target[i] = caps[i] if i in capped else rest * weights[i] / sum(weights[k] for k in open_)
        over = {i for i in open_ if target[i] > caps[i]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("seed", range(6))
def test_water_filling(spark, seed):
    draw = random.Random(seed)
    sizes = [draw.choice([0, 1, 5, 100, 10_000]) for _ in range(draw.randrange(1, 12))]
    weights = [draw.randrange(1, 4) for _ in sizes]
    df = spark.createDataFrame(list(zip(range(len(sizes)), sizes, weights)), "i int, size bigint, weight int")
    got = [r.target for r in mixing.water_filled(df, "weight", "size").orderBy("i").collect()]
    assert got == pytest.approx(filled_by_loop(sizes, weights) if sum(sizes) else [0.0] * len(sizes))


@pytest.mark.parametrize("slice_rows", [200_000, 50])
def test_mix(spark, slice_rows):
    draw = random.Random(1)
    rows = [(i, " ".join(["w"] * draw.randrange(1, 80)), draw.choice(["a", "b", "c", "é", None])) for i in range(1500)]
    rows += [(2000, None, "a"), (2001, "", "b"), (2002, "x", "empty?"), (2003, "", "nothing")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("?"))
    first = mixing.mix(docs, slice_rows=slice_rows).collect()
    again = mixing.mix(docs.repartition(9), slice_rows=slice_rows).collect()
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)
    assert len(first) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in first)
    taken, target = Counter(), {}
    for r in first:
        taken[r.source] += r.taken
        target[r.source] = r.target
    sources = sorted((s for s in target if s is not None), key=lambda s: s.encode()) + [None]
    sizes = [sum(r.size for r in first if r.source == s) for s in sources]
    assert [target[s] for s in sources] == pytest.approx(filled_by_loop(sizes, [1 + i % 3 for i in range(len(sources))]))
    assert all(abs(taken[s] - target[s]) <= 160 for s in sources)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_is_the_same_for_any_slices(spark):
    draw = random.Random(3)
    rows = [(i, "w " * draw.randrange(0, 300), draw.choice(["a", "b", None])) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = [sorted(map(tuple, mixing.mix(docs, slice_rows=n).collect()), key=repr) for n in (200_000, 40, 7)]
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("slice_rows", [200_000, 300])
def test_mix_makes_up_for_a_giant(spark, slice_rows):
    """What a giant takes too little or too much is made up by any number of small texts."""
    draw = random.Random(5)
    rows = [(0, "w " * 100_000, "a"), *((i, "w " * 50, "a") for i in range(1, 2001))]
    rows += [(5000 + i, "w " * draw.randrange(1, 120), "b") for i in range(2000)] + [(9000, "w " * 60_000, "b")]
    rows += [(10_000 + i, "w " * 100, None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for weights in ((1, 1, 1), (1, 2, 3), (3, 2, 1), (5, 4, 1)):
        found = mixing.mix(docs, weights=weights, slice_rows=slice_rows).collect()
        taken, target, size = Counter(), {}, {}
        for r in found:
            taken[r.source] += r.taken
            target[r.source], size[r.source] = r.target, r.source_size
            assert r.times in (r.target // r.source_size, r.target // r.source_size + 1)
        for source in target:
            # The small texts can make up for a giant's rest if they have as many words.
            assert abs(taken[source] - target[source]) <= 100, (weights, source)


def test_mix_with_giants_equals_its_sql(spark, folder):
    """The registered SQL gives the rows of the query where a few texts hold most of the words, too."""
    draw = random.Random(11)
    rows = [(0, "w " * 100_000, "a"), *((i, "w " * 50, "a") for i in range(1, 1501))]
    rows += [(5000 + i, "w " * draw.randrange(0, 120), "b") for i in range(1500)] + [(9000 + i, "w " * 60_000, "b") for i in range(3)]
    rows += [(10_000 + i, "w " * draw.choice([1, 7, 300]), None) for i in range(900)] + [(20_000, None, "c"), (20_001, "w", "d"), (20_001, "w", "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    docs.write.parquet(f"{folder}/documents.parquet")
    got = comparable(queries.op6_mixing(spark, folder).toArrow())
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert got == comparable(duck.execute(queries.SQL["op6_mixing"]).to_arrow_table())
    taken = {}
    for r in queries.op6_mixing(spark, folder).join(docs.select("doc_id", "source").distinct(), "doc_id").collect():
        at = taken.setdefault(r.source, [0, r.target])
        at[0] += r.taken
    # Of b's giants two are taken, and all its smaller texts do not make up for the part of the third.
    assert abs(taken["a"][0] - taken["a"][1]) <= 50 and abs(taken["b"][0] - taken["b"][1]) <= 0.03 * taken["b"][1]


# -- encoding ------------------------------------------------------------------------------------

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODING = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = [
    *ODD[:6], "don't  I'll 'x\x1c\x1cy", "\x85\x85z   ", "日本語 𝔘𝔫𝔦 ١٢٣ ¼½", "\U0001f600 !! <|endoftext|>", " \n\n a\r\n", "thereofing" * 3
]


def test_encoding_equals_the_library(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, ids string")
    for common in (200_000, 5):
        monkeypatch.setattr(byte_bpe, "COMMON_WORDS", common)
        made = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
        assert made.columns == ["doc_id", "ids", "_ids", "packed"]
        rows = made.withColumn("back", byte_bpe.decoded(F.col("_ids"), RANKS)).collect()
        assert len(rows) == len(TEXTS)
        for r in rows:
            want = ENCODING.encode_ordinary(TEXTS[r.doc_id] or "")
            assert list(r._ids) == want
            assert bytes(r.packed) == np.array(want, "<u4").tobytes()
            assert bytes(r.back) == (TEXTS[r.doc_id] or "").encode()
    assert byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("longest", [4096, 6])
def test_words_outside_the_list_go_through_the_fold(spark, plan_of, monkeypatch, longest):
    monkeypatch.setattr(byte_bpe, "COMMON_WORDS", 1)
    monkeypatch.setattr(byte_bpe, "LONGEST_FOLDED", longest)
    texts = ["oscoadodo ofanstingon", "underäöä " * 3, "ab" * 2500, "\n".join(["wasthblethre", "x" * 40, "日本語の文"]), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    made = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert "aggregate(" in plan_of(made)
    assert {r.doc_id: list(r.ids) for r in made.collect()} == {i: ENCODING.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_native_fold_and_task_fold_agree(spark):
    draw = random.Random(2)
    words = ["".join(draw.choice("theaionrs éß") for _ in range(draw.randrange(1, 20))).encode() for _ in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "word binary")
    rows = df.select("word", byte_bpe.encoded_word(F.col("word"), byte_bpe._rank_map(RANKS)).alias("ids")).collect()
    assert all(list(r.ids) == byte_bpe.folded_word(bytes(r.word), RANKS) for r in rows)


def test_fold_stands_once_in_the_plan(spark, plan_of):
    docs = spark.createDataFrame([(1, "oscoadodo ofanstingon")], "doc_id bigint, text string")
    plan = plan_of(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN))
    assert plan.count("array_position(") == plan.count("crc32(") > 0


def test_rank_tables_are_made_in_little_memory(spark):
    df = spark.range(1)
    tracemalloc.start()
    byte_bpe._with_ranks(df, RANKS, "ranks")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20


def test_unranked_and_odd_bytes_in_the_fold(spark):
    ranks = {bytes([i]): i for i in range(256)} | {b"\xff\x00": 256, b"aba": 257, b"ab": 258, b"ba": 259, b"\x00\x00": 260}
    words = [b"", b"\x00", b"\x00\x00\x00", b"\xff\x00\xff", b"ababa", b"abaaba", b"baab" * 40]
    df = spark.createDataFrame([(w,) for w in words], "word binary")
    rows = df.select("word", byte_bpe.encoded_word(F.col("word"), byte_bpe._rank_map(ranks)).alias("ids")).collect()
    assert all(list(r.ids) == byte_bpe.folded_word(bytes(r.word), ranks) for r in rows)
    codes = spark.createDataFrame([(w,) for w in words[1:]], "word binary").select(byte_bpe._codes(F.col("word"))).collect()
    assert [list(r[0]) for r in codes] == byte_bpe._byte_codes(words[1:]).to_pylist()


def test_decoding_of_unknown_ids(spark):
    df = spark.createDataFrame([([1, 2],), ([1, None],), ([60_000],), ([],), (None,)], "ids array<int>")
    got = [r[0] for r in df.select(byte_bpe.decoded(F.col("ids"), RANKS)).collect()]
    assert bytes(got[0]) == ENCODING.decode_bytes([1, 2]) and got[1:3] == [None, None] and bytes(got[3]) == b"" and got[4] is None


# -- fingerprints --------------------------------------------------------------------------------


def test_compared_with_next(spark):
    texts = [*ODD, "same text here", "same text here", "日本語" * 40]
    rows = [(5 * i - 3, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = {r.doc_id: r for r in edit_fingerprints.compared_with_next(docs).collect()}
    order = sorted(((d, t or "") for d, t in rows), reverse=True)
    for k, (doc, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        prints = [edit_fingerprints.fingerprint(t) for t in (text, edited, after)]
        r = got[doc]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(text), prints[0], prints[1])
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == edit_fingerprints.likeness(*prints[:2])
        assert r.near_next == edit_fingerprints.likeness(prints[0], prints[2])
    assert edit_fingerprints.compared_with_next(docs.limit(0)).count() == 0
    one = edit_fingerprints.compared_with_next(docs.filter("doc_id = 2")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "x"), (None, "y")], "doc_id bigint, text string")
    assert edit_fingerprints.compared_with_next(twice).count() == 4


def test_likeness_follows_edits():
    draw = random.Random(4)
    text = "".join(draw.choice("abcdefgh ") for _ in range(3000))
    likes = []
    for share in (0, 0.01, 0.05, 0.2):
        chars = list(text)
        for _ in range(int(share * len(text))):
            p = draw.randrange(len(chars))
            chars[p : p + draw.choice([0, 1])] = draw.choice(["x", "", "yz"])
        likes.append(edit_fingerprints.likeness(*map(edit_fingerprints.fingerprint, (text, "".join(chars)))))
    assert likes[0] == 1.0 and likes == sorted(likes, reverse=True) and likes[1] > 0.6 and likes[3] < 0.5


@pytest.mark.parametrize("block", [512, 4])
def test_near_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(edit_fingerprints, "BLOCK", block)
    draw = random.Random(6)
    base = "".join(draw.choice("abcdefgh ") for _ in range(1500))
    near = [base[:p] + "#" + base[p + 1 :] for p in draw.sample(range(1500), 12)]
    rows = list(enumerate([base, base, *near, "other text " * 90, "", None]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = edit_fingerprints.near_pairs(edit_fingerprints.fingerprints(docs), 0.6).collect()
    from test_llm_dedup import least_reachable

    owners = least_reachable([d for d, _ in rows], [(r.a, r.b) for r in found])
    assert [d for d in owners if owners[d] == 0] == list(range(14))
    assert all(r.likeness >= 0.6 for r in found)
    assert edit_fingerprints.near_pairs(edit_fingerprints.fingerprints(docs.limit(0)), 0.6).count() == 0


@pytest.mark.parametrize("threshold", [0.6, 0.75, 0.9])
def test_near_pairs_find_what_brute_force_finds(spark, threshold):
    """Edited copies of short and long texts, and of texts whose walks just fill a power of two."""
    draw = random.Random(9)
    texts = []
    for size in (60, 500, 510, 1000, 1020, 2040):
        for _ in range(8):
            chars = [draw.choice("abcdefgh ") for _ in range(size)]
            texts.append("".join(chars))
            for edits in (1, 3, size // 40):
                copy = list(chars)
                for _ in range(edits):
                    p = draw.randrange(len(copy))
                    copy[p : p + draw.choice([0, 1])] = draw.choice(["x", "", "yz"])
                texts.append("".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    prints = [edit_fingerprints.fingerprint(t) for t in texts]
    near = [(a, b) for a in range(len(texts)) for b in range(a) if edit_fingerprints.likeness(prints[a], prints[b]) >= threshold]
    found = edit_fingerprints.near_pairs(edit_fingerprints.fingerprints(docs), threshold).collect()
    from test_llm_dedup import least_reachable

    assert {(max(r.a, r.b), min(r.a, r.b)) for r in found} <= set(near)
    owners = least_reachable(range(len(texts)), [(r.a, r.b) for r in found])
    assert len(near) > 20 and sum(owners[a] == owners[b] for a, b in near) >= 0.99 * len(near)


def test_walks_character_by_character():
    """The samples of a fingerprint, from a walk that writes its output symbol by symbol."""
    draw = random.Random(2)
    stays = edit_fingerprints.seeded(21, edit_fingerprints.KINDS * edit_fingerprints.PERIOD)
    for size in (1, 40, 700, 5000):
        text = "".join(draw.choice("abc dé日") for _ in range(size))
        output, at = [], 0
        while at < size:
            kind = (ord(text[at]) + 37 * (ord(text[at]) >> 6)) % edit_fingerprints.KINDS
            place = len(output) % edit_fingerprints.PERIOD
            output.append(edit_fingerprints.LETTERS[kind])
            goes = int(stays[kind * edit_fingerprints.PERIOD + place]) >> 40 & 1
            at += goes or place == edit_fingerprints.PERIOD - 1
        power, symbols = edit_fingerprints.fingerprint(text).split(":")
        for half in (0, 1):
            places = [int(p * (1 << int(power) + half)) for p in edit_fingerprints.PLACES]
            want = "".join(output[p] if p < len(output) else edit_fingerprints.BEYOND for p in places)
            assert symbols[half * edit_fingerprints.SAMPLES :][: edit_fingerprints.SAMPLES] == want


def test_fingerprints_beside_a_column_of_that_name(spark):
    rows = [(1, "a b", 7, 1.5), (2, None, 8, 2.5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint int, near_next double")
    made = edit_fingerprints.fingerprints(docs)
    assert made.columns == ["doc_id", "text", "fingerprint", "near_next", "_fingerprint"]
    assert sorted(r.fingerprint for r in made.collect()) == [7, 8]
    assert edit_fingerprints.compared_with_next(docs).filter("near_next <= 1").count() == 2


# -- main text -----------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="with-sidebar">
<header><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">A, b, c</a></li></ul></nav>
<div id="cookie-notice">We use cookies, and more, and more.</div><!-- <p>no</p> -->
%s
<aside><p>Side, bar, text, with, commas.</p></aside><section id="comments"><p>First, comment, here.</p></section>
<form><label>Your, name</label><input></form><footer>&copy; foot</footer><script>if (a < b) { "</p>" }</script></body></html>"""


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>Title &amp; x</h1><p><b>One,\n two<br>three <p>Four&#33; <a href=x>link</a> end</article>", "Title & x One, two three Four! link end"),
        ("<div class=content><h2>Head</h2><p>Some text, with commas.</p><p>More of it.</p></div>", "Head Some text, with commas. More of it."),
        ("<main><article><header><h1>T</h1></header><p>a, b</p><div class='ad'>buy</div><ul><li>x<li>y</ul></article></main>", "T a, b x y"),
        ("<div><p>plain<div>nested &lt;b&gt;</div>tail</div>", "plain nested <b> tail"),
    ],
)
def test_main_text(body, text):
    assert main_text.main_text(PAGE % body) == text


def test_main_text_keeps_what_stands_beside_the_longest_part():
    long = "".join(f"<p>Part {i}, a, b, c, d, {'word ' * 55}end.</p>" for i in range(20))
    short = "<div><p>Closing, short.</p></div><ul><li>one<li>two</ul><table><tr><td>cell</table><pre>code</pre><blockquote>said</blockquote>"
    links = "<ul><li><a href=/1>First link of many</a><li><a href=/2>Second link of many</a></ul>"
    for page in (f"<div><div>{long}</div>{short}{links}</div>", f"<div><div><div>{long}</div></div>{short}{links}</div>"):
        text = main_text.main_text(PAGE % page)
        assert text.startswith("Part 0, a") and text.endswith("end. Closing, short. one two cell code said")


@pytest.mark.parametrize(
    "start",
    ["div class='content with-sidebar'", "article class='post comments-open'", "div id=page class=has-navbar", "section class=related-work", "div class=social"],
)
def test_main_text_within_names_that_tell_little(start):
    paragraphs = "".join(f"<p>Part {i}, a, b, c <span class=share>Share</span> end.</p>" for i in range(9))
    formula = "<p>with <math><mi>x</mi><annotation>tex</annotation></math></p>"
    page = f"<{start}><div class=sidebar><p>Side, text.</p></div>{paragraphs}{formula}</{start.split()[0]}>"
    assert main_text.main_text(PAGE % page) == " ".join(f"Part {i}, a, b, c end." for i in range(9)) + " with x"


SECTION_NAMES = [
    "id=related-work", "id=social-impact", "id=share-prices", "id=cookie-recipe", "class=menu-history", "class=comment-on-results",
    "class=alert-systems", "class=reply-to-critics",
]


@pytest.mark.parametrize("name", SECTION_NAMES)
def test_main_text_keeps_sections_of_telling_names(name):
    sections = "".join(f"<section><h2>Part {i}</h2><p>Words, of part {i}.</p></section>" for i in range(4))
    sections += f"<section {name}><h2>Part 4</h2><p>Words, of part 4.</p></section>"
    text = "Title " + " ".join(f"Part {i} Words, of part {i}." for i in range(5))
    for start, end in (("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")):
        assert main_text.main_text(PAGE % f"{start}<h1>Title</h1>{sections}{end}") == text


@pytest.mark.parametrize(
    "name", ["class=comment-list", "id=comments-area", "class=ad-slot", "id=ad_12", "class='share-buttons'", "class=related-posts", "id=cookieNotice", "class=newsletter-box"]
)
def test_main_text_drops_parts_of_the_page_by_name(name):
    part = f"<div {name}><p>Read this, and that, and that, by all means.</p></div>"
    for page in (f"<article><p>Some text, here.</p>{part}<p>More, of it.</p></article>", f"<div><p>Some text, here.</p><p>More, of it.</p></div>{part}"):
        assert main_text.main_text(PAGE % page) == "Some text, here. More, of it."


def test_main_text_drops_links_under_a_telling_name():
    links = "<div class=related-reading><p><a href=/1>One, and more</a></p><p><a href=/2>Two, and more</a></p></div>"
    assert main_text.main_text(PAGE % f"<div><p>Some text, here.</p><p>More, of it.</p></div>{links}") == "Some text, here. More, of it."


def test_main_text_of_a_page_within_a_form():
    page = PAGE.replace('<body class="with-sidebar">', "<body><form id=aspnetForm><input type=hidden>").replace("</body>", "</form></body>")
    body = "<div><h1>Title</h1><p>Some text, with commas.</p><p>More, and more.</p></div>"
    assert main_text.main_text(page % body) == "Title Some text, with commas. More, and more."
    asked = "<article><p>Text, and text.</p><form><p>Sign up, now, and get it.</p><input></form></article>"
    assert main_text.main_text(PAGE % asked) == "Text, and text."


def test_main_text_beside_an_article():
    one, two = "<article><h2>One</h2><p>Some, longer, text, of one.</p></article>", "<article><h2>Two</h2><p>Text of two.</p></article>"
    teasers = "<ul><li><a href=/1>First link of many</a><li><a href=/2>Second link of many</a></ul>"
    assert main_text.main_text(PAGE % f"<p>Before.</p>{one}{two}<p>After.</p>{teasers}") == "Before. One Some, longer, text, of one. Two Text of two. After."
    within = f"<div><p>Outside.</p><main><p>Before.</p>{one}</main></div>"
    assert main_text.main_text(PAGE % within) == "Before. One Some, longer, text, of one."


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 100_000 + "deep, text", "<b>x</div>" * 100_000, "<p><button>" + "<div>" * 100_000, "<li>" * 100_000, "<b>" * 50_000 + "<p>x</p>y" * 50_000,
        "<a>" * 100_000 + "</i>" * 100_000, "<table>" * 50_000 + "<td>x" * 50_000,
    ],
)
def test_main_text_takes_time_in_proportion(source):
    import time

    start = time.process_time()
    main_text.main_text(source)
    assert time.process_time() - start < 10


def plain_choice(root):
    """Points, link densities and what is chosen, by recursion over a tree of (tag, children), text or ("a", text)."""
    nodes, above = [], {}

    def walk(node, parent):
        nodes.append(node)
        above[id(node)] = parent
        for child in node[1]:
            if isinstance(child, tuple) and child[0] != "a":
                walk(child, node)

    walk(root, None)

    def own_text(node):
        return [(c, False) if isinstance(c, str) else (c[1], True) for c in node[1] if isinstance(c, str) or c[0] == "a"]

    def size(node, links):
        inner = sum(size(c, links) for c in node[1] if isinstance(c, tuple) and c[0] != "a")
        return inner + sum(len(t) for t, link in own_text(node) if link or not links)

    points = {id(n): 0.0 for n in nodes}
    for node in nodes:
        if node[0] == "p" and own_text(node):
            text = "".join(t for t, _ in own_text(node))
            linked = sum(len(t) for t, link in own_text(node) if link)
            own = (1 + text.count(",") + min(3, len(text) // 100)) * (1 - linked / len(text))
            at = above[id(node)]
            for share in (1, 2, 6, 9, 12, 15):
                if at is not None:
                    points[id(at)] += own / share
                    at = above[id(at)]
    score = [points[id(n)] * (1 - size(n, True) / max(1, size(n, False))) for n in nodes]
    best = nodes[score.index(max(score))]
    path, at = [], best
    while at is not None:
        path.append(id(at))
        at = above[id(at)]

    def reads(node):
        chars, linked = size(node, False), size(node, True)
        return 4 * linked < chars if chars > 80 else not linked

    def texts(node, taken, linky=False):
        taken |= node is best
        for child in node[1]:
            if isinstance(child, str) or child[0] == "a":
                continue
            if taken or id(child) in path:
                yield from texts(child, taken)
            elif reads(child) and not (linky and size(child, False) <= 80):
                yield from texts(child, True)
            else:
                yield from texts(child, False, True)
        if taken and own_text(node):
            yield "".join(t for t, _ in own_text(node))

    return " ".join(texts(root, False))


def test_main_text_against_a_plain_recursion():
    draw = random.Random(9)

    def made(depth):
        if depth == 0 or draw.random() < 0.3:
            words = draw.choice([3, 10, 40])
            text = f"{draw.randrange(10**6)}" + "".join(draw.choice(["x,", "xyz", "x"]) for _ in range(words))
            return ("p", [text, ("a", "l" * draw.choice([5, 30, 90]))] if draw.random() < 0.4 else [text])
        return ("div", [made(depth - 1) for _ in range(draw.randrange(1, 4))])

    def written(node):
        if isinstance(node, str):
            return node
        return f"<{node[0]}>{node[1] if node[0] == 'a' else ''.join(map(written, node[1]))}</{node[0]}>"

    for _ in range(300):
        tree = ("body", [("div", [made(3) for _ in range(3)])])
        assert main_text.main_text(f"<html>{written(tree)}</html>") == plain_choice(tree)


def test_main_text_leaves_out_longer_comments():
    comments = "<article class=comment><p>Long, comment, by, a, reader.</p></article>" * 30
    page = "<div class=content><h1>Title</h1><p>Some text, with commas.</p><p>More, and more.</p></div><div id=comments>%s</div>" % comments
    assert main_text.main_text(PAGE % page) == "Title Some text, with commas. More, and more."


def test_main_text_of_odd_pages(spark):
    odd = [None, "", " ", "text, only", "<p>a<p>b", "<", "<a href='x>never", "<!-- open", "<div>" * 3000 + "deep, text", "<script>x"]
    odd.append("<article>" + "<p>word, and word</p>" * 20_000 + "</article>")
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(odd)], "page_id bigint, text string, html string")
    made = main_text.extract(pages)
    assert made.columns == ["page_id", "text", "_text", "n_chars"]
    got = {r.page_id: r for r in made.collect()}
    assert [got[i]._text for i in (0, 1, 2, 3, 4, 7, 8, 9)] == ["", "", "", "text, only", "a b", "", "deep, text", ""]
    assert got[10]._text == " ".join(["word, and word"] * 20_000)
    assert all(r.n_chars == len(r._text) for r in got.values())
    assert main_text.extract(pages.limit(0)).count() == 0


def test_pages_give_their_articles(spark):
    """In the given tables every article is whole: all text of the element, and nothing else."""
    import html
    import re

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r.text for r in queries.op2_main_text(spark, SMALL).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        bare = re.sub(r"</?(?:b|i|em|a|strong|span)\b[^>]*>", "", article)
        assert got[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", bare)).split())
