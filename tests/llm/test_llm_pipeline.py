"""The stages one after the other, and the package on its own."""

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from clicklake.llm import byte_bpe, mixing, queries
from clicklake.llm.common import written
from conftest import SMALL
from test_llm_dedup import near_by_force, repeats_by_force


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), name)
        frames[name] = docs
        kept[name] = docs.collect()
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(frames[name].columns == columns for name in list(frames)[:-1])

    good = {r.doc_id: r.text for r in kept["quality"]}
    owners = near_by_force(good.items())
    single = {r.doc_id: r.text for r in kept["near_duplicates"]}
    assert single == {d: good[d] for d in owners if owners[d] == d}

    cut = {r.doc_id: r for r in kept["repeats"]}
    removed = repeats_by_force(single.items())
    assert set(cut) == set(single)
    for doc, r in cut.items():
        assert r.n_chars == len(r.text)
        if removed[doc][0] == 0:
            assert r.text == single[doc]
        else:
            assert len(r.text.encode()) <= len(single[doc].encode()) - removed[doc][0]

    times = {r.doc_id: r.times for r in mixing.mix(frames["repeats"]).collect()}
    mixed = frames["mixing"].groupBy("doc_id").agg(F.count("*").alias("n"), F.first("text").alias("text")).collect()
    assert {r.doc_id: r.n for r in mixed} == {d: n for d, n in times.items() if n}
    assert all(r.text == cut[r.doc_id].text for r in mixed)

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(kept["encoding"]) == sum(times.values())
    for r in kept["encoding"]:
        assert list(r.ids) == library.encode_ordinary(cut[r.doc_id].text) and r.n_tokens == len(r.ids)


def test_stages_of_odd_tables(spark):
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 50, None, "s", 9)]
    for table in ([], rows):
        docs = spark.createDataFrame(table, kind)
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = written(stage(spark, docs, SMALL), name)
        assert docs.columns == ["doc_id", "lang", "source", "n_chars", "ids", "n_tokens"]


def test_ids_that_do_not_decode_are_an_error(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "")], "doc_id bigint, text string")
    assert [r.n_tokens > 0 for r in corpus_pipeline.encode_texts(spark, docs, SMALL).orderBy("doc_id").collect()] == [True, False, False]
    encode = byte_bpe.encode
    cut = F.slice("ids", 1, F.greatest(F.size("ids") - 1, F.lit(0)))
    monkeypatch.setattr(byte_bpe, "encode", lambda *args: encode(*args).withColumn("ids", cut))
    with pytest.raises(Exception, match="do not decode to the text of document 1"):
        corpus_pipeline.encode_texts(spark, docs, SMALL).collect()


def test_all_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert {*queries.QUERIES, "pipeline"} <= names
    assert set(__spark_entry__.oracle_sql()) <= names
