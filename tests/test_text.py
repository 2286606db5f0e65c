"""Text and scalar expressions on edge values."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clicklake.functions import scalars, text
from clicklake.schemas import REVIEW, record
from clicklake.streaming.transforms import line_details, parsed_messages, rejected_messages, valid_messages, word_counts, words
from conftest import rows_of
from pyspark.sql.types import LongType

LINES = ["a b ", "  a", "a  b", "   ", "", None, "one", "x\ty z"]
PARTS = [["a", "b"], ["", "", "a"], ["a", "", "b"], [], [""], None, ["one"], ["x\ty", "z"]]


def values(spark, items, kind="string"):
    return spark.createDataFrame([(i, item) for i, item in enumerate(items)], f"id int, value {kind}")


def mapped(spark, items, expression, kind="string"):
    df = values(spark, items, kind).select("id", expression(F.col("value")).alias("out"))
    return [row.out for row in sorted(df.collect())]


def test_split_spaces(spark):
    assert mapped(spark, LINES, text.split_spaces) == PARTS


def test_line_word_count(spark):
    assert mapped(spark, LINES, text.line_word_count) == [p if p is None else len(p) for p in PARTS]


def test_words_with_and_without_inner_empty(spark):
    df = values(spark, LINES).select("value")
    with_empty = [w for line, parts in zip(LINES, PARTS) if line for w in parts]
    assert sorted(r.word for r in words(df, keep_inner_empty=True).collect()) == sorted(with_empty)
    assert sorted(r.word for r in words(df).collect()) == sorted(w for w in with_empty if w)
    counted = {w: with_empty.count(w) for w in with_empty}
    assert dict(rows_of(word_counts(df, keep_inner_empty=True))) == counted


def test_words_keep_other_columns(spark):
    assert words(values(spark, LINES)).columns == ["id", "word"]


def test_line_details(spark):
    details = line_details(values(spark, LINES))
    assert details.columns == ["inputLine", "totalWordCount", "receivedTimestamp"]
    assert rows_of(details, "inputLine", "totalWordCount") == sorted(
        ((line, len(parts)) for line, parts in zip(LINES, PARTS) if line), key=repr
    )
    assert {row.receivedTimestamp > 1_600_000_000_000 for row in details.collect()} == {True}


def test_lengths_count_characters_or_units(spark):
    items = ["abc", "é", "😀!", "", None]
    assert mapped(spark, items, text.text_length) == [3, 1, 2, 0, None]
    assert mapped(spark, items, lambda c: text.text_length(c, utf16_units=True)) == [3, 1, 3, 0, None]


def test_upper_case_words(spark):
    assert mapped(spark, ["ABC", "Abc", "12!", None], text.is_upper_case) == [True, False, True, None]


def test_reverse_prefix_number(spark):
    assert mapped(spark, ["abc", "", None], text.reverse_text) == ["cba", "", None]
    assert mapped(spark, ["x", None], lambda c: text.prefixed("shop_", c)) == ["shop_x", None]
    assert mapped(spark, [5, None], text.number_text, "int") == ["5", None]


def test_epoch_ms(spark):
    df = values(spark, [1609448400000, 1, None], "bigint")
    out = df.select("id", scalars.epoch_ms_time(F.col("value")).cast("timestamp_ntz").cast("string").alias("t"))
    assert [r.t for r in sorted(out.collect())] == ["2020-12-31 21:00:00", "1970-01-01 00:00:00.001", None]


def test_day_in_a_zone(spark):
    df = values(spark, [1609448400000], "bigint").select(scalars.epoch_ms_time(F.col("value")).alias("t"))
    days = df.select(
        scalars.day_start(F.col("t")).cast("string").alias("utc"),
        scalars.day_start(F.col("t"), "Europe/Istanbul").cast("string").alias("local"),
    ).first()
    assert tuple(days) == ("2020-12-31 00:00:00", "2021-01-01 00:00:00")


def test_labels(spark):
    assert mapped(spark, [0, 1], scalars.decoded_label, "int") == ["negative", "positive"]
    for bad in (2, None):
        with pytest.raises(PySparkException, match="Unknown label"):
            mapped(spark, [bad], scalars.decoded_label, "int")


def test_flag_and_default(spark):
    assert mapped(spark, [1, 2, None], lambda c: scalars.flag_when(c == 1), "int") == [True, False, False]
    assert mapped(spark, [1, None], lambda c: scalars.value_or(c, 7), "int") == [1, 7]


def test_date_key(spark):
    assert mapped(spark, ["2021-01-09"], lambda c: scalars.date_key(c.cast("date"))) == ["20210109"]


def test_whole_number(spark):
    items = ["12", " -3 ", "x", "1.5", "99999999999999999999", "", None]
    assert mapped(spark, items, scalars.whole_number) == [12, -3, None, None, None, None, None]


def test_tokens_are_those_of_the_model_stage(spark):
    from pyspark.ml.feature import Tokenizer

    items = [*[line for line in LINES if line is not None], "A b\tC\n", "\n \t", "  É x\r\n\r\n", "a\x0b\fB"]
    want = Tokenizer(inputCol="value", outputCol="out").transform(values(spark, items))
    assert mapped(spark, items, text.split_tokens) == [row.out for row in sorted(want.collect())]


def test_plus_n_is_exact_and_keeps_nulls(spark):
    assert mapped(spark, [1, None, 7], scalars.plus_n(3), "int") == [4, None, 10]
    assert mapped(spark, [2**53 + 1, None], scalars.plus_n(1, "bigint"), "bigint") == [2**53 + 2, None]


MESSAGES = [
    '{"customerId":"c","reviewId":"good","reviewDate":5,"reviewBody":"fine"}',
    "oops",
    '{"reviewId":"empty","reviewBody":""}',
    '{"reviewId":"none"}',
    '{"reviewId":"partly","reviewDate":"no number","reviewBody":"fine"}',
    None,
]


def test_messages_are_valid_or_rejected(spark):
    parsed = parsed_messages(values(spark, MESSAGES), REVIEW)
    assert rows_of(valid_messages(parsed, "reviewBody"), "reviewId") == [("good",)]
    assert rejected_messages(parsed, "reviewBody").count() == len(MESSAGES) - 1
    assert rows_of(valid_messages(parsed, "reviewBody", strict=False), "reviewId") == [("good",), ("partly",)]
    assert rejected_messages(parsed, "reviewBody", strict=False).count() == len(MESSAGES) - 2
    texts = {r["_corrupt_record"] for r in rejected_messages(parsed, "reviewBody").collect()}
    assert {"oops", MESSAGES[4]} <= texts


def test_parsing_leaves_the_schema_alone(spark):
    schema = record(k=LongType())
    for _ in range(2):
        df = values(spark, ['{"k": 4}']).select(text.parsed_json(F.col("value"), schema).alias("m")).select("m.*")
        assert df.columns == ["k", "_corrupt_record"]
    assert schema.names == ["k"]
