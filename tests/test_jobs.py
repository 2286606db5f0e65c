"""Jobs in batch and on streams, with restarts."""

import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clicklake.operators.reviews import load_model, split_reviews, tokens
from clicklake.plans.clicks import cart_after_favorite, daily_cart_additions, event_totals_since, users_per_event
from clicklake.plans.lines import read_word_count, start_line_details, start_word_count
from clicklake.plans.reviews import REJECTED_REVIEW, score_messages, score_reviews, start_scoring, train_reviews
from clicklake.plans.view_report import read_view_report, run_view_report, view_report
from clicklake.schemas import CLICK, LABELLED_REVIEW, LINE, LINE_DETAIL, PRODUCT, PRODUCT_VIEW, REVIEW, SCORED_REVIEW
from clicklake.streaming.sinks import batch_files, trigger_options
from clicklake.streaming.sources import file_stream, line_stream, message_stream
from clicklake.streaming.transforms import word_counts
from conftest import rows_of

# The sample views of two days, and the products.
VIEWS = {
    20210110: [
        (100, 1, "Android"), (105, 1, "Mobile"), (107, 1, "IOS"),
        (100, 2, "Android"), (103, 2, "Android"), (103, 3, "Android"),
    ],
    20210111: [(101, 1, "Mobile"), (101, 2, "Mobile"), (109, 1, "IOS")],
}
PRODUCTS = [(1, "Laptop", 1611227995000), (2, "hat", 1611227995000), (3, "shoes", 1611227995000)]
REPORT = [
    ("Android", "Laptop", 1), ("Android", "hat", 2), ("Android", "shoes", 1),
    ("IOS", "Laptop", 2), ("Mobile", "Laptop", 2), ("Mobile", "hat", 1),
]


def views_of(spark, *days):
    return spark.createDataFrame([(*row, 0) for day in days for row in VIEWS[day]], PRODUCT_VIEW)


def test_view_report(spark):
    products = spark.createDataFrame(PRODUCTS, PRODUCT)
    report = view_report(views_of(spark, *VIEWS), products, top=None)
    assert rows_of(report) == sorted(REPORT, key=repr)
    assert rows_of(view_report(views_of(spark, *VIEWS), products, top=1)) == [
        ("Android", "hat", 2), ("IOS", "Laptop", 2), ("Mobile", "Laptop", 2),
    ]


def test_view_report_runs(spark, folder):
    spark.createDataFrame(PRODUCTS, PRODUCT).write.json(f"{folder}/products")

    def arrive(day):
        views_of(spark, day).write.json(f"{folder}/views/partition_date={day}")

    def run(date):
        return run_view_report(spark, f"{folder}/views", f"{folder}/products", f"{folder}/report", date)

    def reported():
        return rows_of(read_view_report(spark, f"{folder}/report"))

    arrive(20210110)
    assert run(20210201) == 20210110
    first = reported()
    assert {row[3:] for row in first} == {(20210201, 20210110)} and len(first) == 5
    assert run(20210201) is None and reported() == first
    arrive(20210111)
    assert run(20210201) == 20210111  # later the same day: adds to the first run
    both = reported()
    assert set(first) < set(both)
    assert [row[:3] for row in both if row[4] == 20210111] == [
        ("IOS", "Laptop", 1), ("Mobile", "Laptop", 1), ("Mobile", "hat", 1),
    ]


def test_view_report_marks(spark, folder):
    """Views without a product move the mark; days from the run date on stay open; no views folder is an error."""
    spark.createDataFrame(PRODUCTS, PRODUCT).write.json(f"{folder}/products")

    def arrive(day, rows):
        spark.createDataFrame([(*row, 0) for row in rows], PRODUCT_VIEW).write.mode("append").json(
            f"{folder}/views/partition_date={day}"
        )

    def run(date):
        return run_view_report(spark, f"{folder}/views", f"{folder}/products", f"{folder}/report", date)

    with pytest.raises(AnalysisException):
        run(20210201)
    arrive(20210105, [(1, 99, "Android")])
    assert run(20210201) == 20210105
    assert run(20210201) is None
    arrive(20210202, [(1, 1, "Android")])
    assert run(20210202) is None
    arrive(20210202, [(2, 1, "Android")])
    assert run(20210203) == 20210202
    assert rows_of(read_view_report(spark, f"{folder}/report"), "channel", "distinctUserCount") == [("Android", 2)]


def test_a_failed_run_is_reported_once(spark, folder, monkeypatch):
    """Rows are written and the note of the run fails: nobody reads them, and the next run has their views."""
    import os

    from clicklake.plans import view_report as job

    spark.createDataFrame(PRODUCTS, PRODUCT).write.json(f"{folder}/products")

    def arrive(day, *users):
        rows = spark.createDataFrame([(user, 1, "Android", 0) for user in users], PRODUCT_VIEW)
        rows.write.json(f"{folder}/views/partition_date={day}")

    def run(date):
        return run_view_report(spark, f"{folder}/views", f"{folder}/products", f"{folder}/report", date)

    def reported():
        return rows_of(read_view_report(spark, f"{folder}/report"), "distinctUserCount", "partition_date", "processed_to")

    arrive(20230101, 7)
    assert run(20230105) == 20230101
    arrive(20240101, 1, 2)
    with monkeypatch.context() as patch:
        patch.setattr(job, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(20240110)
    assert os.listdir(f"{folder}/report/rows/partition_date=20240110") == ["processed_to=20240101"]
    assert reported() == [(1, 20230105, 20230101)]
    arrive(20240102, 2, 3)
    assert run(20240111) == 20240102
    assert reported() == [(1, 20230105, 20230101), (3, 20240111, 20240102)]
    assert os.listdir(f"{folder}/report/rows/partition_date=20240110") == []
    # The same run tried again after a failure.
    arrive(20240103, 4)
    with monkeypatch.context() as patch:
        patch.setattr(job, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(20240112)
    assert run(20240112) == 20240103 and run(20240112) is None
    assert reported()[-1] == (3, 20240111, 20240102) and (1, 20240112, 20240103) in reported()


CLICKS = [
    (1, 9, "favorite", 1), (1, 9, "view", 2), (1, 9, "addToCart", 3),
    (2, 9, "addToCart", 1), (2, 9, "favorite", 2), (2, 8, "addToCart", 86_400_001),
]


def test_click_reports(spark):
    clicks = spark.createDataFrame(CLICKS, CLICK)
    assert rows_of(cart_after_favorite(clicks)) == [(1, 9, 3)]
    assert rows_of(cart_after_favorite(clicks, max_group_rows=1)) == [(1, 9, 3)]
    together = spark.createDataFrame([(1, 9, "favorite", 1), (1, 9, "addToCart", 1), (1, 9, "addToCart", 2)], CLICK)
    assert rows_of(cart_after_favorite(together)) == [(1, 9, 2)]
    daily = daily_cart_additions(clicks)
    assert daily.columns == ["day", "userId", "totalAddToCart"]
    assert rows_of(daily.select(F.col("day").cast("string"), "userId", "totalAddToCart")) == [
        ("1970-01-01 00:00:00", 1, 1), ("1970-01-01 00:00:00", 2, 1), ("1970-01-02 00:00:00", 2, 1),
    ]
    assert rows_of(event_totals_since(clicks, 2)) == [("addToCart", 2), ("favorite", 1), ("view", 1)]
    assert rows_of(users_per_event(clicks)) == [("addToCart", 2), ("favorite", 2), ("view", 1)]


LINES = ["a b ", "  a", "a  b", "   ", "", "one"]


def add_file(tmp_path, name, lines):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text("\n".join(lines))


def test_running_word_count_goes_on_after_a_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run():
        start_word_count(line_stream(spark, source, 1), out, checkpoint, drain=True).awaitTermination()
        return rows_of(read_word_count(spark, out))

    def in_batch():
        return rows_of(word_counts(spark.read.text(source), keep_inner_empty=True))

    add_file(tmp_path, "1.txt", LINES)
    add_file(tmp_path, "2.txt", ["a a"])
    assert run() == in_batch()
    add_file(tmp_path, "3.txt", ["a one new"])
    assert run() == in_batch()
    assert dict(run())["a"] == 6


def test_a_repeated_batch_replaces_itself(spark, folder):
    from clicklake.streaming.sinks import write_batch

    for _ in range(2):
        write_batch(spark.createDataFrame([("w", 3)], "word string, count bigint"), folder, 0)
    assert rows_of(read_word_count(spark, folder)) == [("w", 3)]
    assert spark.read.parquet(folder).count() == 1


def test_compaction_keeps_what_is_read(spark, folder):
    from clicklake.schemas import WORD_COUNT
    from clicklake.streaming.sinks import compact_updates, write_batch

    path = f"{folder}/log"

    def batch(number, *rows):
        write_batch(spark.createDataFrame(list(rows), "word string, count bigint"), path, number)

    batch(0, ("a", 1), ("b", 1))
    batch(1, ("a", 2))
    write_batch(spark.createDataFrame([], "word string, count bigint"), path, 2)  # writes nothing
    batch(3, ("c", 1))
    before = rows_of(read_word_count(spark, path))
    assert before == [("a", 2), ("b", 1), ("c", 1)]
    assert compact_updates(spark, path, WORD_COUNT, ["word"]) == 1
    assert rows_of(read_word_count(spark, path)) == before
    batch(1, ("a", 2))  # a repeat that comes late, of a batch already folded
    assert rows_of(read_word_count(spark, path)) == before
    batch(4, ("a", 5))
    assert compact_updates(spark, path, WORD_COUNT, ["word"]) == 3
    assert compact_updates(spark, path, WORD_COUNT, ["word"], keep=0) == 4
    assert rows_of(read_word_count(spark, path)) == [("a", 5), ("b", 1), ("c", 1)]


NAMED = "n bigint, name string"


def test_folding_keeps_what_is_read(spark, folder, monkeypatch):
    """Batches become parts, parts become larger ones; crashes and repeats change nothing that is read."""
    import os

    from clicklake.schemas import record
    from clicklake.streaming import sinks
    from pyspark.sql.types import LongType, StringType

    schema, path = record(n=LongType(), name=StringType()), f"{folder}/log"

    def batch(number):
        rows = [(number, name) for name in "ab"] + [(7, "same")]
        sinks.write_batch(spark.createDataFrame(rows, NAMED), path, number)

    def read():
        return sinks.batch_files(spark, path, schema)

    def want(*numbers):
        return sorted([(n, name) for n in numbers for name in "ab"] + [(7, "same")] * len(numbers), key=repr)

    def fold(**options):
        return sinks.fold_batches(spark, path, schema, fan=2, **options)

    assert read().count() == 0 and fold() == []
    for number in (0, 1, 3):  # the second had no rows
        batch(number)
    before = read()
    assert fold() == [(0, 1, 0)]
    assert rows_of(before) == rows_of(read()) == want(0, 1, 3)  # also what was read before
    batch(1)  # a repeat that comes late
    assert rows_of(read()) == want(0, 1, 3)
    batch(4)
    with monkeypatch.context() as patch:  # fails while it writes the larger part
        patch.setattr(sinks, "_part_path", lambda p, part, f=sinks._part_path: 1 / 0 if part[2] else f(p, part))
        with pytest.raises(ZeroDivisionError):
            fold()
    assert rows_of(read()) == want(0, 1, 3, 4)
    os.makedirs(f"{path}-folded/level=1-from=0-to=9")  # left by a run that died
    assert rows_of(read()) == want(0, 1, 3, 4)
    batch(5)
    assert fold() == [(0, 4, 1)]
    assert rows_of(read()) == want(0, 1, 3, 4, 5)
    assert fold(keep=0) == [(0, 4, 1), (5, 5, 0)]
    for number in range(6, 12):
        batch(number)
        fold(keep=0)
        assert rows_of(read()) == want(0, 1, 3, *range(4, number + 1))
    fold(keep=0)
    assert sinks._batches(spark, path) == []
    parts = sinks._parts(spark, path)
    assert len(parts) <= 4 and [p[0] for p in parts[1:]] == [p[1] + 1 for p in parts[:-1]]
    assert len(os.listdir(f"{path}-folded")) == len(parts)


def test_arrival_times_lie_within_the_run(spark, tmp_path):
    import time

    add_file(tmp_path, "1.txt", ["x", "y z"])
    start = time.time() * 1000
    out = str(tmp_path / "o")
    start_line_details(line_stream(spark, str(tmp_path / "in")), out, str(tmp_path / "c"), drain=True).awaitTermination()
    end = time.time() * 1000
    times = [row.receivedTimestamp for row in spark.read.schema(LINE_DETAIL).parquet(out).collect()]
    assert len(times) == 2 and all(start <= t <= end for t in times)


def test_message_stream_of_text(spark, tmp_path):
    add_file(tmp_path, "1.txt", ["m1", "m2"])
    stream = message_stream(spark, "text", path=str(tmp_path / "in"))
    assert stream.isStreaming and stream.columns == ["value"]


def test_line_details_stream(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    add_file(tmp_path, "1.txt", LINES)
    for _ in range(2):  # the second start finds nothing new
        start_line_details(line_stream(spark, source), out, checkpoint, drain=True).awaitTermination()
    rows = spark.read.schema(LINE_DETAIL).parquet(out)
    assert rows_of(rows, "inputLine", "totalWordCount") == sorted(
        [("a b ", 2), ("  a", 3), ("a  b", 3), ("   ", 0), ("one", 1)], key=repr
    )


def test_windows_close_and_late_lines_are_told(spark, tmp_path):
    """Three batches: a window, one that closes it, and a line too late beside one in time."""
    from datetime import datetime

    from clicklake.plans.lines import late_words, start_windowed_word_count
    from clicklake.streaming.transforms import windowed_word_counts

    schema = "value string, time timestamp"
    batches = [
        [("a b a", datetime(2024, 1, 1, 10, 5)), ("b", datetime(2024, 1, 1, 10, 55))],
        [("c", datetime(2024, 1, 1, 12, 30)), ("a", datetime(2024, 1, 1, 10, 59))],
        [("late late", datetime(2024, 1, 1, 10, 1)), ("in time", datetime(2024, 1, 1, 12, 40))],
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    late = 0
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        lines = file_stream(spark, source, spark.createDataFrame([], schema).schema)
        query = start_windowed_word_count(lines, out, str(tmp_path / "checkpoint"), "time", drain=True)
        query.awaitTermination()
        late += late_words(query)
    closed = spark.read.parquet(out).select(F.hour("start").alias("hour"), "word", "count")
    assert rows_of(closed) == [(10, "a", 3), (10, "b", 2)]
    assert late == 1
    in_batch = windowed_word_counts(spark.createDataFrame(batches[0] + batches[1], schema), "time", "1 hour", "10 minutes")
    assert rows_of(in_batch.filter("hour(start) = 10").select(F.hour("start"), "word", "count")) == rows_of(closed)


def test_batches_that_come_too_soon():
    from clicklake.streaming.notes import on_time

    assert on_time([(0, 1_500, 1), (1, 2_000, 1), (2, 2_999, 1), (3, 7_000, 1)], 1000) == [(0, True), (1, True), (2, False), (3, True)]
    assert on_time([], 1000) == []


def test_notes_of_batches(spark, tmp_path):
    from clicklake.streaming.notes import BatchNotes

    add_file(tmp_path, "1.txt", ["x", "y"])
    add_file(tmp_path, "2.txt", ["z"])
    with BatchNotes(spark, last=3) as notes:
        query = start_line_details(line_stream(spark, str(tmp_path / "in"), 1), str(tmp_path / "o"), str(tmp_path / "c"), drain=True)
        query.awaitTermination()
        notes.wait(query)
    assert sorted(r[2] for r in notes.of(query)) == [1, 2] and [r[0] for r in notes.of(query)] == [0, 1]
    assert notes.table().filter("rows > 0").count() == 2


def test_triggers():
    assert trigger_options("5 seconds") == {"processingTime": "5 seconds"}
    assert trigger_options(drain=True) == {"availableNow": True}
    assert trigger_options() == {}


def test_interval_trigger(spark, tmp_path):
    add_file(tmp_path, "1.txt", ["x"])
    query = start_line_details(
        line_stream(spark, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), interval="1 second"
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_message_stream_needs_its_connector(spark):
    """The connector is not part of this installation; the source is chosen by name."""
    options = {"kafka.bootstrap.servers": "nowhere:1", "subscribe": "reviews"}
    with pytest.raises(AnalysisException, match="kafka"):
        message_stream(spark, "kafka", **options)


GOOD, BAD = "great lovely perfect", "awful broken terrible"


@pytest.fixture(scope="module")
def model_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    rows = [("c", "p", f"g{i}", i, GOOD, 1) for i in range(20)] + [("c", "p", f"b{i}", i, BAD, 0) for i in range(20)]
    rows += [("c", "p", "none", 1, None, 1), ("c", "p", "empty", 1, "", 0)]
    spark.createDataFrame(rows, LABELLED_REVIEW).write.json(f"{path}/train")
    for _ in range(2):  # the second saves over the first
        train_reviews(spark, f"{path}/train", f"{path}/model")
    return f"{path}/model"


def test_models_are_versions(spark, model_path, folder, monkeypatch):
    """The latest noted version is loaded; a save that fails leaves it, and the next one takes its place."""
    import os

    from clicklake.operators import reviews

    assert reviews.model_versions(spark, model_path) == [1, 2]
    model, path = load_model(model_path), f"{folder}/m"
    with pytest.raises(FileNotFoundError):
        load_model(path)
    assert reviews.save_model(model, path) == 1
    with monkeypatch.context() as patch:
        patch.setattr(reviews, "commit", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            reviews.save_model(model, path)
    assert sorted(os.listdir(f"{path}/versions")) == ["version=1", "version=2"]
    assert reviews.model_versions(spark, path) == [1]
    loaded = load_model(path)
    assert [reviews.save_model(model, path, keep=2) for _ in range(3)] == [2, 3, 4]
    assert reviews.model_versions(spark, path) == [3, 4]
    assert list(load_model(path).stages[-1].coefficients) == list(loaded.stages[-1].coefficients)
    assert list(load_model(path, 3).stages[-1].coefficients) == list(loaded.stages[-1].coefficients)


def test_batch_scores(spark, model_path, folder):
    rows = [("c", "p", "x", 1, GOOD), ("c", "p", "y", 2, BAD), ("c", "p", "z", 3, None)]
    spark.createDataFrame(rows, REVIEW).write.json(f"{folder}/reviews")
    scores = score_reviews(spark, f"{folder}/reviews", model_path)
    assert {"words", "features", "probability", "prediction"} <= set(scores.columns)
    assert rows_of(scores, "reviewId", "prediction") == [("x", 1.0), ("y", 0.0)]


def test_stream_scores_equal_batch_and_survive_a_restart(spark, model_path, tmp_path):
    source = str(tmp_path / "in")
    model = load_model(model_path)

    def message(name, body):
        return (f'{{"customerId":"c","productId":"p","reviewId":"{name}","reviewDate":7,"reviewBody":"{body}"}}',)

    def arrive(*rows):
        spark.createDataFrame(list(rows), LINE).write.mode("append").parquet(source)

    def run():
        start_scoring(
            file_stream(spark, source, LINE), model, *(str(tmp_path / n) for n in ("scores", "rejects", "cp")), drain=True, fold_every=1
        ).awaitTermination()
        return rows_of(batch_files(spark, str(tmp_path / "scores"), SCORED_REVIEW))

    def in_batch():
        return rows_of(score_messages(spark.read.parquet(source), model))

    arrive(message("x", GOOD), message("y", BAD), ("oops",), message("e", ""), ('{"reviewId":"n"}',))
    assert run() == in_batch() == [("c", "p", "x", 7, "positive"), ("c", "p", "y", 7, "negative")]
    arrive(message("z", GOOD))
    assert run() == in_batch()
    assert len(run()) == 3
    assert rows_of(batch_files(spark, str(tmp_path / "rejects"), REJECTED_REVIEW), "reviewId") == [("e",), ("n",), (None,)]
    assert (tmp_path / "scores-folded").exists()


def test_scores_follow_the_model_formula(spark):
    """Whole documents, scored by the query's own steps and by a plain dot product."""
    import numpy as np

    from clicklake.operators.reviews import fit_reviews, scored
    from clicklake.sources.readers import read_table
    from conftest import SMALL

    documents = read_table(spark, SMALL, "documents")
    labelled = documents.join(read_table(spark, SMALL, "labels"), "doc_id")
    model = fit_reviews(labelled, "text", "quality")
    weights, start = np.array(model.stages[-1].coefficients), model.stages[-1].intercept
    rows = scored(documents, model).select("words", "features", "prediction").collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert row.features.toArray().sum() == len(row.words)
        assert row.prediction == float(row.features.toArray() @ weights + start > 0)


def test_fit_in_steps_is_the_pipeline_fit(spark, folder):
    from clicklake.operators.reviews import fit_reviews, review_pipeline

    rows = [("c", "p", str(i), i, f"{GOOD if i % 3 else BAD} w{i % 7}", int(i % 3 > 0)) for i in range(60)]
    reviews = spark.createDataFrame(rows, LABELLED_REVIEW)
    ours, whole = fit_reviews(reviews).stages[-1], review_pipeline().fit(reviews).stages[-1]
    assert list(ours.coefficients) == pytest.approx(list(whole.coefficients), rel=1e-6)


def test_split_is_stable_and_whole(spark):
    reviews = spark.range(1000).select(F.col("id").cast("string").alias("reviewId"))
    train, held_out = split_reviews(reviews, "reviewId", 0.2)
    assert train.count() + held_out.count() == 1000
    assert 120 < held_out.count() < 280
    assert rows_of(split_reviews(reviews.repartition(3), "reviewId", 0.2)[1]) == rows_of(held_out)


def test_tokens(spark):
    df = spark.createDataFrame([("A b\tC ",), (None,)], "t string")
    assert [r.words for r in tokens(df, "t").collect()] == [["a", "b", "c"]]


def test_files_of_a_stream_grow_with_the_input(spark, tmp_path):
    from clicklake.plans.job_queries import _in_files

    for splits, times, written, files in ((2, 1, 4, 1), (9, 1, 9, 3), (3, 4, 12, 3)):
        path = str(tmp_path / f"{splits}-{times}")
        rows = spark.range(1000, numPartitions=splits).select(F.col("id").cast("string").alias("text"))
        assert _in_files(rows, path, 4, times=times) == files
        assert len(spark.read.parquet(path).inputFiles()) == written and spark.read.parquet(path).distinct().count() == 1000
    assert _in_files(rows.limit(0), str(tmp_path / "none"), 4) == 1


def test_windowed_words_in_more_parts(spark, monkeypatch):
    """More splits of the input make more runs of the stream, not larger ones, and the same counts."""
    from clicklake.plans import job_queries

    runs = []
    start = job_queries.start_windowed_word_count
    monkeypatch.setattr(job_queries, "start_windowed_word_count", lambda *args, **options: runs.append(1) or start(*args, **options))
    table = "/root/testdata/sf0.001"
    usual = rows_of(job_queries.stream_windowed_words(spark, table))
    assert len(runs) == 4
    cost, size = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = {key: spark.conf.get(key) for key in (cost, size)}
    try:
        spark.conf.set(cost, "0")
        spark.conf.set(size, str(os.path.getsize(f"{table}/documents.parquet") // 5 + 1))
        assert rows_of(job_queries.stream_windowed_words(spark, table)) == usual and usual
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(runs) > 4 + 4


def test_windowed_words_store_state_and_not_its_changes(spark, monkeypatch):
    """A start of the stream reads its state, however many runs there were, from files that several tasks read."""
    from clicklake.plans import job_queries

    asked = []
    start = job_queries.start_windowed_word_count
    monkeypatch.setattr(job_queries, "start_windowed_word_count", lambda *args, **options: asked.append(args) or start(*args, **options))
    assert job_queries.stream_windowed_words(spark, "/root/testdata/sf0.001").count()
    checkpoint = Path(asked[-1][2].removeprefix("file:"))
    kinds = [p.suffix for p in checkpoint.glob("state/**/*") if p.is_file()]
    assert ".zip" in kinds and ".changelog" not in kinds
    kept = [job_queries.streaming_session(spark, restarts=r).conf.get("spark.sql.streaming.minBatchesToRetain") for r in (True, False)]
    assert kept == ["2", "100"]
    assert [len(list(checkpoint.parent.glob(f"lines/n={n}/*.parquet"))) for n in range(3)] == [4, 4, 4]
