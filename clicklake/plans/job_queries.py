"""Queries that run whole jobs: streams, review models, the report and the product merge."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, TimestampType

from clicklake.functions.scalars import date_key
from clicklake.operators.reviews import FEATURES, fit_reviews, load_model, term_counts, token_counts, tokens, vector_sum
from clicklake.plans.clicks import ADD_TO_CART, FAVORITE, cart_after_favorite, daily_cart_additions
from clicklake.plans.lines import read_word_count, start_line_details, start_windowed_word_count, start_word_count
from clicklake.plans.product_merge import read_snapshot, run_product_merge
from clicklake.plans.registry import ALL_PARTS_SQL, CLICKS_SQL, PARTS_SQL, clicks_table, query, texts_table
from clicklake.plans.reviews import REJECTED_REVIEW, REVIEW_IDS, score_messages, score_reviews, start_scoring, train_reviews
from clicklake.plans.view_report import read_view_report, run_view_report, view_report, write_report
from clicklake.schemas import LABELLED_REVIEW, LINE_DETAIL, REVIEW, SCORED_REVIEW, WORD_COUNT, record
from clicklake.session import scratch_path, streaming_session
from clicklake.sources.readers import read_table
from clicklake.sources.writers import rebalance
from clicklake.streaming.notes import BatchNotes, on_time
from clicklake.streaming.sinks import append_files, batch_files, compact_updates
from clicklake.streaming.sources import file_stream, message_stream, table_stream
from clicklake.streaming.transforms import CORRUPT, parsed_messages, valid_messages

_TOKENS_SQL = r"(SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\s')) AS word FROM documents)"


# -- streams -------------------------------------------------------------------------------------


def _in_files(rows, path, batches, kind="parquet", times=1):
    """Write rows in random order as files for a stream; returns how many a batch takes, for ``batches`` batches.

    There are as many files as batches, or more so that each is written and read by a task of ordinary size: ``times`` the
    splits of the input.
    """
    dealt = rows.repartition(max(batches, times * rows.rdd.getNumPartitions()))
    dealt.write.format(kind).save(path)
    return max(1, math.ceil(len(rows.sparkSession.read.format(kind).load(path).inputFiles()) / batches))


@query(f"SELECT word, count(*) AS count FROM {ALL_PARTS_SQL} GROUP BY word")
def stream_word_count(spark, base):
    path = scratch_path(spark, "words")
    # Several batches: words recur, and no batch holds the whole table.
    files = _in_files(texts_table(spark, base, "text"), f"{path}/in", 4)
    lines = file_stream(streaming_session(spark), f"{path}/in", record(text=StringType()), files_per_batch=files)
    start_word_count(lines, f"{path}/updates", f"{path}/checkpoint", drain=True, line="text").awaitTermination()
    compact_updates(spark, f"{path}/updates", WORD_COUNT, ["word"])
    return read_word_count(spark, f"{path}/updates")


@query(
    f"""SELECT text AS "inputLine", CAST(len({PARTS_SQL}) AS INTEGER) AS "totalWordCount"
        FROM documents WHERE text <> ''"""
)
def stream_line_detail(spark, base):
    path = scratch_path(spark, "details")
    lines = table_stream(spark, base, "documents").select("text")
    start_line_details(lines, f"{path}/rows", f"{path}/checkpoint", drain=True, line="text").awaitTermination()
    return spark.read.schema(LINE_DETAIL).parquet(f"{path}/rows").select("inputLine", "totalWordCount")


# Lines of the windowed count: the time of document d is d minutes after this; every 17th one comes a day late.
_FIRST_MS = 1_704_067_200_000
_LINE_MS = f"({_FIRST_MS} + CAST(doc_id AS BIGINT) * 60000)"
# Files of a run of it, each read by a task of its own.
_FILES = 4


@query(
    f"""SELECT make_timestamp((ms - ms % 3600000) * 1000) AS start, word, count(*) AS count
        FROM (SELECT {_LINE_MS} AS ms, unnest({PARTS_SQL}) AS word FROM documents WHERE text <> '' AND doc_id % 17 <> 0)
        WHERE ms - ms % 3600000 + 3600000 <= (SELECT max({_LINE_MS}) FROM documents WHERE doc_id % 17 <> 0) - 600000
        GROUP BY 1, 2"""
)
def stream_windowed_words(spark, base):
    """Closed windows of a word count over event time, in batches of a split of the input, three at least, and a last one that comes too late."""
    path = scratch_path(spark, "windows")
    lines = read_table(spark, base, "documents").select("doc_id", "text", F.expr(_LINE_MS).alias("ms"))
    on_time = lines.filter("doc_id % 17 <> 0").select("text", F.timestamp_millis("ms").alias("time"))
    # Times rise from part to part, except for the last: its lines belong to windows long before the first.
    n_parts = max(3, lines.rdd.getNumPartitions())
    ranges = on_time.repartitionByRange(_FILES * n_parts, "time")
    parts = ranges.withColumn("n", F.floor(F.spark_partition_id() / _FILES).cast("int"))
    late = lines.filter("doc_id % 17 = 0").select("text", F.timestamp_millis(F.col("ms") - 400 * 86_400_000).alias("time"))
    parts.unionByName(late.withColumn("n", F.lit(n_parts))).write.partitionBy("n").parquet(f"{path}/lines")
    schema = record(text=StringType(), time=TimestampType())
    session = streaming_session(spark, restarts=True)
    for n in range(n_parts + 1):  # a run for each part: state and watermark go on where the last run ended
        stream = file_stream(session, f"{path}/lines/n={{{','.join(map(str, range(n + 1)))}}}", schema)
        start_windowed_word_count(stream, f"{path}/counts", f"{path}/checkpoint", "time", drain=True, line="text").awaitTermination()
    counts = record(start=TimestampType(), end=TimestampType(), word=StringType(), count=LongType())
    return spark.read.schema(counts).parquet(f"{path}/counts").select(F.col("start").cast("timestamp_ntz").alias("start"), "word", "count")


@query("SELECT * FROM (VALUES ('drain', 0, TRUE), ('drain', 1, TRUE), ('interval', 0, TRUE), ('interval', 1, TRUE)) t(trigger, batch, as_asked)")
def stream_triggers(spark, base):
    """Of each batch of two streams over the documents whether it came by the trigger asked for."""
    path = scratch_path(spark, "triggers")
    files = _in_files(texts_table(spark, base, "text"), f"{path}/in", 2)
    told = []
    with BatchNotes(spark) as notes:
        for trigger, options in (("drain", {"drain": True}), ("interval", {"interval": "1 second"})):
            lines = file_stream(spark, f"{path}/in", record(text=StringType()), files_per_batch=files)
            running = start_line_details(lines, f"{path}/{trigger}", f"{path}/{trigger}-checkpoint", **options, line="text")
            if trigger == "drain":
                running.awaitTermination()  # ends by itself once all files are read
            else:
                running.processAllAvailable()
                running.stop()
            notes.wait(running)
            batches = notes.of(running)
            told += [(trigger, batch, ok) for batch, ok in on_time(batches, 1000 if trigger == "interval" else 1)]
    return spark.createDataFrame(told, "trigger string, batch int, as_asked boolean")


def _review_messages(spark, base):
    """Every conversation turn as a good review message, and three bad ones made from each.

    Written as lines, in several files; returns the folder and how many of them a batch takes.
    """
    turns = read_table(spark, base, "conversations")

    def message(body):
        return F.to_json(
            F.struct(
                F.col("conv_id").cast("string").alias("customerId"),
                F.col("role").alias("productId"),
                F.concat_ws("-", "conv_id", "turn").alias("reviewId"),
                F.col("turn").alias("reviewDate"),
                body.alias("reviewBody"),
            )
        )

    good = message(F.col("text"))
    bad = [F.substr(good, F.lit(1), F.length(good) - 5), message(F.lit("")), F.col("text")]
    path = scratch_path(spark, "messages")
    messages = turns.select(F.explode(F.array(good, *bad)).alias("value")).filter("value is not null")
    lines = messages.select(F.regexp_replace("value", "[\\r\\n]+", " ").alias("value"))
    return path, str(_in_files(lines, path, 3, "text", times=4))


_VALID_SQL = """SELECT CAST(conv_id AS VARCHAR) AS "customerId", role AS "productId", conv_id || '-' || turn AS "reviewId",
                       turn AS "reviewDate", text AS "reviewBody" FROM conversations WHERE text <> ''"""


@query(_VALID_SQL)
def stream_parse_valid(spark, base):
    path = scratch_path(spark, "valid")
    source, files = _review_messages(spark, base)
    messages = message_stream(spark, "text", path=source, maxFilesPerTrigger=files)
    valid = valid_messages(parsed_messages(messages, REVIEW), "reviewBody")
    append_files(valid, f"{path}/rows", f"{path}/checkpoint", drain=True).awaitTermination()
    return spark.read.schema(REVIEW).parquet(f"{path}/rows")


# -- review models -------------------------------------------------------------------------------


@query(f"SELECT word, count(*) AS count FROM {_TOKENS_SQL} GROUP BY word")
def ml_token_freq(spark, base):
    return token_counts(texts_table(spark, base, "text"), "text")


@query(f"SELECT doc_id, CAST(count(*) AS DOUBLE) AS mass FROM {_TOKENS_SQL} GROUP BY doc_id")
def ml_hash_tf_mass(spark, base):
    split = tokens(texts_table(spark, base, "doc_id", "text"), "text")
    return term_counts(split, "words", "features", FEATURES).select("doc_id", vector_sum("features").alias("mass"))


def _trained(spark, base, text="text"):
    """A model of the labelled documents, for texts in a column of the given name."""
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    documents = texts_table(spark, base, "doc_id", "text").withColumnRenamed("text", text)
    return fit_reviews(documents.join(labels, "doc_id"), text, "quality")


@query("""SELECT doc_id, TRUE AS as_by_formula, TRUE AS is_class FROM documents WHERE text <> ''""")
def ml_review_scores(spark, base):
    """Whether each review's prediction is the sign of coefficients times hashed counts plus intercept.

    Trained on files of labelled reviews and saved; scored from a file in a session that loads what was saved.
    """
    path = scratch_path(spark, "reviews")
    none = F.lit(None).cast("string")
    documents = texts_table(spark, base, "doc_id", "text").select(
        none.alias("customerId"), none.alias("productId"), F.col("doc_id").cast("string").alias("reviewId"),
        F.lit(0).cast("bigint").alias("reviewDate"), F.col("text").alias("reviewBody"),
    )
    labels = read_table(spark, base, "labels").select(F.col("doc_id").cast("string").alias("reviewId"), F.col("quality").alias("label"))
    documents.join(labels, "reviewId").select(LABELLED_REVIEW.names).write.json(f"{path}/labelled")
    documents.write.json(f"{path}/reviews")
    train_reviews(spark, f"{path}/labelled", f"{path}/model")
    scores = score_reviews(spark.newSession(), f"{path}/reviews", f"{path}/model")
    model = load_model(f"{path}/model")
    weights = F.array(*[F.lit(float(w)) for w in model.stages[-1].coefficients])
    counts = vector_to_array("features")
    margin = F.aggregate(F.zip_with(counts, weights, lambda c, w: c * w), F.lit(0.0), lambda a, x: a + x)
    by_formula = (margin + float(model.stages[-1].intercept) > 0).cast("double")
    return scores.select(
        F.col("reviewId").cast("bigint").alias("doc_id"),
        (F.col("prediction") == by_formula).alias("as_by_formula"),
        F.col("prediction").isin(0.0, 1.0).alias("is_class"),
    )


@query("""SELECT conv_id || '-' || turn AS "reviewId", TRUE AS as_in_batch FROM conversations WHERE text <> ''""")
def stream_review_scores(spark, base):
    """Whether each message's label on the stream is that of the same messages in batch."""
    path = scratch_path(spark, "scores")
    source, files = _review_messages(spark, base)
    model = _trained(spark, base, "reviewBody")
    messages = message_stream(spark, "text", path=source, maxFilesPerTrigger=files)
    outputs = (f"{path}/scores", f"{path}/rejects", f"{path}/checkpoint")
    start_scoring(messages, model, *outputs, drain=True, fold_every=2).awaitTermination()
    streamed = batch_files(spark, f"{path}/scores", SCORED_REVIEW)
    in_batch = score_messages(spark.read.text(source), model)
    label = [f.name for f in SCORED_REVIEW.fields if f.name not in REVIEW_IDS][0]
    both = streamed.select("reviewId", F.col(label).alias("one")).join(
        in_batch.select("reviewId", F.col(label).alias("other")), "reviewId"
    )
    return both.select("reviewId", (F.col("one") == F.col("other")).alias("as_in_batch"))


@query(
    """SELECT "customerId", broken, count(*) AS messages FROM (
           SELECT CAST(conv_id AS VARCHAR) AS "customerId", FALSE AS broken FROM conversations
           UNION ALL SELECT NULL, TRUE FROM conversations UNION ALL SELECT NULL, TRUE FROM conversations)
       GROUP BY "customerId", broken"""
)
def stream_review_rejects(spark, base):
    """Messages that cannot be scored, by sender: broken ones, whose sender may be lost, and those without a text."""
    path = scratch_path(spark, "rejects")
    source, files = _review_messages(spark, base)
    messages = message_stream(spark, "text", path=source, maxFilesPerTrigger=files)
    outputs = (f"{path}/scores", f"{path}/rejects", f"{path}/checkpoint")
    start_scoring(messages, _trained(spark, base, "reviewBody"), *outputs, drain=True, fold_every=1).awaitTermination()
    rejects = batch_files(spark, f"{path}/rejects", REJECTED_REVIEW)
    broken = F.col(CORRUPT).isNotNull()
    sender = F.when(~broken, F.col("customerId")).alias("customerId")
    return rejects.groupBy(sender, broken.alias("broken")).agg(F.count(F.lit(1)).alias("messages"))


# -- jobs ----------------------------------------------------------------------------------------


def _as_views(events):
    return events.select(
        F.col("user_id").alias("userId"),
        F.col("k").alias("productId"),
        F.col("event_type").alias("channel"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        date_key(F.col("ts")).cast("int").alias("partition_date"),
    )


def _as_products(part):
    return part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("category"), F.lit(0).cast("bigint").alias("timestamp"))


def flagship(spark, base):
    """The view report over the whole event table."""
    return view_report(_as_views(clicks_table(spark, base)), _as_products(read_table(spark, base, "part")))


def _report_sql(condition: str) -> str:
    return f"""SELECT channel, category, "distinctUserCount" FROM (SELECT *, rank() OVER (PARTITION BY channel
        ORDER BY "distinctUserCount" DESC) AS r FROM (SELECT event_type AS channel, p_type AS category,
        CAST(count(DISTINCT user_id) AS INTEGER) AS "distinctUserCount" FROM {CLICKS_SQL} e JOIN part ON k = p_partkey
        WHERE {condition} GROUP BY 1, 2)) WHERE r <= 3"""


query(_report_sql("TRUE"))(flagship)


@query(
    f"""SELECT *, 20240201 AS partition_date,
              (SELECT max(CAST(strftime(ts, '%Y%m%d') AS INTEGER)) FROM events WHERE ts < TIMESTAMP '2024-01-16') AS processed_to
        FROM ({_report_sql("ts < TIMESTAMP '2024-01-16'")})
        UNION ALL
        SELECT *, 20990202, (SELECT max(CAST(strftime(ts, '%Y%m%d') AS INTEGER)) FROM events)
        FROM ({_report_sql("ts >= TIMESTAMP '2024-01-16'")})"""
)
def job_view_report(spark, base):
    path = scratch_path(spark, "report")
    views = _as_views(clicks_table(spark, base))
    _as_products(read_table(spark, base, "part")).write.json(f"{path}/products")

    def arrive(rows):
        rebalance(rows, "partition_date").write.mode("append").partitionBy("partition_date").json(f"{path}/views")

    def run(day):
        return run_view_report(spark, f"{path}/views", f"{path}/products", f"{path}/report", day)

    arrive(views.filter("partition_date <= 20240115"))
    run(20240201)
    arrive(views.limit(1).withColumn("productId", F.lit(-1).cast("bigint")).withColumn("partition_date", F.lit(20240115)))
    run(20240201)  # a day that was reported is closed: nothing new
    arrive(views.filter("partition_date between 20240116 and 20240120"))
    # A run that fails before it is noted: its rows are not read, and its views are left to the next run.
    write_report(spark, f"{path}/views", f"{path}/products", f"{path}/report", 20990201)
    arrive(views.filter("partition_date > 20240120"))
    run(20990202)
    # A day whose views meet no product adds no rows, but the mark moves.
    arrive(views.limit(1).withColumn("productId", F.lit(-1).cast("bigint")).withColumn("partition_date", F.lit(20990201)))
    run(20990203)
    run(20990204)  # nothing new
    return read_view_report(spark, f"{path}/report")


def _clicks(spark, base):
    """Events as clicks, views standing for favorites and purchases for cart additions."""
    event = (
        F.when(F.col("event_type") == "view", FAVORITE)
        .when(F.col("event_type") == "purchase", ADD_TO_CART)
        .otherwise(F.col("event_type"))
    )
    return clicks_table(spark, base).select(
        F.col("user_id").alias("userId"),
        F.col("k").alias("productId"),
        event.alias("event"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
    )


@query(
    f"""SELECT "userId", "productId", timestamp
        FROM (SELECT *, lag(event) OVER (PARTITION BY "userId", "productId" ORDER BY timestamp, event) AS previous
              FROM (SELECT user_id AS "userId", k AS "productId", epoch_us(ts) // 1000 AS timestamp,
                           CASE event_type WHEN 'view' THEN 'favorite' ELSE 'addToCart' END AS event
                    FROM {CLICKS_SQL} WHERE event_type IN ('view', 'purchase')))
        WHERE event = 'addToCart' AND previous = 'favorite'"""
)
def job_cart_after_favorite(spark, base):
    return cart_after_favorite(_clicks(spark, base))


@query(
    """SELECT date_trunc('day', ts)::TIMESTAMP AS day, user_id AS "userId", count(*) AS "totalAddToCart"
       FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"""
)
def job_daily_cart_additions(spark, base):
    return daily_cart_additions(_clicks(spark, base))


_RECORD_SQL = """SELECT p_partkey AS id, {name} AS name, p_type AS category, p_brand AS brand, p_name AS color,
                        p_retailprice AS price, CAST({timestamp} AS BIGINT) AS timestamp FROM part WHERE {condition}"""
# Three sets of records: the first snapshot, newer ones (some for new products), and late ones.
_RECORDS = (
    ("p_name", "1000", "p_brand <> 'Brand#1'"),
    ("concat(p_name, '_new')", "2000 + p_size", "p_size >= 25 OR p_brand = 'Brand#1'"),
    ("concat(p_name, '_late')", "500", "p_type = 'LARGE'"),
)


def _records_sql(index: int) -> str:
    name, timestamp, condition = _RECORDS[index]
    return _RECORD_SQL.format(name=name, timestamp=timestamp, condition=condition)


@query(
    f"""SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp DESC) AS n
        FROM ({_records_sql(0)} UNION ALL {_records_sql(1)} UNION ALL {_records_sql(2)})) WHERE n = 1"""
)
def job_product_merge(spark, base):
    path = scratch_path(spark, "merge")
    part = read_table(spark, base, "part")

    def arrive(index, folder):
        name, timestamp, condition = _RECORDS[index]
        part.filter(condition).select(
            F.col("p_partkey").alias("id"),
            F.expr(name).alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_name").alias("color"),
            F.col("p_retailprice").alias("price"),
            F.expr(timestamp).cast("bigint").alias("timestamp"),
        ).write.mode("append").json(f"{path}/{folder}")

    arrive(0, "first")
    arrive(1, "changes")
    arrive(2, "changes")
    run_product_merge(spark, f"{path}/first", f"{path}/catalogue", buckets=16)
    run_product_merge(spark, f"{path}/changes", f"{path}/catalogue")
    run_product_merge(spark, f"{path}/changes", f"{path}/catalogue")  # a replay changes nothing
    return read_snapshot(spark, f"{path}/catalogue")
