"""Mixing sources to target weights by capped water-filling.

Each source gets words in proportion to its weight, but at most ``max_epochs`` times its own size;
what exceeds a cap goes to the others by weight until nobody is above. In closed form: the target
is ``min(cap, level * weight)``, and with sources sorted by cap / weight the level follows from
running sums, so no loop is needed.

A source's rate is target / size. Every document is taken ``floor(rate)`` times, and the fraction
that is left once more for a seeded, evenly spread part of the documents. Documents are ranked within
their source by size class, then by a seeded hash; the k-th is taken once more if the running sum of
the fraction passes a whole number at k. So taken words miss the target by about one of the largest
documents, where independent draws would miss it by the square root of their number.

Then the draw is changed for some documents of each source, so that its words come nearer: from the largest size down,
as many of each size as fit in what is missing, or too much, until none of the documents that could be
changed fits. This has no count to stop at. It is planned from one row per source and size, which are at most
the root of twice the source's words, and ranks rows within slices only.

Ranks are made without bringing a source to one task: rows are numbered within (source, size class,
slice), slices being as many as hold ``SLICE_ROWS`` rows each, and offsets come from the counts. Slices are
ranges of the hash, so their number does not change the order.

Defined results: a null text has size 0; size 0 is taken ``floor(rate)`` times 0 words; a null source
is a source of its own, ordered last; a source of size 0 has target 0; repeated rows are documents
of their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.llm.common import written

MAX_EPOCHS = 3
SLICE_ROWS = 2_000
SEED = "mix"

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def water_filled(sources: DataFrame, weight: str, size: str, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target``. One row per source; the sum of all sizes is what is shared.

    The windows run over one row per source, not over documents.
    """
    cap = F.col(size) * F.lit(float(max_epochs))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(cap / F.col(weight), F.col(weight), F.col(size)).rowsBetween(Window.unboundedPreceding, -1)
    ratio = F.col("__cap") / F.col(weight)
    sums = sources.withColumn("__cap", cap).select(
        "*",
        F.sum(F.col(size).cast("double")).over(everything).alias("__total"),
        F.coalesce(F.sum("__cap").over(by_ratio), F.lit(0.0)).alias("__capped"),
        (F.sum(weight).over(everything) - F.coalesce(F.sum(weight).over(by_ratio), F.lit(0))).alias("__open"),
    )
    # The level if exactly the sources before this one are capped. It is right for the first source
    # that it does not cap, and falls from there on.
    level = (F.col("__total") - F.col("__capped")) / F.col("__open")
    levelled = sums.withColumn("__level", F.max(F.when(level <= ratio, level)).over(everything))
    return levelled.withColumn(
        "target", F.when(F.col("__level").isNull(), F.col("__cap")).otherwise(F.least("__cap", F.col("__level") * F.col(weight)))
    ).drop("__cap", "__total", "__capped", "__open", "__level")


def cycled_weights(sources: DataFrame, source: str, weights: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Add ``weight``: the given ones in turn, sources ordered by code point, null last."""
    at = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    return sources.withColumn("weight", F.array(*map(F.lit, weights))[at % len(weights)])


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, times, taken`` of each document.

    ``times`` is how often the document enters the mix as a whole, ``taken`` its words in all.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    # Classes by the power of two of the size, largest first.
    sized = written(sized.withColumn("__class", -F.length(F.bin("size"))), "sizes")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))

    groups = sized.groupBy("source", "__class").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words"))
    groups = written(groups.withColumn("slices", F.ceil(F.col("rows") / slice_rows).cast("int")), "groups")
    sources = groups.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = water_filled(cycled_weights(sources, "source", weights), "weight", "source_size", max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("rate", F.least(rate, F.lit(float(max_epochs)))).drop("weight")

    same_group = [F.col("d.source").eqNullSafe(F.col("g.source")), F.col("d.__class") == F.col("g.__class")]
    sliced = (
        sized.withColumn("__key", key)
        .alias("d")
        .join(groups.select("source", "__class", "slices").alias("g"), same_group)
        .select("d.*", F.shiftright(F.conv(F.substring("__key", 1, 7), 16, 10).cast("bigint") * F.col("slices"), 28).alias("__slice"))
    )
    slices = sliced.groupBy("source", "__class", "__slice").agg(F.count(F.lit(1)).alias("rows"))
    running = Window.partitionBy("source").orderBy("__class", "__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("__before", F.coalesce(F.sum("rows").over(running), F.lit(0))).drop("rows")
    within = Window.partitionBy("source", "__class", "__slice").orderBy("__key", "doc_id", "size")
    ranked = sliced.withColumn("__rank", F.row_number().over(within))
    same_slice = [*same_group, F.col("d.__slice") == F.col("g.__slice")]
    placed = ranked.alias("d").join(offsets.alias("g"), same_slice).select("d.*", (F.col("__before") + F.col("__rank")).alias("__place"))
    whole, part = F.floor("rate").cast("bigint"), F.col("rate") - F.floor("rate")
    once_more = F.floor(F.col("__place") * part + 0.5) - F.floor((F.col("__place") - 1) * part + 0.5)
    chosen = (
        placed.alias("d")
        .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select(
            "d.doc_id", "d.source", "d.size", "t.source_size", "t.target", "d.__place", "d.__slice",
            whole.alias("__whole"), (part > 0).alias("__loose"), once_more.cast("bigint").alias("__more"),
        )
    )
    chosen = _filled(written(chosen, "chosen"))
    times = F.col("__whole") + F.col("__more")
    return chosen.select(
        "doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken")
    )


def _filled(chosen: DataFrame) -> DataFrame:
    """Change the fraction's draw for as many documents of each source as it takes."""
    open_ = _open(chosen)
    counts = open_.groupBy("source", "size", "__slice").agg(F.count(F.lit(1)).alias("n"), F.first("missing").alias("missing"))
    counts = written(counts, "open_sizes")
    sizes = counts.groupBy("source", "size").agg(F.sum("n").alias("n"), F.first("missing").alias("missing"))
    fill = sizes.groupBy("source").applyInArrow(_fitting, sizes.select("source", "size", F.col("n").alias("wanted")).schema)
    same_size = [F.col("d.source").eqNullSafe(F.col("g.source")), F.col("d.size") == F.col("g.size")]
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    wanted = counts.alias("d").join(fill.alias("g"), same_size).select("d.*", "g.wanted")
    wanted = wanted.withColumn("wanted", F.col("wanted") - F.coalesce(before, F.lit(0))).filter("wanted > 0")
    same_slice = [*same_size, F.col("d.__slice") == F.col("g.__slice")]
    within = Window.partitionBy("source", "size", "__slice").orderBy("__place")
    ranked = open_.alias("d").join(wanted.alias("g"), same_slice).select("d.*", "g.wanted").withColumn("n", F.row_number().over(within))
    return _changed(chosen, ranked.filter("n <= wanted"))


def _fitting(sizes: pa.Table) -> pa.Table:
    """How many documents of each size of one source are changed, from the largest size down."""
    sizes = sizes.sort_by([("size", "descending")])
    left, wanted = abs(sizes.column("missing")[0].as_py()), []
    for size, n in zip(sizes.column("size").to_pylist(), sizes.column("n").to_pylist()):
        wanted.append(min(n, math.floor(left / size)))
        left -= wanted[-1] * size
    made = sizes.select(["source", "size"]).append_column("wanted", pa.array(wanted, pa.int64()))
    return made.filter(pc.greater(made.column("wanted"), 0))


def _open(chosen: DataFrame) -> DataFrame:
    """Documents that are no larger than what is missing, or too much, and whose change brings the words nearer.

    What is missing has a row for each source. It is written first, so that Spark knows its size and reads the
    documents where they are, and the draw is compared by a condition that cannot become a key of the join.
    """
    taken = F.sum((F.col("__whole") + F.col("__more")) * F.col("size"))
    missing = written(chosen.groupBy("source").agg((F.max("target") - taken).alias("missing")), "missing")
    return (
        chosen.alias("d")
        .join(missing.alias("m"), F.col("d.source").eqNullSafe(F.col("m.source")))
        .filter("d.__loose and d.size > 0 and d.size <= abs(m.missing)")
        .filter("d.__more = 0 and m.missing > 0 or d.__more = 1 and m.missing < 0")
        .select("d.source", "d.size", "d.__place", "d.__slice", "m.missing")
    )


def _changed(chosen: DataFrame, places: DataFrame) -> DataFrame:
    same = F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.__place") == F.col("c.__place"))
    more = F.when(F.col("c.__place").isNull(), F.col("d.__more")).otherwise(1 - F.col("d.__more"))
    joined = chosen.alias("d").join(places.select("source", "__place").alias("c"), same, "left")
    return joined.select("d.*", more.alias("__new")).drop("__more").withColumnRenamed("__new", "__more")
