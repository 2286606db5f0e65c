"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clicklake.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for each node with a link to another; the component is its least node.

    Alternates two steps until nothing changes: every node's larger neighbours are tied to its least
    neighbour, then its smaller ones are. What remains are stars around the least nodes. The number
    of rounds grows with the logarithm of the longest chain. Each round is aggregates and joins over
    at most the links there were, so a node with very many links needs no task of its own; rounds
    end in a written table, so that lineage does not grow.

    Links to oneself, null ends and repeated links are ignored.
    """
    first = F.least(a, b).alias("v")
    links = written(
        links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), first)
        .distinct(),
        "links",
    )
    mark = _mark(links)
    while mark[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        upper = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = upper.groupBy("u").agg(F.min("v").alias("m"))
        tied = upper.join(least, "u")
        lower = (
            tied.filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        links = written(lower, "links")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """Number of links and a checksum of them."""
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)
