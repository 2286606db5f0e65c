"""URL filter: rules first, then the host's reputation by empirical Bayes.

Labelled outcomes of pages (good or not) are counted per host. Each host's share of good pages is
shrunk towards that of its registered domain, the domain's towards its suffix, and the suffix's
towards all pages: at each level the parent's mean is the mean of a beta prior, and how strongly it
pulls is estimated from how much more the children's counts vary than binomial counts would (a
beta-binomial by moments). A prior is made without the pages of the child it is for, and it never counts
for more pages than it was made of, so no page counts twice and bounds stay honest. A host is blocked if even the upper bound of its posterior share is below
``MIN_GOOD``, so a few bad pages on a new host do not block it.

Counting combines before its shuffle, so a host with a third of all pages is one row per task. Verdicts
come back to the pages by a join on the host, whose large partitions Spark can split.

Defined results: a null url, or one without ``://``, has an empty host and path, and is judged as the
host ''; pages without an outcome count for nothing; a host without outcomes has its domain's mean;
without any outcome all is allowed; several outcomes of a page all count; repeated pages each get a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clicklake.llm.common import free_name, written

MIN_GOOD = 0.5
Z = 1.645
# Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 10_000.0
# Names that unrelated parties register below; otherwise the last label is the suffix. These few are a
# default only: a whole list is given as a table (see read_suffixes).
SUFFIXES = ("co.uk", "com.au", "co.jp")

Rule = tuple[str, str, str]  # host, path, verdict


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def _within(host: Column, name: str) -> Column:
    return (host == name) | host.endswith("." + name)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``, or null.

    Rules are a short list that is part of the job; of equally long ones the longer host wins.
    """
    choice = F
    for name, start, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r)):
        fits = _within(host, name) & path.startswith(start)
        found = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        choice = choice.when(fits, found)
    return choice if isinstance(choice, Column) else F.lit(None).cast("struct<rule:string,verdict:string>")


def domain_and_suffix(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    choice = F
    for name in sorted(suffixes, key=lambda s: (-len(s), s)):
        choice = choice.when(_within(host, name), F.lit(name))
    last = F.substring_index(host, ".", -1)
    suffix = choice.otherwise(last) if isinstance(choice, Column) else last
    before = F.substr(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    domain = F.when(F.length(host) <= F.length(suffix), host).otherwise(
        F.concat(F.substring_index(before, ".", -1), F.lit("."), suffix)
    )
    return domain, suffix


def read_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """Rules of a file of public suffixes: one in a line, ``*.`` for any label, ``!`` for an exception, ``//`` for remarks."""
    rule = F.lower(F.regexp_extract("value", r"^\s*(\S+)", 1))
    return spark.read.text(path).select(rule.alias("suffix")).filter("suffix <> '' and not startswith(suffix, '//')")


def _last_labels(count: Column) -> Column:
    return F.call_function("substring_index", F.col("host"), F.lit("."), -count)


def placed_hosts(hosts: DataFrame, suffixes: Sequence[str] | DataFrame) -> DataFrame:
    """Add ``domain`` and ``suffix`` to distinct hosts.

    A table of rules (column ``suffix``) is joined to the ends of each host. An exception wins, else the rule of
    most labels; a host no rule fits has its last label as suffix, and one that is a suffix is its own domain.
    """
    if not isinstance(suffixes, DataFrame):
        domain, suffix = domain_and_suffix(F.col("host"), suffixes)
        return hosts.withColumns({"domain": domain, "suffix": suffix})
    rule = F.col("suffix")
    more = F.when(rule.startswith("!"), -1).when(rule.startswith("*."), 1).otherwise(0)
    rules = suffixes.filter(rule.isNotNull()).select(F.regexp_replace(rule, r"^(!|\*\.)", "").alias("end"), more.alias("more")).distinct()
    labels = F.split("host", r"\.")
    ends = hosts.select("host", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("k"))
    ends = ends.withColumn("end", _last_labels(F.col("k")))
    fits = ends.join(rules, "end").withColumn("n", F.col("k") + F.col("more")).filter(F.col("n") <= F.size(labels))
    best = fits.groupBy(F.col("host").alias("__host")).agg(F.max(F.struct(F.col("more") < 0, "n")).getField("n").alias("__n"))
    n = F.coalesce("__n", F.lit(1))
    return (
        hosts.join(best, F.col("host") == F.col("__host"), "left")
        .withColumns({"domain": _last_labels(n + 1), "suffix": _last_labels(n)})
        .drop("__host", "__n")
    )


def _strength(children: DataFrame) -> float:
    """How many pages the prior of a level counts for. ``children``: n, good, mean (of the parent).

    Of a beta-binomial with correlation r, ``n (share - mean)^2 / (mean (1 - mean))`` is 1 + (n - 1) r on
    average; r is read off the sums over all children.
    """
    spread = F.col("mean") * (1 - F.col("mean"))
    row = (
        children.filter("n > 0")
        .agg(
            F.sum(F.col("n") * (F.col("good") / F.col("n") - F.col("mean")) ** 2 / spread).alias("s"),
            F.count(F.lit(1)).alias("c"),
            F.sum(F.col("n") - 1).alias("d"),
        )
        .first()
    )
    if not row["d"]:
        return STRONGEST
    r = (row["s"] - row["c"]) / row["d"]
    return STRONGEST if r <= 0 else float(min(STRONGEST, max(WEAKEST, (1 - r) / r)))


def host_reputation(pages: DataFrame, outcomes: DataFrame, suffixes: Sequence[str] | DataFrame = SUFFIXES) -> DataFrame:
    """``host, n, good, mean, low, high``: the posterior share of good pages of each host, with its bounds.

    ``pages``: page_id, host. ``outcomes``: page_id, good (0 or 1). ``suffixes``: a few names, or a table.
    """
    told = outcomes.filter(F.col("page_id").isNotNull() & F.col("good").isNotNull())
    hosts = (
        pages.select("page_id", "host")
        .join(told.select("page_id", "good"), "page_id", "left")
        .groupBy("host")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    )
    hosts = written(placed_hosts(hosts, suffixes).select("host", "domain", "suffix", "n", "good"), "hosts")

    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("good").alias("dg"))
    domains = written(domains, "domains")
    suffixes_ = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dg").alias("sg"))
    total = suffixes_.agg(F.coalesce(F.sum("sn"), F.lit(0)).alias("n"), F.coalesce(F.sum("sg"), F.lit(0)).alias("g")).first()
    above = domains.join(suffixes_, "suffix")
    level = hosts.join(above.drop("suffix"), "domain")

    def children(rows: DataFrame, n: str, good: str, of_n: Column, of_good: Column) -> DataFrame:
        return rows.select(F.col(n).alias("n"), F.col(good).alias("good"), ((of_good + 1) / (of_n + 2)).alias("mean"))

    strengths = (
        _strength(children(suffixes_, "sn", "sg", F.lit(total["n"]), F.lit(total["g"]))),
        _strength(children(above, "dn", "dg", F.col("sn"), F.col("sg"))),
        _strength(children(level, "n", "good", F.col("dn"), F.col("dg"))),
    )
    # Down the levels, each time without the pages that the next level counts itself.
    mean = (F.lit(total["g"]) - F.col("sg") + 1) / (F.lit(total["n"]) - F.col("sn") + 2)
    known = (F.lit(total["n"]) - F.col("sn") + 2).cast("double")
    for strength, n, good in zip(strengths, (("sn", "dn"), ("dn", "n"), ("n", None)), (("sg", "dg"), ("dg", "good"), ("good", None))):
        pull = F.least(F.lit(strength), known)
        rest_n = F.col(n[0]) - (F.col(n[1]) if n[1] else F.lit(0))
        rest_good = F.col(good[0]) - (F.col(good[1]) if good[1] else F.lit(0))
        mean, known = (rest_good + pull * mean) / (rest_n + pull), rest_n + pull
    sd = F.sqrt(mean * (1 - mean) / (known + 1))
    return level.select(
        "host",
        "n",
        "good",
        mean.alias("mean"),
        F.greatest(F.lit(0.0), mean - Z * sd).alias("low"),
        F.least(F.lit(1.0), mean + Z * sd).alias("high"),
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] = (),
    url: str = "url",
    page_id: str = "page_id",
    suffixes: Sequence[str] | DataFrame = SUFFIXES,
    min_good: float = MIN_GOOD,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` (allow or block) to every page."""
    names = {n: free_name(pages, n) for n in ("host", "path", "rule", "verdict")}
    host, path = host_and_path(F.col(url))
    placed = pages.withColumns({names["host"]: F.coalesce(host, F.lit("")), names["path"]: F.coalesce(path, F.lit(""))})
    known = host_reputation(
        placed.select(F.col(page_id).alias("page_id"), F.col(names["host"]).alias("host")), outcomes, suffixes
    )
    known = known.select(F.col("host").alias("__host"), F.when(F.col("high") < min_good, "block").otherwise("allow").alias("__verdict"))
    found = rule_for(F.col(names["host"]), F.col(names["path"]), rules)
    return (
        placed.withColumn("__rule", found)
        .join(known, F.col(names["host"]) == F.col("__host"), "left")
        .withColumn(names["rule"], F.col("__rule.rule"))
        .withColumn(names["verdict"], F.coalesce("__rule.verdict", "__verdict", F.lit("allow")))
        .drop("__rule", "__host", "__verdict")
    )
