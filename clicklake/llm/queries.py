"""One query per operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clicklake.llm import byte_bpe, edit_fingerprints, language, main_text, metric_join, minhash_join, mixing, packing, prefix_trie, quality_gam, repair, repeats, reputation
from clicklake.llm.common import id_remainder, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def op10_quality(spark: SparkSession, base: str) -> DataFrame:
    """Quality score of every document by the additive model."""
    docs = table(spark, base, "documents").select("doc_id", "text")
    model = quality_gam.train_quality(docs, table(spark, base, "labels"))
    scored = quality_gam.score_quality(docs, model)
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


QUERIES["op10_quality"] = op10_quality


def op5_minhash(spark: SparkSession, base: str) -> DataFrame:
    """Components of near-duplicate documents by the inverted MinHash join."""
    return minhash_join.near_duplicates(table(spark, base, "documents"))


QUERIES["op5_minhash"] = op5_minhash


def op6_mixing(spark: SparkSession, base: str) -> DataFrame:
    """All documents mixed to the weights 1, 2, 3 in turn, at most three epochs of a source."""
    mixed = mixing.mix(table(spark, base, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES["op6_mixing"] = op6_mixing
SQL["op6_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), sums AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS ratio,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0.0) AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open
  FROM sources
  WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, weight, source_size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, max(CASE WHEN (total - capped) / open <= ratio THEN (total - capped) / open END) OVER () AS level FROM sums
), targets AS (
  SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0.0 END AS rate FROM targets
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY -length(bin(size)),
                               md5('mix:' || coalesce(doc_id::VARCHAR, '')), doc_id, size) AS place
  FROM sized
), chosen0 AS (
  SELECT doc_id, ranked.source, CAST(size AS BIGINT) AS size, source_size, target, place, floor(rate) AS whole,
         rate > floor(rate) AS loose, floor(place * (rate - floor(rate)) + 0.5) - floor((place - 1) * (rate - floor(rate)) + 0.5) AS more
  FROM ranked JOIN rates ON ranked.source IS NOT DISTINCT FROM rates.source
)
"""
SQL["op6_mixing"] = SQL["op6_mixing"].replace("WITH sized", "WITH RECURSIVE sized", 1) + """, missing AS (
  SELECT *, target - sum((whole + more) * size) OVER (PARTITION BY source) AS missing FROM chosen0
), open AS (
  SELECT source, place, size, abs(missing) AS missing, row_number() OVER (PARTITION BY source, size ORDER BY place) AS n FROM missing
  WHERE loose AND size > 0 AND size <= abs(missing) AND (more = 0 AND missing > 0 OR more = 1 AND missing < 0)
), sizes AS (
  SELECT source, size, max(missing) AS missing, count(*) AS n, row_number() OVER (PARTITION BY source ORDER BY size DESC) AS k
  FROM open GROUP BY source, size
), fill AS (
  SELECT source, size, k, least(n, floor(missing / size)) AS wanted, missing - least(n, floor(missing / size)) * size AS rest
  FROM sizes WHERE k = 1
  UNION ALL
  SELECT s.source, s.size, s.k, least(s.n, floor(f.rest / s.size)), f.rest - least(s.n, floor(f.rest / s.size)) * s.size
  FROM fill f JOIN sizes s ON s.source IS NOT DISTINCT FROM f.source AND s.k = f.k + 1
), changed AS (
  SELECT o.source, o.place FROM open o JOIN fill f ON o.source IS NOT DISTINCT FROM f.source AND o.size = f.size WHERE o.n <= f.wanted
)
SELECT d.doc_id, d.size, d.source_size, d.target, CAST((whole + CASE WHEN c.place IS NULL THEN more ELSE 1 - more END) * d.size AS BIGINT) AS taken
FROM chosen0 d LEFT JOIN changed c ON d.place = c.place AND d.source IS NOT DISTINCT FROM c.source
"""


def op7_byte_bpe(spark: SparkSession, base: str) -> DataFrame:
    """Every text encoded by the 50k byte-level ranks, and decoded again."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, base, "documents").select("doc_id", "text")
    ids = F.col("ids")
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decoded(ids, ranks), 256).alias("decoded_sha256"),
    )


QUERIES["op7_byte_bpe"] = op7_byte_bpe


def op4_metric_join(spark: SparkSession, base: str) -> DataFrame:
    """Links and components of the embeddings of each label at a cosine of 0.93 or more."""
    return metric_join.range_join(table(spark, base, "embeddings"), 0.93)


QUERIES["op4_metric_join"] = op4_metric_join
SQL["op4_metric_join"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: abs(x))) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
), least_of AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least_of USING (vec_id) LEFT JOIN counted ON a = e.vec_id
"""


def op9_repeats(spark: SparkSession, base: str) -> DataFrame:
    """Every text without the 100-byte strings that also start earlier."""
    cut = repeats.without_repeats(table(spark, base, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.coalesce(F.octet_length("text").cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES["op9_repeats"] = op9_repeats


def op8_edit_fingerprints(spark: SparkSession, base: str) -> DataFrame:
    """Every text's fingerprint beside those of its edited text and of the next document."""
    return edit_fingerprints.compared_with_next(table(spark, base, "documents"))


QUERIES["op8_edit_fingerprints"] = op8_edit_fingerprints


def op3_language(spark: SparkSession, base: str) -> DataFrame:
    """Language of every text, by a model of those outside the fold."""
    docs = table(spark, base, "documents").select("doc_id", "text", "lang")
    model = language.train_language(docs)
    return language.predict_language(docs.drop("lang"), model).select(
        "doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "accepted"
    )


QUERIES["op3_language"] = op3_language


RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


# Names below which the hosts of the given pages are unrelated.
SHARED_SUFFIXES = ("example.com", "example.net", "example.org")


def op1_host_reputation(spark: SparkSession, base: str) -> DataFrame:
    """Every page judged by the rules, else by its host's reputation.

    The outcome of a page is the quality of the document that has its number.
    """
    outcomes = table(spark, base, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    pages = table(spark, base, "pages").select("page_id", "url")
    judged = reputation.judge(pages, outcomes, RULES, suffixes=(*SHARED_SUFFIXES, *reputation.SUFFIXES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


QUERIES["op1_host_reputation"] = op1_host_reputation
SQL["op1_host_reputation"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), placed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
), rules(name, start, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), known(name) AS (
  VALUES ('example.com'), ('example.net'), ('example.org'), ('co.uk'), ('com.au'), ('co.jp')
), hosts AS (
  SELECT host, count(quality) AS n, coalesce(sum(quality), 0) AS good
  FROM placed LEFT JOIN labels ON page_id = doc_id GROUP BY host
), suffixed AS (
  SELECT h.*, coalesce((SELECT arg_max(name, length(name)) FROM known WHERE h.host = name OR suffix(h.host, '.' || name)),
                       string_split(h.host, '.')[-1]) AS suffix FROM hosts h
), named AS (
  SELECT *, CASE WHEN length(host) <= length(suffix) THEN host
       ELSE string_split(substr(host, 1, length(host) - length(suffix) - 1), '.')[-1] || '.' || suffix END AS domain
  FROM suffixed
), domains AS (
  SELECT suffix, domain, sum(n) AS dn, sum(good) AS dg FROM named GROUP BY suffix, domain
), suffixes AS (
  SELECT suffix, sum(dn) AS sn, sum(dg) AS sg FROM domains GROUP BY suffix
), total AS (
  SELECT coalesce(sum(sn), 0) AS tn, coalesce(sum(sg), 0) AS tg FROM suffixes
), children AS (
  SELECT 1 AS level, sn AS n, sg AS good, (tg + 1) / (tn + 2) AS mean FROM suffixes, total
  UNION ALL SELECT 2, dn, dg, (sg + 1) / (sn + 2) FROM domains JOIN suffixes USING (suffix)
  UNION ALL SELECT 3, n, good, (dg + 1) / (dn + 2) FROM named JOIN domains USING (suffix, domain)
), spread AS (
  SELECT level, (sum(n * (good / n - mean) ** 2 / (mean * (1 - mean))) - count(*)) / nullif(sum(n - 1), 0) AS r
  FROM children WHERE n > 0 GROUP BY level
), strength AS (
  SELECT level, CASE WHEN r IS NULL OR r <= 0 THEN 10000.0::DOUBLE ELSE least(10000.0, greatest(1.0, (1 - r) / r)) END AS c
  FROM (SELECT unnest([1, 2, 3]) AS level) LEFT JOIN spread USING (level)
), step0 AS (
  SELECT *, (tg - sg + 1) / (tn - sn + 2) AS m0, tn - sn + 2 AS k0
  FROM named JOIN domains USING (suffix, domain) JOIN suffixes USING (suffix), total
), step1 AS (
  SELECT *, least(c, k0) AS p1, (sg - dg + least(c, k0) * m0) / (sn - dn + least(c, k0)) AS m1, sn - dn + least(c, k0) AS k1
  FROM step0, (SELECT c FROM strength WHERE level = 1)
), step2 AS (
  SELECT * EXCLUDE (c), (dg - good + least(d, k1) * m1) / (dn - n + least(d, k1)) AS m2, dn - n + least(d, k1) AS k2
  FROM step1, (SELECT c AS d FROM strength WHERE level = 2)
), ab AS (
  SELECT host, (good + least(e, k2) * m2) / (n + least(e, k2)) AS mean, n + least(e, k2) AS known
  FROM step2, (SELECT c AS e FROM strength WHERE level = 3)
), judged AS (
  SELECT host, CASE WHEN mean + 1.645 * sqrt(mean * (1 - mean) / (known + 1)) < 0.5 THEN 'block' ELSE 'allow' END AS verdict
  FROM ab
), best AS (
  SELECT p.page_id, p.host, p.path, arg_max(r.name || r.start, length(r.name || r.start)) AS rule,
         arg_max(r.verdict, length(r.name || r.start)) AS by_rule
  FROM placed p LEFT JOIN rules r ON (p.host = r.name OR suffix(p.host, '.' || r.name)) AND starts_with(p.path, r.start)
  GROUP BY p.page_id, p.host, p.path
)
SELECT page_id, host, path, rule, coalesce(by_rule, verdict, 'allow') AS verdict FROM best LEFT JOIN judged USING (host)
"""


def op2_main_text(spark: SparkSession, base: str) -> DataFrame:
    """Main text of every page by tree scoring."""
    return main_text.extract(table(spark, base, "pages").select("page_id", "url", "html"))


QUERIES["op2_main_text"] = op2_main_text


def op11_packing(spark: SparkSession, base: str) -> DataFrame:
    """Every text cut into pieces that fill sequences of 4096 tokens."""
    docs = table(spark, base, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), ids=None)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES["op11_packing"] = op11_packing


# crc32 of ASCII text in SQL, byte by byte with the usual table of 256 entries.
_CRC_SQL = """crc AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT] || range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))
)"""


def _crc_sql(key: str) -> str:
    codes = f"list_transform(string_split({key}, ''), lambda ch: ascii(ch)::BIGINT)"
    folded = f"list_reduce([4294967295] || {codes}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))"
    return f"xor({folded}, 4294967295)"


def op12_repair(spark: SparkSession, base: str) -> DataFrame:
    """Every conversation, damaged by rule, with its faults, the cheapest edits and the digest of the result."""
    rows = repair.prepared(repair.damaged(table(spark, base, "conversations")), gone=F.col("gone"))
    audits = written(repair.audits(rows), "audits")
    made = repair.digests(repair.repaired(rows, audits)).withColumnRenamed("conv_id", "__conv")
    return audits.join(made, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").select(
        *audits.columns, F.coalesce("sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256")
    )


QUERIES["op12_repair"] = op12_repair


def _way(state: str, cost: str, edits: str) -> str:
    """A way as text: its cost in nine digits, then its audit; some more cost and edits added."""
    return f"lpad((left({state}, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{edits}'"


def _repair_step() -> str:
    """The ways to the four states after a row, from those before it; the row is kept, given a role, or deleted."""
    may = "CASE WHEN NOT go THEN {} END"
    first = [[_way(f"s{q}", "3", "D")] for q in range(4)]
    for state, role, before in ((1, "s", [0]), (2, "u", [0, 1, 3]), (3, "a", [2])):
        for q in before:
            first[state].append(f"CASE WHEN NOT go AND initial = '{role}' THEN {_way(f's{q}', 'extra', 'K')} END")
            if role != "s":
                first[state].append(may.format(_way(f"s{q}", "2 + extra", "R")))
    return ", ".join(f"least({', '.join(ways)}, NULL) AS q{q}" for q, ways in enumerate(first))


# Then rows may be inserted.
_INSERTED = f"""q0 AS s0, q1 AS s1, least(q2, {_way("q0", "2", "I")}, {_way("q1", "2", "I")}, {_way("q3", "2", "I")}) AS s2,
  least(q3, {_way("q2", "2", "I")}, {_way("q0", "4", "II")}, {_way("q1", "4", "II")}) AS s3"""

SQL["op12_repair"] = f"""
WITH RECURSIVE {_CRC_SQL}, hits AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS hit
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hits WHERE hit <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS n,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM damaged
), flagged AS (
  SELECT conv_id, turn, role, text, n, left(role, 1) AS initial, last = '' AS blank,
         last <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS duplicate,
         last <> '' AND last NOT IN ('.', '!', '?') AS unended,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
  FROM numbered
), rows_ AS (
  SELECT *, blank OR duplicate AS go, (unended AND NOT duplicate)::INTEGER AS extra FROM flagged
), convs AS (
  SELECT DISTINCT conv_id FROM conversations
), start AS (
  SELECT conv_id, '000000000' AS q0, NULL::VARCHAR AS q1, NULL::VARCHAR AS q2, NULL::VARCHAR AS q3 FROM convs
), ways AS (
  SELECT conv_id, 0::BIGINT AS n, {_INSERTED} FROM start
  UNION ALL
  SELECT conv_id, n, {_INSERTED} FROM (
    SELECT w.conv_id, r.n, {_repair_step()} FROM ways w JOIN rows_ r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.n = w.n + 1)
), ends AS (
  SELECT conv_id, arg_max(least(s0, s3), n) AS best FROM ways GROUP BY conv_id
), audits AS (
  SELECT conv_id, left(best, 9)::BIGINT AS cost, substr(best, 10) AS audit FROM ends
), edits AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS i FROM audits WHERE audit <> ''
), placed AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER so_far AS n, count(*) FILTER (edit <> 'D') OVER so_far AS m FROM edits
  WINDOW so_far AS (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), joined AS (
  SELECT p.*, r.role, r.text, max(CASE WHEN m = 1 AND edit = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS heads
  FROM placed p LEFT JOIN rows_ r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND p.n = r.n AND p.edit <> 'I'
  WHERE edit <> 'D'
), digests AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - heads) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || coalesce(text, ''), chr(10) ORDER BY i)) AS digest
  FROM joined GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, sum(extra)::BIGINT AS truncated, count(*) FILTER (illegal) AS illegal
  FROM rows_ GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM audits a LEFT JOIN counts c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN digests d ON a.conv_id IS NOT DISTINCT FROM d.conv_id
"""


def op13_prefix_trie(spark: SparkSession, base: str) -> DataFrame:
    """The trie of all conversations, each rebuilt with the first turns of its base."""
    turns = prefix_trie.turns_of(table(spark, base, "conversations"))
    return prefix_trie.trie(turns, prefix_trie.rebuilt_heads(turns))


QUERIES["op13_prefix_trie"] = op13_prefix_trie
SQL["op13_prefix_trie"] = rf"""
WITH {_CRC_SQL}, turns AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT conv_id, x, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS n FROM turns
), convs AS (
  SELECT conv_id, {_crc_sql("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, n, x, words FROM convs c JOIN numbered t ON t.conv_id = c.conv_id - c.conv_id % 20 WHERE n <= h
  UNION ALL SELECT c.conv_id, 1, n, x, words FROM convs c JOIN numbered t USING (conv_id) WHERE n > h
), paths AS (
  SELECT conv_id, words, string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY part, n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS key
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, '' FROM convs
), nodes AS (
  SELECT key, len(key) // 32 AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM paths GROUP BY key
), children AS (
  SELECT left(key, len(key) - 32) AS key, count(*) AS n_children FROM nodes WHERE key <> '' GROUP BY 1
), counted AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (key)
), shares AS (
  SELECT left(key, 32 * unnest(range(depth + 1))) AS key, (n_children = 0)::BIGINT AS leaf, (n_convs - 1) * words AS saved FROM counted
), totals AS (
  SELECT key, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM shares GROUP BY key
), ends AS (
  SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest
  FROM (SELECT conv_id, arg_max(key, len(key)) AS key FROM paths GROUP BY conv_id) GROUP BY key
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM counted c JOIN totals USING (key) LEFT JOIN ends USING (key)
LEFT JOIN nodes p ON c.key <> '' AND p.key = left(c.key, len(c.key) - 32)
"""
