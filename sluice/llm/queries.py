"""One query per operator, each over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import divergence, factor_machine, robust_rules, sharding, tag_paths, toxicity, va_file, warc
from sluice.llm.collocations import collocations
from sluice.llm.common import held_out, materialise, table, with_rows
from sluice.llm.decontaminate import find_leaks
from sluice.llm.edit_counts import EditCounts, redactions
from sluice.llm.mixing import plan_mix
from sluice.llm.simhash import simhash_groups

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_tag_paths(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", tag_paths.extract("html").alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op3_warc_transactions(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.write(table(spark, folder, "pages"))
    captures = warc.assemble(materialise(warc.read(spark, archive, with_payload=False), "records"))
    captures = captures.select(
        "capture",
        warc.page_number().alias("page_id"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("original"),
        F.col("response.payload_bytes").alias("own_bytes"),
        F.coalesce("response.payload_sha1", F.replace("response.payload_digest", F.lit("sha1:"), F.lit(""))).alias("payload_digest"),
    )
    captures = materialise(captures, "captures")
    responses = captures.filter("record_type = 'response'").select(
        F.col("capture").alias("original"), F.col("page_id").alias("refers_to"), F.col("own_bytes").alias("original_bytes")
    )
    return captures.join(responses, "original", "left").select(
        "page_id", F.coalesce("own_bytes", "original_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


def op4_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents"))
    return placed.select("doc_id", "bytes", "shard", "depth", "shard_bytes", "shard_docs")


def op5_toxicity_grammar(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.toxicity_score(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op6_factor_machine(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = factor_machine.train(docs, table(spark, folder, "labels"), "quality")
    scored = docs.select("doc_id", held_out().alias("held_out"), factor_machine.quality_score(model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_simhash_bk_trees(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash_groups(table(spark, folder, "documents"), radius=4, shingle=4)
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )


def op8_edit_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document before and after its personal data is replaced."""
    counts = EditCounts(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.select("doc_id", "text", counts.build("text").alias("tree"), redactions("text").alias("edits"))
    docs = docs.withColumn("after", counts.edit("text", "tree", "edits", with_text=False))
    return docs.select(
        "doc_id",
        F.aggregate("tree.tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
        F.size("edits").alias("n_edits"),
        F.col("after.n_tokens").alias("n_tokens_edited"),
        F.col("after.encoded_chars").alias("encoded_chars"),
    )


def op9_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return robust_rules.judge(table(spark, folder, "documents"))


def op10_systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = plan_mix(with_rows(table(spark, folder, "documents")))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op11_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_va_file_topk(spark: SparkSession, folder: str) -> DataFrame:
    return va_file.top_k(table(spark, folder, "embeddings"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_decontaminate,
        op2_tag_paths,
        op3_warc_transactions,
        op4_extendible_sharding,
        op5_toxicity_grammar,
        op6_factor_machine,
        op7_simhash_bk_trees,
        op8_edit_counts,
        op9_robust_outliers,
        op10_systematic_mix,
        op11_divergence_audit,
        op12_va_file_topk,
        op13_collocations,
    )
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op3_warc_transactions"] = """
WITH payloads AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

# The shortest prefix of a document's 60 hash bits whose documents fit into 8 MiB.
ORACLE_SQL["op4_extendible_sharding"] = """
WITH hashed AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
         CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS hash
  FROM documents
), prefixes AS (
  SELECT hash, bytes, d AS depth, hash >> (60 - d) AS prefix FROM hashed, generate_series(0, 40) AS depths(d)
), buckets AS (
  SELECT depth, prefix, CAST(sum(bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs FROM prefixes GROUP BY ALL
), fits AS (
  SELECT * FROM buckets WHERE shard_bytes <= 8388608 OR shard_docs = 1
), placed AS (
  SELECT p.hash, min(p.depth) AS depth FROM prefixes p JOIN fits f ON p.depth = f.depth AND p.prefix = f.prefix GROUP BY p.hash
)
SELECT h.doc_id, h.bytes,
       CASE WHEN p.depth = 0 THEN '' ELSE right(repeat('0', 60) || bin(f.prefix), CAST(p.depth AS INT)) END AS shard,
       CAST(p.depth AS INT) AS depth, f.shard_bytes, f.shard_docs
FROM hashed h JOIN placed p ON h.hash = p.hash
JOIN fits f ON f.depth = p.depth AND f.prefix = h.hash >> (60 - p.depth)
"""

# Water-filled targets, then systematic sampling in the order of size, with the best of 16 offsets of each source.
ORACLE_SQL["op10_systematic_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('0:' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS pick
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources
), levels AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS bound,
         (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(3 * source_size) OVER before, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN bound < level THEN CAST(3 * source_size AS DOUBLE)
              ELSE weight * (SELECT arg_min(level, (bound, coalesce(source, chr(1114111)))) FROM levels WHERE bound >= level) END AS target
  FROM levels
), placed AS (
  SELECT *, sum(units) OVER (PARTITION BY source ORDER BY size, pick, doc_id) AS prefix FROM (
    SELECT s.*, t.source_size, t.target,
           CAST(floor((CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END) * 1000000000) AS HUGEINT) AS units,
           CAST('0x' || substr(md5('0:' || coalesce(s.source, chr(0))), 1, 15) AS BIGINT) % 1000000000 AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
), tried AS (
  SELECT *, (prefix + shift) // 1000000000 - (prefix - units + shift) // 1000000000 AS copies
  FROM (SELECT *, (start + k * 62500000) % 1000000000 AS shift FROM placed, generate_series(0, 15) AS offsets(k))
), chosen AS (
  SELECT source, arg_min(shift, (distance, shift)) AS shift FROM (
    SELECT source, shift, abs(CAST(sum(size * copies) AS DOUBLE) - any_value(target)) AS distance FROM tried GROUP BY source, shift)
  GROUP BY source
)
SELECT t.doc_id, t.size, t.source_size, t.target, CAST(t.size * t.copies AS BIGINT) AS taken
FROM tried t JOIN chosen c ON t.source IS NOT DISTINCT FROM c.source AND t.shift = c.shift
"""

# Every group's probability of every kept term of its language, all pairs of them compared.
ORACLE_SQL["op11_divergence_audit"] = r"""
WITH rows AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), tokens AS (
  SELECT row_id, lang, source, unnest(terms) AS term FROM rows
), kept AS (
  SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3
), kept_counts AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM rows
), counts AS (
  SELECT t.lang, t.source, t.term, count(*) AS n FROM tokens t JOIN kept k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL
), full_counts AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, kc.v
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN kept_counts kc ON kc.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
  SELECT lang, source, term, n,
         1 + CAST(1000000000 AS HUGEINT) * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p FROM full_counts
), q AS (
  SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 1) // (sum(n) OVER (PARTITION BY lang) + v) AS q
  FROM (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM full_counts GROUP BY lang, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), over_used AS (
  SELECT p.lang, p.source, p.term AS item, (p.p - q.q) * (p.p - q.q) // q.q AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q
)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM over_used)
WHERE rank <= 200
"""

# All inner products of the query rows.
ORACLE_SQL["op12_va_file_topk"] = """
WITH rows AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row_id, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY q.row_id ORDER BY list_inner_product(q.ints, c.ints) DESC, c.vec_id NULLS LAST) AS rank
  FROM rows q JOIN rows c ON q.row_id <> c.row_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM scored WHERE rank <= 20
"""

# Every phrase of up to five words at every place of every piece.
ORACLE_SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), spoken AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(words)) AS HUGEINT) AS n FROM spoken GROUP BY lang
), places AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS start FROM spoken
), phrases AS (
  SELECT lang, array_to_string(words[start : start + m - 1], ' ') AS phrase, m
  FROM places, range(1, 6) AS lengths(m) WHERE start + m - 1 <= len(words)
), counts AS (
  SELECT lang, phrase, any_value(m) AS m, CAST(count(*) AS HUGEINT) AS f FROM phrases GROUP BY lang, phrase HAVING count(*) >= 100
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE m >= 2
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, h.f AS l, t.f AS r, s.n, c.k, 1000 * c.f * s.n // (h.f * t.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN counts h ON h.lang = c.lang AND h.phrase = array_to_string(c.words[1 : c.k], ' ')
  JOIN counts t ON t.lang = c.lang AND t.phrase = array_to_string(c.words[c.k + 1 : c.m], ' ')
  JOIN sizes s ON s.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(words[start : start + size - 1], ' ') AS phrase, max(f) AS within
  FROM (SELECT *, unnest(range(1, m)) AS start FROM candidates), range(2, 5) AS sizes(size)
  WHERE size < m AND start + size - 1 <= m GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.within IS NULL OR i.within < b.a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
