"""The named queries of the corpus operators over the shared tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    filter_audit, language, minhash, mixing, ngram_join, packing, page_text, pii, secret_scan, sharding, spelling, token_store,
    topk,
)
from millrace.session import scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = _table(spark, sf_dir, "documents"), scratch(spark, "ledger")
    # Two deliveries into one ledger, the older ids and then all other rows: a blob that the first had is not scanned again.
    middle = docs.approxQuantile("doc_id", [0.5], 0.01)
    older = F.coalesce(F.col("doc_id") <= F.lit(middle[0] if middle else None), F.lit(False))
    for delivery in (docs.where(older), docs.where(~older)):
        secret_scan.extend(delivery, ledger)
    found = secret_scan.report(docs, ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in secret_scan.BASE]
    digest = F.sha2(secret_scan.written(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_scan.written(F.col("spans")).alias("spans"), "blob")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-store")
    token_store.write(_table(spark, sf_dir, "documents"), path)
    return token_store.read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row",
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(_table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints_with_next(_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    profiles = language.train(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language.predict(profiles, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


OP8_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash
  FROM documents),
stats AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words, row_number() OVER (ORDER BY source NULLS LAST) AS number
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (number - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight FROM stats),
ratios AS (SELECT *, words * 3e0 / weight AS ratio FROM weighed),
levels AS (
  SELECT *, (sum(words) OVER () - coalesce(sum(words * 3) OVER (ORDER BY ratio, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0)) AS level
  FROM ratios),
chosen AS (SELECT arg_min(level, (ratio, number)) AS level_all FROM levels WHERE level <= ratio),
targets AS (
  SELECT source, words, least(CAST(words * 3 AS DOUBLE), coalesce(level_all * weight, CAST(words * 3 AS DOUBLE))) AS target
  FROM levels CROSS JOIN chosen),
placed AS (
  SELECT s.*, t.words, t.target, CASE WHEN t.words > 0 THEN t.target / t.words ELSE 0e0 END AS rate,
    CAST('0x' || md5('1:source:' || coalesce(s.source, ''))[1:5] AS BIGINT) / 1048576e0 AS u,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.hash, s.doc_id) AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, words AS source_size, target,
  CAST(least(floor(rate * place + u) - floor(rate * (place - 1) + u), 3) AS BIGINT) * size AS taken
FROM placed
"""

def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components_of(_table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
single AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 90 * (x.n + y.n - s.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT z.doc_id, z.n AS n_shingles, min(r.b) AS component_id
FROM sizes z JOIN reach r ON r.a = z.doc_id GROUP BY z.doc_id, z.n
"""


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(_table(spark, sf_dir, "pages"), page_text.train(page_text.labelled(spark)))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    coalesce(min(doc_id) OVER (PARTITION BY coalesce(text, '')) < doc_id, false) AS later
  FROM documents),
failed AS (
  SELECT doc_id, part,
    CAST(len(w) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INTEGER)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER) + 16 * CAST(later AS INTEGER) AS mask
  FROM docs),
marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
cells AS (
  SELECT f.part, f.mask, count(*) AS n, coalesce(sum(m.good), 0) AS good, coalesce(sum(m.toxic), 0) AS toxic
  FROM failed f LEFT JOIN marks m ON m.doc_id = f.doc_id GROUP BY f.part, f.mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND a.c <> b.c AND a.c <> c.c AND a.c <> d.c AND a.c <> e.c AND b.c <> c.c AND b.c <> d.c AND b.c <> e.c
    AND c.c <> d.c AND c.c <> e.c AND d.c <> e.c),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS earlier
  FROM orders, unnest([1, 2, 3, 4, 5]) AS s(step))
SELECT part, filter_order, step,
  CAST(coalesce(sum(n) FILTER (mask & (bit | earlier) = 0), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier <> 0), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & bit <> 0), 0) AS BIGINT) AS shapley
FROM cells, steps GROUP BY part, filter_order, step
"""

QUERIES = {
    q.__name__: q
    for q in (
        op1_secret_scan, op2_token_store, op3_sharding, op4_pii, op5_minhash,
        op6_language, op7_packing, op8_topk, op9_mixing, op10_ngram_join,
        op11_spelling, op12_page_text, op13_filter_audit,
    )
}
SQL = {"op8_topk": OP8_SQL, "op9_mixing": OP9_SQL, "op10_ngram_join": OP10_SQL, "op13_filter_audit": OP13_SQL}
