"""The registered queries of the operators over the test tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagtable.llm import archives, decontamination, fingerprints, hard_negatives, jaccard, mixing, quality, secrets, sharding, spelling, token_counts, token_files, trie_dedup
from tagtable.llm.store import table
from tagtable.llm.tokenizer import public_path
from tagtable.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@registered
def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.classes(table(spark, folder, "documents"), k=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op1_jaccard_join"] = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS g
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, e.y FROM reached r JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) e ON r.other = e.x
), least AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""


@registered
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark)
    token_files.write_tokens(table(spark, folder, "documents"), path, public_path("word_bpe_49k.json"), end_id=2)
    return token_files.checksums(token_files.read_tokens(spark, path))


@registered
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    kinds = [rule.kind for rule in secrets.BASE]
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    base = F.filter("spans", lambda s: s.kind.isin(kinds))
    of_kind = F.transform("spans", lambda s: s.kind)
    counts = [F.size(F.filter(of_kind, lambda k: k == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in kinds]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


@registered
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"))


SQL["op4_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        ([3, 1, 2])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM sized GROUP BY source
), filled AS (
    SELECT *, source_size * 2.0::DOUBLE AS cap,
        sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(source_size * 2.0::DOUBLE) OVER (
                ORDER BY source_size * 2.0::DOUBLE / weight, source ASC NULLS FIRST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (
            ORDER BY source_size * 2.0::DOUBLE / weight, source ASC NULLS FIRST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM totals
), level AS (
    SELECT rest, weights FROM filled WHERE weight * rest <= cap * weights ORDER BY weights DESC LIMIT 1
), targets AS (
    SELECT f.source, f.source_size,
        CASE WHEN l.weights IS NULL THEN f.cap ELSE least(f.cap, f.weight * l.rest / l.weights) END AS target
    FROM filled f LEFT JOIN level l ON true
), planned AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), run AS (
    SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS budget,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto, s.h, s.source
    FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
), cut AS (
    SELECT source, min(h) AS threshold FROM run WHERE upto > budget GROUP BY source
)
SELECT r.doc_id, r.size, r.source_size, r.target,
    (r.size * (r.whole + CASE WHEN r.h < c.threshold THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run r LEFT JOIN cut c ON r.source IS NOT DISTINCT FROM c.source
"""


@registered
def op5_archives(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark)
    archives.write_archives(table(spark, folder, "pages"), path)
    return archives.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op5_archives"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, ''))::BIGINT AS n
    FROM pages
), w AS (
    SELECT d, max(page_id) AS winner FROM p WHERE n >= 1000 GROUP BY d HAVING count(*) > 1
)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
    CASE WHEN winner IS NULL OR winner IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN winner IS DISTINCT FROM page_id THEN winner END AS refers_to
FROM p LEFT JOIN w ON p.d = w.d AND p.n >= 1000
"""


@registered
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


SQL["op6_decontamination"] = rf"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r,
        coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
    SELECT item_id, coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS g
    FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i
          FROM b WHERE len(w) > 0)
), own AS (
    SELECT r, n, i, list_slice(w, i, i + n - 1) AS g
    FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
          FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
    SELECT own.r, own.i, own.n, item_id FROM own JOIN windows ON own.n = windows.n AND own.g = windows.g
), covered AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r
), items AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""


@registered
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, folder, "documents"), public_path("piece_bpe_32k.model"))
    return token_counts.over_limit(counts, 4096)


@registered
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose id is divisible by 50 also tell how many other rows are within 6 of 128 bits."""
    rows = fingerprints.compared_with_next(table(spark, folder, "documents"))
    own, edited, following = ((F.col(f"{x}1"), F.col(f"{x}2")) for x in "fen")
    told = fingerprints.searched(rows, F.col("doc_id") % 50 == 0)
    return told.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.hexadecimal(*own).alias("fingerprint"),
        fingerprints.hexadecimal(*edited).alias("edited_fingerprint"),
        fingerprints.likeness(own, edited).alias("near_edited"),
        fingerprints.likeness(own, following).alias("near_next"),
        "n_within",
    )


@registered
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, folder, "labels")))


@registered
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@registered
def op11_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = trie_dedup.classes(table(spark, folder, "documents"))
    return found.select("doc_id", trie_dedup.hexadecimal(F.col("f")).alias("fingerprint"), "component_id")


@registered
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(table(spark, folder, "documents"))


@registered
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


SQL["op13_hard_negatives"] = """
WITH v AS (
    SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, list_inner_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND len(a.e) = len(b.e)
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike AND other_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3
"""
