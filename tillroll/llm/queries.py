"""The registered queries of this subpackage, with production parameters over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    backoff_lm,
    chaining,
    decontamination,
    hard_negatives,
    jaccard_join,
    language_id,
    lexicon,
    piece_encoding,
    pseudonyms,
    quality,
    suffix_dedup,
    token_counts,
    whitening,
)
from tillroll.llm.batches import with_small_batches

#: The key of the registered queries; a deployment passes its own secret.
PSEUDONYM_KEY = b"tillroll demonstration key"


def documents_of(spark: SparkSession, folder: str) -> DataFrame:
    return table(with_small_batches(spark), folder, "documents")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents_of(spark, folder))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.held_out_predictions(documents_of(spark, folder))


def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.removed_spans(documents_of(spark, folder)))


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents_of(spark, folder))


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return backoff_lm.held_out_scores(documents_of(spark, folder))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdicts(documents_of(spark, folder))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chaining.shared_passages(documents_of(spark, folder))


def op8_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return lexicon.digest(lexicon.round_trip(documents_of(spark, folder)))


def op9_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    documents = documents_of(spark, folder).select("doc_id", "text")
    return pseudonyms.pseudonymise(documents, PSEUDONYM_KEY)


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(documents_of(spark, folder), table(spark, folder, "benchmark"))
    return decontamination.digest(found)


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def op12_sentencepiece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return piece_encoding.digest(piece_encoding.round_trip(documents_of(spark, folder)))


def op13_hard_negative_mining(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def queries():
    return {
        "op1_token_counts": op1_token_counts,
        "op2_language_id": op2_language_id,
        "op3_suffix_array_dedup": op3_suffix_array_dedup,
        "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_quality_rules": op6_quality_rules,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_bpe_encoding": op8_bpe_encoding,
        "op9_pii_pseudonyms": op9_pii_pseudonyms,
        "op10_benchmark_decontamination": op10_benchmark_decontamination,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_sentencepiece_encoding": op12_sentencepiece_encoding,
        "op13_hard_negative_mining": op13_hard_negative_mining,
    }


#: Scores of all rows against the anchors, then ranks; as whole numbers throughout.
HARD_NEGATIVES = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


#: Windows of all items, and those of the same sizes of all documents, joined as text.
DECONTAMINATION = r"""
WITH d AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
i AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS form
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
),
doc_windows AS (
  SELECT place, size, k, array_to_string(w[k : k + size - 1], ' ') AS form
  FROM (SELECT place, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM d JOIN (SELECT DISTINCT size FROM item_windows) sizes ON len(w) >= size)
),
found AS (SELECT place, size, k, item_id FROM doc_windows JOIN item_windows USING (size, form)),
hit AS (
  SELECT place, count(DISTINCT word) AS n_hit
  FROM (SELECT place, unnest(range(k, k + size)) AS word FROM (SELECT DISTINCT place, k, size FROM found))
  GROUP BY place
),
named AS (
  SELECT place, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT place, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY place
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (place) LEFT JOIN named USING (place)
"""


#: 50-byte strings of each text as hexadecimal digits, and the smallest id that holds each. A removed run ends where the
#: next covered string begins beyond the end of the one before.
SUFFIX_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS place, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT place, doc_id, k, substr(h, 2 * k + 1, 100) AS s
  FROM (SELECT place, doc_id, h, unnest(range(0, CAST(len(h) // 2 AS BIGINT) - 49)) AS k FROM d WHERE len(h) >= 100)
),
firsts AS (SELECT s, min(doc_id) AS first_id FROM strings GROUP BY s HAVING count(*) > 1),
covered AS (
  SELECT place, k, lag(k) OVER (PARTITION BY place ORDER BY k) AS before
  FROM strings JOIN firsts USING (s) WHERE first_id < doc_id
),
runs AS (
  SELECT place, min(k) AS a, max(k) + 50 AS b
  FROM (SELECT place, k, sum(CASE WHEN before IS NULL OR k > before + 50 THEN 1 ELSE 0 END)
                           OVER (PARTITION BY place ORDER BY k) AS run FROM covered)
  GROUP BY place, run
),
kept AS (
  SELECT place, b AS a, lead(a) OVER (PARTITION BY place ORDER BY a) AS b FROM runs
  UNION ALL SELECT place, 0, min(a) FROM runs GROUP BY place
),
joined AS (
  SELECT place, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' ORDER BY a) AS h
  FROM kept JOIN d USING (place) GROUP BY place
),
sums AS (SELECT place, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY place)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(joined.h, d.h))) AS kept_sha256
FROM d LEFT JOIN sums USING (place) LEFT JOIN joined USING (place)
"""


def oracles() -> dict[str, str]:
    return {
        "op3_suffix_array_dedup": SUFFIX_DEDUP,
        "op10_benchmark_decontamination": DECONTAMINATION,
        "op13_hard_negative_mining": HARD_NEGATIVES,
    }
