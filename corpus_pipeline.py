"""A training corpus from raw documents, in five stages over the operators of ``tillroll.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; ``run`` writes each result as
Parquet in the shared folder and rereads it, so a lost executor repeats one stage at most.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontamination, jaccard_join, lexicon, pseudonyms, quality
from tillroll.llm.batches import with_small_batches
from tillroll.llm.queries import PSEUDONYM_KEY, documents_of, table
from tillroll.sinks.scratch import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the hard limits or lie outside their group's ellipsoid go."""
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; ``n_chars`` follows the text, since addresses may change length."""
    replaced = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, with_counts=False)
    return replaced.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids; ``lossless`` says that decoding gives the text back."""
    return lexicon.encode_and_decode(docs, lexicon.compile_lexicon(docs)).select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def with_bounded_batches(stage):
    """``stage`` in a session whose Arrow batches are sized for whole texts."""
    return lambda spark, docs, sf_dir: stage(with_small_batches(spark), docs, sf_dir)


STAGES = [
    ("quality rules", with_bounded_batches(quality_rules)),
    ("n-gram Jaccard join", with_bounded_batches(near_duplicates)),
    ("benchmark decontamination", with_bounded_batches(benchmark_decontamination)),
    ("PII", with_bounded_batches(pii_pseudonyms)),
    ("BPE encoding and decoding", with_bounded_batches(bpe_encoding)),
]

#: Outlier estimates, connected components and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents_of(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
