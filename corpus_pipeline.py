"""A corpus of documents, from raw text to token ids, in five stages.

Every stage takes what its predecessor kept and returns rows with the columns of ``documents``, in
their order and whatever other columns there are; the last returns the token counts and digests of the
encoded texts. Every stage takes whole texts of any length, and an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fxtape.llm import bpe, cgk, line_dedup, ngram_join, quality_rules
from fxtape.shared import new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go, null and empty texts among them. Each row is judged by
    itself, so repeated rows go or stay together; a null doc_id is judged like any other."""
    return quality_rules.kept(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and similar lines one stays. A document left without a line goes, as others hold all
    its lines, as does one with a null or empty text; n_chars follows the text. Of repeated rows one keeps the
    lines, and of equal lines the one of the smallest doc_id stays."""
    fresh = line_dedup.deduplicated(docs).where(F.col("text").rlike(line_dedup.NOT_BLANK))
    kind = dict(docs.dtypes)["n_chars"]
    return fresh.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 over five-word shingles the one with the smallest
    doc_id stays. Null and empty texts link with nothing and stay; rows that share a doc_id are one document;
    a row with a null doc_id takes no part in links and stays."""
    return ngram_join.first_of_each(docs, size=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, with all rows of their doc_id. Null and empty texts and a
    null doc_id stay; null and empty items are in no text."""
    return cgk.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row, repeated ones too; decoding gives back the texts. A null
    text is an empty one, with no token; other columns are left out."""
    import public_tokenizers

    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("byte-level bpe", token_ids),
]

# Line dedup, the similarity join and the encoding have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
