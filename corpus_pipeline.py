"""The training-data pipeline: language ID, near-dedup, decontamination, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import decontaminate, languages, packing, secrets, simhash
from pagemill.llm.common import Scratch, small_batches

#: A fixed choice: five words to a shingle for near duplicates, linked at this similarity.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def bounded(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage in small Arrow batches: all stages share the executors and their Python workers, where large ones add up."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@bounded
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (a null or empty text, or one without a letter); ``lang`` becomes the language found.

    The model is fitted on the stage's own labelled rows. A mixed-language document keeps its main language.
    Repeated rows are judged row by row. Where no row is labelled, nothing can be learned: documents with
    letters stay, with the null language they have.
    """
    model = languages.fit(docs)
    found = languages.identify(docs, model, out=("_lang", "_share", "_spans"), spans=False)
    if model.langs == ["und"]:
        return found.where(F.col("text").rlike(r"\p{L}")).select(*docs.columns)
    kept = found.where("_lang <> 'und'").withColumn("lang", F.col("_lang"))
    return kept.select(*docs.columns)


@bounded
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the document with the smallest id; of equal rows one.

    SimHash fingerprints of sets of five-word shingles propose pairs, and MinHash keys those that two bits do not reach;
    a pair links at a Jaccard similarity of 0.8 or more, decided by the whole sets. Null,
    empty and blank texts are one group; rows of one id with different texts are judged text by text,
    and all of them stay where they hold a group's smallest id. Documents with a null id are never dropped.
    """
    found = simhash.near_duplicates(docs, words_in_shingle=SHINGLE_WORDS, similarity=SIMILARITY)
    first = found.where("doc_id = component").select("doc_id").distinct()
    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return rows.join(first, "doc_id", "left_semi").select(*docs.columns).union(docs.where("doc_id is null"))


@bounded
def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item within its error budget.

    Null and empty texts hold none and stay; repeated rows are judged row by row.
    """
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


@bounded
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; each secret in its text becomes ``[SECRET]`` and ``n_chars`` follows."""
    masked = secrets.redact_secrets(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


@bounded
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens, see ``pack_documents``; a null or empty text is one piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate_benchmark),
    ("secret_masking", mask_secrets),
    ("packing", pack),
]

#: The stages (language model, fingerprints, edit distances, tokens) are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; a stage's table goes when the next is written."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for _, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
