"""From raw documents to packed training sequences: five stages, each one of the text operators applied to all that the last one kept.

Rows stay rows of ``documents`` up to the last stage: ``doc_id, text, lang, source, n_chars``, other columns are dropped. Nulls: a null text
is an empty one (the first stage rejects it); null ids are carried along; rows equal in id and text are one document after the second stage.
An empty table gives an empty result. Texts are never shortened but by the lines and secrets that a stage removes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridpulse.llm import dedup, ngram_join, packing, quality, secrets
from gridpulse.llm.common import stored, table
from gridpulse.llm.queries import RANKS, TOKENIZER, older_half
from gridpulse.plans.registry import query

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(dedup.NO_ID)).alias("_id")


def _with_text(rows: DataFrame, text: str) -> DataFrame:
    """``COLUMNS`` with another text; its length follows."""
    return rows.withColumn("text", F.col(text)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that failed."""
    return _with_text(quality.clean(docs, ("doc_id", "lang", "source")).filter("kept"), "clean_text")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays, once."""
    stay = dedup.deduplicate(docs, older_half(docs)).filter("kept").select(_id(), "digest")
    keyed = docs.select(*COLUMNS, _id(), dedup.digest(F.col("text")).alias("digest"))
    return keyed.join(stay, ["_id", "digest"], "left_semi").dropDuplicates(["_id", "digest"]).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents (three-word shingles, similarity 0.9 or more, as in op9) the one with the smallest id stays."""
    first = ngram_join.join(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(_id()).distinct()
    return docs.select(*COLUMNS, _id()).join(first, "_id", "left_semi").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by the name of their kind."""
    return _with_text(secrets.scan(docs, RANKS, ("doc_id", "lang", "source")), "redacted")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return packing.pack(docs, TOKENIZER, RANKS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("secret scan", secret_scan),
    ("best-fit packing", best_fit_packing),
]

# Token ids cannot be had in SQL; tests compare the rows of run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


@query(ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The packed sequences of the whole pipeline."""
    return run(spark, folder)
