"""Queries over the text operators, each with its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.llm import (
    dedup, disclosure, html, ngram_join, packing, quality, secrets, sentencepieces, spelling, substrings, toxicity, warc, whitening,
)
from gridpulse.llm.common import table
from gridpulse.llm.oracles import (
    DISCLOSURE_SQL, EXACT_DEDUP_SQL, HTML_SQL, JACCARD_SQL, QUALITY_SQL, SPELLING_SQL, SUBSTRING_SQL, WARC_SQL,
)
from gridpulse.plans.registry import query
from gridpulse.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SENTENCE_PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document, learned from the labels that are not held out."""
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.pack(table(spark, folder, "documents"), TOKENIZER, RANKS)


@query(QUALITY_SQL)
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict per document."""
    return quality.clean(table(spark, folder, "documents")).drop("clean_text")


@query(HTML_SQL)
def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, folder, "pages"))


@query(WARC_SQL)
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to WARC archives in the shared folder and read back."""
    path = scratch_path(spark, "warc")
    warc.write(table(spark, folder, "pages"), path)
    return warc.checked(spark, path)


@query(SUBSTRING_SQL)
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without its repeated passages, as a digest."""
    return substrings.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, counted and summed up, and whether they decode to the text."""
    return sentencepieces.round_trip(table(spark, folder, "documents"), SENTENCE_PIECES)


@query()
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets per document, from the fixed patterns and from the token-efficiency test."""
    return secrets.scan(table(spark, folder, "documents"), RANKS).drop("redacted")


@query(JACCARD_SQL)
def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Set size, component and number of links per document."""
    return ngram_join.join(table(spark, folder, "documents"))


def older_half(docs: DataFrame):
    """Condition: the id is at most halfway between the smallest and the largest."""
    middle = docs.agg(((F.min("doc_id") + F.max("doc_id")) / 2).cast("long").alias("m")).first()["m"]
    return F.col("doc_id") <= F.lit(middle).cast("long")


@query(EXACT_DEDUP_SQL)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The older half of the ids as history; the newer half is looked up in its perfect hash. Every document gets a verdict."""
    docs = table(spark, folder, "documents")
    return dedup.deduplicate(docs, older_half(docs)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query(SPELLING_SQL)
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Form and root of every frequent word, from its neighbours in a trie over all words."""
    return spelling.variants(table(spark, folder, "documents"))


@query(DISCLOSURE_SQL)
def op12_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: fixed patterns, and terms near them that disclose too much."""
    return disclosure.scan(table(spark, folder, "documents")).select(
        "doc_id", *(f"n_{kind}" for kind in disclosure.PATTERNS),
        F.sha2(disclosure.written(F.col("base")), 256).alias("base_sha256"),
        disclosure.written(F.concat("base", "added")).alias("spans"))


@query()
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable embedding on the first 32 components, whitened by the covariance of all. A deviation beyond a long's range is null here."""
    return whitening.whiten(table(spark, folder, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
