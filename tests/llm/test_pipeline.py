"""The pipeline against its stages done one text at a time, and the queries as they are registered."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_texts import DOCS, JSON, OTHER, RANKS, TEXTS, brute_join, near_copies

import corpus_pipeline
from gridpulse.llm import packing, quality, secrets


def brute_force(texts):
    """The pieces of what all stages keep."""
    measured = {i: quality.measure(t) for i, t in texts.items()}
    names = [c.split()[0] for c in quality.COLUMNS.split(", ")]
    kept = {i: m[names.index("clean_text")] for i, m in measured.items() if m[names.index("kept")]}
    groups = defaultdict(list)
    for i, t in kept.items():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
    kept = {i: kept[i] for i in map(min, groups.values())}
    kept = {i: kept[i] for i, (_, low, _) in brute_join(kept).items() if i == low}
    encoder, want = packing.ByteLevelEncoder(JSON, RANKS), Counter()
    for i, t in kept.items():
        ids = encoder.ids(secrets.examine(t, RANKS)[-1]) + packing.packed([2])
        for k, (start, n) in enumerate(packing.cut(len(ids) // 4, packing.CAPACITY)):
            want[i, k, start, n, zlib.crc32(ids[4 * start:4 * (start + n)])] += 1
    return want


def test_pipeline(spark, tmp_path):
    texts = near_copies(1, groups=3, size=8)
    texts |= {900: OTHER + "\npassword = 'abcdefgh12'", 901: "Menu | About | News | Jobs\n" + OTHER, 902: "a| b| c| d| e| f| g| h| i| j| k| l|"}
    rows = [(i, t, None, "s", None) for i, t in texts.items()] + [(900, texts[900], None, "s", None)]
    frame = spark.createDataFrame(rows, DOCS)
    for name in ("kept", "digest", "redacted", "rank", "_id"):
        frame = frame.withColumn(name, F.lit("clash"))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == brute_force(texts)
    assert {i for i, *_ in brute_force(texts)} & {*TEXTS, 900, 901}


def test_stages_return_documents(spark):
    docs = spark.createDataFrame([(1, OTHER, "en", "s", 3), (2, None, None, None, None)], DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert [(r.doc_id, r.text, r.n_chars) for r in docs.collect()] == [(1, OTHER, len(OTHER))]


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op3_quality_rules", "op4_html_extraction", "op5_warc", "op6_substring_dedup", "op9_ngram_jaccard_join", "op10_exact_dedup"])
def test_queries_agree_with_sql(spark, name):
    import duckdb

    import __spark_entry__ as contract
    from check_oracles import TABLES, difference

    folder, duck = "/root/testdata/sf0.001", duckdb.connect()
    for table in TABLES.split():
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    assert difference(contract.queries()[name](spark, folder).toPandas(), duck.sql(contract.oracle_sql()[name]).df()) is None
