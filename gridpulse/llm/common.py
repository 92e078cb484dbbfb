"""What the text operators share: words, hashing, row-wise Arrow stages and stored intermediate tables."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridpulse.session import scratch_path, ship_package

# The six ASCII white-space bytes separate words, as in ``bytes.split``.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; none for null."""
    return text.encode("utf-8").split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def rolling_hashes(hashes: np.ndarray, length: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Rabin-Karp over words modulo 2**64: one value per run of ``length`` neighbours, for all runs at once.

    Runs are put together by doubling: the value of two runs side by side is ``left * base**len(right) + right``.
    """
    n = len(hashes) - length + 1
    if n < 1:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        run, done, power = hashes, 1, base
        rolled, have = None, 0
        while True:
            if length & done:
                if rolled is None:
                    rolled, have = run, done
                else:
                    rolled, have = rolled[:len(run) - have] * np.uint64(power) + run[have:][:len(rolled)], have + done
            if 2 * done > length:
                return mixed(rolled[:n])
            run, done, power = run[:len(run) - done] * np.uint64(power) + run[done:], 2 * done, power * power % 2**64


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.astype(np.uint64).view(np.int64)


@lru_cache(maxsize=2)
def rank_vocabulary(path: str):
    """A byte-level encoding from a file of vocabulary ranks, loaded once per worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_batches(df: DataFrame, rows: Callable[[dict[str, list]], dict[str, list]], schema: str | T.StructType) -> DataFrame:
    """Arrow stage: ``rows`` gets the columns of a batch as Python lists and returns columns named as in ``schema``."""
    ship_package(df.sparkSession)
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                out = rows(batch.slice(at, 1024).to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet to a fresh place in the shared folder and reads it back: computed once, survives lost executors.

    The shuffle files of the write are freed as soon as it is done. ``codec`` is how the files are packed, as the session has it if None.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Deletes tables that :func:`stored` returned. Nothing may read them any more, not even a plan that has yet to run."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


BROADCAST_IDS = 1_000_000


def broadcast_ids(ids: DataFrame) -> DataFrame:
    """``ids`` (one stored column of longs) for broadcast if there are at most ``BROADCAST_IDS`` of them, 8 MB; else for a plain join.

    Only the plan depends on their number; the result is the same.
    """
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


# A key with more than one in so many of all rows is hot: its rows are split into pieces of about that share.
HOT_KEYS = 1000


def join_unique(rows: DataFrame, unique: DataFrame, keys: list[str], counts: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``unique`` (a row per key, or a bounded number) so that no key is the work of one task.

    ``counts`` has the number of ``rows`` per key (``keys, rows_of_key``; more keys are fine). The rows of a hot key are dealt to as many
    pieces as it has thousandths of all rows, but no more than it has rows, by a hash of their columns, and its rows in ``unique`` are copied for
    each piece. At most ``HOT_KEYS`` keys are hot and they have fewer than twice as many pieces, which bounds what is broadcast and copied. Keys must not be null;
    ``counts`` should be stored.
    """
    total = counts.agg(F.sum("rows_of_key")).first()[0] or 0
    hot = F.broadcast(counts.filter(F.col("rows_of_key") * HOT_KEYS > F.lit(total)).select(
        *keys, F.least("rows_of_key", F.ceil(F.col("rows_of_key") * HOT_KEYS / F.lit(max(total, 1)))).cast("int").alias("_pieces")))
    piece = F.when(F.col("_pieces").isNotNull(), F.pmod(F.xxhash64(*rows.columns), F.col("_pieces")).cast("int")).otherwise(F.lit(0))
    dealt = rows.join(hot, keys, "left").withColumn("_piece", piece).drop("_pieces")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    copied = unique.join(hot, keys, "left").withColumn("_piece", copies).drop("_pieces")
    return dealt.join(copied, [*keys, "_piece"], how).drop("_piece")
