"""Exact deduplication against a minimal perfect hash over the digests seen so far."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.llm.common import SPACES, mixed, stored
from gridpulse.session import ship_package

DIGESTS_PER_SHARD = 100_000
KEYS_PER_BUCKET = 2
NO_ID = 2**63 - 1
SHARD = "shard int, seeds binary, slots binary, winners binary, counts binary"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def distinct_digests(rows: DataFrame) -> DataFrame:
    """One row per digest with its smallest id and number of rows. Copies combine before the shuffle, so no digest is hot."""
    return rows.groupBy("digest").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("winner"), F.count("*").alias("copies"))


def _words_of(digest_bytes: np.ndarray) -> np.ndarray:
    """Digests of shape (n, 32) as (n, 4) integers: word 0 gives the shard, 1 the bucket, 2 and 3 the slot."""
    return np.ascontiguousarray(digest_bytes).view("<u8").reshape(-1, 4)


def _slot(parts: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mixed(parts[:, 2] + seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ parts[:, 3]) % np.uint64(n)).astype(np.int64)


def build_perfect_hash(digest_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds per bucket and the slot of every digest (hash, displace and compress; buckets by falling size).

    All ``n`` distinct digests get different slots in 0..n-1. A bucket tries seeds until its keys fall on free slots; the seed of a
    bucket is all that is stored. The first seed that fits is found for many buckets of one size at a time.
    """
    parts, n = _words_of(digest_bytes), len(digest_bytes)
    buckets = max(1, -(-n // KEYS_PER_BUCKET))
    bucket = (parts[:, 1] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    seeds, slots, taken = np.zeros(buckets, np.uint32), np.full(n, -1, np.int64), np.zeros(n, bool)
    claim = np.empty(n, np.int64)
    for size in range(int(sizes.max(initial=0)), 1, -1):
        waiting, seed = np.flatnonzero(sizes == size), 0
        while len(waiting):
            members = order[starts[waiting][:, None] + np.arange(size)]
            tried = _slot(parts[members.ravel()], np.full(members.size, seed), n).reshape(members.shape)
            ordered = np.sort(tried, axis=1)
            fits = ~taken[tried].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            fitting = np.flatnonzero(fits)
            wanted = tried[fitting]
            # of the buckets that want one slot in this round, the first keeps it
            claim[wanted[::-1].ravel()] = np.repeat(fitting[::-1], size)
            won = fitting[(claim[wanted] == fitting[:, None]).all(axis=1)]
            taken[tried[won].ravel()] = True
            slots[members[won].ravel()] = tried[won].ravel()
            seeds[waiting[won]] = seed
            waiting, seed = np.delete(waiting, won), seed + 1
    # a bucket of one key names its slot itself, marked by the top bit
    single = np.flatnonzero(sizes == 1)
    free = np.flatnonzero(~taken)[:len(single)]
    slots[order[starts[single]]] = free
    seeds[single] = free.astype(np.uint32) | np.uint32(1 << 31)
    return seeds, slots


def lookup(seeds: np.ndarray, slots: np.ndarray, digest_bytes: np.ndarray) -> np.ndarray:
    """Slot of each digest whose 32 bytes equal those in the slot, -1 for the others."""
    n = len(slots)
    if not n or not len(digest_bytes):
        return np.full(len(digest_bytes), -1, np.int64)
    parts = _words_of(digest_bytes)
    seed = seeds[(parts[:, 1] % np.uint64(len(seeds))).astype(np.int64)]
    direct = (seed >> np.uint32(31)).astype(bool)
    at = np.where(direct, (seed & np.uint32(0x7FFFFFFF)).astype(np.int64), _slot(parts, seed, n))
    return np.where((slots[at] == digest_bytes).all(axis=1), at, -1)


def _masked(values: np.ndarray, known: np.ndarray) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(values.astype(np.int64), ~known)


def _matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, 32)


def shard_of(shards: int) -> Column:
    """The shard of a digest, from its first bytes."""
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The index over ``digest, winner, copies`` (distinct digests): one row per shard.

    A slot holds the full digest, the winner's id and the number of copies. Digests are uniform, so shards are even; their number is
    chosen so that each holds about ``DIGESTS_PER_SHARD``, whatever the size of the history.
    """
    ship_package(history.sparkSession)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = _matrix(rows["digest"])
        seeds, at = build_perfect_hash(keys)
        slots, winners, counts = np.empty_like(keys), np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        slots[at], winners[at], counts[at] = keys, rows["winner"].to_numpy(), rows["copies"].to_numpy()
        return pd.DataFrame([(int(rows["shard"].iloc[0]), seeds.tobytes(), slots.tobytes(), winners.tobytes(), counts.tobytes())],
                            columns=["shard", "seeds", "slots", "winners", "counts"])

    return history.withColumn("shard", shard_of(shards)).groupBy("shard").applyInPandas(build, SHARD)


def find_members(batch: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """``digest, winner, copies, old_winner, old_copies``: what the index holds for each distinct digest of the batch (null: not a member)."""
    ship_package(batch.sparkSession)
    kind = "digest binary, winner long, copies long, old_winner long, old_copies long"

    def find(rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({c.split()[0]: [] for c in kind.split(", ")})
        found = np.full(len(rows), -1, np.int64)
        winners = counts = np.zeros(1, np.int64)
        if len(entry):
            seeds, slots, winners, counts = (entry[c].iloc[0] for c in ("seeds", "slots", "winners", "counts"))
            winners, counts = np.frombuffer(winners, np.int64), np.frombuffer(counts, np.int64)
            found = lookup(np.frombuffer(seeds, np.uint32), np.frombuffer(slots, np.uint8).reshape(-1, 32), _matrix(rows["digest"]))
        hit = found >= 0
        return rows[["digest", "winner", "copies"]].assign(
            old_winner=_masked(winners[found], hit),
            old_copies=_masked(counts[found], hit),
        )

    dealt = batch.withColumn("shard", shard_of(shards))
    return dealt.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(find, kind)


def shards_for(distinct: int) -> int:
    return max(1, -(-distinct // DIGESTS_PER_SHARD))


def deduplicate(docs: DataFrame, is_history: Column) -> DataFrame:
    """Verdict on every row of ``docs``: ``doc_id, keep_id, group_size, kept, digest``.

    Rows where ``is_history`` holds came first: their distinct digests make the index. The digests of the other rows, combined
    first, are looked up in it; members join the group of the digest that they equal byte by byte, the others form
    groups of their own. ``keep_id`` is the smallest id of a group.

    Null texts count as empty; texts equal after normalising white space are one group, however many. Rows that share id
    and text share the verdict. Null ids lose to all others; in a group of null ids only, all stay. A null ``is_history`` counts as
    false. Either side may be empty. Columns beside ``doc_id`` and ``text`` (and those of ``is_history``) play no part.
    """
    marked = docs.select("doc_id", F.coalesce(is_history, F.lit(False)).alias("old"), "text")
    rows = stored(marked.select("doc_id", "old", digest(F.col("text")).alias("digest")), "digests")
    history = stored(distinct_digests(rows.filter("old")), "history")
    batch = stored(distinct_digests(rows.filter("NOT old")), "batch")
    shards = shards_for(max(history.count(), batch.count()))
    found = stored(find_members(batch, build_index(history, shards), shards), "found")
    members = found.filter("old_winner IS NOT NULL").select(
        "digest", F.least("winner", "old_winner").alias("winner"), (F.col("copies") + F.col("old_copies")).alias("copies")
    )
    untouched = history.join(members, "digest", "left_anti")
    groups = untouched.unionByName(members).unionByName(
        found.filter("old_winner IS NULL").select("digest", "winner", "copies")
    )
    keep_id = F.when(F.col("winner") != NO_ID, F.col("winner"))
    return rows.join(groups, "digest").select(
        "doc_id", keep_id.alias("keep_id"), F.col("copies").alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "digest"
    )
