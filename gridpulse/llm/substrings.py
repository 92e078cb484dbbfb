"""Removal of passages that occur more than once: Rabin-Karp hashes of word windows, counted in Spark.

Windows are hashed where the text is and counted by hash. Before they are shuffled, windows that cannot repeat are set aside by their
anchors: the anchor of a window is its smallest run of ``ANCHOR_WORDS`` words (by hash, the leftmost of equal ones), found at the same
place in every equal window. An anchor that stands at one place of the whole corpus belongs to windows that are unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gridpulse.llm.common import mixed, rolling_hashes, signed, stored, word_hashes, words
from gridpulse.session import ship_package

WINDOW_WORDS = 35
ANCHOR_WORDS = 8
_PLACE_BITS = np.uint64(20)
WHOLE = -1


def window_anchors(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``anchor`` words, and for every window the place of its smallest run.

    Runs are compared by the upper bits of their hashes, so that the place fits below; of equal ones the leftmost is taken.
    """
    runs = rolling_hashes(hashes, anchor)
    span = window - anchor + 1
    if len(runs) < span:
        return runs, np.empty(0, np.int64)
    block, out = 1 << int(_PLACE_BITS), []
    for low in range(0, len(runs) - span + 1, block - span + 1):  # longer texts in overlapping blocks
        own = runs[low:low + block]
        least = own >> _PLACE_BITS << _PLACE_BITS | np.arange(len(own), dtype=np.uint64)
        size = 1
        while 2 * size <= span:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        if size < span:
            least = np.minimum(least[:len(least) - (span - size)], least[span - size:])
        out.append((least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64) + low)
    return runs, np.concatenate(out)


def text_keys(tokens: list[bytes]) -> tuple[int, int]:
    """Two 64-bit keys of a sequence of words, as Spark's longs: one to join by, one that tells apart what shares the first."""
    text = b" ".join(tokens)
    return tuple(int(k) for k in signed(np.asarray([xxhash.xxh3_64_intdigest(text, seed) for seed in (7, 8)], np.uint64)))


def text_key(tokens: list[bytes]) -> int:
    return text_keys(tokens)[0]


def window_hashes(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two Rabin-Karp hashes of every window, over differently mixed words and with different bases: 128 bits in all."""
    return rolling_hashes(hashes, window), rolling_hashes(mixed(hashes ^ np.uint64(0xD1B54A32D192ED03)), window, 0xC2B2AE3D27D4EB4F)


def covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``: the maximal removal intervals, as a mask."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return np.cumsum(edges[:-1]) > 0


def _stage(df: DataFrame, fields: list[tuple[str, pa.DataType]], schema: str, rows) -> DataFrame:
    """``rows(part)`` turns a few columns (dict of lists) into column values; at most 256 texts at a time."""
    ship_package(df.sparkSession)
    kinds = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k.type) for c, k in zip(rows(batch.slice(at, 256).to_pydict()), kinds)], schema=kinds)

    return df.mapInArrow(run, schema)


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """``anchor, key, place``: every anchor of every text that has a window."""

    def rows(part):
        found, keys, places = [], [], []
        for text in part["text"]:
            tokens = words(text)
            if len(tokens) >= window:
                runs, at = window_anchors(word_hashes(tokens), window, anchor)
                at = np.unique(at)
                found.append(signed(runs[at]))
                places.append(at)
                keys.append(np.full(len(at), text_key(tokens), np.int64))
        return _joined(found, np.int64), _joined(keys, np.int64), _joined(places, np.int64).astype(np.int32)

    kinds = [("anchor", pa.int64()), ("key", pa.int64()), ("place", pa.int32())]
    return _stage(docs.select("text"), kinds, "anchor long, key long, place int", rows)


def keyed(docs: DataFrame, window: int) -> DataFrame:
    """``key, other, text`` of the texts that have a window."""

    def rows(part):
        own = [(*text_keys(tokens), t) for t in part["text"] if len(tokens := words(t)) >= window]
        return [list(c) for c in zip(*own)] if own else [[], [], []]

    return _stage(docs.select("text"), [("key", pa.int64()), ("other", pa.int64()), ("text", pa.string())], "key long, other long, text string", rows)


def candidate_windows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """``hash, other, key, start, weight`` of the windows whose anchor repeats; of texts with copies only for the count (``start`` null), and
    one row with ``start`` -1 that stands for all their words."""

    def rows(part):
        hashes, others, keys, starts, weights = [], [], [], [], []
        for key, text, copies, places in zip(part["key"], part["text"], part["copies"], part["places"]):
            h = word_hashes(words(text))
            at = np.flatnonzero(np.isin(window_anchors(h, window, anchor)[1], np.asarray(places)))
            for out, values in zip((hashes, others), window_hashes(h, window)):
                out.append(pa.array(signed(values[at])))
            starts.append(pa.array(at.astype(np.int32), mask=np.full(len(at), copies > 1)))
            if copies > 1:
                hashes.append(pa.nulls(1, pa.int64()))
                others.append(pa.nulls(1, pa.int64()))
                starts.append(pa.array([WHOLE], pa.int32()))
            keys.append(np.full(len(at) + (copies > 1), key, np.int64))
            weights.append(np.full(len(at) + (copies > 1), min(copies, 2), np.int32))
        return pa.concat_arrays(hashes), pa.concat_arrays(others), _joined(keys, np.int64), pa.concat_arrays(starts), _joined(weights, np.int32)

    kinds = [("hash", pa.int64()), ("other", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("weight", pa.int32())]
    return _stage(texts, kinds, "hash long, other long, key long, start int, weight int", rows)


def without(docs: DataFrame, repeats: DataFrame, window: int) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` from the places of repeated windows by text key."""

    def rows(part):
        ids, own, keys, texts = part["doc_id"], [], [], []
        for t in part["text"]:
            tokens = words(t)
            own.append(len(tokens))
            keys.append(text_key(tokens) if len(tokens) >= window else None)
            texts.append(b" ".join(tokens).decode("utf-8"))
        return ids, own, keys, texts

    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("key", pa.int64()), ("text", pa.string())]
    known = _stage(docs.select("doc_id", "text"), fields, "doc_id long, n_words long, key long, text string", rows)
    # short texts have no key of their own: spread them instead of joining them all on null
    known = known.withColumn("key", F.coalesce("key", F.xxhash64("doc_id", "text")))

    def cut(part):
        removed, kept = [], []
        for n, text, starts in zip(part["n_words"], part["text"], part["starts"]):
            if not starts or n < window:
                gone, left = 0, text
            elif WHOLE in starts:
                gone, left = n, ""
            else:
                mask = covered(np.asarray(starts, np.int64), n, window)
                tokens = text.encode("utf-8").split(b" ")
                gone, left = int(mask.sum()), b" ".join(tokens[i] for i in np.flatnonzero(~mask)).decode("utf-8")
            removed.append(gone)
            kept.append(left)
        return part["doc_id"], part["n_words"], removed, kept

    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
    found = known.join(repeats, "key", "left").select("doc_id", "n_words", "text", "starts")
    return _stage(found, fields, "doc_id long, n_words long, n_removed long, kept_text string", cut)


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every row: the words outside all windows that occur more than once, single-spaced.

    1. Anchors are counted over all texts; those at two places or more stay.
    2. Distinct texts with such anchors give the hashes of their candidate windows, counted with the number of copies (combined
       before the shuffle). Texts with copies are repeated as a whole and only count.
    3. Repeated windows go back to their texts, merge into maximal intervals, and the words in them are removed.

    Null, empty and short texts (fewer words than a window) lose nothing. Repeated rows are copies of each other. An empty table gives no
    rows. Ids may be null or repeated: texts are known by their words. Texts of any length are read whole. Windows are told apart by 128 bits.
    Columns beside ``doc_id`` and ``text`` play no part.
    """
    if not 0 < anchor < window:
        raise ValueError("an anchor is shorter than a window")
    places = stored(anchors(docs, window, anchor), "anchors")
    # kept by themselves, so that the joins below can split the places of a hot anchor or window over tasks
    often = stored(places.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "anchors-often")
    candidates = places.join(often, "anchor", "left_semi").groupBy("key").agg(F.collect_set("place").alias("places"))
    candidates = stored(candidates, "candidates")
    # Different texts of one key (64 bits) would be taken for copies; they stop the job instead.
    one_text = F.when(F.min("other") == F.max("other"), F.first("text")).otherwise(F.raise_error(F.lit("two texts share a key")))
    texts = keyed(docs, window).groupBy("key").agg(one_text.alias("text"), F.count("*").alias("copies"))
    windows = stored(candidate_windows(texts.join(candidates, "key"), window, anchor), "windows")
    repeated = stored(
        windows.filter("hash IS NOT NULL").groupBy("hash", "other").agg(F.sum("weight").alias("n")).filter("n > 1").select("hash", "other"), "windows-often")
    starts = windows.filter("start >= 0").join(repeated, ["hash", "other"], "left_semi").select("key", "start").unionByName(
        windows.filter(f"start = {WHOLE}").select("key", "start"))
    repeats = stored(starts.groupBy("key").agg(F.collect_list("start").alias("starts")), "repeats")
    return without(docs, repeats, window)
