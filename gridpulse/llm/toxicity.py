"""Toxicity by compression distance: how much shorter does a window of text get once a dictionary of toxic text is at hand?

There are two zstandard dictionaries, one trained on ordinary text and one filled with the words that set toxic text apart most. Every window of
a text is compressed with the ordinary dictionary alone and with both; the bytes saved are its distance towards toxic text. Thresholds for
windows and for texts are calibrated on labelled texts that took no part in training the dictionaries.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.session import ship_package

# Bounds of the sample of labelled rows that the classifier is fitted on; of these, one in three is for calibration.
SAMPLE_TOXIC = 3000
SAMPLE_ORDINARY = 6000
CALIBRATION_SHARE = 3
WINDOW_WORDS = 16
LEVEL = 12
ORDINARY_BYTES, TOXIC_BYTES = 131_072, 1_536
SEGMENT, MATCH = 32, 6
# Words are ranked by their runs of so many characters.
GRAM = 5
# A window stands out if it saves more than this share of the ordinary windows do.
WINDOW_QUANTILE = 0.999
RIDGE = 0.01


def windows(text: str | None) -> list[bytes]:
    """The text in windows of words, lower case; one empty window if it has no words."""
    own = (text or "").lower().encode("utf-8").split()
    return [b" ".join(own[at:at + WINDOW_WORDS]) for at in range(0, len(own), WINDOW_WORDS)] or [b""]


def trained(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; of too few samples for the trainer, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT, d=MATCH).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


def grams(word: str) -> set[str]:
    """The runs of ``GRAM`` characters in a word with its borders marked."""
    marked = f"_{word}_"
    return {marked[k:k + GRAM] for k in range(max(1, len(marked) - GRAM + 1))}


def telling_words(toxic: list[str], ordinary: list[str]) -> list[str]:
    """All words of toxic texts, the most telling ones first.

    A word counts by the best of its runs of characters: by how many standard deviations the run is in more toxic texts than chance would
    have. No level has to be reached, so that few toxic texts give words too.
    """
    def of(text: str) -> set[str]:
        return set().union(*map(grams, set(text.lower().split())))

    often = Counter(g for t in toxic for g in of(t))
    other = Counter(g for t in ordinary for g in of(t) if g in often)
    n, m, deviations = len(toxic), len(ordinary), {}
    for gram, a in often.items():
        p = (a + other[gram]) / (n + m)
        deviations[gram] = (a - p * n) / math.sqrt(p * (1 - p) * n * m / (n + m)) if p < 1 else 0.0
    texts = Counter(w for t in toxic for w in set(t.lower().split()))
    return sorted(texts, key=lambda w: (-max(deviations[g] for g in grams(w)), -texts[w], w))


def filled(words: list[str], size: int) -> bytes:
    """A dictionary of the first words that have room, the first one last; of one longer than all of it, the start."""
    out, left = [], size
    for word in words:
        own = word.encode("utf-8")
        if out and len(own) + 1 > left:
            break
        out.append(own[:size])
        left -= len(own) + 1
    return b" ".join(reversed(out))


class Distances:
    """Bytes that the toxic dictionary saves, by window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.plain, self.both = self._compressor(ordinary), self._compressor(toxic + ordinary)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=128, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False)
        if not content:
            return zstandard.ZstdCompressor(compression_params=how)
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=how)

    def of(self, text: str | None) -> np.ndarray:
        plain, both = self.plain.compress, self.both.compress
        own = windows(text)
        return np.fromiter((len(plain(w)) - len(both(w)) for w in own), np.float64, len(own))


def features(saved: np.ndarray, threshold: float) -> list[float]:
    """What a text is judged by: the most that windows save, what they save on average, and how many stand out."""
    top = np.sort(saved)[::-1][:3]
    over = float((saved > threshold).sum())
    return [1.0, float(top[0]), float(top.mean()), float(saved.mean()), math.log1p(over), over / len(saved), math.log(len(saved))]


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a small ridge, by Newton's method."""
    weights, ridge = np.zeros(x.shape[1]), RIDGE * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ weights)
        weights += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fitted(texts: list[str], labels: list[int]) -> tuple[bytes, bytes, str]:
    """The ordinary dictionary, the toxic one, and the calibration as JSON, from texts in random order.

    Equal texts count once. Without texts of both labels there is no distance: every score is the smoothed share of toxic texts.
    """
    known = dict(zip(texts, labels))
    groups = [[t for t, label in known.items() if label == want] for want in (1, 0)]
    prior = (len(groups[0]) + 1) / (len(known) + 2)
    if min(map(len, groups)) < 2 * CALIBRATION_SHARE:
        return b"", b"", json.dumps({"prior": prior})
    train = [[t for k, t in enumerate(g) if k % CALIBRATION_SHARE] for g in groups]
    held = [(t, label) for g, label in zip(groups, (1, 0)) for t in g[::CALIBRATION_SHARE]]
    toxic = filled(telling_words(*train), TOXIC_BYTES)
    ordinary = trained(list(dict.fromkeys(w for t in train[1] for w in windows(t))), ORDINARY_BYTES)
    distances = Distances(ordinary, toxic)
    saved = [distances.of(t) for t, _ in held]
    usual = np.concatenate([s for s, (_, label) in zip(saved, held) if not label])
    threshold = float(np.quantile(usual, WINDOW_QUANTILE))
    x = np.asarray([features(s, threshold) for s in saved])
    weights = logistic(x, np.asarray([label for _, label in held], np.float64))
    return ordinary, toxic, json.dumps({"threshold": threshold, "weights": weights.tolist()})


MODEL = "ordinary binary, toxic binary, calibration string"


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text divides by five; rows without id too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``MODEL``, one row, from a sample of labelled rows that are not held out.

    The sample is bounded by ``SAMPLE_TOXIC`` and ``SAMPLE_ORDINARY`` rows, taken by a hash of the id, with their whole texts. Labels other
    than 0 and 1 are ignored; of several labels of one id the largest counts.
    """
    ship_package(docs.sparkSession)
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("label"))
    sampled = [known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
               for label, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY))]
    ids = F.broadcast(sampled[0].unionByName(sampled[1]))  # bounded by the two limits
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id")
    kinds = pa.schema([("ordinary", pa.binary()), ("toxic", pa.binary()), ("calibration", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            marks += batch.column("label").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([c], k.type) for c, k in zip(fitted(texts, marks), kinds)], schema=kinds)

    ordered = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text")
    return ordered.select("text", "label").mapInArrow(run, MODEL)


def score(docs: DataFrame, model: tuple[bytes, bytes, str]) -> DataFrame:
    """``doc_id, score, predicted, n_windows, max_saved`` of every row, from its whole text alone.

    One map stage. Null and empty texts are one empty window. Repeated rows each give a row; an empty table gives none; no column but
    ``text`` has a part in the score.
    """
    ship_package(docs.sparkSession)
    ordinary, toxic, calibration = model
    how = json.loads(calibration)
    kinds = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_windows", pa.int64()), ("max_saved", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distances = Distances(ordinary, toxic)
        weights = np.asarray(how.get("weights", []))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for text in part.column("text").to_pylist():
                    saved = distances.of(text)
                    value = how.get("prior")
                    if value is None:
                        value = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights @ features(saved, how["threshold"]))))))
                    rows.append((value, int(value >= 0.5), len(saved), int(saved.max())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k.type) for c, k in zip(zip(*rows), list(kinds)[1:]))], schema=kinds)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int, n_windows long, max_saved long")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score`` of all rows of ``docs`` by a model fitted on their ``labels``, and whether a row was ``held_out`` from fitting."""
    found = fit(docs, labels).first() or fitted([], [])
    return score(docs, tuple(bytes(v) if isinstance(v, bytearray) else v for v in found)).withColumn("held_out", held_out(F.col("doc_id")))
