"""Best-fit packing of tokenised documents into sequences of fixed length, in bulk-synchronous rounds.

Pieces of one length are interchangeable, and so are sequences with one gap. A range sort gives every piece its global rank, so
all pieces of one length are one run of ranks, and sequences are numbered so that those with one gap are runs of numbers. Each
round matches a whole run of pieces with the run of its successor gap (the smallest that is large enough), resolves who gets
which gap by rank, updates the gaps, and goes on. There are at most ``capacity`` lengths and gaps whatever the number of
documents, so the sweep over runs is a bounded table; all work per document (tokens, sorting, placing) stays in tasks.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tiktoken import Encoding

from gridpulse.functions.ranking import rank_rows
from gridpulse.llm.common import rank_vocabulary, stored
from gridpulse.session import ship_package

CAPACITY = 1024
END_ID = 2
# Words that a worker keeps encoded; beyond that it starts anew.
CACHED_WORDS = 200_000
LONGEST_CACHED = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"

_DOUBLED = ("  ", "\n\n", " \n", "\n ")


def evenly_spaced(text: str) -> bool:
    """Only single spaces and line breaks stand between the words, and nothing around them."""
    return not any(d in text for d in _DOUBLED) and len(text.split()) == text.count(" ") + text.count("\n") + 1


class CachedWords(dict):
    """Encoded words, each with the prefix that stands before it in a text."""

    def __init__(self, vocabulary: Encoding, prefix: str):
        super().__init__()
        self.encode, self.letters, self.prefix = vocabulary.encode_ordinary, vocabulary._encode_single_piece, prefix

    def __missing__(self, word: str) -> bytes:
        ids = packed(self.letters(self.prefix + word) if word.isalpha() else self.encode(self.prefix + word))
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class ByteLevelEncoder:
    """Token ids of whole texts, with a cache of words.

    A byte-level vocabulary with the usual word pattern never joins a word with what stands before its space: a single space
    belongs to the word after it and a single line break stands alone. So a text with single spaces and breaks only is encoded
    word by word, from the vocabulary's ranks; any other text, and one that holds an added token, goes through the tokenizer as it is.
    Both give the same ids.
    """

    def __init__(self, tokenizer: str, ranks: str):
        self.path = tokenizer
        vocabulary = rank_vocabulary(ranks)
        self.first, self.spaced = CachedWords(vocabulary, ""), CachedWords(vocabulary, " ")
        self.line_break = packed(vocabulary.encode_ordinary("\n"))

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def added(self) -> list[str]:
        """Literal tokens that the file adds to its vocabulary, such as marks of a text's end; they are found anywhere in a text."""
        return [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.added) or not evenly_spaced(text):
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        lines = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            lines.append(self.first[head] + b"".join(map(self.spaced.__getitem__, rest)))
        return self.line_break.join(lines)


@lru_cache(maxsize=1)
def encoder(tokenizer: str, ranks: str) -> ByteLevelEncoder:
    return ByteLevelEncoder(tokenizer, ranks)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``total`` ids: all full but perhaps the first."""
    first = total % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def cut_pieces(docs: DataFrame, tokenizer: str, ranks: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``PIECES`` of every document: ids of the text, then ``end_id``; only documents longer than ``capacity`` are cut."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = packed([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks).ids
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256).to_pydict(), []
                for doc, text in zip(part["doc_id"], part["text"]):
                    ids = encode(text or "") + end
                    rows += [(doc, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]))
                             for k, (start, length) in enumerate(cut(len(ids) // 4, capacity))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def match_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """The rounds. ``counts``: pieces by length; ranks go from the longest pieces to the shortest.

    Returns ``(first rank, first sequence, pieces per sequence, offset, length)`` per placement, by rising rank: the k-th
    piece from the first rank on goes to sequence ``first + k // per``, at ``offset + k % per * length``.
    Equal to best fit decreasing on single pieces: the gap that a piece leaves is smaller than the one it filled, so the next
    piece of the same length takes the same sequence again while it fits.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first sequence, number)
    sizes: list[int] = []  # the gaps in order
    opened, rank, placements = 0, 0, []

    def give(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in gaps:
                insort(sizes, gap)
            gaps.setdefault(gap, []).append((first, number))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(sizes, length)
            gap = sizes[at] if at < len(sizes) else capacity
            per = gap // length
            if at < len(sizes):
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                first, number = opened, -(-left // per)
                opened += number
            placements.append((rank, first, per, capacity - gap, length))
            full, rest = divmod(min(left, number * per), per)
            give(gap - per * length, first, full)
            if rest:
                give(gap - rest * length, first + full, 1)
            give(gap, first + full + bool(rest), number - full - bool(rest))
            rank, left = rank + full * per + rest, left - full * per - rest
    return placements


def place(ranked: DataFrame, placements: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Sequence and offset of every piece from its rank. The placements are a table of runs, bounded by the capacity."""
    ship_package(ranked.sparkSession)
    firsts, sequences, per, offsets, lengths = (np.asarray(c, np.int64) for c in zip(*placements)) if placements else [np.empty(0, np.int64)] * 5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(firsts, rank, "right") - 1
            k = rank - firsts[at]
            own = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(sequences[at] + k // per[at]), pa.array(offsets[at] + k % per[at] * lengths[at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, PLACED)


def pack(docs: DataFrame, tokenizer: str, ranks: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``PLACED``: every piece of every document with its sequence and its place there, gapless from 0.

    Null and empty texts are one piece of the end id alone. Repeated rows (also of one id) are packed once per row. An empty table gives
    no rows. Long texts are cut, never shortened. Columns beside ``doc_id`` and ``text`` play no part. Equal
    lengths are told apart by id and piece; rows equal in all of that may swap places. ``tokenizer`` and ``ranks`` are the
    vocabulary as a tokenizer file and as a list of ranks.
    """
    pieces = stored(cut_pieces(docs, tokenizer, ranks, capacity, end_id), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    ranked = rank_rows(pieces, F.desc("length"), F.asc("doc_id"), F.asc("piece"))
    return place(ranked, match_runs(counts, capacity))
