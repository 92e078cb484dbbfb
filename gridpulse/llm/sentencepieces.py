"""SentencePiece ids by a streaming Viterbi search, and back to text.

The search goes over the places of a text with one surviving path per place: the pieces that end there, each joined to the survivor where it
begins if the two are legal neighbours. It holds a window as long as the longest piece; whenever the paths of all survivors in
the window run through one boundary, the ids before it are committed and forgotten. So memory does not grow with the text.

With a unigram model all neighbours are legal and the survivor is the path with the best score. With a byte-pair model, which merges by
rank, two pieces are legal neighbours if merging their joined text gives back these two; a text has exactly one path of legal
neighbours, its byte-pair encoding. Characters without a piece become bytes, and every path converges there; the same holds before each
space, as pieces have spaces in front only.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridpulse.session import ship_package

SPACE = "▁"
# Segments that a worker remembers, in two generations: the older one goes when the younger one is full.
CACHED_SEGMENTS = 400_000
CACHED_PAIRS = 1_000_000
LONGEST_CACHED = 64
TAIL = 4
COLUMNS = "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, round_trip boolean"


class Pieces:
    """A vocabulary: ids and scores of pieces, ids of bytes; ``merging`` if it is a byte-pair model."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: list[int], merging: bool, unknown: int = 0):
        self.scores, self.byte_ids, self.merging, self.unknown = scores, byte_ids, merging, unknown
        self.longest = max(map(len, scores), default=1)
        self.chars = frozenset(p for p in scores if len(p) == 1)
        self.merges: dict[str, tuple | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        # pieces that a path can have: with a byte-pair model only those that merging gives
        self.usable = {p: s for p, (_, s) in scores.items() if not merging or self.history(p)}
        # the lengths of pieces by their last characters, longest first
        sizes: dict[str, set[int]] = {}
        for piece in self.usable:
            sizes.setdefault(piece[-TAIL:], set()).add(len(piece))
        shorter = tuple(range(TAIL - 1, 0, -1))
        self.sizes = {tail: (*sorted(own, reverse=True), *shorter) for tail, own in sizes.items() if len(tail) == TAIL}
        self.short_sizes = shorter

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte_ids = {}, [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                scores[piece] = (i, model.get_score(i))
        with open(path, "rb") as stream:
            kind = model_type(stream.read())
        return cls(scores, byte_ids, kind == BYTE_PAIR, model.unk_id())

    def fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8")] if any(self.byte_ids) else [self.unknown]

    def history(self, piece: str) -> tuple | None:
        """The merges that make a piece: their scores, and its first and last part after each. None if merging never gives the piece."""
        if piece not in self.merges:
            parts, seen = list(piece), [(None, piece[0], piece[-1])]
            while len(parts) > 1:
                best, at = max(((self.scores.get(a + b, (0, None))[1], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores),
                               default=(None, 0))
                if best is None:
                    break
                parts[-at:2 - at] = ["".join(parts[-at:2 - at])]
                seen.append((best, parts[0], parts[-1]))
            self.merges[piece] = tuple(seen) if len(parts) == 1 and all(c in self.scores for c in piece) else None
        return self.merges[piece]

    def neighbours(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` ends with these two parts: their own merges, best score first and the left one first of
        equals, and no merge over the border comes before."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._neighbours(self.history(left), self.history(right))
        return known

    def _neighbours(self, left: tuple, right: tuple) -> bool:
        i = j = 0
        while True:
            across = self.scores.get(left[i][2] + right[j][1])
            a = left[i + 1][0] if i + 1 < len(left) else None
            b = right[j + 1][0] if j + 1 < len(right) else None
            if across is not None and (a is None or across[1] > a) and (b is None or across[1] >= b):
                return False
            if a is None and b is None:
                return True
            if b is None or a is not None and a >= b:
                i += 1
            else:
                j += 1


    def only_path(self, text: str) -> list[int]:
        """The ids of a segment of characters with pieces, where merging leaves one path: per place the longest piece that may end there."""
        usable, pairs, sizes, short, known = self.usable, self.pairs, self.sizes, self.short_sizes, self.scores
        last: list[str | None] = [""]
        for end in range(1, len(text) + 1):
            found = None
            for size in sizes.get(text[end - TAIL:end], short) if end >= TAIL else short:
                if size <= end and (piece := text[end - size:end]) in usable and (left := last[end - size]) is not None:
                    if left:
                        legal = pairs.get((left, piece))
                        if not (self.neighbours(left, piece) if legal is None else legal):
                            continue
                    found = piece
                    break
            last.append(found)
        ids, end = [], len(text)
        while end:
            piece = last[end]
            ids.append(known[piece][0])
            end -= len(piece)
        return ids[::-1]


BYTE_PAIR = 2


def model_type(data: bytes) -> int:
    """The kind of a model file: field 3 (an integer) of its trainer settings, which are field 2 of the file; 1 is unigram."""
    for number, value in _fields(data):
        if number == 2:
            return next((v for n, v in _fields(value) if n == 3), 1)
    return 1


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message, by number."""
    at = 0

    def whole() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = whole()
        if key & 7 == 0:
            yield key >> 3, whole()
        else:
            size = whole() if key & 7 == 2 else 4 if key & 7 == 5 else 8
            yield key >> 3, data[at:at + size]
            at += size


class StreamingEncoder:
    """Feed text of any length with spaces as ``SPACE``; ids come out as soon as they are certain."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.widest = pieces, 0
        self._reset()

    def _reset(self) -> None:
        self.text = ""
        # per place of the window: (score, piece that ends here, place where it begins), None where no path ends
        self.best: list[tuple[float, str, int] | None] = [(0.0, "", -1)]

    def feed(self, text: str) -> list[int]:
        """The ids that become certain with these characters."""
        chars, ids, start, last = self.pieces.chars, [], 0, self.text[-1:]
        if chars.issuperset(text) and SPACE not in text[1:] and not (last and text[:1] == SPACE != last):
            return self._extend(text)
        for at, char in enumerate(text):
            if char not in chars:
                ids += self._extend(text[start:at]) + self.finish() + self.pieces.fallback(char)
                start = at + 1
            elif char == SPACE and (text[at - 1] if at > start else self.text[-1:]) not in ("", SPACE):
                ids += self._extend(text[start:at]) + self.finish()
                start = at
        return ids + self._extend(text[start:])

    def _extend(self, text: str) -> list[int]:
        """Adds characters that have pieces; what is certain is committed now and then."""
        pieces, ids = self.pieces, []
        longest = pieces.longest
        for low in range(0, len(text), longest):
            self.text += text[low:low + longest]
            self._search()
            self.widest = max(self.widest, len(self.best))
            if len(self.best) > 4 * longest:
                ids += self._commit()
        return ids

    def _search(self) -> None:
        """Survivors of the places that have none yet."""
        pieces, text, best = self.pieces, self.text, self.best
        usable, pairs, merging, sizes, short = pieces.usable, pieces.pairs, pieces.merging, pieces.sizes, pieces.short_sizes
        for end in range(len(best), len(text) + 1):
            found = None
            for size in sizes.get(text[end - TAIL:end], short) if end >= TAIL else short:
                start = end - size
                before = best[start] if start >= 0 else None
                if before is None:
                    continue
                piece = text[start:end]
                score = usable.get(piece)
                if score is None:
                    continue
                if merging:
                    left = before[1]
                    if left:
                        legal = pairs.get((left, piece))
                        if legal is None:
                            legal = pieces.neighbours(left, piece)
                        if not legal:
                            continue
                    found = (0.0, piece, start)
                    break
                if found is None or before[0] + score > found[0]:
                    found = (before[0] + score, piece, start)
            best.append(found)

    def _path(self, end: int) -> list[int]:
        ids = []
        while end > 0:
            _, piece, start = self.best[end]
            ids.append(self.pieces.scores[piece][0])
            end = start
        return ids[::-1]

    def _commit(self) -> list[int]:
        """The ids before the boundary that the paths of all survivors share, if there is one."""
        length = len(self.text)
        live = {k for k in range(max(0, length - self.pieces.longest + 1), length + 1) if self.best[k] is not None}
        while len(live) > 1:
            live.add(self.best[top][2] if (top := max(live)) else 0)
            live.discard(top)
        at = live.pop()
        if at <= 0:
            return []
        ids, last = self._path(at), self.best[at]
        self.text = self.text[at:]
        self.best = [(last[0], last[1], -1)] + [b and (b[0], b[1], b[2] - at) for b in self.best[at + 1:]]
        return ids

    def finish(self) -> list[int]:
        """The ids of what is left."""
        ids = self._path(len(self.text))
        self._reset()
        return ids


class _Segments(dict):
    """Ids of segments as little-endian unsigned 32-bit integers. A segment ends where all surviving paths converge, so its ids never depend
    on what stands around it and are remembered."""

    def __init__(self, pieces: Pieces, prefix: str):
        super().__init__()
        self.pieces, self.prefix, self.older = pieces, prefix, {}

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            ids = self._searched(self.prefix + segment)
        if len(segment) <= LONGEST_CACHED:
            if len(self) >= CACHED_SEGMENTS:
                self.older = dict(self)
                self.clear()
            self[segment] = ids
        return ids

    def _searched(self, text: str) -> bytes:
        pieces = self.pieces
        if pieces.merging and len(text) <= LONGEST_CACHED and pieces.chars.issuperset(text) and SPACE not in text.lstrip(SPACE):
            ids = pieces.only_path(text)
        else:
            encoder = StreamingEncoder(pieces)
            ids = encoder.feed(text) + encoder.finish()
        return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Texts to ids and back: a space before the text, spaces as ``SPACE``, no other change to it."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.first, self.spaced = _Segments(pieces, ""), _Segments(pieces, SPACE)
        self.breaks = "\n" not in pieces.chars  # a line break is bytes then, where all paths converge
        self.line_break = np.asarray(pieces.fallback("\n"), "<u4").tobytes()
        self.parts = {i: p.replace(SPACE, " ").encode("utf-8") for p, (i, _) in pieces.scores.items()}
        self.parts |= {i: bytes([b]) for b, i in enumerate(pieces.byte_ids) if i}
        self.is_byte = frozenset(i for i in pieces.byte_ids if i)

    def commits(self, text: str) -> Iterator[bytes]:
        """The ids of a text as they become certain: a commit wherever all surviving paths have converged.

        That is before each space that follows something else (pieces have spaces in front only) and at each line break without a piece. A segment
        between two such places that is longer than the window is committed in parts too, see :class:`StreamingEncoder`.
        """
        if text:
            for k, line in enumerate((" " + text).split("\n") if self.breaks else [" " + text]):
                if k:
                    yield self.line_break
                yield from self._line(line)

    def encode(self, text: str) -> bytes:
        return b"".join(self.commits(text))

    def _line(self, line: str) -> Iterator[bytes]:
        if "  " in line or line.endswith(" ") or SPACE in line:  # segments with several spaces before them
            return map(self.first.__getitem__, re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", line.replace(" ", SPACE)))
        head, *rest = line.split(" ")
        spaced = map(self.spaced.__getitem__, rest)
        return chain((self.first[head],), spaced) if head else spaced

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        data = b"".join(map(self.parts.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    return Codec(Pieces.load(path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) of every row. Null and empty texts have no ids; rows, repeated or not, give a row each."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [own.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text."""
    ship_package(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = [None if i is None else own.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``COLUMNS`` of every row: its ids counted and summed up, and whether they decode to the text.

    One map stage over whole texts. Null counts as empty: no ids, a round trip. A text with ``SPACE`` itself does not come back, as the
    vocabulary writes spaces so. Repeated rows each give a row; an empty table gives none; other columns play no part.
    """
    ship_package(docs.sparkSession)
    kinds = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("n_byte_ids", pa.int64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        marks = np.zeros(max(own.parts, default=0) + 1, bool)
        marks[list(own.is_byte)] = True
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for text in part.column("text").to_pylist():
                    ids = own.encode(text or "")
                    rows.append((len(ids) // 4, int(marks[np.frombuffer(ids, "<u4")].sum()), zlib.crc32(ids), own.decode(ids) == (text or "")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k.type) for c, k in zip(zip(*rows), list(kinds)[1:]))], schema=kinds)

    return docs.select("doc_id", "text").mapInArrow(run, COLUMNS)
