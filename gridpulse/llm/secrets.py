"""Secret scan: fixed patterns, and strings that a tokenizer for ordinary text cannot compress."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from gridpulse.llm.common import map_batches, rank_vocabulary

# The base patterns and the least lengths of their matches.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")
ASSIGN_HINTS = ("passw", "secret", "token", "api")

# Token-efficiency test: strings of this many characters, with letters and digits, under so many characters a token.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MAX_CHARS_PER_TOKEN = 2.0
# Known digests and identifiers, which look random but are no secrets (MD5, SHA-1, SHA-2 in hex; UUIDs; numbers; words joined by signs).
# A word is in one case, or capitalised; letters of mixed case are tested, and names in camel case pass by their tokens.
KNOWN = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|[0-9+/_=-]+|(?:[A-Z]?[a-z]+|[A-Z]+)(?:[+/_=-]+(?:[A-Z]?[a-z]+|[A-Z]+))*[0-9]{0,4}|[+/_=-]*)"
)
DIGEST_LABEL = re.compile(r"(?:sha-?\d*|md5|digest|checksum|integrity|uuid|guid|etag)[-:= \"']{1,4}\Z", re.I | re.A)

COLUMNS = (
    "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string, redacted string"
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points of what the fixed patterns find, leftmost and without overlap within a kind."""
    found, lower = [], text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=_by_place)


_LONG_HEX = re.compile(rf"(?:{HEX.pattern[:-1]}){{{MIN_HEX},}}")  # whole runs, as the pattern is greedy


def _by_place(span: tuple[int, int, str]) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def outside(start: int, end: int, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """The parts of a stretch of text that no span (sorted by start) touches."""
    for low, high, _ in taken:
        if low >= end:
            break
        if high > start:
            if low > start:
                yield start, low
            start = max(start, high)
    if start < end:
        yield start, end


def random_spans(text: str, taken: list[tuple[int, int, str]], path: str, max_ratio: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, str]]:
    """Strings that fail the token-efficiency test; of one that a span already ``taken`` touches, the parts outside that are long enough."""
    found, passed = [], 0
    for m in CANDIDATE.finditer(text):
        if DIGEST_LABEL.search(text, max(0, m.start() - 16), m.start()):
            continue
        while passed < len(taken) and taken[passed][1] <= m.start():
            passed += 1
        for start, end in outside(m.start(), m.end(), taken[passed:]):
            run = text[start:end]
            if CANDIDATE.fullmatch(run) and not KNOWN.fullmatch(run) and len(run) < max_ratio * len(rank_vocabulary(path).encode_ordinary(run)):
                found.append((start, end, "random"))
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span, overlapping ones as one, replaced by the mark of its first kind."""
    out, upto, at = [], 0, 0
    while at < len(spans):
        start, end, kind = spans[at]
        while at < len(spans) and spans[at][0] < end:
            end = max(end, spans[at][1])
            at += 1
        out += [text[upto:start], f"<{kind}>"]
        upto = end
    return "".join([*out, text[upto:]])


def examine(text: str | None, path: str, max_ratio: float = MAX_CHARS_PER_TOKEN) -> tuple:
    """All columns of one text, in the order of ``COLUMNS``."""
    text = text or ""
    base = base_spans(text)
    added = random_spans(text, base, path, max_ratio)
    spans = sorted(base + added, key=_by_place)
    counts = [sum(kind == k for _, _, kind in spans) for k in KINDS]
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), redact(text, spans) if spans else text)


def scan(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), max_ratio: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """Counts, spans and redacted text of every row of ``docs``; the columns in ``keep`` are carried along.

    One map stage over whole texts, no shuffle. Null texts count as empty: no spans, the digest of the empty string. Repeated rows each
    give a row; an empty table gives none; columns of ``docs`` that are not in ``keep`` play no part, whatever their names.
    ``path`` is the tiktoken vocabulary file.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    if clash := {*keep} & {"_text", *names}:
        raise ValueError(f"columns {sorted(clash)} of the input would hide results")

    def rows(batch: dict[str, list]) -> dict[str, list]:
        found = list(zip(*(examine(t, path, max_ratio) for t in batch["_text"]))) or [()] * len(names)
        return {c: batch[c] for c in keep} | dict(zip(names, map(list, found)))

    picked = docs.select(*keep, F.col("text").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name in keep)
    return map_batches(picked, rows, f"{kinds}, {COLUMNS}")
