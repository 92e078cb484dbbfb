"""Line-first cleaning: rules judge each line, failing lines go, then texts that lost too much are rejected."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from gridpulse.llm.common import map_batches, words

# The symbols counted by the base measures.
SYMBOLS = "[#*$%&|<>]"
# A line fails with two or more marks when they are over one in twenty of its word characters.
MARKS = SYMBOLS + "|!!+"
MARKS_PER_100_CHARS = 5
# A line fails when at least two of its words, and a fifth of them, are separators of a menu.
SEPARATORS = ("|", "»", "›", "•", "·", "::", ">", ">>", "/")
SEPARATORS_PER_100_WORDS = 20
# A line with one of these phrases, in either case, is boilerplate.
PHRASES = (
    "accept all cookies", "all rights reserved", "click here to", "cookie policy", "enable javascript", "lorem ipsum",
    "privacy policy", "skip to content", "subscribe to our newsletter", "terms of service", "terms of use",
)
MAX_LOST_PER_100_CHARS = 30
MIN_WORDS = 10
MAX_REPEAT_PER_100_WORDS = 20
REPEAT_WINDOW = 5

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_failed_lines long, lost_chars long, clean_text string"
)


def any_case(phrase: str) -> str:
    """Pattern for an ASCII phrase in either case that means the same to every regex engine."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in phrase)


BOILERPLATE = "|".join(map(any_case, PHRASES))

_marks, _boilerplate = re.compile(MARKS), re.compile(BOILERPLATE)
_separators = frozenset(t.encode("utf-8") for t in SEPARATORS)


def line_fails(line: str, tokens: list[bytes], chars: int) -> bool:
    """The three rules on one line that has words: punctuation, navigation, boilerplate."""
    marks = len(_marks.findall(line))
    if marks >= 2 and 100 * marks > MARKS_PER_100_CHARS * chars:
        return True
    separators = 0 if _separators.isdisjoint(tokens) else sum(t in _separators for t in tokens)
    if separators >= 2 and 100 * separators >= SEPARATORS_PER_100_WORDS * len(tokens):
        return True
    return bool(_boilerplate.search(line))


def word_chars(text: str, tokens: list[bytes]) -> int:
    """Code points of a text inside its words: all but the white-space bytes."""
    return len(text) - len(text.encode("utf-8")) + sum(map(len, tokens))


def repeated_words(tokens: list[bytes]) -> int:
    """Words inside windows of five that are found twice or more, the first occurrence included."""
    windows = list(zip(*(tokens[k:] for k in range(REPEAT_WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, upto = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + REPEAT_WINDOW - max(at, upto)
            upto = at + REPEAT_WINDOW
    return covered


def measure(text: str | None) -> tuple:
    """All columns of one text, in the order of ``COLUMNS``."""
    text = text or ""
    tokens = words(text)
    symbols = sum(map(text.count, SYMBOLS[1:-1]))
    lower = text.lower()
    # a text without any of these has no line that fails
    suspect = symbols or "!!" in text or any(p in lower for p in PHRASES) or not _separators.isdisjoint(tokens)
    seen, duplicates, failed, lost, kept_lines = set(), 0, 0, 0, []
    for line in text.split("\n"):
        own = line.encode("utf-8").split() if suspect else line.strip(" \t\n\v\f\r")
        if not own:
            kept_lines.append(line)
            continue
        duplicates += line in seen
        seen.add(line)
        if suspect and line_fails(line, own, size := word_chars(line, own)):
            failed += 1
            lost += size
        else:
            kept_lines.append(line)
    chars = word_chars(text, tokens)
    repeats = repeated_words(tokens)
    base_failed = len(tokens) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PER_100_WORDS * len(tokens)
    kept = not base_failed and 100 * lost <= MAX_LOST_PER_100_CHARS * chars
    return (
        len(tokens), chars, symbols, duplicates, repeats, base_failed, kept, failed, lost,
        "\n".join(kept_lines) if failed else text,
    )


def clean(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measures, verdict and cleaned text of every row of ``docs``; the columns in ``keep`` are carried along.

    One map stage, no shuffle: a text is judged by itself and whole, so skew does not matter. Null texts count as empty, empty
    texts fail the base rule; repeated rows each give a row; an empty table gives none; texts of any length are judged whole; columns of
    ``docs`` that are not in ``keep`` play no part, whatever their names. ``clean_text`` is the text without its failing lines (lines without words stay).
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    if clash := {*keep} & {"_text", *names}:
        raise ValueError(f"columns {sorted(clash)} of the input would hide results")

    def rows(batch: dict[str, list]) -> dict[str, list]:
        found = list(zip(*map(measure, batch["_text"]))) or [()] * len(names)
        return {c: batch[c] for c in keep} | dict(zip(names, map(list, found)))

    picked = docs.select(*keep, F.col("text").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name in keep)
    return map_batches(picked, rows, f"{kinds}, {COLUMNS}")
