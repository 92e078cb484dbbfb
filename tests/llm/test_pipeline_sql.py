"""The pipeline over a given table against SQL for its first three stages and plain code, with the untouched tokenizer, for the other two."""

import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import duckdb
from test_faults import JSON, RANKS, plain_random
from tokenizers import Tokenizer

import corpus_pipeline
from gridpulse.llm.oracles import QUALITY_CTES, jaccard_ctes

SF = "/root/testdata/sf0.001"
PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)


def redacted(text):
    spans = [(m.start(), m.end(), k) for k, (_, p, ok) in enumerate(PATTERNS) for m in p.finditer(text) if ok(m)]
    spans = sorted([(s, k, e) for s, e, k in spans] + [(s, 3, e) for s, e, _ in plain_random(text, RANKS)])
    out, at = "", 0
    while spans:
        start, kind, end = spans.pop(0)
        while spans and spans[0][0] < end:
            end = max(end, spans.pop(0)[2])
        out += text[at:start] + f"<{('assign', 'access', 'hex', 'random')[kind]}>"
        at = end
    return out + text[at:]


def kept_texts():
    duck = duckdb.connect()
    duck.sql(f"""CREATE TABLE first AS WITH docs AS (SELECT doc_id, text FROM '{SF}/documents.parquet'), {QUALITY_CTES}
        SELECT doc_id, clean_text AS text FROM cleaned WHERE kept""")
    duck.sql(r"""CREATE TABLE second AS SELECT doc_id, text FROM first
        QUALIFY doc_id = min(doc_id) OVER (PARTITION BY regexp_replace(text, '[\x20\x09-\x0D]+', ' ', 'g'))""")
    return duck.sql(f"""WITH RECURSIVE {jaccard_ctes('second')}
        SELECT second.doc_id, text FROM second JOIN joined USING (doc_id) WHERE doc_id = component_id""").fetchall()


def best_fit(lengths, capacity=1024):
    """The number of sequences that best fit decreasing needs, one piece at a time."""
    gaps, opened = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(gaps, length)
        if at < len(gaps):
            gap = gaps.pop(at)
        else:
            gap, opened = capacity, opened + 1
        insort(gaps, gap - length)
    return opened


def test_pipeline_over_a_given_table(spark):
    tokenizer, want = Tokenizer.from_file(JSON), Counter()
    for doc, text in kept_texts():
        ids = tokenizer.encode(redacted(text), add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        for k, (low, high) in enumerate(zip([0, *range(first, len(ids), 1024)], [first, *range(first + 1024, len(ids) + 1, 1024)])):
            want[doc, k, low, high - low, zlib.crc32(struct.pack(f"<{high - low}I", *ids[low:high]))] += 1
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 1024
    assert len(places) == best_fit([r.length for r in rows])
