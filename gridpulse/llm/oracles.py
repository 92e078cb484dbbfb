"""The same results in SQL, from the same constants."""

from __future__ import annotations

from gridpulse.llm import disclosure, quality, spelling, substrings
from gridpulse.llm.common import SPACES, WORD

EXACT_DEDUP_SQL = f"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""

_SEPARATORS = ", ".join(f"'{s}'" for s in quality.SEPARATORS)

# Documents as `docs` (doc_id, text); gives `cleaned` with all measures and the text without its failing lines.
QUALITY_CTES = f"""
w AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM docs
),
windows AS (
    SELECT doc_id, i, list_slice(words, i, i + {quality.REPEAT_WINDOW - 1}) AS five
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {quality.REPEAT_WINDOW - 2})) AS i FROM w)
),
repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS times FROM windows), range({quality.REPEAT_WINDOW}) AS r(k)
    WHERE times > 1 GROUP BY doc_id
),
lines AS (
    SELECT doc_id, line, pos, regexp_extract_all(line, '{WORD}') AS own FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM w
    )
),
judged AS (
    SELECT *, len(own) > 0 AND (
        marks >= 2 AND 100 * marks > {quality.MARKS_PER_100_CHARS} * chars
        OR separators >= 2 AND 100 * separators >= {quality.SEPARATORS_PER_100_WORDS} * len(own)
        OR regexp_matches(line, '{quality.BOILERPLATE}')
    ) AS fails
    FROM (
        SELECT *, length(array_to_string(own, '')) AS chars, len(regexp_extract_all(line, '{quality.MARKS}')) AS marks,
            len(list_filter(own, lambda x: x IN ({_SEPARATORS}))) AS separators
        FROM lines
    )
),
by_line AS (
    SELECT doc_id, count(*) FILTER (len(own) > 0) - count(DISTINCT line) FILTER (len(own) > 0) AS n_dup_lines,
        count(*) FILTER (fails) AS n_failed_lines, coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS lost_chars,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT fails), '') AS clean_text
    FROM judged GROUP BY doc_id
),
measured AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        len(regexp_extract_all(text, '{quality.SYMBOLS}')) AS n_symbols, n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, n_failed_lines, lost_chars, clean_text,
        len(words) < {quality.MIN_WORDS}
            OR 100 * coalesce(n_repeat_words, 0) > {quality.MAX_REPEAT_PER_100_WORDS} * len(words) AS base_failed
    FROM w LEFT JOIN repeated USING (doc_id) JOIN by_line USING (doc_id)
),
cleaned AS (
    SELECT *, NOT base_failed AND 100 * lost_chars <= {quality.MAX_LOST_PER_100_CHARS} * word_chars AS kept FROM measured
)"""

QUALITY_SQL = f"""
WITH docs AS (SELECT doc_id, text FROM documents), {QUALITY_CTES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_failed_lines, lost_chars FROM cleaned
"""


def jaccard_ctes(source: str) -> str:
    """From a table `source` (doc_id, text): `joined` with the set size and the component of every document."""
    return f"""
jw AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
    FROM {source}
),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 2), ' ') AS s
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM jw WHERE len(words) > 0)
),
sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sized x ON x.doc_id = a.doc_id JOIN sized y ON y.doc_id = b.doc_id
    WHERE 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM {source} UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other),
joined AS (
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
    FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    LEFT JOIN sized USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a) USING (doc_id)
)"""


JACCARD_SQL = f"WITH RECURSIVE {jaccard_ctes('documents')} SELECT doc_id, n_shingles, component_id, n_links FROM joined"

SUBSTRING_SQL = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
windows AS (
    SELECT doc_id, i, sha256(array_to_string(list_slice(words, i, i + {substrings.WINDOW_WORDS - 1}), ' ')) AS h
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {substrings.WINDOW_WORDS - 2})) AS i FROM t)
),
starts AS (SELECT doc_id, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
gone AS (
    SELECT doc_id, list(i ORDER BY i) AS removed
    FROM (SELECT DISTINCT doc_id, i + k AS i FROM starts, range({substrings.WINDOW_WORDS}) AS r(k)) GROUP BY doc_id
),
left_over AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM (
        SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM t
    ) w ANTI JOIN (SELECT doc_id, unnest(removed) AS i FROM gone) g USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(len(removed), 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN gone USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_LETTERS}', ((('0x' || substr(h, {at + 1}, 5))::INT >> {shift}) & 31) + 1, 1)" for at in range(0, 40, 5) for shift in (15, 10, 5, 0)
)

WARC_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> top THEN top END AS refers_to
FROM t
"""

# For the markup of these tables: one article per page, of headings and paragraphs.
HTML_SQL = r"""
WITH b AS (
    SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's'), '</?(?:p|h1)>') AS parts FROM pages
),
d AS (
    SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda p: trim(regexp_replace(
        regexp_replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(p, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
        '\s+', ' ', 'g'))), lambda p: p <> ''), chr(10)) AS text FROM b
)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""


def _crc_table() -> str:
    """The 256 entries of the table for CRC-32 (reversed polynomial 0xEDB88320), as a SQL list."""
    entries = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        entries.append(value)
    return f"{entries}::BIGINT[]"


# Letters of a run have one or two bytes: those from U+00C0 on are 0xC3 and their number less 64.
SPELLING_SQL = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS times FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents
    ) GROUP BY doc_id, run
),
hashed AS (
    SELECT run, times, xor(list_reduce(list_concat([4294967295::BIGINT], flatten([
        CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END
        for c in string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')])),
        lambda crc, b: xor(crc >> 8, ({_crc_table()})[(xor(crc, b) & 255) + 1])), 4294967295) AS h FROM runs
),
w AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % {spelling.TYPO_EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed
    ) WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(times) >= {spelling.MIN_COUNT}
),
gone AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(0, length(word))) AS i FROM w)),
near AS (
    SELECT a.word AS a, b.word AS b FROM gone a JOIN gone b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT gone.word, w.word FROM gone JOIN w ON w.word = gone.rest
    UNION SELECT w.word, gone.word FROM gone JOIN w ON w.word = gone.rest
),
best AS (
    SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b) AS b, max(n) AS b_n FROM near JOIN w ON w.word = near.b GROUP BY a
),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= {spelling.FORM_TIMES} * w.n THEN b END AS form,
        CASE WHEN b_n >= {spelling.FORM_TIMES} * w.n THEN b_n END AS form_n FROM w LEFT JOIN best ON best.a = w.word
),
walk(word, ends_at) AS (SELECT word, word FROM formed UNION ALL SELECT walk.word, f.form FROM walk JOIN formed f ON f.word = walk.ends_at WHERE f.form IS NOT NULL)
SELECT formed.word, formed.form, walk.ends_at AS root, formed.n, formed.n_near, formed.form_n FROM formed JOIN walk ON walk.word = formed.word
JOIN formed ends ON ends.word = walk.ends_at AND ends.form IS NULL
"""

# The patterns of the contract as they stand there; places follow from the pieces between the matches.
_FOUND = " UNION ALL ".join(f"""
    SELECT row, {rank} AS rank, '{kind}' AS kind, m, {value} AS value, start, start + length(m) AS "end",
        right(pieces[i], {disclosure.REACH}) AS before, left(pieces[i + 1], {disclosure.REACH}) AS after FROM (
        SELECT row, pieces, i, found[i] AS m, list_sum([length(p) for p in pieces[1:i]]) + coalesce(list_sum([length(f) for f in found[1:i - 1]]), 0) AS start
        FROM (SELECT row, string_split_regex(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}') AS found, unnest(range(1, len(found) + 1)) AS i FROM docs)
    ) WHERE {passes}""" for rank, (kind, pattern, value, passes) in enumerate((
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "lower(m)", "true"),
        ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "m", "list_max([part::DOUBLE for part in string_split(m, '.')]) <= 255"),
        ("card", r"[0-9](?:[\x20-]?[0-9])+", "translate(m, ' -', '')", """length(translate(m, ' -', '')) BETWEEN 14 AND 19 AND list_sum([
            CASE WHEN k % 2 = 1 THEN d ELSE 2 * d - CASE WHEN d > 4 THEN 9 ELSE 0 END END for d, k in [c::INT for c in string_split(reverse(translate(m, ' -', '')), '')]]) % 10 = 0"""),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "translate(m, '+ ().-', '')", "length(translate(m, '+ ().-', '')) BETWEEN 10 AND 15"),
    )))


def _side(side: str, begin: str, cut: str) -> str:
    return f"""SELECT row, entity, lower(t[i]) AS term, {begin} + coalesce(list_sum([length(x) + 1 for x in t[1:i - 1]]), 0) AS start, length(t[i]) AS long
        FROM (SELECT *, string_split_regex({side}, '[^\\p{{L}}\\p{{N}}]') AS t, unnest(range(1, len(t) + 1)) AS i FROM named)
        WHERE t[i] <> '' AND ({cut} OR length({side}) < {disclosure.REACH})"""


DISCLOSURE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS key FROM documents),
found AS ({_FOUND}),
named AS (SELECT *, kind || ':' || value AS entity FROM found),
near AS (SELECT row, entity, term, start, start + long AS "end" FROM ({_side("before", "start - length(before)", "i > 1")}
    UNION ALL {_side("after", '"end"', "i < len(t)")})),
size AS (SELECT count(*)::DOUBLE AS total FROM docs),
df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT row, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM docs) GROUP BY term),
entities AS (SELECT entity, count(DISTINCT row) AS n_entity FROM named GROUP BY entity),
pairs AS (SELECT entity, term, count(DISTINCT near.row) AS n_both, count(DISTINCT key) AS texts FROM near JOIN docs ON docs.row = near.row GROUP BY entity, term),
told AS (
    SELECT pairs.entity, pairs.term, CASE WHEN n_entity < total THEN log2(total * n_both / (n_entity * df)) / log2(total / n_entity) ELSE 0 END AS disclosure
    FROM pairs JOIN entities ON entities.entity = pairs.entity JOIN df ON df.term = pairs.term, size WHERE texts >= {disclosure.MIN_TEXTS}
),
marks AS (
    SELECT row, start, "end", max(disclosure) >= {disclosure.REMOVE} AS gone FROM near JOIN told ON told.entity = near.entity AND told.term = near.term
    WHERE disclosure >= {disclosure.GENERALISE} GROUP BY row, start, "end"
),
spans AS (
    SELECT row, start, rank, "end", kind FROM found
    UNION ALL SELECT row, start, CASE WHEN gone THEN 5 ELSE 4 END, "end", CASE WHEN gone THEN 'removed' ELSE 'generalised' END FROM marks
    WHERE NOT EXISTS (SELECT 1 FROM found WHERE found.row = marks.row AND found.start < marks."end" AND found."end" > marks.start)
),
joined AS (
    SELECT row, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip, count(*) FILTER (rank = 2) AS n_card, count(*) FILTER (rank = 3) AS n_phone,
        string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
        string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) AS spans FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN joined ON joined.row = docs.row
""".replace("\\\\", "\\")
