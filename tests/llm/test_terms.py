"""Spelling variants, disclosure and whitening against brute force, with the awkward rows that tables can have."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import disclosure, spelling, whitening

DOCS = "doc_id long, text string, word string, n long, key string"  # the last three clash with names inside the operators


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, None) for i, t in rows], DOCS)


# --- spelling variants -------------------------------------------------------------------------

def brute_vocabulary(rows):
    counted = Counter()
    for doc_id, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counted[run] += 1
    return {w: n for w, n in counted.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows):
    words = brute_vocabulary(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-words[v], v))
            if words[best] >= 5 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def variants(spark, rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(documents(spark, rows)).collect()}


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    letters = "abÀé÷ÿ"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(40)]

    def mutated(stem):
        at, kind = rng.randrange(len(stem) + 1), rng.randrange(4)
        if kind == 0:
            return stem
        if kind == 1:
            return stem[:at] + rng.choice(letters) + stem[at:]
        return stem[:at] + (rng.choice(letters) if kind == 2 else "") + stem[at + 1:]

    rows = [(i, " ".join(mutated(rng.choice(stems)) for _ in range(60)).upper() if i % 9 == 0 else
             ". ".join(mutated(rng.choice(stems)) for _ in range(60))) for i in range(200)]
    rows += [(None, None), (None, " ".join(stems * 3)), (3, ""), (4, None), rows[5], rows[5]]
    got = variants(spark, rows)
    assert got == brute_variants(rows) and sum(v[3] for v in got.values()) > 100 and any(v[0] for v in got.values())


def test_chains_of_forms_and_ties(spark):
    """Counts that grow by five at each step make a chain; of equally frequent neighbours the first in code-point order counts."""
    counts = {"abcdefgh": 5, "abcdefghi": 30, "abcdefghij": 200, "qqqqqqa": 5, "qqqqqqb": 40, "qqqqqqc": 40}
    rows = [(1, " ".join(w for w, n in counts.items() for _ in range(n)))]
    got = variants(spark, rows)
    assert got == brute_variants(rows)
    assert got["abcdefgh"][:2] == ("abcdefghi", "abcdefghij") and got["qqqqqqa"][0] == "qqqqqqb"


def test_long_words_and_crowded_prefixes(spark):
    """Words of thousands of letters take rounds by the logarithm of their length; one prefix may be that of most words."""
    rng = random.Random(5)
    long = "".join(rng.choice("abc") for _ in range(3000))
    crowd = [f"{'common' * 2}{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    words = [long, long[:1500] + "z" + long[1500:], "y" + long, long + "x", long[:2999], *crowd]
    rows = [(i, " ".join(words)) for i in range(5)]
    got = variants(spark, rows)
    want = brute_variants([(i, " ".join(words[:5])) for i in range(5)])
    assert {w: got[w] for w in want} == want and got[long][3] == 4
    assert all(got[w][3] == 18 for w in crowd if w in got and spelling._mangled(0, w) == w) or len(got) > 100


def test_no_words(spark):
    assert variants(spark, []) == {} and variants(spark, [(1, None), (2, ""), (None, "12 34")]) == {}


# --- disclosure --------------------------------------------------------------------------------

def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PLAIN = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True, str.lower),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m.split(".")), str),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 14 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m)), lambda m: re.sub("[ -]", "", m)),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15, lambda m: re.sub("[^0-9]", "", m)),
]
WORD = re.compile(r"[^\W_]+")


def plain_mentions(text):
    """(start, rank, end, kind, value, before, after) of the passing matches; neighbours are bounded by the next match of the kind."""
    out = []
    for rank, (kind, pattern, passes, value) in enumerate(PLAIN):
        matches = list(pattern.finditer(text))
        for i, m in enumerate(matches):
            if passes(m.group()):
                low = matches[i - 1].end() if i else 0
                high = matches[i + 1].start() if i + 1 < len(matches) else len(text)
                out.append((m.start(), rank, m.end(), kind, value(m.group()), max(low, m.start() - disclosure.REACH), min(high, m.end() + disclosure.REACH), low, high))
    return sorted(out)


def plain_scan(rows, min_texts):
    texts = [(t or "") for _, t in rows]
    near, names, df = defaultdict(set), defaultdict(set), Counter()
    marks = []
    for row, text in enumerate(texts):
        df.update({w.lower() for w in WORD.findall(text)})
        for start, rank, end, kind, value, low, high, lowest, highest in plain_mentions(text):
            entity = (kind, value)
            names[entity].add(row)
            for at, stop, cut_front, cut_back in ((low, start, start - low == disclosure.REACH, False), (end, high, False, high - end == disclosure.REACH)):
                for m in WORD.finditer(text, at, stop):
                    if cut_front and m.start() == at or cut_back and m.end() == stop:
                        continue
                    near[entity, m.group().lower()].add(row)
                    marks.append((row, m.start(), m.end(), entity, m.group().lower()))
    n = len(texts)

    def strength(entity, term):
        rows_ = near[entity, term]
        if len({texts[r] for r in rows_}) < min_texts or len(names[entity]) >= n:
            return 0.0
        return math.log2(n * len(rows_) / (len(names[entity]) * df[term])) / math.log2(n / len(names[entity]))

    added = [dict() for _ in texts]
    for row, start, end, entity, term in marks:
        s = strength(entity, term)
        if s >= disclosure.GENERALISE and not any(b[0] < end and b[2] > start for b in plain_mentions(texts[row])):
            added[row][start, end] = max(added[row].get((start, end), 0.0), s)
    out = []
    for row, (doc_id, _) in enumerate(rows):
        base = [(b[0], b[1], b[2], b[3]) for b in plain_mentions(texts[row])]
        more = [(s, 5, e, "removed") if v >= disclosure.REMOVE else (s, 4, e, "generalised") for (s, e), v in added[row].items()]
        out.append((doc_id, tuple(base), tuple(sorted(more))))
    return Counter(out)


def scanned(spark, rows, min_texts=disclosure.MIN_TEXTS):
    return Counter(
        (r.doc_id, tuple(tuple(s) for s in r.base), tuple(tuple(s) for s in r.added))
        for r in disclosure.scan(documents(spark, rows), min_texts).collect())


def corpus():
    rng = random.Random(11)
    filler = [f"word{k}" for k in range(300)]
    say = lambda k: " ".join(rng.choice(filler) for _ in range(k))
    rows = [(i, say(30)) for i in range(60)]
    rows += [(100 + i, f"{say(20)} Zebulon Quist (accounts) writes from zq@corp.example.org, {say(25)}") for i in range(6)]
    rows += [(200 + i, f"{say(10)} call Mirabel at +1 (555) 010-99{i % 2}0 or 10.0.0.{i} {say(12)}") for i in range(8)]
    rows += [(300, f"{say(9)} Zebulon accounts"), (301, None), (None, None), (None, rows[62][1]), rows[61], rows[61], (302, "")]
    rows += [(303, "1.2.3.4.5.6.7.8 999.1.1.1 +1 23 a@b.c_d@e.f @x.y me@here. 4111 1111-1111 1111 4111111111111112")]
    return rows


def test_scan_equals_brute_force(spark):
    rows = corpus()
    for min_texts in (3, 1):
        got = scanned(spark, rows, min_texts)
        assert got == plain_scan(rows, min_texts)
        assert {kind for _, _, more in got for *_, kind in more} <= {"generalised", "removed"} and any(more for _, _, more in got)


def test_sanitised_texts(spark):
    texts = {r.doc_id: r.text for r in disclosure.sanitise(documents(spark, corpus())).collect() if r.doc_id is not None}
    assert "[email]" in texts[100] and "Quist" not in texts[100] and "zq@" not in texts[100]
    assert "[phone]" in texts[200] and texts[300].endswith("Zebulon accounts") and texts[301] == ""


def plain_whole_scan(rows, min_texts):
    """As ``plain_scan``, with every word of a text near all its mentions."""
    texts = [t or "" for _, t in rows]
    terms = [{w.lower() for w in WORD.findall(t)} for t in texts]
    df, names = Counter(t for found in terms for t in found), defaultdict(set)
    for row, text in enumerate(texts):
        for _, _, _, kind, value, *_ in plain_mentions(text):
            names[kind, value].add(row)
    n, added = len(texts), [dict() for _ in texts]
    for named in names.values():
        both = defaultdict(set)
        for row in named:
            for term in terms[row]:
                both[term].add(row)
        for term, in_rows in both.items():
            if len(named) == n or len({texts[r] for r in in_rows}) < min_texts:
                continue
            s = math.log2(n * len(in_rows) / (len(named) * df[term])) / math.log2(n / len(named))
            for row in in_rows if s >= disclosure.GENERALISE else ():
                for m in WORD.finditer(texts[row]):
                    if m.group().lower() == term and not any(b[0] < m.end() and b[2] > m.start() for b in plain_mentions(texts[row])):
                        added[row][m.span()] = max(added[row].get(m.span(), 0.0), s)
    return Counter(
        (doc_id, tuple(b[:4] for b in plain_mentions(texts[row])),
         tuple(sorted((s, 5, e, "removed") if v >= disclosure.REMOVE else (s, 4, e, "generalised") for (s, e), v in added[row].items())))
        for row, (doc_id, _) in enumerate(rows))


def far_corpus():
    """Names that stand 40 words before an address, after it beyond another match, and in a text without it."""
    rng = random.Random(12)
    say = lambda k: " ".join(f"word{rng.randrange(200)}" for _ in range(k))
    rows = corpus() + [(400 + i, f"Ottokar \U0001f600 {say(40)} ok@corp.example.org {say(3)} other{i}@corp.example.org {say(30)} ottokar, Brun") for i in range(4)]
    return rows + [(410, f"{say(10)} Ottokar Brun"), (411, f"{say(10)} Brun")]


def test_whole_texts_equal_brute_force(spark):
    rows = far_corpus()
    for min_texts in (3, 1):
        got = Counter(
            (r.doc_id, tuple(tuple(s) for s in r.base), tuple(tuple(s) for s in r.added))
            for r in disclosure.scan(documents(spark, rows), min_texts, whole=True).collect())
        assert got == plain_whole_scan(rows, min_texts)


def test_far_names_disclose_in_whole_texts(spark):
    docs = documents(spark, far_corpus())
    near, whole = ({r.doc_id: r.text for r in disclosure.sanitise(docs, whole=w).collect()} for w in (False, True))
    assert all("ttokar" in near[400 + i] and "ttokar" not in whole[400 + i] and "Brun" not in whole[400 + i] for i in range(4))
    assert whole[410].endswith("Ottokar Brun") and "Quist" not in whole[100]


def test_whole_texts_with_odd_letters_and_no_mentions(spark):
    """Words whose lower case depends on their neighbours, or is longer, are known as they stand; tables without evidence give no spans."""
    rows = [(i, f"\u0130zmir \u0391\u03a3.\u0392 {i} fine words{i} here odd@corp.example.org") for i in range(4)] + [(10 + i, f"fine words{i} here") for i in range(60)]
    added = {r.doc_id: [(s.start, s.end) for s in r.added] for r in disclosure.scan(documents(spark, rows), whole=True).collect()}
    assert all(added[i] == [(0, 5), (6, 8), (9, 10)] for i in range(4)) and not any(added[10 + i] for i in range(60))
    assert disclosure.scan(documents(spark, []), whole=True).count() == 0
    assert [r.added for r in disclosure.scan(documents(spark, [(1, None), (2, "a@b.cd e")]), whole=True).orderBy("doc_id").collect()] == [[], []]


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "a@b" + ".c" * 50_000, "1 " * 100_000, "+1" + " " * 100_000, "x@y.zz " * 3000])
def test_long_texts_take_linear_time(spark, text):
    (got,) = disclosure.scan(documents(spark, [(1, text)])).collect()
    base = [(b[0], b[1], b[2], b[3]) for b in plain_mentions(text)] if "y.zz" in text or "@b" in text else [tuple(s) for s in got.base]
    assert [tuple(s) for s in got.base] == base


def test_query_columns_and_empty_table(spark):
    assert disclosure.scan(documents(spark, [])).count() == 0
    row = disclosure.scan(documents(spark, [(1, None)])).select(F.sha2(disclosure.written(F.col("base")), 256).alias("h")).first()
    assert row.h == hashlib.sha256(b"").hexdigest()


# --- whitening ---------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, x string, w long, y int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x", 1, 2) for i, v in rows], VECTORS)


def brute_whitening(v, components, counted=True):
    x = np.floor(64 * np.asarray(v, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = x if counted else np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    z = (n * fit - s) / n
    values, vectors_ = np.linalg.eigh(z.T @ z / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    deviation = ((n * x - s).astype(object) ** 2).sum(1)
    return n, deviation, ((n * x - s) / n) @ vectors_[:, :components] / np.sqrt(values[:components]), values[:components] / values.sum()


@pytest.mark.parametrize("counted", [True, False])
def test_whitening_equals_numpy(spark, counted):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(120, 6)) @ rng.normal(size=(6, 6))
    v[40:90] = v[3]  # a vector that many rows share
    rows = [(i, r) for i, r in enumerate(v)] + [(1000, None), (1001, [1, 2, None, 4, 5, 6]), (1002, [1, 2, float("nan"), 4, 5, 6]),
                                                (1003, [1, 2, float("inf"), 4, 5, 6]), (1004, [1.0]), (1005, [1e30] * 6), (None, v[7]), (5, v[5])]
    kept = np.vstack([v, v[7], v[5]])
    got = whitening.whiten(vectors(spark, rows), components=4, counted=counted).toPandas()
    n, deviation, whitened, explained = brute_whitening(kept, 4, counted)
    assert len(got) == 4 * len(kept) and set(got["n"]) == {n} and got["identity_error"].max() < 1e-9
    wide = got[got.vec_id.notna()].drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((wide * whitened[:120]).sum(0))
    assert np.allclose(wide * sign, whitened[:120], rtol=1e-9, atol=1e-9)
    assert got[got.vec_id.isna()]["component"].tolist() == [1, 2, 3, 4] and (got.vec_id == 5).sum() == 8
    by_id = got.drop_duplicates("vec_id").set_index("vec_id")["deviation"]
    assert [int(by_id[i]) for i in range(120)] == [int(d) for d in deviation[:120]]
    assert np.allclose(got.drop_duplicates("component").sort_values("component")["explained"], explained)


def test_whitening_without_variance(spark):
    one = whitening.whiten(vectors(spark, [(1, [1, 2, 3])])).toPandas()
    assert one["component"].tolist() == [1, 2, 3] and one["whitened"].isna().all() and (one["deviation"] == 0).all()
    flat = whitening.whiten(vectors(spark, [(i, [i, 2 * i, 5]) for i in range(10)])).toPandas()
    assert flat[flat.component == 1]["whitened"].notna().all() and flat[flat.component == 3]["whitened"].isna().all()
    assert flat["identity_error"].max() < 1e-9
    assert whitening.whiten(vectors(spark, [])).count() == 0 and whitening.whiten(vectors(spark, [(1, []), (2, None)])).count() == 0


def test_exact_sums_beyond_64_bits(spark):
    """Large entries: the products of counts and numbers do not fit into longs, sums and deviations stay exact."""
    rows = [(i, [2.0 ** 44 * (i % 3), float(i)]) for i in range(9)]
    got = whitening.whiten(vectors(spark, rows)).toPandas().drop_duplicates("vec_id").set_index("vec_id")["deviation"]
    x = [[int(64 * c) + 1_000_000 for c in map(float, np.asarray(v, np.float32))] for _, v in rows]
    sums = [sum(r[k] for r in x) for k in range(2)]
    assert [int(got[i]) for i in range(9)] == [sum((9 * r[k] - sums[k]) ** 2 for k in range(2)) for r in x]
