"""Similarity join on word n-grams: grouped prefixes, filtered by the rarest of them, verified in blocks, components of the links."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from gridpulse.llm.common import broadcast_ids, discard, join_unique, rolling_hashes, signed, stored, word_hashes
from gridpulse.llm.components import components
from gridpulse.session import ship_package

SHINGLE_WORDS = 3
PERCENT = 90
# Members of a set, by hash, that are kept: so many prefixes long, and some for small sets.
LISTED_PREFIXES, LISTED_MORE = 3, 8
# Shingles that so many lists have, or fewer, are equally good probes.
FREQUENT_FROM = 1
# Texts per side of a verification tile, and shingles per text that a side has room for.
TILE = 1024
ROOM = 1000
_COLUMNS_AT_ONCE = 4096

SIGNATURES = "doc_id long, n_shingles long, k1 binary, grp long, trusted long, prefix binary"
LINKED = "k1 binary, root binary, links long"


def shingles(text: str | None, n: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a text with fewer words is one shingle, without words none."""
    tokens = text.encode("utf-8").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < n:
        return np.asarray([xxhash.xxh3_64_intdigest(b" ".join(tokens), len(tokens))], np.uint64)
    return np.unique(rolling_hashes(word_hashes(tokens), n))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Of two sets that link, each has a common member among its first so many in any fixed order of all members."""
    return n - -(-percent * n // 100) + 1


def listed(n: int, percent: int = PERCENT) -> int:
    """How many members of a set, its first ones by hash, are listed."""
    return min(n, LISTED_PREFIXES * prefix_size(n, percent) + LISTED_MORE)


@lru_cache(maxsize=100_000)
def trusted(n: int, percent: int = PERCENT) -> int:
    """How many first members of a set of size n are sure to be listed by every set that links with it and has them.

    Let the other set have m members, o of them common. A common member in place r here has at most ``r + m - o`` members of the other set
    before it or at it, so it is listed there if that is within the list. The least common o for a link decides.
    """
    m = np.arange(-(-percent * n // 100), 100 * n // percent + 1)
    common = -(-percent * (n + m) // (100 + percent))
    prefix = m - -(-percent * m // 100) + 1
    whole = np.minimum(m, LISTED_PREFIXES * prefix + LISTED_MORE)
    sure = np.where(whole == m, n, whole - (m - common))
    return int(max(0, min(n, listed(n, percent), sure.min())))


def set_key(found: np.ndarray) -> bytes:
    """The 128-bit key of a set."""
    return xxhash.xxh3_128_digest(found.tobytes())


def _batched(df: DataFrame, schema: str, rows) -> DataFrame:
    """Arrow stage over ``text`` and ``doc_id``: ``rows(doc_id, text)`` gives a row per text."""
    ship_package(df.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = pa.schema([(n, pa.binary() if c.endswith("binary") else pa.int64()) for n, c in zip(names, schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512).to_pydict()
                columns = zip(*(rows(d, t) for d, t in zip(part["doc_id"], part["text"])))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k.type) for c, k in zip(columns, kinds)], schema=kinds)

    return df.select("doc_id", "text").mapInArrow(run, schema)


def signatures(docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS) -> DataFrame:
    """``SIGNATURES`` of every row: ``prefix`` lists the first members by hash; rows with equal lists and sizes are one group ``grp``."""

    def row(doc_id, text):
        found = shingles(text, words)
        n = len(found)
        first = found[:listed(n, percent)].tobytes()
        group = int(signed(np.asarray([xxhash.xxh3_64_intdigest(first, n)], np.uint64))[0])
        return doc_id, n, set_key(found), group, trusted(n, percent) if n else 0, first

    return _batched(docs, SIGNATURES, row)


def unpacked(groups: DataFrame) -> DataFrame:
    """``grp, band, token, early``: one row per listed member, with the group's size band; early is 1 for the ``trusted`` first ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                values = part.column("prefix").to_pylist()
                sizes = np.fromiter((len(v) // 8 for v in values), np.int64, len(values))
                place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                early = place < np.repeat(part.column("trusted").to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(part.column("grp").to_numpy(), sizes)), pa.array(np.repeat(part.column("band").to_numpy(), sizes)),
                    pa.array(np.frombuffer(b"".join(values), np.int64)), pa.array(early.astype(np.int8))], names=["grp", "band", "token", "early"])

    return groups.select("grp", "band", "trusted", "prefix").mapInArrow(run, "grp long, band int, token long, early byte")


def size_band(n: str = "n_shingles", percent: int = PERCENT):
    """Sizes in bands: sets that link are in the same band or in neighbouring ones."""
    return F.floor(F.log(F.col(n).cast("double")) / F.lit(float(np.log(100 / percent))) + F.lit(1e-9)).cast("int")


def repeated_members(groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``grp, band, token, early, n`` of the listed members that n > 1 groups list, stored. Most members are listed once and go no further."""
    members = unpacked(groups.withColumn("band", size_band(percent=percent)))
    counts = stored(members.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"), "counts")
    found = stored(join_unique(members, counts, ["token"], counts.select("token", F.col("n").alias("rows_of_key"))), "repeated")
    discard(counts)
    return found


def probes(repeated: DataFrame, sizes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``token, band``: what each group that can link looks for, the rarest of its trusted members.

    Two sets that link differ in fewer members than a prefix has. So of any ``prefix_size`` trusted members at least one is listed by the
    other set too, and the choice is free: the members that fewest groups list. Those that no other group lists find nothing, so a group with a
    prefix of them links with none.
    """
    prefix = F.expr(f"n_shingles - ({percent} * n_shingles + 99) div 100 + 1")
    own = repeated.filter("early = 1").join(sizes, "grp")
    order = Window.partitionBy("grp", "n_shingles").orderBy(F.greatest("n", F.lit(FREQUENT_FROM)), "token")
    whole = Window.partitionBy("grp", "n_shingles")
    placed = own.withColumn("place", F.row_number().over(order)).withColumn("alone", F.col("trusted") - F.count("*").over(whole))
    return placed.filter(F.col("place") <= prefix - F.col("alone")).select("token", "band").distinct()


def candidate_edges(groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges ``a, b`` between groups, stored, so that all groups which can link are connected. A shingle that m groups list gives m edges or
    fewer, never its pairs; counts combine before the shuffle."""
    sizes = stored(groups.select("grp", "n_shingles", "trusted"), "sizes")
    repeated = repeated_members(groups, percent)
    asked = stored(probes(repeated, sizes, percent), "probes")
    near = asked.select("token", F.explode(F.expr("array(band - 1, band, band + 1)")).alias("band")).distinct()
    posting = stored(repeated.select("grp", "token", "band").join(near, ["token", "band"], "left_semi"), "posting")
    lists = stored(posting.groupBy("token", "band").agg(
        F.min("grp").alias("low"), F.max("grp").alias("high"), F.count("*").alias("rows_of_key")), "posting-heads")
    inside = lists.filter("low <> high").select("token", "band", "low")
    starred = join_unique(posting, inside, ["token", "band"], lists.select("token", "band", "rows_of_key")).filter("grp <> low").select(
        F.col("grp").alias("a"), F.col("low").alias("b"))
    following = lists.select("token", (F.col("band") - 1).alias("band"), F.col("low").alias("next"))
    across = lists.join(following, ["token", "band"]).select(F.col("low").alias("a"), F.col("next").alias("b"))
    edges = stored(starred.unionByName(across).distinct(), "candidates")
    discard(sizes, repeated, asked, posting, lists)
    return edges


def tiles(members: DataFrame, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """``members`` (``block``, ``k1``, ``n_shingles``, …) dealt to verification tiles: adds ``tile``, ``side``.

    A block of up to two sides is one tile. A larger one is cut into chunks of one size band each, and a tile is a pair of chunks of the
    same or neighbouring bands: each pair of texts that can link meets in exactly one tile, on two sides or on one (``side`` 0). A side
    has about ``tile`` texts or, of long ones, ``tile * ROOM`` shingles.
    """
    banded = members.withColumn("band", size_band(percent=percent))
    sides = F.greatest(F.count("*").cast("double"), F.sum("n_shingles") / ROOM) / tile
    sizes = stored(banded.groupBy("block", "band").agg(F.count("*").alias("n"), sides.alias("sides")), "block-sizes")
    totals = sizes.groupBy("block").agg(F.sum("sides").alias("total"), F.sum("n").alias("texts")).filter("texts > 1").drop("texts")
    chunks = sizes.join(totals, "block").withColumn(
        "chunks", F.when(F.col("total") <= 2, F.lit(0)).otherwise(F.ceil("sides"))).drop("n", "sides")
    beside = [
        chunks.select("block", (F.col("band") + step).alias("band"), F.col("chunks").alias(name))
        for step, name in ((1, "below"), (-1, "above"))
    ]
    planned = chunks.join(beside[0], ["block", "band"], "left").join(beside[1], ["block", "band"], "left")
    dealt = join_unique(banded, planned, ["block", "band"], sizes.select("block", "band", F.col("n").alias("rows_of_key"))).withColumn(
        "own", F.when(F.col("chunks") > 0, F.pmod(F.xxhash64("k1"), F.col("chunks"))).otherwise(F.lit(0)))
    where = F.expr("""
        CASE WHEN chunks = 0 THEN array(struct(concat_ws('/', block) AS tile, 0 AS side)) ELSE concat(
            transform(sequence(0, chunks - 1), j -> struct(
                concat_ws('/', block, band, least(own, j), band, greatest(own, j)) AS tile,
                CASE WHEN j = own THEN 0 WHEN own < j THEN 1 ELSE 2 END AS side)),
            transform(filter(sequence(0, coalesce(above, 0)), j -> j < coalesce(above, 0)), j -> struct(
                concat_ws('/', block, band, own, band + 1, j) AS tile, 1 AS side)),
            transform(filter(sequence(0, coalesce(below, 0)), j -> j < coalesce(below, 0)), j -> struct(
                concat_ws('/', block, band - 1, j, band, own) AS tile, 2 AS side))
        ) END""")
    return dealt.select("k1", "doc_id", "copies", F.explode(where).alias("t")).select("k1", "doc_id", "copies", "t.tile", "t.side")


def tile_links(keys: list[bytes], copies: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT):
    """``(key, root, links)`` of the texts in one tile that link: a spanning forest, and linked texts counted with their copies."""
    m, lengths = len(sets), np.fromiter(map(len, sets), np.int64, len(sets))
    members = np.concatenate(sets)
    order = np.argsort(members)
    members = members[order]
    starts = np.flatnonzero(np.concatenate(([True], members[1:] != members[:-1])))
    times = np.diff(np.append(starts, len(members)))
    shared = np.repeat(times > 1, times)  # the others are in one text only
    owner = np.repeat(np.arange(m, dtype=np.int32), lengths)[order[shared]]
    token = np.repeat(np.arange((times > 1).sum()), times[times > 1])
    del members, order, shared
    common, width = np.zeros((m, m), np.float32), int(token[-1]) + 1 if len(token) else 0
    for low in range(0, width, _COLUMNS_AT_ONCE):
        first, last = np.searchsorted(token, [low, low + _COLUMNS_AT_ONCE])
        part = np.zeros((m, min(_COLUMNS_AT_ONCE, width - low)), np.float32)
        part[owner[first:last], token[first:last] - low] = 1
        common += part @ part.T
    union = lengths[:, None] + lengths[None, :] - common
    linked = 100 * common >= percent * union
    if sides.any():
        linked &= sides[:, None] != sides[None, :]
    np.fill_diagonal(linked, False)
    root = np.arange(m)
    while True:  # smallest neighbour, until nothing changes
        lower = np.minimum(root, np.where(linked, root[None, :], m).min(axis=1))
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    links = linked @ copies
    return [(keys[i], keys[root[i]], int(links[i])) for i in np.flatnonzero(linked.any(axis=1))]


def verified(dealt: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS) -> DataFrame:
    """``LINKED`` from ``tile, side, k1, copies, text``: every tile is gathered by itself, of bounded size. Texts of another key do not count."""
    ship_package(dealt.sparkSession)
    kinds = pa.schema([("k1", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield from zip(*(part.column(c).to_pylist() for c in ("tile", "side", "k1", "copies", "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, own in groupby(rows(batches), key=lambda r: r[0]):
            found = {}
            for _, side, key, copies, text in own:
                if set_key(own_set := shingles(text, words)) == key:
                    found[key] = (side, copies, own_set)
            if len(found) > 1:
                sides, copies, sets = zip(*found.values())
                out += tile_links([*found], np.asarray(copies, np.int64), np.asarray(sides), [*sets], percent)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], schema=kinds)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], schema=kinds)

    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "tile").sortWithinPartitions("tile").select(
        "tile", "side", "k1", "copies", "text").mapInArrow(run, LINKED)


def join(docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row: the smallest id reachable by links, and the number of linked rows.

    Two rows link when the Jaccard similarity of their sets of shingles of ``words`` words is at least ``percent`` hundredths.

    1. Rows with equal sets are one class; classes with equal listed members and size are one group.
    2. Groups are filtered: each looks for the rarest of its prefix among the members that others list (:func:`probes`). A group whose prefix nobody
       else lists is done. The others are connected by a linear number of edges; connected groups, expanded to their classes, are blocks.
       Two classes of different blocks cannot link.
    3. Blocks are verified in tiles of bounded size from the full sets. Only a spanning forest and counts leave a tile.

    Null and empty texts have no shingles, link with nothing and are their own component. Rows of one id count as different rows,
    rows without id too; a component of only such rows has a null ``component_id``. Columns beside ``doc_id`` and
    ``text`` play no part. An empty table gives no rows. Texts of any length are read whole; one with very many words lists a fixed share of them.
    Sets are told apart by 128 bits.
    """
    signed_docs = stored(signatures(docs, percent, words), "signatures")
    filled = signed_docs.filter("n_shingles > 0")
    classes = stored(filled.groupBy("k1", "n_shingles", "grp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first"), F.count("*").alias("copies")
    ).select("k1", "n_shingles", "grp", "copies", "first.doc_id"), "classes")
    groups = stored(filled.select("grp", "n_shingles", "trusted", "prefix").distinct(), "groups")
    crowded = classes.groupBy("grp").count().filter("count > 1").select(F.col("grp").alias("node"), F.col("grp").alias("component"))
    blocks = components(candidate_edges(groups, percent)).unionByName(crowded).groupBy("node").agg(F.min("component").alias("block"))
    discard(groups)
    inside = stored(classes.join(blocks, F.col("grp") == F.col("node")).select("block", "k1", "doc_id", "n_shingles", "copies"), "inside")
    dealt = stored(tiles(inside, percent), "tiles")
    texts = docs.select("doc_id", "text").join(broadcast_ids(inside.select("doc_id")), "doc_id", "left_semi")
    columns = ("tile", "side", "k1", "copies", "text")
    nameless = dealt.filter("doc_id IS NULL").join(texts_without_id(docs, words), "k1").select(*columns)
    linked = stored(verified(dealt.join(texts, "doc_id").select(*columns).unionByName(nameless), percent, words), "links")
    found = components(linked.select(F.col("k1").alias("a"), F.col("root").alias("b")))
    degree = linked.groupBy("k1").agg(F.sum("links").alias("links"))
    with_label = classes.select("k1", "n_shingles", "doc_id", "copies").join(
        found.withColumnRenamed("node", "k1"), "k1", "left").join(degree, "k1", "left")
    component = F.coalesce("component", "k1")
    named = with_label.groupBy(component.alias("component")).agg(F.min("doc_id").alias("component_id"))
    answer = with_label.withColumn("component", component).join(named, "component").select(
        "k1", "n_shingles", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed_docs.select("doc_id", "n_shingles", "k1").join(answer, ["k1", "n_shingles"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def texts_without_id(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``k1, text`` of the rows without id, one per set: they can only be found by their sets."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                keys = [set_key(shingles(t, words)) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), part.column("text")], names=["k1", "text"])

    return docs.filter("doc_id IS NULL").select("text").mapInArrow(run, "k1 binary, text string").dropDuplicates(["k1"])
