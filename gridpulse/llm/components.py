"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from gridpulse.llm.common import discard, join_unique, stored
from gridpulse.session import ship_package

MAX_ROUNDS = 60
# Edges that a task turns into stars at once.
EDGES_AT_ONCE = 1 << 18


def stars(a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Edges that connect the same nodes: each node but the smallest of its component here, once, with that smallest."""
    nodes = pc.unique(pa.concat_arrays([a, b]))
    nodes = nodes.take(pc.sort_indices(nodes))
    left, right = (pc.index_in(x, nodes).to_numpy(zero_copy_only=False) for x in (a, b))
    root = np.arange(len(nodes))
    while True:  # roots hang themselves on the smallest root beside them
        left, right = root[left], root[right]
        apart = left != right
        left, right = left[apart], right[apart]
        if not len(left):
            break
        np.minimum.at(root, np.maximum(left, right), np.minimum(left, right))
        while (root[root] != root).any():
            root = root[root]
    leaves = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes.take(pa.array(leaves)), nodes.take(pa.array(root[leaves]))


def forests(edges: DataFrame, together: bool = False) -> DataFrame:
    """``a, b``, ``a > b``: every task's edges (not null, no loops) as stars, ``EDGES_AT_ONCE`` or so at a time. A node is an ``a`` once in each of them.

    ``together``: the edges are sorted by ``a``, and those of one ``a`` go into one piece.
    """
    ship_package(edges.sparkSession)
    edges = edges.select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def star(piece: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*stars(*(pa.concat_arrays(piece[c].chunks) for c in ("a", "b")))], names=["a", "b"])

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= EDGES_AT_ONCE:
                piece = pa.Table.from_batches(held)
                cut = pc.index(piece["a"], piece["a"][-1]).as_py() if together else rows
                if cut:
                    yield star(piece.slice(0, cut))
                    held, rows = piece.slice(cut).to_batches(), rows - cut
        if rows:
            yield star(pa.Table.from_batches(held))

    return edges.mapInArrow(run, edges.schema)


def _seen(now: DataFrame) -> DataFrame:
    """Of every ``node``: the smallest node that it sees or is (``low``), whether it sees a smaller one and yet another (``open``), and how many
    edges lead to larger ones (``larger``). Without open nodes the edges are stars. Partial sums, so a node with many edges is no task's."""
    both = now.select(F.col("a").alias("node"), F.col("b").alias("other"), F.lit(0).alias("up")).unionByName(
        now.select(F.col("b").alias("node"), F.col("a").alias("other"), F.lit(1).alias("up")))
    low, high = F.min("other"), F.max("other")
    return stored(both.groupBy("node").agg(
        F.least("node", low).alias("low"), ((low < F.col("node")) & (low != high)).alias("open"), F.sum("up").alias("larger")), "seen")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``edges`` (``a, b``, of one type): the component is the smallest node in it.

    Tasks make the edges that they read stars. A round then hangs each node on the smallest neighbour of what it hangs on (a large star; a node
    with many edges is dealt to several tasks) and makes stars of the edges of each upper node, which meet in one task: no more of a node than
    there were tasks that read. Rounds grow with the logarithm of the size, edges never grow in number, and nothing but one flag and one sum per
    round reaches the driver. Loops and repeated edges are allowed; no edges give no rows.
    """
    edges, before = edges.filter("a <> b"), []
    for _ in range(MAX_ROUNDS):
        now = stored(forests(edges), "edges")
        discard(*before)
        seen = _seen(now)
        if not seen.agg(F.max("open")).first()[0]:
            discard(now)
            return seen.select("node", F.col("low").alias("component"))
        lower = seen.filter("larger > 0 AND low <> node").select(F.col("node").alias("b"), "low")
        counts = seen.filter("larger > 0").select(F.col("node").alias("b"), F.col("larger").alias("rows_of_key"))
        hung = join_unique(now, lower, ["b"], counts, "left").select("a", F.coalesce("low", "b").alias("b"))
        edges = stored(forests(hung.repartition("a").sortWithinPartitions("a"), together=True), "hung")
        discard(now, seen)
        before = [edges]
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
