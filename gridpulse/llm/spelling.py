"""Spelling variants of a corpus' words: neighbours at one edit from a frontier over a trie that is a table, then forms and roots.

The trie is never in one place. A node is the hash of a prefix, the edge table has the labels that leave each node (letters, or
``END`` where a word ends), and search states ``(word, position, node, edits)`` meet it in joins, level by level:

* without edits a word walks its own path, so its states are its own prefixes. Two words one edit apart part at the end of their
  common prefix; a state therefore branches only where another label than the word's own leaves its node.
* Both a word and its mirror image are in the trie. An edit in the second half of a word is found on the word, one in the first
  half on the mirror image; so states begin at the middle, where few labels are left, and never at the crowded root.
* After the edit, a state lives as long as its next node exists. A node exists only if all above it do, so levels are taken in strides
  of 1, 2, 4, ...: the number of joins grows with the logarithm of the longest word.
* A state that ends at an ``END`` is a neighbour; the two words are compared in full. Prefixes of one hash can only add states, so hashes
  decide nothing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import count as counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.llm.common import stored
from gridpulse.session import ship_package

# Fixed values of the contract: letters, one run of a document in 199 loses a code point.
RUN = re.compile("[a-zÀ-ÿ]+")
TYPO_EVERY = 199
MIN_LENGTH, MIN_COUNT, FORM_TIMES = 6, 5, 5
END = ""


def _mangled(doc_id: object, run: str) -> str:
    """The run, or for one (document, run) pair in ``TYPO_EVERY`` the run without one of its code points."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % TYPO_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: letter runs of all texts, ASCII lower-cased, of at least ``min_length`` code points and ``min_count`` occurrences."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch, found = whole.slice(at, 1024), Counter()
                for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                    if text:
                        for token, times in Counter(RUN.findall(text.encode().lower().decode())).items():
                            word = _mangled(doc_id, token)
                            if len(word) >= min_length:
                                found[word] += times
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    counted = docs.select(F.col("doc_id").alias("id"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _facing(word: str = "word", back: str = "back") -> Column:
    """The word, or its mirror image."""
    return F.when(F.col(back), F.reverse(word)).otherwise(F.col(word))


def _node(prefix: Column) -> Column:
    """The node of a prefix; mirror images have a trie of their own."""
    return F.xxhash64("back", prefix)


def _walks(words: DataFrame, first: str) -> DataFrame:
    """``word, back, position, node, label``: every word's own way, forwards and mirrored, from position ``first`` (SQL) to its end."""
    both = words.select("word", F.explode(F.array(F.lit(False), F.lit(True))).alias("back")).withColumn("facing", _facing())
    each = both.select("word", "back", "facing", F.explode(F.expr(f"sequence(int({first}), length(word))")).alias("position"))
    return each.select("word", "back", "position", _node(F.expr("left(facing, position)")).alias("node"),
                       F.expr("substr(facing, position + 1, 1)").alias("label"))  # empty at the end: END


def trie_nodes(words: DataFrame) -> DataFrame:
    """``node, labels``: the labels that leave each node which a search can meet.

    Neighbours of a word with one code point less are met from the middle of that one on. Labels are as many as the alphabet has letters.
    """
    steps = _walks(words, "(length(word) - 1) div 2").select("node", "label").distinct()
    return steps.groupBy("node").agg(F.collect_list("label").alias("labels"))


def trie_edges(words: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, other, beyond``: the distributed edge table where ways part, with the labels that leave the node at the edge's end."""
    steps = _walks(words, "(length(word) - 1) div 2").filter(F.col("label") != END).withColumn("facing", _facing())
    edges = steps.select("node", F.col("label").alias("other"), _node(F.expr("left(facing, position + 1)")).alias("child")).distinct()
    parting = nodes.filter(F.size("labels") > 1).select("node")
    return edges.join(parting, "node", "left_semi").join(nodes.select(F.col("node").alias("child"), F.col("labels").alias("beyond")), "child").drop("child")


def _after_edit(words: DataFrame, edges: DataFrame) -> DataFrame:
    """States one level after the edit, ``word, back, target, position``: a letter put in or replaced where another way leaves the word's own.

    ``target`` is the neighbour to be found (facing the way of the walk), ``position`` how many of its code points are known to be a node.
    A letter taken out is the same pair as one put into the other word; of a replaced pair only the smaller word starts. Most ways end at
    once, because the first letter after the edit does not go on from there; they never leave the join.
    """
    met = _walks(words, "length(word) div 2").withColumn("facing", _facing()).join(edges, "node").filter("other <> label")
    put_in = F.array_contains("beyond", F.col("label"))
    after = F.expr("substr(facing, position + 2, 1)")
    replaced = (F.col("label") != END) & (F.col("other") > F.col("label")) & F.array_contains("beyond", after)
    known = F.when(put_in & replaced, F.array(F.lit(0), F.lit(1))).when(put_in, F.array(F.lit(0))).when(replaced, F.array(F.lit(1)))
    ways = met.select("word", "back", "facing", "position", "other", F.explode(known).alias("gone"))
    target = F.expr("concat(left(facing, position), other, substr(facing, position + 1 + gone))")
    return ways.select("word", "back", target.alias("target"), F.least(F.col("position") + 2, F.length(target)).alias("position"))


def neighbours(words: DataFrame) -> DataFrame:
    """``a, b``, once each way: distinct words that one inserted, deleted or replaced code point turns into one another.

    ``words`` has one row per word (``word``, stored). The frontier is stored after every join, so a lost executor costs one level. A node
    on the way of very many words is a skewed key of a plain join, which adaptive execution splits; no row of it has more than an alphabet.
    """
    nodes = stored(trie_nodes(words), "trie")
    frontier, found = stored(_after_edit(words, trie_edges(words, nodes)), "frontier"), []
    ends = nodes.select("node", F.array_contains("labels", END).alias("is_end"))
    at_end = F.col("position") == F.length("target")
    for level in counter(1):
        # At a target's end the node must end a word; before it, being a node is enough.
        checked = frontier.withColumn("node", _node(F.expr("left(target, position)"))).join(ends, "node").drop("node")
        alive = stored(checked.filter(~at_end | F.col("is_end")).select("word", "back", "target", "position"), "frontier")
        found.append(alive.filter(at_end).select("word", F.when(F.col("back"), F.reverse("target")).otherwise(F.col("target")).alias("other")))
        going = alive.filter(~at_end)
        if going.isEmpty():
            break
        frontier = going.withColumn("position", F.least(F.col("position") + (1 << level), F.length("target")))
    pairs = reduce(DataFrame.unionByName, found).select(F.col("word").alias("a"), F.col("other").alias("b"))
    pairs = pairs.filter(F.levenshtein("a", "b", 1) == 1)
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = FORM_TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of all ``docs`` (``doc_id, text``; other columns are ignored).

    A word's form is its most frequent neighbour (ties: the first in code-point order) if it has at least ``times`` its occurrences, its
    root where following forms ends. Null texts have no words; a null id counts as an empty one; repeated rows count again; texts and words of any
    length are read whole; an empty table gives no rows. The number of neighbours is bounded by the alphabet: a group by word is small.
    """
    words = stored(vocabulary(docs, min_length, min_count), "words")
    near = stored(neighbours(words), "near")
    told = near.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = told.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("minus"), F.col("b").alias("b"))).alias("best"))
    has_form = -F.col("best.minus") >= times * F.col("n")
    formed = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best.b")).alias("form"),
        F.when(has_form, -F.col("best.minus")).alias("form_n")), "forms")
    return formed.join(roots(formed.filter("form IS NOT NULL").select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(steps: DataFrame) -> DataFrame:
    """``word, root``: where following ``word -> form`` ends, by pointer jumping.

    Counts grow at every step, so there are no circles, and the rounds grow with the logarithm of the longest chain.
    """
    now = stored(steps.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = stored(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return now
