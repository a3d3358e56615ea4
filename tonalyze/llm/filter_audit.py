"""Filter interaction audit by Lehmer-rank difference arrays.

Five filters can be applied in 120 orders, and what a filter removes depends
on what the ones before it have removed already.  A document's outcome in
every order depends only on which filters it fails: its mask.  So the corpus
is read once and comes down to counts per part and mask (at most 32 a part).

The orders are ranked lexicographically.  All orders that begin with the same
filters have neighbouring ranks, and the first of them is found from the
beginning's Lehmer code.  A mask is removed at step s by filter f exactly in
the orders that begin with s-1 filters it passes and then f: an interval of
(5-s)! ranks.  Its count is added where the interval begins and taken off
where it ends; one prefix sum over the 120 ranks then gives what each step of
each order removes.

Identical texts are found through their SHA-256 digest: the smallest id per
digest is aggregated map-side, written, and joined back, so a text that a
third of all documents share is split like any skewed join key.

Defined results
    null or empty text   no words; fails A and nothing else but E
    null text and empty  count as identical texts
    very long text       read whole
    null id              fails E for nobody and never fails it; has no labels
    repeated rows        each row counts; rows of one id are not "smaller"
    repeated labels      a document is good (toxic) if any of its rows says so
    null source          part is the empty string
    empty table          empty result
    clashing columns     only doc_id, text and source are read
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalyze.llm.common import field, let, map_arrow, saved

MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SYMBOLS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("n", "good", "toxic")
PARTS_AT_ONCE = 64
RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_mask(text: Column) -> Column:
    """A = 1, B = 2, C = 4, D = 8, with the words of the text counted once."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))

    def bit(failed: Column, value: int) -> Column:
        return F.when(failed, F.lit(value)).otherwise(F.lit(0))

    by_words = let(words, lambda w: bit(F.size(w) < MIN_WORDS, 1)
                   + bit(100 * F.size(F.array_distinct(w)).cast("long") < DISTINCT_PERCENT * F.size(w).cast("long"), 2))
    return (by_words + bit(100 * capitals.cast("long") > CAPITAL_PERCENT * F.length(text).cast("long"), 4)
            + bit(text.rlike(SYMBOLS), 8))


def lehmer_rank(head: str, letters: str) -> int:
    """Rank of the first order of ``letters`` that begins with ``head``."""
    left, rank = sorted(letters), 0
    for c in head:
        at = left.index(c)
        rank += at * factorial(len(left) - 1)
        del left[at]
    return rank


def intervals(letters: str) -> list[tuple[int, int, int, int]]:
    """(mask, step from 0, first rank, rank past the last) of every removal."""
    found, k = [], len(letters)
    for mask in range(1, 1 << k):
        passes = [c for i, c in enumerate(letters) if not mask >> i & 1]
        fails = [c for i, c in enumerate(letters) if mask >> i & 1]
        for step in range(len(passes) + 1):
            for head in permutations(passes, step):
                for f in fails:
                    first = lehmer_rank("".join(head) + f, letters)
                    found.append((mask, step, first, first + factorial(k - 1 - step)))
    return found


def removed_by_rank(counts: np.ndarray, letters: str) -> np.ndarray:
    """(parts, ranks, steps, measures) removed, from (parts, masks, measures)."""
    k = len(letters)
    change = np.zeros((len(counts), factorial(k) + 1, k, counts.shape[2]), np.int64)
    for mask, step, first, stop in intervals(letters):
        change[:, first, step] += counts[:, mask]
        change[:, stop, step] -= counts[:, mask]
    return np.cumsum(change, axis=1)[:, :-1]


def _totals(batches: Iterator[pa.RecordBatch], letters: str) -> Iterator[pa.RecordBatch]:
    k = len(letters)
    orders = ["".join(o) for o in permutations(letters)]
    filter_at = np.array([[letters.index(c) for c in o] for o in orders])            # (ranks, steps)
    masks = np.arange(1 << k)
    fails = np.array([(masks >> i & 1) for i in range(k)], np.int64)                 # (filters, masks)
    for whole in batches:
        for at in range(0, whole.num_rows, PARTS_AT_ONCE):
            batch = whole.slice(at, PARTS_AT_ONCE)
            parts = len(batch)
            counts = np.zeros((parts, 1 << k, len(MEASURES)), np.int64)
            for p, cells in enumerate(field(batch, "cells").to_pylist()):
                for cell in cells:
                    counts[p, cell["mask"]] = [cell[m] for m in MEASURES]
            removed = removed_by_rank(counts, letters)
            total = counts[:, :, 0].sum(axis=1)
            kept = total[:, None, None] - np.cumsum(removed[:, :, :, 0], axis=2)
            failing = counts[:, :, 0] @ fails.T                                      # (parts, filters)
            alone = counts[:, 1 << np.arange(k), 0]
            shapley = np.stack([(removed[:, :, :, 0] * (filter_at == f)).sum(axis=(1, 2)) for f in range(k)], axis=1)
            rows = len(orders) * k

            def flat(x):
                return pa.array(np.ascontiguousarray(x).reshape(-1))

            yield pa.RecordBatch.from_arrays(
                [field(batch, "part").take(pa.array(np.repeat(np.arange(parts), rows))),
                 pa.array(np.tile(np.repeat(orders, k), parts), pa.string()),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), parts * len(orders))),
                 flat(kept), flat(removed[:, :, :, 0]), flat(failing[:, filter_at] - removed[:, :, :, 0]),
                 flat(alone[:, filter_at]), flat(removed[:, :, :, 1]), flat(removed[:, :, :, 2]),
                 flat(shapley[:, filter_at])],
                names=[c.split()[0] for c in RESULT.split(", ")])


def interactions(cells: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Totals of every step of every order, from counts per ``part`` and
    ``mask`` (bit i: fails the i-th filter) with ``n``, ``good``, ``toxic``."""
    grouped = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))
    return map_arrow(grouped, lambda x: _totals(x, letters), RESULT)


def failure_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail."""
    text = F.col(text_col)
    read = saved(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text_mask(text).alias("mask"), F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)).alias("digest")),
        "audit-documents")
    # written first, so that Spark can split the join at a text that very many share
    first = saved(read.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
                  .filter("copies > 1").drop("copies"), "audit-first")
    marked = read.join(first, "digest", "left").select(
        "doc_id", "part", (F.col("mask") + F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)).alias("mask"))
    judged = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return marked.join(judged, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """What each filter removes at each step of all 120 orders, by part."""
    return interactions(failure_cells(docs, labels, **columns))
