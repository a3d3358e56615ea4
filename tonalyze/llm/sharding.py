"""Sharding by histogram sort: exact byte histograms refine the splitters.

Rows are ordered by (62 bits of a hash of the text, id), so equal texts lie
next to each other and a group of copies of any size can still be divided
between shards at any of its ids.  The law is ``bytes``: sizes near equal.

1. A narrow table (hash, id, size) is written once.
2. The splitters between the shards are searched: each pass counts the exact
   bytes and rows below every candidate boundary (one ``groupBy(bucket)``,
   map-side combined) and narrows the interval of each splitter that misses
   its tolerance, until all meet it or no candidate key is left between two
   rows.
3. One exchange moves the rows to their part.  Where a shard is too much for
   one task it is dealt into parts by a hash of (text, id), which divides
   copies too and is the same when a task runs again; rows are sorted inside
   a part.  The slot of a row is the number of rows in the earlier parts of
   its shard, summed over a table of counts, plus its place in the part.

Only DataFrame functions are used.  To the driver go counts per candidate
boundary, at most ``shards * (probes + 3)`` of them in a pass whatever the
input; the counts per part are a table of at most ``max_parts`` rows.

Defined results
    null text            size 8, hash of the empty text; null id: sorted first
    very long text       one row is never divided: a shard may exceed its
                         share by one row
    repeated rows        rows of equal text and id cannot be told apart by a
                         key; they go to one part, in any order
    empty table          empty result
    clashing columns     input columns named like an added one are replaced
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonalyze.llm.common import let, saved

LAW = "bytes"
HASH_BITS = 62
ID_BITS = 64
KEY_END = 1 << (HASH_BITS + ID_BITS)
ADDED = ("size", "shard", "part", "slot")


@dataclass(frozen=True)
class ShardParams:
    shards: int = 24
    tolerance: float = 0.0001    # of a shard's ideal bytes
    probes: int = 16             # candidate boundaries per open splitter and pass
    part_bytes: int = 32_000_000  # a task of the exchange gets about so much,
    max_parts: int = 65_536      # or more where that would take more tasks than this


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def _hash(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - HASH_BITS)


def _id(id_col: Column) -> Column:
    return F.coalesce(id_col.cast("long"), F.lit(-(1 << 63)))


def _pair(key: int) -> tuple[int, int]:
    """An integer key as (hash, signed id)."""
    return key >> ID_BITS, (key & ((1 << ID_BITS) - 1)) - (1 << 63)


def bucket(h: Column, i: Column, boundaries: list[int]) -> Column:
    """Number of boundaries (ascending) that are <= the key: binary search in
    two literal arrays, log2 of their length steps a row."""
    if not boundaries:
        return F.lit(0)
    pairs = [_pair(min(k, KEY_END - 1)) for k in boundaries]
    high = F.lit(np.array([p[0] for p in pairs], np.int64))
    low = F.lit(np.array([p[1] for p in pairs], np.int64))
    n, steps = len(boundaries), []
    step = 1 << (n.bit_length() - 1)
    while step:
        steps.append(F.lit(step))
        step >>= 1

    def search(key: Column) -> Column:
        def move(at: Column, s: Column) -> Column:
            to = at + s
            bh, bl = F.get(high, to - 1), F.get(low, to - 1)
            past = (key["h"] > bh) | ((key["h"] == bh) & (key["i"] >= bl))
            return F.when((to <= n) & past, to).otherwise(at)

        return F.aggregate(F.array(*steps), F.lit(0), move)

    return let(F.struct(h.alias("h"), i.alias("i")), search)


def parts_per_shard(all_bytes: int, params: ShardParams) -> int:
    most = max(1, params.max_parts // params.shards)
    return min(most, max(1, -(-all_bytes // (params.shards * params.part_bytes))))


def find_splitters(keys: DataFrame, params: ShardParams) -> tuple[list[int], int]:
    """(splitter keys between the shards, bytes of all rows).

    Every open splitter holds an interval with the exact bytes and rows below
    its two ends; a pass probes inside it and keeps the sub-interval where
    the target lies.
    """
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    all_bytes, all_rows = int(total["b"]), int(total["n"])
    if not all_rows:
        return [], 0
    targets = [all_bytes * k // params.shards for k in range(1, params.shards)]
    slack = params.tolerance * all_bytes / params.shards
    # interval of splitter k: (low key, bytes, rows below it, high key, bytes, rows below it)
    spans = [(0, 0, 0, KEY_END, all_bytes, all_rows) for _ in targets]
    found: list[int | None] = [None] * len(targets)
    while True:
        probes: set[int] = set()
        for k, (lo, lo_b, _, hi, hi_b, _) in enumerate(spans):
            if found[k] is None:
                # where an even spread of bytes would put the target, and evenly around it
                m = params.probes
                width = hi - lo
                near = lo + width * max(0, min(targets[k] - lo_b, hi_b - lo_b)) // max(1, hi_b - lo_b)
                probes.update(lo + width * j // m for j in range(1, m))
                reach = max(1, width >> 8)
                probes.update(p for p in (near - reach, near, near + reach) if lo < p < hi)
        probes.discard(0)
        if not probes:
            break
        edges = sorted(probes)
        counts = (keys.groupBy(bucket(F.col("h"), F.col("i"), edges).alias("b"))
                  .agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect())
        in_bucket = {r["b"]: (int(r["s"]), int(r["n"])) for r in counts}
        below, seen_b, seen_n = [], 0, 0
        for j in range(len(edges)):          # bytes and rows with key < edges[j]
            s, n = in_bucket.get(j, (0, 0))
            seen_b, seen_n = seen_b + s, seen_n + n
            below.append((edges[j], seen_b, seen_n))
        for k, target in enumerate(targets):
            if found[k] is not None:
                continue
            lo, lo_b, lo_n, hi, hi_b, hi_n = spans[k]
            inside = [x for x in below if lo < x[0] < hi]
            for key, b, n in inside:
                if b <= target:
                    lo, lo_b, lo_n = key, b, n
                else:
                    hi, hi_b, hi_n = key, b, n
                    break
            spans[k] = (lo, lo_b, lo_n, hi, hi_b, hi_n)
            ends = sorted([(abs(lo_b - target), lo), (abs(hi_b - target), hi)])
            # met, one row left between the ends, or no key left between them
            if ends[0][0] <= slack or hi_n - lo_n <= 1 or hi - lo <= 1:
                found[k] = ends[0][1]
    # a splitter never lies before the one to its left
    return list(itertools.accumulate(found, max)), all_bytes


def shard(docs: DataFrame, params: ShardParams = ShardParams(),
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``size``, ``shard``, ``part`` and ``slot``."""
    h, i = _hash(F.col(text_col)), _id(F.col(id_col))
    keys = saved(docs.select(h.alias("h"), i.alias("i"), text_size(F.col(text_col)).alias("size")),
                 "shard-keys")
    splitters, all_bytes = find_splitters(keys, params)
    per = parts_per_shard(all_bytes, params)

    def part(h: Column, i: Column) -> Column:
        return (bucket(h, i, splitters) * per + F.pmod(F.xxhash64(h, i), F.lit(per))).cast("int")

    # rows in the earlier parts of a shard: at most max_parts rows, so it may be broadcast
    earlier = Window.partitionBy(F.floor(F.col("part") / per)).orderBy("part")
    counts = keys.groupBy(part(F.col("h"), F.col("i")).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    base = saved(counts.select(F.col("part").alias("_part"),
                               (F.sum("n").over(earlier) - F.col("n")).alias("_base")), "shard-parts")
    kept = [c for c in docs.columns if c not in (*ADDED, "_h", "_i", "_nth", "_part", "_base")]
    placed = docs.select(*kept, h.alias("_h"), i.alias("_i"),
                         text_size(F.col(text_col)).alias("size"), part(h, i).alias("part"))
    # each part to a task of its own; the window below needs no other exchange
    placed = placed.repartitionById((len(splitters) + 1) * per, "part")
    order = Window.partitionBy("part").orderBy("_h", "_i")
    return (placed.withColumn("_nth", F.row_number().over(order))
            .join(F.broadcast(base), F.col("part") == F.col("_part"))
            .select(*kept, "size", F.floor(F.col("part") / per).cast("int").alias("shard"), "part",
                    (F.col("_base") + F.col("_nth") - 1).cast("long").alias("slot")))
