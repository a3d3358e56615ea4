"""Benchmark decontamination: an FM-index per shard of the training texts.

Each task cuts its documents into shards of bounded text, builds the
FM-index of a shard (``fm_index``), searches all benchmark windows backward
through wavelet-tree ranks, locates their occurrences by sampled suffix
positions, and merges the hit words into removal spans.  Nothing is
shuffled: the documents stay where they are read.

Words that no benchmark item has cannot lie in an occurrence, so they end
runs, and runs shorter than the shortest window are left out of the index;
this drops no occurrence.  Ids are found by a 64-bit hash; the bytes of
every hit word are compared with the benchmark's word afterwards.

The benchmark goes to the tasks in blocks of at most ``block_bytes`` of
text.  If it has more, the documents pass once per block, each pass adding
its hits to those before.

Defined results
    null or empty text   no words, no hits
    very long text       one shard by itself, whole
    repeated rows, ties  each row by itself; items with the same id are one
    items without words  never occur; null item ids read as "null"
    empty tables         empty result; without items nothing is hit
    clashing columns     input columns named like an added one are replaced
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalyze.llm import words as W
from tonalyze.llm.common import cut_spans, field, map_arrow, saved, slices, utf8
from tonalyze.llm.fm_index import FMIndex

WIDTH = 10
NO_ITEMS = hashlib.sha256(b"").hexdigest()
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
    T.StructField("hit_spans", SPANS)])   # of characters, merged
#: Of earlier passes: [from, to) word numbers, flattened, and item ids.
EARLIER = T.StructType([T.StructField("_hit_words", T.ArrayType(T.IntegerType())),
                        T.StructField("_hit_items", T.ArrayType(T.StringType()))])


@dataclass
class Block:
    """Windows of some benchmark items over a vocabulary of their words."""
    vocabulary: np.ndarray        # sorted word hashes; id = place + 1
    vocabulary_words: list[bytes]
    phrases: np.ndarray           # (n, width) ids, right-aligned
    lengths: np.ndarray
    item_from: np.ndarray         # items of phrase p: items[item_from[p]:item_from[p + 1]]
    items: np.ndarray
    item_ids: list[str]


def make_block(items: list[tuple[str, str | None]], width: int = WIDTH) -> Block | None:
    text = pa.array([t or "" for _, t in items], pa.large_string())
    words = W.split(*utf8(text), W.PUNCTUATION)
    if not len(words.hash):
        return None
    vocabulary, first, ids = np.unique(words.hash, return_index=True, return_inverse=True)
    ids = ids.astype(np.int32) + 1
    item_ids = sorted({i for i, _ in items})
    number = {x: k for k, x in enumerate(item_ids)}
    owners: dict[tuple[int, ...], set[int]] = {}
    for k, (item, _) in enumerate(items):
        own = ids[words.row[k]:words.row[k + 1]].tolist()
        for j in range(max(1, len(own) - width + 1) if own else 0):
            owners.setdefault(tuple(own[j:j + width]), set()).add(number[item])
    phrases = np.zeros((len(owners), width), np.int32)
    lengths = np.zeros(len(owners), np.int64)
    for k, p in enumerate(owners):
        phrases[k, width - len(p):] = p
        lengths[k] = len(p)
    sizes = [len(o) for o in owners.values()]
    return Block(vocabulary, [words.bytes_of(i) for i in first], phrases, lengths,
                 np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
                 np.array([i for o in owners.values() for i in sorted(o)], np.int64), item_ids)


def occurrences(ids: np.ndarray, row: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(word number, phrase number) of every window occurrence in a shard."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    known = ids > 0
    if not known.any():
        return none
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    doc_starts = row[:-1][(row[:-1] < len(ids)) & (row[:-1] < row[1:])]
    begins[doc_starts] |= known[doc_starts]
    run = np.cumsum(begins)
    at = np.flatnonzero(known)
    length = np.bincount(run[at])
    at = at[length[run[at]] >= block.lengths.min()]
    if not len(at):
        return none
    # the runs one after another, a separator after each
    new = np.concatenate([[0], (run[at][1:] != run[at][:-1]).cumsum()])
    place = np.arange(len(at)) + new
    seq = np.zeros(int(place[-1]) + 2, np.int32)
    seq[place] = ids[at]
    origin = np.full(len(seq), -1, np.int64)
    origin[place] = at
    index = FMIndex(seq, len(block.vocabulary) + 1)
    low, high = index.search(block.phrases, block.lengths)
    found = np.flatnonzero(high > low)
    n = high[found] - low[found]
    if not len(found):
        return none
    rows = np.repeat(low[found] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return origin[index.locate(rows)], np.repeat(found, n)


def _ids(words: W.Words, block: Block) -> np.ndarray:
    at = np.minimum(np.searchsorted(block.vocabulary, words.hash), len(block.vocabulary) - 1)
    return np.where(block.vocabulary[at] == words.hash, at + 1, 0).astype(np.int32)


def _hits(words: W.Words, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is the word hit, text numbers, item numbers): items per text, distinct."""
    ids = _ids(words, block)
    while True:
        at, phrase = occurrences(ids, words.row, block)
        edges = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + block.lengths[phrase], -1)
        hit = np.cumsum(edges[:-1]) > 0
        other = [i for i in np.flatnonzero(hit).tolist()
                 if words.bytes_of(i) != block.vocabulary_words[ids[i] - 1]]
        if not other:
            break
        ids[other] = 0            # another word with the same hash
    text = np.searchsorted(words.row, at, side="right") - 1
    n = block.item_from[phrase + 1] - block.item_from[phrase]
    starts = np.repeat(block.item_from[phrase] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    items = block.items[starts + np.arange(n.sum())] if len(n) else np.empty(0, np.int64)
    pairs = np.unique(np.repeat(text, n) * len(block.item_ids) + items)
    return hit, pairs // len(block.item_ids), pairs % len(block.item_ids)


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def scan(batches: Iterator[pa.RecordBatch], block: Block | None, out: pa.Schema, text: str,
         final: bool, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """One pass: hits of ``block`` added to those of earlier passes."""
    for whole in batches:
        for batch in slices(whole, text, shard_bytes):
            data, offsets = utf8(field(batch, text))
            words = W.split(data, offsets, W.PUNCTUATION)
            if block is not None:
                hit, texts, items = _hits(words, block)
            else:
                hit, texts, items = np.zeros(len(words.hash), bool), np.empty(0, int), np.empty(0, int)
            of_text: dict[int, set[str]] = {}
            for t, i in zip(texts.tolist(), items.tolist()):
                of_text.setdefault(t, set()).add(block.item_ids[i])
            if "_hit_words" in batch.schema.names:
                for t, spans in enumerate(field(batch, "_hit_words").to_pylist()):
                    for a, b in zip(spans[::2], spans[1::2]):
                        hit[words.row[t] + a:words.row[t] + b] = True
                for t, ids in enumerate(field(batch, "_hit_items").to_pylist()):
                    if ids:
                        of_text.setdefault(t, set()).update(ids)
            total = np.concatenate([[0], np.cumsum(hit)])
            n_hit = total[words.row[1:]] - total[words.row[:-1]]
            kept = [field(batch, c) for c in out.names
                    if c not in ADDED.names and c not in EARLIER.names]
            rows = range(batch.num_rows)
            word_spans = [_spans(hit[words.row[t]:words.row[t + 1]]) if n_hit[t] else [] for t in rows]
            item_lists = [sorted(of_text.get(t, ())) for t in rows]
            if not final:
                added = [pa.array([[x for s in spans for x in s] for spans in word_spans], pa.list_(pa.int32())),
                         pa.array(item_lists, pa.list_(pa.string()))]
            else:
                chars = []
                for t, spans in enumerate(word_spans):
                    own, done, at = [], 0, int(offsets[t])
                    for a, b in spans:
                        cut = []
                        for byte in (words.start[words.row[t] + a], words.end[words.row[t] + b - 1]):
                            # characters: bytes that do not continue one
                            done += int(np.count_nonzero((data[at:byte] & 0xC0) != 0x80))
                            at = int(byte)
                            cut.append(done)
                        own.append({"start": cut[0], "end": cut[1]})
                    chars.append(own)
                added = [pa.array(np.diff(words.row), pa.int64()), pa.array(n_hit, pa.int64()),
                         pa.array([len(x) for x in item_lists], pa.int64()),
                         pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() if x else NO_ITEMS
                                   for x in item_lists], pa.string()),
                         pa.array(n_hit > 0, pa.bool_()),
                         pa.array(item_lists, pa.list_(pa.string())),
                         pa.array(chars, out.field("hit_spans").type)]
            yield pa.RecordBatch.from_arrays(kept + added, schema=out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH,
                  keep: list[str] | None = None, block_bytes: int = 8_000_000,
                  shard_bytes: int = 6_000_000) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``, default all) with the columns of ``ADDED``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                             F.col(item_text_col).alias("text")).filter("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // block_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    kept = [c for c in (keep or docs.columns) if c not in ADDED.names and c not in EARLIER.names]
    fields = [f for f in docs.schema.fields if f.name in kept]
    current = docs.select(*{f.name: None for f in fields}, *([] if text_col in kept else [text_col]))
    for b in range(blocks):
        rows = [(r["item"], r["text"]) for r in items.filter(part == b).collect()]
        shared = spark.sparkContext.broadcast(make_block(rows, width))
        final = b == blocks - 1
        own = list(fields)
        if not final and text_col not in kept:
            own.append(docs.schema[text_col])
        schema = T.StructType([*own, *(ADDED if final else EARLIER).fields])
        out = to_arrow_schema(schema)

        def run(batches, shared=shared, out=out, final=final):
            return scan(batches, shared.value, out, text_col, final, shard_bytes)

        current = map_arrow(current, run, schema)
        if not final:
            current = saved(current, "decontam-pass")
    return current


def remove_spans(found: DataFrame, text_col: str = "text") -> DataFrame:
    """The hit spans cut out of the texts; other texts are returned as they are."""
    return found.withColumn(text_col, F.when(
        F.size("hit_spans") > 0, cut_spans(F.col(text_col), F.col("hit_spans"))).otherwise(F.col(text_col)))
