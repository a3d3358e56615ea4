"""Exact substring dedup with suffix arrays.

A byte is removed if a string of ``width`` bytes that covers it also starts
anywhere else in the table, the same document included.  Strings are judged on
the input and never cross documents; overlaps count.

Equal strings must meet in one shard, so texts are dealt by content.  Each
string (its start stands for it) has an anchor: the ``gram``-byte piece in it
with the smallest hash.  Equal strings have equal anchors at equal places.
Neighbouring starts mostly share their anchor; such a run of starts with the
bytes that its strings cover is a segment, and the anchor's hash is its key.

    1. One pass over the texts writes (document, start, key, digest) of every
       segment.  A key that occurs once in the table holds no repeated string;
       only segments of other keys go on.
    2. Segments of equal bytes are aggregated map-side to one with a count,
       and the bytes of that one are read from its document.
    3. Each task sorts whole keys together into shards of bounded size and
       builds a shard's suffix array by induced sorting.  A start is repeated
       if its suffix has ``width`` bytes in common with its predecessor or
       successor (permuted common prefixes), or if its segment counts twice.
    4. Repeated starts go back to all places of their segment, and become
       merged removal spans of each document.

A passage that very many documents share gives a key with very many different
segments (each with other surroundings).  Such a key is never gathered: its
segments are cut into blocks of ``blocks[0]`` and then ``blocks[1]`` starts,
aligned on the anchor, with the hash of the bytes common to all strings of the
block as the new key.  Blocks outside the passage become unique and go; those
inside become equal and are aggregated.  At one start a block, all segments
of a key are equal.

Defined results
    null or empty text   nothing to remove, digest of no bytes
    text under width     nothing to remove
    very long text       read in blocks that overlap by width - 1 bytes
    repeated rows        each row is a place of its own: both lose what they share
    null id              like any other document
    empty table          empty result
    clashing columns     only the id and the text are read
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalyze.llm import words as W
from tonalyze.llm.common import distilled, field, map_arrow, saved, slices, utf8
from tonalyze.llm.suffix_array import permuted_prefixes, suffix_array

SEGMENT = ["key", "digest", "n"]
SEPARATOR, SHIFT, SYMBOLS = 1, 2, 258
PLACE = np.uint64((1 << 24) - 1)   # places in a block of text


@dataclass(frozen=True)
class SuffixParams:
    width: int = 400               # bytes of a string
    gram: int = 64                 # bytes of an anchor
    block_bytes: int = 1_000_000   # of text hashed at once, at most 8 million
    shard_bytes: int = 1_500_000   # of a suffix array, or one key if that is more
    key_segments: int = 1000       # different segments of a key in one shard
    blocks: tuple[int, ...] = (16, 1)


_SEED = 0x9E3779B97F4A7C15
_UP = np.ones(1, np.uint64)
_DOWN = np.ones(1, np.uint64)


def _scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse."""
    global _UP, _DOWN
    if n > len(_UP):
        def powers(base):
            return np.cumprod(np.append(np.ones(1, np.uint64), np.full(n, np.uint64(base))), dtype=np.uint64)
        _UP, _DOWN = powers(_SEED), powers(pow(_SEED, -1, 1 << 64))
    return _UP[:n], _DOWN[:n]


class Hashes:
    """Hashes of any byte ranges of ``data``, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = _scales(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(W.BYTE_VALUES[data] * up[:len(data)], out=self.sums[1:])

    def of(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return W.mix((self.sums[stop] - self.sums[first]) * self.down[first]
                     + (stop - first).astype(np.uint64) * W.MULTIPLIER)

    def grams(self, size: int) -> np.ndarray:
        return W.mix((self.sums[size:] - self.sums[:-size]) * self.down[:len(self.sums) - size])


def _window_minimum(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` neighbours, in two running passes per block."""
    n = len(x) - size + 1
    blocks = np.append(x, np.full(-len(x) % size, np.iinfo(np.uint64).max)).reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[size - 1:size - 1 + n])


def _segments(data: np.ndarray, offsets: np.ndarray, p: SuffixParams):
    """(row, start in the row, starts, anchor, key, digest, repeats) of the
    segments of texts of ``data``.  Neighbours of equal bytes (periodic text)
    are one entry with a number of repeats."""
    starts = len(data) - p.width + 1
    valid = np.zeros(max(starts, 0), bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        valid[a:max(a, b - p.width + 1)] = True
    if not valid.any():
        return None
    hashes = Hashes(data)
    grams = hashes.grams(p.gram)
    # the upper bits of the hash, then the place: of equal hashes the first one
    lowest = _window_minimum((grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64), p.width - p.gram + 1)
    anchor = (lowest & PLACE).astype(np.int64)
    opens = valid.copy()
    opens[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(opens)
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | opens[1:]
    n = np.flatnonzero(ends) + 1 - first
    anchor = anchor[first]
    key, digest = grams[anchor], hashes.of(first, first + n + p.width - 1)
    row = np.searchsorted(offsets, first, side="right") - 1
    fresh = np.append(True, (key[1:] != key[:-1]) | (digest[1:] != digest[:-1]) | (n[1:] != n[:-1])
                      | (row[1:] != row[:-1]))
    at = np.flatnonzero(fresh)
    repeats = np.diff(np.append(at, len(first)))
    return (row[at], (first - offsets[row])[at], n[at], (anchor - first)[at], key[at].view(np.int64),
            digest[at].view(np.int64), repeats)


def _occurrences(batches: Iterator[pa.RecordBatch], p: SuffixParams) -> Iterator[pa.RecordBatch]:
    def rows(batch, found, add=0):
        row, start, n, anchor, key, digest, repeats = found
        at = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [field(batch, "doc_id").take(at), field(batch, "crc").take(at), pa.array(start + add),
             pa.array(n.astype(np.int32)), pa.array(anchor.astype(np.int32)), pa.array(repeats.astype(np.int32)),
             pa.array(key), pa.array(digest)],
            names=["doc_id", "crc", "start", "n", "anchor", "repeats", "key", "digest"])

    for whole in batches:
        for batch in slices(whole, max_bytes=p.block_bytes):
            data, offsets = utf8(field(batch, "text"))
            if len(data) <= 2 * p.block_bytes:
                found = _segments(data, offsets, p)
                if found:
                    yield rows(batch, found)
                continue
            for r in range(batch.num_rows):
                text = data[offsets[r]:offsets[r + 1]]
                for a in range(0, len(text), p.block_bytes):
                    part = text[a:a + p.block_bytes + p.width - 1]
                    found = _segments(part, np.array([0, len(part)]), p)
                    if found:
                        yield rows(batch.slice(r, 1), found, a)


def _read_segments(batches: Iterator[pa.RecordBatch], p: SuffixParams) -> Iterator[pa.RecordBatch]:
    """(segment, copies, anchor, bytes) of the wanted segments of each text."""
    for whole in batches:
        for batch in slices(whole, max_bytes=p.block_bytes):
            data, offsets = utf8(field(batch, "text"))
            wanted = field(batch, "wanted")
            row = np.repeat(np.arange(len(batch)), np.diff(wanted.offsets.to_numpy()))
            cells = wanted.flatten()
            at, n = cells.field("start").to_numpy(), cells.field("n").to_numpy()
            first = offsets[row] + at
            pieces = [data[f:f + k].tobytes() for f, k in zip(first.tolist(), (n + p.width - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(cells.field(c) for c in (*SEGMENT, "copies", "anchor")), pa.array(pieces, pa.binary())],
                names=[*SEGMENT, "copies", "anchor", "bytes"])


def _recut(batches: Iterator[pa.RecordBatch], size: int, p: SuffixParams) -> Iterator[pa.RecordBatch]:
    """Segments cut into blocks of ``size`` starts, counted back from the anchor."""
    for batch in batches:
        if not batch.num_rows:
            continue
        pieces = field(batch, "bytes").to_pylist()
        data = np.frombuffer(b"".join(pieces), np.uint8)
        base = np.concatenate([[0], np.cumsum([len(x) for x in pieces])])[:-1]
        hashes = Hashes(data)
        n, anchor = (field(batch, c).to_numpy().astype(np.int64) for c in ("n", "anchor"))
        row = np.repeat(np.arange(len(n)), n)
        start = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        block = (anchor[row] - start) // size
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (block[1:] != block[:-1])))
        row, begin, block = row[first], start[first], block[first]
        count = np.diff(np.append(first, len(start)))
        # bytes of all strings that start in the whole block
        latest = base[row] + anchor[row] - block * size
        core = hashes.of(latest, latest - size + 1 + p.width)
        up_key = field(batch, "key").to_numpy()[row]
        key = W.mix(core ^ W.mix(up_key.view(np.uint64) + block.astype(np.uint64)))
        at = base[row] + begin
        digest = hashes.of(at, at + count + p.width - 1)
        cut = [data[f:f + k].tobytes() for f, k in zip(at.tolist(), (count + p.width - 1).tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(count.astype(np.int32)),
             pa.array(field(batch, "copies").to_numpy()[row]),
             pa.array((anchor[row] - begin).astype(np.int32)), pa.array(cut, pa.binary()),
             pa.array(up_key), field(batch, "digest").take(pa.array(row)), field(batch, "n").take(pa.array(row)),
             pa.array(begin.astype(np.int32))],
            names=[*SEGMENT, "copies", "anchor", "bytes", "up_key", "up_digest", "up_n", "at"])


def repeated_starts(pieces: list[bytes], copies: np.ndarray, width: int) -> np.ndarray:
    """Is the string that starts at each byte of each piece (laid end to end)
    repeated?  One suffix array over all pieces."""
    text = np.full(sum(map(len, pieces)) + len(pieces) + 1, SEPARATOR, np.uint16)
    ends = np.cumsum([len(x) + 1 for x in pieces])
    joined = np.frombuffer(b"\0".join(pieces), np.uint8)
    text[:len(joined)] = joined.astype(np.uint16) + SHIFT
    text[ends - 1] = SEPARATOR
    text[-1] = 0
    array = suffix_array(text, SYMBOLS)
    common = permuted_prefixes(text, array)
    common[array[:-1]] = np.maximum(common[array[:-1]], common[array[1:]])   # with the successor, too
    piece = np.repeat(np.arange(len(pieces)), np.diff(np.append(0, ends)))
    place = np.arange(len(piece))
    inside = ends[piece] - 1 - place >= width
    found = inside & ((common[:len(piece)] >= width) | (copies[piece] > 1))
    return found[np.delete(place, ends - 1)]


def _shards(batches: Iterator[pa.RecordBatch], p: SuffixParams) -> Iterator[pa.RecordBatch]:
    """Repeated starts of each segment as (segment, first, stop), from batches
    sorted by key; a key's segments are never parted."""
    names = [*SEGMENT, "copies", "bytes"]

    def solve(rows: pa.Table) -> pa.RecordBatch:
        pieces = rows["bytes"].to_pylist()
        found = repeated_starts(pieces, rows["copies"].to_numpy(), p.width)
        size = np.array([len(x) for x in pieces])
        base = np.cumsum(size) - size
        edge = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
        first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # pieces end on starts that are no strings, so no run goes over two
        piece = np.searchsorted(base, first, side="right") - 1
        return pa.RecordBatch.from_arrays(
            [rows[c].combine_chunks().take(pa.array(piece)) for c in SEGMENT]
            + [pa.array((first - base[piece]).astype(np.int32)), pa.array((stop - base[piece]).astype(np.int32))],
            names=[*SEGMENT, "first", "stop"])

    held = None
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            now = pa.table([field(batch, c).slice(at, 2000) for c in names], names=names)
            held = now if held is None else pa.concat_tables([held, now])
            if held["bytes"].nbytes < p.shard_bytes:
                continue
            keys = held["key"].to_numpy()
            edge = np.flatnonzero(keys[1:] != keys[:-1])
            if len(edge):
                cut = int(edge[-1]) + 1
                yield solve(held.slice(0, cut))
                held = held.slice(cut)
    if held is not None and len(held):
        yield solve(held)


def _repeated(segments: DataFrame, p: SuffixParams, blocks: tuple[int, ...]) -> DataFrame:
    """(segment, first, stop): runs of starts whose strings are repeated."""
    kinds = saved(segments.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("all"))
                  .filter("all > 1").drop("all"), "suffix-kinds")
    most = p.key_segments if blocks else np.iinfo(np.int64).max
    few = segments.join(kinds.filter(F.col("kinds") <= F.lit(int(most))).select("key"), "key", "left_semi")
    dealt = few.repartition("key").sortWithinPartitions("key")
    found = map_arrow(dealt, lambda x: _shards(x, p), "key long, digest long, n int, first int, stop int")
    many = kinds.filter(F.col("kinds") > F.lit(int(most))).select("key")
    if not blocks or many.isEmpty():
        return found
    cut = saved(map_arrow(segments.join(many, "key", "left_semi"), lambda x: _recut(x, blocks[0], p),
                          "key long, digest long, n int, copies long, anchor int, bytes binary, "
                          "up_key long, up_digest long, up_n int, at int"), "suffix-blocks")
    smaller = saved(cut.groupBy(*SEGMENT, "anchor").agg(F.sum("copies").alias("copies"), F.min("bytes").alias("bytes")),
                    "suffix-segments")
    inside = saved(_repeated(smaller, p, blocks[1:]), "suffix-starts")
    back = cut.drop("bytes", "copies", "anchor").join(inside, SEGMENT).select(
        F.col("up_key").alias("key"), F.col("up_digest").alias("digest"), F.col("up_n").alias("n"),
        (F.col("at") + F.col("first")).alias("first"), (F.col("at") + F.col("stop")).alias("stop"))
    return found.unionByName(back)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("crc"), text.alias("text"))


def _same_row(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.crc") == F.col(f"{b}.crc"))


def repeated_spans(docs: DataFrame, params: SuffixParams = SuffixParams(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, crc, start, n, repeats, first, stop): in the document with that
    id and text hash, the strings that start at start + k * n + [first, stop)
    for each k below repeats occur elsewhere, too."""
    rows = _rows(docs, id_col, text_col)
    return distilled(lambda: _repeated_spans(rows, params), "suffix-spans")


def _repeated_spans(rows: DataFrame, p: SuffixParams) -> DataFrame:
    every = saved(map_arrow(rows, lambda x: _occurrences(x, p),
                            "doc_id long, crc long, start long, n int, anchor int, repeats int, key long, digest long"),
                  "suffix-occurrences")
    keys = saved(every.groupBy("key").agg(F.sum("repeats").alias("places")).filter("places > 1").select("key"),
                 "suffix-keys")
    places = saved(every.join(keys, "key", "left_semi"), "suffix-places")
    segments = places.groupBy(*SEGMENT).agg(
        F.sum("repeats").alias("copies"), F.min(F.struct("doc_id", "crc", "start", "anchor")).alias("at"))
    wanted = segments.select("at.*", *SEGMENT, "copies").groupBy("doc_id", "crc").agg(
        F.collect_list(F.struct("start", *SEGMENT, "copies", "anchor")).alias("wanted"))
    texts = rows.alias("d").join(wanted.alias("w"), _same_row("d", "w")).select("d.text", "w.wanted")
    read = saved(map_arrow(texts, lambda x: _read_segments(x, p),
                           "key long, digest long, n int, copies long, anchor int, bytes binary"), "suffix-segments")
    found = saved(_repeated(read, p, p.blocks).distinct(), "suffix-starts")
    return places.join(found, SEGMENT).select("doc_id", "crc", "start", "n", "repeats", "first", "stop").distinct()


def _remove(batches: Iterator[pa.RecordBatch], p: SuffixParams) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, max_bytes=p.block_bytes):
            data, offsets = utf8(field(batch, "text"))
            removed, spans, kept, where = [], [], [], []
            for r, cells in enumerate(field(batch, "cells")):
                text = data[offsets[r]:offsets[r + 1]]
                change = np.zeros(len(text) + 1, np.int64)
                if cells.is_valid:
                    c = {k: cells.values.field(k).to_numpy() for k in ("start", "n", "repeats", "first", "stop")}
                    times = c["repeats"]
                    k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    base = np.repeat(c["start"], times) + k * np.repeat(c["n"], times)
                    np.add.at(change, base + np.repeat(c["first"], times), 1)
                    np.add.at(change, base + np.repeat(c["stop"], times) + p.width - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                removed.append(int(gone.sum()))
                spans.append(len(edge) // 2)
                kept.append(text[~gone].tobytes())
                where.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [field(batch, "doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), pa.array(where, kind)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])


def remove_repeats(docs: DataFrame, params: SuffixParams = SuffixParams(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the
    bytes that stay, which need not be whole characters) and spans (removed
    byte ranges of the original text)."""
    found = repeated_spans(docs, params, id_col, text_col)
    cells = found.groupBy("doc_id", "crc").agg(
        F.collect_list(F.struct("start", "n", "repeats", "first", "stop")).alias("cells"))
    rows = _rows(docs, id_col, text_col)
    joined = rows.alias("d").join(cells.alias("c"), _same_row("d", "c"), "left").select("d.doc_id", "d.text", "c.cells")
    return map_arrow(joined, lambda x: _remove(x, params),
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, "
                     "spans array<struct<start:long,end:long>>")
