"""Best-fit packing: hierarchical residual packing into fixed-size sequences.

Level 0 runs where the documents are read: a task tokenizes its partition,
cuts longer documents, and best-fits the pieces (longest first, into the
fullest sequence that still takes one).  Sequences nearly full are final.
The underfull ones become items of the next level: the partitions are the
leaves of a tree, each level has ``fan_in`` times fewer nodes, over which the
underfull sequences are dealt by a hash of their numbers, and a node
best-fits its own again, whole and also opened up into their pieces, keeping
the way that needs fewer; up to the root, which emits what is left.  Only
underfull sequences are ever shuffled.

Memory is bounded by pieces: a leaf packs at most ``max_items`` of them at a
time, and a level never has so few nodes that one would get more than
``max_items`` on average.  Where that holds the tree open, its top level is
repeated, dealt anew each time so that sequences meet other ones, until a
round saves less than ``min_gain`` of them.  Every level is written to the
shared folder, so sequence numbers never change when a task is run again.

Token ids are those of ``byte_bpe_50k.json`` in the `tokenizers` library.
Texts are encoded from the same vocabulary's rank file (the ids are equal,
tests hold both against each other, and it is about six times faster);
texts that spell a special token, or hold a run of blanks longer than the
pattern matcher's stack takes, go to the `tokenizers` library itself.

Defined results
    null or empty text   only the end id: one piece of length 1
    very long text       cut; pieces of 1024 but for the first
    repeated rows        packed once per row
    empty table          empty result
    clashing columns     only the id and the text are read
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalyze.llm.common import field, map_arrow, saved, slices

END_ID = 2
LONG_BLANKS = 100_000     # the matcher's stack holds some six times as many
_BLANKS = re.compile(rf"\s{{{LONG_BLANKS}}}")


@dataclass(frozen=True)
class PackParams:
    capacity: int = 1024
    nearly_full: int = 1020       # a sequence of so many tokens is final
    fan_in: int = 16
    max_items: int = 200_000      # pieces packed at once
    min_gain: float = 0.02
    vocabulary: str = "byte_bpe_50k.json"
    ranks: str = "byte_bpe_50k.tiktoken"

    def at_once(self, with_ids: bool) -> int:
        """Pieces that a task holds; those with their ids are some 32 times as large."""
        return max(1, self.max_items // 32) if with_ids else self.max_items


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: str, ranks: str):
    """text -> ids as numpy, the same as `tokenizers` gives."""
    import base64
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(ranks), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                             special_tokens={})
    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as f:
        special = [t["content"] for t in json.load(f)["added_tokens"]]
    exact = Tokenizer.from_file(public_tokenizers.path(vocabulary))

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special) or (len(text) >= LONG_BLANKS and _BLANKS.search(text)):
            return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n % capacity
    pieces = [(0, first)] if first else []
    return pieces + [(s, capacity) for s in range(first, n, capacity)]


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best fit, longest first: (bin of each item, its offset there, fill of each bin).

    Open bins wait by their free space; the bits of ``free`` say which
    spaces exist, so the tightest fit is the lowest set bit from the item's
    length on.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    fill: list[int] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        above = free >> n
        if above:
            space = n + ((above & -above).bit_length() - 1)
            b = waiting[space].pop()
            if not waiting[space]:
                free &= ~(1 << space)
        else:
            space, b = capacity, len(fill)
            fill.append(0)
        bins[k], offsets[k] = b, fill[b]
        fill[b] += n
        space -= n
        if space:
            waiting[space].append(b)
            free |= 1 << space
    return bins, offsets, fill


PIECE = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
PLACE = T.StructType([
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("fill", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("final", T.BooleanType())])


def _number(level: int, node: int, k: np.ndarray) -> np.ndarray:
    """Sequence numbers: level, node and counter side by side in 63 bits."""
    return (np.int64(level) << 55) + (np.int64(node) << 31) + k.astype(np.int64)


def _leaf(batches: Iterator[pa.RecordBatch], out: pa.Schema, id_col: str, text_col: str,
          params: PackParams, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encode = _encoder(params.vocabulary, params.ranks)
    node = TaskContext.get().partitionId()
    made = 0
    ids: list[pa.Scalar] = []
    rows: list[tuple[int, int, int, int]] = []
    tokens: list[np.ndarray] = []

    def flush():
        nonlocal made, ids, rows, tokens
        piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows))
        bins, offsets, fill = best_fit(length, params.capacity)
        full = np.array(fill, np.int32)[bins]
        columns = [pa.array(ids, out.field(0).type), pa.array(piece, pa.int32()), pa.array(start),
                   pa.array(length), pa.array(crc)]
        if with_ids:
            columns.append(pa.array(tokens, pa.list_(pa.int32())))
        columns += [pa.array(_number(0, node, made + bins)), pa.array(offsets), pa.array(full),
                    pa.array(np.full(len(rows), node, np.int32)),
                    pa.array(full >= params.nearly_full)]
        made += len(fill)
        ids, rows, tokens = [], [], []
        return pa.RecordBatch.from_arrays(columns, schema=out)

    for whole in batches:
        for batch in slices(whole, text_col):
            for doc_id, text in zip(field(batch, id_col), field(batch, text_col).to_pylist()):
                doc_id = doc_id.as_py()
                own = np.append(encode(text or ""), END_ID).astype("<u4")
                for number, (start, length) in enumerate(cut(len(own), params.capacity)):
                    part = own[start:start + length]
                    ids.append(doc_id)
                    rows.append((number, start, length, zlib.crc32(part.tobytes())))
                    if with_ids:
                        tokens.append(part.astype(np.int32))
                    if len(rows) >= params.at_once(with_ids):
                        yield flush()
    if rows:
        yield flush()


def _merge(table: pa.Table, node: int, level: int, root: bool, params: PackParams) -> pa.Table:
    """Best-fit the sequences of one inner node as items, or their pieces if
    that takes fewer sequences."""
    order = np.lexsort((table.column("offset").to_numpy(), table.column("sequence_id").to_numpy()))
    table = table.take(pa.array(order))
    _, first, inverse = np.unique(table.column("sequence_id").to_numpy(),
                                  return_index=True, return_inverse=True)
    fill = table.column("fill").to_numpy()[first].astype(np.int64)
    bins, offsets, merged = best_fit(fill, params.capacity)
    bins, offsets = bins[inverse], offsets[inverse] + table.column("offset").to_numpy()
    opened = best_fit(table.column("length").to_numpy(), params.capacity)
    if len(opened[2]) < len(merged):
        bins, offsets, merged = opened
    full = np.array(merged, np.int32)[bins]
    final = full >= params.nearly_full
    if root:
        final = np.ones(len(full), bool)
    places = {"sequence_id": _number(level, node, bins), "offset": offsets,
              "fill": full, "node": np.full(len(full), node, np.int32), "final": final}
    for name, values in places.items():
        at = table.schema.get_field_index(name)
        table = table.set_column(at, table.schema.field(at), pa.array(values, table.schema.field(at).type))
    return table


def _merger(level: int, root: bool, params: PackParams):
    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _merge(table, key[0].as_py(), level, root, params)

    return merge


def pack(docs: DataFrame, params: PackParams = PackParams(), id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset
    (and the piece's token ids with ``with_ids``)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    extra = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *PIECE.fields, *extra,
                           *PLACE.fields])
    out = to_arrow_schema(schema)
    leaves = map_arrow(
        docs.select(id_col, text_col), lambda batches: _leaf(batches, out, id_col, text_col, params, with_ids), schema)
    current = saved(leaves, "pack-0", ["final"])
    nodes = (current.agg(F.max("node")).first()[0] or 0) + 1
    done = [current.filter("final")]
    level, before = 0, None
    while True:
        level += 1
        rest = current.filter(~F.col("final")).select(*schema.names)
        pieces, sequences = rest.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).first()
        if not pieces:
            break
        least = -(-pieces // params.at_once(with_ids))
        if before and 1 < nodes <= least and sequences > (1 - params.min_gain) * before:
            done.append(rest)
            break
        before, nodes = sequences, max(-(-nodes // params.fan_in), least)
        root = nodes == 1
        dealt = rest.groupBy(F.pmod(F.xxhash64("sequence_id", F.lit(level)), F.lit(nodes)).cast("int").alias("to"))
        current = saved(dealt.applyInArrow(_merger(level, root, params), schema), f"pack-{level}", ["final"])
        done.append(current.filter("final"))
        if root:
            break
    names = [id_col, *PIECE.names, *(f.name for f in extra), "sequence_id", "offset"]
    whole = done[0].select(*names)
    for more in done[1:]:
        whole = whole.unionByName(more.select(*names))
    return whole
