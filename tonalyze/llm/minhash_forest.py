"""MinHash near-duplicates with an LSH forest.

A document's set is its distinct 5-word shingles.  Every document gets
``trees`` signature orders of ``depths[-1]`` minhashes each.  In the sorted
order of a tree, documents whose signatures share their first ``depths[0]``
values are neighbours: a region.  The depth adapts to the region: one that
holds more than ``region_rows`` documents is read at the next depth, so that
dense parts of an order ask for a longer common prefix.  All documents of a
region are compared by their sketches (a byte of every minhash) inside one
task, which emits the edges of a maximum spanning forest only; these are
confirmed on the full sets.  The forest grows one document at a time and no
pair is kept, so a task's memory follows the region's documents.  A second
round compares the full sets of every pair of a region that is still in
different components and similar by sketch, each pair in the first tree that
holds it in one region, inside the region's task: what leaves it are links
that join components, never pairs.

A region that has too many documents even at the last depth, or sets of too
many bytes, is dealt into chunks, and a task is one pair of chunks: every
pair of documents of the region meets in exactly one of them.

Documents of equal sets are one node from the start, and so are the rows of
one id.  Links, components and sketches never leave the executors; every
round is written to the shared folder.

At 85 % similarity a pair is missed by all of 20 trees at depth 5 with a
chance of 8e-6; the sketch (200 values, threshold 0.75) drops 4e-5.

Defined results
    null, empty, blank text   no shingles; linked with nothing, kept
    fewer than 5 words        the whole sequence is the one shingle
    null id                   linked with nothing: component null, kept
    repeated rows             rows of one id count as one document
    empty table               empty result
    clashing columns          only the id and the text are read
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
from tonalyze.llm.graph import UnionFind, components


@dataclass(frozen=True)
class ForestParams:
    width: int = 5                 # words of a shingle
    percent: int = 85              # links: 100 * intersection >= percent * union
    trees: int = 20
    depths: tuple[int, ...] = (5, 8, 10)
    region_rows: int = 2000
    region_bytes: int = 32_000_000  # of the full sets of a region or chunk
    sketch_similarity: float = 0.75
    broadcast_ids: int = 4_000_000  # candidates up to this many are broadcast (8 bytes each)

    @property
    def hashes(self) -> int:
        return self.trees * self.depths[-1]


def shingles(words: W.Words, r: int, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of text ``r``."""
    own = words.hash[words.row[r]:words.row[r + 1]]
    return np.unique(W.windows(own, min(width, len(own)))) if len(own) else np.empty(0, np.uint64)


def _signature(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum over the set of each hash a * x + b, its upper 32 bits."""
    low = np.full(len(a), np.iinfo(np.uint64).max)
    for at in range(0, len(x), 512):         # blocks that stay in cache
        np.minimum(low, (x[at:at + 512, None] * a + b).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def _signatures(batches: Iterator[pa.RecordBatch], p: ForestParams) -> Iterator[pa.RecordBatch]:
    a, b = W._random64(p.hashes, 101), W._random64(p.hashes, 202)
    for whole in batches:
        for batch in slices(whole, max_bytes=1_000_000):
            words = W.split(*utf8(field(batch, "text")), W.SPACES)
            n, set_a, set_b, signs = [], [], [], []
            for r in range(batch.num_rows):
                x = shingles(words, r, p.width)
                n.append(len(x))
                # an order-free digest of the set in 128 bits
                set_a.append(int(W.mix(x).sum(dtype=np.uint64).view(np.int64)))
                set_b.append(int(W.mix(x ^ W.MULTIPLIER).sum(dtype=np.uint64).view(np.int64)))
                signs.append(_signature(x, a, b).tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays(
                [field(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(set_a, pa.int64()),
                 pa.array(set_b, pa.int64()), pa.array(signs, pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "signature"])


def _orders(batches: Iterator[pa.RecordBatch], p: ForestParams) -> Iterator[pa.RecordBatch]:
    """One row per tree: a key of the order's first values at each depth."""
    k = p.depths[-1]
    names = ["doc_id", "n_shingles", "tree", *(f"key{d}" for d in p.depths)]
    for batch in batches:
        signs = np.frombuffer(b"".join(field(batch, "signature").to_pylist()), "<u4").reshape(
            -1, p.trees, k).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, p.trees + 1, dtype=np.uint64) * W.MULTIPLIER,
                              signs.shape[:2]).copy()
        keys = []
        for d in range(k):
            key = W.mix(key ^ (signs[:, :, d] + np.uint64(d + 1)))
            if d + 1 in p.depths:
                keys.append(key.reshape(-1).view(np.int64))
        ids, sizes = (np.repeat(field(batch, c).to_numpy(zero_copy_only=False), p.trees) for c in names[:2])
        trees = np.tile(np.arange(p.trees, dtype=np.int32), batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, sizes, trees, *keys)], names=names)


def _regions(rows: DataFrame, p: ForestParams) -> DataFrame:
    """(doc_id, tree, region, chunks) of documents with company: the region is
    read at the first depth where it has at most ``region_rows`` documents."""
    done, at = [], rows
    for depth in p.depths:
        key, last = f"key{depth}", depth == p.depths[-1]
        counts = saved(at.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
                       .filter("n > 1"), "forest-counts")
        fit = counts if last else counts.filter(F.col("n") <= p.region_rows)
        chunks = F.greatest(F.ceil(F.col("n") / p.region_rows), F.ceil(8 * F.col("size") / p.region_bytes))
        done.append(at.join(fit, key).select("doc_id", "tree", F.col(key).alias("region"),
                                             chunks.cast("int").alias("chunks")))
        dense = counts.filter(F.col("n") > p.region_rows)
        if last or dense.isEmpty():
            break
        at = saved(at.join(dense, key, "left_semi"), "forest-dense")
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of each (region, chunk), from batches sorted by them; a group
    may go over batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {c: field(batch, c).to_numpy(zero_copy_only=False)
               for c in ("region", "chunk", "part", "doc_id", "component")}
        for name, kind in (("sketch", np.uint8), ("places", "<i8")):
            now[name] = np.frombuffer(b"".join(field(batch, name).to_pylist()), kind).reshape(batch.num_rows, -1)
        now["tree"] = field(batch, "tree").to_numpy(zero_copy_only=False)
        if "shingles" in batch.schema.names:
            column = field(batch, "shingles")
            sets = np.empty(batch.num_rows, object)
            for k in range(batch.num_rows):
                sets[k] = column[k].values.to_numpy()
            now["shingles"] = sets
        if held is not None:
            now = {c: np.concatenate([held[c], now[c]]) for c in now}
        edge = np.flatnonzero((now["region"][1:] != now["region"][:-1])
                              | (now["chunk"][1:] != now["chunk"][:-1])) + 1
        for s, e in zip([0, *edge[:-1].tolist()], edge.tolist()):
            if e - s > 1:
                yield {c: x[s:e] for c, x in now.items()}
        start = int(edge[-1]) if len(edge) else 0
        held = {c: x[start:] for c, x in now.items()}
    if held is not None and len(held["doc_id"]) > 1:
        yield held


def _spanning(group: dict[str, np.ndarray], least: float) -> tuple[list[int], list[int]]:
    """Edges of the maximum spanning forest by sketch: the tree takes in the
    document nearest to it, one at a time."""
    sketch, part = group["sketch"], group["part"]
    need, two = int(np.ceil(least * sketch.shape[1])), (part != part[0]).any()
    best, parent = np.full(len(sketch), -1), np.zeros(len(sketch), np.int64)
    rest, at, left, right = np.arange(1, len(sketch)), 0, [], []
    while len(rest):
        same = np.count_nonzero(sketch[rest] == sketch[at], axis=1)
        if two:
            same[part[rest] == part[at]] = -1
        nearer = rest[same > best[rest]]
        best[nearer], parent[nearer] = same[same > best[rest]], at
        k = int(best[rest].argmax())
        at = int(rest[k])
        if best[at] >= need:
            left.append(int(parent[at]))
            right.append(at)
        rest = np.delete(rest, k)
    return left, right


def _similar(group: dict[str, np.ndarray], least: float) -> Iterator[tuple[int, np.ndarray]]:
    """(i, all j > i) of pairs of different components whose sketches agree in a
    share of at least ``least``, in the first tree that has both in one place.
    A task of two chunks pairs documents of both."""
    sketch, component, places, part = group["sketch"], group["component"], group["places"], group["part"]
    tree, two = int(group["tree"][0]), (part != part[0]).any()
    need = int(np.ceil(least * sketch.shape[1]))
    if (component == component[0]).all():
        return
    for i in range(len(sketch) - 1):
        other = component[i + 1:] != component[i]
        if two:
            other &= part[i + 1:] != part[i]
        j = np.flatnonzero(other) + i + 1
        if tree and len(j):
            j = j[~(places[j, :tree] == places[i, :tree]).any(axis=1)]
        j = j[np.count_nonzero(sketch[j] == sketch[i], axis=1) >= need]
        if len(j):
            yield i, j


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    x, y = np.concatenate([*a, np.empty(0, np.int64)]), np.concatenate([*b, np.empty(0, np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y).astype(np.int64)),
                                       pa.array(np.maximum(x, y).astype(np.int64))], names=["a", "b"])


def _forest(batches: Iterator[pa.RecordBatch], p: ForestParams) -> Iterator[pa.RecordBatch]:
    """Edges of each region's maximum spanning forest by sketch, to confirm."""
    for group in _groups(batches):
        i, j = _spanning(group, p.sketch_similarity)
        if i:
            yield _pairs([group["doc_id"][i]], [group["doc_id"][j]])


def _open(batches: Iterator[pa.RecordBatch], p: ForestParams) -> Iterator[pa.RecordBatch]:
    """Rows (region, chunk, part, tree, doc_id) that have a pair left to compare."""
    names = ["region", "chunk", "part", "tree", "doc_id"]
    for group in _groups(batches):
        found = np.zeros(len(group["doc_id"]), bool)
        for i, j in _similar(group, p.sketch_similarity):
            found[i] = True
            found[j] = True
        if found.any():
            yield pa.RecordBatch.from_arrays([pa.array(group[c][found]) for c in names], names=names)


def _links(batches: Iterator[pa.RecordBatch], p: ForestParams) -> Iterator[pa.RecordBatch]:
    """Links between components of a region, by its documents' full sets.  A
    pair whose components are joined by then is not compared."""
    for group in _groups(batches):
        sets, shingled = UnionFind(), group["shingles"]
        component, a, b = group["component"].tolist(), [], []
        for first, j in _similar(group, p.sketch_similarity):
            own = shingled[first]
            for k in j.tolist():
                if sets.find(component[k]) == sets.find(component[first]):
                    continue
                other = shingled[k]
                at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                common = int(np.count_nonzero(own[at] == other))
                if 100 * common >= p.percent * (len(own) + len(other) - common):
                    sets.union(component[first], component[k])
                    a.append(group["doc_id"][[first]])
                    b.append(group["doc_id"][[k]])
        if a:
            yield _pairs(a, b)


def _sets(batches: Iterator[pa.RecordBatch], p: ForestParams) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            words = W.split(*utf8(field(batch, "text")), W.SPACES)
            rows = [np.sort(shingles(words, r, p.width).view(np.int64)) for r in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [field(batch, "doc_id"), pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "shingles"])


def _sets_of(ids: DataFrame, docs: DataFrame, p: ForestParams) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids``, read again from the texts."""
    ids = saved(ids.distinct(), "forest-candidates")
    if ids.count() <= p.broadcast_ids:
        ids = F.broadcast(ids)
    return saved(map_arrow(docs.join(ids, "doc_id", "left_semi"), lambda x: _sets(x, p),
                           "doc_id long, shingles array<long>"), "forest-sets")


def _confirm(pairs: DataFrame, docs: DataFrame, p: ForestParams) -> DataFrame:
    """Pairs whose full sets are similar enough, compared in the JVM."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs, p)
    both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y")).cast("long")
    return (both.select("a", "b", common.alias("c"), (F.size("x") + F.size("y")).cast("long").alias("n"))
            .filter(100 * F.col("c") >= p.percent * (F.col("n") - F.col("c"))).select("a", "b").distinct())


def _chunked(regions: DataFrame) -> DataFrame:
    """Rows of all regions; one of a region of several chunks goes to every pair
    of chunks with its own (``part``)."""
    chunks = F.col("chunks").cast("long")
    own = F.pmod(F.xxhash64("doc_id", "region"), chunks)
    each = regions.select("region", "tree", "doc_id", "chunks", own.alias("part"),
                          F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("other"))
    pair = F.least("part", "other") * chunks + F.greatest("part", "other")
    return each.select("region", pair.alias("chunk"), "part", "tree", "doc_id")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("region", "chunk").sortWithinPartitions("region", "chunk", "doc_id")


def _same_id(shingled: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the nodes of all sets of an id that has several."""
    several = (shingled.select("doc_id", "set_a", "set_b").distinct().groupBy("doc_id")
               .agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1").select("doc_id"))
    rows = shingled.join(several, "doc_id", "left_semi").join(classes, ["set_a", "set_b"]).filter("doc_id != node")
    return rows.select(F.least("doc_id", "node").alias("a"), F.greatest("doc_id", "node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, params: ForestParams = ForestParams(),
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return distilled(lambda: _near_duplicates(docs, params), "near-duplicates")


def _near_duplicates(docs: DataFrame, p: ForestParams) -> DataFrame:
    signed = saved(map_arrow(docs, lambda x: _signatures(x, p),
                             "doc_id long, n_shingles long, set_a long, set_b long, signature binary"),
                   "forest-signatures")
    narrow = signed.select("doc_id", "n_shingles", "set_a", "set_b")
    shingled = narrow.filter("n_shingles > 0 and doc_id is not null")
    classes = saved(shingled.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node")), "forest-classes")
    nodes = signed.filter("n_shingles > 0").join(
        classes.withColumnRenamed("node", "doc_id"), ["doc_id", "set_a", "set_b"], "left_semi").dropDuplicates(
        ["doc_id", "set_a", "set_b"])
    orders = map_arrow(nodes.select("doc_id", "n_shingles", "signature"), lambda x: _orders(x, p),
                       "doc_id long, n_shingles long, tree int, " + ", ".join(f"key{d} long" for d in p.depths))
    regions = saved(_regions(saved(orders, "forest-orders"), p), "forest-regions")
    sketched = saved(map_arrow(nodes.select("doc_id", "signature").join(_places(regions, p), "doc_id"),
                               _sketches, "doc_id long, sketch binary, places binary"), "forest-sketches")
    columns = ["region", "chunk", "part", "tree", "doc_id", "component", "sketch", "places"]

    chunked = _chunked(regions)
    rows = _dealt(chunked.join(sketched.withColumn("component", F.col("doc_id")), "doc_id").select(*columns))
    tested = saved(map_arrow(rows, lambda x: _forest(x, p), "a long, b long").distinct(), "forest-pairs")
    links = saved(_confirm(tested, docs, p).unionByName(_same_id(shingled, classes)), "forest-links")
    found = components(links)
    members = sketched.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    left = saved(map_arrow(_dealt(chunked.join(members, "doc_id").select(*columns)), lambda x: _open(x, p),
                           "region long, chunk long, part long, tree int, doc_id long"), "forest-open")
    if not left.isEmpty():
        rows = left.join(members, "doc_id").join(_sets_of(left.select("doc_id"), docs, p), "doc_id")
        new = saved(map_arrow(_dealt(rows.select(*columns, "shingles")), lambda x: _links(x, p), "a long, b long")
                    .distinct(), "forest-links")
        found = components(links.unionByName(new))
    member = classes.join(found, "node", "left").select(
        "set_a", "set_b", F.coalesce("component", "node").alias("class_component"))
    linked = shingled.join(member, ["set_a", "set_b"]).select(
        "doc_id", "n_shingles", F.col("class_component").alias("component_id"))
    alone = narrow.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _places(regions: DataFrame, p: ForestParams) -> DataFrame:
    """(doc_id, places): the region of each tree where it is whole (and the
    only one, for an id with several texts), else a number no other document
    has."""
    one = regions.groupBy("doc_id", "tree").agg(F.max("region").alias("region"), F.max("chunks").alias("chunks"),
                                                F.count(F.lit(1)).alias("n"))
    whole = F.map_from_entries(F.collect_list(
        F.when((F.col("chunks") == 1) & (F.col("n") == 1), F.struct("tree", "region"))))
    of = one.groupBy("doc_id").agg(whole.alias("m"))
    return of.select("doc_id", F.transform(F.sequence(F.lit(0), F.lit(p.trees - 1)), lambda t: F.coalesce(
        F.try_element_at("m", t), F.xxhash64("doc_id", t))).alias("places"))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lowest byte of each minhash."""
    for batch in batches:
        signs = field(batch, "signature").to_pylist()
        rows = [np.frombuffer(s, "<u4").astype(np.uint8).tobytes() for s in signs]
        places = field(batch, "places").flatten().to_numpy().astype("<i8").reshape(batch.num_rows, -1)
        yield pa.RecordBatch.from_arrays(
            [field(batch, "doc_id"), pa.array(rows, pa.binary()),
             pa.array([x.tobytes() for x in places], pa.binary())], names=["doc_id", "sketch", "places"])
