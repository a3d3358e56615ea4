"""Quality classifier: a byte-level convolutional network (``byte_cnn``).

Training reads a bounded sample: ``train_docs`` labelled documents of the
training fold, chosen by a hash of their id; of each, executors cut up to
``train_chunks`` chunks at random places of the whole text.  The network is
fitted on the driver and broadcast (about half a megabyte of weights).
Scoring covers every whole text with overlapping chunks; nothing is
shuffled.

Defined results
    null or empty text    scored as one chunk of padding
    very long text        all its chunks, ``batch_bytes`` of texts at a time
    repeated rows, ties   each row by itself
    no labelled row       score 0.5 for every text
    empty table           empty result
    clashing columns      only id and text are read
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field as field_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalyze.llm.byte_cnn import Net, NetParams, chunks
from tonalyze.llm.common import field, fold, map_arrow, slices


@dataclass(frozen=True)
class QualityParams:
    net: NetParams = field_(default_factory=NetParams)
    train_docs: int = 4000
    train_chunks: int = 24
    modulus: int = 3              # folds by crc32 of the id
    held_out: int = 1


def labelled_sample(labels: DataFrame, label: str, modulus: int, held_out: int, n: int) -> DataFrame:
    """(doc_id, label) of at most ``n`` documents of the training fold, those
    with the smallest hash of their id."""
    known = labels.filter((fold(F.col("doc_id"), modulus) != held_out) & F.col(label).isNotNull())
    return (known.groupBy("doc_id").agg(F.max(label).alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(n))


def _cut(batches: Iterator[pa.RecordBatch], params: QualityParams) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(field(batch, "doc_id").to_pylist(), field(batch, "text").to_pylist()):
            own = chunks((text or "").encode(), params.net)
            if len(own) > params.train_chunks:
                rng = np.random.Generator(np.random.PCG64(abs(doc_id)))
                own = own[np.sort(rng.choice(len(own), params.train_chunks, replace=False))]
            rows.append(own.tobytes())
        yield pa.RecordBatch.from_arrays([field(batch, "label"), pa.array(rows, pa.binary())],
                                         names=["label", "chunks"])


def train(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> Net | None:
    sample = labelled_sample(labels, "quality", params.modulus, params.held_out, params.train_docs)
    # at most train_docs rows of two numbers
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = map_arrow(texts.select("doc_id", F.col("label").cast("int").alias("label"), "text"),
                     lambda x: _cut(x, params), "label int, chunks binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["label"], bytes(r["chunks"])))      # any order of partitions
    parts = [np.frombuffer(r["chunks"], np.uint8).reshape(-1, params.net.chunk) for r in rows]
    return Net(params.net).train(parts, np.array([r["label"] for r in rows], np.float32))


def _score(batches: Iterator[pa.RecordBatch], net: Net | None, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, max_bytes=batch_bytes):
            texts = [(t or "").encode() for t in field(batch, "text").to_pylist()]
            scores = np.full(len(texts), 0.5) if net is None else net.score(texts)
            yield pa.RecordBatch.from_arrays([field(batch, "doc_id"), pa.array(scores)],
                                             names=["doc_id", "score"])


def classify(docs: DataFrame, net: Net | None, batch_bytes: int = 500_000) -> DataFrame:
    """doc_id, score and predicted (score >= 0.5) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_arrow(docs.select("doc_id", "text"), lambda x: _score(x, shared.value, batch_bytes),
                       f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
