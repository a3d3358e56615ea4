"""Helpers shared by the text operators: tables, batches, folds, row keys."""

from __future__ import annotations

import os
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tonalyze
from tonalyze.session import work_path

_SHIPPED: set[str] = set()
#: Tables saved inside each running ``distilled``.
_OPEN: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with a table every executor can read again, so a lost
    executor never makes an iterative job start over.
    """
    path = work_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if _OPEN:
        _OPEN[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def distilled(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """``saved(build())``, without the tables that ``build`` saved on its way:
    they are deleted once the result is written."""
    _OPEN.append([])
    try:
        result = saved(build(), name)
    finally:
        made = _OPEN.pop()
    if _OPEN:
        _OPEN[-1].append(made[-1])
    spark = result.sparkSession
    for path in made[:-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return result


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once, inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def cut_spans(text: Column, spans: Column) -> Column:
    """``text`` without its (start, end) character spans, sorted and disjoint."""
    head = F.array(F.substring(text, F.lit(1), F.get(spans, F.lit(0))["start"].cast("int")))
    rest = F.transform(spans, lambda s, i: F.substring(
        text, (s["end"] + 1).cast("int"),
        F.coalesce(F.get(spans, i + 1)["start"] - s["end"], F.length(text)).cast("int")))
    return F.array_join(F.concat(head, rest), "")


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application (Spark
    hands the archive to each executor; nothing needs to be installed there)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(tonalyze.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tonalyze-"), "tonalyze.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tonalyze", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Is the row in the held-out fold (a null id is in none)?"""
    return F.coalesce(fold(F.col(id_col), modulus) == remainder, F.lit(False)).alias("held_out")


def fold_of(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Identity of a row by its id and text (both may be null)."""
    return F.md5(F.concat_ws("\u0000", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                             F.coalesce(F.col(text_col), F.lit(""))))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or len(offsets) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text",
           max_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``max_bytes`` of text each, so
    that the memory of a step follows this bound (or one text, if longer)."""
    if not batch.num_rows:
        return
    column = batch.column(batch.schema.get_field_index(text))
    _, offsets = utf8(column)
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        end = max(end, start + 1)
        yield batch.slice(start, end - start)
        start = end


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
