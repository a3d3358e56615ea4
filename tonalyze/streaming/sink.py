"""A streaming sink that commits each micro-batch, by its id, to the store.

Spark's Python data source API hands the rows of a micro-batch to ``write`` on
the executors and then, once all tasks have ended well, calls ``commit`` with
the batch id.  Tasks write parquet files into folders of their own below the
store; ``commit`` puts one small file that names them, under a name made of
the stream and the batch id.  A batch that is replayed after a lost commit
marker writes new files and replaces its own commit: it is in the store once.
Files of a failed or replaced attempt are named by no commit, so no reader
sees them.

The class is sent to Spark's Python workers by value and imports nothing of
this package.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

FORMAT = "prediction_store"


@dataclass
class Written(WriterCommitMessage):
    folder: str
    rows: int


def filesystem(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def put(folder: str, name: str, content: dict) -> None:
    """Put ``name`` into ``folder`` whole: readers see all of it or, as it
    was before, an older one or none."""
    files, at = filesystem(folder)
    files.create_dir(at, recursive=True)
    hidden = f"{at}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(hidden) as out:
        out.write(json.dumps(content).encode())
    files.move(hidden, f"{at}/{name}")


class StoreWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, stream: str):
        self.path, self.stream = path.rstrip("/"), stream

    def write(self, iterator):
        import pyarrow as pa
        import pyarrow.parquet as pq

        folder, rows, out = f"data/{uuid.uuid4().hex}", 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                files, at = filesystem(f"{self.path}/{folder}")
                files.create_dir(at, recursive=True)
                out = pq.ParquetWriter(f"{at}/part-0.parquet", batch.schema, filesystem=files)
            out.write_table(pa.Table.from_batches([batch]))
            rows += batch.num_rows
        if out is None:
            return None
        out.close()
        return Written(folder, rows)

    def commit(self, messages, batchId):
        written = [m for m in messages if m is not None]
        put(f"{self.path}/commits", f"stream-{self.stream}-{batchId}.json", {
            "write": uuid.uuid4().hex, "paths": [m.folder for m in written], "format": "parquet",
            "rows": sum(m.rows for m in written)})

    def abort(self, messages, batchId):
        for m in messages:
            if m is not None:
                files, at = filesystem(f"{self.path}/{m.folder}")
                files.delete_dir(at)


class StoreSink(DataSource):
    """``writeStream.format("prediction_store")``; options ``path`` (the store)
    and ``stream`` (the name that, with the batch id, names a batch)."""

    @classmethod
    def name(cls):
        return FORMAT

    def streamWriter(self, schema, overwrite):
        return StoreWriter(self.options["path"], self.options["stream"])


def register(spark) -> None:
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(StoreSink)
