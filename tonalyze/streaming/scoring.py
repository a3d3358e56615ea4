"""Stream scoring: text lines in, scored predictions appended to a table.

Source: a folder of text files holding wire records (``text|||label``), the
replayable stand-in for the line socket (a socket source cannot be replayed
after a failure; on a cluster this is a file drop, text or parquet).
Sink: the predictions store itself, each micro-batch one commit by its batch
id (``streaming.sink``), or the parquet file sink with a checkpoint.  Offsets are logged before
a batch runs and the sink commits each batch id once in its own metadata
log, so a batch planned but not committed (a crash between the two) is
re-run on restart without duplicating rows: exactly-once, unlike a
``foreachBatch`` append.  Each batch is written in one action (no
separate emptiness check or console print on the same lineage).

The query is stateless (projections and the model's row-wise stages), so
there is no state store, watermark or shuffle; it scales with the number
of source files per trigger.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonalyze.operators import classifier as clf
from tonalyze.operators import records, store
from tonalyze.streaming import sink

STREAM_COLUMNS = ("id", "texto", "etiqueta_real", "prediccion", "confianza", "probability", "timestamp")


def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def parquet_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Wire lines from a folder of parquet files with a column ``value``: the
    other replayable file source (whole files, columnar, lines with breaks)."""
    reader = spark.readStream.schema("value string").format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def score_lines(model: PipelineModel, lines: DataFrame) -> DataFrame:
    """Parse wire lines, score them, add processing time; batch or stream.

    ``id`` is a hash of the line, so a row read again has the id it had."""
    parsed = records.parse_records(lines.withColumn("id", F.sha2("value", 256)), "value")
    scored = clf.score(model, parsed, keep=["id", "texto", "etiqueta_real"])
    return scored.select(*STREAM_COLUMNS[:-1], F.current_timestamp().alias(STREAM_COLUMNS[-1]))


def run_available(stream: DataFrame, sink_path: str | None, checkpoint: str,
                  fmt: str = "parquet", timeout_s: float | None = None) -> None:
    """Process everything available now, then stop (one or more batches).

    ``fmt="console"`` (no path) prints each batch, the debugging sink.  No
    deadline unless ``timeout_s`` sets one.
    """
    writer = (stream.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if fmt == "console":
        writer = writer.option("truncate", "false")
    query = writer.start(sink_path) if sink_path else writer.start()
    _await(query, timeout_s)


def _await(query, timeout_s: float | None) -> None:
    finished = False
    try:
        finished = query.awaitTermination(timeout_s) if timeout_s is not None else (
            query.awaitTermination() or True)
    finally:
        if query.isActive:
            query.stop()
    if query.exception() is not None:
        raise query.exception()
    if not finished:
        # stopped before the backlog was drained: the sink holds a prefix
        # (committed batches only); say so instead of returning quietly
        raise TimeoutError(f"stream did not finish within {timeout_s} s; "
                           "restart with the same checkpoint to continue")


def store_available(spark: SparkSession, scored: DataFrame, store_path: str, checkpoint: str,
                    name: str, timeout_s: float | None = None) -> None:
    """Process everything available now straight into the predictions store:
    each micro-batch is one commit named by ``name`` and its batch id.  ``name``
    belongs to the checkpoint: another checkpoint needs another name."""
    sink.register(spark)
    rows = store.enrich_for_store(scored.withColumn("ts", store.utc_ntz(F.col("timestamp"))), "id")
    query = (rows.writeStream.format(sink.FORMAT).outputMode("append")
             .option("path", store_path).option("stream", name)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _await(query, timeout_s)


def append_to_store(spark: SparkSession, sink_path: str, store_path: str, fmt: str = "parquet") -> int:
    """Bring what a stream has committed to the file sink ``sink_path`` into the
    predictions store; returns how many rows were new.

    A file of the sink belongs to one committed batch and never changes, so
    it names the batch: files the store has are skipped, and one that is
    sent again replaces itself.  Runs beside or after the stream.
    """
    rows = spark.read.format(fmt).load(sink_path).select(
        *STREAM_COLUMNS, F.concat(F.lit("stream-"), F.col("_metadata.file_name")).alias(store.BATCH_COLUMN))
    known = [(n,) for n in store.live_batches(spark, store_path)]
    if known:
        seen = spark.createDataFrame(known, "_seen string")
        rows = rows.join(seen, F.col(store.BATCH_COLUMN) == F.col("_seen"), "left_anti")
    rows = rows.withColumn("ts", store.utc_ntz(F.col("timestamp")))
    return store.append_batches(store.enrich_for_store(rows, "id", keep=(store.BATCH_COLUMN,)), store_path)


def write_lines(records_df: DataFrame, path: str) -> None:
    """Append wire lines as new text files of the source folder."""
    records_df.select("value").write.mode("append").text(path)


def start_scoring(model: PipelineModel, spark: SparkSession, source: str, sink: str,
                  checkpoint: str, every: str = "1 second",
                  max_files_per_trigger: int | None = None, fmt: str = "parquet"):
    """Long-running form: a micro-batch every ``every``; returns the query.

    Restarting with the same checkpoint resumes after the last committed
    batch.  The caller awaits or stops the returned query.
    """
    scored = score_lines(model, text_source(spark, source, max_files_per_trigger))
    return (scored.writeStream.format(fmt).outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=every)
            .start(sink))
