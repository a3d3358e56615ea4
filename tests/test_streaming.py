"""Stream scoring equals batch scoring; restarts do not duplicate rows."""

from tonalyze.operators import classifier as clf
from tonalyze.operators import records
from tonalyze.plans import catalog
from tonalyze.session import work_path
from tonalyze.streaming import scoring as stream

COLS = ["texto", "etiqueta_real", "prediccion", "confianza", "probability"]


def _rows(df):
    return sorted(tuple(r) for r in clf.rounded(df.select(*COLS)).collect())


def test_stream_equals_batch_and_resume_is_exactly_once(spark, sf_small):
    model = catalog.trained_model(spark, sf_small)
    lines = records.encode_records(catalog._cleaned(spark, sf_small)).select("value")
    batch = _rows(stream.score_lines(model, lines))

    src, sink, ckpt = (work_path(spark, n) for n in ("t-src", "t-sink", "t-ckpt"))
    ordered = lines.orderBy("value").collect()
    half = len(ordered) // 2
    stream.write_lines(spark.createDataFrame(ordered[:half], "value string"), src)
    stream.run_available(stream.score_lines(model, stream.text_source(spark, src)), sink, ckpt)
    assert spark.read.parquet(sink).count() == half
    stream.write_lines(spark.createDataFrame(ordered[half:], "value string"), src)
    for _ in range(2):   # second run finds nothing new
        stream.run_available(stream.score_lines(model, stream.text_source(spark, src)), sink, ckpt)
    out = spark.read.parquet(sink)
    assert _rows(out) == batch
    assert out.filter("timestamp IS NULL").count() == 0


def test_long_running_query_with_rate_limit(spark, sf_small):
    model = catalog.trained_model(spark, sf_small)
    lines = records.encode_records(catalog._cleaned(spark, sf_small)).select("value")
    src, sink, ckpt = (work_path(spark, n) for n in ("lr-src", "lr-sink", "lr-ckpt"))
    stream.write_lines(lines.repartition(3), src)
    q = stream.start_scoring(model, spark, src, sink, ckpt, every="100 milliseconds",
                             max_files_per_trigger=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(sink).count() == lines.count()
    assert q.lastProgress is not None


def test_batch_replayed_after_crash_is_not_duplicated(spark, sf_small):
    """A batch whose offsets were logged but whose commit was lost (a crash
    between the two) is re-run on restart; the sink must not append twice.
    The crashed state is built by copying the checkpoint without the last
    commit marker."""
    import os
    import shutil

    model = catalog.trained_model(spark, sf_small)
    lines = records.encode_records(catalog._cleaned(spark, sf_small)).select("value").collect()
    src, sink, ckpt = (work_path(spark, n) for n in ("cr-src", "cr-sink", "cr-ckpt"))
    local = ckpt.removeprefix("file:")
    half = len(lines) // 2
    stream.write_lines(spark.createDataFrame(lines[:half], "value string"), src)
    stream.run_available(stream.score_lines(model, stream.text_source(spark, src)), sink, ckpt)
    stream.write_lines(spark.createDataFrame(lines[half:], "value string"), src)
    stream.run_available(stream.score_lines(model, stream.text_source(spark, src)), sink, ckpt)
    assert spark.read.parquet(sink).count() == len(lines)
    commits = sorted(int(f) for f in os.listdir(os.path.join(local, "commits")) if f.isdigit())
    offsets = sorted(int(f) for f in os.listdir(os.path.join(local, "offsets")) if f.isdigit())
    last = commits[-1]
    assert last in offsets
    crashed = work_path(spark, "cr-ckpt-crashed").removeprefix("file:")
    shutil.copytree(local, crashed, ignore=lambda d, names: [
        n for n in names if os.path.basename(d) == "commits" and n in (str(last), f".{last}.crc")])
    assert str(last) not in os.listdir(os.path.join(crashed, "commits"))
    stream.run_available(stream.score_lines(model, stream.text_source(spark, src)), sink, crashed)
    assert str(last) in os.listdir(os.path.join(crashed, "commits"))   # the batch was re-run
    assert spark.read.parquet(sink).count() == len(lines)              # and wrote nothing twice


def _into_store(spark, model, src, path, ckpt):
    stream.store_available(spark, stream.score_lines(model, stream.parquet_source(spark, src)), path, ckpt, "t")


def test_sink_commits_each_batch_once(spark, sf_small):
    """A batch whose commit marker was lost is replayed with its id: it
    replaces its own commit in the store, beside batches of other writers."""
    import os
    import shutil

    from tonalyze.operators import store

    model = catalog.trained_model(spark, sf_small)
    lines = records.encode_records(catalog._cleaned(spark, sf_small)).select("value")
    src, path, ckpt = (work_path(spark, n) for n in ("sk-src", "sk-store", "sk-ckpt"))
    half = lines.count() // 2
    ordered = lines.orderBy("value").collect()
    spark.createDataFrame(ordered[:half], "value string").write.parquet(src)
    _into_store(spark, model, src, path, ckpt)
    assert store.read_store(spark, path).count() == half
    spark.createDataFrame(ordered[half:], "value string").write.mode("append").parquet(src)
    store.append_predictions(store.read_store(spark, path).limit(3), path, batch_id=7)
    _into_store(spark, model, src, path, ckpt)
    local = ckpt.removeprefix("file:")
    last = max(int(f) for f in os.listdir(os.path.join(local, "commits")) if f.isdigit())
    before = store.live_batches(spark, path)
    crashed = work_path(spark, "sk-ckpt-crashed").removeprefix("file:")
    shutil.copytree(local, crashed, ignore=lambda d, names: [
        n for n in names if os.path.basename(d) == "commits" and n in (str(last), f".{last}.crc")])
    _into_store(spark, model, src, path, crashed)
    after = store.live_batches(spark, path)
    name = f"stream-t-{last}"
    assert after.keys() == before.keys() and after[name]["rows"] == before[name]["rows"]
    assert after[name]["write"] != before[name]["write"]           # it was written again
    assert store.read_store(spark, path).count() == len(ordered) + 3
    rows = store.read_store(spark, path).select("id", "texto", "prediccion", "estado").distinct()
    want = stream.score_lines(model, lines).selectExpr("id", "texto", "prediccion", "'almacenado' estado").distinct()
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, want.collect()))


def test_a_failed_batch_leaves_nothing(spark, sf_small):
    import pytest
    from pyspark.sql import functions as F

    from tonalyze.operators import store
    from tonalyze.streaming import sink

    src, path, ckpt = (work_path(spark, n) for n in ("bad-src", "bad-store", "bad-ckpt"))
    spark.range(20).selectExpr("cast(id as string) id").repartition(4).write.parquet(src)
    sink.register(spark)
    rows = spark.readStream.schema("id string").parquet(src).select(
        "id", F.when(F.col("id") == "7", F.raise_error(F.lit("stop"))).alias("texto"))
    with pytest.raises(Exception):
        query = (rows.writeStream.format(sink.FORMAT).option("path", path).option("stream", "x")
                 .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        query.awaitTermination()
    assert store.live_batches(spark, path) == {}


def test_console_sink_runs(spark, sf_small):
    model = catalog.trained_model(spark, sf_small)
    src, ckpt = work_path(spark, "con-src"), work_path(spark, "con-ckpt")
    stream.write_lines(spark.createDataFrame([("hola|||positivo",), ("sin delimitador",)], "value string"), src)
    stream.run_available(stream.score_lines(model, stream.text_source(spark, src)), None, ckpt, fmt="console")
