"""Command line, run in-process on the test session."""

import os

from tonalyze.__main__ import main
from tonalyze.session import work_path


def test_list(capsys):
    assert main(["list"]) == 0
    assert "class_stats" in capsys.readouterr().out


def test_train_score_and_query(spark, sf_small):
    model, out, rep = (work_path(spark, n) for n in ("cli-model", "cli-out", "cli-report"))
    assert main(["train", "--sf-dir", sf_small, "--model", model], spark) == 0
    assert main(["score", "--model", model, "--input", os.path.join(sf_small, "documents.parquet"),
                 "--keep", "doc_id", "--out", out], spark) == 0
    scored = spark.read.parquet(out)
    assert scored.count() == 200
    assert set(scored.columns) >= {"doc_id", "prediccion", "confianza", "probability", "status"}
    assert main(["query", "class_stats", "--sf-dir", sf_small, "--out", rep], spark) == 0
    assert spark.read.parquet(rep).count() == 4


def test_train_stream_store_report_end_to_end(spark, sf_small):
    """The application's flow: train, stream lines in, store request
    predictions, then report over both stores."""
    from tonalyze.operators import classifier as clf
    from tonalyze.operators import records, store
    from tonalyze.plans import catalog
    from tonalyze.sources import tables as T
    from tonalyze.streaming import scoring as stream

    model_path, src, sink, ckpt, st, rep = (work_path(spark, n) for n in (
        "e2e-model", "e2e-src", "e2e-sink", "e2e-ckpt", "e2e-store", "e2e-report"))
    assert main(["train", "--sf-dir", sf_small, "--model", model_path], spark) == 0
    stream.write_lines(records.encode_records(catalog._cleaned(spark, sf_small)), src)
    assert main(["stream", "--model", model_path, "--source", src, "--sink", sink,
                 "--checkpoint", ckpt, "--available-now"], spark) == 0
    from pyspark.ml import PipelineModel
    scored = clf.score(PipelineModel.load(model_path), T.documents(spark, sf_small), keep=["doc_id", "texto"])
    store.append_predictions(store.enrich_for_store(scored, id_col="doc_id"), st, batch_id=1)
    assert main(["report", "stats", "--store", st, "--stream-sink", sink, "--out", rep], spark) == 0
    stats = {r["_id"]: r["total"] for r in spark.read.parquet(rep).collect()}
    assert sum(stats.values()) == 200 + 87          # 200 stored + 87 streamed
    preds = store.read_predictions(spark, st, sink)
    assert preds.filter("ts IS NULL").count() == 0
    assert main(["report", "history", "--store", st, "--stream-sink", sink, "--limit", "5"], spark) == 0


def test_every_report_runs_over_store_and_sink(spark, sf_small):
    from tonalyze.operators import classifier as clf
    from tonalyze.operators import records, store
    from tonalyze.plans import catalog
    from tonalyze.sources import tables as T
    from tonalyze.streaming import scoring as stream

    model = catalog.trained_model(spark, sf_small)
    st, src, sink, ckpt = (work_path(spark, n) for n in ("rep-store", "rep-src", "rep-sink", "rep-ckpt"))
    scored = clf.score(model, T.documents(spark, sf_small), keep=["doc_id", "texto"])
    store.append_predictions(store.enrich_for_store(scored, id_col="doc_id"), st, batch_id=3)
    stream.write_lines(records.encode_records(catalog._cleaned(spark, sf_small)), src)
    stream.run_available(stream.score_lines(model, stream.text_source(spark, src)), sink, ckpt)
    outs = {}
    for name in ("history", "stats", "summary", "share", "over-time", "overview", "json"):
        outs[name] = work_path(spark, f"rep-{name}")
        args = ["report", name, "--store", st, "--stream-sink", sink, "--out", outs[name]]
        assert main(args, spark) == 0, name
        assert spark.read.parquet(outs[name]).count() >= 1, name
    assert spark.read.parquet(outs["summary"]).first().total_analizado == 200 + 87
    assert abs(sum(r.proporcion for r in spark.read.parquet(outs["share"]).collect()) - 1) < 1e-5
    assert main(["report", "history", "--store", st, "--clase", "positivo", "--limit", "3"], spark) == 0


def test_migrate_and_clear_commands(spark, sf_small, capsys):
    from tonalyze.operators import store
    from tonalyze.sources import tables as T

    src, dst = work_path(spark, "cli-legacy"), work_path(spark, "cli-migrated")
    T.stored_predictions(spark, sf_small).write.parquet(src)
    assert main(["migrate", "--src", src, "--dst", dst], spark) == 0
    out = capsys.readouterr().out
    assert "matched_count: 87" in out and "modified_count: 8" in out
    migrated = store.read_store(spark, dst)
    assert migrated.count() == 87 and migrated.filter("prediccion IS NULL").count() == 0
    st = work_path(spark, "cli-clear")
    store.append_predictions(store.read_store(spark, dst), st)
    assert main(["clear", "--store", st], spark) == 0
    assert "deleted: 87" in capsys.readouterr().out
    assert store.read_store(spark, st).count() == 0
    docs, made, bad = (work_path(spark, n) for n in ("cli-docs", "cli-docs-store", "cli-docs-bad"))
    spark.createDataFrame([('{"id": "1", "intencion_predicha": "neutral"}',), ("{",)], "value string").write.text(docs)
    assert main(["migrate", "--src", docs, "--dst", made, "--format", "json", "--rejected", bad], spark) == 0
    assert "matched_count: 1\nmodified_count: 1" in capsys.readouterr().out
    assert store.read_store(spark, made).first().prediccion == "neutral" and spark.read.json(bad).count() == 1
    assert main(["migrate", "--in-place", "--dst", made], spark) == 0
    assert "matched_count: 1\nmodified_count: 0" in capsys.readouterr().out


def test_train_from_csv_score_store_report(spark, sf_small, tmp_path):
    """Only commands: train on a CSV, score into the store, stream into the
    store, report."""
    rows = "".join(f"texto bueno {i},positivo\ntexto malo {i},negativo\n" for i in range(5))
    (tmp_path / "rows.csv").write_text("texto,etiqueta\n" + rows, encoding="utf-8")
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.txt").write_text("muy bueno|||positivo\nmuy malo|||negativo\n", encoding="utf-8")
    model, st, sink, ckpt, rep = (work_path(spark, n) for n in ("c-model", "c-store", "c-sink", "c-ckpt", "c-report"))
    docs = os.path.join(sf_small, "documents.parquet")
    assert main(["train", "--csv", str(tmp_path / "rows.csv"), "--model", model], spark) == 0
    for _ in range(2):      # the batch sent again replaces itself
        assert main(["score", "--model", model, "--input", docs, "--store", st, "--id-col", "doc_id",
                     "--batch-id", "1"], spark) == 0
    for _ in range(2):      # nothing new the second time
        assert main(["stream", "--model", model, "--source", str(src), "--sink", sink, "--store", st,
                     "--checkpoint", ckpt, "--available-now"], spark) == 0
    assert main(["report", "stats", "--store", st, "--out", rep], spark) == 0
    assert sum(r["total"] for r in spark.read.parquet(rep).collect()) == 200 + 2
