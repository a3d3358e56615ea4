"""Store maintenance: migration, counts, unified read, append and clear."""

import datetime as dt

from tonalyze.operators import store
from tonalyze.session import work_path

LEGACY = ("id string, texto string, prediccion string, intencion_predicha string, confianza double, "
          "probability array<double>, ts timestamp_ntz, estado string")
T0 = dt.datetime(2024, 1, 1)


def _legacy(spark):
    return spark.createDataFrame([
        ("1", "a", "positivo", None, None, [0.6, 0.4], T0, "almacenado"),
        ("2", "b", None, "negativo", 0.5, None, T0, "almacenado"),
        ("3", "c", None, None, None, None, T0, "almacenado"),
    ], LEGACY)


def test_migration_is_idempotent(spark):
    once = store.migrate_predictions(_legacy(spark))
    twice = store.migrate_predictions(once)
    assert "confianza" not in once.columns
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert {r.id: r.prediccion for r in once.collect()} == {"1": "positivo", "2": "negativo", "3": None}


def test_migration_counts(spark):
    r = store.migration_counts(_legacy(spark)).first()
    assert (r.matched_count, r.modified_count) == (3, 1)
    again = store.migration_counts(store.migrate_predictions(_legacy(spark))).first()
    assert again.modified_count == 0


def test_unified_read(spark):
    streamed = spark.createDataFrame(
        [("x", "positivo", "negativo", dt.datetime(2024, 2, 1))],
        "texto string, etiqueta_real string, intencion_predicha string, timestamp timestamp")
    both = store.unified_predictions(_legacy(spark), streamed)
    rows = {r.texto: r for r in both.collect()}
    assert rows["x"].prediccion == "negativo" and rows["x"].ts is not None
    assert rows["b"].prediccion == "negativo"
    assert len(rows) == 4


def test_append_then_clear(spark):
    path = work_path(spark, "test-store")
    batch = spark.createDataFrame([("t1", "positivo"), ("t2", "neutral")], "texto string, prediccion string")
    store.append_predictions(store.enrich_for_store(batch), path)
    store.append_predictions(store.enrich_for_store(batch), path)
    saved = store.read_store(spark, path)
    rows = saved.collect()
    assert len(rows) == 4 and len({r.id for r in rows}) == 4
    assert all(r.ts is not None and r.estado == "almacenado" for r in rows)
    assert store.clear_predictions(spark, path) == 4
    assert store.read_store(spark, path).count() == 0


def test_append_keyed_by_batch_id_is_idempotent(spark):
    path = work_path(spark, "test-store-batches")
    b7 = spark.createDataFrame([("1", "x", "positivo"), ("2", "y", "neutral")], "id string, texto string, prediccion string")
    b8 = spark.createDataFrame([("3", "z", "negativo")], "id string, texto string, prediccion string")
    store.append_predictions(store.enrich_for_store(b7, id_col="id"), path, batch_id=7)
    store.append_predictions(store.enrich_for_store(b7, id_col="id"), path, batch_id=7)   # retried batch
    store.append_predictions(store.enrich_for_store(b8, id_col="id"), path, batch_id=8)
    saved = store.read_store(spark, path)
    assert sorted(r.id for r in saved.collect()) == ["1", "2", "3"]
    assert saved.columns == ["id", "texto", "prediccion", "probability", "ts", "estado"]
    assert store.clear_predictions(spark, path) == 3
    assert store.read_store(spark, path).count() == 0


def test_read_predictions_needs_a_source(spark):
    import pytest
    with pytest.raises(ValueError):
        store.read_predictions(spark)


def _batch(spark, *ids):
    rows = [(i, "t", "neutral") for i in ids]
    return store.enrich_for_store(spark.createDataFrame(rows, "id string, texto string, prediccion string"), "id")


def test_keyed_and_unkeyed_batches_mix_in_any_order(spark):
    for keyed_first in (True, False):
        path = work_path(spark, "test-store-mixed")
        for keyed in ((True, False) if keyed_first else (False, True)):
            if keyed:
                store.append_predictions(_batch(spark, "1"), path, batch_id=3)
            else:
                store.append_predictions(_batch(spark, "2", "3"), path)
        assert sorted(r.id for r in store.read_store(spark, path).collect()) == ["1", "2", "3"]
        assert store.clear_predictions(spark, path) == 3
        assert store.read_store(spark, path).count() == 0
        store.append_predictions(_batch(spark, "4"), path)
        assert store.read_store(spark, path).count() == 1


def test_other_layouts_are_refused(spark):
    import pytest
    path = work_path(spark, "test-store-flat")
    _batch(spark, "1").write.parquet(path)
    with pytest.raises(ValueError):
        store.append_predictions(_batch(spark, "2"), path, batch_id=1)
    with pytest.raises(ValueError):
        store.read_store(spark, path)
    moved = work_path(spark, "test-store-moved")
    assert store.migrate_store(spark, path, moved) == (1, 0)
    store.append_predictions(_batch(spark, "2"), moved, batch_id=1)
    assert store.read_store(spark, moved).count() == 2


def test_stored_time_is_utc_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        got = _batch(spark, "1").first().ts
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        assert abs(now - got) < dt.timedelta(minutes=2)
        path = work_path(spark, "test-sink")
        at = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
        spark.createDataFrame([("a", "x", at)], "id string, texto string, timestamp timestamp").write.parquet(path)
        assert store.read_predictions(spark, stream_sink=path).first().ts == dt.datetime(2024, 1, 1, 12)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_newest_rows_do_not_depend_on_partitions(spark):
    from tonalyze.operators import reports
    rows = [(f"h{i}", f"t{i}", None if i == 5 else T0) for i in range(6)]
    got = set()
    for n in (1, 3, 5):
        preds = spark.createDataFrame(rows, "id string, texto string, ts timestamp_ntz").repartition(n)
        got.add(tuple(r.texto for r in reports.newest_rows(preds, 2).collect()))
    assert got == {("t4", "t3")}


def _ids(spark, path):
    return sorted(r.id for r in store.read_store(spark, path).collect())


def _between(monkeypatch, action):
    """Run ``action`` once, right before the next commit is put in place."""
    real, done = store.put, []

    def put(*args):
        if not done:
            done.append(1)
            action()
        real(*args)

    monkeypatch.setattr(store, "put", put)


def test_append_while_clearing_stays(spark, monkeypatch):
    path = work_path(spark, "test-store-race")
    store.append_predictions(_batch(spark, "1", "2"), path, batch_id=1)
    store.append_predictions(_batch(spark, "3"), path)
    _between(monkeypatch, lambda: store.append_predictions(_batch(spark, "4"), path, batch_id=2))
    assert store.clear_predictions(spark, path) == 3
    assert _ids(spark, path) == ["4"]
    assert store.clear_predictions(spark, path) == 1 and _ids(spark, path) == []
    store.append_predictions(_batch(spark, "1"), path, batch_id=1)     # a cleared name can be used again
    assert _ids(spark, path) == ["1"]


def test_batch_sent_again_while_clearing_stays(spark, monkeypatch):
    path = work_path(spark, "test-store-race")
    store.append_predictions(_batch(spark, "1"), path, batch_id=1)
    _between(monkeypatch, lambda: store.append_predictions(_batch(spark, "1", "2"), path, batch_id=1))
    assert store.clear_predictions(spark, path) == 1
    assert _ids(spark, path) == ["1", "2"]


def test_append_while_migrating_stays(spark, monkeypatch):
    src, path = work_path(spark, "test-legacy"), work_path(spark, "test-store-race")
    _legacy(spark).write.parquet(src)
    # a store whose first batch holds rows of the older schema
    store.append_predictions(_batch(spark, "9"), path, batch_id=1)
    entry = store._write(_legacy(spark), path, "parquet")
    store.put(f"{path}/commits", "old.json", entry)
    _between(monkeypatch, lambda: store.append_predictions(_batch(spark, "8"), path, batch_id=2))
    assert store.migrate_in_place(spark, path) == (4, 1)
    rows = {r.id: r for r in store.read_store(spark, path).collect()}
    assert sorted(rows) == ["1", "2", "3", "8", "9"] and rows["2"].prediccion == "negativo"
    assert store.migrate_in_place(spark, path) == (5, 0)
    # a migrated batch that is sent again replaces itself
    store.append_predictions(_batch(spark, "9", "10"), path, batch_id=1)
    assert _ids(spark, path) == ["1", "10", "2", "3", "8", "9"]
    before = _ids(spark, path)
    assert store.purge(spark, path) > 0 and _ids(spark, path) == before


def test_clear_and_migrate_at_once(spark, monkeypatch):
    path = work_path(spark, "test-store-race")
    store.append_predictions(_batch(spark, "1"), path, batch_id=1)
    _between(monkeypatch, lambda: store.clear_predictions(spark, path))
    store.migrate_in_place(spark, path)
    assert _ids(spark, path) == []


def test_batches_with_odd_names(spark):
    from pyspark.sql import functions as F
    path = work_path(spark, "test-store-names")
    rows = _batch(spark, "1", "2", "3").withColumn(store.BATCH_COLUMN, F.concat(F.lit("a/b %ñ="), "id"))
    assert store.append_batches(rows, path) == 3
    assert store.append_batches(rows.filter("id = '2'"), path) == 1
    assert _ids(spark, path) == ["1", "2", "3"]
    assert set(store.live_batches(spark, path)) == {f"a/b %ñ={i}" for i in (1, 2, 3)}


def test_documents_of_any_shape(spark):
    from tonalyze.sources import documents
    lines = [
        '{"id": "1", "texto": "a", "prediccion": "positivo", "probability": [0.5, 0.5], "ts": "2024-01-01T00:00:00"}',
        '{"id": 2, "intencion_predicha": "negativo", "confianza": "0.5", "otro": {"x": [1]}}',
        '{"id": "3", "texto": null, "probability": null}',
        '{"id": "4", "probability": "no"}', '{"id": "5", "confianza": "alta", "ts": "ayer"}',
        '{"id": "6"', '[1, 2]', '"texto"', "", '{"id": "7", "probability": ["0.25", 1]}']
    src, dst, bad = (work_path(spark, n) for n in ("test-docs", "test-docs-store", "test-docs-bad"))
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(src)
    assert store.migrate_store(spark, src, dst, fmt="json", rejected=bad) == (4, 1)
    rows = {r.id: r for r in store.read_store(spark, dst).collect()}
    assert sorted(rows) == ["1", "2", "3", "7"]
    assert rows["1"].ts == T0 and rows["2"].prediccion == "negativo" and rows["7"].probability == [0.25, 1.0]
    assert rows["3"].texto is None
    got = {(r.value, r.motivo) for r in spark.read.schema("value string, motivo string").json(bad).collect()}
    assert got == {(lines[3], "probability"), (lines[4], "ts,confianza"), (lines[5], "json"), (lines[6], "objeto"),
                   (lines[7], "objeto"), (lines[8], "json")}
    # JSON and parquet batches in one store
    store.append_predictions(_batch(spark, "8"), dst, fmt="json", batch_id=1)
    assert _ids(spark, dst) == ["1", "2", "3", "7", "8"]
    assert store.migrate_in_place(spark, dst) == (5, 0)
    assert _ids(spark, dst) == ["1", "2", "3", "7", "8"]
    assert documents.fields("a long, b array<double>") == [("a", "long"), ("b", "array<double>")]
