"""Reads over a literal predictions table."""

import datetime as dt
import json

import pytest

from tonalyze.operators import reports

SCHEMA = ("id long, texto string, prediccion string, intencion_predicha string, "
          "probability array<double>, ts timestamp_ntz, estado string")
T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


@pytest.fixture(scope="module")
def preds(spark):
    rows = [
        (1, "a", "positivo", None, [0.7, 0.2, 0.1], T0, "almacenado"),
        (2, "b", "positivo", None, None, T0, "almacenado"),                 # null probability
        (3, "c", "Negativo", None, [0.1, 0.8, 0.1], T0 + dt.timedelta(minutes=1), "almacenado"),
        (4, "d", "negativo", None, [0.2, 0.6, 0.2], T0 + dt.timedelta(minutes=2), "almacenado"),
        (5, None, None, "neutral", [0.2, 0.2, 0.6], T0 + dt.timedelta(hours=2), "almacenado"),
        (6, "f", "", None, [0.5, 0.25, 0.25], T0 + dt.timedelta(microseconds=1500), "almacenado"),
        (7, "g", None, None, None, None, "almacenado"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_class_stats_null_group_and_mean_ignores_missing(preds):
    got = {r._id: (r.total, r.promedio_confianza) for r in reports.class_stats(preds).collect()}
    assert got["positivo"] == (2, 0.7)       # total counts the row without probability
    assert got[None] == (2, 0.6)             # null is its own group
    assert got[""] == (1, 0.5)
    assert got["Negativo"] == (1, 0.8)


def test_class_summary_fallback_merge_and_case_variants(preds):
    s = reports.class_summary(reports.class_stats(preds)).first()
    assert s.total_analizado == 7
    assert (s.positivos, s.negativos, s.neutrales) == (2, 2, 0)
    assert json.loads(s.distribucion) == {"Negativo": 1, "desconocido": 3, "negativo": 1, "positivo": 2}


def test_class_share_sums_to_one(preds):
    shares = reports.class_share(reports.class_stats(preds)).collect()
    assert abs(sum(r.proporcion for r in shares) - 1) < 1e-5


def test_newest_orders_ties_by_id_and_nulls_last(preds):
    ids = [r.id for r in reports.newest(preds, None).collect()]
    assert ids == [5, 4, 3, 6, 2, 1, 7]
    assert [r.id for r in reports.newest(preds, 2).collect()] == [5, 4]
    assert len(reports.newest(preds, 0).collect()) == 7   # 0 means no limit


def test_latest_predictions_iso_text(preds):
    rows = {r._id: r.timestamp for r in reports.latest_predictions(preds, None).collect()}
    assert rows["1"] == "2024-01-01T12:00:00"
    assert rows["6"] == "2024-01-01T12:00:00.001500"
    assert rows["7"] is None


def test_latest_by_class_filters_first(preds):
    assert [r._id for r in reports.latest_by_class(preds, "positivo", 1).collect()] == ["2"]


def test_format_predictions(preds):
    rows = {r._id: r for r in reports.format_predictions(preds).collect()}
    assert rows["1"].probabilidades == "[0.700, 0.200, 0.100]"
    assert rows["2"].probabilidades == "N/A" and rows["2"].probability is None
    assert rows["5"].sentimiento == "neutral" and rows["5"].texto == ""
    assert rows["6"].sentimiento == "" and rows["6"].css == "sentiment-desconocido"
    assert rows["3"].css == "sentiment-negativo"
    assert rows["1"].fecha == "1/1/2024, 12:00:00"


def test_overview_recent_and_summary(preds):
    o = reports.overview(preds, limit=3).first()
    assert o.recientes == ["5", "4", "3"]
    assert o.total_analizado == 7


def test_class_over_time_hour_windows(preds):
    rows = {(r.inicio, r.clase): r.total for r in reports.class_over_time(preds).collect()}
    assert rows[(T0, "positivo")] == 2
    assert rows[(T0 + dt.timedelta(hours=2), "neutral")] == 1


def test_predictions_json_keeps_nulls(preds):
    docs = {r._id: json.loads(r.json) for r in reports.predictions_json(preds).collect()}
    assert docs["2"]["probability"] is None
    assert docs["1"]["probability"] == [0.7, 0.2, 0.1]
