"""Column functions on literal rows."""

from pyspark.sql import functions as F

from tonalyze.functions import formatting as fmt
from tonalyze.functions import text as tx


def test_numeric_array_casts_or_nulls(spark):
    df = spark.createDataFrame([(["0.5", "abc", None],), (None,)], "p array<string>")
    got = [r[0] for r in df.select(fmt.numeric_array(F.col("p"))).collect()]
    assert got == [[0.5, None, None], None]


def test_probability_text(spark):
    df = spark.createDataFrame([([0.6666666, 0.25, 0.0833334],), (None,)], "p array<double>")
    assert [r[0] for r in df.select(fmt.probability_text(F.col("p"))).collect()] == \
        ["[0.667, 0.250, 0.083]", "N/A"]


def test_strip_special_keeps_letters_digits_spaces(spark):
    df = spark.createDataFrame([("¡Hola, Señor! Año 2024 — ok?\tsí",)], "t string")
    assert df.select(tx.strip_special(F.col("t"))).first()[0] == "hola señor año 2024  ok\tsí"


def test_strip_ws_matches_python_strip(spark):
    samples = ["  a b  ", " x　", "\t\n y \x0b", " z ", "plain"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    assert [r[0] for r in df.select(tx.strip_ws(F.col("t"))).collect()] == [s.strip() for s in samples]


def test_display_class_fallbacks(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), (None, ""), (None, None)], "p string, i string")
    got = [r[0] for r in df.select(tx.display_class(F.col("p"), F.col("i"))).collect()]
    assert got == ["a", "b", "desconocido", "desconocido"]
