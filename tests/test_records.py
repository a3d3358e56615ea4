"""Wire records: cleaning, encoding, parsing, preview, empty-text rejection."""

from tonalyze.operators import records


def test_parse_edge_lines(spark):
    lines = spark.createDataFrame(
        [("hola mundo|||positivo",), ("nodelim",), ("",), ("a|||b|||c",), ("tail |||||neutral",)],
        "value string")
    got = [tuple(r) for r in records.parse_records(lines).collect()]
    assert got == [
        ("hola mundo", "positivo"),
        ("nodelim", None),          # no failure under ANSI mode, label null
        ("", None),                 # blank line
        ("a", "b"),                 # third part dropped
        ("tail ", "||neutral"),     # leftmost delimiter wins
    ]


def test_has_fields(spark):
    lines = spark.createDataFrame([("x|||y",), ("x",)], "value string")
    assert [r[0] for r in lines.select(records.has_fields()).collect()] == [True, False]


def test_clean_then_encode(spark):
    rows = spark.createDataFrame(
        [(1, "  line one\nline two \t", " positivo "), (2, None, "x"), (3, "t", None),
         (4, "a\r\nb ", "neutral")],
        "doc_id long, texto string, etiqueta string")
    cleaned = records.clean_records(rows)
    got = {r.doc_id: (r.texto, r.etiqueta) for r in cleaned.collect()}
    assert got == {1: ("line one line two", "positivo"), 4: ("a  b", "neutral")}
    enc = {r.doc_id: r.value for r in records.encode_records(cleaned).collect()}
    assert enc[1] == "line one line two|||positivo"


def test_encode_parse_roundtrip(spark):
    rows = spark.createDataFrame([(1, "texto con, coma", "negativo")],
                                 "doc_id long, texto string, etiqueta string")
    back = records.parse_records(records.encode_records(rows).select("doc_id", "value")).collect()
    assert (back[0].texto, back[0].etiqueta_real) == ("texto con, coma", "negativo")


def test_preview_counts_characters(spark):
    text = "é" * 60
    df = spark.createDataFrame([(text,)], "texto string")
    assert records.text_preview(df).first().preview == "é" * 50


def test_reject_empty_side_output(spark):
    df = spark.createDataFrame([(1, "ok"), (2, ""), (3, None), (4, "   "), (5, " \t")],
                               "id long, texto string")
    accepted, rejected = records.reject_empty(df)
    assert sorted(r.id for r in accepted.collect()) == [1]
    assert sorted(r.id for r in rejected.collect()) == [2, 3, 4, 5]


def test_csv_roundtrip_keeps_multiline_quotes_and_edges(spark):
    from tonalyze.session import work_path
    from tonalyze.sources import csv_corpus

    rows = [(1, 'dice "hola",\nadiós ', "positivo"), (2, "  espacios  ", "neutral"), (3, "", "negativo")]
    df = spark.createDataFrame(rows, csv_corpus.CORPUS_SCHEMA)
    path = work_path(spark, "test-corpus")
    csv_corpus.write_corpus_csv(df, path)
    back = sorted(tuple(r) for r in csv_corpus.read_corpus_csv(spark, path).collect())
    assert back == rows
