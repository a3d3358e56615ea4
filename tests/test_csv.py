"""CSV corpus: values come back as they were."""

from tonalyze.session import work_path
from tonalyze.sources import csv_corpus


def test_every_text_comes_back(spark):
    texts = ["\\N", "\\\\N", "\\", "", None, " a ", 'q"q', "x\ny", "a,b", "\\x"]
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], csv_corpus.CORPUS_SCHEMA)
    path = work_path(spark, "csv-values")
    csv_corpus.write_corpus_csv(df, path, rows_per_file=3)
    got = {r.doc_id: r.texto for r in csv_corpus.read_corpus_csv(spark, path).collect()}
    assert got == dict(enumerate(texts))


def test_plain_labelled_csv(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('texto,etiqueta\nhola,positivo\n"a, ""b""",negativo\n', encoding="utf-8")
    rows = csv_corpus.read_labelled_csv(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("hola", "positivo"), ('a, "b"', "negativo")]
