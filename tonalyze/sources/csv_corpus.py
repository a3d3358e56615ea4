"""Labelled corpus as CSV with a header, RFC-4180 quoting.

Texts hold line breaks, quotes and commas.  Spark's CSV defaults would tear
a quoted multi-line field in two and trim edge whitespace on write, so the
writer and reader here set quoting, escaping, multi-line parsing and
whitespace handling explicitly, and the schema is fixed (no inference pass).
Multi-line files are not splittable: each file is one task, so the writer
keeps the input's partitioning (many files) rather than coalescing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORPUS_SCHEMA = "doc_id long, texto string, etiqueta string"

_CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
    # Null as \N so that an empty text ("" on disk) reads back as '' and a
    # missing one as null; with the default both read back as null.
    "nullValue": "\\N",
}
# Rows per file: a multi-line file is one task.
ROWS_PER_FILE = 200_000


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]


def write_corpus_csv(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """A text that begins with a backslash gets a second one, so that no text
    looks like the null marker."""
    marked = {c: F.when(F.col(c).startswith("\\"), F.concat(F.lit("\\"), F.col(c))).otherwise(F.col(c))
              for c in _strings(df)}
    (df.withColumns(marked).write.mode("overwrite").options(**_CSV_OPTIONS, quoteAll="false")
       .option("maxRecordsPerFile", str(rows_per_file)).csv(path))


def read_corpus_csv(spark: SparkSession, path: str, schema: str = CORPUS_SCHEMA) -> DataFrame:
    """What ``write_corpus_csv`` wrote."""
    raw = spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)
    return raw.withColumns({
        c: F.when(F.col(c).startswith("\\\\"), F.substring(F.col(c), F.lit(2), F.length(c))).otherwise(F.col(c))
        for c in _strings(raw)})


def read_labelled_csv(spark: SparkSession, path: str, text_col: str = "texto",
                      label_col: str = "etiqueta") -> DataFrame:
    """(texto, etiqueta) of a plain CSV with a header, columns found by name."""
    plain = {k: v for k, v in _CSV_OPTIONS.items() if k != "nullValue"}
    return spark.read.options(**plain).csv(path).select(
        F.col(text_col).alias("texto"), F.col(label_col).alias("etiqueta"))
