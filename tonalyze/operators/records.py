"""Delimited text records: clean, encode, parse, preview, reject empty.

Wire format: ``<text>|||<label>`` on one line.  All steps are projections or
filters (narrow, no shuffle) made of built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalyze.fixed import PREVIEW_CHARS
from tonalyze.functions import text as tx


def clean_records(df: DataFrame, text_col: str = "texto", label_col: str = "etiqueta") -> DataFrame:
    """Rows with both fields; text on one line, both fields stripped."""
    return (df.filter(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
            .withColumn(text_col, tx.strip_ws(tx.one_line(F.col(text_col))))
            .withColumn(label_col, tx.strip_ws(F.col(label_col))))


def encode_records(df: DataFrame, text_col: str = "texto", label_col: str = "etiqueta",
                   out_col: str = "value") -> DataFrame:
    """One wire line per record (other columns are kept)."""
    line = F.concat(F.col(text_col), F.lit(tx.RECORD_DELIMITER), F.col(label_col))
    return df.withColumn(out_col, line)


def parse_records(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Split a wire line into ``texto`` and ``etiqueta_real``.

    The split is computed once.  ``get`` returns null past the end, so a
    line without a delimiter keeps its text and gets a null label instead
    of failing the job under ANSI mode; parts after the second are dropped.
    """
    keep = [c for c in df.columns if c != value_col]
    parts = F.split(F.col(value_col), tx.RECORD_DELIMITER_REGEX)
    return df.select(*keep, parts.alias("_parts")).select(
        *keep,
        F.get(F.col("_parts"), 0).alias("texto"),
        F.get(F.col("_parts"), 1).alias("etiqueta_real"),
    )


def has_fields(value_col: str = "value", n: int = 2):
    """Line carries at least ``n`` delimited fields."""
    return F.size(F.split(F.col(value_col), tx.RECORD_DELIMITER_REGEX)) >= n


def text_preview(df: DataFrame, text_col: str = "texto", chars: int = PREVIEW_CHARS) -> DataFrame:
    return df.withColumn("preview", F.substring(F.col(text_col), 1, chars))


def reject_empty(df: DataFrame, text_col: str = "texto") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): blank or null texts go to the side output."""
    blank = tx.is_blank(F.col(text_col))
    return df.filter(~blank), df.filter(blank)
