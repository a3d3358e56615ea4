"""Schemaless documents: JSON lines read under one declared schema.

A document store promises nothing about its documents: a field may be
missing, hold another type, or belong to an older schema, and a line may be
broken.  Each line is parsed once into a variant; every declared field is
taken out of it as its declared type if it converts (a number stored as text,
an id stored as a number).  A missing field or a JSON null is null.  A line
that is no JSON object, or that holds a declared field of a type that does not
convert, goes to the side output with the reason, not into the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROKEN, NO_OBJECT = "json", "objeto"


def fields(schema: str) -> list[tuple[str, str]]:
    """(name, type) of a flat schema string."""
    return [tuple(f.strip().split(" ", 1)) for f in schema.split(", ")]


def encode_documents(rows: DataFrame) -> DataFrame:
    """One JSON line (``value``) per row; null fields are left out."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def parse_documents(lines: DataFrame, schema: str) -> DataFrame:
    """The declared fields of each line, with the columns of ``lines`` (the line
    itself is ``value``) and ``motivo``: null, or why the line is rejected (``json``, ``objeto`` or the
    names of the fields of a wrong type)."""
    parsed = lines.withColumn("_v", F.try_parse_json("value"))

    def held(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "variant")

    typed = parsed.select(*lines.columns, "_v", *[F.try_variant_get("_v", f"$.{n}", t).alias(n) for n, t in fields(schema)])
    wrong = F.concat_ws(",", *[
        F.when(held(n).isNotNull() & ~F.is_variant_null(held(n)) & F.col(n).isNull(), F.lit(n))
        for n, _ in fields(schema)])
    reason = (F.when(F.col("_v").isNull(), BROKEN)
              .when(~F.schema_of_variant("_v").startswith("OBJECT"), NO_OBJECT)
              .when(wrong != "", wrong))
    return typed.withColumn("motivo", reason).drop("_v")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("motivo").isNull()).drop("motivo", "value")


def rejected(parsed: DataFrame) -> DataFrame:
    """Side output: the lines as they are, and why."""
    return parsed.filter(F.col("motivo").isNotNull()).select("value", "motivo")
