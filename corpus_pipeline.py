"""The corpus pipeline: five stages over ``documents``, each written as
Parquet and reread as the next one's input.

Every stage works on all that the one before kept, and its decisions take
effect: rejected documents go, one document of each near-duplicate group
stays, repeated lines and benchmark passages are cut out of the texts (a
document without a word left goes), and what remains is packed.  All but the
last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonalyze.llm import decontam, line_dedup, minhash_forest, packing, quality_rules
from tonalyze.llm.common import saved, table


def _with_words(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Texts that were cut: their length anew, and gone if no word is left."""
    kept = docs.filter(F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return docs.filter(quality_rules.is_kept(F.col("text")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id.  Rows
    that repeat an id are one document; the first by text stays.  Rows without
    an id are linked with nothing and all stay."""
    found = minhash_forest.near_duplicates(docs).filter("doc_id is not null").groupBy("doc_id").agg(
        F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    # those that go are the smaller side
    away = saved(found.filter("not kept or rows > 1"), "pipeline-away")
    stay = docs.alias("d").join(away.alias("k"), F.col("d.doc_id") == F.col("k.doc_id"), "left_anti")
    several = away.filter("kept")
    if several.isEmpty():
        return stay
    order = F.struct(F.coalesce("text", F.lit("")), F.xxhash64(*docs.columns))
    rows = docs.alias("d").join(several.alias("k"), F.col("d.doc_id") == F.col("k.doc_id"), "left_semi")
    first = rows.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return stay.unionByName(first)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines and passages seen in an earlier document are cut out."""
    return _with_words(line_dedup.remove_repeats(docs), docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out."""
    # other columns go under numbers, so that none meets an added one
    names = {c: c if c == "text" else f"in_{i}" for i, c in enumerate(docs.columns)}
    found = decontam.decontaminate(docs.select(*[F.col(c).alias(n) for c, n in names.items()]),
                                   table(spark, sf_dir, "benchmark"))
    cut = decontam.remove_spans(found).select(*[F.col(n).alias(c) for c, n in names.items()])
    return _with_words(cut, docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("minhash near-dedup", near_dedup_stage),
    ("line dedup", line_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: Near-duplicates and token ids have no SQL; tests hold each stage against a
#: brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
