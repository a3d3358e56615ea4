"""Readers for the given parquet tables and the tables Spark derives from them.

Everything here is lazy: callers select only the columns they need, so the
parquet scans read just those columns (``ReadSchema``) and filters reach the
scan (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonalyze.fixed import CLASS_NEGATIVE, CLASS_NEUTRAL, CLASS_POSITIVE, STORED_STATE  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


TEXT_PARTITIONS = "tonalyze.text.partitions"


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out over as many tasks as the caller set in
    ``tonalyze.text.partitions``; unset (the default) the scan is returned as
    it is, so no text is shuffled.

    Text stages are CPU-bound per row, and a file of one row group is read by
    one task however many there are.  A table written with enough row groups
    (``spark.sql.files.maxPartitionBytes`` then cuts it) needs no setting.
    """
    n = df.sparkSession.conf.get(TEXT_PARTITIONS, None)
    return df if df.isStreaming or not n else df.repartition(int(n))


def class_of(toxic: Column, quality: Column) -> Column:
    """Three-class label of a labelled document."""
    return (F.when(toxic == 1, F.lit(CLASS_NEGATIVE))
            .when(quality == 1, F.lit(CLASS_POSITIVE))
            .otherwise(F.lit(CLASS_NEUTRAL)))


def labelled_corpus(spark: SparkSession, sf_dir: str, spread_rows: bool = True,
                    extra_cols: tuple[str, ...] = ()) -> DataFrame:
    """``documents JOIN labels``: (doc_id, texto, etiqueta, *extra_cols).

    Equi-join on doc_id with no hint: AQE turns it into a broadcast join only
    when the runtime size of ``labels`` is under Spark's checked threshold,
    otherwise it stays a sort-merge join on doc_id.
    """
    docs = table(spark, sf_dir, "documents")
    return corpus_of(spread(docs) if spread_rows else docs, table(spark, sf_dir, "labels"), extra_cols)


def corpus_of(documents_df: DataFrame, labels_df: DataFrame,
              extra_cols: tuple[str, ...] = ()) -> DataFrame:
    """The labelled corpus from any two frames shaped like the given tables
    (for example bucketed catalog copies, see ``sources.bucketed``)."""
    docs = documents_df.select("doc_id", F.col("text").alias("texto"), *extra_cols)
    labels = labels_df.select("doc_id", class_of(F.col("toxic"), F.col("quality")).alias("etiqueta"))
    return docs.join(labels, "doc_id", "inner")


def documents(spark: SparkSession, sf_dir: str, spread_rows: bool = True) -> DataFrame:
    """Texts to score: (doc_id, texto).  ``spread_rows`` for CPU-heavy text stages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("texto"))
    return spread(docs) if spread_rows else docs


def stored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions store in its mixed (pre-migration) state.

    Deterministic rule over ``documents JOIN labels`` (FIXTURES.md), with
    the whole text kept:

    * every 11th id is a legacy row: class in ``intencion_predicha``,
      ``confianza`` 0.5, ``prediccion`` null;
    * every 7th id has no probability vector;
    * ``ts`` advances one minute per three ids, so timestamps tie.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    k = F.col("doc_id") % 10
    cls = class_of(F.col("toxic"), F.col("quality"))
    legacy = (F.col("doc_id") % 11) == 0
    probability = F.array(
        (40 + 5 * k).cast("double") / 100,
        (35 - 3 * k).cast("double") / 100,
        (25 - 2 * k).cast("double") / 100,
    )
    return docs.join(labels, "doc_id", "inner").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("texto"),
        F.when(legacy, F.lit(None).cast("string")).otherwise(cls).alias("prediccion"),
        F.when(legacy, cls).otherwise(F.lit(None).cast("string")).alias("intencion_predicha"),
        F.when(legacy, F.lit(0.5)).otherwise(F.lit(None).cast("double")).alias("confianza"),
        F.when((F.col("doc_id") % 7) == 0, F.lit(None).cast("array<double>"))
         .otherwise(probability).alias("probability"),
        F.expr("timestampadd(MINUTE, CAST(doc_id DIV 3 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')")
         .alias("ts"),
        F.lit(STORED_STATE).alias("estado"),
    )
