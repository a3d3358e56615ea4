"""Reads over the predictions table: newest N, per-class statistics, summaries.

Scale notes
-----------
* Per-class aggregates group on a handful of keys, so one class can hold a
  third of all rows.  Every aggregate used (count, sum, avg) is algebraic:
  Spark pre-aggregates in each map task (partial HashAggregate) and only a
  few rows per task cross the shuffle.
* Newest-N is ``orderBy(..).limit(n)``: Catalyst plans
  ``TakeOrderedAndProject`` (a bounded top-n per task, then a merge of
  n rows per task) instead of a global sort.
* The summary steps after grouping work on at most one row per class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonalyze.functions import formatting as fmt
from tonalyze.functions import text as tx
from tonalyze.fixed import CLASS_NEGATIVE, CLASS_NEUTRAL, CLASS_POSITIVE

from tonalyze.fixed import HISTORY_LIMIT, OVERVIEW_LIMIT, PANEL_LIMIT  # noqa: F401


def _limit(df: DataFrame, limit: int | None) -> DataFrame:
    # The document store reads 0 as "no limit"; Spark's limit(0) is "no rows".
    return df if not limit else df.limit(int(limit))


def newest(preds: DataFrame, limit: int | None = HISTORY_LIMIT,
           ts_col: str = "ts", id_col: str = "id") -> DataFrame:
    """Newest first; equal timestamps ordered by id (descending); nulls last."""
    ordered = preds.orderBy(F.col(ts_col).desc_nulls_last(), F.col(id_col).desc())
    return _limit(ordered, limit)


def newest_rows(preds: DataFrame, limit: int | None = HISTORY_LIMIT,
                wide: tuple[str, ...] = ("texto",), id_col: str = "id") -> DataFrame:
    """Newest-n rows with every column, reading the wide columns for n rows only.

    The ranking reads the narrow columns only (the text is pruned from its
    scan) and leaves n (time, id) pairs; a semi-join with them, planned by
    Spark from their size, reads the rest.  Ranking the joined rows again
    gives exactly the one-step result.  Nothing passes through the driver.
    """
    if not limit or not any(c in preds.columns for c in wide):
        return newest(preds, limit, id_col=id_col)
    top = newest(preds.select("ts", id_col), limit, id_col=id_col).select(
        F.col("ts").alias("_ts"), F.col(id_col).alias("_id_")).distinct()
    match = F.col("ts").eqNullSafe(F.col("_ts")) & F.col(id_col).eqNullSafe(F.col("_id_"))
    return newest(preds.join(top, match, "left_semi"), limit, id_col=id_col)


LEGACY_FIELDS = ("intencion_predicha", "confianza")


def history_record(preds: DataFrame) -> DataFrame:
    """History document: the stored fields as they are (legacy fields
    included where the table has them), id as text, ISO timestamp text."""
    legacy = [c for c in LEGACY_FIELDS if c in preds.columns]
    return preds.select(
        F.col("id").cast("string").alias("_id"),
        "texto", "prediccion", *legacy, "probability",
        fmt.iso_timestamp(F.col("ts")).alias("timestamp"),
        "estado",
    )


def latest_predictions(preds: DataFrame, limit: int | None = HISTORY_LIMIT) -> DataFrame:
    """History read, newest first."""
    return history_record(newest_rows(preds, limit))


def latest_by_class(preds: DataFrame, clase: str, limit: int | None = HISTORY_LIMIT) -> DataFrame:
    """History filtered to one class; the filter runs before the top-n."""
    return latest_predictions(preds.filter(F.col("prediccion") == F.lit(clase)), limit)


def class_stats(preds: DataFrame, ordered: bool = True) -> DataFrame:
    """Rows and mean confidence (max of the probability vector) per class.

    Null is a group of its own.  Rows without a probability vector count in
    ``total`` and are left out of the mean.  ``ordered`` sorts by total
    (descending) for display; callers that aggregate further skip it.
    """
    stats = (preds.groupBy(F.col("prediccion").alias("_id"))
             .agg(F.count(F.lit(1)).alias("total"),
                  F.round(F.avg(F.array_max("probability")), 6).alias("promedio_confianza")))
    if ordered:
        stats = stats.orderBy(F.col("total").desc(), F.col("_id").asc_nulls_last())
    return stats


def _merged_counts(stats: DataFrame) -> DataFrame:
    """Statistics keyed after the ``desconocido`` fallback; variants merged."""
    return (stats.select(tx.class_key(F.col("_id")).alias("clase"),
                         F.coalesce(F.col("total"), F.lit(0)).alias("total"))
            .groupBy("clase").agg(F.sum("total").alias("total")))


def _summary_row(merged: DataFrame) -> DataFrame:
    low = F.lower(F.col("clase"))

    def pick(name: str):
        return F.sum(F.when(low == name, F.col("total")).otherwise(0))

    return merged.agg(
        F.sum("total").alias("total_analizado"),
        pick(CLASS_POSITIVE).alias("positivos"),
        pick(CLASS_NEGATIVE).alias("negativos"),
        pick(CLASS_NEUTRAL).alias("neutrales"),
        F.to_json(F.map_from_entries(F.array_sort(
            F.collect_list(F.struct(F.col("clase"), F.col("total")))))).alias("distribucion"),
    )


def class_summary(stats: DataFrame) -> DataFrame:
    """One summary row from the statistics rows: totals per fixed class.

    Case variants of a class are summed (the client kept the last one seen).
    ``distribucion`` is the class -> count map as JSON with sorted keys.
    """
    return _summary_row(_merged_counts(stats))


def class_share(stats: DataFrame) -> DataFrame:
    """Share of each class in all predictions (pie-chart data)."""
    merged = _merged_counts(stats)
    # one row per class reaches the window: a handful
    grand = F.sum("total").over(Window.partitionBy(F.lit(0)))
    return merged.select("clase", "total", F.round(F.col("total") / grand, 6).alias("proporcion"))


def class_over_time(preds: DataFrame, every: str = "1 hour") -> DataFrame:
    """Predictions per class per time window (line-chart data)."""
    clase = tx.display_class(F.col("prediccion"), F.col("intencion_predicha"))
    return (preds.groupBy(F.window("ts", every).alias("w"), clase.alias("clase"))
            .agg(F.count(F.lit(1)).alias("total"))
            .select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fin"),
                    "clase", "total"))


def format_predictions(preds: DataFrame) -> DataFrame:
    """Display record of each stored prediction (history list entries)."""
    shown = tx.display_class(F.col("prediccion"), F.col("intencion_predicha"))
    return preds.select(
        F.col("id").cast("string").alias("_id"),
        F.coalesce(F.col("texto"), F.lit("")).alias("texto"),
        tx.display_class(F.col("prediccion"), F.col("intencion_predicha"), "").alias("sentimiento"),
        fmt.spanish_datetime(F.col("ts")).alias("fecha"),
        fmt.numeric_array(F.col("probability")).alias("probability"),
        fmt.probability_text(F.col("probability")).alias("probabilidades"),
        tx.css_class(shown).alias("css"),
    )


def predictions_json(preds: DataFrame, limit: int | None = None) -> DataFrame:
    """History documents as JSON text, one per prediction (null fields kept).

    With a limit: the newest ``limit`` documents.  Without one this is the
    bulk export of the whole table, map-only: no global sort of the table.
    """
    docs = latest_predictions(preds, limit) if limit else history_record(preds)
    return docs.select(
        "_id",
        F.to_json(F.struct(*[F.col(c) for c in docs.columns]),
                  {"ignoreNullFields": "false"}).alias("json"))


def overview(preds: DataFrame, limit: int = OVERVIEW_LIMIT) -> DataFrame:
    """Recent records and ids (newest first), the statistics rows and the
    class summary, as one row.

    All parts are bounded before they meet: the top-n holds ``limit`` rows
    and the statistics one row per class, from which the summary is made too.
    """
    newest_first = F.sort_array(F.collect_list(F.struct(
        F.col("ts").alias("ts"), F.col("id").alias("id"),
        F.to_json(F.struct("_id", "texto", "prediccion", "timestamp")).alias("doc"))), asc=False)
    rows = newest_rows(preds, limit)
    recent = (rows.select("ts", "id", F.col("id").cast("string").alias("_id"), "texto", "prediccion",
                          fmt.iso_timestamp(F.col("ts")).alias("timestamp"))
              .agg(newest_first.alias("r"))
              .select(F.transform("r", lambda x: x["id"].cast("string")).alias("recientes"),
                      F.transform("r", lambda x: x["doc"]).alias("documentos")))
    stats = class_stats(preds, ordered=False)
    listed = F.array_sort(F.collect_list(F.struct(
        (-F.col("total")).alias("o"), F.coalesce("_id", F.lit("\uffff")).alias("k"),
        F.to_json(F.struct("_id", "total", "promedio_confianza"), {"ignoreNullFields": "false"}).alias("doc"))))
    per_class = stats.agg(F.transform(listed, lambda x: x["doc"]).alias("estadisticas"))
    both = (recent.unionByName(class_summary(stats), allowMissingColumns=True)
            .unionByName(per_class, allowMissingColumns=True))
    return both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
