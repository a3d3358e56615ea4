"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the given tables (or tables Spark derives from them) in
full.  Queries that write (CSV copy, store, stream sink, saved model) do so
under a fresh folder below the session's checkpoint directory and return a
frame read back from what they wrote.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonalyze.functions import text as tx
from tonalyze.operators import classifier as clf
from tonalyze.operators import records, reports, store
from tonalyze.session import work_path
from tonalyze.sources import csv_corpus
from tonalyze.sources import tables as T
from tonalyze.streaming import scoring as stream

QueryFn = Callable[[SparkSession, str], DataFrame]

_MODELS: OrderedDict[tuple, PipelineModel] = OrderedDict()
_MODELS_KEPT = 4


def _version(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = ("documents", "labels")) -> tuple:
    """Files, sizes and change times of the tables, as one number: a rewritten
    table has another.  A listing of the files; none is opened."""
    files = spark.read.format("binaryFile").load([f"{sf_dir.rstrip('/')}/{name}.parquet" for name in names])
    listed = files.select("path", "length", "modificationTime")
    return tuple(listed.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*listed.columns).cast("decimal(38,0)"))).first())


def trained_model(spark: SparkSession, sf_dir: str,
                  params: clf.ClassifierParams = clf.ClassifierParams(),
                  reuse: bool = True) -> PipelineModel:
    """Model fitted on the labelled corpus; fitted once per session and state
    of the tables, the last few kept."""
    sc = spark.sparkContext
    key = (sc.applicationId, sc.startTime, sf_dir.rstrip("/"), _version(spark, sf_dir), params)
    if not reuse or key not in _MODELS:
        _MODELS[key] = clf.train(T.labelled_corpus(spark, sf_dir), params)
    _MODELS.move_to_end(key)
    while len(_MODELS) > _MODELS_KEPT:
        _MODELS.popitem(last=False)
    return _MODELS[key]


def clear_model_cache() -> None:
    _MODELS.clear()


# -- step 1 ---------------------------------------------------------------

def csv_corpus_scan(spark, sf_dir):
    path = work_path(spark, "corpus-csv")
    csv_corpus.write_corpus_csv(T.labelled_corpus(spark, sf_dir), path)
    return csv_corpus.read_corpus_csv(spark, path)


def lower_text(spark, sf_dir):
    return T.labelled_corpus(spark, sf_dir, spread_rows=False).withColumn("texto", F.lower("texto"))


# -- step 2 ---------------------------------------------------------------

def class_stats(spark, sf_dir):
    return reports.class_stats(T.stored_predictions(spark, sf_dir))


def class_summary(spark, sf_dir):
    return reports.class_summary(reports.class_stats(T.stored_predictions(spark, sf_dir), ordered=False))


def latest_predictions(spark, sf_dir):
    return reports.latest_predictions(T.stored_predictions(spark, sf_dir), reports.HISTORY_LIMIT)


def format_predictions(spark, sf_dir):
    return reports.format_predictions(T.stored_predictions(spark, sf_dir))


def overview(spark, sf_dir):
    return reports.overview(T.stored_predictions(spark, sf_dir))


def predictions_json(spark, sf_dir):
    return reports.predictions_json(T.stored_predictions(spark, sf_dir))


# -- step 3 ---------------------------------------------------------------

def _cleaned(spark, sf_dir, extra_cols: tuple[str, ...] = ()):
    return records.clean_records(T.labelled_corpus(spark, sf_dir, extra_cols=extra_cols))


def clean_records(spark, sf_dir):
    """Raw lines: the documents' own lines and the corpus records, of which
    those with both fields are parsed and cleaned."""
    records_ = records.encode_records(_cleaned(spark, sf_dir)).select("doc_id", "value")
    bare = T.documents(spark, sf_dir).select("doc_id", F.explode(F.split("texto", "\n")).alias("value"))
    lines = records_.unionByName(bare).filter(records.has_fields("value"))
    parsed = records.parse_records(lines).withColumnRenamed("etiqueta_real", "etiqueta")
    return records.clean_records(parsed).select("doc_id", "texto", "etiqueta")


def encode_records(spark, sf_dir):
    return records.encode_records(_cleaned(spark, sf_dir)).select("doc_id", "value")


def parse_records(spark, sf_dir):
    encoded = records.encode_records(_cleaned(spark, sf_dir)).select("doc_id", "value")
    return records.parse_records(encoded)


def text_preview(spark, sf_dir):
    return records.text_preview(T.documents(spark, sf_dir, spread_rows=False)).select("doc_id", "preview")


def reject_empty(spark, sf_dir):
    conv = T.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("texto"))
    accepted, rejected = records.reject_empty(conv)
    return (accepted.select("conv_id", "turn", F.lit(True).alias("aceptado"))
            .unionByName(rejected.select("conv_id", "turn", F.lit(False).alias("aceptado"))))


# -- step 4 ---------------------------------------------------------------

def migrate_predictions(spark, sf_dir):
    return store.migrate_predictions(T.stored_predictions(spark, sf_dir))


def migration_counts(spark, sf_dir):
    """Write the legacy store, migrate it to a new table, report the counts."""
    src, dst = work_path(spark, "legacy-store"), work_path(spark, "migrated-store")
    T.stored_predictions(spark, sf_dir).write.parquet(src)
    matched, modified = store.migrate_store(spark, src, dst)
    return spark.createDataFrame([(matched, modified)], "matched_count long, modified_count long")


def store_predictions(spark, sf_dir):
    model = trained_model(spark, sf_dir)
    scored = clf.score(model, T.documents(spark, sf_dir), keep=["doc_id", "texto"])
    path = work_path(spark, "store")
    # one request batch, keyed so that a retry replaces instead of duplicating
    store.append_predictions(store.enrich_for_store(scored, id_col="doc_id"), path, batch_id=0)
    saved = store.read_store(spark, path)
    # A row read back from the store was stored: the request's "stored" flag.
    return clf.rounded(saved.select(
        "id", "texto", "prediccion", "probability", "estado",
        F.col("ts").isNotNull().alias("con_fecha"), F.col("id").isNotNull().alias("stored")))


def clear_predictions(spark, sf_dir):
    path = work_path(spark, "store")
    preds = T.stored_predictions(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    # batches with and without an id, one of them sent twice
    odd = F.col("id").cast("long") % 2 == 1
    store.append_predictions(preds.filter(odd), path)
    store.append_predictions(preds.filter(~odd), path, batch_id=0)
    store.append_predictions(preds.filter(~odd), path, batch_id=0)
    deleted = store.clear_predictions(spark, path)
    remaining = store.read_store(spark, path).count()
    return spark.createDataFrame([(deleted, remaining)], "deleted_count long, remaining_count long")


def _document_lines(spark, sf_dir):
    """Stored predictions as a document store holds them: null fields missing,
    legacy and newer rows, and by the id's remainders an id stored as a number
    (13), a probability that is a text (17), a line that breaks off (19)."""
    k = F.col("id")
    rows = T.stored_predictions(spark, sf_dir)
    text = rows.withColumn("id", k.cast("string"))
    line = F.to_json(F.struct(*rows.columns))
    numbered = rows.select("id", line.alias("value"))
    worded = text.withColumn("probability", F.lit("no disponible")).select(k.cast("long").alias("id"), line.alias("value"))
    plain = text.select(k.cast("long").alias("id"), line.alias("value"))
    broken = plain.withColumn("value", F.expr("substring(value, 1, length(value) - 1)"))
    of = {19: broken, 17: worded, 13: numbered}
    rest, parts = F.lit(True), []
    for n, made in of.items():
        parts.append(made.filter(rest & (F.col("id") % n == 0)))
        rest = rest & (F.col("id") % n != 0)
    out = plain.filter(rest)
    for part in parts:
        out = out.unionByName(part)
    return out.select("value")


def _document_store(spark, sf_dir) -> tuple[str, str]:
    """(store, rejected lines): documents migrated into a store, then a JSON
    batch that is sent twice, then a migration in place."""
    src, path, bad = (work_path(spark, n) for n in ("documents-json", "document-store", "documents-rejected"))
    _document_lines(spark, sf_dir).write.text(src)
    store.migrate_store(spark, src, path, fmt="json", rejected=bad)
    fresh = T.stored_predictions(spark, sf_dir).filter("prediccion is not null and id % 5 = 0").withColumn(
        "id", F.concat(F.lit("n-"), F.col("id").cast("string")))
    for _ in range(2):
        store.append_predictions(fresh, path, fmt="json", batch_id=1)
    store.migrate_in_place(spark, path)
    return path, bad


def document_store(spark, sf_dir):
    return store.read_store(spark, _document_store(spark, sf_dir)[0])


def document_rejects(spark, sf_dir):
    """Lines that are no documents: the reason, and the id if it can be read."""
    lines = spark.read.schema("value string, motivo string").json(_document_store(spark, sf_dir)[1])
    ident = F.try_variant_get(F.try_parse_json("value"), "$.id", "string")
    return lines.select(ident.alias("id"), "motivo")


def _streamed_batch(spark, sf_dir) -> DataFrame:
    """What the stream path writes, computed as a batch over the same lines."""
    lines = records.encode_records(_cleaned(spark, sf_dir)).select("value")
    return stream.score_lines(trained_model(spark, sf_dir), lines)


def unified_predictions(spark, sf_dir):
    stored = T.stored_predictions(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    streamed = clf.rounded(_streamed_batch(spark, sf_dir)).withColumnRenamed(
        "prediccion", "intencion_predicha")
    both = store.unified_predictions(stored, streamed)
    return both.select("id", "texto", "prediccion", "intencion_predicha", "probability",
                       "estado", "etiqueta_real", F.col("ts").isNotNull().alias("con_fecha"))


# -- step 5 ---------------------------------------------------------------

def label_index(spark, sf_dir):
    corpus = T.labelled_corpus(spark, sf_dir, spread_rows=False)
    return clf.label_indexer(corpus).transform(corpus).select("doc_id", "etiqueta", "label")


def tokens(spark, sf_dir):
    return clf.tokenize(T.documents(spark, sf_dir)).select("doc_id", clf.TOKENS)


def tokens_no_stop(spark, sf_dir):
    return clf.tokenize(T.documents(spark, sf_dir)).select("doc_id", clf.CLEAN_TOKENS)


def term_counts(spark, sf_dir):
    params = clf.ClassifierParams()
    corpus_tokens = clf.tokenize(T.labelled_corpus(spark, sf_dir), params)
    terms = clf.vocabulary_terms(clf.vocabulary(corpus_tokens, params.vocab_size, params.min_df))
    return clf.term_counts(corpus_tokens, terms)


def idf_weights(spark, sf_dir):
    corpus = T.labelled_corpus(spark, sf_dir)
    n_docs = T.labelled_corpus(spark, sf_dir, spread_rows=False).count()
    top = clf.top_terms(clf.term_totals(clf.tokenize(corpus)), clf.ClassifierParams().vocab_size)
    return clf.idf_table(top, n_docs).withColumn("idf", F.round("idf", 6))


# -- step 6 ---------------------------------------------------------------

def nb_model_params(spark, sf_dir):
    """All parameters from one aggregate over (class, term): the corpus is
    tokenised once."""
    classes = T.labelled_corpus(spark, sf_dir, spread_rows=False).groupBy("etiqueta").agg(F.count(F.lit(1)).alias("n"))
    names = {r["etiqueta"]: r["n"] for r in classes.collect()}
    path = work_path(spark, "term-totals")
    clf.term_totals(clf.tokenize(T.labelled_corpus(spark, sf_dir)), "etiqueta").write.parquet(path)
    by_class = spark.read.parquet(path).withColumnRenamed("etiqueta", "clase")
    totals = by_class.groupBy("term").agg(F.sum("total").alias("total"), F.sum("doc_freq").alias("doc_freq"))
    idf = clf.idf_table(clf.top_terms(totals, clf.ClassifierParams().vocab_size), sum(names.values()))
    return clf.nb_params_table(by_class, idf, names).withColumn("valor", F.round("valor", 6))


def score_corpus(spark, sf_dir):
    model = trained_model(spark, sf_dir)
    record = clf.scoring_record(clf.score(model, T.documents(spark, sf_dir), keep=["doc_id", "texto"]))
    # the time itself differs from run to run
    return clf.rounded(record).withColumn("con_fecha", F.col("ts").isNotNull()).drop("ts")


def scored_class_stats(spark, sf_dir):
    """Flagship: score every document, then count and mean confidence per class."""
    model = trained_model(spark, sf_dir)
    scored = clf.score(model, T.documents(spark, sf_dir), keep=["doc_id"])
    return (scored.groupBy("prediccion")
            .agg(F.count(F.lit(1)).alias("total"),
                 F.round(F.avg("confianza"), 6).alias("promedio_confianza")))


def score_examples(spark, sf_dir):
    model = trained_model(spark, sf_dir)
    conv = T.spread(T.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("text").alias("texto")))
    return clf.rounded(clf.score(model, conv, keep=["conv_id", "turn"]))


def model_roundtrip(spark, sf_dir):
    path = work_path(spark, "model")
    trained_model(spark, sf_dir).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    bench = T.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("texto"))
    return clf.rounded(clf.score(loaded, bench, keep=["item_id"]))


def score_corpus_hashed(spark, sf_dir):
    model = trained_model(spark, sf_dir, clf.ClassifierParams(hashed=True))
    return clf.rounded(clf.score(model, T.documents(spark, sf_dir), keep=["doc_id"]))


# -- step 7 ---------------------------------------------------------------

def _stream_output(spark, path) -> DataFrame:
    return clf.rounded(spark.read.parquet(path).select(
        "texto", "etiqueta_real", "prediccion", "confianza", "probability"))


def stream_score(spark, sf_dir):
    source, sink, ckpt = (work_path(spark, n) for n in ("stream-src", "stream-sink", "stream-ckpt"))
    stream.write_lines(records.encode_records(_cleaned(spark, sf_dir)), source)
    scored = stream.score_lines(trained_model(spark, sf_dir), stream.text_source(spark, source))
    stream.run_available(scored, sink, ckpt)
    return _stream_output(spark, sink)


def stream_store(spark, sf_dir):
    """Two arrivals of a parquet folder, streamed straight into the predictions
    store, beside a request batch that is cleared in between: each streamed
    line once."""
    source, path, ckpt = (work_path(spark, n) for n in ("store-src", "stream-store", "store-ckpt"))
    model = trained_model(spark, sf_dir)
    lines = records.encode_records(_cleaned(spark, sf_dir, extra_cols=("lang",)))
    first = F.coalesce(F.col("lang").isin("en", "es"), F.lit(False))

    def arrive(rows):
        rows.select("value").write.mode("append").parquet(source)
        stream.store_available(spark, stream.score_lines(model, stream.parquet_source(spark, source)), path, ckpt, "replay")

    store.append_predictions(T.stored_predictions(spark, sf_dir), path, batch_id=0)
    store.clear_predictions(spark, path)
    arrive(lines.filter(first))
    arrive(lines.filter(~first))
    return clf.rounded(store.read_store(spark, path).select("id", "texto", "prediccion", "probability", "estado"))


def stream_resume(spark, sf_dir):
    """Two arrivals and an idle restart on one checkpoint: each row once."""
    source, sink, ckpt = (work_path(spark, n) for n in ("resume-src", "resume-sink", "resume-ckpt"))
    lines = records.encode_records(_cleaned(spark, sf_dir, extra_cols=("lang",)))
    first = F.col("lang").isin("en", "es")
    model = trained_model(spark, sf_dir)
    stream.write_lines(lines.filter(first), source)
    stream.run_available(stream.score_lines(model, stream.text_source(spark, source)), sink, ckpt)
    stream.write_lines(lines.filter(~first | F.col("lang").isNull()), source)
    stream.run_available(stream.score_lines(model, stream.text_source(spark, source)), sink, ckpt)
    stream.run_available(stream.score_lines(model, stream.text_source(spark, source)), sink, ckpt)
    return _stream_output(spark, sink)


# -- step 8 ---------------------------------------------------------------

def latest_by_class(spark, sf_dir):
    return reports.latest_by_class(T.stored_predictions(spark, sf_dir), T.CLASS_NEGATIVE)


def strip_special(spark, sf_dir):
    return T.documents(spark, sf_dir).select("doc_id", tx.strip_special(F.col("texto")).alias("texto_limpio"))


def class_share(spark, sf_dir):
    return reports.class_share(reports.class_stats(T.stored_predictions(spark, sf_dir), ordered=False))


def class_over_time(spark, sf_dir):
    return reports.class_over_time(T.stored_predictions(spark, sf_dir))


QUERIES: dict[str, QueryFn] = {
    "csv_corpus_scan": csv_corpus_scan,
    "lower_text": lower_text,
    "class_stats": class_stats,
    "class_summary": class_summary,
    "latest_predictions": latest_predictions,
    "format_predictions": format_predictions,
    "overview": overview,
    "predictions_json": predictions_json,
    "clean_records": clean_records,
    "encode_records": encode_records,
    "parse_records": parse_records,
    "text_preview": text_preview,
    "reject_empty": reject_empty,
    "migrate_predictions": migrate_predictions,
    "migration_counts": migration_counts,
    "store_predictions": store_predictions,
    "clear_predictions": clear_predictions,
    "document_store": document_store,
    "document_rejects": document_rejects,
    "unified_predictions": unified_predictions,
    "label_index": label_index,
    "tokens": tokens,
    "tokens_no_stop": tokens_no_stop,
    "term_counts": term_counts,
    "idf_weights": idf_weights,
    "nb_model_params": nb_model_params,
    "score_corpus": score_corpus,
    "scored_class_stats": scored_class_stats,
    "score_examples": score_examples,
    "model_roundtrip": model_roundtrip,
    "score_corpus_hashed": score_corpus_hashed,
    "stream_score": stream_score,
    "stream_store": stream_store,
    "stream_resume": stream_resume,
    "latest_by_class": latest_by_class,
    "strip_special": strip_special,
    "class_share": class_share,
    "class_over_time": class_over_time,
}
