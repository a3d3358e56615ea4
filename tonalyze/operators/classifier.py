"""Text classifier: tokenise, drop stop words, count terms, IDF, Naive Bayes.

The model is a plain MLlib ``PipelineModel`` of seven stages (label index,
tokenizer, stop-word remover, term counts, IDF, multinomial Naive Bayes,
index-to-label), so it saves, loads and scores batch and streaming frames
like any MLlib pipeline.  How it is fitted differs from ``Pipeline.fit``:

* The vocabulary is cut deterministically: term totals come from a
  DataFrame aggregation (partial aggregation per task, so a stop word that
  makes up a third of all tokens costs one row per task in the shuffle),
  ordered by count descending then term, and the first ``vocab_size`` are
  taken with a top-n (``TakeOrderedAndProject``).  MLlib's own
  ``CountVectorizer`` breaks ties at the cut by partition order, which
  changes the model with the partitioning.
* The corpus is tokenised twice, not once per estimator: once for the
  vocabulary, once for the (label, term counts) vectors, which are
  persisted (memory, spilling to disk; recomputed from lineage if an
  executor is lost) and read by both the IDF and the Naive Bayes fits.
  Persisting the token arrays instead would hold about as much as the
  text itself, so the second tokenising pass is the cheaper choice.

Driver state is bounded by parameters: the vocabulary (``vocab_size``
terms), IDF (one double per term) and Naive Bayes (classes x terms).

Exact model, with N documents, K classes, V terms and smoothing 1:
idf(w) = ln((N+1)/(df(w)+1)); x = tf * idf;
prior(c) = ln(n_c+1) - ln(N+K); theta(c,w) = ln(S(c,w)+1) - ln(S(c)+V);
raw = prior + x . theta; probability = softmax(raw); class = first arg-max.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    HashingTF,
    IndexToString,
    StopWordsRemover,
    StringIndexerModel,
    Tokenizer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonalyze.functions.formatting import utc_ntz
from tonalyze.fixed import MIN_DF, PROCESSED_STATUS, SMOOTHING, STOP_WORDS_LANGUAGE, VOCAB_SIZE

# Column names used inside the pipeline.
MODEL_TEXT = "texto_modelo"
LABEL = "label"
TOKENS = "palabras"
CLEAN_TOKENS = "palabras_limpias"
RAW_FEATURES = "rawFeatures"
FEATURES = "features"
PREDICTED = "intencion_predicha"


@dataclass(frozen=True)
class ClassifierParams:
    text_col: str = "texto"
    label_col: str = "etiqueta"
    vocab_size: int = VOCAB_SIZE
    min_df: float = MIN_DF
    smoothing: float = SMOOTHING
    stop_words_language: str = STOP_WORDS_LANGUAGE
    hashed: bool = False
    num_features: int = 1 << 18


def with_model_text(df: DataFrame, text_col: str = "texto") -> DataFrame:
    """Working text column for the model: null text scores as ''."""
    return df.withColumn(MODEL_TEXT, F.coalesce(F.col(text_col), F.lit("")))


def text_stages(params: ClassifierParams) -> tuple[Tokenizer, StopWordsRemover]:
    tokenizer = Tokenizer(inputCol=MODEL_TEXT, outputCol=TOKENS)
    # Tokens are already lower case and Spark's lists are lower case, so an
    # exact match gives the case-insensitive result without lowercasing
    # every token a second time.
    words = StopWordsRemover.loadDefaultStopWords(params.stop_words_language)
    if any(w != w.lower() for w in words):
        words = [w.lower() for w in words]
    remover = StopWordsRemover(inputCol=TOKENS, outputCol=CLEAN_TOKENS,
                               stopWords=words, caseSensitive=True)
    return tokenizer, remover


def tokenize(df: DataFrame, params: ClassifierParams = ClassifierParams()) -> DataFrame:
    """Adds ``palabras`` and ``palabras_limpias`` (both JVM-side stages)."""
    tokenizer, remover = text_stages(params)
    return remover.transform(tokenizer.transform(with_model_text(df, params.text_col)))


def explode_terms(tokens: DataFrame, tokens_col: str = CLEAN_TOKENS, *keep: str) -> DataFrame:
    """One row per token.

    ``explode_outer`` plus a null filter instead of ``explode``: from an inner
    explode Catalyst infers a ``size(tokens) > 0`` filter and, the tokenizer
    being deterministic, evaluates the tokenizer stages a second time inside
    it (and below any exchange).  Tokens themselves are never null.
    """
    return (tokens.select(*keep, F.explode_outer(tokens_col).alias("term"))
            .filter(F.col("term").isNotNull()))


def vocabulary(tokens: DataFrame, vocab_size: int, min_df: float = 1.0,
               tokens_col: str = CLEAN_TOKENS) -> DataFrame:
    """Top terms: (term_index, term, total); count desc, then term asc.

    ``min_df`` >= 1 is a document count, below 1 a fraction of documents.
    The default (1 document) holds for every term seen, so the document
    frequency pass is only run when a stricter threshold is asked for.
    """
    terms = explode_terms(tokens, tokens_col)
    totals = terms.groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    if min_df != 1.0:
        threshold = min_df if min_df >= 1.0 else min_df * tokens.count()
        distinct = tokens.select(F.array_distinct(tokens_col).alias("_distinct"))
        docs = (explode_terms(distinct, "_distinct")
                .groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
                .filter(F.col("doc_freq") >= threshold).select("term"))
        totals = totals.join(docs, "term", "left_semi")
    top = totals.orderBy(F.col("total").desc(), F.col("term").asc()).limit(vocab_size)
    # ``top`` has at most vocab_size rows; the index follows its order.
    order = Window.orderBy(F.col("total").desc(), F.col("term").asc())
    return top.select((F.row_number().over(order) - 1).alias("term_index"), "term", "total")


def vocabulary_terms(vocab: DataFrame) -> list[str]:
    """The vocabulary as a driver list (bounded by ``vocab_size``)."""
    rows = vocab.orderBy("term_index").select("term").collect()
    return [r["term"] for r in rows]


def term_counts(tokens: DataFrame, terms: list[str], key: str = "doc_id",
                tokens_col: str = CLEAN_TOKENS) -> DataFrame:
    """(key, term, tf) for the vocabulary terms of each row; map-only.

    ``terms`` is the vocabulary, whose size ``vocab_size`` bounds (the model
    holds it on the driver too).  A row is counted by the model's own
    ``CountVectorizerModel`` (hash lookups in the JVM) and its sparse vector
    is laid out as rows: nothing is exploded before it is counted, and
    nothing is shuffled.
    """
    if not terms:
        return tokens.select(key, F.lit("").alias("term"), F.lit(0).cast("long").alias("tf")).limit(0)
    counter = CountVectorizerModel.from_vocabulary(terms, inputCol=tokens_col, outputCol=RAW_FEATURES)
    vector = F.unwrap_udt(F.col(RAW_FEATURES))
    # an outer explode: see explode_terms
    cells = (counter.transform(tokens.select(key, tokens_col)).select(key, vector.alias("_v"))
             .select(key, F.explode_outer(F.arrays_zip("_v.indices", "_v.values")).alias("_c"))
             .filter(F.col("_c").isNotNull()))
    # one constant, folded when the plan is made
    names = F.from_json(F.lit(json.dumps(terms)), "array<string>")
    return cells.select(key, F.get(names, F.col("_c.indices")).alias("term"),
                        F.col("_c.values").cast("long").alias("tf"))


def term_totals(tokens: DataFrame, *by: str, tokens_col: str = CLEAN_TOKENS) -> DataFrame:
    """(by, term, total, doc_freq) of all terms in one pass over the tokens.

    A row's tokens are sorted, so a token that differs from its neighbour is
    the first of its term in that document.
    """
    ordered = tokens.select(*by, F.sort_array(tokens_col).alias("_sorted"))
    each = (ordered.select(*by, "_sorted", F.posexplode_outer("_sorted").alias("_at", "term"))
            .filter(F.col("term").isNotNull()))
    fresh = (F.col("_at") == 0) | (F.get(F.col("_sorted"), F.col("_at") - 1) != F.col("term"))
    return each.groupBy(*by, "term").agg(F.count(F.lit(1)).alias("total"), F.count_if(fresh).alias("doc_freq"))


def label_indexer(labelled: DataFrame, label_col: str = "etiqueta") -> StringIndexerModel:
    """Label index by frequency (descending), ties by label; unseen labels kept.

    The same order ``StringIndexer(stringOrderType="frequencyDesc")`` fits,
    from one aggregate over the label column only (the text is pruned from
    the scan), one row per class back to the driver.
    """
    counts = (labelled.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(label_col).asc()).collect())
    return StringIndexerModel.from_labels([r[label_col] for r in counts], inputCol=label_col,
                                          outputCol=LABEL, handleInvalid="keep")


def term_stage(terms: list[str] | None, params: ClassifierParams):
    if params.hashed:
        return HashingTF(inputCol=CLEAN_TOKENS, outputCol=RAW_FEATURES,
                         numFeatures=params.num_features)
    return CountVectorizerModel.from_vocabulary(terms, inputCol=CLEAN_TOKENS,
                                                outputCol=RAW_FEATURES)


def train(corpus: DataFrame, params: ClassifierParams = ClassifierParams()) -> PipelineModel:
    """Fit the seven-stage model on (text, label) rows.

    Rows with a null label are dropped (an index without a name would make
    the last stage fail); null texts train as ''.
    """
    labelled = with_model_text(
        corpus.filter(F.col(params.label_col).isNotNull()), params.text_col)
    indexer = label_indexer(labelled, params.label_col)
    tokenizer, remover = text_stages(params)
    tokens = remover.transform(tokenizer.transform(labelled))
    terms = None
    if not params.hashed:
        terms = vocabulary_terms(vocabulary(tokens, params.vocab_size, params.min_df))
    counts = term_stage(terms, params)
    vectors = (counts.transform(indexer.transform(tokens))
               .select(LABEL, RAW_FEATURES)
               .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        idf = IDF(inputCol=RAW_FEATURES, outputCol=FEATURES, minDocFreq=0).fit(vectors)
        nb = NaiveBayes(labelCol=LABEL, featuresCol=FEATURES, smoothing=params.smoothing,
                        modelType="multinomial").fit(idf.transform(vectors))
    finally:
        vectors.unpersist()
    to_label = IndexToString(inputCol="prediction", outputCol=PREDICTED, labels=indexer.labels)
    return PipelineModel(stages=[indexer, tokenizer, remover, counts, idf, nb, to_label])


def score(model: PipelineModel, df: DataFrame, text_col: str = "texto",
          keep: list[str] | None = None) -> DataFrame:
    """Scored rows: kept columns + class, confidence and probability vector.

    ``probability`` is the posterior as array<double> in label-index order;
    ``confianza`` is its maximum.  Works on batch and streaming frames.
    """
    keep = list(df.columns) if keep is None else keep
    scored = model.transform(with_model_text(df, text_col))
    # vector -> array once; the maximum is taken from the array column
    arrays = scored.select(*keep, F.col(PREDICTED).alias("prediccion"),
                           vector_to_array(F.col("probability")).alias("probability"))
    return arrays.select(*keep, "prediccion", F.array_max("probability").alias("confianza"),
                         "probability")


def score_texts(spark: SparkSession, model: PipelineModel, texts: list[str]) -> DataFrame:
    """Score request texts given inline (one small frame, one plan for all)."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "pos int, texto string")
    return scoring_record(score(model, rows))


def scoring_record(scored: DataFrame) -> DataFrame:
    """Response record of a scoring request, for a whole scored batch: class,
    probability vector, confidence, a constant status, the time it was
    scored (UTC, kept if the row has one) and whether it is stored (not yet)."""
    now = utc_ntz(F.current_timestamp())
    ts = F.coalesce(F.col("ts"), now) if "ts" in scored.columns else now
    return scored.withColumns({"status": F.lit(PROCESSED_STATUS), "ts": ts, "stored": F.lit(False)})


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Confidence and probabilities rounded (for comparison across engines)."""
    out = df
    if "confianza" in df.columns:
        out = out.withColumn("confianza", F.round("confianza", places))
    if "probability" in df.columns:
        out = out.withColumn("probability",
                             F.transform("probability", lambda x: F.round(x, places)))
    return out


def stage(model: PipelineModel, kind: type):
    return next(s for s in model.stages if isinstance(s, kind))


def label_names(model: PipelineModel) -> list[str]:
    return list(stage(model, IndexToString).getLabels())


def top_terms(totals: DataFrame, vocab_size: int) -> DataFrame:
    """The first ``vocab_size`` rows of (term, total, ...) in vocabulary order,
    with their ``term_index``."""
    keys = (F.col("total").desc(), F.col("term").asc())
    top = totals.orderBy(*keys).limit(vocab_size)
    return top.withColumn("term_index", F.row_number().over(Window.orderBy(*keys)) - 1)


def idf_table(top: DataFrame, n_docs: int) -> DataFrame:
    """(term_index, term, doc_freq, idf) of the vocabulary terms of ``n_docs``
    training documents."""
    return top.select(F.col("term_index").cast("int").alias("term_index"), "term",
                      F.col("doc_freq").cast("long").alias("doc_freq"),
                      F.log((n_docs + 1.0) / (F.col("doc_freq") + 1.0)).alias("idf"))


def nb_params_table(by_class: DataFrame, idf: DataFrame, names: dict[str, int],
                    smoothing: float = SMOOTHING) -> DataFrame:
    """Log prior per class (term null) and log term probability per class and
    term.

    ``by_class`` has (clase, term, total) of the corpus, ``names`` the
    documents per class.  A term's IDF is one number, so what a class holds of
    it is its count times that.
    """
    spark = by_class.sparkSession
    n, k = sum(names.values()), len(names)
    labels = F.array(*[F.lit(c) for c in sorted(names)])
    weighted = by_class.join(idf.select("term", "idf"), "term").select(
        "clase", "term", (F.col("total") * F.col("idf")).alias("s"))
    # every (class, term) of the vocabulary, those never seen too
    grid = (idf.select("term", F.explode(labels).alias("clase")).join(weighted, ["clase", "term"], "left")
            .withColumn("s", F.coalesce("s", F.lit(0.0))))
    of_class = grid.groupBy("clase").agg(F.sum("s").alias("s_c"), F.count(F.lit(1)).alias("v"))
    theta = grid.join(of_class, "clase").select("clase", "term", (
        F.log(F.col("s") + smoothing) - F.log(F.col("s_c") + F.col("v") * smoothing)).alias("valor"))
    prior = spark.createDataFrame(sorted(names.items()), "clase string, n_c long").select(
        "clase", F.lit(None).cast("string").alias("term"),
        (F.log(F.col("n_c") + smoothing) - F.log(F.lit(n + k * smoothing))).alias("valor"))
    return prior.unionByName(theta)
