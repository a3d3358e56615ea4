"""Classifier stages and the closed-form model they must equal."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonalyze.operators import classifier as clf

CORPUS = [
    (1, "la comida llegó fría y tarde", "negativo"),
    (2, "pésima atención, nunca más", "negativo"),
    (3, "entrega rápida y producto excelente", "positivo"),
    (4, "todo perfecto, muy contento", "positivo"),
    (5, "me encantó el envío rápido", "positivo"),
    (6, "el paquete llegó ayer", "neutral"),
    (7, "recibí la caja en la oficina", "neutral"),
]
SCHEMA = "doc_id long, texto string, etiqueta string"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(CORPUS, SCHEMA)


@pytest.fixture(scope="module")
def model(corpus):
    return clf.train(corpus)


def test_tokenizer_whitespace_rules(spark):
    df = spark.createDataFrame([(1, "  Lead  two "), (2, ""), (3, "   "), (4, None)], "doc_id long, texto string")
    got = {r.doc_id: r.palabras for r in clf.tokenize(df).collect()}
    assert got[1] == ["", "", "lead", "", "two"]     # leading and inner runs give empty tokens
    assert got[2] == [""]                             # '' is one empty token
    assert got[3] == []                               # trailing runs give none
    assert got[4] == [""]                             # null text tokenised as ''


def test_stop_words_spanish_default(spark):
    df = spark.createDataFrame([(1, "No me gusta el servicio")], "doc_id long, texto string")
    assert clf.tokenize(df).first().palabras_limpias == ["gusta", "servicio"]


def test_label_index_by_frequency_then_name(corpus):
    idx = clf.label_indexer(corpus)
    assert idx.labels == ["positivo", "negativo", "neutral"]


def test_vocabulary_is_deterministic_across_partitionings(spark):
    rows = [(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 9)), "x") for i in range(60)]
    base = spark.createDataFrame(rows, SCHEMA)
    cuts = []
    for n in (1, 3, 7):
        toks = clf.tokenize(base.repartition(n))
        cuts.append(clf.vocabulary_terms(clf.vocabulary(toks, 10)))
    assert cuts[0] == cuts[1] == cuts[2]
    assert len(cuts[0]) == 10


def _closed_form(corpus_rows, texts, stop_words):
    """Brute force of the model: idf, priors, theta, softmax (smoothing 1)."""
    def toks(t):
        return [w for w in (t or "").lower().rstrip(" \t\n\x0b\f\r").split(" ") if w not in stop_words] \
            if (t or "").strip() or not t else []

    docs = [(toks(t), y) for _, t, y in corpus_rows]
    counts = {}
    for ws, _ in docs:
        for w in ws:
            counts[w] = counts.get(w, 0) + 1
    vocab = sorted(counts, key=lambda w: (-counts[w], w))
    index = {w: i for i, w in enumerate(vocab)}
    n, v = len(docs), len(vocab)
    labels = sorted({y for _, y in docs}, key=lambda c: (-sum(1 for _, y in docs if y == c), c))
    k = len(labels)

    def tf(ws):
        x = np.zeros(v)
        for w in ws:
            if w in index:
                x[index[w]] += 1
        return x

    tfs = np.array([tf(ws) for ws, _ in docs])
    df = (tfs > 0).sum(axis=0)
    idf = np.log((n + 1) / (df + 1))
    x = tfs * idf
    prior = np.array([math.log(sum(1 for _, y in docs if y == c) + 1) - math.log(n + k) for c in labels])
    s = np.array([x[[y == c for _, y in docs]].sum(axis=0) for c in labels])
    theta = np.log(s + 1) - np.log(s.sum(axis=1, keepdims=True) + v)
    out = []
    for t in texts:
        raw = prior + theta @ (tf(toks(t)) * idf)
        p = np.exp(raw - raw.max())
        p /= p.sum()
        out.append((labels[int(np.argmax(raw))], p))
    return out


def test_model_equals_closed_form(spark, corpus, model):
    from pyspark.ml.feature import StopWordsRemover
    stop = set(StopWordsRemover.loadDefaultStopWords("spanish"))
    texts = ["entrega excelente y rápida", "la comida fría", "caja en la oficina", "zzz qqq"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, texto string")
    got = {r.doc_id: r for r in clf.score(model, df, keep=["doc_id"]).collect()}
    want = _closed_form(CORPUS, texts, stop)
    for i, (cls, p) in enumerate(want):
        assert got[i].prediccion == cls
        assert np.allclose(got[i].probability, p, rtol=1e-9, atol=1e-12)


def test_unknown_words_give_priors_and_most_frequent_label(spark, model):
    df = spark.createDataFrame([(1, "xyzzy plugh")], "doc_id long, texto string")
    r = clf.score(model, df, keep=["doc_id"]).first()
    # priors: (3+1, 2+1, 2+1) / (7+3)
    assert np.allclose(r.probability, [0.4, 0.3, 0.3])
    assert r.prediccion == "positivo"


def test_probabilities_sum_to_one_and_confidence_is_max(spark, model):
    df = spark.createDataFrame([(i, t) for i, t, _ in CORPUS], "doc_id long, texto string")
    for r in clf.score(model, df, keep=["doc_id"]).collect():
        assert abs(sum(r.probability) - 1) < 1e-9
        assert r.confianza == max(r.probability)


def test_scoring_without_label_column_and_with_unseen_label(spark, model):
    no_label = spark.createDataFrame([(1, "entrega rápida")], "doc_id long, texto string")
    unseen = spark.createDataFrame([(1, "entrega rápida", "zzz")], SCHEMA)
    a = clf.score(model, no_label, keep=["doc_id"]).first()
    b = clf.score(model, unseen, keep=["doc_id"]).first()
    assert a.prediccion == b.prediccion == "positivo"
    assert a.probability == b.probability


def test_null_text_scores_and_null_label_rows_are_dropped(spark):
    rows = CORPUS + [(8, None, "positivo"), (9, "texto sin clase", None)]
    m = clf.train(spark.createDataFrame(rows, SCHEMA))
    assert clf.label_names(m) == ["positivo", "negativo", "neutral"]
    df = spark.createDataFrame([(1, None)], "doc_id long, texto string")
    assert clf.score(m, df, keep=["doc_id"]).first().prediccion in clf.label_names(m)


def test_model_save_load_roundtrip(spark, model):
    from pyspark.ml import PipelineModel

    from tonalyze.session import work_path
    path = work_path(spark, "test-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    df = spark.createDataFrame([(1, "producto excelente")], "doc_id long, texto string")
    assert clf.score(model, df).first().probability == clf.score(loaded, df).first().probability


def test_hashed_model_equals_brute_force(spark, corpus):
    """No SQL oracle for murmur3 hashing: check against Spark's own index
    function plus the closed-form model on a literal fixture."""
    from pyspark.ml.feature import HashingTF, StopWordsRemover
    params = clf.ClassifierParams(hashed=True, num_features=64)
    m = clf.train(corpus, params)
    htf = HashingTF(numFeatures=64)
    stop = set(StopWordsRemover.loadDefaultStopWords("spanish"))

    def toks(t):
        return [w for w in t.lower().split(" ") if w not in stop]

    docs = [(toks(t), y) for _, t, y in CORPUS]
    labels = clf.label_names(m)
    n, k, v = len(docs), len(labels), 64

    def tf(ws):
        x = np.zeros(v)
        for w in ws:
            x[htf.indexOf(w)] += 1
        return x

    tfs = np.array([tf(ws) for ws, _ in docs])
    idf = np.log((n + 1) / ((tfs > 0).sum(axis=0) + 1))
    x = tfs * idf
    prior = np.array([math.log(sum(1 for _, y in docs if y == c) + 1) - math.log(n + k) for c in labels])
    s = np.array([x[[y == c for _, y in docs]].sum(axis=0) for c in labels])
    theta = np.log(s + 1) - np.log(s.sum(axis=1, keepdims=True) + v)
    text = "entrega excelente en la oficina"
    raw = prior + theta @ (tf(toks(text)) * idf)
    p = np.exp(raw - raw.max())
    p /= p.sum()
    got = clf.score(m, spark.createDataFrame([(text,)], "texto string")).first()
    assert np.allclose(got.probability, p, rtol=1e-9)
    assert got.prediccion == labels[int(np.argmax(raw))]


def test_term_counts_match_count_vectors(spark, corpus, model):
    from pyspark.ml.feature import CountVectorizerModel
    from pyspark.ml.functions import vector_to_array
    params = clf.ClassifierParams()
    toks = clf.tokenize(corpus)
    vocab = clf.vocabulary(toks, params.vocab_size)
    by_df = {(r.doc_id, r.term): r.tf for r in clf.term_counts(toks, clf.vocabulary_terms(vocab)).collect()}
    cv = clf.stage(model, CountVectorizerModel)
    dense = cv.transform(toks).select("doc_id", vector_to_array(F.col("rawFeatures")).alias("a")).collect()
    by_ml = {(r.doc_id, cv.vocabulary[j]): int(c) for r in dense for j, c in enumerate(r.a) if c}
    assert by_df == by_ml


def test_split_fit_equals_stock_pipeline_fit(spark, corpus, model):
    """Without a tie at the vocabulary cut the model equals Pipeline.fit."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF, CountVectorizer, IndexToString, StringIndexer

    tok, rem = clf.text_stages(clf.ClassifierParams())
    indexer = StringIndexer(inputCol="etiqueta", outputCol="label", handleInvalid="keep")
    label_model = indexer.fit(corpus)
    stock = Pipeline(stages=[
        indexer, tok, rem,
        CountVectorizer(inputCol=clf.CLEAN_TOKENS, outputCol=clf.RAW_FEATURES, vocabSize=5000, minDF=1.0),
        IDF(inputCol=clf.RAW_FEATURES, outputCol=clf.FEATURES),
        NaiveBayes(smoothing=1.0, modelType="multinomial"),
        IndexToString(inputCol="prediction", outputCol=clf.PREDICTED, labels=label_model.labels),
    ]).fit(clf.with_model_text(corpus))
    texts = spark.createDataFrame([(i, t) for i, t, _ in CORPUS] + [(99, "rápida caja fría")],
                                  "doc_id long, texto string")
    ours = {r.doc_id: r for r in clf.score(model, texts, keep=["doc_id"]).collect()}
    theirs = {r.doc_id: r for r in clf.score(stock, texts, keep=["doc_id"]).collect()}
    for k in ours:
        assert ours[k].prediccion == theirs[k].prediccion
        assert np.allclose(ours[k].probability, theirs[k].probability, rtol=1e-12)


def test_score_inline_request_texts(spark, model):
    out = clf.score_texts(spark, model, ["producto excelente, entrega rápida",
                                         "comida fría y tarde", "la caja en la oficina"]).collect()
    assert [r.prediccion for r in sorted(out, key=lambda r: r.pos)] == ["positivo", "negativo", "neutral"]
    assert all(r.status == "processed" for r in out)


def test_sql_murmur3_bucket_equals_hashing_tf(spark):
    import duckdb
    from pyspark.ml.feature import HashingTF

    from tonalyze.plans.oracle import murmur3_buckets
    words = ["", "a", "ab", "abc", "abcd", "abcde", "hola", "éçà", "niño", "straße", "x" * 37, "日本語", "€uro"]
    con = duckdb.connect()
    con.execute("CREATE TABLE ws (w VARCHAR)")
    con.executemany("INSERT INTO ws VALUES (?)", [(w,) for w in words])
    got = dict(con.execute(f"WITH {murmur3_buckets('ws', 1 << 18)} SELECT w, j FROM bucket").fetchall())
    htf = HashingTF(numFeatures=1 << 18)
    assert got == {w: htf.indexOf(w) for w in words}


def test_vocabulary_min_df_threshold(spark):
    rows = [(1, "alfa beta beta", "x"), (2, "alfa gamma", "x"), (3, "alfa delta", "x")]
    toks = clf.tokenize(spark.createDataFrame(rows, SCHEMA))
    assert clf.vocabulary_terms(clf.vocabulary(toks, 10, min_df=2.0)) == ["alfa"]
    assert clf.vocabulary_terms(clf.vocabulary(toks, 10, min_df=0.5)) == ["alfa"]
    assert clf.vocabulary_terms(clf.vocabulary(toks, 10)) == ["alfa", "beta", "delta", "gamma"]
