"""Physical-plan properties that matter at scale (read from explain output)."""

import contextlib
import io

from tonalyze.operators import classifier as clf
from tonalyze.operators import reports
from tonalyze.plans import catalog
from tonalyze.sources import tables as T


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _scan_schemas(text: str) -> list[str]:
    return [line for line in text.splitlines() if line.startswith("ReadSchema")]


def test_class_reads_prune_text_and_pre_aggregate(spark, sf_small):
    p = plan(catalog.class_stats(spark, sf_small))
    assert all("text" not in s for s in _scan_schemas(p))
    assert "partial_count" in p and "partial_avg" in p


def test_newest_joins_instead_of_collecting(spark, sf_small):
    p = plan(catalog.latest_predictions(spark, sf_small))
    assert "TakeOrderedAndProject" in p and "LeftSemi" in p
    assert "INSET" not in p and "In(doc_id" not in p


def test_overview_recent_part_reads_no_text(spark, sf_small):
    recent = reports.newest(T.stored_predictions(spark, sf_small), 10).select("id", "ts")
    assert all("text" not in s for s in _scan_schemas(plan(recent)))


def test_scoring_is_map_only_and_jvm_side(spark, sf_small):
    model = catalog.trained_model(spark, sf_small)
    p = plan(clf.score(model, T.documents(spark, sf_small).select("doc_id", "texto"), keep=["doc_id"]))
    assert "Exchange" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_vocabulary_tokenizes_once_and_uses_top_n(spark, sf_small):
    toks = clf.tokenize(T.labelled_corpus(spark, sf_small))
    p = plan(clf.vocabulary(toks, 5000))
    assert "TakeOrderedAndProject" in p
    assert "partial_count" in p
    # no tokenizer call inside an inferred filter (size(...) > 0)
    assert "size(UDF" not in p


def test_no_python_udf_in_any_query_plan(spark, sf_small):
    for name, query in catalog.QUERIES.items():
        p = plan(query(spark, sf_small))
        assert "EvalPython" not in p and "InArrow" not in p and "InPandas" not in p, name


def test_term_counts_shuffle_nothing(spark, sf_small):
    p = plan(clf.term_counts(clf.tokenize(T.documents(spark, sf_small)), ["de", "la"]))
    assert "Exchange" not in p and "Join" not in p


def test_parameter_tables_come_from_aggregates(spark, sf_small):
    for name in ("idf_weights", "nb_model_params"):
        p = plan(catalog.QUERIES[name](spark, sf_small))
        assert "Scan parquet" in p and "HashAggregate" in p, name


def test_bucketed_inputs_join_without_exchange(spark, sf_small):
    from tonalyze.__main__ import main
    from tonalyze.session import work_path
    from tonalyze.sources.bucketed import bucket_inputs

    docs, labels = bucket_inputs(spark, sf_small, 4, work_path(spark, "bucketed"), prefix="t_bucketed")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as if labels were large
    try:
        corpus = T.corpus_of(spark.table(docs), spark.table(labels))
        p = plan(corpus)
        assert "SortMergeJoin" in p
        assert "Exchange" not in p
        direct = T.labelled_corpus(spark, sf_small, spread_rows=False)
        assert sorted(map(tuple, corpus.collect())) == sorted(map(tuple, direct.collect()))
        model = work_path(spark, "bucketed-model")
        assert main(["train", "--tables", docs, labels, "--model", model], spark) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_spread_only_when_the_caller_asks(spark):
    few = spark.range(100).coalesce(1)
    assert T.spread(few) is few
    spark.conf.set(T.TEXT_PARTITIONS, "3")
    try:
        assert T.spread(few).rdd.getNumPartitions() == 3
        assert T.spread(spark.range(0, 1000, 1, 16)).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(T.TEXT_PARTITIONS)


def test_class_share_runs_no_job_when_built(spark, sf_small):
    stats = spark.createDataFrame([("a", 3), ("b", 1)], "_id string, total long")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    share = reports.class_share(stats)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
    assert {r.clase: r.proporcion for r in share.collect()} == {"a": 0.75, "b": 0.25}
