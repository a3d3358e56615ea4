"""The pipeline: each stage on its predecessor's rows against brute force."""

import os
import sys

import edge

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from test_dedup import brute_components, brute_cut, brute_hits, brute_lines  # noqa: E402
from test_packing import check_pieces  # noqa: E402

from tonalyze.llm import quality_rules  # noqa: E402
from tonalyze.llm.common import saved, table  # noqa: E402


def walk(spark, docs, sf_dir, items):
    columns = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]

    def texts(df):
        assert df.columns == columns and df.dtypes == docs.dtypes
        assert all(r.signature == "clash" and r["kept"] == "clash" for r in df.collect() if "signature" in columns)
        return {(r.doc_id, r.text): r for r in df.collect()}

    before = texts(docs)
    ruled = saved(stages[0](spark, docs, sf_dir), "t-rules")
    verdicts = quality_rules.apply_rules(docs).filter("kept").collect()
    assert set(texts(ruled)) == {(r.doc_id, r.text) for r in verdicts} <= set(before)

    unique = saved(stages[1](spark, ruled, sf_dir), "t-near")
    parts = brute_components({(i, t) for i, t in texts(ruled) if i is not None})
    assert set(texts(unique)) == {(i, t) for i, t in texts(ruled) if i is None or parts[i][1] == i}
    assert unique.filter("doc_id is not null").count() == len({i for i, _ in texts(unique) if i is not None})

    lined = saved(stages[2](spark, unique, sf_dir), "t-lines")
    ordered = sorted(((i, t) for i, t in texts(unique)), key=lambda x: (x[0] is not None, x[0] or 0))
    cuts = brute_lines(ordered)
    want = {}
    for i, text in ordered:
        text = text and brute_cut(text, cuts.get(i, []))
        if edge.ALNUM.search(edge.lower(text)):
            want[(i, text)] = len(text)
    assert {k: r.n_chars for k, r in texts(lined).items()} == want

    clean = saved(stages[3](spark, lined, sf_dir), "t-clean")
    left = texts(clean)
    for i, text in texts(lined):
        words, hit, _ = brute_hits(text, items)
        rest = [w for k, w in enumerate(words) if k not in hit]
        mine = [edge.ALNUM.findall(edge.lower(t)) for j, t in left if j == i]
        assert mine == ([rest] if rest else [])
        if not hit:
            assert (i, text) in left

    packed = stages[4](spark, clean, sf_dir)
    check_pieces(packed.collect(), list(left))
    return packed


def test_stages_equal_brute_force(spark, sf_small):
    items = [(r.item_id, r.text) for r in table(spark, sf_small, "benchmark").collect()]
    last = walk(spark, table(spark, sf_small, "documents"), sf_small, items)
    whole = corpus_pipeline.run(spark, sf_small)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, last.select(key).collect()))


def test_stages_of_odd_rows(spark, sf_small):
    items = [(r.item_id, r.text) for r in table(spark, sf_small, "benchmark").collect()]
    walk(spark, edge.frame(spark), sf_small, items)


def test_stages_of_an_empty_table(spark, sf_small):
    docs = edge.frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, sf_small), "t-empty")
        assert docs.count() == 0, name


def test_one_row_of_an_id_stays(spark, sf_small):
    a, b = edge.passage(1, 40), edge.passage(2, 40)
    rows = [(3, a), (7, a), (7, b), (9, b), (11, edge.passage(4, 40)), (11, edge.passage(3, 40)), (None, a), (None, a)]
    left = corpus_pipeline.near_dedup_stage(spark, edge.frame(spark, rows), sf_small)
    want = [(3, a), (11, min(edge.passage(3, 40), edge.passage(4, 40))), (None, a), (None, a)]
    key = lambda x: (x[0] is not None, x)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=key) == sorted(want, key=key)
