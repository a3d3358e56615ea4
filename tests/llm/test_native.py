"""Quality rules, sharding and the licence scan against plain Python."""

import collections
import math
import zlib

import edge
import pytest
from oracle_compare import compare
from pyspark.sql import functions as F

from tonalyze.llm import licenses, queries, quality_rules, sharding
from tonalyze.llm.common import table


def base_counts(text):
    text = text or ""
    words = edge.SPACED.findall(text)
    seen = collections.Counter(tuple(words[j:j + 5]) for j in range(len(words) - 4))
    covered = set()
    for j in range(len(words) - 4):
        if seen[tuple(words[j:j + 5])] > 1:
            covered.update(range(j, j + 5))
    lines = [s for s in text.split("\n") if edge.SPACED.search(s)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_rules_equal_plain_counts(spark, sf_small):
    for docs in (edge.frame(spark), table(spark, sf_small, "documents")):
        rows = quality_rules.apply_rules(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            want = base_counts(r.text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
            assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
            assert not (r.base_failed and r.kept)


def test_rules_keep_input_columns_and_take_an_empty_table(spark):
    done = quality_rules.apply_rules(edge.frame(spark, []))
    assert done.count() == 0
    assert set(done.columns) == set(edge.frame(spark).columns) | {*quality_rules.ADDED, "base_failed", "kept"}


def test_rules_shuffle_nothing_and_call_no_python(spark, sf_small):
    plan = queries.op5_quality_rules(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["op2_license_inheritance", "op5_quality_rules", "op9_fm_decontamination"])
def test_query_matches_sql(spark, sf_small, name):
    report = compare(spark, sf_small, [name], verbose=False)[name]
    assert report["ok"], report


def check_shards(rows, texts, shards):
    of = collections.defaultdict(list)
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").encode()) + 8
        of[r.shard].append(r)
    for own in of.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert set(of) <= set(range(shards))
    return {k: sum(r.size for r in v) for k, v in of.items()}


def test_shards_are_near_equal_and_slots_gapless(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.op10_histogram_shards(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes = check_shards(rows, texts, 24)
    ideal, largest = sum(sizes.values()) / 24, max(r.size for r in rows)
    assert len(sizes) == 24 and max(abs(s - ideal) for s in sizes.values()) <= largest
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)


def test_a_group_of_copies_is_divided(spark):
    copy = "same text " * 40
    docs = spark.createDataFrame([(i, copy if i % 3 else f"t{i} " * 50) for i in range(900)], "doc_id long, text string")
    sizes = collections.Counter()
    for r in sharding.shard(docs).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == 24 and max(sizes.values()) < 1.1 * sum(sizes.values()) / 24


def test_shards_of_odd_rows(spark):
    rows = sharding.shard(edge.frame(spark)).collect()
    assert len(rows) == len(edge.texts()) and all(r["kept"] == "clash" for r in rows)
    of = collections.defaultdict(list)
    for r in rows:
        of[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in of.values())
    assert sharding.shard(edge.frame(spark, [])).count() == 0


def test_driver_state_follows_the_shard_count(spark, monkeypatch):
    """100,000 parts' worth of keys: no more boundaries than for one part a shard."""
    seen, bucket = [], sharding.bucket
    monkeypatch.setattr(sharding, "bucket", lambda h, i, edges: seen.append(len(edges)) or bucket(h, i, edges))
    params = sharding.ShardParams()
    for size in (300, params.part_bytes * 5):
        keys = spark.range(20_000).select(
            sharding._hash(F.col("id").cast("string")).alias("h"), F.col("id").alias("i"), F.lit(size).alias("size"))
        splitters, all_bytes = sharding.find_splitters(keys, params)
        assert len(splitters) == 23 and splitters == sorted(splitters) and all_bytes == 20_000 * size
    assert max(seen) <= params.shards * (params.probes + 3) and len(seen) < 20
    assert -(-all_bytes // params.part_bytes) == 100_000
    assert sharding.parts_per_shard(all_bytes, params) * params.shards <= params.max_parts


def test_shards_of_many_parts(spark):
    copy = "same text " * 40
    rows = [(i, copy if i % 3 else f"t{i} " * 50) for i in range(900)] + [(5, copy)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    params = sharding.ShardParams(part_bytes=2_000)
    found = sharding.shard(docs, params).collect()
    assert len(found) == len(rows) and len({r.part for r in found}) > 100
    check_shards(found, dict(rows), 24)


def test_shards_use_no_python(spark, sf_small):
    plan = queries.op10_histogram_shards(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange") <= 2


FILES = [
    (1, "a/b/c/x.py", "# Licensed under the Apache License, Version 2.0.\n" + edge.passage(1, 50)),
    (2, "a/LICENSE", "Released under the MIT License."),
    (3, "a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
    (4, "a/b/c/y.py", edge.passage(2, 50)), (5, "a/z.py", edge.passage(3, 50)), (6, "a/d/e/f.py", None),
    (7, "q/w.py", edge.passage(4, 50)), (8, None, ""), (9, "root.py", "the license word alone here " * 9),
]


def test_licences_come_from_header_file_or_nearest_directory(spark):
    docs = spark.createDataFrame(FILES, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.basis, r.license_dir) for r in licenses.scan(docs).collect()}
    assert got == {
        1: ("Apache-2.0", "header", None), 2: ("MIT", "header", None), 3: ("GPL-3.0", "header", None),
        4: ("GPL-3.0", "inherited", "a/b"), 5: ("MIT", "inherited", "a"), 6: ("MIT", "inherited", "a"),
        7: (None, "none", None), 8: (None, "none", None), 9: (None, "none", None)}


def plain_scores(texts):
    """Best cosine of each whole text, by the formula."""
    own = {i: licenses.terms_of(t) for i, t in texts.items()}
    df = collections.Counter(t for terms in own.values() for t in terms)
    def weighed(terms):
        return {t: tf * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, tf in terms.items()}
    def cosine(a, b):
        return sum(w * b.get(t, 0) for t, w in a.items()) / math.sqrt(
            sum(w * w for w in a.values()) * sum(w * w for w in b.values()))
    known = [weighed(licenses.terms_of(text)) for _, text in licenses.KNOWN]
    return {i: max(cosine(weighed(terms), k) for k in known) for i, terms in own.items()}


def test_cosine_equals_plain_formula(spark):
    texts = {i: t for i, _, t in FILES if t} | {
        20: "license license license the the " + edge.passage(5, 40), 21: licenses.FULL_TEXTS["GPL-3.0"][:9000]}
    docs = spark.createDataFrame(list(texts.items()), "id long, text string").select(
        "id", F.lit("p").alias("path"), "text", F.xxhash64("text").alias("version"))
    want = plain_scores(texts)
    rows = licenses.unit_scores(docs).filter("kind = 'file'").collect()
    assert {20, 21} < {r.id for r in rows}
    for r in rows:
        assert r.cosine == pytest.approx(want[r.id], abs=1e-8)


def test_rows_of_one_id_and_path_are_judged_apart(spark):
    apache = "# Licensed under the Apache License, Version 2.0.\n" + edge.passage(1, 50)
    rows = [(1, "a/x.py", apache), (1, "a/x.py", "nothing here at all"), (1, "a/x.py", apache), (1, "a/x.py", None)]
    rows += [(i, f"s/{i}.py", edge.passage(i, 30)) for i in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = collections.Counter((r.license, r.basis) for r in licenses.scan(docs).filter("doc_id = 1").collect())
    assert got == {("Apache-2.0", "header"): 2, (None, "none"): 2}


def test_every_full_text_is_found(spark):
    rows = [(i, f"s/{i}.py", edge.passage(i, 30)) for i in range(50)]
    rows += [(100 + k, f"{name}/LICENSE", text) for k, (name, text) in enumerate(licenses.FULL_TEXTS.items())]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.path: r.license for r in licenses.scan(docs).filter("doc_id >= 100").collect()}
    assert len(got) == 5 and got == {f"{name}/LICENSE": name for name in licenses.FULL_TEXTS}


def test_common_words_in_a_header_weigh_little(spark):
    rows = [(i, f"s/{i}.py", "You may use it as it is: " + edge.passage(i, 20)) for i in range(980)]
    rows += [(i, f"t/{i}.py", "Licensed under the Apache License, Version 2.0.") for i in range(1000, 1019)]
    rows.append((2000, "u/x.py", "You may use it as it is, licensed under the Apache License, Version 2.0."))
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    found = licenses.scan(files).filter("doc_id = 2000").first()
    assert (found.license, found.basis) == ("Apache-2.0", "header") and found.cosine > 0.9


MIT = """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_full_texts_and_broken_headers(spark):
    broken = ["# This Source Code Form is subject to", "# the terms of the Mozilla Public License,", "# v. 2.0."]
    rows = [(i, f"s/{i}.py", edge.passage(i, 30)) for i in range(50)]
    rows += [(100, "m/LICENSE", MIT), (101, "m/a/x.py", edge.passage(60, 30)),
             (102, "n/x.py", "\n".join([edge.passage(61, 30), *broken, edge.passage(62, 30)])),
             (103, "n/y.py", "\n".join(f" * {x}" for x in MIT.split("\n")) + "\n\n" + edge.passage(63, 400))]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.basis) for r in licenses.scan(files).filter("doc_id >= 100").collect()}
    assert got.pop(100)[0] == "MIT"
    assert got == {101: ("MIT", "inherited"), 102: ("MPL-2.0", "header"), 103: ("MIT", "header")}


def test_licences_of_odd_rows(spark, sf_small):
    rows = licenses.scan(edge.frame(spark).withColumn("path", F.col("source"))).collect()
    assert len(rows) == len(edge.texts())
    assert {r.doc_id for r in rows if r.basis == "header"} == {18}
    assert licenses.scan(edge.frame(spark, [])).count() == 0
    plan = queries.op2_license_inheritance(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
