"""The filter audit against documents followed through every order."""

import collections
import itertools
import re

import edge
import numpy as np
from oracle_compare import compare

from tonalyze.llm import filter_audit
from tonalyze.llm.common import table


def brute_audit(rows, labels):
    """rows: (doc_id, text, source); labels: doc_id -> (good, toxic)."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    failing = []
    for i, text, source in rows:
        text = text or ""
        words = edge.SPACED.findall(text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and least[text] < i}
        failing.append((source or "", "".join(c for c in "ABCDE" if fails[c]), *labels.get(i, (0, 0))))
    out = {}
    for part in {p for p, *_ in failing}:
        mine = [x for x in failing if x[0] == part]
        taken = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                taken[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == f for x in mine),
                    sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for key in out:
            if key[0] == part:
                out[key].append(taken[key[1][key[2] - 1]])
    return out


def got(df):
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                                r.toxic_lost, r.shapley] for r in rows}
    assert len(found) == len(rows)
    return found


def test_odd_rows_equal_brute_force(spark):
    long = edge.passage(50, 400)
    rows = [(i, t, "src" if (i or 0) % 2 else None) for i, t in edge.texts()]
    rows += [(200 + k, long if k % 3 else long + f" {k}", "hot") for k in range(40)]
    rows += [(300, long + " #", "hot"), (301, (long + " ") * 3, "hot"), (302, long.upper(), "other"), (None, long, "hot")]
    schema = edge.SCHEMA
    docs = spark.createDataFrame([(i, t, "en", s, 0, *["clash"] * len(edge.CLASH)) for i, t, s in rows], schema)
    marks = [(i, int(i % 2), int(i % 5 == 0)) for i, *_ in rows if i is not None and i % 3 == 0]
    given = spark.createDataFrame([*marks, (201, None, 1), (201, 1, None), (None, 1, 1)],
                                  "doc_id long, quality int, toxic int")
    labels = {i: (q, t) for i, q, t in marks} | {201: (1, 1)}
    assert got(filter_audit.audit(docs, given)) == brute_audit(rows, labels)


def test_an_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(edge.frame(spark, []), labels).count() == 0


def test_query_equals_its_sql(spark, sf_small):
    assert compare(spark, sf_small, ["op12_filter_audit"])["op12_filter_audit"]["ok"]


def test_given_documents_equal_brute_force(spark, sf_small):
    rows = [(r.doc_id, r.text, r.source) for r in table(spark, sf_small, "documents").collect()]
    labels = {r.doc_id: (int(r.quality == 1), int(r.toxic == 1)) for r in table(spark, sf_small, "labels").collect()}
    found = filter_audit.audit(table(spark, sf_small, "documents"), table(spark, sf_small, "labels"))
    assert got(found) == brute_audit(rows, labels)


def test_ranks_and_intervals():
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    assert [filter_audit.lehmer_rank(o, "ABCDE") for o in orders] == list(range(120))
    counts = np.ones((1, 32, 1), np.int64)
    removed = filter_audit.removed_by_rank(counts, "ABCDE")[0, :, :, 0]
    # 16 masks hold the first filter, 8 of the rest the second, ...
    assert (removed == [16, 8, 4, 2, 1]).all()
