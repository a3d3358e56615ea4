"""Fill-in-the-middle and its rank index against plain Python."""

import hashlib
import re

import edge
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_compare import compare

from tonalyze.llm import fim, queries, rank_index
from tonalyze.llm.common import table

TOKEN = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    units = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_rows():
    extra = [(100 + k, t) for k, t in enumerate(
        [" ", "\n\n a", "a ", "ab\x0c\x0bcd \t", "<P>x y z", "x <S> y", "a <M", "< P> <S <M> <", "ñ   x y z", "\x00 \x1c a"])]
    many = [(1000 + k, edge.passage(k, k % 23) + " " * (k % 3)) for k in range(150)]
    return edge.texts() + extra + many + [(2000, " " * 300000 + "x"), (2001, "é" * 200000), (2002, "a " * 150000)]


def test_rows_equal_brute_force(spark, sf_small):
    given_rows = [(r.doc_id, r.text) for r in table(spark, sf_small, "documents").collect()]
    for rows, docs in ((odd_rows(), edge.frame(spark, odd_rows())), (given_rows, table(spark, sf_small, "documents"))):
        key = lambda x: tuple((v is not None, v) for v in x)
        made = fim.transform(docs)
        got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()), key=key)
        assert got == sorted((brute(*r) for r in rows), key=key)
        got = sorted(map(tuple, fim.digests(made).collect()), key=key)
        want = sorted(((*(b := brute(i, t))[:5], sha(b[5]), sha(t or "")) for i, t in rows), key=key)
        assert got == want


def test_an_empty_table(spark):
    assert fim.digests(fim.transform(edge.frame(spark, []))).count() == 0


def test_query_equals_its_sql(spark, sf_small):
    assert compare(spark, sf_small, ["op13_fill_in_middle"])["op13_fill_in_middle"]["ok"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 400), max_size=400), st.integers(1, 50))
def test_index_is_exact_and_bounded(steps, error):
    y = np.concatenate([[0], np.cumsum(np.array(steps, np.int64))]).astype(np.int64)
    index = rank_index.fit(y, error)
    ranks = np.arange(len(y))
    assert (index.offset(ranks) == y).all()
    assert np.abs(index.residual).max() <= error + 1


def test_segments_are_few():
    y = np.cumsum(np.random.default_rng(1).integers(2, 12, 200_000))
    index = rank_index.fit(y, 32)
    assert len(index.first) < 2_000
    even = rank_index.fit(np.arange(0, 5_000_000, 7), 8)
    assert len(even.first) == 1 and not even.residual.any()
