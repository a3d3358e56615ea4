"""Suffix arrays and exact substring dedup against plain Python."""

import collections
import hashlib
import random

import edge
import numpy as np
import pytest

from tonalyze.llm import queries, suffix_array, suffix_dedup
from tonalyze.llm.common import table


def brute(rows, width):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) of each row."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(hashlib.md5(t[k:k + width]).digest() for _, t in texts for k in range(len(t) - width + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, np.int64)
        for k in range(len(t) - width + 1):
            if seen[hashlib.md5(t[k:k + width]).digest()] > 1:
                gone[k] += 1
                gone[k + width] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((i, len(t), int(gone.sum()), int(np.count_nonzero(np.diff(np.append(0, gone.astype(int))) == 1)),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def run(docs, params=suffix_dedup.SuffixParams()):
    rows = suffix_dedup.remove_repeats(docs, params).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed == r.n_bytes - len(r.kept)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows]
    return sorted(got, key=lambda r: (r[0] is not None, r))


def odd_rows():
    shared = edge.passage(70, 90)
    rows = edge.texts() + [(400 + k, f"{edge.passage(80 + k, k)} {shared} {edge.passage(180 + k, 30)}") for k in range(30)]
    rows += [(500, "ab" * 1500), (501, "x" * 399), (502, "y" * 400), (503, "z" * 401), (504, shared[:399]), (505, shared[:400]),
             (506, "é" * 250), (507, "é" * 150 + shared + "ü" * 150), (508, edge.passage(9, 200) + shared[:450] + shared[:420])]
    return rows


def test_odd_rows_equal_brute_force(spark):
    rows = odd_rows()
    assert run(edge.frame(spark, rows)) == brute(rows, 400)


def test_query_equals_brute_force(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_small, "documents").collect()]
    got = queries.op11_suffix_dedup(spark, sf_small).collect()
    assert sorted(map(tuple, got)) == brute(rows, 400)


@pytest.mark.parametrize("blocks", [(4, 1), (16, 1), (1,)])
def test_shared_passages_are_cut_into_blocks(spark, blocks):
    """Keys with more different segments than a shard takes, small blocks of
    text, short strings of few symbols."""
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdef ") for _ in range(160))
    rows = []
    for i in range(120):
        own = "".join(rng.choice("abcdef ") for _ in range(rng.randrange(60)))
        rows.append((i, own + passage[rng.randrange(40):160 - rng.randrange(40)] + own[::-1]))
    rows += [(200, "abc" * 100), (201, "abc" * 30 + passage), (202, "é" * 120 + passage * 3), (203, passage), (203, passage)]
    docs = edge.frame(spark, rows)
    params = suffix_dedup.SuffixParams(width=40, gram=8, block_bytes=300, shard_bytes=2000, key_segments=5, blocks=blocks)
    assert run(docs, params) == brute(rows, 40)


def test_an_empty_table(spark):
    assert suffix_dedup.remove_repeats(edge.frame(spark, [])).count() == 0


def test_a_long_blank_text(spark):
    rows = [(1, " " * 3_000_000), (2, "a" + " " * 1000 + "b")]
    got = run(edge.frame(spark, rows))
    assert [r[:4] for r in got] == [(1, 3_000_000, 3_000_000, 1), (2, 1002, 1000, 1)]


def test_suffix_arrays_equal_sorted_suffixes():
    rng = np.random.default_rng(0)
    for k in range(400):
        text = rng.integers(1, rng.integers(2, 6), rng.integers(1, 120)).astype(np.uint16)
        if k % 5 == 0:
            text = np.resize(text[:rng.integers(1, 6)], len(text))
        text = np.append(text, np.uint16(0)).astype(np.uint16)
        raw = text.astype(">u2").tobytes()
        array = suffix_array.suffix_array(text, 6)
        assert array.tolist() == sorted(range(len(text)), key=lambda i: raw[2 * i:])
        common = suffix_array.permuted_prefixes(text, array)
        for a, b in zip(array[:-1].tolist(), array[1:].tolist()):
            n = 0
            while text[a + n] == text[b + n]:
                n += 1
            assert common[b] == n
