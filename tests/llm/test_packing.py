"""Packing: pieces and places against the contract, ids against `tokenizers`."""

import collections
import zlib

import edge
import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tonalyze.llm import packing
from tonalyze.llm.common import table

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check_pieces(rows, texts, capacity=1024):
    """texts: (id, text) of every document."""
    want = collections.Counter()
    for i, text in texts:
        ids = np.array(ids_of(text), "<u4")
        assert packing.cut(len(ids), capacity)[0][0] == 0
        for piece, (start, n) in enumerate(packing.cut(len(ids), capacity)):
            want[(i, piece, start, n, zlib.crc32(ids[start:start + n].tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    return len(sequences), sum(r.length for r in rows)


def test_packing_of_the_documents(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    n, tokens = check_pieces(packing.pack(docs.repartition(9)).collect(), texts)
    assert n <= 1.02 * -(-tokens // 1024) + 1


def test_tree_of_several_levels(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    params = packing.PackParams(fan_in=2, max_items=7)
    check_pieces(packing.pack(docs.repartition(9), params).collect(), texts)


def test_more_underfull_sequences_than_a_node_holds(spark):
    """Long and short documents lie in different partitions: the halves that
    fill each other meet although no node may hold more than 60 pieces."""
    word = " the"
    texts = [(i, word * (590 if i < 300 else 410)) for i in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).repartitionByRange(8, "doc_id")
    params = packing.PackParams(fan_in=4, max_items=60, nearly_full=1000)
    rows = packing.pack(docs, params).collect()
    n, tokens = check_pieces(rows, texts)
    assert len({r.sequence_id for r in rows if r.doc_id < 300}) == 300      # two of them never fit
    assert n <= 315, n


def test_odd_rows_and_special_strings(spark):
    rows = [*edge.texts(), (50, "a <|endoftext|> b"), (51, "<|endoftext|>"), (52, "x" * 20000)]
    check_pieces(packing.pack(edge.frame(spark, rows)).collect(), rows)
    assert packing.pack(edge.frame(spark, [])).count() == 0


def test_ids_travel_with_their_pieces(spark):
    rows = [(i, edge.passage(i, 900)) for i in range(6)]
    done = packing.pack(edge.frame(spark, rows).repartition(3), with_ids=True).collect()
    for r in done:
        ids = ids_of(dict(rows)[r.doc_id])
        assert list(r.ids) == ids[r.start:r.start + r.length]


@settings(max_examples=60, deadline=None)
@given(st.text())
def test_ids_equal_those_of_the_tokenizers_library(text):
    encode = packing._encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    assert encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_best_fit_is_best_fit(lengths):
    bins, offsets, fill = packing.best_fit(np.array(lengths, np.int64), 100)
    want: list[int] = []
    for n in sorted(lengths, reverse=True):
        open_ = [b for b in range(len(want)) if want[b] + n <= 100]
        if open_:
            want[max(open_, key=lambda b: want[b])] += n
        else:
            want.append(n)
    assert sorted(fill) == sorted(want)
    used = collections.Counter()
    for b, n in zip(bins, lengths):
        used[b] += n
    assert [used[b] for b in range(len(fill))] == fill


def test_long_runs_of_blanks(spark):
    rows = [(1, "x" + " " * 1_000_000 + "y"), (2, "\n" * 1_000_000), (3, " " * 99_999 + "a"), (4, "b " * 60_000), (5, "\t" * 3_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_pieces(packing.pack(docs).collect(), rows)
