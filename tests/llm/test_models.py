"""Trained operators: held-out accuracy, and their parts against brute force."""

import edge
import numpy as np
import pytest
from pyspark.sql import functions as F

from tonalyze.llm import byte_cnn, langid, quality_cnn, queries, toxicity
from tonalyze.llm.common import fold_of, table

SF = "/root/testdata/sf0.01"


def scores(spark, df, label, sf_dir=SF):
    labels = table(spark, sf_dir, "labels").select("doc_id", label)
    rows = df.join(labels, "doc_id").filter("held_out").collect()
    s, y = np.array([r.score for r in rows]), np.array([r[label] for r in rows])
    order = s.argsort().argsort()
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return s, y, (order[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * n0)


def test_quality_on_held_out_documents(spark):
    done = queries.op1_byte_cnn_quality(spark, SF).cache()
    assert done.count() == table(spark, SF, "documents").count()
    for r in done.collect():
        assert r.held_out == (fold_of(r.doc_id, 3) == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    s, y, auc = scores(spark, done, "quality")
    assert auc > 0.9 and ((s >= 0.5) == y).mean() > 0.88


def test_toxicity_on_held_out_documents(spark):
    done = queries.op6_weak_toxicity(spark, SF).cache()
    assert done.count() == table(spark, SF, "documents").count()
    for r in done.collect():
        assert r.held_out == (fold_of(r.doc_id, 5) == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    s, y, auc = scores(spark, done, "toxic")
    assert auc > 0.75 and (s[y == 0] < 0.5).mean() > 0.95


def test_language_on_held_out_documents(spark):
    done = queries.op8_segmentation_langid(spark, SF).cache()
    lang = table(spark, SF, "documents").select("doc_id", "lang")
    rows = done.join(lang, "doc_id").collect()
    assert len(rows) == lang.count()
    assert all(r.held_out == (fold_of(r.doc_id, 4) == 2) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) > 0.97


def test_chunks_cover_the_text():
    p = byte_cnn.NetParams(chunk=16, overlap=4)
    for n in (0, 1, 16, 17, 28, 29, 100):
        text = bytes(range(1, n + 1))
        own = byte_cnn.chunks(text, p)
        assert own.shape[1] == 16
        seen = set(own.ravel().tolist()) - {0}
        assert seen == set(text)
        for i in range(n - 4):      # every filter-wide window lies in one chunk
            assert any(text[i:i + 4] in c.tobytes() for c in own)


def test_gradients_equal_differences():
    p = byte_cnn.NetParams(filters=3, width=4, chunk=20, overlap=4, stride=2)
    net = byte_cnn.Net(p)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(0)
    drawn = [rng.integers(97, 105, (k, 20)).astype(np.uint8) for k in (1, 3, 2)]
    labels, weight = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        z = [net.w["tables"][0][c[:, 0:net.places * 2:2]] + sum(
            net.w["tables"][j][c[:, j:j + net.places * 2:2]] for j in range(1, 4)) for c in drawn]
        pools = np.concatenate([np.maximum(x.max(axis=1) + net.w["bias"], 0) for x in z])
        prob = net._combine(pools, np.array([0, 1, 4]))[2]
        return -(labels * np.log(prob) + (1 - labels) * np.log(1 - prob)).mean()

    grads = net._gradients(drawn, labels, weight)
    for name, at in [("mean", (1,)), ("max", (2,)), ("out", (0,)), ("bias", (1,)), ("tables", (2, 100, 1))]:
        eps, was = 1e-5, net.w[name][at]
        net.w[name][at] = was + eps
        up = loss()
        net.w[name][at] = was - eps
        down = loss()
        net.w[name][at] = was
        assert grads[name][at] == pytest.approx((up - down) / (2 * eps), abs=1e-4)


def test_joined_pairs_equal_single_places():
    net = byte_cnn.Net(byte_cnn.NetParams(filters=5))
    net.join_pairs()
    x = byte_cnn.chunks(edge.passage(1, 300).encode(), net.p)
    plain = sum(net.w["tables"][j][x[:, j:j + net.places * 2:2]] for j in range(net.p.width))
    assert np.allclose(net._convolve(x), plain, atol=1e-4)


def brute_probability(word, p, max_piece):
    total = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for size in range(1, min(max_piece, end) + 1):
            total[end] += total[end - size] * p.get(word[end - size:end], 0.0)
    return total[-1]


def test_forward_sums_all_segmentations():
    vocabulary = sorted({"▁", "a", "b", "c", "ab", "▁a", "abc", "bc", "▁ab"})
    lattice = langid.Lattice(vocabulary)
    rng = np.random.default_rng(1)
    values = np.zeros((len(vocabulary) + 2, 2))
    values[1:-1] = rng.random((len(vocabulary), 2))
    words = ["abc", "a", "cab", "abcabc", "bb"]
    for at, rows in langid._by_length(lattice, words):
        got = np.exp(lattice.forward(rows, values))
        for k, i in enumerate(at):
            for lang in range(2):
                p = {piece: values[n + 1, lang] for n, piece in enumerate(vocabulary)}
                assert got[k, lang] == pytest.approx(brute_probability("▁" + words[i], p, 3))


def test_long_words_are_scored_whole(monkeypatch):
    """Against exact fractions, over several blocks of columns and rescalings."""
    from fractions import Fraction
    from math import log
    vocabulary = sorted({"▁", "a", "b", "ab", "▁a", "aba", "bbab", "abbaab"})
    lattice = langid.Lattice(vocabulary)
    values = np.concatenate([[0.0], np.random.default_rng(3).random(len(vocabulary)) / 50, [1e-7]])
    p = {piece: Fraction(float(values[n + 1])) for n, piece in enumerate(vocabulary)} | {"z": Fraction(float(values[-1]))}
    words = ["".join("abz"[(i * i * 7 + k) % 3] if i % 41 == 0 else "ab"[(i * i + i // 3 + k) % 2] for i in range(700))
             for k in range(3)]
    monkeypatch.setattr(langid, "COLUMNS", 50)
    at, rows = next(langid._by_length(lattice, words))
    got = lattice.forward(rows, values[:, None])[:, 0]
    for k, i in enumerate(at):
        total = [Fraction(1)] + [Fraction(0)] * 701
        for end in range(1, 702):
            for size in range(1, min(6, end) + 1):
                total[end] += total[end - size] * p.get(("▁" + words[i])[end - size:end], 0)
        exact = log(total[-1].numerator) - log(total[-1].denominator)
        assert got[k] == pytest.approx(exact, rel=1e-9)


def test_every_piece_is_used_and_long_words_are_told_apart():
    import public_tokenizers
    import sentencepiece
    found = set(langid.pieces(langid.LangParams.vocabulary))
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(langid.LangParams.vocabulary))
    whole = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    assert {p for p in whole if p.removeprefix("▁").isalpha()} <= found and max(map(len, found)) > 12
    texts = ["x" * 100, "x" * 100 + " " + "x" * 99 + "y", "y" + "x" * 99, "ab ba"]
    codes, start, end, _ = langid._words(texts)
    first, inverse = langid._distinct(codes, start, end)
    assert len(first) == 5 and inverse[0] == inverse[1]


def test_expected_uses_match_differences():
    """d log P / d log p of a piece is its expected number of uses."""
    vocabulary = sorted({"▁", "a", "b", "ab", "▁a", "ba"})
    lattice = langid.Lattice(vocabulary)
    p = np.concatenate([[0.0], np.linspace(0.1, 0.6, len(vocabulary)), [0.0]])
    at, rows = next(langid._by_length(lattice, ["abab"]))
    uses = lattice.expected(rows, np.ones(1), p)
    for n in range(1, len(vocabulary) + 1):
        up, down = p.copy(), p.copy()
        up[n] *= 1 + 1e-6
        down[n] *= 1 - 1e-6
        logs = [lattice.forward(rows, q[:, None])[0, 0] for q in (up, down)]
        assert uses[n] == pytest.approx((logs[0] - logs[1]) / 2e-6, abs=1e-4)


def test_languages_of_odd_texts(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = langid.train(docs)
    got = {r.doc_id: r for r in langid.identify(edge.frame(spark), model).collect() if r.doc_id is not None}
    assert len(got) == len({i for i, _ in edge.texts() if i is not None})
    for i in (4, 5, 6, 21):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[10].lang_pred in model.langs and 0 < got[10].score <= 1
    assert langid.identify(edge.frame(spark, []), model).count() == 0
    assert langid.train(docs.filter("lang is null")) is None
    assert {r.lang_pred for r in langid.identify(edge.frame(spark), None).collect()} == {"und"}


def test_models_without_labels_and_odd_rows(spark):
    docs, n = edge.frame(spark), len(edge.texts())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_cnn.train(docs, none) is None
    assert {r.score for r in quality_cnn.classify(docs, None).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(23)] + [(3, None, None)],
                                   "doc_id long, quality int, toxic int")
    tiny = quality_cnn.QualityParams(net=byte_cnn.NetParams(filters=4, epochs=1))
    rows = quality_cnn.classify(docs, quality_cnn.train(docs, labels, tiny)).collect()
    assert len(rows) == n and all(0 <= r.score <= 1 for r in rows)
    for given in (none, labels):
        rows = toxicity.classify(docs, toxicity.train(docs, given)).collect()
        assert len(rows) == n and all(0 <= r.score <= 1 for r in rows)
    empty = edge.frame(spark, [])
    assert toxicity.classify(empty, toxicity.train(empty, none)).count() == 0


def test_labels_never_come_from_the_held_out_fold(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, toxic int")
    got = quality_cnn.labelled_sample(labels, "toxic", 5, 0, 1000).collect()
    assert {r.doc_id for r in got} == {i for i in range(300) if fold_of(i, 5) != 0}
    assert quality_cnn.labelled_sample(labels, "toxic", 5, 0, 10).count() == 10


def test_label_model_finds_accuracies_and_discounts_copies():
    """Votes drawn from known rates; a voter and its copies count about once."""
    rng = np.random.default_rng(2)
    toxic = rng.random(200_000) < 0.1
    rates = [(0.6, 0.01), (0.5, 0.02), (0.4, 0.005), (0.7, 0.05)]
    votes = np.stack([np.where(toxic, rng.random(len(toxic)) < a, rng.random(len(toxic)) < b) for a, b in rates], 1)
    votes = np.concatenate([votes, votes[:, 3:4], votes.any(axis=1)[:, None]], axis=1).astype(float)
    whole = np.concatenate([votes, np.ones((len(votes), 1))], axis=1)
    model = toxicity.fit_label_model(whole.T @ whole, 0.1)
    for j, (a, b) in enumerate(rates[:3]):
        assert model.precision[j] == pytest.approx(0.1 * a / (0.1 * a + 0.9 * b), abs=0.12)
    assert model.correlation[3, 4] > 0.3 > model.correlation[0, 1]
    one, both = np.zeros((1, 6)), np.zeros((1, 6))
    one[0, [3, 5]] = both[0, [3, 4, 5]] = 1
    odds = [np.log(p / (1 - p)) - model.prior for p in (model.posterior(one)[0], model.posterior(both)[0])]
    assert odds[1] < 1.7 * odds[0]
    assert model.posterior(np.zeros((1, 6)))[0] < 0.1


def test_moments_cover_every_text(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    voters = toxicity.Voters([toxicity.term_hash(w) for w in toxicity.LEXICON], 5)
    from tonalyze.llm.common import map_arrow
    sums = map_arrow(docs.repartition(3).select("text"), lambda x: toxicity._moments(x, voters),
                     "i long, j long, s long").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    n = {(r.i, r.j): r.s for r in sums}[(voters.n, voters.n)]
    assert n == docs.count()
    any_hit = {(r.i, r.j): r.s for r in sums}[(voters.n - 1, voters.n)]
    want = sum(any(w in toxicity.LEXICON for w in edge.ALNUM.findall(edge.lower(r.text))) for r in docs.collect())
    assert any_hit == want


def test_every_operator_and_the_pipeline_are_registered():
    import os
    import sys
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
    assert "op5_quality_rules" in entry.oracle_sql()
