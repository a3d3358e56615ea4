"""Toxicity by weak supervision.

1. Voters.  Lexicon terms (a fixed list, and word beginnings mined from
   labelled documents of the training fold) are dealt into ``slices``
   lexicon voters; pattern voters look at several hits, hits per word,
   shouting and repeated exclamation marks.  Each votes toxic or abstains;
   a text without any lexicon hit is a vote for clean.
2. Label model.  One pass over all documents sums the votes and their
   products (a small matrix, aggregated map-side).  With voters that err
   independently, cov(i, j) = p (1 - p) d_i d_j, where d_i = P(vote | toxic) -
   P(vote | clean): d_i follows from triplets of covariances (median over
   all of them), which needs no label, and gives each voter's accuracy.
   What the covariances hold beyond that are the correlations of the
   voters; in the posterior the log odds of a vote are divided by its
   correlation with the other votes cast, so that voters that repeat each
   other count once.
3. Classifier.  A logistic regression over hashed words and word beginnings
   is fitted to the posterior labels of a sample of documents of the
   training fold, and scores every whole text.

Bounded samples (documented parameters): ``mine_docs`` labelled documents
for the lexicon and the share of toxic ones, ``train_docs`` documents for
the classifier.  The votes are counted over all documents.

Defined results
    null or empty text    no words: the classifier's bias alone
    very long text        read whole
    repeated rows, ties   each row by itself
    no labelled row       the fixed lexicon alone, 5 % taken as toxic
    empty table           empty result
    clashing columns      only id and text are read
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalyze.llm import words as W
from tonalyze.llm.common import field, fold, map_arrow, saved, slices, utf8
from tonalyze.llm.quality_cnn import labelled_sample

# Common insults.
LEXICON = ["asshole", "bastard", "bitch", "clown", "coward", "creep", "cretin", "degenerate", "disgusting",
           "dumb", "fool", "freak", "garbage", "idiot", "imbecile", "jerk", "liar", "loser", "lowlife",
           "moron", "pathetic", "pig", "scum", "stupid", "trash", "ugly", "vermin", "worthless"]
WHOLE = 0                      # a term of this length is a whole word


@dataclass(frozen=True)
class ToxicParams:
    slices: int = 12
    beginnings: tuple[int, ...] = (4, 5, 6, 7, 8, 10)      # bytes of a mined term
    features: tuple[int, ...] = (0, 4, 6, 8)               # bytes hashed (0: the whole word)
    mine_docs: int = 8000
    mine_precision: float = 0.93
    mine_terms: int = 600
    train_docs: int = 8000
    bits: int = 18               # of hashed features
    feature_support: int = 5     # documents of the sample that hold a feature
    epochs: int = 24
    toxic_weight: float = 1.0
    rate: float = 0.3
    decay: float = 1e-5
    modulus: int = 5             # folds by crc32 of the id
    held_out: int = 0


class Voters:
    """Lexicon terms as (length in bytes, hash), dealt into voters; then the
    pattern voters, and last whether any lexicon term was hit."""
    PATTERNS = 5

    def __init__(self, terms: list[tuple[int, int]], slices_: int):
        self.n_lexicon = slices_
        self.tables = []
        for k in sorted({k for k, _ in terms}):
            own = [(np.uint64(h), i % slices_, i) for i, (j, h) in enumerate(terms) if j == k]
            own.sort(key=lambda x: x[0])
            self.tables.append((k, np.array([o[0] for o in own], np.uint64),
                                np.array([o[1] for o in own]), np.array([o[2] for o in own])))

    @property
    def n(self) -> int:
        return self.n_lexicon + self.PATTERNS

    def votes(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, voters) of 0 and 1."""
        n = len(offsets) - 1
        out = np.zeros((n, self.n), np.int8)
        hits = []
        for k, hashes, slice_, term in self.tables:
            words = W.split(data, offsets, W.PUNCTUATION, prefix=k or None)
            at = np.minimum(np.searchsorted(hashes, words.hash), len(hashes) - 1)
            found = np.flatnonzero(hashes[at] == words.hash)
            text = np.searchsorted(words.row, found, side="right") - 1
            out[text, slice_[at[found]]] = 1
            hits.append(np.stack([text, term[at[found]]], axis=1))
            n_words = np.diff(words.row)
        hits = np.concatenate(hits) if hits else np.empty((0, 2), int)
        total = np.bincount(hits[:, 0], minlength=n)
        distinct = np.bincount(np.unique(hits, axis=0)[:, 0], minlength=n) if len(hits) else total
        csum = lambda mask: np.concatenate([[0], np.cumsum(mask)])
        upper, marks = csum((data >= 65) & (data <= 90)), csum(data[1:] * (data[:-1] == 33) == 33)
        size = np.maximum(np.diff(offsets), 1)
        last = np.minimum(offsets, max(0, len(data) - 1))
        out[:, -5] = distinct >= 2
        out[:, -4] = (total > 0) & (100 * total >= n_words)
        out[:, -3] = 10 * (upper[offsets[1:]] - upper[offsets[:-1]]) > 3 * size
        out[:, -2] = (marks[last[1:]] - marks[last[:-1]]) >= 3 if len(data) else 0
        out[:, -1] = total > 0
        return out


def term_hash(word: str) -> tuple[int, int]:
    words = W.split(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())]), W.PUNCTUATION)
    return WHOLE, int(words.hash[0])


def _mine(batches: Iterator[pa.RecordBatch], params: ToxicParams) -> Iterator[pa.RecordBatch]:
    """(length, hash, parent hash, label, n): beginnings of a text's words."""
    for whole in batches:
        for batch in slices(whole):
            data, offsets = utf8(field(batch, "text"))
            labels = field(batch, "label").to_numpy(zero_copy_only=False)
            for k in params.beginnings:
                words = W.split(data, offsets, W.PUNCTUATION, prefix=k)
                shorter = W.split(data, offsets, W.PUNCTUATION, prefix=k - 1).hash
                long = np.flatnonzero(words.end - words.start >= k)
                text = np.searchsorted(words.row, long, side="right") - 1
                keys = np.stack([text.astype(np.uint64), words.hash[long], shorter[long]], axis=1)
                _, first = np.unique(keys[:, 0] * W.MULTIPLIER ^ keys[:, 1], return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), k, np.int32)), pa.array(keys[first, 1].view(np.int64)),
                     pa.array(keys[first, 2].view(np.int64)), pa.array(labels[text[first]].astype(np.int32))],
                    names=["k", "hash", "parent", "label"])


def find_terms(docs: DataFrame, labels: DataFrame, params: ToxicParams) -> tuple[list[tuple[int, int]], float]:
    """(lexicon terms, share of toxic documents) from the labelled sample."""
    sample = labelled_sample(labels, "toxic", params.modulus, params.held_out, params.mine_docs).cache()
    share = sample.agg(F.avg("label")).first()[0]
    fixed = [term_hash(w) for w in LEXICON]
    if share is None:
        sample.unpersist()
        return fixed, 0.05
    # at most mine_docs rows of two numbers
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
             .select(F.col("label").cast("int").alias("label"), "text"))
    counts = (map_arrow(texts, lambda x: _mine(x, params), "k int, hash long, parent long, label int")
              .groupBy("k", "hash", "parent").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")))
    # a term must be less likely a chance find than one in ten among all tried:
    # n KL(share of toxic || base rate) > ln(10 * terms tried)
    counts = saved(counts.filter("n >= 3"), "toxic-terms")
    tried = counts.count()
    rate = F.lit(float(share))
    part = F.col("toxic") / F.col("n")
    evidence = (F.col("toxic") * F.ln(part / rate)
                + F.coalesce((F.col("n") - F.col("toxic")) * F.ln((1 - part) / (1 - rate)), F.lit(0.0)))
    good = (counts.filter((part >= params.mine_precision) & (evidence > float(np.log(10 * max(1, tried)))))
            .orderBy(F.desc("toxic"), "k", "hash").limit(10 * params.mine_terms).collect())
    sample.unpersist()
    known, terms = {}, []
    for r in sorted(good, key=lambda r: (r["k"], -r["toxic"], r["hash"])):
        known[(r["k"], r["hash"])] = r["toxic"]
        if known.get((r["k"] - 1, r["parent"]), 0) < r["toxic"]:    # its shorter beginning says the same
            terms.append((r["toxic"], r["k"], r["hash"]))
    terms.sort(key=lambda t: (-t[0], t[1], t[2]))
    mined = [(k, h & (2**64 - 1)) for _, k, h in terms[:params.mine_terms]]
    return fixed + mined, float(min(max(share, 0.005), 0.5))


def _moments(batches: Iterator[pa.RecordBatch], voters: Voters) -> Iterator[pa.RecordBatch]:
    """Sums of vote products of a whole partition; row n counts the texts."""
    n = voters.n
    total = np.zeros((n + 1, n + 1), np.int64)
    for whole in batches:
        for batch in slices(whole):
            votes = voters.votes(*utf8(field(batch, "text"))).astype(np.float64)
            votes = np.concatenate([votes, np.ones((len(votes), 1))], axis=1)
            total += (votes.T @ votes).astype(np.int64)
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays([pa.array(x.ravel().astype(np.int64)) for x in (i, j, total)],
                                     names=["i", "j", "s"])


@dataclass
class LabelModel:
    precision: np.ndarray         # P(toxic | vote)
    correlation: np.ndarray       # of the votes, beyond what the class explains
    weight: np.ndarray            # log odds a vote adds
    clean: float                  # log odds that no lexicon hit adds
    prior: float                  # log odds

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        shared = np.maximum(self.correlation - np.eye(len(self.weight)), 0)
        odds = (votes * self.weight / (1 + votes @ shared)).sum(axis=1)
        odds += self.prior + self.clean * (votes[:, -1] == 0)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _log_odds(p):
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def fit_label_model(moments: np.ndarray, share: float) -> LabelModel:
    """From sums of products (last row: sums, last entry: number of texts)."""
    n = len(moments) - 1
    total = max(float(moments[n, n]), 1.0)
    mean = moments[n, :n] / total
    cov = moments[:n, :n] / total - np.outer(mean, mean)
    pq = share * (1 - share)
    d = np.zeros(n)
    for i in range(n):
        found = [cov[i, j] * cov[i, k] / cov[j, k]
                 for j in range(n) for k in range(j + 1, n)
                 if i not in (j, k) and cov[i, j] > 0 and cov[i, k] > 0 and cov[j, k] > 1e-9]
        if found:       # no larger than if every vote were right
            d[i] = min(np.sqrt(np.median(found) / pq), mean[i] / share, 1.0)
    within = cov - pq * np.outer(d, d)
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    correlation = np.clip(within / np.outer(scale, scale), -1, 1)
    np.fill_diagonal(correlation, 1.0)
    toxic = np.clip(mean + (1 - share) * d, 0, 1)          # P(vote | toxic)
    precision = np.where(mean > 0, share * toxic / np.maximum(mean, 1e-12), share)
    weight = _log_odds(precision) - _log_odds(share)
    weight[-1] = 0.0                                       # speaks by its absence
    none = share * (1 - toxic[-1]) / max(1 - mean[-1], 1e-9)
    return LabelModel(precision, correlation, weight, float(min(0.0, _log_odds(none) - _log_odds(share))),
                      float(_log_odds(share)))


def features(data: np.ndarray, offsets: np.ndarray, bits: int,
             lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(bounds per text, distinct hashed words and word beginnings)."""
    keys = []
    for k in lengths:
        words = W.split(data, offsets, W.PUNCTUATION, prefix=k or None)
        hashed = words.hash
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(words.row))
        if k:
            longer = np.flatnonzero(words.end - words.start > k)
            hashed, text = W.mix(hashed[longer] ^ np.uint64(k)), text[longer]
        keys.append((text.astype(np.uint64) << np.uint64(bits)) | (hashed >> np.uint64(64 - bits)))
    keys = np.unique(np.concatenate(keys))
    of = (keys >> np.uint64(bits)).astype(np.int64)
    return np.searchsorted(of, np.arange(len(offsets))), (keys & np.uint64((1 << bits) - 1)).astype(np.int64)


@dataclass
class Linear:
    weight: np.ndarray
    bias: float
    params: ToxicParams

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        bounds, index = features(data, offsets, self.params.bits, self.params.features)
        total = np.concatenate([[0.0], np.cumsum(self.weight[index])])
        return 1 / (1 + np.exp(-np.clip(total[bounds[1:]] - total[bounds[:-1]] + self.bias, -30, 30)))


def fit_linear(rows: list[np.ndarray], target: np.ndarray, params: ToxicParams) -> Linear:
    """Logistic regression on soft labels by AdaGrad, features seen in too few
    documents left out."""
    size = 1 << params.bits
    seen = np.bincount(np.concatenate([*rows, np.empty(0, np.int32)]), minlength=size)
    rows = [r[seen[r] >= params.feature_support] for r in rows]
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3)) if len(target) else 0.05
    weight, bias = np.zeros(size), float(np.log(share / (1 - share)))
    squares, bias_squares = np.full(size, 1e-2), 1e-2
    rng = np.random.Generator(np.random.PCG64(9))
    for _ in range(params.epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            batch = order[at:at + 64]
            counts = [len(rows[r]) for r in batch]
            index = np.concatenate([rows[r] for r in batch])
            text = np.repeat(np.arange(len(batch)), counts)
            z = np.bincount(text, weight[index], minlength=len(batch)) + bias
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[batch]) / len(batch)
            g *= 1 + (params.toxic_weight - 1) * target[batch]
            used, inverse = np.unique(index, return_inverse=True)
            step = np.bincount(inverse, g[text], minlength=len(used)) + params.decay * weight[used]
            squares[used] += step * step
            weight[used] -= params.rate * step / np.sqrt(squares[used])
            bias_squares += g.sum() ** 2
            bias -= params.rate * g.sum() / np.sqrt(bias_squares)
    return Linear(weight, bias, params)


def _examples(batches: Iterator[pa.RecordBatch], voters: Voters, model: LabelModel,
              params: ToxicParams) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            data, offsets = utf8(field(batch, "text"))
            target = model.posterior(voters.votes(data, offsets).astype(float))
            bounds, index = features(data, offsets, params.bits, params.features)
            rows = [index[bounds[i]:bounds[i + 1]].astype("<i4").tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(target), pa.array(rows, pa.binary())],
                                             names=["target", "features"])


@dataclass
class ToxicModel:
    label_model: LabelModel
    linear: Linear


def train(docs: DataFrame, labels: DataFrame, params: ToxicParams = ToxicParams()) -> ToxicModel:
    spark = docs.sparkSession
    terms, share = find_terms(docs, labels, params)
    voters = Voters(terms, params.slices)
    shared = spark.sparkContext.broadcast(voters)
    sums = (map_arrow(docs.select("text"), lambda x: _moments(x, shared.value), "i long, j long, s long")
            .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    moments = np.zeros((voters.n + 1, voters.n + 1))
    for r in sums:
        moments[r["i"], r["j"]] = r["s"]
    model = fit_label_model(moments, share)
    pool = docs.filter(fold(F.col("doc_id"), params.modulus) != params.held_out)
    chance = min(1.0, params.train_docs / max(1, pool.select("doc_id").count()))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 24)) / float(1 << 24)
    shared_model = spark.sparkContext.broadcast(model)
    rows = map_arrow(pool.filter(draw < chance).select("text"),
                     lambda x: _examples(x, shared.value, shared_model.value, params),
                     "target double, features binary").collect()
    rows.sort(key=lambda r: (r["target"], bytes(r["features"])))    # any order of partitions
    linear = fit_linear([np.frombuffer(r["features"], "<i4") for r in rows],
                        np.array([r["target"] for r in rows]), params)
    return ToxicModel(model, linear)


def _score(batches: Iterator[pa.RecordBatch], linear: Linear) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            yield pa.RecordBatch.from_arrays(
                [field(batch, "doc_id"), pa.array(linear.score(*utf8(field(batch, "text"))))],
                names=["doc_id", "score"])


def classify(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score and predicted (score >= 0.5) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.linear)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_arrow(docs.select("doc_id", "text"), lambda x: _score(x, shared.value),
                       f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
