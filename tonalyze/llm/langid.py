"""Language ID: unigrams over a public vocabulary, marginalised over all
segmentations.

A text's words are its runs of letters, lower-cased.  A word, with the
vocabulary's word-start mark before it, can be cut into vocabulary pieces in
many ways; its probability in a language is the sum over all of them of the
product of the language's piece probabilities.  The forward algorithm gives
that sum in one pass over the word.  Piece probabilities are learned by
expectation maximisation (forward and backward) from word counts of
labelled training documents.  A document's score for a language is the sum of
the log probabilities of its words; the posterior over languages is the
reported score.

Distinct words of a slice of texts are scored once, all at a time in numpy.
A word of any length is scored whole: only as many positions as the longest
piece has symbols are held, and they are rescaled as the word goes on.

Training reads a bounded sample: about ``docs_per_lang`` documents of each
language, chosen by a hash of their id, and of these the ``words_per_lang``
most frequent words of each language of at most ``learn_letters`` letters.
Scoring reads every whole text with every piece of the vocabulary.

Defined results
    null text, no letter      ``und`` with score 0
    very long text or word    read whole (a word of 100,000 letters takes about
                              6 seconds of its task)
    null lang                 not learned from; still scored
    ties                      the language that sorts first
    no labelled document      every text is ``und`` with score 0
    empty table               empty result
    clashing columns          only id and text are read
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonalyze.llm import words as W
from tonalyze.llm.common import field, fold, map_arrow, slices

UNDETERMINED = "und"
START = "▁"             # the vocabulary's word-start mark
BASE = np.uint64(0x9E3779B97F4A7C15)
COLUMNS = 512           # positions of a word whose pieces are looked up at a time
RESCALE = 16            # positions between rescalings
CELLS = 400_000         # rows times columns, and rows times languages, of a step


@dataclass(frozen=True)
class LangParams:
    vocabulary: str = "piece_bpe_32k.model"
    docs_per_lang: int = 800
    words_per_lang: int = 60_000
    learn_letters: int = 32       # longer words are scored but not learned from
    rounds: int = 4
    floor: float = 1e-7           # smallest probability of a single symbol
    modulus: int = 4              # folds by crc32 of the id
    held_out: int = 2


def pieces(vocabulary: str) -> list[str]:
    """Lower-cased pieces of letters, the mark only in front."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    found = set()
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).lower()
        if piece == START or piece.removeprefix(START).isalpha():
            found.add(piece)
    singles = {c for p in found for c in p}
    return sorted(found | singles)


@functools.lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


class Table:
    """64-bit keys to numbers 1, 2, ... (0: absent), for arrays of keys: a
    first slot per key, and a second table for those that collide there."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(10, int(len(keys) * 8).bit_length())
        numbers = np.arange(1, len(keys) + 1, dtype=np.int32)
        for seed in range(1000):
            self.first, self.second = W._random64(2, 7000 + seed)
            self.keys1, self.ids1, left = self._fill(keys, numbers, self.first)
            self.keys2, self.ids2, left = self._fill(keys[left], numbers[left], self.second)
            if not len(left):
                return
        raise ValueError("no table for these keys")

    def _slot(self, keys: np.ndarray, multiplier: np.uint64) -> np.ndarray:
        return (keys * multiplier) >> np.uint64(64 - self.bits)

    def _fill(self, keys, numbers, multiplier):
        slots = self._slot(keys, multiplier)
        _, first = np.unique(slots, return_index=True)
        table, ids = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        table[slots[first]], ids[slots[first]] = keys[first], numbers[first]
        return table, ids, np.setdiff1d(np.arange(len(keys)), first)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys, self.first)
        found = np.where(self.keys1[slot] == keys, self.ids1[slot], 0)
        slot = self._slot(keys, self.second)
        return np.where(self.keys2[slot] == keys, self.ids2[slot], found)


class Lattice:
    """All segmentations of words (rows of symbol ids of one length)."""

    def __init__(self, vocabulary: list[str]):
        symbols = sorted({c for p in vocabulary for c in p})
        self.symbol = np.zeros(0x110000, np.uint64)       # 0: a letter no piece has
        for n, c in enumerate(symbols):
            self.symbol[ord(c)] = n + 1
        self.vocabulary = vocabulary
        self.max_piece = max(map(len, vocabulary))
        keys = []
        for p in vocabulary:
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for c in p:
                    h = h * BASE + self.symbol[ord(c)] + np.uint64(1)
            keys.append(h)
        self.table = Table(np.array(keys, np.uint64))
        self.unknown = len(vocabulary) + 1                # number of the piece of an unknown letter

    def numbers(self, rows: np.ndarray) -> np.ndarray:
        """Number of the piece of each size that ends at each column (0: none),
        as (size - 1, row, column); a single letter always has one."""
        n, length = rows.shape
        out = np.zeros((self.max_piece, n, length), np.int32)
        s = rows + np.uint64(1)
        keys = s
        for size in range(1, min(self.max_piece, length) + 1):
            if size > 1:
                keys = keys[:, :-1] * BASE + s[:, size - 1:]
            out[size - 1, :, size - 1:] = self.table(keys)
        out[0][out[0] == 0] = self.unknown
        return out

    def arcs(self, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(end, piece length, rows that have it, piece numbers) by rising end."""
        numbers = self.numbers(rows)
        some = numbers.any(axis=1)
        for end in range(1, rows.shape[1] + 1):
            for size in np.flatnonzero(some[:, end - 1]) + 1:
                ids = numbers[size - 1, :, end - 1]
                has = np.flatnonzero(ids)
                yield end, size, has, ids[has]

    def forward(self, rows: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Log probability of each word, per column of ``p`` (piece number, language)."""
        n, length = rows.shape
        m = self.max_piece
        alpha = np.zeros((m + 1, n, p.shape[1]))           # the last positions, in a ring
        alpha[0] = 1.0
        logs = np.zeros((n, p.shape[1]))
        for begin in range(0, length, COLUMNS):
            head = max(0, begin - m + 1)
            block = rows[:, head:begin + COLUMNS]
            for end, size, has, ids in self.arcs(block):
                at = head + end
                if at <= begin:                            # of the block before
                    continue
                here = alpha[at % (m + 1)]
                if size == 1:
                    if at % RESCALE == 0:
                        top = np.delete(alpha, at % (m + 1), axis=0).max(axis=0)
                        alpha /= top
                        logs += np.log(top)
                    here[:] = alpha[(at - 1) % (m + 1)] * p[ids]
                elif len(has) == n:
                    here += alpha[(at - size) % (m + 1)] * p[ids]
                else:
                    here[has] += alpha[(at - size) % (m + 1)][has] * p[ids]
        return logs + np.log(np.maximum(alpha[length % (m + 1)], 1e-300))

    def expected(self, rows: np.ndarray, weight: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations (one language)."""
        n, length = rows.shape
        arcs = list(self.arcs(rows))
        alpha = np.zeros((length + 1, n))
        alpha[0] = 1.0
        for end, size, has, numbers in arcs:
            alpha[end, has] += alpha[end - size, has] * p[numbers]
        beta = np.zeros((length + 1, n))
        beta[length] = 1.0
        for end, size, has, numbers in reversed(arcs):
            beta[end - size, has] += beta[end, has] * p[numbers]
        scale = weight / np.maximum(alpha[length], 1e-300)
        uses = np.zeros(len(p))
        for end, size, has, numbers in arcs:
            uses += np.bincount(numbers, alpha[end - size, has] * p[numbers] * beta[end, has] * scale[has],
                                minlength=len(p))
        return uses


@dataclass
class Model:
    langs: list[str]
    lattice: Lattice
    p: np.ndarray                 # (piece number, language)


def _by_length(lattice: Lattice, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, their symbols with the mark in front) by length."""
    lengths = np.array([len(w) for w in words])
    mark = lattice.symbol[ord(START)]
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        codes = np.frombuffer("".join(words[i] for i in at).encode("utf-32-le"), np.uint32).reshape(-1, n)
        yield at, np.concatenate([np.full((len(at), 1), mark), lattice.symbol[codes]], axis=1)


def fit(counts: list[tuple[str, str, int]], params: LangParams = LangParams()) -> Model | None:
    """Model from (language, word, count)."""
    langs = sorted({c[0] for c in counts})
    if not langs:
        return None
    lattice = Lattice(pieces(params.vocabulary))
    n_numbers = lattice.unknown + 1
    single = np.zeros(n_numbers, bool)
    single[[i + 1 for i, p in enumerate(lattice.vocabulary) if len(p) == 1]] = True
    single[lattice.unknown] = True
    columns = []
    for lang in langs:
        own = [(w, n) for name, w, n in counts if name == lang]
        weight = np.array([n for _, n in own], float)
        groups = list(_by_length(lattice, [w for w, _ in own]))
        p = np.full(n_numbers, 1.0 / n_numbers)
        p[0] = 0.0
        for _ in range(params.rounds):
            uses = sum(lattice.expected(rows, weight[at], p) for at, rows in groups)
            p = uses / uses.sum()
            p[single] = np.maximum(p[single], params.floor)
            p[0] = 0.0
        columns.append(p / p.sum())
    p = np.stack(columns, axis=1)
    # a piece one language has and another lacks must not rule the other out
    used = p.max(axis=1) > params.floor
    p = np.where(used[:, None] | single[:, None], np.maximum(p, params.floor), 0.0)
    p[0] = 0.0
    return Model(langs, lattice, p)


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, start and end of each word, word rows of each text)."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in lowered])])
    letter = _is_letter()[codes]
    edge = np.zeros(len(codes) + 1, bool)
    edge[bounds] = True
    begins = letter & (np.concatenate([[True], ~letter[:-1]]) | edge[:-1]) if len(codes) else letter
    start = np.flatnonzero(begins)
    ends = letter & (np.concatenate([~letter[1:], [True]]) | edge[1:]) if len(codes) else letter
    end = np.flatnonzero(ends) + 1
    return codes, start, end, np.searchsorted(start, bounds)


def _distinct(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each distinct word, distinct number of each word)."""
    length = end - start
    total = np.concatenate([[0], np.cumsum(length)])
    within = np.arange(total[-1]) - np.repeat(total[:-1], length)
    values = W.mix(codes[np.repeat(start, length) + within].astype(np.uint64) + np.uint64(1)
                   + (within.astype(np.uint64) << np.uint64(21)))
    hashed = np.add.reduceat(values, total[:-1])
    _, first, inverse = np.unique(W.mix(hashed ^ length.astype(np.uint64)), return_index=True,
                                  return_inverse=True)
    return first, inverse


def _count_words(batches: Iterator[pa.RecordBatch], learn_letters: int) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) per slice and language."""
    for whole in batches:
        for batch in slices(whole):
            langs = np.array(field(batch, "lang").to_pylist(), object)
            texts = field(batch, "text").to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == lang]
                codes, start, end, _ = _words(own)
                short = end - start <= learn_letters
                start, end = start[short], end[short]
                if not len(start):
                    continue
                first, inverse = _distinct(codes, start, end)
                words = [codes[start[i]:end[i]].tobytes().decode("utf-32-le") for i in first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()),
                     pa.array(np.bincount(inverse), pa.int64())], names=["lang", "word", "n"])


def train(docs: DataFrame, params: LangParams = LangParams()) -> Model | None:
    """Model from the training fold of ``docs`` (doc_id, text, lang)."""
    known = docs.filter((fold(F.col("doc_id"), params.modulus) != params.held_out)
                        & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    shares = F.create_map(*[x for lang, n in sorted(sizes.items())
                            for x in (F.lit(lang), F.lit(min(1.0, params.docs_per_lang / n)))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = known.filter(draw < F.element_at(shares, F.col("lang"))).select("lang", "text")
    counts = map_arrow(sample, lambda x: _count_words(x, params.learn_letters), "lang string, word string, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
           .withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= params.words_per_lang).collect())
    return fit(sorted((r["lang"], r["word"], r["n"]) for r in top), params)


def score_texts(texts: list[str | None], model: Model | None) -> tuple[list[str], np.ndarray]:
    """(language, posterior) of each text."""
    codes, start, end, row = _words(texts)
    none = row[1:] == row[:-1]
    if model is None or not len(start):
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    first, inverse = _distinct(codes, start, end)
    length = (end - start)[first]
    logs = np.empty((len(first), len(model.langs)))
    mark = model.lattice.symbol[ord(START)]
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        step = max(1, CELLS // max(min(n, COLUMNS) + 1, len(model.langs)))
        for some in np.split(at, range(step, len(at), step)):
            symbols = model.lattice.symbol[codes[start[first[some]][:, None] + np.arange(n)]]
            rows = np.concatenate([np.full((len(some), 1), mark), symbols], axis=1)
            logs[some] = model.lattice.forward(rows, model.p)
    total = np.zeros((len(texts), len(model.langs)))
    full = ~none
    total[full] = np.add.reduceat(logs[inverse], row[:-1][full], axis=0)
    best = total.argmax(axis=1)
    posterior = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return ([UNDETERMINED if n else model.langs[b] for n, b in zip(none, best)],
            np.where(none, 0.0, posterior))


def _score(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, max_bytes=6_000_000):
            langs, scores = score_texts(field(batch, "text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [field(batch, "doc_id"), pa.array(langs, pa.string()), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), lambda x: _score(x, shared.value),
                     f"doc_id {kind}, lang_pred string, score double")
