"""Substring dedup by line and phrase hashing.

Units, from the coarsest to the finest:

    lines     of at least ``min_words`` words
    blocks    of adjacent lines around shorter ones: from each short line on,
              and back from it, the fewest lines that reach ``min_words``
              together (lines without a word count for nothing)
    phrases   of at least ``phrase_words`` words between two phrase bounds,
              whatever the lines.  A word is a bound if its hash with the next
              word is the smallest of ``spread`` neighbours, so equal
              passages have equal bounds wherever they stand in a line

No unit leaves its text.  A repeated passage of ``phrase_words`` +
3 * ``spread`` words (50) always holds a whole phrase of its own, so it is
found if it starts and ends inside lines, too; a repeated line is found from
``min_words`` words on.  What is shorter in all (a heading, notice or list
item that recurs in other surroundings) is left alone.

A unit is normalised to its words (ASCII lower-cased, all other ASCII than
digits and letters is white space) and hashed to 128 bits.  Digests are
grouped globally; the occurrence that ranks first by (id, position) stays and
the others become removal spans that keep their offsets in the original text.
A span that overlaps an occurrence that stays for others is none: what a
removed span points to is always still there, uncut.

A line that fills a third of all documents is one aggregated row (partial
aggregation) joined back to its occurrences, which Spark splits when skewed.

Defined results
    null or empty text   no units
    very long text       read whole; a line of any length is one unit
    repeated rows        rows of equal id and text rank alike: the first
                         occurrence stays in each of them
    null id              ranks before all others
    empty table          empty result
    clashing columns     ``remove_repeats`` returns the input's columns only
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonalyze.llm import words as W
from tonalyze.llm.common import cut_spans, distilled, field, map_arrow, saved, slices, utf8

UNITS = "doc_id long, crc long, start long, end long, cut long, n_words long, high long, low long"
REPEATS = ("doc_id long, crc long, start long, end long, cut long, n_words long, "
           "kept_doc_id long, kept_start long")
PLACE = np.uint64((1 << 24) - 1)   # words of a slice of text
FAR = np.uint64(np.iinfo(np.uint64).max)


@dataclass(frozen=True)
class LineParams:
    min_words: int = 13       # of a line or a block of short lines
    phrase_words: int = 20
    spread: int = 10          # pairs of words of which one is a phrase bound


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base)]), dtype=np.uint64)


def _sequence_hash(words: W.Words, first: np.ndarray, last: np.ndarray, multiplier: np.uint64) -> np.ndarray:
    """Hash of each word sequence first..last-1 (not empty), from running sums."""
    n = len(words.hash)
    inverse = np.uint64(pow(int(multiplier), -1, 1 << 64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(W.mix(words.hash ^ multiplier) * _powers(multiplier, n)[:n], dtype=np.uint64, out=sums[1:])
    out = (sums[last] - sums[first]) * _powers(inverse, n)[first]
    return W.mix(out + (last - first).astype(np.uint64))


def _blocks(row: np.ndarray, doc: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last line) of each unit; line i has the words row[i]..row[i+1]-1."""
    count = np.diff(row)
    long, short = np.flatnonzero(count >= min_words), np.flatnonzero((count > 0) & (count < min_words))
    # on from a short line, and back from it
    on = np.searchsorted(row, row[short] + min_words) - 1
    back = np.searchsorted(row, row[short + 1] - min_words, side="right") - 1
    first, last = np.concatenate([short, back]), np.concatenate([on, short])
    inside = (first >= 0) & (last < len(count))
    first, last = first[inside], last[inside]
    inside = doc[first] == doc[last]
    both = np.unique(np.stack([np.concatenate([long, first[inside]]),
                               np.concatenate([long, last[inside]])]), axis=1)
    return both[0], both[1]


def _bounds(hashes: np.ndarray, doc: np.ndarray, spread: int) -> np.ndarray:
    """Words that are phrase bounds, of words in documents ``doc`` (ascending)."""
    pairs, n = len(hashes) - 1, len(hashes) - spread
    if n < 1:
        return np.empty(0, np.int64)
    value = W.mix(hashes[:-1] ^ (W.mix(hashes[1:]) * W.MULTIPLIER))
    value = (value & ~PLACE) | (np.arange(pairs, dtype=np.uint64) & PLACE)
    low = value[:n].copy()
    for k in range(1, spread):
        np.minimum(low, value[k:k + n], out=low)
    low = low[doc[:n] == doc[spread:]]
    at = (low & PLACE).astype(np.int64)
    return np.unique(at)


def _phrases(hashes: np.ndarray, doc: np.ndarray, p: LineParams) -> tuple[np.ndarray, np.ndarray]:
    """(first word, one past the last) of each phrase: from a bound to the first
    bound at least ``phrase_words`` on."""
    bound = _bounds(hashes, doc, p.spread)
    if not len(bound):
        return bound, bound
    to = np.searchsorted(bound, bound + p.phrase_words)
    inside = to < len(bound)
    first, stop = bound[inside], bound[to[inside]]
    same = doc[first] == doc[stop]
    return first[same], stop[same]


def _apart(doc: np.ndarray, high: np.ndarray, low: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Of equal phrases of one document that overlap (periodic text), those
    that begin where the one before has ended."""
    order = np.lexsort((first, low, high, doc))
    same = np.append(False, (doc[order[1:]] == doc[order[:-1]]) & (high[order[1:]] == high[order[:-1]])
                     & (low[order[1:]] == low[order[:-1]]))
    stays = np.ones(len(first), bool)
    reach = 0
    for k in np.flatnonzero(same).tolist():
        if not same[k - 1]:
            reach = stop[order[k - 1]]
        if first[order[k]] < reach:
            stays[order[k]] = False
        else:
            reach = stop[order[k]]
    return stays


def units(batches: Iterator[pa.RecordBatch], p: LineParams) -> Iterator[pa.RecordBatch]:
    """(doc_id, crc, start, end, cut, n_words, digest) of each unit; ``cut`` is
    its end with the line break or blank that goes with it."""
    for whole in batches:
        for batch in slices(whole):
            data, offsets = utf8(field(batch, "text"))
            if not len(data):
                continue
            is_start = np.zeros(len(data) + 1, bool)
            is_start[offsets[:-1]] = True
            is_start[1:][data == 10] = True
            starts = np.flatnonzero(is_start[:-1])
            words = W.split(data, np.append(starts, len(data)), W.PUNCTUATION)
            doc = np.searchsorted(offsets, starts, side="right") - 1
            first, last = _blocks(words.row, doc, p.min_words)
            begin, stop = words.row[first], words.row[last + 1]
            ends = np.append(starts[1:], len(data))
            ends = (ends - (data[ends - 1] == 10))[last]
            at, of, cut = starts[first], doc[first], ends + 1
            # phrases, by words
            word_doc = np.searchsorted(offsets, words.start, side="right") - 1
            p_begin, p_stop = _phrases(words.hash, word_doc, p)
            p_ends = words.end[p_stop - 1]
            blank = np.isin(data[np.minimum(p_ends, len(data) - 1)], (9, 32)) & (p_ends < offsets[word_doc[p_begin] + 1])
            begin, stop = np.concatenate([begin, p_begin]), np.concatenate([stop, p_stop])
            high = _sequence_hash(words, begin, stop, W.MULTIPLIER)
            low = _sequence_hash(words, begin, stop, np.uint64(0xD6E8FEB86659FD93))
            n = len(first)
            taken = np.append(np.ones(n, bool), _apart(word_doc[p_begin], high[n:], low[n:], p_begin, p_stop))
            at = np.concatenate([at, words.start[p_begin]])[taken]
            of = np.concatenate([of, word_doc[p_begin]])[taken]
            # characters before each byte
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            base = chars[offsets[of]]
            line_cut = cut - ends
            ends = np.concatenate([ends, p_ends])[taken]
            end = chars[ends] - base
            more = np.concatenate([line_cut, blank.astype(np.int64)])[taken]
            crc = np.array([zlib.crc32(data[offsets[d]:offsets[d + 1]]) for d in range(batch.num_rows)],
                           np.int64)
            yield pa.RecordBatch.from_arrays(
                [field(batch, "doc_id").take(pa.array(of)), pa.array(crc[of]), pa.array(chars[at] - base),
                 pa.array(end), pa.array(end + more), pa.array((stop - begin)[taken].astype(np.int64)),
                 pa.array(high[taken].view(np.int64)), pa.array(low[taken].view(np.int64))],
                names=["doc_id", "crc", "start", "end", "cut", "n_words", "high", "low"])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text that go: those that overlap none that stays."""
    names = [c.split()[0] for c in REPEATS.split(", ")]
    for batch in batches:
        found = field(batch, "found")
        row = np.repeat(np.arange(len(batch)), np.diff(found.offsets.to_numpy()))
        cells = found.flatten()
        start, end = cells.field("start").to_numpy(), cells.field("end").to_numpy()
        stays = cells.field("stays").to_numpy(zero_copy_only=False)
        # one axis for all texts of the batch
        shift = row * (int(end.max(initial=0)) + 2)
        a, b = np.sort((start + shift)[stays]), np.sort((end + shift)[stays])
        # overlaps = spans begun before this one's end, less those ended by its start
        free = np.searchsorted(a, end + shift, side="left") == np.searchsorted(b, start + shift, side="right")
        gone = pa.array(np.flatnonzero(~stays & free))
        at = pa.array(row).take(gone)
        yield pa.RecordBatch.from_arrays(
            [field(batch, "doc_id").take(at), field(batch, "crc").take(at), *(cells.field(c).take(gone) for c in names[2:])],
            names=names)


def repeats(docs: DataFrame, params: LineParams = LineParams(), id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per removed span: doc_id, crc (of the text), start, end (in
    characters), cut (the end with its line break or blank), n_words, and the
    occurrence that stays: kept_doc_id, kept_start."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return distilled(lambda: _repeats(source, params), "line-repeats")


def _repeats(source: DataFrame, params: LineParams) -> DataFrame:
    # units are cheap to cut and many: they are cut twice, and what moves first
    # is half a digest each.  Only units whose half recurs are kept
    every = map_arrow(source, lambda x: units(x, params), UNITS)
    keys = saved(every.groupBy("high").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("high"), "line-keys")
    found = saved(every.join(keys, "high", "left_semi"), "line-units")
    place = F.struct("doc_id", "start", "crc", "end")
    first = (found.groupBy("high", "low").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    # written first, so that the join reads two plain tables and Spark can split
    # the occurrences of a very frequent line over tasks
    first = saved(first, "line-first")
    stays = (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("crc") == F.col("first.crc"))
             & (F.col("start") == F.col("first.start")) & (F.col("end") == F.col("first.end")))
    marked = found.join(first, ["high", "low"]).select(
        "doc_id", "crc", "start", "end", "cut", "n_words", stays.alias("stays"),
        F.col("first.doc_id").alias("kept_doc_id"), F.col("first.start").alias("kept_start"))
    # a text's spans, once for rows that repeat it
    by_text = marked.distinct().groupBy("doc_id", "crc").agg(F.collect_list(F.struct(
        "start", "end", "cut", "n_words", "kept_doc_id", "kept_start", "stays")).alias("found"))
    return map_arrow(by_text, _decide, REPEATS)


def remove_repeats(docs: DataFrame, params: LineParams = LineParams(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated units cut out of their texts (each with its
    line break or blank); other texts are returned as they are."""
    at = Window.partitionBy("doc_id", "crc").orderBy("start", "end")
    reach = F.max("end").over(at.rowsBetween(Window.unboundedPreceding, -1))
    # spans that touch become one
    found = (repeats(docs, params, id_col, text_col).select("doc_id", "crc", "start", F.col("cut").alias("end"))
             .distinct().withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
             .withColumn("span", F.sum("new").over(at.rowsBetween(Window.unboundedPreceding, 0))))
    spans = (found.groupBy("doc_id", "crc", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
             .groupBy("doc_id", "crc").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")))
    text = F.col(f"row.{text_col}")
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    joined = rows.join(spans, F.col(f"row.{id_col}").eqNullSafe(F.col("doc_id"))
                       & (F.crc32(F.coalesce(text, F.lit("")).cast("binary")) == F.col("crc")), "left")
    left = F.when(F.col("spans").isNotNull(), cut_spans(text, F.col("spans"))).otherwise(text)
    return joined.select(*[left.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
                           for c in docs.columns])
