"""Fill-in-the-middle transformation over a learned rank index.

A text is cut after two of its tokens (white space with the word that follows
it; white space at the end is a token of its own) into prefix, middle and
suffix, and written as ``<P>prefix<S>suffix<M>middle`` (psm) or
``<S>suffix<P>prefix<M>middle`` (spm).  Which tokens, and whether at all, is
decided by the SHA-256 of a seed and the id, so a lost task gives the same
rows again and documents can be dealt to any number of executors.

The boundaries of all tokens go into a ``RankIndex`` of their byte offsets;
a cut is the index's offset of its rank.  Offsets always fall between
characters, because white space is ASCII.

The work is a map over the rows: nothing is shuffled.

Defined results
    null or empty text   no tokens; plain and empty
    blank text           one token
    very long text       cut like any other, from its whole text
    text with a marker   plain, as it could not be told apart again
    null id              hashed as an empty number
    repeated rows, ties  equal ids are cut at equal draws
    empty table          empty result
    clashing columns     only the id and the text are read
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalyze.llm import rank_index
from tonalyze.llm.common import field, map_arrow, slices, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
COLUMNS = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, "
           "segments int, source_bytes long")
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


@dataclass(frozen=True)
class FimParams:
    seed: int = 42
    rate: int = 50         # percent of texts that are transformed
    spm_rate: int = 80     # percent of those in the order suffix, prefix, middle
    error: int = 32        # bytes a predicted boundary may miss


def boundaries(data: np.ndarray) -> np.ndarray:
    """0 and the end of every token of a text's UTF-8 bytes."""
    if not len(data):
        return np.zeros(1, np.int64)
    blank = _BLANK[data]
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.concatenate([[0], ends, [len(data)]])


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    said = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(said[k:k + 8], 16) for k in (0, 8, 16, 24))


def compose(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == "psm":
        return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle


def restore(output: bytes, form: str) -> bytes:
    """The text that an output was made of."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE)
    if form == "psm":
        prefix, suffix = head[len(PREFIX):].split(SUFFIX)
    else:
        suffix, prefix = head[len(SUFFIX):].split(PREFIX)
    return prefix + middle + suffix


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _transform(batches: Iterator[pa.RecordBatch], p: FimParams) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    for whole in batches:
        for batch in slices(whole):
            data, offsets = utf8(field(batch, "text"))
            rows = []
            for r, doc_id in enumerate(field(batch, "doc_id").to_pylist()):
                text = data[offsets[r]:offsets[r + 1]]
                raw = text.tobytes()
                ends = boundaries(text)
                index = rank_index.fit(ends, p.error)
                n = len(ends) - 1
                h1, h2, h3, h4 = draws(doc_id, p.seed)
                common = (doc_id, n)
                if not raw or h3 % 100 >= p.rate or any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)):
                    rows.append((*common, "plain", None, None, raw, len(index.first), len(raw)))
                    continue
                a, b = index.offset(np.sort(np.array([h1 % (n + 1), h2 % (n + 1)]))).tolist()
                form = "spm" if h4 % 100 < p.spm_rate else "psm"
                rows.append((*common, form, _chars(text[:a]), _chars(text[a:b]),
                             compose(form, raw[:a], raw[a:b], raw[b:]), len(index.first), len(raw)))
            columns = list(zip(*rows))
            columns[names.index("output")] = pa.array(columns[names.index("output")], pa.binary()).cast(pa.string())
            kinds = {"form": pa.string(), "segments": pa.int32()}
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, kinds.get(name, pa.int64()))
                 for name, c in zip(names, columns)], names=names)


def transform(docs: DataFrame, params: FimParams = FimParams(), id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n (tokens), form, prefix_chars,
    middle_chars, output (the transformed text), segments (of its rank index)
    and source_bytes."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(source, lambda x: _transform(x, params), COLUMNS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keep = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    for batch in batches:
        outputs = [x.as_buffer().to_pybytes() for x in field(batch, "output").cast(pa.large_binary())]
        forms = field(batch, "form").to_pylist()
        sums = [[hashlib.sha256(x).hexdigest() for x in outputs],
                [hashlib.sha256(restore(x, f)).hexdigest() for x, f in zip(outputs, forms)]]
        yield pa.RecordBatch.from_arrays([field(batch, c) for c in keep] + [pa.array(s, pa.string()) for s in sums],
                                         names=[*keep, "output_sha256", "restored_sha256"])


def digests(transformed: DataFrame) -> DataFrame:
    """Digests of the outputs of ``transform`` and of the texts rebuilt from
    them (output and form alone)."""
    return map_arrow(transformed, _digests, "doc_id long, n long, form string, prefix_chars long, "
                     "middle_chars long, output_sha256 string, restored_sha256 string")
