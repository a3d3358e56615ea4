"""Licence scan: TF-IDF cosine to templates, then inheritance by path.

1. Document frequencies of all terms are counted over all files (one
   aggregate, combined where the texts are read).
2. Units of a file are the file as a whole (licence files) and, as headers,
   each line with a cue word, the groups of two and three adjacent lines
   around it, and the blocks between blank lines.  Templates are short notices
   and the full texts in ``license_texts``.  A term weighs
   (1 + ln tf) * idf, in a unit as in a template.  Files, blocks and lines
   without a cue word are no licence notices; the others are spelt out into
   (unit, term) rows and joined to the frequencies and to the fixed table of
   template weights; the best cosine of a unit decides.
3. A file with a header has that licence.  A licence file gives its licence
   to its directory; a file without its own takes it from the nearest
   ancestor directory that has one, by joins of directory paths: distinct
   directories are resolved first, then joined to their files.

Only DataFrame functions are used; to the driver go the frequencies of the
templates' terms.

Defined results
    null or empty text   no licence of its own
    null path            the root directory
    very long text       read whole
    ties                 the licence that sorts first; among licence files of
                         a directory the higher cosine, then the smaller id,
                         then the licence that sorts last
    repeated rows        each row is judged by itself, also rows of one id and
                         path with different texts
    empty table          empty result
    clashing columns     only id, path and text are read
"""

from __future__ import annotations

import collections
import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalyze.llm.common import let, saved

# Short notices of common licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, "
                    "are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
CUES = ["license", "licensed", "licence", "licenced", "redistribution"]
CUE = "(?i)(^|[^a-z0-9])(" + "|".join(CUES) + ")($|[^a-z0-9])"     # lines
WIDE_CUE = "(?i)licen[cs]|redistribut|warrant"      # files and blocks: full texts have one of these
AROUND = [(0, 0), (1, 0), (0, 1), (2, 0), (1, 1), (0, 2)]      # lines before and after one with a cue
HEADER_COSINE = 0.7
FILE_COSINE = 0.4
SPLIT = r"[^a-z0-9]+"


def terms_of(text: str) -> dict[str, float]:
    """Terms and their 1 + ln tf."""
    counts = collections.Counter(w for w in re.split(SPLIT, text.lower()) if w)
    return {t: 1 + math.log(n) for t, n in counts.items()}


FULL_TEXTS = {f.stem: f.read_text("utf-8") for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
KNOWN = [*TEMPLATES.items(), *FULL_TEXTS.items()]
VOCABULARY = sorted({t for _, text in KNOWN for t in terms_of(text)})


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def _terms(text: Column) -> Column:
    """(term, 1 + ln tf) of a text: runs of equal words in sorted order."""
    def runs(words: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: (i == 0) | (i == F.size(words))
                          | (F.get(words, i) != F.get(words, i - 1)))
        return let(starts, lambda at: F.transform(
            F.slice(at, F.lit(1), F.size(at) - 1),
            lambda i, k: F.struct(F.get(words, i).alias("term"),
                                  (1 + F.log((F.get(at, k + 1) - i).cast("double"))).alias("tf"))))

    return let(F.array_sort(_words(text)), runs)


def _idf(n_files: float, n: float) -> float:
    return math.log((1 + n_files) / (1 + n)) + 1


def term_counts(files: DataFrame) -> DataFrame:
    """(term, n): files that hold the term; terms of a single file are left
    out unless a template has them."""
    return (files.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("term")).groupBy("term")
            .agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col("term").isin(VOCABULARY)))


def _headers(text: Column) -> Column:
    """The parts of a text that may be a header."""
    cue = CUE

    def around(lines: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(cue))
        return F.flatten(F.transform(at, lambda i: F.array(*[
            F.concat_ws("\n", F.slice(lines, F.greatest(i - before, F.lit(0)) + 1, F.lit(before + after + 1)))
            for before, after in AROUND])))

    blocks = F.filter(F.split(text, "\n[ \t\r]*\n"), lambda part: part.rlike(WIDE_CUE))
    return F.array_distinct(F.concat(let(F.split(text, "\n"), around), blocks))


def unit_scores(files: DataFrame) -> DataFrame:
    """(id, path, version, kind, license, cosine): the best template of each file as a
    whole ('file') and of its lines and blocks ('header'), where any term is shared."""
    spark = files.sparkSession
    # written first, so that the join reads two plain tables and Spark can split
    # the units of a very frequent term over tasks
    counts, n_files = saved(term_counts(files), "license-terms"), files.count()
    df = {r["term"]: r["n"] for r in counts.filter(F.col("term").isin(VOCABULARY)).collect()}
    idf = {t: _idf(n_files, df.get(t, 0)) for t in VOCABULARY}
    weights = [{t: tf * idf[t] for t, tf in terms_of(text).items()} for _, text in KNOWN]
    norms = [math.sqrt(sum(w * w for w in own.values())) for own in weights]
    table = spark.createDataFrame(
        [(t, [own.get(t, 0.0) * idf[t] / norm for own, norm in zip(weights, norms)]) for t in VOCABULARY],
        "term string, weights array<double>")
    cued = files.filter(F.col("text").rlike(WIDE_CUE)).withColumn("unit_row", F.monotonically_increasing_id())
    cued = saved(cued, "license-files")
    units = cued.select("unit_row", F.lit(-1).alias("n"), _terms(F.col("text")).alias("terms")).unionByName(
        cued.select("unit_row", F.posexplode(_headers(F.col("text"))).alias("n", "part"))
        .select("unit_row", "n", _terms(F.col("part")).alias("terms")))
    idf_of = F.log((1 + F.lit(n_files)) / (1 + F.coalesce("n_files", F.lit(1)))) + 1
    # the table of weights has one row per template term: its size is fixed above
    dots = (units.select("unit_row", "n", F.explode("terms").alias("t")).select("unit_row", "n", "t.term", "t.tf")
            .join(counts.withColumnRenamed("n", "n_files"), "term", "left")
            .join(F.broadcast(table), "term", "left")
            .groupBy("unit_row", "n").agg(
                F.sqrt(F.sum(F.pow(F.col("tf") * idf_of, F.lit(2.0)))).alias("norm"),
                *[F.sum(F.col("tf") * F.col("weights")[k]).alias(f"dot{k}") for k in range(len(KNOWN))]))
    # a dot is null where no term of the unit is a template's
    best = F.array_min(F.array(*[F.struct((-F.round(F.col(f"dot{k}") / F.col("norm"), 9)).alias("far"),
                                          F.lit(name).alias("license")) for k, (name, _) in enumerate(KNOWN)]))
    kind = F.when(F.col("n") < 0, "file").otherwise("header").alias("kind")
    return (dots.filter("dot0 is not null").select("unit_row", kind, best.alias("b"))
            .groupBy("unit_row", "kind").agg(F.min("b").alias("b"))
            .join(cued.select("unit_row", "id", "path", "version"), "unit_row")
            .select("id", "path", "version", "unit_row", "kind", F.col("b.license").alias("license"),
                    (-F.col("b.far")).alias("cosine")))


def directory(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def ancestors(d: Column) -> Column:
    """The directory and all above it, down to the root ''."""
    parts = F.split(d, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)),
                       lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path",
         text_col: str = "text") -> DataFrame:
    """doc_id, path, license, cosine, basis ('header', 'file', 'inherited' or
    'none') and license_dir of every file."""
    named = files.select(F.col(id_col).alias("id"), F.coalesce(F.col(path_col), F.lit("")).alias("path"),
                         F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version"))
    scores = saved(unit_scores(named), "license-scores")
    own = scores.filter(((F.col("kind") == "header") & (F.col("cosine") >= HEADER_COSINE))
                        | ((F.col("kind") == "file") & (F.col("cosine") >= FILE_COSINE)))
    of_dir = (own.filter("kind = 'file'").withColumn("dir", directory(F.col("path")))
              .groupBy("dir").agg(F.max_by("license", F.struct(F.col("cosine"), -F.col("id"), F.col("license"))).alias("dir_license")))
    # a row is known by id, path and text; rows equal in all three have one verdict
    mine = own.groupBy(F.col("id").alias("own_id"), F.col("path").alias("own_path"),
                       F.col("version").alias("own_version")).agg(
        F.max_by(F.struct("license", "cosine", "kind"),
                 F.struct(F.col("cosine"), F.col("kind") == "header")).alias("m"))
    placed = named.select("id", "path", "version", directory(F.col("path")).alias("dir"))
    dirs = placed.select("dir").distinct()
    above = dirs.select("dir", F.explode(ancestors(F.col("dir"))).alias("ancestor"))
    nearest = (above.join(of_dir.withColumnRenamed("dir", "ancestor"), "ancestor")
               .groupBy("dir").agg(F.max_by(F.struct("ancestor", "dir_license"), F.length("ancestor")).alias("d")))
    known = placed.join(nearest, "dir", "left").join(
        mine, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("path") == F.col("own_path"))
        & (F.col("version") == F.col("own_version")), "left")
    return known.select(
        F.col("id").alias("doc_id"), "path",
        F.coalesce("m.license", "d.dir_license").alias("license"),
        F.round("m.cosine", 6).alias("cosine"),
        F.when(F.col("m").isNotNull(), F.col("m.kind")).when(F.col("d").isNotNull(), "inherited")
         .otherwise("none").alias("basis"),
        F.when(F.col("m").isNull(), F.col("d.ancestor")).alias("license_dir"))
