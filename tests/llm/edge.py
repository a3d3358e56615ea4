"""Rows every operator must take: nulls, empty and long texts, ties,
repeated rows, and extra columns whose names clash with added ones."""

import re

CLASH = ["kept", "score", "predicted", "n_words", "size", "shard", "slot", "part", "signature", "shingles",
         "component_id", "hit_spans", "contaminated", "_m", "_spans", "start", "label", "path", "lang_pred"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{c}` string" for c in CLASH)

WORDS = "the cat of house is and river on stone tree for bird wind path light".split()


def passage(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"{WORDS[x % 15]}{(x >> 8) % 97}")
    return " ".join(out)


def texts() -> list[tuple]:
    base = passage(1, 60)
    near = " ".join(["changed", *base.split()[1:]])
    rows = [
        (0, base), (1, base), (2, near), (3, base.upper()),
        (4, None), (5, ""), (6, " \n\t "), (7, "one two"), (8, "one two"), (9, "One  TWO"),
        (10, passage(2, 30000)), (11, "x" * 5000), (12, "ñandú çà et là \U0001f600 über äh\n" * 3),
        (13, passage(3, 40) + "\n" + passage(4, 30)), (14, passage(4, 30) + "\n" + passage(5, 40)),
        (15, passage(6, 20) + "\n\n" + passage(7, 25)), (15, passage(6, 20) + "\n\n" + passage(7, 25)),
        (None, passage(8, 30)), (None, None), (16, "a\x00b\x0bc \x1c d"), (17, "the the the the the the the the"),
        (18, "Licensed under the Apache License, Version 2.0.\n" + passage(9, 30)),
        (19, "was 5% #### && ***"), (20, "…—“quoted”"), (21, "… — 123 ²"),
    ]
    return rows


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, "en", "src", len(t) if t else None, *["clash"] * len(CLASH)) for i, t in rows], SCHEMA)


def lower(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
