"""Near-duplicates, line dedup and decontamination against brute force."""

import collections
import hashlib

import edge
import numpy as np

from tonalyze.llm import decontam, graph, line_dedup, minhash_forest
from tonalyze.llm import words as W
from tonalyze.llm.common import table
from tonalyze.llm.fm_index import FMIndex


def shingle_set(text):
    w = edge.SPACED.findall(edge.lower(text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[j:j + 5]) for j in range(len(w) - 4)])


def brute_components(docs):
    """id -> (n_shingles, component); an id may have several texts."""
    sets = collections.defaultdict(set)
    for i, t in docs:
        sets[i].add(shingle_set(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = [(i, s) for i in sorted(sets) for s in sets[i] if s]
    for k, (a, x) in enumerate(nodes):
        for b, y in nodes[k + 1:]:
            small, large = sorted((len(x), len(y)))
            if 100 * small < 85 * large:
                continue
            common = len(x & y)
            if 100 * common >= 85 * (len(x) + len(y) - common):
                u, v = find(a), find(b)
                parent[max(u, v)] = min(u, v)
    return {i: (max(map(len, sets[i])), find(i)) for i in sets}


def check_components(docs_frame, params=minhash_forest.ForestParams()):
    rows = docs_frame.collect()
    want = brute_components({(r.doc_id, r.text) for r in rows if r.doc_id is not None})
    got = minhash_forest.near_duplicates(docs_frame, params).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_components_equal_brute_force(spark, sf_small):
    check_components(table(spark, sf_small, "documents"))


def test_components_of_odd_rows(spark):
    check_components(edge.frame(spark))
    assert minhash_forest.near_duplicates(edge.frame(spark, [])).count() == 0


def test_regions_over_the_bound_lose_no_link(spark):
    """Near copies of one text, far more than a region may hold."""
    base = edge.passage(1, 200).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        own = list(base)
        own[(i * 37) % 200] = f"w{i}"
        own[(i * 53 + 90) % 200] = f"v{i}"
        rows.append((i, " ".join(own)))
    rows += [(200 + i, edge.passage(100 + i, 80)) for i in range(30)]
    check_components(spark.createDataFrame(rows, "doc_id long, text string"),
                     minhash_forest.ForestParams(region_rows=10))


def test_rows_of_one_id_are_one_document(spark):
    a, b = edge.passage(1, 40), edge.passage(2, 40)
    rows = [(3, a), (7, a), (7, b), (9, b), (11, edge.passage(3, 40)), (11, edge.passage(4, 40)), (12, edge.passage(4, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_components(docs)
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash_forest.near_duplicates(docs).collect()}
    assert got == {(3, 3, True), (7, 3, False), (9, 3, False), (11, 11, True), (12, 11, False)}


def test_chunks_by_bytes_lose_no_link(spark):
    base = edge.passage(1, 300).split()
    rows = [(i, " ".join([*base[:i], f"w{i}", *base[i + 1:]])) for i in range(60)]
    check_components(spark.createDataFrame(rows, "doc_id long, text string"),
                     minhash_forest.ForestParams(region_bytes=20_000))


def test_signature_agreement_estimates_similarity():
    a, b = (minhash_forest.W._random64(200, s) for s in (101, 202))
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 1150, dtype=np.uint64)
    x, y = pool[:1000], pool[150:]
    s, t = (np.frombuffer(minhash_forest._signature(v, a, b).tobytes(), "<u4") for v in (x, y))
    assert abs((s == t).mean() - 850 / 1150) < 0.12


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 250)]
    links = [(min(x), max(x)) for x in links]
    got = {r.node: r.component for r in graph.components(
        spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 250: 250, 300: 250}


def word_hash(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return W.split(raw, np.array([0, len(raw)]), W.PUNCTUATION).hash[0]


def brute_units(text, p=line_dedup.LineParams()):
    """{(start, end, cut, words)} of a text's units."""
    out, lines, at = set(), [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line), edge.ALNUM.findall(edge.lower(line))))
        at += len(line) + 1
    for k, (start, end, own) in enumerate(lines):
        if len(own) >= p.min_words:
            out.add((start, end, end + 1, tuple(own)))
        elif own:
            for step in (1, -1):
                j, n = k, len(own)
                while n < p.min_words and 0 <= j + step < len(lines):
                    j += step
                    n += len(lines[j][2])
                if n >= p.min_words:
                    a, b = min(j, k), max(j, k)
                    out.add((lines[a][0], lines[b][1], lines[b][1] + 1, tuple(w for x in lines[a:b + 1] for w in x[2])))
    found = list(edge.ALNUM.finditer(edge.lower(text)))
    words = [m.group() for m in found]
    hashes = np.array([word_hash(w) for w in words], np.uint64)
    pairs = [int(W.mix(hashes[k:k + 1] ^ (W.mix(hashes[k + 1:k + 2]) * W.MULTIPLIER))[0]) >> 24 for k in range(len(words) - 1)]
    bounds = sorted({min(range(k, k + p.spread), key=lambda j: (pairs[j], j)) for k in range(len(pairs) - p.spread + 1)})
    reach = {}
    for b in bounds:
        to = next((c for c in bounds if c >= b + p.phrase_words), None)
        if to is not None and b >= reach.get(tuple(words[b:to]), 0):
            reach[tuple(words[b:to])] = to
            end = found[to - 1].end()
            out.add((found[b].start(), end, end + (text[end:end + 1] in ("\t", " ") and end < len(text)), tuple(words[b:to])))
    return out


def brute_lines(docs):
    """id -> removed spans (start, end, cut, kept id, kept start), from
    (id, text) in rank order, one text an id."""
    first, mine = {}, {}
    places = collections.defaultdict(list)
    for i, text in docs:
        mine[i] = brute_units(text or "")
        for start, end, _, own in sorted(mine[i]):
            places[own].append((i, start, end))
    stays = collections.defaultdict(list)
    for own, at in places.items():
        first[own] = at[0]
        if len(at) > 1:
            stays[at[0][0]].append(at[0][1:])
    out = collections.defaultdict(list)
    for i in mine:
        for start, end, cut, own in mine[i]:
            if first[own] != (i, start, end) and not any(a < end and start < b for a, b in stays[i]):
                out[i].append((start, end, cut, *first[own][:2]))
    return out


def brute_cut(text, spans):
    gone = set()
    for start, _, cut, *_ in spans:
        gone.update(range(start, cut))
    return "".join(c for k, c in enumerate(text) if k not in gone)


def check_lines(docs):
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    want = brute_lines(texts)
    got = collections.defaultdict(list)
    for r in line_dedup.repeats(docs).collect():
        got[r.doc_id].append((r.start, r.end, r.cut, r.kept_doc_id, r.kept_start))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if v} and got
    # what a span points to is left whole
    cuts = {(i, k) for i in want for start, _, cut, *_ in want[i] for k in range(start, cut)}
    for i in want:
        for start, end, _, kept, at in want[i]:
            assert not any((kept, k) in cuts for k in range(at, at + 1))
    cleaned = {r.doc_id: r.text for r in line_dedup.remove_repeats(docs).collect()}
    for i, text in texts:
        assert cleaned[i] == (text and brute_cut(text, want.get(i, []))), i


def test_lines_equal_brute_force(spark, sf_small):
    check_lines(table(spark, sf_small, "documents"))


def test_overlapping_units_leave_what_they_point_to(spark):
    a, b, c, z = (edge.passage(k, 8) for k in (40, 41, 42, 43))
    rows = [(1, f"{a}\n{b}"), (2, f"{a}\n{b}\n{c}"), (3, f"{z}\n{b}\n{c}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_lines(docs)
    left = {r.doc_id: r.text for r in line_dedup.remove_repeats(docs).collect()}
    assert left == {1: rows[0][1], 2: rows[1][1], 3: f"{z}\n"}


def test_passages_inside_lines_are_repeats(spark):
    shared = [edge.passage(500 + k, 55) for k in range(20)]
    rows = [(i, f"{edge.passage(600 + i, 17 + i % 9)} {shared[i % 20]} {edge.passage(700 + i, 15 + i % 7)}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_lines(docs)
    assert {r.doc_id for r in line_dedup.repeats(docs).collect()} == set(range(20, 60))


def test_lines_of_odd_rows(spark):
    rows = [r for k, r in enumerate(edge.texts()) if r not in edge.texts()[:k] and r != (None, None)]
    check_lines(edge.frame(spark, rows))
    docs = edge.frame(spark)
    found = {(r.doc_id, r.kept_doc_id) for r in line_dedup.repeats(docs).collect()}
    assert found == {(1, 0), (2, 0), (3, 0), (14, 13)}      # repeated rows of id 15 rank alike
    done = line_dedup.remove_repeats(docs)
    assert done.columns == docs.columns and done.count() == docs.count()
    assert {r.text for r in done.filter("doc_id = 15").collect()} == {dict(edge.texts())[15]}
    assert line_dedup.repeats(edge.frame(spark, [])).count() == 0


def lines_of(seed, lengths):
    words = edge.passage(seed, sum(lengths)).split()
    return ["  ".join(words[sum(lengths[:k]):sum(lengths[:k + 1])]) for k in range(len(lengths))]


def test_passages_of_short_lines_are_repeats(spark):
    verse, mixed = lines_of(21, [10] * 6), lines_of(22, [3, 20, 2, 1])
    rest = {i: lines_of(30 + i, [5, 5, 30, 5, 5]) for i in range(5)}
    put = lambda i, passage: "\n".join(rest[i][:3] + passage + rest[i][3:])
    rows = [(0, put(0, verse)), (1, put(1, verse[:3] + [" "] + verse[3:])), (2, put(2, mixed)), (3, put(3, mixed)),
            (4, "\n".join(["la la la"] * 11)), (5, "\n".join(lines_of(29, [6, 6]) + rest[4])),
            (6, "\n".join(lines_of(29, [6, 6]) + rest[0][:1] + rest[1][:1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in line_dedup.remove_repeats(docs).collect()}
    assert left == dict(rows) | {1: put(1, []), 3: put(3, []), 4: "la la la\n" * 5}
    found = line_dedup.repeats(docs)
    assert {(r.doc_id, r.kept_doc_id) for r in found.collect()} == {(1, 0), (3, 2), (4, 4)}


def brute_hits(text, items, width=10):
    matches = list(edge.ALNUM.finditer(edge.lower(text or "")))
    words = [m.group() for m in matches]
    hit, found = set(), set()
    for item, own in items:
        own = edge.ALNUM.findall(edge.lower(own or ""))
        for j in range(max(1, len(own) - width + 1) if own else 0):
            window = own[j:j + width]
            for k in range(len(words) - len(window) + 1):
                if words[k:k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(str(item) if item is not None else "null")
    return words, hit, found


ITEMS = [(1, "cat dog " * 8), (2, "One two"), (10, "ÑANDÚ çà et là"), (3, None), (4, " - "), (None, "äh"),
         (2, "wind path, one"), (7, edge.passage(4, 18)), (8, edge.passage(2, 30000)[900:1100])]


def check_hits(spark, **more):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = edge.frame(spark, [*edge.texts(), (40, "dog " + "cat dog " * 9), (41, edge.passage(4, 18) + " x")])
    done = decontam.decontaminate(docs, items, **more)
    rows = done.collect()
    assert len(rows) == docs.count()
    some = 0
    for r in rows:
        words, hit, found = brute_hits(r.text, ITEMS)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            len(words), len(hit), len(found), digest, bool(hit)), r.doc_id
        cut = [w for s in r.hit_spans for w in edge.ALNUM.findall(edge.lower(r.text[s.start:s.end]))]
        assert cut == [words[i] for i in sorted(hit)]
        some += bool(hit)
    assert some >= 6
    left = {(r.doc_id, r.n_words, r.n_hit): r.text for r in decontam.remove_spans(done).collect()}
    for r in rows:
        words, hit, _ = brute_hits(r.text, ITEMS)
        text = left[(r.doc_id, r.n_words, r.n_hit)]
        assert edge.ALNUM.findall(edge.lower(text or "")) == [w for i, w in enumerate(words) if i not in hit]


def test_hits_equal_brute_force(spark):
    check_hits(spark)


def test_hits_in_blocks_equal_one_pass(spark):
    check_hits(spark, block_bytes=100)


def test_hits_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.decontaminate(edge.frame(spark, []), items).count() == 0
    none = decontam.decontaminate(edge.frame(spark), items.limit(0))
    assert none.filter("contaminated").count() == 0 and none.count() == len(edge.texts())


def test_decontamination_shuffles_no_document(spark, sf_small):
    done = decontam.decontaminate(table(spark, sf_small, "documents"), table(spark, sf_small, "benchmark"))
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    for symbols in (2, 3, 9, 300):
        runs = [rng.integers(1, symbols, rng.integers(1, 60)) for _ in range(40)] + [np.ones(200, int)]
        seq = np.concatenate([np.append(r, 0) for r in runs]).astype(np.int32)
        index = FMIndex(seq, symbols)
        phrases = np.zeros((200, 5), np.int32)
        lengths = rng.integers(1, 6, 200)
        for k, n in enumerate(lengths):
            phrases[k, 5 - n:] = rng.integers(1, symbols, n)
        low, high = index.search(phrases, lengths)
        for k, n in enumerate(lengths):
            want = [i for i in range(len(seq) - n + 1) if (seq[i:i + n] == phrases[k, 5 - n:]).all()]
            assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == want
