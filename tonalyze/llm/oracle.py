"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from tonalyze.llm import licenses
from tonalyze.llm.quality_rules import STOP_WORDS, SYMBOLS, THRESHOLDS

SPACE = r"[\x20\x09-\x0D]+"


def quality_rules() -> str:
    stop = ", ".join("'" + w + "'" for w in sorted(
        {v for ws in STOP_WORDS.values() for w in ws for v in (w, w.capitalize())}))
    bounds = []
    for r in THRESHOLDS:
        value = f"({r.measure}::DOUBLE / nullif({r.per}, 0))" if r.per else f"{r.measure}::DOUBLE"
        if r.low is not None:
            bounds.append(f"coalesce({value} >= {r.low}, true)")
        if r.high is not None:
            bounds.append(f"coalesce({value} <= {r.high}, true)")
    return f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{SPACE}'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS rows
  FROM d
), win AS (
  SELECT rid, i, words[i:i+4] AS g FROM w, unnest(generate_series(1, len(words) - 4)) AS u(i)
  WHERE len(words) >= 5
), rep AS (
  SELECT rid, i, i - lag(i) OVER (PARTITION BY rid ORDER BY i) AS gap
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), covered AS (
  SELECT rid, sum(least(5, coalesce(gap, 5)))::BIGINT AS n FROM rep GROUP BY rid
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
         (len(rows) - len(list_distinct(rows)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(rows) AS n_lines,
         length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
         len(list_filter(words, lambda x: x IN ({stop}))) + 1 AS n_stop_words_and_one,
         len(list_filter(generate_series(2, len(words)), lambda k: words[k] = words[k - 1])) AS n_again
  FROM w LEFT JOIN covered USING (rid)
), f AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND {' AND '.join(bounds)}) AS kept
FROM f
"""


def license_inheritance() -> str:
    def quoted(text):
        return "'" + text.replace("'", "''") + "'"

    templates = ",\n".join(f"({k}, {quoted(name)}, {quoted(text)})" for k, (name, text) in enumerate(licenses.KNOWN))
    words = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
    around = ", ".join(
        f"array_to_string(lines[greatest(i - {before}, 1):greatest(i - {before}, 1) + {before + after}], chr(10))"
        for before, after in licenses.AROUND)
    return f"""
WITH templates(k, license, t) AS (VALUES {templates}
), files AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         concat_ws('/', source, lang, (doc_id // 100)::VARCHAR, doc_id::VARCHAR || '.txt') AS path
  FROM documents
), placed AS (
  SELECT rid, doc_id, path, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS dir
  FROM files
), df AS (
  SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct({words.format('text')})) AS term FROM files) GROUP BY term
), total AS (SELECT count(*) AS n FROM files),
template_terms AS (
  SELECT k, license, term, 1 + ln(count(*)) AS tf
  FROM (SELECT k, license, unnest({words.format('t')}) AS term FROM templates) GROUP BY ALL
), weighed AS (
  SELECT k, license, term, tf * (ln((1 + total.n) / (1 + coalesce(df.n, 0))) + 1) AS w
  FROM template_terms LEFT JOIN df USING (term), total
), norms AS (
  SELECT k, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY k
), cued AS (
  SELECT rid, text, string_split(text, chr(10)) AS lines FROM files WHERE regexp_matches(text, '{licenses.WIDE_CUE}')
), cue_lines AS (
  SELECT rid, lines, unnest(list_filter(generate_series(1, len(lines)),
         lambda i: regexp_matches(lines[i], '{licenses.CUE}'))) AS i FROM cued
), parts AS (
  SELECT rid, 'file' AS kind, text AS part FROM cued
  UNION ALL SELECT rid, 'header', unnest([{around}]) FROM cue_lines
  UNION ALL SELECT rid, 'header', unnest(list_filter(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'),
                   lambda x: regexp_matches(x, '{licenses.WIDE_CUE}'))) FROM cued
), units AS (
  SELECT row_number() OVER () AS unit, * FROM parts
), unit_terms AS (
  SELECT unit, term, 1 + ln(count(*)) AS tf
  FROM (SELECT unit, unnest({words.format('part')}) AS term FROM units) GROUP BY ALL
), unit_weighed AS (
  SELECT unit, term, tf * (ln((1 + total.n) / (1 + df.n)) + 1) AS w FROM unit_terms JOIN df USING (term), total
), unit_norms AS (
  SELECT unit, sqrt(sum(w * w)) AS norm FROM unit_weighed GROUP BY unit
), cosines AS (
  SELECT unit, k, license, sum(u.w * t.w) AS dot FROM unit_weighed u JOIN weighed t USING (term) GROUP BY ALL
), scores AS (
  SELECT rid, kind, round(dot / (n.norm * m.norm), 9) AS cosine, license
  FROM cosines JOIN unit_norms n USING (unit) JOIN norms m USING (k) JOIN units USING (unit)
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY rid, kind ORDER BY cosine DESC, license) = 1
), own AS (
  SELECT best.*, doc_id, dir FROM best JOIN placed USING (rid)
  WHERE (kind = 'header' AND cosine >= {licenses.HEADER_COSINE}) OR (kind = 'file' AND cosine >= {licenses.FILE_COSINE})
), of_dir AS (
  SELECT dir AS ancestor, license FROM own WHERE kind = 'file'
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, doc_id NULLS LAST, license DESC) = 1
), mine AS (
  SELECT * FROM own QUALIFY row_number() OVER (PARTITION BY rid ORDER BY cosine DESC, kind = 'header' DESC) = 1
), above AS (
  SELECT dir, unnest(list_transform(generate_series(0, len(string_split(dir, '/'))),
         lambda n: array_to_string(string_split(dir, '/')[1:n], '/'))) AS ancestor
  FROM (SELECT DISTINCT dir FROM placed)
), nearest AS (
  SELECT * FROM above JOIN of_dir USING (ancestor)
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(ancestor) DESC) = 1
)
SELECT p.doc_id, p.path, coalesce(m.license, d.license) AS license, round(m.cosine, 6) AS cosine,
       CASE WHEN m.rid IS NOT NULL THEN m.kind WHEN d.dir IS NOT NULL THEN 'inherited' ELSE 'none' END AS basis,
       CASE WHEN m.rid IS NULL THEN d.ancestor END AS license_dir
FROM placed p LEFT JOIN mine m USING (rid) LEFT JOIN nearest d ON d.dir = p.dir
"""


def decontamination() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             f"'abcdefghijklmnopqrstuvwxyz'), '{word}')")
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, {words} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, w[i:i + 9] AS g FROM items, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS u(i)
  WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT len(g) AS size FROM windows
), found AS (
  SELECT rid, i, size, item
  FROM (SELECT rid, i, size, w[i:i + size - 1] AS g
        FROM d, sizes, unnest(generate_series(1, len(w) - size + 1)) AS u(i)) JOIN windows USING (g)
), hit AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM found, unnest(generate_series(0, size - 1)) AS u(k) GROUP BY rid
), held AS (
  SELECT rid, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN held USING (rid)
"""


def filter_audit() -> str:
    """Every document is followed through every order by the letters it fails."""
    earlier = "length(translate(substr(o, 1, s - 1), fails, '')) < s - 1"
    here = "contains(fails, substr(o, s, 1))"
    return f"""
WITH f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM t
), judged AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN judged USING (doc_id)
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY ALL
), steps AS (
  SELECT part, o, s, substr(o, s, 1) AS f,
         sum(n) FILTER (length(translate(substr(o, 1, s), fails, '')) = s) AS kept,
         sum(n) FILTER ({here} AND NOT {earlier}) AS removed,
         sum(n) FILTER ({here} AND {earlier}) AS redundant,
         sum(n) FILTER (fails = substr(o, s, 1)) AS alone,
         sum(good) FILTER ({here} AND NOT {earlier}) AS good_lost,
         sum(toxic) FILTER ({here} AND NOT {earlier}) AS toxic_lost
  FROM cells, orders, generate_series(1, 5) AS g(s) GROUP BY part, o, s
)
SELECT part, o AS filter_order, s::INT AS step, coalesce(kept, 0)::BIGINT AS kept,
       coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(alone, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
       coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM steps
"""


def fill_in_middle() -> str:
    part = "array_to_string(u[{}], '')"
    return f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM t
), c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
         greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, {part.format('1:a')} AS p, {part.format('a + 1:b')} AS m, {part.format('b + 1:')} AS s FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def statements() -> dict[str, str]:
    return {"op2_license_inheritance": license_inheritance(), "op5_quality_rules": quality_rules(),
            "op9_fm_decontamination": decontamination(), "op12_filter_audit": filter_audit(),
            "op13_fill_in_middle": fill_in_middle()}
