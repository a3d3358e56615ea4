"""Reference SQL (DuckDB dialect) for every registered query.

Each statement recomputes its query from the given tables (views named
after the parquet files), independently of Spark, including the classifier:
tokeniser, stop words, vocabulary cut, IDF and Naive Bayes are written out
as the closed-form formulas of the model.  Floating outputs are rounded to
six places on both sides.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from tonalyze.stop_words import SPANISH

log = logging.getLogger(__name__)

# Stated here, not taken from the code under test: what Python's str.strip()
# and JavaScript's String.trim() remove.
PY_WHITESPACE_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
JS_WHITESPACE_CLASS = (r"[\t\n\x{0B}\f\r \x{A0}\x{1680}\x{2000}-\x{200A}"
                       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]")
VOCAB_SIZE = 5000
# Java's \s, which Spark's Tokenizer splits on.
JAVA_SPACE = r"[ \t\n\x0B\f\r]"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def stop_word_list() -> str:
    return "[" + ", ".join(_quote(w) for w in SPANISH) + "]"


def tokenize(expr: str) -> str:
    """Spark's Tokenizer: lower case, split on each Java whitespace char,
    trailing empty strings dropped (all-blank text gives no token)."""
    stripped = f"regexp_replace(lower({expr}), '{JAVA_SPACE}+$', '')"
    return (f"(CASE WHEN {stripped} = '' AND {expr} <> '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex({stripped}, '{JAVA_SPACE}') END)")


def strip_ws(expr: str, ws: str = PY_WHITESPACE_CLASS) -> str:
    return f"regexp_replace({expr}, '\\A{ws}+|{ws}+\\z', '', 'g')"


def trim_js(expr: str) -> str:
    return strip_ws(expr, JS_WHITESPACE_CLASS)


def one_line(expr: str) -> str:
    return f"regexp_replace({expr}, '[\\r\\n]', ' ', 'g')"


CORPUS = """corpus AS (
  SELECT d.doc_id, d.text AS texto,
         CASE WHEN l.toxic = 1 THEN 'negativo' WHEN l.quality = 1 THEN 'positivo'
              ELSE 'neutral' END AS etiqueta
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

PREDS = """preds AS (
  SELECT d.doc_id AS id, d.text AS texto,
         CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE c.cls END AS prediccion,
         CASE WHEN d.doc_id % 11 = 0 THEN c.cls ELSE NULL END AS intencion_predicha,
         CASE WHEN d.doc_id % 11 = 0 THEN 0.5::DOUBLE ELSE NULL END AS confianza,
         CASE WHEN d.doc_id % 7 = 0 THEN NULL
              ELSE [CAST(40 + 5 * (d.doc_id % 10) AS DOUBLE) / 100,
                    CAST(35 - 3 * (d.doc_id % 10) AS DOUBLE) / 100,
                    CAST(25 - 2 * (d.doc_id % 10) AS DOUBLE) / 100] END AS probability,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(d.doc_id // 3 AS BIGINT)) AS ts,
         'almacenado' AS estado
  FROM documents d
  JOIN (SELECT doc_id, CASE WHEN toxic = 1 THEN 'negativo' WHEN quality = 1 THEN 'positivo'
                            ELSE 'neutral' END AS cls FROM labels) c ON d.doc_id = c.doc_id)"""

CLEANED = f"""cleaned AS (
  SELECT doc_id, {strip_ws(one_line('texto'))} AS texto, {strip_ws('etiqueta')} AS etiqueta
  FROM corpus WHERE texto IS NOT NULL AND etiqueta IS NOT NULL)"""

# Wire line split at the leftmost delimiter (a text ending in '|' moves
# that bar into the label, as the regex split in the stream does).
PARSED = r"""parsed AS (
  SELECT doc_id, texto || '|||' || etiqueta AS value,
         string_split_regex(texto || '|||' || etiqueta, '\|\|\|')[1] AS texto,
         string_split_regex(texto || '|||' || etiqueta, '\|\|\|')[2] AS etiqueta_real
  FROM cleaned)"""

STATS = """stats AS (
  SELECT prediccion AS _id, CAST(count(*) AS BIGINT) AS total,
         round(avg(list_max(probability)), 6) AS promedio_confianza
  FROM preds GROUP BY prediccion)"""

MERGED = """merged AS (
  SELECT coalesce(nullif(_id, ''), 'desconocido') AS clase,
         CAST(sum(coalesce(total, 0)) AS BIGINT) AS total
  FROM stats GROUP BY 1)"""

SUMMARY = """summary AS (
  SELECT CAST(sum(total) AS BIGINT) AS total_analizado,
         CAST(sum(CASE WHEN lower(clase) = 'positivo' THEN total ELSE 0 END) AS BIGINT) AS positivos,
         CAST(sum(CASE WHEN lower(clase) = 'negativo' THEN total ELSE 0 END) AS BIGINT) AS negativos,
         CAST(sum(CASE WHEN lower(clase) = 'neutral' THEN total ELSE 0 END) AS BIGINT) AS neutrales,
         '{' || string_agg('"' || clase || '":' || CAST(total AS VARCHAR), ',' ORDER BY clase) || '}'
           AS distribucion
  FROM merged)"""

ISO_TS = ("CASE WHEN date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') "
          "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END")


def history(where: str = "", limit: int | None = 50) -> str:
    lim = f" LIMIT {int(limit)}" if limit else ""
    return (f"SELECT CAST(id AS VARCHAR) AS _id, texto, prediccion, intencion_predicha, confianza, "
            f"probability, {ISO_TS} AS timestamp, estado FROM preds {where} "
            f"ORDER BY ts DESC NULLS LAST, id DESC{lim}")


_POSTERIOR = """post AS (SELECT *, exp(raw - max(raw) OVER (PARTITION BY key)) AS e FROM raw),
post2 AS (SELECT *, e / sum(e) OVER (PARTITION BY key) AS p FROM post),
scored AS (
  SELECT key,
         (list(clase ORDER BY raw DESC, class_index ASC))[1] AS prediccion,
         round(max(p), 6) AS confianza,
         list(round(p, 6) ORDER BY class_index) AS probability
  FROM post2 GROUP BY key)"""


def naive_bayes(score_sql: str, train: str = "corpus", vocab_size: int = VOCAB_SIZE) -> str:
    """CTEs ending in ``scored(key, prediccion, confianza, probability)``.

    ``train`` names a relation (doc_id, texto, etiqueta); ``score_sql`` is a
    SELECT producing (key, texto) with a unique key.
    """
    sw = stop_word_list()
    return f"""stopwords AS (SELECT unnest({sw}) AS w),
train AS (SELECT doc_id, coalesce(texto, '') AS texto, etiqueta FROM {train} WHERE etiqueta IS NOT NULL),
train_tok AS (
  SELECT doc_id, w FROM (SELECT doc_id, unnest({tokenize('texto')}) AS w FROM train)
  WHERE w NOT IN (SELECT w FROM stopwords)),
vocab AS (
  SELECT w, total, row_number() OVER (ORDER BY total DESC, w) - 1 AS term_index
  FROM (SELECT w, count(*) AS total FROM train_tok GROUP BY w)
  QUALIFY term_index < {int(vocab_size)}),
n_docs AS (SELECT count(*) AS n FROM train),
n_vocab AS (SELECT count(*) AS v FROM vocab),
train_tf AS (
  SELECT t.doc_id, t.w, count(*) AS tf FROM train_tok t JOIN vocab v ON v.w = t.w GROUP BY t.doc_id, t.w),
idf AS (
  SELECT v.w, v.term_index, count(tf.doc_id) AS doc_freq,
         ln((n.n + 1.0) / (count(tf.doc_id) + 1.0)) AS idf
  FROM vocab v LEFT JOIN train_tf tf ON tf.w = v.w CROSS JOIN n_docs n
  GROUP BY v.w, v.term_index, n.n),
classes AS (
  SELECT etiqueta AS clase, count(*) AS n_c,
         row_number() OVER (ORDER BY count(*) DESC, etiqueta) - 1 AS class_index
  FROM train GROUP BY etiqueta),
n_classes AS (SELECT count(*) AS k FROM classes),
train_x AS (
  SELECT tr.etiqueta AS clase, tf.w, tf.tf * i.idf AS x
  FROM train_tf tf JOIN train tr ON tr.doc_id = tf.doc_id JOIN idf i ON i.w = tf.w),
class_term AS (
  SELECT c.clase, c.class_index, i.w, i.term_index, coalesce(sum(x.x), 0) AS s
  FROM classes c CROSS JOIN idf i LEFT JOIN train_x x ON x.clase = c.clase AND x.w = i.w
  GROUP BY c.clase, c.class_index, i.w, i.term_index),
class_tot AS (SELECT clase, sum(s) AS s_c FROM class_term GROUP BY clase),
prior AS (
  SELECT c.clase, c.class_index, ln(c.n_c + 1.0) - ln(n.n + k.k * 1.0) AS lp
  FROM classes c CROSS JOIN n_docs n CROSS JOIN n_classes k),
theta AS (
  SELECT ct.clase, ct.class_index, ct.w, ct.term_index,
         ln(ct.s + 1.0) - ln(t.s_c + v.v * 1.0) AS lt
  FROM class_term ct JOIN class_tot t ON t.clase = ct.clase CROSS JOIN n_vocab v),
score_in AS ({score_sql}),
score_x AS (
  SELECT s.key, s.w, count(*) * i.idf AS x
  FROM (SELECT key, unnest({tokenize("coalesce(texto, '')")}) AS w FROM score_in) s
  JOIN idf i ON i.w = s.w
  WHERE s.w NOT IN (SELECT w FROM stopwords)
  GROUP BY s.key, s.w, i.idf),
raw_dot AS (
  SELECT x.key, th.clase, sum(x.x * th.lt) AS dot
  FROM score_x x JOIN theta th ON th.w = x.w GROUP BY x.key, th.clase),
raw AS (
  SELECT k.key, p.clase, p.class_index, p.lp + coalesce(r.dot, 0) AS raw
  FROM (SELECT key FROM score_in) k CROSS JOIN prior p
  LEFT JOIN raw_dot r ON r.key = k.key AND r.clase = p.clase),
{_POSTERIOR}"""


# -- Spark's HashingTF bucket: MurmurHash3 x86_32, seed 42, over the UTF-8
# bytes of the term, modulo the number of features.  32-bit arithmetic is
# done in UBIGINT and masked.
_M32 = "4294967295::UBIGINT"


def _byte(j: str) -> str:
    return f"CAST(('0x' || substr(hx, 2 * ({j}) + 1, 2)) AS UBIGINT)"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) << {r}) & {_M32}) | (({x}) >> {32 - r})"


def _mix_k(k: str) -> str:
    a = f"(({k}) * 3432918353::UBIGINT) & {_M32}"
    return f"((({_rotl(a, 15)}) * 461845907::UBIGINT) & {_M32})"


def _mix_h(h: str, k: str) -> str:
    x = f"xor({h}, {k})"
    return f"((({_rotl(x, 13)}) * 5::UBIGINT + 3864292196::UBIGINT) & {_M32})"


def murmur3_buckets(words: str, num_features: int, seed: int = 42) -> str:
    """CTEs ending in ``bucket(w, j)`` for the distinct terms of ``words(w)``."""
    block = " | ".join(f"({_byte(f'4 * i + {b}')} << {8 * b})" for b in range(4))
    tail = " | ".join(f"(CASE WHEN n % 4 > {b} THEN {_byte(f'4 * (n // 4) + {b}')} << {8 * b} "
                      f"ELSE 0::UBIGINT END)" for b in range(3))
    return f"""mm_in AS (SELECT w, octet_length(encode(w)) AS n, hex(encode(w)) AS hx FROM {words}),
mm_blocks AS (
  SELECT w, n, hx,
         list_reduce(list_prepend({int(seed)}::UBIGINT,
                                  list_transform(range(n // 4), lambda i: {block})),
                     lambda h, k: {_mix_h('h', _mix_k('k'))}) AS h0
  FROM mm_in),
mm_tail AS (SELECT w, n, CASE WHEN n % 4 > 0 THEN xor(h0, {_mix_k(tail)}) ELSE h0 END AS h FROM mm_blocks),
mm_f1 AS (SELECT w, xor(h, n::UBIGINT) AS h FROM mm_tail),
mm_f2 AS (SELECT w, xor(h, h >> 16) AS h FROM mm_f1),
mm_f3 AS (SELECT w, (h * 2246822507::UBIGINT) & {_M32} AS h FROM mm_f2),
mm_f4 AS (SELECT w, xor(h, h >> 13) AS h FROM mm_f3),
mm_f5 AS (SELECT w, (h * 3266489909::UBIGINT) & {_M32} AS h FROM mm_f4),
mm_f6 AS (SELECT w, xor(h, h >> 16) AS h FROM mm_f5),
bucket AS (SELECT w, CAST(h % {int(num_features)} AS BIGINT) AS j FROM mm_f6)"""


def naive_bayes_hashed(score_sql: str, train: str = "corpus", num_features: int = 1 << 18) -> str:
    """As ``naive_bayes`` with hashed term buckets instead of a vocabulary.

    Every bucket is a feature (V = num_features): buckets never seen in
    training still weigh in, with idf ln(N+1) and theta -ln(S(c)+V).
    """
    sw = stop_word_list()
    v = int(num_features)
    return f"""stopwords AS (SELECT unnest({sw}) AS w),
train AS (SELECT doc_id, coalesce(texto, '') AS texto, etiqueta FROM {train} WHERE etiqueta IS NOT NULL),
train_tok AS (
  SELECT doc_id, w FROM (SELECT doc_id, unnest({tokenize('texto')}) AS w FROM train)
  WHERE w NOT IN (SELECT w FROM stopwords)),
score_in AS ({score_sql}),
score_tok AS (
  SELECT key, w FROM (SELECT key, unnest({tokenize("coalesce(texto, '')")}) AS w FROM score_in)
  WHERE w NOT IN (SELECT w FROM stopwords)),
all_words AS (SELECT w FROM train_tok UNION SELECT w FROM score_tok),
{murmur3_buckets('all_words', v)},
n_docs AS (SELECT count(*) AS n FROM train),
train_tf AS (
  SELECT t.doc_id, b.j, count(*) AS tf FROM train_tok t JOIN bucket b ON b.w = t.w GROUP BY t.doc_id, b.j),
idf AS (SELECT tf.j, ln((n.n + 1.0) / (count(*) + 1.0)) AS idf
        FROM train_tf tf CROSS JOIN n_docs n GROUP BY tf.j, n.n),
classes AS (
  SELECT etiqueta AS clase, count(*) AS n_c,
         row_number() OVER (ORDER BY count(*) DESC, etiqueta) - 1 AS class_index
  FROM train GROUP BY etiqueta),
n_classes AS (SELECT count(*) AS k FROM classes),
class_term AS (
  SELECT tr.etiqueta AS clase, tf.j, sum(tf.tf * i.idf) AS s
  FROM train_tf tf JOIN train tr ON tr.doc_id = tf.doc_id JOIN idf i ON i.j = tf.j
  GROUP BY tr.etiqueta, tf.j),
class_tot AS (
  SELECT c.clase, coalesce(sum(ct.s), 0) AS s_c
  FROM classes c LEFT JOIN class_term ct ON ct.clase = c.clase GROUP BY c.clase),
prior AS (
  SELECT c.clase, c.class_index, ln(c.n_c + 1.0) - ln(n.n + k.k * 1.0) AS lp
  FROM classes c CROSS JOIN n_docs n CROSS JOIN n_classes k),
score_x AS (
  SELECT s.key, b.j, count(*) * coalesce(any_value(i.idf), ln(any_value(n.n) + 1.0)) AS x
  FROM score_tok s JOIN bucket b ON b.w = s.w LEFT JOIN idf i ON i.j = b.j CROSS JOIN n_docs n
  GROUP BY s.key, b.j),
raw_dot AS (
  SELECT x.key, c.clase,
         sum(x.x * (ln(coalesce(ct.s, 0) + 1.0) - ln(t.s_c + {v}.0))) AS dot
  FROM score_x x CROSS JOIN classes c JOIN class_tot t ON t.clase = c.clase
  LEFT JOIN class_term ct ON ct.clase = c.clase AND ct.j = x.j
  GROUP BY x.key, c.clase),
raw AS (
  SELECT k.key, p.clase, p.class_index, p.lp + coalesce(r.dot, 0) AS raw
  FROM (SELECT key FROM score_in) k CROSS JOIN prior p
  LEFT JOIN raw_dot r ON r.key = k.key AND r.clase = p.clase),
{_POSTERIOR}"""


def to_fixed(x: str, decimals: int = 3) -> str:
    """JavaScript ``toFixed``: exact binary value, ties half up.  printf
    rounds exact ties to even; exact ties at N decimals are the values with
    x * 2^(N+1) an odd integer, nudged up before printing."""
    p = 2 ** (decimals + 1)
    return (f"(CASE WHEN {x} * {p} = floor({x} * {p}) AND CAST(floor({x} * {p}) AS BIGINT) % 2 = 1 "
            f"THEN printf('%.{decimals}f', {x} + {0.1 ** (decimals + 2):.{decimals + 2}f}) "
            f"ELSE printf('%.{decimals}f', {x}) END)")


FORMAT_SELECT = """SELECT CAST(id AS VARCHAR) AS _id,
  coalesce(texto, '') AS texto,
  coalesce(nullif(prediccion, ''), nullif(intencion_predicha, ''), '') AS sentimiento,
  strftime(ts, '%-d/%-m/%Y, %-H:%M:%S') AS fecha,
  list_transform(probability, lambda x: TRY_CAST(x AS DOUBLE)) AS probability,
  CASE WHEN probability IS NULL THEN 'N/A'
       ELSE '[' || array_to_string(list_transform(probability, lambda x: {TO_FIXED_X}), ', ') || ']'
  END AS probabilidades,
  'sentiment-' || lower(coalesce(nullif(prediccion, ''), nullif(intencion_predicha, ''), 'desconocido')) AS css
FROM preds"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def builders() -> dict[str, Callable[[], str]]:
    """One function per statement, so that each is built on its own."""
    def nb_docs() -> str:
        return naive_bayes("SELECT doc_id AS key, text AS texto FROM documents")

    def nb_stream() -> str:
        return naive_bayes("SELECT doc_id AS key, texto FROM parsed")

    def nb_corpus() -> str:
        return naive_bayes("SELECT doc_id AS key, texto FROM corpus")

    def stream_rows() -> str:
        return (_with(CORPUS, CLEANED, PARSED, nb_stream())
                + "SELECT c.texto, c.etiqueta_real, s.prediccion, s.confianza, "
                  "s.probability FROM parsed c JOIN scored s ON s.key = c.doc_id")

    q: dict[str, Callable[[], str]] = {}

    # -- step 1: scans and projections over the corpus
    q["csv_corpus_scan"] = lambda: _with(CORPUS) + "SELECT doc_id, texto, etiqueta FROM corpus"
    q["lower_text"] = lambda: _with(CORPUS) + "SELECT doc_id, lower(texto) AS texto, etiqueta FROM corpus"

    # -- step 2: reads over the predictions store
    q["class_stats"] = lambda: _with(PREDS, STATS) + "SELECT * FROM stats"
    q["class_summary"] = lambda: _with(PREDS, STATS, MERGED, SUMMARY) + "SELECT * FROM summary"
    q["latest_predictions"] = lambda: _with(PREDS) + history()
    q["format_predictions"] = lambda: _with(PREDS) + FORMAT_SELECT.replace("{TO_FIXED_X}", to_fixed("x"))
    q["overview"] = lambda: _with(PREDS, STATS, MERGED, SUMMARY, f"""recent AS (
  SELECT list(CAST(id AS VARCHAR) ORDER BY ts DESC NULLS LAST, id DESC) AS recientes,
         list(CAST(to_json({{'_id': CAST(id AS VARCHAR), 'texto': texto, 'prediccion': prediccion,
                             'timestamp': timestamp}}) AS VARCHAR) ORDER BY ts DESC NULLS LAST, id DESC) AS documentos
  FROM ({history(limit=10).replace("CAST(id AS VARCHAR) AS _id", "id, ts")}))""", """listed AS (
  SELECT list(CAST(to_json({'_id': _id, 'total': total, 'promedio_confianza': promedio_confianza}) AS VARCHAR)
              ORDER BY total DESC, _id NULLS LAST) AS estadisticas FROM stats)""") + \
        "SELECT r.*, s.*, l.* FROM recent r CROSS JOIN summary s CROSS JOIN listed l"
    q["predictions_json"] = lambda: _with(PREDS, f"h AS ({history(limit=None)})") + \
        ("SELECT _id, CAST(to_json({'_id': _id, 'texto': texto, 'prediccion': prediccion, "
         "'intencion_predicha': intencion_predicha, 'confianza': confianza, "
         "'probability': probability, 'timestamp': timestamp, 'estado': estado}) AS VARCHAR) AS json FROM h")

    # -- step 3: record cleaning and parsing
    q["clean_records"] = lambda: _with(CORPUS, CLEANED) + r"""SELECT doc_id, %s AS texto, %s AS etiqueta
FROM (SELECT doc_id, parts[1] AS texto, parts[2] AS etiqueta
      FROM (SELECT doc_id, string_split_regex(value, '\|\|\|') AS parts
            FROM (SELECT doc_id, texto || '|||' || etiqueta AS value FROM cleaned
                  UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))) FROM documents))
      WHERE len(parts) >= 2)
WHERE texto IS NOT NULL AND etiqueta IS NOT NULL""" % (strip_ws(one_line('texto')), strip_ws('etiqueta'))
    q["encode_records"] = lambda: _with(CORPUS, CLEANED) + \
        "SELECT doc_id, texto || '|||' || etiqueta AS value FROM cleaned"
    q["parse_records"] = lambda: _with(CORPUS, CLEANED, PARSED) + "SELECT doc_id, texto, etiqueta_real FROM parsed"
    q["text_preview"] = lambda: "SELECT doc_id, substring(text, 1, 50) AS preview FROM documents"
    q["reject_empty"] = lambda: (f"SELECT conv_id, turn, length({trim_js('coalesce(text, {e})')}) > 0 AS aceptado "
                         "FROM conversations").replace("{e}", "''")

    # -- step 4: store maintenance
    q["migrate_predictions"] = lambda: _with(PREDS) + """SELECT id, texto,
  coalesce(prediccion, intencion_predicha) AS prediccion, intencion_predicha, probability, ts, estado
FROM preds"""
    q["migration_counts"] = lambda: _with(PREDS) + """SELECT CAST(count(*) AS BIGINT) AS matched_count,
  CAST(count(*) FILTER (WHERE (prediccion IS NULL AND intencion_predicha IS NOT NULL)
                         OR confianza IS NOT NULL) AS BIGINT) AS modified_count
FROM preds"""
    q["store_predictions"] = lambda: _with(CORPUS, nb_docs()) + """SELECT CAST(d.doc_id AS VARCHAR) AS id, d.text AS texto,
  s.prediccion, s.probability, 'almacenado' AS estado, true AS con_fecha, true AS stored
FROM documents d JOIN scored s ON s.key = d.doc_id"""
    q["clear_predictions"] = lambda: _with(PREDS) + \
        "SELECT CAST(count(*) AS BIGINT) AS deleted_count, CAST(0 AS BIGINT) AS remaining_count FROM preds"
    q["document_store"] = lambda: _with(PREDS) + """SELECT CAST(id AS VARCHAR) AS id, texto,
  coalesce(prediccion, intencion_predicha) AS prediccion, probability, ts, estado
FROM preds WHERE id % 19 <> 0 AND id % 17 <> 0
UNION ALL
SELECT 'n-' || id, texto, prediccion, probability, ts, estado FROM preds WHERE prediccion IS NOT NULL AND id % 5 = 0"""
    q["document_rejects"] = lambda: _with(PREDS) + """SELECT CASE WHEN id % 19 <> 0 THEN CAST(id AS VARCHAR) END AS id,
  CASE WHEN id % 19 = 0 THEN 'json' ELSE 'probability' END AS motivo
FROM preds WHERE id % 19 = 0 OR id % 17 = 0"""
    q["unified_predictions"] = lambda: _with(PREDS, CORPUS, CLEANED, PARSED, nb_stream()) + """SELECT CAST(id AS VARCHAR) AS id, texto,
  coalesce(prediccion, intencion_predicha) AS prediccion, intencion_predicha, probability, estado,
  NULL::VARCHAR AS etiqueta_real, ts IS NOT NULL AS con_fecha
FROM preds
UNION ALL
SELECT sha256(c.value), c.texto, s.prediccion, s.prediccion, s.probability, NULL, c.etiqueta_real, true
FROM parsed c JOIN scored s ON s.key = c.doc_id"""

    # -- step 5: text features
    q["label_index"] = lambda: _with(CORPUS) + """SELECT c.doc_id, c.etiqueta, CAST(k.class_index AS DOUBLE) AS label
FROM corpus c JOIN (SELECT etiqueta, row_number() OVER (ORDER BY count(*) DESC, etiqueta) - 1 AS class_index
                    FROM corpus GROUP BY etiqueta) k ON k.etiqueta = c.etiqueta"""
    q["tokens"] = lambda: f"SELECT doc_id, {tokenize('text')} AS palabras FROM documents"
    q["tokens_no_stop"] = lambda: (f"SELECT doc_id, list_filter({tokenize('text')}, "
                           f"lambda w: NOT list_contains({stop_word_list()}, w)) AS palabras_limpias FROM documents")
    q["term_counts"] = lambda: _with(CORPUS, nb_corpus()) + \
        "SELECT tf.doc_id, tf.w AS term, CAST(tf.tf AS BIGINT) AS tf FROM train_tf tf"
    q["idf_weights"] = lambda: _with(CORPUS, nb_corpus()) + \
        ("SELECT CAST(term_index AS INTEGER) AS term_index, w AS term, CAST(doc_freq AS BIGINT) AS doc_freq, "
         "round(idf, 6) AS idf FROM idf")

    # -- step 6: classifier
    q["nb_model_params"] = lambda: _with(CORPUS, nb_corpus()) + """SELECT clase, NULL::VARCHAR AS term, round(lp, 6) AS valor FROM prior
UNION ALL SELECT clase, w, round(lt, 6) FROM theta"""
    q["score_corpus"] = lambda: _with(CORPUS, nb_docs()) + \
        ("SELECT s.key AS doc_id, d.text AS texto, prediccion, confianza, probability, 'processed' AS status, "
         "false AS stored, true AS con_fecha FROM scored s JOIN documents d ON d.doc_id = s.key")
    q["scored_class_stats"] = lambda: _with(CORPUS, nb_docs()) + """SELECT prediccion, CAST(count(*) AS BIGINT) AS total,
  round(avg(confianza), 6) AS promedio_confianza
FROM (SELECT key, prediccion, list_max(probability) AS confianza FROM scored) GROUP BY prediccion"""
    q["score_examples"] = lambda: _with(CORPUS, naive_bayes(
        "SELECT conv_id * 1000000 + turn AS key, text AS texto FROM conversations")) + \
        ("SELECT c.conv_id, c.turn, s.prediccion, s.confianza, s.probability FROM conversations c "
         "JOIN scored s ON s.key = c.conv_id * 1000000 + c.turn")
    q["model_roundtrip"] = lambda: _with(CORPUS, naive_bayes("SELECT item_id AS key, text AS texto FROM benchmark")) + \
        "SELECT key AS item_id, prediccion, confianza, probability FROM scored"

    q["score_corpus_hashed"] = lambda: _with(CORPUS, naive_bayes_hashed(
        "SELECT doc_id AS key, text AS texto FROM documents")) + \
        "SELECT key AS doc_id, prediccion, confianza, probability FROM scored"

    # -- step 7: streaming (the time column is not compared)
    q["stream_score"] = stream_rows
    q["stream_store"] = lambda: (_with(CORPUS, CLEANED, PARSED, nb_stream())
                               + "SELECT sha256(c.value) AS id, c.texto, s.prediccion, s.probability, "
                                 "'almacenado' AS estado FROM parsed c JOIN scored s ON s.key = c.doc_id")
    q["stream_resume"] = stream_rows

    # -- step 8: roadmap items
    q["latest_by_class"] = lambda: _with(PREDS) + history("WHERE prediccion = 'negativo'")
    q["strip_special"] = lambda: (r"SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N} \t\n\x{0B}\f\r]', '', 'g') "
                          "AS texto_limpio FROM documents")
    q["class_share"] = lambda: _with(PREDS, STATS, MERGED) + \
        "SELECT clase, total, round(total / sum(total) OVER (), 6) AS proporcion FROM merged"
    q["class_over_time"] = lambda: _with(PREDS) + """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS inicio,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS fin,
  coalesce(nullif(prediccion, ''), nullif(intencion_predicha, ''), 'desconocido') AS clase,
  CAST(count(*) AS BIGINT) AS total
FROM preds GROUP BY ALL"""
    return q


def statements() -> dict[str, str]:
    """Every statement that can be built; one that fails is logged and left
    out, the others stay."""
    found: dict[str, str] = {}
    for name, build in builders().items():
        try:
            found[name] = build()
        except Exception:
            log.exception("no reference SQL for %s", name)
    return found
