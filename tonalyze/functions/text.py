"""Column expressions for text (all JVM-side built-ins, no Python UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonalyze.fixed import CSS_PREFIX, RECORD_DELIMITER, UNKNOWN_CLASS

# Whitespace sets, written as regex classes both Java and RE2 accept.
# Python's str.strip() (record cleaning): ASCII whitespace, the separators
# U+001C..U+001F, NEL, NBSP, the Unicode space separators and U+2028/9.
PY_WHITESPACE_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# JavaScript's String.trim() (empty-input check): the same without
# U+001C..U+001F and NEL, plus the byte-order mark U+FEFF.
JS_WHITESPACE_CLASS = (r"[\t\n\x{0B}\f\r \x{A0}\x{1680}\x{2000}-\x{200A}"
                       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]")
RECORD_DELIMITER_REGEX = re.escape(RECORD_DELIMITER)


def _strip(c: Column, cls: str) -> Column:
    # \A and \z, not ^ and $: in Java, $ also matches before a final line
    # terminator (NEL, U+2028, ...), which would strip spaces in front of a
    # trailing NEL that JavaScript's trim() keeps.
    return F.regexp_replace(c, rf"\A{cls}+|{cls}+\z", "")


def strip_ws(c: Column) -> Column:
    """Strip leading and trailing whitespace (Python ``str.strip``)."""
    return _strip(c, PY_WHITESPACE_CLASS)


def trim_js(c: Column) -> Column:
    """Strip leading and trailing whitespace (JavaScript ``String.trim``)."""
    return _strip(c, JS_WHITESPACE_CLASS)


def one_line(c: Column) -> Column:
    """Line breaks to spaces, so a record stays on one line of a text source.

    The line readers split on CR as well as LF, so both become a space.
    """
    return F.regexp_replace(c, r"[\r\n]", " ")


def is_blank(c: Column) -> Column:
    """Null, empty or whitespace only (the client's ``value.trim()`` check)."""
    return F.length(trim_js(F.coalesce(c, F.lit("")))) == 0


def strip_special(c: Column) -> Column:
    """Lowercase and keep only letters, digits and whitespace."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N} \t\n\x{0B}\f\r]", "")


def nonempty(c: Column) -> Column:
    """Null for null or ''; JavaScript ``a || b`` skips both."""
    return F.nullif(c, F.lit(""))


def display_class(prediccion: Column, intencion: Column, default: str = UNKNOWN_CLASS) -> Column:
    """``prediccion || intencion_predicha || default``."""
    return F.coalesce(nonempty(prediccion), nonempty(intencion), F.lit(default))


def class_key(c: Column) -> Column:
    """Summary key of a statistics row: null or '' becomes ``desconocido``."""
    return F.coalesce(nonempty(c), F.lit(UNKNOWN_CLASS))


def css_class(c: Column) -> Column:
    return F.concat(F.lit(CSS_PREFIX), F.lower(c))
