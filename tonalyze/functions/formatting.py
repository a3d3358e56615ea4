"""Output formatting of stored predictions (timestamps, probability text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonalyze.fixed import (
    ISO_MICROS,
    ISO_SECONDS,
    MISSING_PROBABILITY,
    PROBABILITY_DECIMALS,
    SPANISH_LOCALE_DATETIME,
)


def iso_timestamp(ts: Column) -> Column:
    """``datetime.isoformat()``: fraction only when microseconds are non-zero."""
    whole_second = F.date_trunc("second", ts) == ts
    return F.when(whole_second, F.date_format(ts, ISO_SECONDS)).otherwise(
        F.date_format(ts, ISO_MICROS))


def spanish_datetime(ts: Column) -> Column:
    """``toLocaleString('es-ES')`` rendered in the session time zone (UTC)."""
    return F.date_format(ts, SPANISH_LOCALE_DATETIME)


def numeric_array(arr: Column) -> Column:
    """Each element as a number, null where it is not one; null stays null."""
    return F.transform(arr, lambda x: x.try_cast("double"))


def to_fixed(x: Column, decimals: int = PROBABILITY_DECIMALS) -> Column:
    """JavaScript ``x.toFixed(decimals)``: the exact binary value of x
    rounded half up, sign kept (``-0.0004`` gives ``-0.000``).

    Spark's formatters round the shortest decimal form of x, not its exact
    value (``%.3f`` gives 1.001 for 1.0005 = 1.000499..; ``format_number``
    gives 0.000 for 0.0005 = 0.000500..01).  Here p = |x| * 10^d is split
    into floor c and fraction f (exact), and Dekker's two-product gives the
    rounding error e of the multiplication exactly (Veltkamp split of x;
    10^d has at most 26 significant bits).  The exact product is c + f + e,
    so it rounds up when f > 1/2, or f = 1/2 and e >= 0.  Java evaluates
    these double operations in strict IEEE arithmetic (no fused
    multiply-add), so every step is exact.  Values of 1e15 and above fall
    back to ``%.Nf``.
    """
    if not 0 <= decimals <= 11:
        raise ValueError("decimals must be within 0..11")
    scale = float(10 ** decimals)
    a = F.abs(x)
    p = a * scale
    c = F.floor(p)
    f = p - c
    t = a * 134217729.0                     # 2^27 + 1
    hi = t - (t - a)
    lo = a - hi
    err = (hi * scale - p) + lo * scale
    n = c + F.when((f > 0.5) | ((f == 0.5) & (err >= 0)), 1).otherwise(0)
    unit = 10 ** decimals
    digits = F.concat(
        (n / F.lit(unit)).cast("long").cast("string"),
        F.lit("." if decimals else ""),
        F.lpad((n % F.lit(unit)).cast("string"), decimals, "0") if decimals else F.lit(""))
    text = F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), digits)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("NaN"))
            .when(a >= 1e15, F.format_string(f"%.{decimals}f", x))
            .otherwise(text))


def probability_text(arr: Column, decimals: int = PROBABILITY_DECIMALS) -> Column:
    """``[0.650, 0.320, 0.230]`` with fixed decimals, ``N/A`` when absent."""
    body = F.array_join(F.transform(arr, lambda x: to_fixed(x, decimals)), ", ")
    return F.when(arr.isNull(), F.lit(MISSING_PROBABILITY)).otherwise(
        F.concat(F.lit("["), body, F.lit("]")))


def utc_ntz(ts):
    """An instant as UTC wall time without a zone, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01").cast("timestamp_ntz"))
