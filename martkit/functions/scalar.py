"""Scalar column functions (F*).

All are compositions of built-in Spark expressions, so they stay inside
whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- numbers
def money(c, scale: int = 2) -> Column:
    """Money as an exact decimal (doubles are only a transport format)."""
    return _c(c).cast(f"decimal(18,{scale})")


def cents(c) -> Column:
    """Money in whole cents as a long: exact, and summed with plain long
    arithmetic inside whole-stage codegen (decimal sums above 18 digits fall
    back to BigDecimal). ``rint`` snaps the binary image of a 2-decimal value
    to its integer cent count."""
    return F.rint(_c(c) * 100).cast("long")


def ratio_half_up(num, den, digits: int = 2) -> Column:
    """num/den of non-negative integers rounded half-up to ``digits`` decimals, in
    decimal integer arithmetic (no binary rounding, no overflow up to 30 digits);
    NULL when den is 0 (the zero guard)."""
    n, d = _c(num).cast("decimal(30,0)"), _c(den).cast("decimal(30,0)")
    scale = 10 ** digits
    return F.when(d != 0, _intdiv(n * F.lit(2 * scale) + d, d * F.lit(2)) / F.lit(float(scale)))


def _intdiv(a: Column, b: Column) -> Column:
    """Floor division of non-negative integers, exact (SQL ``div``)."""
    return F.call_function("div", a, b)


def round_dec(c, digits: int = 2, via: str = "decimal(38,10)") -> Column:
    """Round half-up on a decimal image of the value; result as double."""
    return F.round(_c(c).cast(via), digits).cast("double")


def pct_change(new, old, digits: int = 2) -> Column:
    """|(new - old) / old * 100| for money values, rounded half-up in
    integer cents arithmetic; NULL when old is 0 (the zero guard)."""
    n, o = cents(new), cents(old)
    return ratio_half_up(F.abs(n - o) * 100, F.abs(o), digits)


# ---------------------------------------------------------------- dates
def yyyymm(ts) -> Column:
    """toYYYYMM as an int."""
    return (F.year(_c(ts)) * 100 + F.month(_c(ts))).cast("int")


def wall_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ's wall clock, from
    field arithmetic (no cast to an instant, so no session time zone)."""
    x = _c(ts)
    return (F.unix_date(x.cast("date")).cast("long") * 86_400 + F.hour(x).cast("long") * 3_600
            + F.minute(x).cast("long") * 60 + F.second(x).cast("long"))


def seconds_between(a, b) -> Column:
    """dateDiff('second', a, b) on wall-clock timestamps: the number of
    second boundaries crossed from a to b, bigint (negative when b < a).
    (``timestampdiff`` would first cast NTZ values to session-zone instants.)"""
    return wall_seconds(b) - wall_seconds(a)


_NTZ_FIELDS = {"yyyy": (F.year, 4), "MM": (F.month, 2), "dd": (F.dayofmonth, 2),
               "HH": (F.hour, 2), "mm": (F.minute, 2), "ss": (F.second, 2)}


def ntz_text(ts, pattern: str) -> Column:
    """Render a TIMESTAMP_NTZ with a pattern of yyyy MM dd HH mm ss and
    literals, from its fields (``date_format`` would cast through the session
    time zone and move wall-clock times inside a DST gap)."""
    x, parts, i = _c(ts), [], 0
    while i < len(pattern):
        tok = next((t for t in _NTZ_FIELDS if pattern.startswith(t, i)), None)
        if tok:
            fn, width = _NTZ_FIELDS[tok]
            parts.append(F.lpad(fn(x).cast("string"), width, "0"))
            i += len(tok)
        else:
            parts.append(F.lit(pattern[i]))
            i += 1
    return F.concat(*parts)


def parse_any(text, formats) -> Column:
    """wall-clock timestamp (TIMESTAMP_NTZ) from the first format that
    parses, else NULL.

    Each format is parsed with an explicit +00:00 offset appended, so the
    session time zone never shifts the result (a local DST gap would move
    '2018-11-04 00:00' to 01:00), and the instant's micros are added to the
    NTZ epoch."""
    t = F.concat(_c(text), F.lit(" +00:00"))
    inst = F.coalesce(*[F.try_to_timestamp(t, F.lit(f + " XXX")) for f in formats])
    return F.timestamp_add("MICROSECOND", F.unix_micros(inst),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


# ---------------------------------------------------------------- strings
def readable_size(nbytes) -> Column:
    """bytes -> '123 B' / '1.23 KiB' / '4.56 MiB' / '7.89 GiB' (half-up,
    integer arithmetic)."""
    b = _c(nbytes).cast("long")

    def unit(div: int, name: str) -> Column:
        v = _intdiv(b * 200 + div, F.lit(2 * div)).cast("long")
        return F.concat((v / 100).cast("long").cast("string"), F.lit("."),
                        F.lpad(F.pmod(v, F.lit(100)).cast("string"), 2, "0"), F.lit(" " + name))
    return (F.when(b < 1024, F.concat(b.cast("string"), F.lit(" B")))
             .when(b < 1024 ** 2, unit(1024, "KiB"))
             .when(b < 1024 ** 3, unit(1024 ** 2, "MiB"))
             .otherwise(unit(1024 ** 3, "GiB")))


def last_word(s) -> Column:
    return F.split_part(F.trim(_c(s)), F.lit(" "), F.lit(-1))


def digits_only(s) -> Column:
    """regexp_replace(s, '[^0-9]', '') as int (NULL when no digits)."""
    return F.expr("try_cast(regexp_replace({}, '[^0-9]', '') AS INT)".format(_name(s)))


def first_capital(s) -> Column:
    """first capital letter (regexp strip + substring)."""
    return F.substring(F.regexp_replace(_c(s), "[^A-Z]", ""), 1, 1)


def is_palindrome(s) -> Column:
    return F.reverse(_c(s)) == _c(s)


def _name(s) -> str:
    return f"`{s}`" if isinstance(s, str) else s._jc.toString()
