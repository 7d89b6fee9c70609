"""Column expressions shared by the operators.

All are built-in ``pyspark.sql.functions`` compositions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's float() grammar after strip(): decimal digits with single
# underscores between digits, optional fraction and exponent, or the
# nan / inf / infinity words.  Java-only forms such as "12d" or hex are
# rejected even though Spark's cast would take them.
_DIGITS = r"[0-9](_?[0-9])*"
PY_FLOAT_RE = (
    rf"^[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?"
    r"|(?i:nan|inf|infinity))$"
)


def py_strip(c: Column) -> Column:
    """``str.strip()``: removes surrounding whitespace incl. tabs/newlines."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")


def is_py_float(stripped: Column) -> Column:
    return stripped.rlike(PY_FLOAT_RE)


def py_float(stripped: Column) -> Column:
    """``float(text)`` or null where Python would raise."""
    low = F.lower(stripped)
    plain = F.regexp_replace(stripped, "_", "")
    return (
        F.when(~is_py_float(stripped), F.lit(None).cast("double"))
        .when(low.rlike(r"^[+-]?nan$"), F.lit(float("nan")))
        .when(low.rlike(r"^-inf(inity)?$"), F.lit(float("-inf")))
        .when(low.rlike(r"^\+?inf(inity)?$"), F.lit(float("inf")))
        .otherwise(plain.try_cast("double"))
    )


def fmt_fixed(c: Column, decimals: int) -> Column:
    """Python ``f"{x:.Nf}"``.

    ``format_number`` rounds the exact binary value half-to-even, as Python
    does (``format_string`` rounds the shortest decimal text half-up, which
    differs on values such as 0.15 or 95.25); the grouping commas it adds are
    removed.
    """
    return F.regexp_replace(F.format_number(c, decimals), ",", "")


def patient_key(c: Column) -> Column:
    """Fixture patient id: ``P`` + six-digit zero-padded number."""
    return F.concat(F.lit("P"), F.lpad(c.cast("string"), 6, "0"))


def category(reason: Column, trim: bool = False) -> Column:
    """Error category: text before the first ``:`` (whole text without one)."""
    head = F.substring_index(reason, ":", 1)
    return F.trim(head) if trim else head


_ISO_RE = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
           r"([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?)?"
           r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)?$")


def parse_birthdate(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")


def parse_iso_date(c: Column) -> Column:
    """Date part of an ISO-8601 text as written (no zone shift); null when
    the text is not ISO-8601, like ``datetime.fromisoformat``."""
    return F.when(c.rlike(_ISO_RE), F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")).cast("date"))


def age_years(b: Column, r: Column) -> Column:
    """Whole years from date ``b`` to date ``r``, birthday-aware, clamped to
    0..120; -1 when either date is null."""
    years = F.year(r) - F.year(b) - F.when(
        (F.month(r) < F.month(b)) | ((F.month(r) == F.month(b)) & (F.dayofmonth(r) < F.dayofmonth(b))), 1
    ).otherwise(0)
    return F.when(b.isNull() | r.isNull(), F.lit(-1)).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(120), years))).cast("int")


def age_at(birthdate: Column, ref_iso: Column) -> Column:
    """Age at an ISO date from a ``yyyy-MM-dd`` birth date (see age_years).
    For wide projections prefer staging the two parsed dates as columns."""
    return age_years(parse_birthdate(birthdate), parse_iso_date(ref_iso))


def py_repr(c: Column) -> Column:
    """Python ``repr(float)`` text of a double.

    Spark's cast to string uses Java's notation ("1.0E7", "Infinity"); Python
    switches to exponent form only below 1e-4 or from 1e16 on, and writes
    "1e+16", "1.5e-05", "inf", "nan".
    """
    s = c.cast("string")
    pat = r"^(-?)([0-9])\.([0-9]+)E(-?[0-9]+)$"
    sign = F.regexp_extract(s, pat, 1)
    d0 = F.regexp_extract(s, pat, 2)
    rest = F.regexp_extract(s, pat, 3)
    e = F.regexp_extract(s, pat, 4).cast("int")
    digits = F.when(rest == "0", d0).otherwise(F.concat(d0, rest))
    n = F.length(digits)
    mant = F.when(rest == "0", d0).otherwise(F.concat(d0, F.lit("."), rest))
    big_plain = F.when(e >= n - 1, F.concat(sign, digits, F.repeat(F.lit("0"), e - n + 1), F.lit(".0"))) \
        .otherwise(F.concat(sign, digits.substr(F.lit(1), e + 1), F.lit("."), digits.substr(e + 2, F.lit(1000))))
    small_plain = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    sci = F.concat(sign, mant, F.lit("e"), F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.lpad(F.abs(e).cast("string"), 2, "0"))
    return (
        F.when(F.isnan(c), F.lit("nan"))
        .when(c == float("inf"), F.lit("inf"))
        .when(c == float("-inf"), F.lit("-inf"))
        .when(~s.rlike("E"), s)
        .when((e >= 7) & (e < 16), big_plain)
        .when(e == -4, small_plain)
        .otherwise(sci)
    )
