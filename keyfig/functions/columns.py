"""Column expressions (``Column -> Column``) used throughout the pipeline.

All of them are built from ``pyspark.sql.functions`` so they stay inside whole-stage codegen;
none is a Python UDF.
"""

from __future__ import annotations

import unicodedata
from functools import reduce
from operator import and_
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyfig.plans.config import DEFAULT_SENTINELS, DEFAULT_TIER_ELSE, DEFAULT_TIERS

# Surrogate-key convention (separator and NULL token) so keys equal the
# ones the original models generate.
KEY_SEPARATOR = "-"
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

# A plain decimal number: optional sign, digits with an optional fraction, optional exponent.
# Anything else ("12d", "1,5" before locale handling, "Infinity") is not a number.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- sentinels and numbers (S4, F8, N1-N7) -------------------------------------------------

def null_if_sentinel(c: str | Column, sentinels: Iterable[str] = DEFAULT_SENTINELS) -> Column:
    """NULL when the trimmed text is a suppression marker, the value itself otherwise."""
    c = _col(c)
    return F.when(~F.trim(c).isin(list(sentinels)), c)


def parse_number(c: str | Column, decimal_comma: bool = False,
                 sentinels: Iterable[str] = DEFAULT_SENTINELS) -> Column:
    """Tolerant text -> double: sentinels, blanks and non-numbers become NULL (never NaN)."""
    text = F.trim(_col(c))
    if decimal_comma:
        text = F.regexp_replace(text, ",", ".")
    return (F.when(text.isin(list(sentinels)), F.lit(None).cast("double"))
            .when(text.rlike(NUMBER_PATTERN), text.try_cast("double")))


def strict_int(c: str | Column, what: str = "value") -> Column:
    """Text -> int that fails the job on malformed input (independent of ANSI mode)."""
    c = _col(c)
    return (F.when(c.isNull(), F.lit(None).cast("int"))
            .when(c.rlike(INTEGER_PATTERN), F.trim(c).cast("int"))
            .otherwise(F.raise_error(F.concat(F.lit(f"malformed integer {what}: "), c))
                       .cast("int")))


# --- periods (F1-F6) ----------------------------------------------------------------------

def period_year(c: str | Column) -> Column:
    return strict_int(F.left(_col(c), F.lit(4)), "period year")


def period_sub(c: str | Column, width: int) -> Column:
    """Trailing sub-period number: ``right(s, 1)`` for quarters, ``right(s, 2)`` for months."""
    return strict_int(F.right(_col(c), F.lit(width)), "sub-period")


def period_to_date(c: str | Column) -> Column:
    """Period string -> first day: ``2023`` -> Jan 1, ``2023K3``/``2023Q3`` -> Jul 1,
    ``2023M06`` -> Jun 1; any other text -> NULL."""
    s = _col(c)
    year = F.substring(s, 1, 4).cast("int")
    quarter = F.substring(s, 6, 1).cast("int")
    month = F.substring(s, 6, 2).cast("int")
    return (F.when(s.rlike(r"^[0-9]{4}\z"), F.make_date(year, F.lit(1), F.lit(1)))
            .when(s.rlike(r"^[0-9]{4}[KQ][1-4]\z"),
                  F.make_date(year, (quarter - 1) * 3 + 1, F.lit(1)))
            .when(s.rlike(r"^[0-9]{4}M(0[1-9]|1[0-2])\z"), F.make_date(year, month, F.lit(1))))


def month_string(ts: str | Column) -> Column:
    ts = _col(ts)
    return F.concat(F.year(ts).cast("string"), F.lit("M"), F.lpad(F.month(ts).cast("string"), 2, "0"))


# --- keys, rounding, ratios, bands, flags (F10, F13, P8-P14) -------------------------------

def surrogate_key(*cols: str | Column) -> Column:
    """MD5 over the key columns joined by '-', NULL replaced by a fixed token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


#: From here on a double has no fraction, so there is nothing to round.
WHOLE_FROM = 2.0**52


def round_half_up(c: str | Column, digits: int) -> Column:
    """Round once, half away from zero, on the shortest decimal text of the double, so that ties
    resolve identically in every engine and at any magnitude.  NaN and infinities (e.g. a
    correlation over constant input) become NULL."""
    c = _col(c).cast("double")
    finite = ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    fraction = F.when(F.abs(c) < F.lit(WHOLE_FROM), c)   # 16 digits before the point at most
    return F.when(finite, F.when(F.abs(c) >= F.lit(WHOLE_FROM), c)
                  .otherwise(F.round(fraction.cast("decimal(38,20)"), digits).cast("double")))


def exact_sum(c: str | Column) -> Column:
    """Sum of doubles that does not depend on the order of the rows: added up as decimals with
    12 places; only where a value has no fraction left are doubles added instead."""
    c = _col(c).cast("double")
    small = F.abs(c) < F.lit(1e15)
    exact = F.sum(F.when(small, c).cast("decimal(38,12)")).cast("double")
    return F.when(F.count_if(~small) > 0, F.sum(c)).otherwise(exact)


def exact_avg(c: str | Column) -> Column:
    """Mean of the non-NULL values: one exact sum, one division."""
    c = _col(c)
    return exact_sum(c) / F.when(F.count(c) > 0, F.count(c))


def value_map(c: str | Column, mapping: dict[str, str]) -> Column:
    """Simple CASE: mapped value, NULL when no key matches."""
    c = _col(c)
    out = None
    for key, value in mapping.items():
        out = F.when(c == F.lit(key), F.lit(value)) if out is None else out.when(c == F.lit(key), F.lit(value))
    return out if out is not None else F.lit(None).cast("string")


def band(c: str | Column, tiers=DEFAULT_TIERS, otherwise: str = DEFAULT_TIER_ELSE) -> Column:
    """Ordered bands with strict ``>`` bounds; NULL input stays NULL."""
    c = _col(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for bound, label in tiers:
        out = out.when(c > F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(otherwise))


def all_not_null(*cols: str | Column) -> Column:
    """True when every column is non-NULL; never NULL itself."""
    return reduce(and_, [_col(c).isNotNull() for c in cols])


def equals_flag(c: str | Column, expected) -> Column:
    """``c = expected`` with NULL read as false (full-period flag)."""
    return F.coalesce(_col(c) == F.lit(expected), F.lit(False))


def safe_ratio(numerator: str | Column, denominator: str | Column, scale: float = 1.0,
               digits: int = 2) -> Column:
    """Rounded ``numerator * scale / denominator`` only when the denominator is positive and
    the numerator known; NULL otherwise (never a division by zero)."""
    n, d = _col(numerator), _col(denominator)
    return F.when((d > 0) & n.isNotNull(), round_half_up(n * F.lit(scale) / d, digits))


_BYTE_ORDER_MARK = "\ufeff"


def normalise_header(name: str) -> str:
    """The column name of a header cell: its words in upper case, joined by '_'.

    Words are what white space of any kind (tabs and no-break spaces too) and byte-order marks
    separate; runs of them count once.  The name is composed (Unicode NFC), so that an accent
    typed as a letter and a mark is the letter with the accent."""
    composed = unicodedata.normalize("NFC", name.replace(_BYTE_ORDER_MARK, " "))
    return "_".join(word.upper() for word in composed.split())
