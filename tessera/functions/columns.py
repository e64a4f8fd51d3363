"""Column -> Column functions (cleaning and scalar feature maths).

All of these are native Spark expressions: they stay inside whole-stage
codegen and need no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Missing-value tokens recognised by normalise_missing (S3).
MISSING_TOKENS = ("NA", "N/A", "na", "NaN", "?", "-999")

# Textual markers treated as "no value" by parse_money.
MONEY_EMPTY = ("", "nan", "none", "-")

# Strict decimal literal: optional sign, digits with optional fraction, optional exponent.
_NUMERIC_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_numeric(c) -> Column:
    """Parse text as a double, NULL when it is not a plain number.

    ``try_cast`` alone accepts ``'12d'`` and ``'nan'``; the regex guard keeps
    the pandas ``errors='coerce'`` meaning.  Numeric input passes through.
    """
    s = F.trim(_c(c).cast("string"))
    return F.when(s.rlike(_NUMERIC_RE), s.try_cast("double"))


def strip_thousands(c) -> Column:
    """Drop thousands separators and surrounding blanks."""
    return F.trim(F.regexp_replace(_c(c).cast("string"), ",", ""))


def first_year(c) -> Column:
    """The first run of four digits as a double (NULL when none)."""
    return F.nullif(F.regexp_extract(_c(c).cast("string"), r"(\d{4})", 1), F.lit("")).cast("double")


def range_start_year(c) -> Column:
    """C4: text before an en dash after dropping parentheses, parsed as number."""
    s = F.regexp_replace(_c(c).cast("string"), r"[()]", "")
    return to_numeric(F.split(s, "–").getItem(0))


def parse_money(c, naive: bool = False) -> Column:
    """Money text to a double.

    Default (C5): currency signs ($, EUR sign, GBP sign) and commas removed, an
    optional K/M/B suffix (any case) multiplies by 1e3/1e6/1e9, and empty,
    'nan', 'none', '-' become NULL.  ``naive=True`` (C6) reproduces the textual
    rewrite that drops '$' and 'M' and turns 'K' into '000'.
    """
    raw = F.trim(_c(c).cast("string"))
    if naive:
        s = F.replace(F.replace(F.replace(raw, F.lit("$"), F.lit("")), F.lit("M"), F.lit("")),
                      F.lit("K"), F.lit("000"))
        return to_numeric(s)
    s = F.trim(F.translate(raw, "$€£,", ""))
    low = F.lower(s)
    suffix = F.upper(F.regexp_extract(s, r"([kKmMbB])$", 1))
    mult = (F.when(suffix == "K", F.lit(1e3)).when(suffix == "M", F.lit(1e6))
            .when(suffix == "B", F.lit(1e9)).otherwise(F.lit(1.0)))
    body = F.regexp_replace(s, r"[kKmMbB]$", "")
    return F.when(raw.isNull() | low.isin(*MONEY_EMPTY), F.lit(None).cast("double")) \
        .otherwise(to_numeric(body) * mult)


def clean_text(c) -> Column:
    """Newlines to spaces, then trim."""
    return F.trim(F.regexp_replace(_c(c).cast("string"), r"[\r\n]+", " "))


def to_datetime(c, fmt: str | None = None) -> Column:
    """Parse a wall-clock timestamp (TIMESTAMP_NTZ), NULL when unparseable."""
    s = _c(c).cast("string")
    t = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    return t.cast("timestamp_ntz")


def normalise_token(c, tokens=MISSING_TOKENS) -> Column:
    """S3 for one column: trimmed text, NULL when it is a missing-value token."""
    s = F.trim(_c(c))
    return F.when(~s.isin(*tokens), s)


def log1p_safe(c) -> Column:
    """log(1+x); NULL (not -inf/NaN) for x <= -1."""
    x = _c(c)
    return F.when(x > -1, F.log1p(x))


def safe_ratio(a, b, fill: float | None = 0.0) -> Column:
    """a / b with a zero or NULL denominator giving ``fill``."""
    r = F.try_divide(_c(a), F.nullif(_c(b), F.lit(0)))
    return r if fill is None else F.coalesce(r, F.lit(float(fill)))


def delta(a, b) -> Column:
    """trend b - a."""
    return _c(b) - _c(a)


def mean_of(*cols) -> Column:
    """arithmetic mean of the given columns (NULL if any is NULL)."""
    total = _c(cols[0])
    for c in cols[1:]:
        total = total + _c(c)
    return total / F.lit(float(len(cols)))


def binary_encode(c) -> Column:
    """F8: integer to its binary digits as text, NULL kept."""
    return F.bin(_c(c).cast("bigint"))


def linear_class_round(pred, k: int) -> Column:
    """M5: regression output to a class index: round half-even, clip to [0, k-1]."""
    return F.greatest(F.lit(0), F.least(F.lit(k - 1), F.bround(_c(pred), 0))).cast("int")


def hash_unit(key, seed: int | str = 42) -> Column:
    """Uniform value in [0, 1) from md5(key ':' seed) -- engine independent.

    The first 13 hex digits (52 bits) are read as an integer and scaled.
    """
    h = F.md5(F.concat(_c(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))
