"""Column-level helpers: casts, repairs, parsers, derived features.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen; nothing runs per row in Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- casts
def tolerant_cast(c, dtype: str) -> Column:
    """Bad input becomes NULL instead of failing the job."""
    return _c(c).try_cast(dtype)


def default_if_null(c, default) -> Column:
    """A column that drifted in late: NULL where a source never had it."""
    return F.coalesce(_c(c), F.lit(default))


# ---------------------------------------------------------------- repairs
def blank_to_null(c, *sentinels: str) -> Column:
    """Trimmed text, with '' and any sentinel ('N/A', 'NULL', ...) as NULL."""
    out = F.nullif(F.trim(_c(c)), F.lit(""))
    for s in sentinels:
        out = F.nullif(out, F.lit(s))
    return out


def strip_thousands(c) -> Column:
    """Digits without their group separators ('27,450' -> '27450'), so that a numeric cast can succeed."""
    return F.replace(_c(c), F.lit(","), F.lit(""))


def tolerant_int(c) -> Column:
    """Blank, separators and garbage tolerated: text -> int or NULL."""
    return strip_thousands(blank_to_null(c)).try_cast("int")


def repair_smart_quote(c) -> Column:
    """cp1252 right single quote decoded as Latin-1 (U+0092) -> ASCII quote."""
    return F.replace(_c(c), F.lit("\u0092"), F.lit("'"))


# ---------------------------------------------------------------- numbers
def round_half_up(c, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d.

    Used instead of ``round`` where results must be bit-identical with other
    engines: every step is one IEEE operation, so any engine agrees.
    """
    scale = float(10 ** digits)
    return F.floor(_c(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def safe_ratio(num, den) -> Column:
    """num / den with a zero denominator giving NULL (never an error)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


# ---------------------------------------------------------------- time
def elapsed_seconds(start, end) -> Column:
    """Whole seconds from start to end (negative when end is earlier)."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def iso_dow(c) -> Column:
    """ISO day of week, Monday=1 .. Sunday=7."""
    return F.weekday(_c(c)) + F.lit(1)


def weekend_flag(c) -> Column:
    return F.when(iso_dow(c).isin(6, 7), F.lit(1)).otherwise(F.lit(0))


def flag(pred: Column) -> Column:
    """0/1 integer flag (the data model uses ints, not booleans)."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def parse_date(c, fmt: str, strict: bool = False) -> Column:
    """Fixed-format date parse; ``strict`` raises on bad input."""
    return F.to_date(_c(c), fmt) if strict else F.try_to_date(_c(c), fmt)


def parse_date_any(c, formats: list[str]) -> Column:
    """First format that parses wins; none -> NULL."""
    return F.coalesce(*[F.try_to_date(_c(c), f) for f in formats])


def parse_iso_timestamp(c) -> Column:
    """ISO-8601 text (with or without trailing 'Z') -> timestamp_ntz or NULL."""
    return _c(c).try_cast("timestamp_ntz")


# ---------------------------------------------------------------- text
def char_count(c) -> Column:
    return F.length(_c(c))


def word_count(c) -> Column:
    """Whitespace-separated tokens of the trimmed text ('' counts as 1)."""
    return F.size(F.split(F.trim(_c(c)), r"\s+"))


def file_basename(c) -> Column:
    """Last path segment of a path or URL."""
    return F.regexp_extract(_c(c), r"[^/]+$", 0)


# ---------------------------------------------------------------- json
_END = "end-of-value"


def once(c) -> Column:
    """The value as a generated column, computed once per row: the optimizer neither copies the
    expression into every projection that names it nor pushes a filter on it below."""
    return F.explode(F.array(_c(c)))


def one_json_value(c) -> Column:
    """The text parsed as the first element of ``[text, end mark]``, as a VARIANT.

    The parser ignores what follows a complete value, so the text is closed in by
    an array: several values, trailing text or an early bracket change the array.
    """
    return F.try_parse_json(F.concat(F.lit("["), _c(c), F.lit(f',"{_END}"]')))


def is_one_value(v) -> Column:
    """Whether a VARIANT of ``one_json_value`` is exactly [value, end mark]."""
    v = _c(v)
    return (F.try_variant_get(v, "$[1]", "string").eqNullSafe(F.lit(_END))
            & F.try_variant_get(v, "$[2]", "variant").isNull())


def json_valid(c) -> Column:
    """The whole text is one JSON value; NULL and blank texts are not."""
    return is_one_value(one_json_value(c))


def variant_field(v, path: str, dtype: str) -> Column:
    """Field of an already parsed VARIANT; missing or uncastable -> NULL."""
    return F.try_variant_get(_c(v), path, dtype)


def json_text(c, path: str) -> Column:
    """Text at a JSON path ('$.a.b'); missing key or malformed -> NULL."""
    return F.get_json_object(_c(c), path)


def json_typed(c, path: str, dtype: str) -> Column:
    """Extract as text, then tolerant cast: survives type-unstable keys."""
    return json_text(c, path).try_cast(dtype)


# ---------------------------------------------------------------- rules
def all_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)
