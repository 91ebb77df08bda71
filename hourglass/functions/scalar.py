"""Column-level helpers (inventory H1-H30).

Every helper takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen.
ANSI mode is assumed on: parsing uses ``try_cast`` and division uses
``try_divide`` wherever bad input must become NULL instead of raising.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------------- text
def strip_percent(col: ColumnOrName) -> Column:
    """H1: remove every ``%`` sign from a text value."""
    return F.regexp_replace(_c(col), "%", "")


def nan_to_null(col: ColumnOrName) -> Column:
    """Spark ``avg`` propagates NaN while pandas skips it: map NaN to NULL."""
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_number(col: ColumnOrName) -> Column:
    """H2: text to double, unparsable or NaN text -> NULL (never raises)."""
    return nan_to_null(_c(col).try_cast("double"))


def age_int(col: ColumnOrName) -> Column:
    """H3: age text -> int; ``'> 89'`` -> 89, ``''`` -> NULL."""
    c = _c(col)
    return F.nullif(F.replace(c, F.lit("> 89"), F.lit("89")), F.lit("")).try_cast("int")


def contains_flag(col: ColumnOrName, text: str) -> Column:
    """H4: 1 when the text contains ``text`` else 0 (NULL text -> 0)."""
    return F.coalesce(_c(col).contains(text).cast("int"), F.lit(0))


def age_float(col: ColumnOrName) -> Column:
    """H5: drop the ``'> '`` prefix and parse as double."""
    return F.regexp_replace(_c(col), "> ", "").try_cast("double")


def map_values(col: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """H6: value map as a ``CASE`` chain; unmatched (and NULL) -> ``default``."""
    c = _c(col)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def fill_const(col: ColumnOrName, value) -> Column:
    """H7: replace NULL by a constant."""
    return F.coalesce(_c(col), F.lit(value))


def is_missing(col: ColumnOrName) -> Column:
    """H8: 1 if NULL else 0."""
    return _c(col).isNull().cast("int")


def clip(col: ColumnOrName, lo: float | None = -4.0, hi: float | None = 4.0) -> Column:
    """H9: bound to [lo, hi]; NULL stays NULL (``greatest``/``least`` skip NULLs)."""
    c = _c(col)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)


def clock_hour(col: ColumnOrName) -> Column:
    """Hour of a ``HH:mm:ss`` clock text."""
    return F.hour(F.try_to_timestamp(_c(col), F.lit("HH:mm:ss")))


def ts_hour(col: ColumnOrName) -> Column:
    """Hour of a timestamp."""
    return F.hour(_c(col))


def ts_year(col: ColumnOrName) -> Column:
    """Year of a timestamp."""
    return F.year(_c(col))


def micros_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Elapsed microseconds ``end - start``.

    ``timestamp_diff`` works on wall-clock values for TIMESTAMP_NTZ, so the
    result does not depend on the session time zone (casting to TIMESTAMP
    first would shift by an hour across a daylight-saving change).
    """
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``floor((end - start) / 1 min)`` as a long (negative when end < start)."""
    return F.floor(micros_between(start, end) / F.lit(60_000_000))


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``floor((end - start) / 1 h)`` as a long."""
    return F.floor(micros_between(start, end) / F.lit(3_600_000_000))


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Fractional days ``(end - start) / 86400 s``."""
    return micros_between(start, end) / F.lit(86_400_000_000.0)


def hour_ceil(offset_min: ColumnOrName) -> Column:
    """Minute offset -> hour rounded up (61 -> 2, 60 -> 1, -61 -> -1)."""
    return F.ceil(_c(offset_min) / F.lit(60)).cast("long")


def cyclic_unit(col: ColumnOrName, n: int = 24) -> Column:
    """``linspace(0, 1, n)[x mod n]`` = ``pmod(x, n) / (n - 1)``."""
    return F.pmod(_c(col), F.lit(n)).cast("double") / F.lit(float(n - 1))


def split_path(col: ColumnOrName, sep: str = "|") -> Column:
    """Split a code path on a literal separator."""
    import re

    return F.split(_c(col), re.escape(sep))


def strip_literals(col: ColumnOrName, literals: Sequence[str]) -> Column:
    """Remove each literal substring in turn."""
    out = _c(col)
    for lit in literals:
        out = F.replace(out, F.lit(lit), F.lit(""))
    return out


def path_prefixes(parts: ColumnOrName, max_depth: int = 5, exact_depth: int | None = 6,
                  sep: str = "|") -> Column:
    """Cumulative prefixes ``a``, ``a|b``, ``a|b|c``... of a split path.

    Depths 1..``max_depth`` are produced for every path; a path with exactly
    ``exact_depth`` levels also yields its full depth (paths with more levels
    stop at ``max_depth``).
    """
    p = _c(parts)
    n = F.size(p)
    depth = F.least(n, F.lit(max_depth))
    if exact_depth is not None:
        depth = F.when(n == F.lit(exact_depth), n).otherwise(depth)
    return F.transform(F.sequence(F.lit(1), depth),
                       lambda i: F.array_join(F.slice(p, F.lit(1), i), sep))


def first_word(col: ColumnOrName) -> Column:
    """Text up to the first space, ``/`` or ``,``."""
    return F.regexp_extract(_c(col), r"^[^ /,]*", 0)


def eq_ignore_case(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Case-insensitive equality."""
    return F.lower(_c(a)) == F.lower(_c(b))


def round_half_even(col: ColumnOrName, scale: int = 0) -> Column:
    """bankers' rounding (Python ``round``)."""
    return F.bround(_c(col), scale)


def los_link(col: ColumnOrName, lo: float = 1 / 48, hi: float = 100.0) -> Column:
    """``clip(exp(x), lo, hi)`` days."""
    return F.least(F.greatest(F.exp(_c(col)), F.lit(lo)), F.lit(hi))


def risk_link(col: ColumnOrName) -> Column:
    """Logistic link."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(col)))


def zero_to_null(col: ColumnOrName) -> Column:
    """0 -> NULL."""
    return F.nullif(_c(col), F.lit(0))


def nan_to_zero(col: ColumnOrName) -> Column:
    """NaN or NULL -> 0."""
    return F.coalesce(nan_to_null(col), F.lit(0.0))


def to_bool(col: ColumnOrName) -> Column:
    """Numeric flag -> boolean."""
    return _c(col).cast("boolean")


# The ten length-of-stay bins in days used by the regression report.
# Bin i holds lo <= x < hi.  (-inf,1) [1,2) [2,3) [3,4) [4,5) [5,6) [6,7) [7,8) [8,14) [14,inf)
LOS_BIN_EDGES = (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 14.0)


def los_bin(col: ColumnOrName) -> Column:
    """Bin index 0..9 for a length of stay in days (NULL stays NULL)."""
    c = _c(col)
    out = F.when(c.isNull(), F.lit(None).cast("int"))
    for i, edge in enumerate(LOS_BIN_EDGES):
        out = out.when(c < F.lit(edge), F.lit(i))
    return out.otherwise(F.lit(len(LOS_BIN_EDGES)))


def to_float(col: ColumnOrName) -> Column:
    """Cast to double."""
    return _c(col).cast("double")


def scale_between(col: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """``2 * (x - lo) / (hi - lo) - 1`` with pandas' edge cases.

    When ``hi == lo`` pandas divides by zero: a positive numerator gives +inf, a
    negative one -inf and 0/0 gives NaN.  We return +/-inf and NULL for those so
    a following :func:`clip` maps them to +/-4 and NULL like the reference.
    """
    x, a, b = _c(col), _c(lo), _c(hi)
    num = F.lit(2.0) * (x - a)
    span = b - a
    inf = F.lit(float("inf"))
    return (F.when(x.isNull() | a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(span == 0, F.when(num > 0, inf).when(num < 0, -inf)
                  .otherwise(F.lit(None).cast("double")))
            .otherwise(num / span - F.lit(1.0)))
