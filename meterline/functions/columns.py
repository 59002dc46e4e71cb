"""Column builders for the staging and mart models.

All of them are plain Catalyst expressions (no UDFs), so they stay inside
whole-stage codegen and are evaluated where the data sits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(c: str | Column, digits: int) -> Column:
    """Round a double to ``digits`` decimals, half away from zero, on the
    binary value: ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``.

    Spark's ``round(x, d)`` rounds the decimal text of the double, so a
    value sitting on a tie can round differently from engines that round
    in binary; this form is the same IEEE arithmetic everywhere."""
    x = _col(c)
    scale = F.lit(float(10 ** digits))
    rounded = F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale
    # from 2^52 on a double has no digits left to round; NaN and infinity compare as larger
    return F.when(F.abs(x) * scale >= F.lit(float(1 << 52)), x).otherwise(rounded)


EXACT_SCALE = 6


def exact_total(c: str | Column, scale: int = EXACT_SCALE) -> Column:
    """Exact sum of a double column as DECIMAL(38, scale), for finite values
    with at most ``scale`` decimals (money, miles); see ``exact_sum`` for others.

    Each value is split into whole units and millionths (for scale 6), both
    summed as BIGINT: integer addition is exact and order-free, so the total
    is the same on any partitioning, and it runs at the speed of a double
    sum (a DECIMAL(38) buffer is several times slower). The two totals are
    combined once per group. BIGINT overflow raises under ANSI mode rather
    than wrapping; the fractional total stays below 10^18 up to 10^12 rows."""
    x = _col(c)
    k = 10 ** scale
    units = F.floor(x)
    frac = F.floor((x - units) * F.lit(float(k)) + F.lit(0.5))
    return (F.sum(units).cast(f"decimal(38,{scale})")
            + (F.sum(frac).cast("decimal(38,0)") / F.lit(k).cast("decimal(38,0)"))).cast(f"decimal(38,{scale})")


def exact_sum(c: str | Column, scale: int = EXACT_SCALE) -> Column:
    """``exact_total`` as a double: identical on every cluster layout, and
    re-aggregations (rollups) equal the base query. A group that holds a NaN,
    an infinity or a value without ``scale`` decimals to spare (from 2^52 /
    10^scale on) gets the plain double sum instead."""
    x = _col(c)
    return F.when(F.max(beyond_exact(x, scale)), F.sum(x)).otherwise(exact_total(F.when(~beyond_exact(x, scale), x), scale).cast("double"))


def beyond_exact(c: str | Column, scale: int = EXACT_SCALE) -> Column:
    """Whether a double cannot take part in ``exact_total``."""
    return F.abs(_col(c)) * F.lit(float(10 ** scale)) >= F.lit(float(1 << 52))


def exact_avg(c: str | Column, scale: int = EXACT_SCALE) -> Column:
    """Average as ``exact_sum / count`` (NULL when no non-NULL values)."""
    n = F.count(_col(c))
    return F.when(n > 0, exact_sum(c, scale) / n)


def to_decimal(c: str | Column, precision: int = 10, scale: int = 2) -> Column:
    """double -> DECIMAL(p,s), scaling by 10^s and rounding first (the
    reference's cast), so 1.005 becomes 1.00 rather than 1.01."""
    k = float(10 ** scale)
    return (F.round(_col(c) * F.lit(k), 0) / F.lit(k)).cast(f"decimal({precision},{scale})")


def as_decimal_2(c: str | Column) -> Column:
    """double -> DECIMAL(10,2) (the calculated-total cast)."""
    return to_decimal(c, 10, 2)


def null_safe_sum(*cols: str | Column) -> Column:
    """Sum of components where a NULL component counts as 0."""
    total = None
    for c in cols:
        term = F.coalesce(_col(c), F.lit(0))
        total = term if total is None else total + term
    return total


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def unit_boundaries(start: str | Column, end: str | Column, unit: str) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``
    (negative when ``end`` is earlier); for minutes 00:00:59 -> 00:02:01
    gives 2, where elapsed whole minutes would give 1."""
    s = F.unix_seconds(F.date_trunc(unit, _col(start).cast("timestamp")))
    e = F.unix_seconds(F.date_trunc(unit, _col(end).cast("timestamp")))
    return ((e - s) / F.lit(_UNIT_SECONDS[unit])).cast("bigint")


def minute_boundaries(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries crossed (the trip duration rule)."""
    return unit_boundaries(start, end, "minute")


def month_boundaries(start: str | Column, end: str | Column) -> Column:
    """Calendar-month boundaries crossed: Jan 31 -> Feb 1 gives 1."""
    s, e = _col(start), _col(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("bigint")


def day_of_week_sunday0(c: str | Column) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday, as BIGINT."""
    return (F.dayofweek(_col(c)) - 1).cast("bigint")


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den when den > 0, else 0 (also when den is NULL)."""
    d = _col(den)
    return F.when(d > 0, _col(num) / d).otherwise(F.lit(0.0))


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (NULL counts as not holding)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


# Exact numeric form for comparing keys of different types.
NUMERIC_KEY = "decimal(38,10)"


def key_form(key_type):
    """The form in which a text id meets a key of that type: numeric keys as
    exact decimals, all others as text."""
    if isinstance(key_type, NumericType):
        return lambda c: c.try_cast(NUMERIC_KEY)
    return lambda c: c.cast("string")


def text_key_equals(text_key: Column, key: Column, key_type) -> Column:
    """Equality of a text id against a dimension key of any type.

    Text ids produced from doubles read ``'1.0'``; when the dimension key is
    numeric compare as exact decimals (``try_cast`` keeps junk text a
    non-match, and integer ids beyond 2^53 stay distinct)."""
    if isinstance(key_type, NumericType):
        return text_key.try_cast(NUMERIC_KEY) == key.try_cast(NUMERIC_KEY)
    if isinstance(key_type, StringType):
        return text_key == key
    return text_key == key.cast("string")
