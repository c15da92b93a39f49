"""Integer-millisecond time arithmetic.

Python's ``//`` floors while Spark's ``div`` truncates, so every division that may see a
negative operand goes through :func:`floor_div`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_SECOND = 1000


def _col(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def int_div(a: Column, b: Column) -> Column:
    """Spark's integral ``div`` (truncating, BIGINT result)."""
    return F.call_function("div", a, b)


def floor_div(a: Column, b: Column) -> Column:
    return int_div(a - F.pmod(a, b), b)


def _positive(value: Column, what: str) -> Column:
    return F.when(value > 0, value).otherwise(
        F.raise_error(F.concat(F.lit(what + " must be positive, got "), value.cast("string")))
    )


def ticks_to_ms(pts, num, den) -> Column:
    """Ticks under a ``num/den`` seconds-per-tick time base to ms, rounding half up.

    The product can leave 64 bits, hence DECIMAL(38,0).
    """
    den = _positive(_col(den).cast("bigint"), "time-base denominator").cast("decimal(19,0)")
    scaled = (
        _col(pts).cast("decimal(19,0)") * _col(num).cast("decimal(10,0)") * F.lit(MS_PER_SECOND)
    )
    half = int_div(den, F.lit(2).cast("decimal(19,0)")).cast("decimal(19,0)")
    return floor_div((scaled + half).cast("decimal(38,0)"), den)


def samples_to_ms(n_samples, sample_rate) -> Column:
    """Sample count to ms, rounding half up."""
    rate = _positive(_col(sample_rate).cast("bigint"), "sample_rate")
    shifted = _col(n_samples).cast("bigint") * F.lit(MS_PER_SECOND) + int_div(rate, F.lit(2))
    return floor_div(shifted, rate)


def ms_to_samples(ms, sample_rate) -> Column:
    """Ms to a position on the sample grid (floor)."""
    return floor_div(
        _col(ms).cast("bigint") * _col(sample_rate).cast("bigint"),
        F.lit(MS_PER_SECOND).cast("bigint"),
    )


def seconds_to_ms(seconds) -> Column:
    """Float seconds to ms, half to even; for ingesting model output only."""
    return F.rint(_col(seconds).cast("double") * F.lit(1000.0)).cast("bigint")


def pct(part, whole) -> Column:
    """``100 * part / whole``, or 0 when ``whole`` is zero."""
    part, whole = _col(part), _col(whole)
    return F.when(
        whole != 0, F.lit(100.0) * part.cast("double") / whole.cast("double")
    ).otherwise(F.lit(0.0))


def fmt_ms(ms) -> Column:
    """``[-]MM:SS.mmm`` with unbounded minutes."""
    ms = _col(ms).cast("bigint")
    mag = F.abs(ms)
    return F.format_string(
        "%s%02d:%02d.%03d",
        F.when(ms < 0, F.lit("-")).otherwise(F.lit("")),
        int_div(mag, F.lit(60000)),
        F.pmod(int_div(mag, F.lit(1000)), F.lit(60)),
        F.pmod(mag, F.lit(1000)),
    )


def utc_stamp(ts) -> Column:
    """ISO-8601 UTC stamp with truncated milliseconds. The session time zone must be UTC."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
