"""Column expressions. All are built-in Spark functions, so they stay inside
whole-stage code generation; none needs a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ column, independent of the
    session time zone (bigint)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, _col(ts).cast("timestamp_ntz")).cast("long")


def instant_as_ntz(ts) -> Column:
    """TIMESTAMP -> its UTC wall time as TIMESTAMP_NTZ, whatever the session time
    zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), epoch)


def year_month(epoch_secs) -> Column:
    """Epoch seconds -> int ``yyyyMM`` of the UTC calendar day.

    Replaces the reference's row-at-a-time date-format UDF. The day number is
    taken with floor semantics so that times before 1970 land on the right day.
    """
    s = _col(epoch_secs).cast("long")
    day = F.date_from_unix_date(((s - F.pmod(s, F.lit(SECONDS_PER_DAY))) / SECONDS_PER_DAY).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def dot(a, b) -> Column:
    """Dot product of two numeric arrays (as double)."""
    a2 = _col(a).cast("array<double>")
    b2 = _col(b).cast("array<double>")
    return F.aggregate(F.zip_with(a2, b2, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(a) -> Column:
    a2 = _col(a).cast("array<double>")
    return F.sqrt(F.aggregate(a2, F.lit(0.0), lambda acc, x: acc + x * x))


def unit_vector(a) -> Column:
    """a / |a| as array<double>; NULL for a zero (or NULL) vector."""
    a2 = _col(a).cast("array<double>")
    n = l2_norm(a2)
    return F.when(n > 0, F.transform(a2, lambda x: x / n))


def cosine_similarity(a, b) -> Column:
    """dot(a, b) / (|a| * |b|); NULL when either norm is zero.

    The reference divides 0/0 and gets NaN; under ANSI Spark that division
    would throw, and NaN compares greater than any threshold in Spark SQL, so a
    zero vector yields NULL here and never passes a threshold.
    """
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def congestion_class(avg_speed, width: int = 10, top: int = 10) -> Column:
    """Class of an average speed: ``min(int(v) div width, top)``, clamped at 0,
    as double (the label type Spark ML expects)."""
    v = _col(avg_speed)
    cls = F.floor(F.floor(v) / F.lit(width)).cast("long")
    return F.least(F.greatest(cls, F.lit(0).cast("long")), F.lit(top).cast("long")).cast("double")


def safe_ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 (never an ANSI error)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
