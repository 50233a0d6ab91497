"""Nanosecond time stamps (A3 to A8). The canonical column is ``ts_ns BIGINT``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NS = 1_000_000_000

_BELOW_MICROS = r"\.\d{6}(\d{1,3})"  # the cast itself keeps six fraction digits


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def ts_split_trunc(ns: Column) -> Column:
    """Signed split of nanoseconds: -1.5 s is (-1, -500000000) (A3)."""
    return F.struct(_div(ns, NS).alias("seconds"), (ns % F.lit(NS)).cast("int").alias("nanos"))


def ts_split_euclid(ns: Column) -> Column:
    """Split of unsigned nanoseconds; a negative number is refused (A4)."""
    checked = F.when(ns < 0, F.raise_error(F.lit("timestamp must not be negative"))).otherwise(ns)
    return F.struct(
        _div(checked, NS).alias("seconds"), F.pmod(checked, F.lit(NS).cast("bigint")).cast("int").alias("nanos")
    )


def ts_recombine(seconds: Column, nanos: Column) -> Column:
    """``seconds * 1e9 + nanos``; nanos may exceed a second."""
    return seconds.cast("bigint") * F.lit(NS).cast("bigint") + nanos.cast("bigint")


def ts_from_interval(interval: Column) -> Column:
    """Duration since the epoch, a DAY TO SECOND interval, exact to the microsecond (A5)."""
    hours = F.extract(F.lit("DAY"), interval).cast("bigint") * 24 + F.extract(F.lit("HOUR"), interval)
    minutes = hours * 60 + F.extract(F.lit("MINUTE"), interval)
    micros = (F.extract(F.lit("SECOND"), interval) * 1_000_000).cast("bigint")
    return minutes * F.lit(60 * NS) + micros * 1000


def ts_from_datetime(ts: Column, ntz: bool = False, float_compat: bool = False) -> Column:
    """Instant to nanoseconds (A6). A naive value (``ntz=True``) is read as UTC in any session.

    ``float_compat`` goes through float seconds and so repeats the 256 ns rounding of clients
    that do the same.
    """
    if ntz:
        ns = ts_from_interval(ts - F.lit("1970-01-01").cast("timestamp_ntz"))
    else:
        ns = F.unix_micros(ts) * F.lit(1000)
    if float_compat:
        return ((_div(ns, 1000).cast("double") / 1e6) * 1e9).cast("bigint")
    return ns


def ts_from_iso(text: Column) -> Column:
    """ISO text to nanoseconds, keeping up to nine fraction digits.

    Text without an offset is local to the session, as a naive clock reading is local to its host.
    """
    below_micros = F.rpad(F.regexp_extract(text, _BELOW_MICROS, 1), 3, "0").cast("bigint")
    return F.unix_micros(text.cast("timestamp")) * F.lit(1000) + below_micros


def to_ts_ns(ts: Column, dtype: T.DataType) -> Column:
    """Any accepted time input to ``ts_ns``, chosen by column type."""
    if isinstance(dtype, T.IntegralType):
        return ts.cast("bigint")
    if isinstance(dtype, T.TimestampNTZType):
        return ts_from_datetime(ts, ntz=True)
    if isinstance(dtype, T.TimestampType):
        return ts_from_datetime(ts)
    if isinstance(dtype, T.DayTimeIntervalType):
        return ts_from_interval(ts)
    if isinstance(dtype, T.StringType):
        return ts_from_iso(ts)
    raise TypeError(f"cannot read a timestamp from {dtype.simpleString()}")
