"""Value typing, JSON text and guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.schema import U64


def kind_of_scalar(dtype: T.DataType, preserve_int: bool = False) -> str:
    """Kind of a scalar column (A9): numbers and booleans are ``double``, text is ``string``.

    Integers arrive as doubles because a float is tried first; ``preserve_int`` keeps them.
    """
    if preserve_int and isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return "double"
    if isinstance(dtype, T.StringType):
        return "string"
    raise TypeError(f"value must be float, int, or str, got {dtype.simpleString()}")


def kind_of_array(dtype: T.DataType, preserve_int: bool = False) -> str:
    """Kind of a series given as an array column: its element type decides (A10)."""
    if not isinstance(dtype, T.ArrayType):
        raise TypeError(f"values must be an array, got {dtype.simpleString()}")
    return kind_of_scalar(dtype.elementType, preserve_int)


def same_length(timestamps: Column, values: Column) -> Column:
    """Pairs of a series; a missing side, unequal lengths and empty series are refused."""
    # fixed texts: users match on them
    return (
        F.when(timestamps.isNull() | values.isNull(), F.raise_error(F.lit("timestamps and values must not be null")))
        .when(
            F.size(timestamps) != F.size(values),
            F.raise_error(F.lit("timestamps and values must have same length")),
        )
        .when(F.size(values) == 0, F.raise_error(F.lit("values must not be empty")))
        .otherwise(F.arrays_zip(timestamps.alias("ts"), values.alias("v")))
    )


def _not_finite(col: Column, dtype: T.DataType) -> Column | None:
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        return F.isnan(col) | (F.abs(col) == float("inf"))
    if isinstance(dtype, T.StructType):
        tests = [_not_finite(col[f.name], f.dataType) for f in dtype.fields]
        tests = [F.coalesce(t, F.lit(False)) for t in tests if t is not None]
        return reduce(lambda a, b: a | b, tests) if tests else None
    if isinstance(dtype, T.ArrayType) and _not_finite(F.lit(0.0), dtype.elementType) is not None:
        return F.exists(col, lambda e: F.coalesce(_not_finite(e, dtype.elementType), F.lit(False)))
    if isinstance(dtype, T.MapType):
        return _not_finite(F.map_values(col), T.ArrayType(dtype.valueType))
    return None


def struct_to_json(col: Column, dtype: T.DataType) -> Column:
    """JSON text of a struct or map: nulls and key order kept, NaN and infinities refused."""
    text = F.to_json(col, {"ignoreNullFields": "false"})
    bad = _not_finite(col, dtype)
    if bad is None:
        return text
    return F.when(bad, F.raise_error(F.lit("out of range float values are not JSON compliant"))).otherwise(text)


def checked_uint64(value: Column) -> Column:
    """A number as unsigned 64 bit, out-of-range values refused."""
    wide = value.cast("decimal(38,0)")
    fits = wide.between(F.lit(0), F.lit(str(2**64 - 1)).cast("decimal(38,0)")) | wide.isNull()
    return F.when(fits, wide.cast(U64)).otherwise(F.raise_error(F.lit("value outside of uint64")))


def u64_wrap(value: Column) -> Column:
    """Two's-complement reading of an unsigned 64 bit number, as stored in files."""
    wide = value.cast("decimal(38,0)")
    top = F.lit(str(2**63)).cast("decimal(38,0)")
    turn = F.lit(str(2**64)).cast("decimal(38,0)")
    return F.when(wide >= top, wide - turn).otherwise(wide).cast("bigint")


def u64_unwrap(value: Column) -> Column:
    """The unsigned number behind its two's-complement reading."""
    wide = value.cast("decimal(38,0)")
    turn = F.lit(str(2**64)).cast("decimal(38,0)")
    return F.when(value < 0, wide + turn).otherwise(wide).cast(U64)
