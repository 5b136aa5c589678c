"""The narrowest type that holds the values of two others, and values brought to it.

Whole numbers widen to the longer one, to decimals that hold both, or to double
beside a float; booleans count as 0 and 1 beside numbers. Dates become
timestamps beside one. Text takes in every simple type. Structs are united by
field name, arrays and maps by element; a single value beside an array becomes
an array of one. What has no common type otherwise is an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
#: Decimal digits that every value of a whole-number type has at most.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
#: Whole numbers that a 32-bit float holds exactly.
_SHORT = (T.ByteType, T.ShortType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _numbers(a: T.DataType, b: T.DataType) -> T.DataType:
    if type(a) in _DIGITS and type(b) in _DIGITS:
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)):
        fits = all(isinstance(t, (T.FloatType, *_SHORT)) for t in (a, b))
        return T.FloatType() if fits else T.DoubleType()
    digits = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
    before, after = max(d for d, _ in digits), max(s for _, s in digits)
    return T.DecimalType(before + after, after) if before + after <= 38 else T.DoubleType()


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type of a column that holds values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        others = {f.name.lower(): f for f in b.fields}
        fields = []
        for field in a.fields:
            other = others.pop(field.name.lower(), None)
            kind = common_type(field.dataType, other.dataType) if other else field.dataType
            fields.append(T.StructField(field.name, kind))
        return T.StructType([*fields, *(T.StructField(f.name, f.dataType) for f in b.fields if f.name.lower() in others)])
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        inner = [t.elementType if isinstance(t, T.ArrayType) else t for t in (a, b)]
        return T.ArrayType(common_type(*inner))
    if isinstance(a, _NESTED) or isinstance(b, _NESTED):
        raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    numbers = [isinstance(t, T.NumericType) for t in (a, b)]
    if all(numbers):
        return _numbers(a, b)
    if any(numbers) and any(isinstance(t, T.BooleanType) for t in (a, b)):
        return a if numbers[0] else b
    times = {type(a), type(b)}
    if times <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return T.TimestampType() if T.TimestampType in times else T.TimestampNTZType()
    if T.BinaryType in times and any(isinstance(t, T.StringType) for t in (a, b)):
        return T.BinaryType()
    return T.StringType()


def as_type(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as the wider type ``want``; null stays null at every depth."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = []
        for field in want.fields:
            held = own.get(field.name.lower())
            part = as_type(value.getField(held.name), held.dataType, field.dataType) if held else F.lit(None).cast(field.dataType)
            parts.append(part.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(want, T.ArrayType) and not isinstance(have, T.NullType):
        return F.when(value.isNotNull(), F.array(as_type(value, have, want.elementType)))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(
            F.transform_keys(value, lambda k, _: as_type(k, have.keyType, want.keyType)),
            lambda _, x: as_type(x, have.valueType, want.valueType),
        )
    return value.cast(want)
