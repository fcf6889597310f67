"""Lossless type changes, and the schema that a target and a new frame have in common."""

from __future__ import annotations

from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


class IncompatibleSchema(ValueError):
    """A column of the frame and of the target have no common type that holds both without loss."""


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The smallest type to which both change without loss, or None.

    The order of types: byte < short < int < long; float < double; byte, short and int < double (each is exact there), byte and
    short < float; integers < decimals with enough digits before the point; decimals < decimals with as many
    digits on both sides; date < timestamp without time zone; void < everything. Arrays, maps and
    structs compare by their parts; a part may become nullable."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    kinds = type(a), type(b)
    if kinds[0] in _INTEGRAL and kinds[1] in _INTEGRAL:
        return max(a, b, key=lambda t: _INTEGRAL.index(type(t)))
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.FloatType) and isinstance(y, T.DoubleType):
            return y
        if isinstance(y, (T.FloatType, T.DoubleType)) and type(x) in _INTEGRAL[:3]:
            return T.DoubleType() if isinstance(x, T.IntegerType) else y
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
        if type(x) in _INTEGRAL and isinstance(y, T.DecimalType):
            return _decimal(max(_DIGITS[type(x)], y.precision - y.scale), y.scale)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return _decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = common_type(a.elementType, b.elementType)
        return inner and T.ArrayType(inner, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType)
        return T.MapType(key, value, a.valueContainsNull or b.valueContainsNull) if key and value else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        try:
            return merged(a, b)
        except IncompatibleSchema:
            return None
    return None


def _decimal(whole: int, scale: int) -> T.DecimalType | None:
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def merged(held: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of ``held``, then those that only ``new`` has, each of the common type and nullable."""
    names = {f.name.lower(): f for f in new.fields}
    out = []
    for f in held.fields:
        other = names.pop(f.name.lower(), None)
        kind = f.dataType if other is None else common_type(f.dataType, other.dataType)
        if kind is None:
            raise IncompatibleSchema(
                f"column {f.name}: {other.dataType.simpleString()} of the frame and {f.dataType.simpleString()} of the target "
                "have no common type that holds both without loss"
            )
        out.append(T.StructField(f.name, kind, True))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name.lower() in names])
