"""Types that grow: the narrowest type that holds the values of two others, and the SQL
that casts upward to it.

``null`` is below every type; whole numbers widen among themselves and to decimals,
fractions and decimals to double; structs, arrays and maps join part by part; any other
pair meets in string (nested values as JSON text).
"""

from __future__ import annotations

from pyspark.sql import types as T

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _decimal(t: T.DataType) -> T.DecimalType:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0)


def joined_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type above ``a`` and ``b``."""
    if same_type(a, b) or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    whole, exact = (T.IntegralType,), (T.IntegralType, T.DecimalType)
    if isinstance(a, whole) and isinstance(b, whole):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, exact) and isinstance(b, exact):
        x, y = _decimal(a), _decimal(b)
        scale = max(x.scale, y.scale)
        digits = max(x.precision - x.scale, y.precision - y.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return next(t for t in (T.TimestampType(), T.TimestampNTZType()) if t in (a, b))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return joined_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(joined_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(joined_type(a.keyType, b.keyType), joined_type(a.valueType, b.valueType))
    return T.StringType()


def joined_struct(a: T.StructType, b: T.StructType) -> T.StructType:
    """Field by field, names without regard to case: the fields of ``a`` under its names,
    then those only ``b`` has."""
    other = {f.name.lower(): f for f in b.fields}
    fields = [T.StructField(f.name, joined_type(f.dataType, other.pop(f.name.lower()).dataType))
              if f.name.lower() in other else f for f in a.fields]
    return T.StructType(fields + [f for f in b.fields if f.name.lower() in other])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ddl(t: T.DataType) -> str:
    """The type in SQL, names quoted."""
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {ddl(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, T.ArrayType):
        return f"array<{ddl(t.elementType)}>"
    if isinstance(t, T.MapType):
        return f"map<{ddl(t.keyType)}, {ddl(t.valueType)}>"
    return t.simpleString()


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for whether parts may be NULL."""
    return a == b or ddl(a) == ddl(b)


def stored_type(t: T.DataType) -> T.DataType:
    """The type in which a table keeps ``t``: only-NULL parts as string."""
    if isinstance(t, T.NullType):
        return T.StringType()
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, stored_type(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(stored_type(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(stored_type(t.keyType), stored_type(t.valueType))
    return t


def upcast_sql(ref: str, a: T.DataType, b: T.DataType, depth: int = 0) -> str:
    """SQL for the value ``ref`` of type ``a`` as ``b``, a type above it."""
    if same_type(a, b):
        return ref
    if isinstance(a, T.NullType):
        return f"CAST(NULL AS {ddl(b)})"
    if isinstance(b, T.StringType) and isinstance(a, (T.StructType, T.ArrayType, T.MapType)):
        return f"to_json({ref})"
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        own = {f.name.lower(): f for f in a.fields}
        parts = []
        for f in b.fields:
            mine = own.get(f.name.lower())
            value = (upcast_sql(f"{ref}.{quoted(mine.name)}", mine.dataType, f.dataType, depth) if mine
                     else f"CAST(NULL AS {ddl(f.dataType)})")
            name = f.name.replace("\\", "\\\\").replace("'", "\\'")
            parts.append(f"'{name}', {value}")
        return f"CASE WHEN {ref} IS NOT NULL THEN named_struct({', '.join(parts)}) END"
    x = f"x{depth}"
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return f"transform({ref}, {x} -> {upcast_sql(x, a.elementType, b.elementType, depth + 1)})"
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        keys = f"transform(map_keys({ref}), {x} -> {upcast_sql(x, a.keyType, b.keyType, depth + 1)})"
        values = f"transform(map_values({ref}), {x} -> {upcast_sql(x, a.valueType, b.valueType, depth + 1)})"
        return f"map_from_arrays({keys}, {values})"
    return f"CAST({ref} AS {ddl(b)})"
