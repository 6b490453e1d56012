"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame of the schema that needs no Python worker."""
    return spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def struct_of(columns: Iterable[str], alias: str | None = None) -> Column:
    # a struct needs a field; the literal keeps the empty case valid
    fields = [F.col(f"`{c}`") for c in columns] or [F.lit(True).alias("__none")]
    out = F.struct(*fields)
    return out.alias(alias) if alias else out


def has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(has_map(f.dataType) for f in dtype.fields)
    return False


def comparable(field: T.StructField) -> Column:
    """The column in a form that can be compared, hashed and ordered."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.MapType) and not has_map(field.dataType.valueType):
        return F.array_sort(F.map_entries(column)).alias(field.name)
    if has_map(field.dataType) or isinstance(field.dataType, T.VariantType):
        return F.to_json(F.struct(column)).alias(field.name)
    return column.alias(field.name)


def comparable_struct(schema: T.StructType, columns: Iterable[str]) -> Column:
    fields = [comparable(schema[c]) for c in columns] or [F.lit(True).alias("__none")]
    return F.struct(*fields)


def row_hash(schema: T.StructType, columns: Iterable[str]) -> Column:
    """Order for rows that nothing else tells apart."""
    columns = list(columns)
    if not columns:
        return F.lit(0).cast("long")
    return F.xxhash64(*[comparable(schema[c]) for c in columns])


def bucket_of(keys: Iterable[str], buckets: int) -> Column:
    """Bucket of a key; equals the partition of ``repartition(buckets, keys)``.

    Rows shuffled that way therefore leave one file per bucket.
    """
    return F.pmod(F.hash(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets))


# Whole numbers and the digits that the largest of each has.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def wider(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of two types; text if there is no other.

    Whole numbers, then decimals, then floating point numbers, then text. Structs keep
    the fields of both, arrays and maps have wider entries.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if isinstance(one, T.NumericType) and isinstance(other, T.NumericType):
        return _wider_number(one, other)
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(one, times) and isinstance(other, times):
        return max(one, other, key=lambda t: times.index(type(t)))
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        types = {f.name: f.dataType for f in one.fields}
        for f in other.fields:
            types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
        return T.StructType([T.StructField(n, t) for n, t in types.items()])
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(wider(one.elementType, other.elementType))
    if isinstance(one, T.MapType) and isinstance(other, T.MapType) and one.keyType == other.keyType:
        return T.MapType(one.keyType, wider(one.valueType, other.valueType))
    return T.StringType()


def _wider_number(one: T.DataType, other: T.DataType) -> T.DataType:
    if type(one) in _WHOLE and type(other) in _WHOLE:
        return max(one, other, key=lambda t: _WHOLE[type(t)])
    floating = [t for t in (one, other) if isinstance(t, (T.FloatType, T.DoubleType))]
    if floating:
        return T.FloatType() if all(isinstance(t, T.FloatType) for t in (one, other)) else T.DoubleType()
    pairs = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0) for t in (one, other)]
    scale = max(s for _, s in pairs)
    precision = max(p - s for p, s in pairs) + scale
    return T.DecimalType(precision, scale) if precision <= 38 else T.DoubleType()


def as_type(column: str, held: T.DataType, wanted: T.DataType) -> str:
    """SQL of a column in a wider type; nested values become JSON text."""
    if held == wanted:
        return column
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(wanted, T.StringType) and isinstance(held, nested):
        return f"to_json({column})"
    if isinstance(wanted, nested) and held.simpleString() != wanted.simpleString():
        return f"from_json(to_json({column}), '{wanted.simpleString()}')"
    return f"CAST({column} AS {wanted.simpleString()})"


def text_list(column: Column) -> Column:
    """A JSON array or a comma separated text as an array without blanks."""
    parsed = F.when(
        F.ltrim(column).startswith("["), F.from_json(column, "array<string>")
    ).otherwise(F.split(column, ","))
    cleaned = F.filter(
        F.transform(parsed, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")
    )
    return F.when(F.size(cleaned) > 0, cleaned)


def without_null_values(column: Column) -> Column:
    return F.map_filter(column, lambda _, v: v.isNotNull())


def named_list(values) -> list[str]:
    """Column names of a spec field; blanks removed."""
    if values is None:
        return []
    if isinstance(values, str):
        values = values.split(",")
    return [v.strip() for v in values if v and v.strip()]
