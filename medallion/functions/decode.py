"""Typed rows from JSON and CSV text, with unexpected data kept aside.

Unknown fields and values that do not fit their type are kept as JSON in the
rescue column; the row survives with nulls. All of it is column expressions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


# what stands behind a text to see that nothing else does
END_MARK = "__end"


def _path(name: str) -> str:
    return f"$['{name}']" if "'" not in name else f'$["{name}"]'


def _field_names(names: Iterable[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def decode_json(
    df: DataFrame,
    schema: T.StructType,
    rescue: str | None = None,
    value: str = "value",
    whole_files: bool = False,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Rows of a JSON text column; ``whole_files`` also accepts arrays of records.

    A value is taken if its type holds all of it; any other one is null in its column
    and kept in the rescue column. A text that is not one record is kept there whole.
    """
    fields = [f for f in schema.fields if f.name != rescue]
    kept = [F.col(f"`{c}`") for c in keep]
    lines = df.where(F.trim(F.col(value)) != "")
    if whole_files:
        records = F.coalesce(
            F.try_variant_get(F.col("__v"), "$", "array<variant>"), F.array(F.col("__v"))
        )
        lines = lines.select(*kept, F.col(value).alias("__line"), _parsed(value).alias("__p"))
        lines = lines.select(*kept, "__line", _one_value("__p").alias("__v")).select(
            *kept, "__line", F.explode(records).alias("__v")
        )
    elif rescue and fields:
        lines = _fitting_first(lines, fields, value, kept)
    else:
        lines = lines.select(*kept, F.col(value).alias("__line"), _parsed(value).alias("__p"))
        lines = lines.select(*kept, "__line", _one_value("__p").alias("__v"))
    quick = "__s" in lines.columns
    typed = lines.select(
        *kept,
        "__line",
        *(["__odd"] if quick else []),
        F.try_variant_get("__v", "$", "map<string,variant>").alias("__m"),
        *[_value(f, quick).alias(f.name) for f in fields],
    )
    columns = [F.col(f"`{f.name}`") for f in fields]
    if rescue:
        known = _field_names(f.name for f in fields)

        def unexpected(key, item):
            unfit = F.lit(False)
            for f in fields:
                unfit = unfit | ((key == f.name) & F.col(f"`{f.name}`").isNull())
            return ~F.array_contains(known, key) | (~F.is_variant_null(item) & unfit)

        # as many keys as values that fit: nothing is left over, skip the search
        fitting = F.lit(0)
        for f in fields:
            fitting = fitting + F.col(f"`{f.name}`").isNotNull().cast("int")
        odd = F.col("__m").isNotNull() & (F.size("__m") != fitting)
        extra = F.when(odd, F.map_filter("__m", unexpected))
        typed = typed.withColumn("__extra", extra)
        unread = F.col("__m").isNull() & (F.col("__odd") if quick else F.lit(True))
        columns.append(
            F.when(unread, F.col("__line"))
            .when(F.size("__extra") > 0, F.to_json("__extra"))
            .alias(rescue)
        )
    return typed.select(*columns, *kept)


def _parsed(text: str) -> Column:
    """A list of the JSON value that fills a text and of END_MARK; see ``_one_value``."""
    return F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit(f',"{END_MARK}"]')))


def _one_value(parsed: str) -> Column:
    """The JSON value that fills a text; null if there is none, another one, or anything else.

    The parser stops behind the first value it has read. So the text was made the first
    item of a list with a mark behind it: what follows the value hides the mark.
    """
    marked = (F.try_variant_get(F.col(parsed), "$[1]", "string") == END_MARK) & F.try_variant_get(
        F.col(parsed), "$[2]", "variant"
    ).isNull()
    return F.when(marked, F.try_variant_get(F.col(parsed), "$[0]", "variant"))


def _value(field: T.StructField, quick: bool) -> Column:
    """A field of a record, null if its type would not hold the whole value."""
    path = _path(field.name)
    item = F.try_variant_get("__v", path, "variant")
    typed = F.try_variant_get("__v", path, field.dataType.simpleString())
    if not quick:
        return F.when(_holds(field.dataType, typed, item), typed)
    # whole numbers, truth values and texts are read by schema as they are or not at all
    read = F.col("__s").getField(field.name)
    if isinstance(field.dataType, (T.IntegralType, T.BooleanType, T.StringType)):
        exact = ~F.col("__odd") | F.col("__v").isNotNull()
    elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        exact = ~F.col("__odd")
    else:
        exact = ~F.col("__odd") | (F.col("__v").isNotNull() & ~F.col("__long"))
    return F.when(read.isNotNull() & exact, read).when(_holds(field.dataType, typed, item), typed)


def _holds(kind: T.DataType, typed: Column, item: Column) -> Column:
    """Is a typed value all of the JSON value that it was read from?"""
    text = F.try_variant_get(item, "$", "string")
    quoted = F.schema_of_variant(item) == "STRING"
    if isinstance(kind, T.StringType):
        return typed.isNotNull() & item.isNotNull()
    if isinstance(kind, T.NumericType):
        wide = T.DecimalType(38, 18)
        exact = text.try_cast(wide) == typed.try_cast(wide)
        # beyond decimals there are only floating point numbers
        number = F.coalesce(exact, text.try_cast("double") == typed.cast("double"))
        return F.when(quoted, text == typed.cast("string")).otherwise(number)
    if isinstance(kind, T.BooleanType):
        return text == typed.cast("string")
    if isinstance(kind, T.DateType):
        return quoted & (text.try_cast("timestamp_ntz") == typed.cast("timestamp_ntz"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return typed.isNotNull() & item.isNotNull() & ~text.rlike(FINER_THAN_MICROSECONDS)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        again = [
            F.to_json(F.parse_json(F.to_json(typed, {"ignoreNullFields": drop}))) for drop in ("true", "false")
        ]
        return F.to_json(item).isin(*again)
    return typed.isNotNull() & item.isNotNull()


# more digits of a second than a timestamp has, if they are not all zeros
FINER_THAN_MICROSECONDS = r"[.][0-9]{6}0*[1-9]"


def _fitting_first(lines: DataFrame, fields, value: str, kept) -> DataFrame:
    """Lines read by schema, and once more as a variant where something may be left over.

    Every key of an object ends in a quote and a colon, unless white space parts them.
    A line with all fields of the schema and no more such marks than fields has
    nothing else. Numbers and times that may be longer than their type are looked at
    again.
    """
    schema = T.ArrayType(T.StructType([*fields, T.StructField(END_MARK, T.IntegerType())]))
    text = F.col(value)
    # a list of the record and a mark, see _one_value
    listed = F.concat(F.lit("["), text, F.lit(f',{{"{END_MARK}":1}}]'))
    read = lines.select(*kept, text.alias("__line"), F.from_json(listed, schema).alias("__all"))
    whole = (F.size("__all") == 2) & (F.get("__all", F.lit(1)).getField(END_MARK) == 1)
    read = read.select(*kept, "__line", F.get("__all", F.lit(0)).alias("__s"), whole.alias("__whole"))
    missing = ~F.coalesce(F.col("__whole"), F.lit(False))
    for f in fields:
        missing = missing | F.col("__s").getField(f.name).isNull()
    line = F.col("__line")
    marks = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit('":'), F.lit("")))) / 2
    odd = missing | (marks != len(fields))
    for space in " \t\n\r":  # a key that this count would miss
        odd = odd | F.contains(line, F.lit(f'"{space}'))
    patterns, long = _long_values(fields), F.lit(False)
    if patterns:
        long = line.rlike("|".join(patterns))
    for f in fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            long = long | F.coalesce(F.abs(F.col("__s").getField(f.name)) == float("inf"), F.lit(False))
    read = read.select(*kept, "__line", "__s", long.alias("__long"), odd.alias("__odd"))
    read = read.withColumn("__odd", F.col("__odd") | F.col("__long"))
    # a column of its own, so that no line is parsed for each use of it
    read = read.select("*", F.when(F.col("__odd"), _parsed("__line")).alias("__p"))
    return read.select(*kept, "__line", "__s", "__long", "__odd", _one_value("__p").alias("__v"))


def _long_values(fields) -> list[str]:
    """Patterns of values that a reader by schema would shorten to fit."""
    kinds = [f.dataType for f in fields]
    found = []
    if any(isinstance(k, T.FloatType) for k in kinds):
        found.append("[0-9][0-9.]{7}")
    elif any(isinstance(k, T.DoubleType) for k in kinds):
        found.append("[0-9][0-9.]{15}")
    scales = [k.scale for k in kinds if isinstance(k, T.DecimalType)]
    if scales:
        found += [f"[.][0-9]{{{min(scales) + 1}}}", "[0-9][eE]"]
    if any(isinstance(k, T.DateType) for k in kinds):
        found.append("[0-9]-[0-9]{1,2}[T ]")
    if any(isinstance(k, (T.TimestampType, T.TimestampNTZType)) for k in kinds):
        found.append("[.][0-9]{7}")
    return found


def cast_text(
    df: DataFrame,
    schema: T.StructType,
    rescue: str | None = None,
    options: dict[str, str] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Columns of text, matched by name, in the types of ``schema``."""
    options = options or {}
    keep = list(keep)
    fields = [f for f in schema.fields if f.name != rescue]
    present = [c for c in df.columns if c not in keep]
    names = {f.name for f in fields}

    def typed(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType) and options.get("timestampFormat"):
            return F.try_to_timestamp(column, F.lit(options["timestampFormat"]))
        if isinstance(field.dataType, T.DateType) and options.get("dateFormat"):
            return F.try_to_timestamp(column, F.lit(options["dateFormat"])).cast("date")
        return column.try_cast(field.dataType)

    columns = [
        typed(f).alias(f.name)
        if f.name in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in fields
    ]
    if rescue:
        entries = [
            (f.name, F.when(typed(f).isNull(), F.col(f"`{f.name}`")))
            for f in fields
            if f.name in present and not isinstance(f.dataType, T.StringType)
        ] + [(c, F.col(f"`{c}`")) for c in present if c not in names and c != rescue]
        lost = F.lit(None).cast("string")
        if entries:
            pairs = [x for n, c in entries for x in (F.lit(n), c)]
            extra = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
            lost = F.when(F.size(extra) > 0, F.to_json(extra))
        columns.append(lost.alias(rescue))
    return df.select(*columns, *[F.col(f"`{c}`") for c in keep])


def decode_topic(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Rows of a topic with date, hour and minute, and the payload as a struct."""
    df = df.withColumns(
        {
            "date": F.to_date("timestamp"),
            "hour": F.hour("timestamp"),
            "minute": F.minute("timestamp"),
        }
    )
    if schema is None:
        return df
    return df.withColumn("parsed_records", F.from_json(F.col("value").cast("string"), schema))
