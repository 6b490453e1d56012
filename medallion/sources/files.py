"""Incremental file sources: each file is read once, tracked by the checkpoint."""

from __future__ import annotations

import csv
import datetime as dt
import io
import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import storage
from ..functions.decode import cast_text, decode_json
from ..functions.expressions import no_rows, wider
from .base import Source, SourceRequest, reader, register_source

PREFIX = "cloudFiles."
METADATA = "_metadata"
COLUMNAR = ("parquet", "orc")
# Options of the file dialect that have a Spark counterpart.
RATE_OPTIONS = ("maxFilesPerTrigger", "maxBytesPerTrigger")
BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
# a separator that no text has, so that a line is one column
NO_SEPARATOR = "\uffff"


def translate_options(fmt: str, options: dict[str, str]):
    """(format, Spark options, rescue column, infer types) of the file dialect."""
    options = {k: v for k, v in (options or {}).items() if v is not None}
    lowered = {k.lower(): v for k, v in options.items()}
    dialect = {
        k[len(PREFIX):]: v for k, v in options.items() if k.lower().startswith(PREFIX.lower())
    }
    plain = {k: v for k, v in options.items() if not k.lower().startswith(PREFIX.lower())}
    if fmt.lower() == "cloudfiles":
        fmt = dialect.get("format") or "json"
    rescue = dialect.get("rescuedDataColumn") or plain.pop("rescuedDataColumn", None)
    infer = str(dialect.get("inferColumnTypes", lowered.get("inferschema", "false"))).lower()
    for name in RATE_OPTIONS:
        if name in dialect:
            plain.setdefault(name, dialect[name])
    return fmt.lower(), plain, rescue, infer == "true"


def _flag(options: dict[str, str], name: str) -> bool:
    values = {k.lower(): str(v).lower() for k, v in options.items()}
    return values.get(name.lower()) == "true"


# ---- schema -----------------------------------------------------------------


def _reader_options(fmt: str, options: dict[str, str], infer: bool) -> dict[str, str]:
    if fmt == "csv":
        return {**options, "inferSchema": str(infer).lower()}
    if fmt == "json":
        return {**options, "primitivesAsString": str(not infer).lower()}
    return options


def _merge_schemas(schemas: list[T.StructType]) -> T.StructType:
    """The columns of all, in the order they come, in types that hold the values of all."""
    return reduce(wider, schemas, T.StructType())


def _pinned_schema(request: SourceRequest, infer_schema, newest) -> T.StructType:
    """Infer once, and later only from files that are newer than those seen.

    Columns that later files bring are added at the end; a known column whose values
    no longer fit its type gets a wider one. The schema is kept beside the checkpoint,
    each state of it in a file of its own.
    """
    spark = request.spark
    if not request.state:
        return infer_schema(None)
    grown = sorted(n for n in storage.list_names(spark, request.state) if n.startswith("schema-"))
    path = storage.join(request.state, grown[-1] if grown else "schema.json")
    kept = storage.read_json(spark, path)
    seen = newest()
    if kept is not None and kept.get("seen") == seen:
        return T.StructType.fromJson(kept)
    if kept is None:
        schema = infer_schema(None)
    else:
        known = T.StructType.fromJson(kept)
        schema = _merge_schemas([known, infer_schema(kept.get("seen"))])
        path = storage.join(request.state, f"schema-{len(grown):020d}.json")
    storage.write_json(spark, path, {**json.loads(schema.json()), "seen": seen})
    return schema


# ---- CSV by name ------------------------------------------------------------


def _header(lines: Iterator[str], options: dict[str, str]) -> str | None:
    """The first record of a file, from its lines; None if there is none.

    As in Spark's reader, empty lines and comments before it are passed over; with
    ``multiLine`` a quoted name may hold line breaks, and a line of spaces is not
    empty.
    """
    whole = _flag(options, "multiLine")
    quote, comment = options.get("quote", '"'), options.get("comment")
    for line in lines:
        line = line.lstrip("\ufeff")
        if not (line if whole else line.strip()) or (comment and line.startswith(comment)):
            continue
        while whole and quote and line.count(quote) % 2:
            more = next(lines, None)
            if more is None:
                break
            line += "\n" + more
        return line
    return None


def _names(header: str, path: str, options: dict[str, str]) -> tuple[str, ...]:
    separator, quote = options.get("sep", options.get("delimiter", ",")), options.get("quote", '"')
    found = next(csv.reader(io.StringIO(header, newline=""), delimiter=separator, quotechar=quote or None))
    names = tuple(n.strip() for n in found)
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"{path}: the header names {twice} more than once")
    return names


def group_by_header(spark, paths: list[str], options) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names in their first records; empty files are left out.

    Each file is a task, which reads up to the end of its first record and stops; parts
    of a large file that begin further on stop at once. The driver gets each header
    once, with the names of its files.
    """
    if not paths:
        return {}
    session = spark.newSession()
    for name in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"):
        # opening a file counts as much as a whole task, so that no task has two
        session.conf.set(name, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    encoding = options.get("encoding", options.get("charset", "UTF-8"))
    if encoding.upper() in ("UTF-8", "UTF8"):
        lines = session.read.text(paths).withColumnRenamed("value", "line")
    else:
        # only the reader of CSV knows other encodings; it leaves out empty lines
        lines = session.read.schema("line string").csv(
            paths, sep=NO_SEPARATOR, quote="", encoding=encoding, emptyValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    lines = lines.select("line", F.col(f"{METADATA}.file_path"), F.col(f"{METADATA}.file_block_start"))

    def first_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []

        def texts() -> Iterator[str]:
            for batch in batches:
                if batch.num_rows and batch.column("file_block_start")[0].as_py():
                    return
                names[:] = batch.column("file_path").slice(0, 1).to_pylist() or names
                yield from (text or "" for text in batch.column("line").to_pylist())

        header = _header(texts(), options)
        if header is not None:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([header])], names=["path", "header"])

    found = lines.mapInArrow(first_records, "path string, header string")
    given = {name: path for path in paths for name in (path, _escaped(spark, path))}
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in found.groupBy("header").agg(F.collect_list("path").alias("paths")).collect():
        files = [given[p] for p in row["paths"]]
        groups.setdefault(_names(row["header"], min(files), options), []).extend(files)
    return groups


def _escaped(spark: SparkSession, path: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def read_csv_by_name(
    spark: SparkSession,
    paths: list[str],
    schema: T.StructType,
    options: dict[str, str],
    rescue: str | None,
    metadata: bool = False,
) -> DataFrame:
    """CSV files with different headers; columns are matched by name.

    Files with the same header are read together by Spark's own reader, so the
    number of scans is the number of distinct headers.
    """
    keep = [METADATA] if metadata else []
    parts = []
    for names, files in sorted(group_by_header(spark, paths, options).items()):
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = spark.read.schema(text).options(**{**options, "header": "true"}).csv(files)
        if metadata:
            rows = rows.select("*", METADATA)
        parts.append(cast_text(rows, schema, rescue, options, keep))
    if not parts:
        fields = [f for f in schema.fields if f.name != rescue]
        if rescue:
            fields.append(T.StructField(rescue, T.StringType()))
        return no_rows(spark, T.StructType(fields))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ---- metadata columns -------------------------------------------------------


def file_metadata_columns(df: DataFrame, request: str | dict | None) -> DataFrame:
    """Columns taken from ``_metadata``; then keep it under a name or drop it."""
    wanted = json.loads(request) if isinstance(request, str) else dict(request or {})
    selected = wanted.get("select_metadata_cols") or {}
    selected = json.loads(selected) if isinstance(selected, str) else selected
    df = df.withColumns({name: F.col(path) for name, path in selected.items()})
    if str(wanted.get("include_autoloader_metadata_column", "false")).lower() != "true":
        return df.drop(METADATA)
    name = wanted.get("autoloader_metadata_col_name") or "source_metadata"
    return df.withColumnRenamed(METADATA, name)


# ---- source -----------------------------------------------------------------


def _streamable(spark: SparkSession, path: str) -> str:
    """Spark streams folders and patterns; a single file becomes a pattern."""
    if storage.is_file(spark, path):
        return f"{path[:-1]}[{path[-1]}]"
    return path


def file_source(request: SourceRequest) -> Source:
    spark = request.spark
    fmt, options, rescue, infer = translate_options(request.format, request.options)
    path = request.details.get("path")
    if not path:
        raise ValueError("a file source needs a path")
    path = _streamable(spark, path)
    metadata = request.details.get("source_metadata")
    by_name = fmt == "csv" and _flag(options, "header")
    rates = {k: v for k, v in options.items() if k in RATE_OPTIONS}
    listing = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup")}

    def file_names(streaming: bool, **more: str) -> DataFrame:
        files = reader(spark, streaming).format("binaryFile").schema(BINARY_SCHEMA).options(**more)
        return files.options(**listing, **(rates if streaming else {})).load(path).select("path")

    def newest() -> int | None:
        """When the newest of the files was modified, in milliseconds."""
        files = spark.read.format("binaryFile").schema(BINARY_SCHEMA).options(**listing).load(path)
        return files.agg(F.unix_millis(F.max("modificationTime")).alias("m")).first()["m"]

    def infer_schema(after: int | None) -> T.StructType:
        found = _reader_options(fmt, options, infer)
        if after is not None:
            # a second earlier, for file systems that know whole seconds only
            earlier = dt.datetime.fromtimestamp(after // 1000 - 1, dt.timezone.utc)
            found["modifiedAfter"] = earlier.strftime("%Y-%m-%dT%H:%M:%S")
            found["timeZone"] = "UTC"
        if not by_name:
            try:
                return spark.read.format(fmt).options(**found).load(path).schema
            except AnalysisException as error:
                if after is not None and error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                    return T.StructType()
                raise
        files = file_names(False)
        if after is not None:
            files = file_names(False, modifiedAfter=found.pop("modifiedAfter"), timeZone="UTC")
        paths = [r.path for r in files.collect()]
        groups = group_by_header(spark, paths, options)
        return _merge_schemas(
            [spark.read.options(**found).csv(files).schema for _, files in sorted(groups.items())]
        )

    schema = request.schema or _pinned_schema(request, infer_schema, newest)
    finish = (lambda df: file_metadata_columns(df, metadata)) if metadata else (lambda df: df)
    keep = [METADATA] if metadata else []

    if by_name:

        def expand(batch: DataFrame) -> DataFrame:
            # file names only, as any file listing keeps them on the driver
            paths = sorted(r.path for r in batch.collect())
            return finish(
                read_csv_by_name(
                    batch.sparkSession, paths, schema,
                    {k: v for k, v in options.items() if k not in RATE_OPTIONS},
                    rescue, bool(metadata),
                )
            )

        return Source(file_names, expand)

    def rows(streaming: bool) -> DataFrame:
        source = reader(spark, streaming)
        if fmt == "json" and rescue:
            whole = _flag(options, "multiLine")
            text = source.format("text").options(
                **{k: v for k, v in options.items() if k in (*RATE_OPTIONS, *listing)},
                wholetext=str(whole).lower(),
            ).load(path)
            text = text.select("value", *keep)
            return finish(decode_json(text, schema, rescue, whole_files=whole, keep=keep))
        if fmt == "csv" and rescue:
            text = T.StructType(
                [T.StructField(f.name, T.StringType()) for f in schema.fields if f.name != rescue]
            )
            df = source.format("csv").schema(text).options(**options).load(path)
            df = df.select("*", *keep) if keep else df
            return finish(cast_text(df, schema, rescue, options, keep))
        df = source.format(fmt).schema(schema).options(**options).load(path)
        return finish(df.select("*", *keep) if keep else df)

    return Source(rows, columnar=fmt in COLUMNAR)


# File formats that are read without further modules.
for _name in ("cloudFiles", "csv", "json", "parquet", "orc", "text"):
    register_source(_name, file_source)
