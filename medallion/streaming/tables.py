"""Target tables: parquet folders written by micro-batches.

Parquet has no MERGE, so a target is a set of folders plus a view that selects
the current ones:

* append targets: ``data/__flow=<flow>/__batch=<id>``; a repeated batch replaces
  its own folder;
* change targets: ``state/__v=<version>/__bucket=<n>``; a batch rewrites only the
  buckets its keys fall into, and a manifest names the current version of each;
* snapshot targets: ``state/__v=<version>/__open=<0|1>/__bucket=<n>``; closed versions
  are never rewritten, open ones only in buckets with a changed key.

A change or snapshot batch becomes visible by writing its manifest, the last step,
so a failed batch leaves the table as it was, and a repeated one is recognised. The
files of an append batch become visible when Spark commits its write; rules and
quarantine rows of the batch may follow later. Which batch of which stream it was
says the stream's id, a name with the id of its checkpoint.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import storage
from ..functions.expressions import as_type, bucket_of, comparable_struct, named_list, no_rows, wider
from ..operators import cdc, skew, snapshot as snap

FLOW, BATCH, VERSION, BUCKET, OPEN = "__flow", "__batch", "__v", "__bucket", "__open"
BUCKETS_PROPERTY = "medallion.buckets"
KEEP_PROPERTY = "medallion.keep.versions"
# key bytes of a batch up to which the keys are broadcast
BROADCAST_BYTES = "medallion.broadcast.bytes"
PATH_PROPERTY = "medallion.path"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
TEXT_MARK = "~"
_DECLARING = threading.Lock()


@dataclass
class Target:
    """Where a table lives and how it is declared."""

    name: str | None = None
    path: str | None = None
    partition_by: list[str] = field(default_factory=list)
    cluster_by: list[str] = field(default_factory=list)
    properties: dict[str, str] = field(default_factory=dict)
    comment: str | None = None

    def __post_init__(self):
        self.partition_by = named_list(self.partition_by)
        self.cluster_by = named_list(self.cluster_by)
        self.properties = dict(self.properties or {})
        if not self.name and not self.path:
            raise ValueError("a target needs a name or a path")

    def location(self, spark: SparkSession) -> str:
        if self.path is None:
            # a managed table lives in the folder of its database
            database, _, table = self.name.rpartition(".")
            create_database(spark, database or "default")
            row = spark.sql(f"DESCRIBE DATABASE {database or 'default'}").where(
                "info_name = 'Location'"
            ).first()
            self.path = storage.join(row["info_value"], table)
        return self.path

    def buckets(self, spark: SparkSession) -> int:
        return int(
            self.properties.get(BUCKETS_PROPERTY)
            or spark.conf.get("spark.sql.shuffle.partitions")
        )


# ---- metadata ---------------------------------------------------------------


def _meta(path: str, *parts: str) -> str:
    return storage.join(path, "_medallion", *parts)


def _newest(spark: SparkSession, folder: str) -> dict | None:
    """The last of numbered files; each is written once and never replaced."""
    names = [n for n in storage.list_names(spark, folder) if n.endswith(".json")]
    return storage.read_json(spark, storage.join(folder, names[-1])) if names else None


def describe(spark: SparkSession, path: str) -> dict | None:
    """The description of the table at a path, None if there is none."""
    # tables from before descriptions were numbered have a single file
    return _newest(spark, _meta(path, "tables")) or storage.read_json(spark, _meta(path, "table.json"))


def is_ours(spark: SparkSession, path: str) -> bool:
    return describe(spark, path) is not None


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """What a version of the table shows; the newest one, or None if it is not kept."""
    if version is None:
        return _newest(spark, _meta(path, "versions"))
    return storage.read_json(spark, _meta(path, "versions", f"{version:020d}.json"))


def _commit(spark, target: Target, value: dict) -> None:
    path = target.location(spark)
    storage.write_json(spark, _meta(path, "versions", f"{value['version']:020d}.json"), value)
    show(spark, target)
    _vacuum(spark, target, value["version"])


def _describe(spark, target: Target, kind: str, schema: T.StructType, types=None, **more) -> dict:
    """Create or update the table description; new columns are added at the end.

    ``types``: known columns whose type changes.
    """
    path = target.location(spark)
    known = describe(spark, path)
    if known and known["kind"] != kind:
        raise ValueError(f"{path} holds a {known['kind']} table, not a {kind} table")
    fields = {f.name: f for f in T.StructType.fromJson(known["schema"]).fields} if known else {}
    for f in schema.fields:
        fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    for name, kind_of_values in (types or {}).items():
        fields[name] = T.StructField(name, kind_of_values, True)
    described = {
        "kind": kind,
        "schema": T.StructType(list(fields.values())).jsonValue(),
        "partition_by": target.partition_by,
        "properties": target.properties,
        "comment": target.comment,
        **more,
    }
    described = json.loads(json.dumps(described))
    if described != known:
        number = len(storage.list_names(spark, _meta(path, "tables")))
        storage.write_json(spark, _meta(path, "tables", f"{number:020d}.json"), described)
    return described


def _align(df: DataFrame, schema: T.StructType) -> DataFrame:
    present = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.expr(as_type(f"`{f.name}`", present[f.name], f.dataType)).alias(f.name)
            if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _laid_out(df: DataFrame, target: Target) -> DataFrame:
    """Spread rows for the write so that folders get few files.

    Spark splits partition values that are too large and joins small ones; for
    clustering the row hash keeps one frequent value from filling one task.
    """
    if target.cluster_by:
        simple = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
        spread = F.xxhash64(*[f"`{c}`" for c in simple or target.cluster_by])
        columns = [F.col(f"`{c}`") for c in [*target.partition_by, *target.cluster_by]]
        return df.repartitionByRange(*columns, spread).sortWithinPartitions(*columns)
    return df.hint("rebalance", *target.partition_by) if target.partition_by else df


def _is_text(schema: T.StructType, column: str) -> bool:
    return isinstance(schema[column].dataType, T.StringType)


def _folder_name(schema: T.StructType, column: str) -> str:
    return f"__p_{column}" if _is_text(schema, column) else column


def _shown(schema: T.StructType, column: str, partition_by: list[str]) -> str:
    """SQL of a column, taken from the folder name if the table is partitioned by it.

    Spark guesses types from folder names. Text values are stored with a mark
    in front, so that "007" comes back as it was.
    """
    if column not in partition_by:
        return f"`{column}`"
    if _is_text(schema, column):
        return f"substring(`{_folder_name(schema, column)}`, 2) AS `{column}`"
    return f"CAST(`{column}` AS {schema[column].dataType.simpleString()}) AS `{column}`"


def _store(df: DataFrame, folder: str, partition_by: list[str], inner: list[str] = ()) -> None:
    """Write rows below a folder that belongs to one attempt at one batch."""
    names = []
    for column in partition_by:
        name = _folder_name(df.schema, column)
        if name != column:
            marked = F.concat(F.lit(TEXT_MARK), F.col(f"`{column}`"))
            df = df.withColumn(name, marked).drop(column)
        names.append(name)
    writer = df.write.mode("overwrite").format("parquet")
    folders = [*inner, *names]
    (writer.partitionBy(*folders) if folders else writer).save(folder)


def _load(spark, folder: str, schema: T.StructType, partition_by, streaming=False, options=None):
    """Rows below a folder, with the folder columns in ``schema``."""
    stored = T.StructType(
        [
            T.StructField(_folder_name(schema, f.name), f.dataType) if f.name in partition_by else f
            for f in schema.fields
        ]
    )
    rows = (spark.readStream if streaming else spark.read).options(**(options or {}))
    rows = rows.schema(stored).parquet(folder)
    return rows.selectExpr(*[_shown(schema, f.name, partition_by) for f in schema.fields])


def _write_columns(spark, schema: T.StructType, folder: str, partition_by: list[str]) -> None:
    """An empty file that carries the columns, in the first folder of the table."""
    columns = T.StructType([f for f in schema.fields if f.name not in partition_by])
    nulls = [f"{_folder_name(schema, p)}={NULL_PARTITION}" for p in partition_by]
    path = storage.join(folder, *nulls) if nulls else folder
    no_rows(spark, columns).write.mode("overwrite").parquet(path)


# ---- views ------------------------------------------------------------------


def _sql_text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def show(spark: SparkSession, target: Target) -> None:
    """(Re)create the view of the table's current rows under its name."""
    if not target.name:
        return
    path = target.location(spark)
    described = describe(spark, path)
    folder, condition = _current(spark, path, described)
    schema = T.StructType.fromJson(described["schema"])
    parts = described["partition_by"]
    shown = [
        _shown(schema, c, parts) if c in parts else expression
        for c, expression in zip(schema.names, _expressions(described, schema))
    ]
    properties = {**described["properties"], PATH_PROPERTY: path}
    listed = ", ".join(f"'{_sql_text(k)}' = '{_sql_text(str(v))}'" for k, v in properties.items())
    comment = f"COMMENT '{_sql_text(described['comment'])}'" if described["comment"] else ""
    where = f"WHERE {condition}" if condition else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(target.name)} {comment} TBLPROPERTIES ({listed}) AS "
        f"SELECT {', '.join(shown)} FROM parquet.`{folder}` {where}"
    )


def _expressions(described: dict, schema: T.StructType) -> list[str]:
    special = described.get("expressions") or []
    # columns that were added later are plain ones
    return [*special, *[f"`{c}`" for c in schema.names[len(special):]]]


def _current(spark, path: str, described: dict) -> tuple[str, str | None]:
    """Folder of the rows and the condition on its sub-folders."""
    kind = described["kind"]
    if kind == "append":
        return storage.join(path, "data"), None
    current = manifest(spark, path)
    folder = storage.join(path, "state")
    if current is None:
        return folder, "false"
    if kind in ("type1", "type2"):
        shown = _bucket_condition(current["buckets"])
        return folder, f"{shown} AND NOT {cdc.DEL}" if kind == "type1" else shown
    latest = f"CAST({VERSION} AS BIGINT) = {current['version']}"
    if kind == "snapshot2":
        closed = f"CAST({OPEN} AS INT) = 0 AND CAST({VERSION} AS BIGINT) BETWEEN 0 AND {current['version']}"
        return folder, f"(({closed}) OR (CAST({OPEN} AS INT) = 1 AND {_bucket_condition(current['buckets'])}))"
    return folder, latest


def _bucket_condition(versions: list[int]) -> str:
    """Selects, by folder names alone, the current version of each bucket."""
    numbers = ", ".join(f"{v}L" for v in versions)
    bucket, version = f"CAST({BUCKET} AS INT)", f"CAST({VERSION} AS BIGINT)"
    if len(set(versions)) == 1:
        return f"({bucket} >= 0 AND {version} = {versions[0]})"
    return f"({bucket} >= 0 AND get(array({numbers}), {bucket}) = {version})"


def path_of(spark: SparkSession, name: str) -> str | None:
    """Folder behind a view of this package."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").where(F.col("key") == PATH_PROPERTY)
    row = rows.first()
    return row["value"] if row else None


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    if not spark.catalog.databaseExists(name):
        at = f" LOCATION '{_sql_text(location)}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{at}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(name)} CASCADE")


def register(spark: SparkSession, name: str, path: str) -> None:
    """Show the table at a path under a name."""
    database = name.rpartition(".")[0]
    if database:
        create_database(spark, database)
    show(spark, Target(name=name, path=path))


def deregister(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {_quoted(name)}")


def reset(spark: SparkSession, name: str) -> None:
    """Remove a table with its rows; the next run starts from nothing."""
    path = path_of(spark, name)
    deregister(spark, name)
    if path:
        storage.delete(spark, path)


def location_of(spark: SparkSession, name: str) -> str:
    path = path_of(spark, name)
    if path:
        return path
    rows = spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}").where("col_name = 'Location'")
    return rows.first()["data_type"]


# ---- reading ----------------------------------------------------------------


def read(
    spark: SparkSession, path: str, streaming: bool = False, options: dict | None = None
) -> DataFrame:
    described = describe(spark, path)
    if described is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = T.StructType.fromJson(described["schema"])
    parts = described["partition_by"]
    if described["kind"] == "append":
        rows = _load(spark, storage.join(path, "data"), _held(described), parts, streaming, options)
        return rows.selectExpr(*_expressions(described, schema)) if described.get("held") else rows
    if streaming:
        raise ValueError(f"{path} is rewritten by changes; read it as a batch")
    folder, condition = _current(spark, path, described)
    stored = T.StructType.fromJson(described["stored"])
    rows = _load(spark, folder, stored, parts, options=options).where(condition)
    return rows.selectExpr(*_expressions(described, schema))


# ---- change feeds -----------------------------------------------------------


@dataclass
class Feed:
    """What a rewritten table holds otherwise in one version than in an earlier one."""

    #: rows that are new or changed, as they are now
    rows: DataFrame
    #: rows that were open and are changed or gone: as they were, at the time of the change
    before: DataFrame | None = None
    #: changed and new rows that are open now
    after: DataFrame | None = None
    #: does the table know when its rows changed or went?
    timed: bool = True


def changes_since(spark: SparkSession, path: str, version: int | None) -> Feed:
    """The changes after a version; all rows if it is None, or not kept any more.

    Only buckets that were written since are read, in both versions, and meet by key.
    A row that was open and is gone or closed has, in the table's sequence column (and
    in the start of its version), the time of its end.
    """
    described, current = describe(spark, path), manifest(spark, path)
    earlier = manifest(spark, path, version) if version is not None else None
    keys = described.get("keys")
    if earlier is None or not keys:
        return Feed(read(spark, path))
    schema = T.StructType.fromJson(described["schema"])
    kind = described["kind"]
    history = kind in ("type2", "snapshot2")
    unique = [*keys, cdc.START] if history else list(keys)
    old, new = (_versions_rows(spark, path, described, m, earlier, current) for m in (earlier, current))
    joined = _side(old, schema, unique, "old").join(
        _side(new, schema, unique, "new"),
        reduce(lambda a, b: a & b, [F.col(f"__old_{i}").eqNullSafe(F.col(f"__new_{i}")) for i in range(len(unique))]),
        "full_outer",
    )
    changed = joined.where(~F.col("__old_same").eqNullSafe(F.col("__new_same")))
    rows = changed.where("__new IS NOT NULL").select("__new.*")
    end = f"__new.`{cdc.END}`" if history else "__new_at"
    was_open = "__old IS NOT NULL" + (f" AND __old.`{cdc.END}` IS NULL" if history else "")
    is_open = "__new IS NOT NULL" + (f" AND __new.`{cdc.END}` IS NULL" if history else "")
    at = F.coalesce(F.expr(end), *_floor_of(current, described))
    stamped = {cdc.START} if history else set()
    if described.get("sequence") in schema.names and described["sequence"] not in keys:
        stamped.add(described["sequence"])
    before = changed.where(was_open).select(
        *[
            F.coalesce(at.cast(f.dataType), F.col(f"__old.`{f.name}`")).alias(f.name)
            if f.name in stamped
            else F.col(f"__old.`{f.name}`")
            for f in schema.fields
        ]
    )
    return Feed(rows, before, changed.where(is_open).select("__new.*"), bool(stamped))


def _floor_of(current: dict, described: dict) -> list:
    """The time of the last truncate, for rows that it left no trace of."""
    if not current.get("floor"):
        return []
    stored = T.StructType.fromJson(described["stored"])
    return [F.lit(current["floor"]).cast(stored[cdc.SEQ].dataType)]


def _versions_rows(spark, path, described, shown: dict, earlier: dict, current: dict) -> DataFrame:
    """Rows of one of two versions in what differs between them: visible columns, __at, __gone.

    Deleted keys of a type 1 table are rows too, with the time of their deletion.
    """
    schema = T.StructType.fromJson(described["schema"])
    stored = T.StructType.fromJson(described["stored"])
    kind = described["kind"]
    rows = _load(spark, storage.join(path, "state"), stored, described["partition_by"])
    visible = _expressions(described, schema)
    if kind == "full":
        rows = rows.where(f"CAST({VERSION} AS BIGINT) = {shown['version']}")
        return rows.selectExpr(*visible, "NULL AS __at", "false AS __gone")
    versions = zip(earlier["buckets"], current["buckets"])
    written = [i for i, (a, b) in enumerate(versions) if a != b]
    mine = f"{_bucket_condition(shown['buckets'])} AND CAST({BUCKET} AS INT) IN ({', '.join(map(str, written)) or -1})"
    if kind == "snapshot2":
        closed = (
            f"CAST({OPEN} AS INT) = 0 AND CAST({VERSION} AS BIGINT) > {earlier['version']} "
            f"AND CAST({VERSION} AS BIGINT) <= {shown['version']}"
        )
        mine = f"(({closed}) OR (CAST({OPEN} AS INT) = 1 AND {mine}))"
    rows = rows.where(mine)
    if kind == "type1":
        return rows.selectExpr(*visible, f"{cdc.SEQ} AS __at", f"{cdc.DEL} AS __gone")
    return rows.selectExpr(*visible, "NULL AS __at", "false AS __gone")


def _side(rows: DataFrame, schema: T.StructType, unique: list[str], name: str) -> DataFrame:
    """Rows as one struct beside their key; null for deleted ones."""
    kept = ~F.col("__gone")
    return rows.select(
        *[F.col(f"`{k}`").alias(f"__{name}_{i}") for i, k in enumerate(unique)],
        F.when(kept, F.struct(*[f"`{c}`" for c in schema.names])).alias(f"__{name}"),
        F.when(kept, comparable_struct(schema, schema.names)).alias(f"__{name}_same"),
        F.col("__at").alias(f"__{name}_at"),
    )


def note_reader(spark: SparkSession, path: str, reader: str, version: int) -> None:
    """A reader has taken over a version; it is kept until the reader has a later one.

    ``drop_reader`` ends this for a reader that does not come back.
    """
    folder = _meta(path, "readers", reader)
    known = storage.list_names(spark, folder)
    if f"{version:020d}.json" not in known:
        storage.write_json(spark, storage.join(folder, f"{version:020d}.json"), {"version": version})
    for name in known:
        if name < f"{version:020d}.json":
            storage.delete(spark, storage.join(folder, name))


def drop_reader(spark: SparkSession, path: str, reader: str) -> None:
    storage.delete(spark, _meta(path, "readers", reader))


def _versions_of_readers(spark: SparkSession, path: str) -> set[str]:
    """Names of the manifests that readers go on from."""
    folder = _meta(path, "readers")
    return {n for r in storage.list_names(spark, folder) for n in storage.list_names(spark, storage.join(folder, r))}


# ---- append targets ---------------------------------------------------------


def _held(described: dict) -> T.StructType:
    """The columns of the files of an append table, in the types they were written in.

    Where the type of a column became wider, later files have the column under
    another name, and the table shows the first of its columns that has a value.
    """
    schema = T.StructType.fromJson(described["schema"])
    names = described.get("held") or {}
    return T.StructType([
        g for f in schema.fields
        for g in ([T.StructField.fromJson(h) for h in names[f.name]] if f.name in names else [f])
    ])


def _widened(known: dict | None, schema: T.StructType) -> dict[str, T.DataType]:
    """Known columns that rows of a schema do not fit, with the types that hold both."""
    found = {}
    for f in T.StructType.fromJson(known["schema"]).fields if known else []:
        if f.name in schema.names:
            both = wider(f.dataType, schema[f.name].dataType)
            if not _same_type(both, f.dataType):
                found[f.name] = both
    return found


def _same_type(one: T.DataType, other: T.DataType) -> bool:
    return one.simpleString() == other.simpleString()


def declare_append(spark: SparkSession, target: Target, schema: T.StructType) -> T.StructType:
    """Create the table if needed; returns its columns, old and new."""
    path = target.location(spark)
    known = describe(spark, path)
    types = _widened(known, schema)
    held = dict((known or {}).get("held") or {})
    for name, kind in types.items():
        if name in target.partition_by:
            raise ValueError(f"{path} is partitioned by {name}, whose type changed to {kind.simpleString()}")
        before = T.StructType.fromJson(known["schema"])[name]
        columns = held.get(name) or [before.jsonValue()]
        held[name] = [*columns, T.StructField(f"__{len(columns)}_{name}", kind, True).jsonValue()]
    shown = None
    if held:
        full = T.StructType.fromJson(_grown_schema(known, schema, types).jsonValue())
        shown = [_of_held(f, held.get(f.name)) for f in full.fields]
    described = _describe(spark, target, "append", schema, types, **({"held": held, "expressions": shown} if held else {}))
    full = T.StructType.fromJson(described["schema"])
    if known is None or known["schema"] != described["schema"]:
        # "-" sorts before every flow name, so readers take the columns from it
        folder = storage.join(path, "data", f"{FLOW}=-", f"{BATCH}=-1")
        _write_columns(spark, _held(described), folder, target.partition_by)
    show(spark, target)
    return full


def _grown_schema(known: dict, schema: T.StructType, types: dict[str, T.DataType]) -> T.StructType:
    fields = {f.name: f for f in T.StructType.fromJson(known["schema"]).fields}
    for f in schema.fields:
        fields.setdefault(f.name, f)
    return T.StructType([T.StructField(n, types.get(n, f.dataType), True) for n, f in fields.items()])


def _of_held(field: T.StructField, columns: list[dict] | None) -> str:
    """SQL of a column from the columns that hold it, the newest first."""
    if not columns:
        return f"`{field.name}`"
    held = [T.StructField.fromJson(c) for c in reversed(columns)]
    values = ", ".join(as_type(f"`{h.name}`", h.dataType, field.dataType) for h in held)
    return f"coalesce({values}) AS `{field.name}`"


def append(
    df: DataFrame, target: Target, flow: str, batch: int, behind: Callable[[DataFrame], DataFrame] | None = None,
    carried: Iterable[str] = (),
) -> bool:
    """Write one batch of a flow; false if that was done before.

    behind: applied to the rows in the stage that writes them. It takes away the
    ``carried`` columns, which are not the table's.
    """
    spark = df.sparkSession
    path = target.location(spark)
    folder = storage.join(path, "data", f"{FLOW}={flow}", f"{BATCH}={batch}")
    if storage.exists(spark, storage.join(folder, "_SUCCESS")):
        return False
    known = describe(spark, path)
    if known and known["kind"] != "append":
        raise ValueError(f"{path} holds a {known['kind']} table, not an append table")
    names = [f["name"] for f in known["schema"]["fields"]] if known else []
    schema = T.StructType([f for f in df.schema.fields if f.name not in carried])
    if known is None or any(c not in names for c in schema.names) or _widened(known, schema):
        # flows of one run append side by side, but declare one after the other
        with _DECLARING:
            declare_append(spark, target, schema)
        known = describe(spark, path)
    full = T.StructType.fromJson(known["schema"])
    rows = _laid_out(_align(df, T.StructType([*full.fields, *[df.schema[c] for c in carried]])), target)
    held = {name: columns[-1]["name"] for name, columns in (known.get("held") or {}).items()}
    _store((behind(rows) if behind else rows).withColumnsRenamed(held), folder, target.partition_by)
    return True


def has_batch(spark: SparkSession, target: Target, flow: str, batch: int) -> bool:
    folder = storage.join(target.location(spark), "data", f"{FLOW}={flow}", f"{BATCH}={batch}")
    return storage.exists(spark, storage.join(folder, "_SUCCESS"))


def append_staged(
    df: DataFrame, label: str, targets: list[Target], folder: str, flow: str, batch: int, schemas: list[T.StructType]
) -> None:
    """Write a batch of several append targets at once: ``label`` is the place of a row's target.

    The rows are written to a folder of their own first, one folder per target, and these
    become batches by renaming. A repeated batch goes on from what was written.
    """
    spark = df.sparkSession
    if not storage.exists(spark, storage.join(folder, "_SUCCESS")):
        df.write.mode("overwrite").partitionBy(label).parquet(folder)
    for i, (target, schema) in enumerate(zip(targets, schemas)):
        if has_batch(spark, target, flow, batch):
            continue
        known = describe(spark, target.location(spark))
        if known and (known["kind"] != "append" or known.get("held") or _widened(known, schema)):
            raise ValueError(f"{target.path} cannot take rows of a fan-out any more; give it a flow of its own")
        with _DECLARING:
            declare_append(spark, target, schema)
        path = storage.join(target.location(spark), "data", f"{FLOW}={flow}", f"{BATCH}={batch}")
        storage.move(spark, storage.join(folder, f"{label}={i}"), path)
        storage.write_text(spark, storage.join(path, "_SUCCESS"), "")
    storage.delete(spark, folder)


# ---- change targets ---------------------------------------------------------


def _start(spark, target: Target, buckets: int) -> dict:
    current = manifest(spark, target.location(spark))
    return current or {"version": 0, "buckets": [-1] * buckets, "applied": {}, "floor": None}


def declare_changes(spark, target: Target, schema: T.StructType, spec: cdc.ChangeSpec) -> None:
    """Create the change target for inputs of this schema."""
    empty = no_rows(spark, schema)
    shape = cdc.shape_of(empty, spec)
    log = cdc.change_rows(empty, spec)
    if spec.scd_type == "1":
        stored = cdc.type1_state(log, shape).schema
        expressions = cdc.type1_expressions(shape)
    else:
        stored, expressions = cdc.target_schema(empty, spec), None
    _declare(
        spark, target, f"type{spec.scd_type}", cdc.target_schema(empty, spec), stored,
        [(VERSION, T.LongType()), (BUCKET, T.IntegerType())], [BUCKET], expressions,
        keys=shape.keys, sequence=spec.sequence_by,
    )


def _with_columns_of(spark, path: str, df: DataFrame, spec: cdc.ChangeSpec) -> DataFrame:
    """The input with the table's columns first, nulls for those it lacks."""
    described = describe(spark, path)
    if described is None:
        return df
    known = [
        f for f in T.StructType.fromJson(described["schema"]).fields
        if f.name not in (cdc.START, cdc.END)
    ]
    present, dropped = set(df.columns), set(named_list(spec.except_column_list))
    unfit = {n: t for n, t in _widened(described, df.schema).items() if n not in dropped}
    if unfit:
        names = ", ".join(f"{n} to {t.simpleString()}" for n, t in unfit.items())
        raise ValueError(f"{path}: columns of a table of changes keep their types, but these changed: {names}")
    first = [
        F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in known
        if f.name not in dropped
    ]
    names = {f.name for f in known}
    return df.select(*first, *[f"`{c}`" for c in df.columns if c not in names or c in dropped])


def _declare(spark, target, kind, schema, stored, folders, inner, expressions=None, **more) -> None:
    path = target.location(spark)
    full = T.StructType([*stored.fields, *[T.StructField(n, t) for n, t in folders]])
    known = describe(spark, path)
    if known is None or known.get("stored") != json.loads(json.dumps(full.jsonValue())):
        # "-1" sorts before every version, so readers take the columns from it
        folder = storage.join(path, "state", f"{VERSION}=-1", *[f"{n}=-1" for n in inner])
        _write_columns(spark, stored, folder, target.partition_by)
    _describe(spark, target, kind, schema, stored=full.jsonValue(), expressions=expressions, **more)
    show(spark, target)


def _read_state(spark, path: str, current: dict, buckets: list[int]) -> DataFrame:
    described = describe(spark, path)
    stored = T.StructType.fromJson(described["stored"])
    rows = _load(spark, storage.join(path, "state"), stored, described["partition_by"])
    # both conditions are on folder names, so other buckets are not even listed as tasks
    rows = rows.where(_bucket_condition(current["buckets"])).where(F.col(BUCKET).isin(buckets))
    return rows.drop(VERSION, BUCKET)


def apply_changes(
    df: DataFrame, target: Target, spec: cdc.ChangeSpec, flow: str, batch: int
) -> bool:
    """Fold one batch of change events into the target; false if that was done before."""
    spark = df.sparkSession
    path = target.location(spark)
    df = _with_columns_of(spark, path, df, spec)
    described = describe(spark, path)
    shape = cdc.shape_of(df, spec)
    known = T.StructType.fromJson(described["schema"]).names if described else []
    if any(c not in known for c in shape.columns):
        declare_changes(spark, target, df.schema, spec)
    current = _start(spark, target, target.buckets(spark))
    if current["applied"].get(flow, -1) >= batch:
        show(spark, target)
        return False
    merge = _merge_type1 if spec.scd_type == "1" else _merge_type2
    version = current["version"] + 1
    touched, floor = merge(df, target, spec, current, version)
    buckets = [version if i in touched else v for i, v in enumerate(current["buckets"])]
    following = {
        "version": version,
        "buckets": buckets,
        "applied": {**current["applied"], flow: batch},
        "floor": floor,
    }
    known_heads = current.get("heads") or ([-1] * len(buckets) if not current["version"] else None)
    if spec.scd_type == "2" and known_heads is not None:
        following["heads"] = [
            version if i in touched or not current["version"] else v for i, v in enumerate(known_heads)
        ]
    _commit(spark, target, following)
    return True


def _merge_type1(df, target, spec, current, version):
    spark = df.sparkSession
    path = target.location(spark)
    shape = cdc.shape_of(df, spec)
    buckets = len(current["buckets"])
    log = cdc.change_rows(df, spec)
    old_floor = floor = current["floor"]
    if spec.apply_as_truncates:
        sequence = log.schema[cdc.SEQ].dataType
        found = cdc.truncate_floor(log)
        if found is not None:
            row = spark.range(1).select(
                F.greatest(
                    F.lit(found).cast(sequence), F.lit(old_floor or found).cast(sequence)
                ).cast("string")
            )
            floor = row.first()[0]
    # reduced to one row per key before it meets the state
    fresh = cdc.type1_merge(cdc.type1_state(cdc.apply_floor(log, floor), shape), shape)
    if not current["version"]:
        if buckets != int(spark.conf.get("spark.sql.shuffle.partitions")):
            # otherwise the grouping by key has laid out the buckets already
            fresh = _by_bucket(fresh, shape.keys, buckets)
        return _write_buckets(fresh, target, shape.keys, version, buckets), floor
    fresh = fresh.persist()
    try:
        touched, small, _ = _touched(fresh.withColumn("__n", F.lit(1)), shape.keys, buckets)
        if floor != old_floor:
            touched = list(range(buckets))
        if not touched:
            return [], floor
        state = _read_state(spark, path, current, touched)
        if floor != old_floor:
            state = _forget(state, shape, floor)
        if small:
            # the few keys of the batch go to the state; other rows are copied
            # from bucket to bucket without a shuffle
            mine, others = skew.split_by_keys(state, fresh, shape.keys)
            merged = others.unionByName(cdc.type1_merge(mine.unionByName(fresh), shape))
        else:
            merged = cdc.type1_merge(_by_bucket(state.unionByName(fresh), shape.keys, buckets), shape)
        _write_buckets(merged, target, shape.keys, version, buckets)
        return touched, floor
    finally:
        fresh.unpersist()


def _by_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """One partition per bucket; the grouping by key that follows needs no other shuffle."""
    return df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])


def _touched(per_key: DataFrame, keys: list[str], buckets: int) -> tuple[list[int], bool, int]:
    """Buckets of the keys, whether the keys are small enough to broadcast, and the largest ``__n``."""
    size = F.octet_length(F.to_json(F.struct(*[f"`{k}`" for k in keys])))
    rows = (
        per_key.groupBy(bucket_of(keys, buckets).alias("b"))
        .agg(F.sum(size).alias("bytes"), F.max("__n").alias("most")).collect()
    )
    limit = int(per_key.sparkSession.conf.get(BROADCAST_BYTES, str(32 * 1024 * 1024)))
    return [r["b"] for r in rows], sum(r["bytes"] for r in rows) <= limit, max((r["most"] for r in rows), default=0)


@contextmanager
def _beside(spark: SparkSession, job: Callable[[], None]):
    """Run a job while another one runs; both are done at the end."""
    with ThreadPoolExecutor(1) as pool:
        running = pool.submit(inheritable_thread_target(spark)(job))
        yield
        running.result()


def _forget(state: DataFrame, shape: cdc.Shape, floor: str) -> DataFrame:
    """State rows without anything that is not after the floor."""
    limit = F.lit(floor).cast(state.schema[cdc.SEQ].dataType)
    return state.where(F.col(cdc.SEQ) > limit).withColumns(
        {c: F.when(F.col(f"`{c}`.{cdc.SEQ}") > limit, F.col(f"`{c}`")) for c in shape.fill}
    )


def _merge_type2(df, target, spec, current, version):
    """Fold a batch into a history.

    Where all events of a key are newer than any that came before, its history goes
    on from its open version; the change log is not read. Only keys with late events
    are rebuilt from the log, from the version that the first of them falls into. The
    newest sequence of every key is kept in ``heads`` to tell them apart.
    """
    spark = df.sparkSession
    path = target.location(spark)
    shape = cdc.shape_of(df, spec)
    buckets = len(current["buckets"])
    log = cdc.change_rows(df, spec)
    folder = storage.join(path, "log", f"{VERSION}={version}")
    marked = log.withColumn(BUCKET, bucket_of(shape.keys, buckets))
    _store(marked.hint("rebalance", BUCKET), folder, [], [BUCKET])
    stored = T.StructType(
        [*log.schema.fields, T.StructField(VERSION, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
    )
    logged = spark.read.schema(stored).parquet(storage.join(path, "log"))
    batch = logged.where(F.col(VERSION) == version).drop(VERSION, BUCKET)
    keys = [f"`{k}`" for k in shape.keys]
    spans = batch.groupBy(*keys).agg(
        F.min(cdc.SEQ).alias("__from"), F.max(cdc.SEQ).alias("__last"), F.count(F.lit(1)).alias("__n")
    ).persist()
    try:
        touched, small, most = _touched(spans, shape.keys, buckets)
        if not current["version"]:
            history = cdc.type2_history(batch, shape, buckets, most)
            with _beside(spark, lambda: _write_heads(spans.select(*keys, "__last"), path, shape.keys, version, buckets)):
                return _write_buckets(history, target, shape.keys, version, buckets), None
        if not touched:
            return [], None
        earliest = spans.select(*keys, "__from")
        heads = _read_heads(spark, path, current, touched, spans.select(*keys, "__last"), logged)
        late = skew.join_per_key(heads, earliest, shape.keys, small)
        late = late.where(F.col("__from") <= F.col("__last")).select(*keys, "__from").persist()
        try:
            some_late = late.limit(1).count() > 0
            old = _read_state(spark, path, current, touched)
            fresh, cuts, again = earliest.select(*keys), None, []
            news = batch
            if some_late:
                fresh = skew.without_keys(fresh, late, shape.keys, small)
                news = skew.without_keys(batch, late, shape.keys, small)
                cuts = _cuts(old, late, shape, small).persist()
                again = [_logged_since(logged, cuts, shape, version, buckets, small)]
                rebuilt_from = cuts
                if shape.fill:
                    ending = _carried_on(old, cuts, shape, small)
                    again.append(cdc.open_as_changes(ending, shape))
                    starts = cuts.unionByName(ending.select(*keys, F.col(cdc.START).alias("__cut")))
                    rebuilt_from = starts.groupBy(*keys).agg(F.min("__cut").alias("__cut"))
            # versions that begin before the cut of their key stay as they are, and so
            # do closed versions of keys whose history only goes on
            per_key = fresh.withColumns({"__cut": F.lit(None).cast(shape.sequence), "__late": F.lit(False)})
            if some_late:
                per_key = per_key.unionByName(rebuilt_from.withColumn("__late", F.lit(True)))
            kept = skew.join_per_key(old, per_key, shape.keys, small, "left").where(
                F.col("__late").isNull()
                | (F.col("__late") & (F.col(cdc.START) < F.col("__cut")))
                | (~F.col("__late") & F.col(cdc.END).isNotNull())
            )
            begun = skew.join_per_key(old.where(F.col(cdc.END).isNull()), fresh, shape.keys, small)
            rows = reduce(DataFrame.unionByName, [news, cdc.open_as_changes(begun, shape), *again])
            # a history that goes on has the rows of the batch and its open version
            rebuilt = cdc.type2_history(rows, shape, buckets, None if some_late else most + 1)
            merged = _merged_heads(heads, spans.select(*keys, "__last"), shape.keys, small)
            with _beside(spark, lambda: _write_heads(merged, path, shape.keys, version, buckets)):
                _write_buckets(
                    kept.drop("__cut", "__late").unionByName(rebuilt), target, shape.keys, version, buckets
                )
        finally:
            late.unpersist()
            if cuts is not None:
                cuts.unpersist()
        return touched, None
    finally:
        spans.unpersist()


def _logged_since(logged, cuts, shape: cdc.Shape, version: int, buckets: int, small: bool) -> DataFrame:
    """Logged events of the keys with late events, from the cut of each key on."""
    spark = logged.sparkSession
    late_buckets = [r["b"] for r in cuts.select(bucket_of(shape.keys, buckets).alias("b")).distinct().collect()]
    events = logged.where((F.col(VERSION) <= version) & F.col(BUCKET).isin(late_buckets))
    if isinstance(shape.sequence, T.AtomicType):
        # a literal, so that files and row groups that end before it are not read
        least = cuts.agg(F.min("__cut").cast("string")).first()[0]
        events = events.where(F.col(cdc.SEQ) >= F.lit(least).cast(shape.sequence))
    again = skew.join_per_key(events.drop(VERSION, BUCKET), cuts, shape.keys, small)
    return again.where(F.col(cdc.SEQ) >= F.col("__cut")).drop("__cut")


# the newest sequence of every key of a type 2 target, laid out as its state


def _write_heads(heads: DataFrame, path: str, keys: list[str], version: int, buckets: int) -> None:
    rows = heads.withColumn(BUCKET, bucket_of(keys, buckets))
    _store(rows.hint("rebalance", BUCKET), storage.join(path, "heads", f"{VERSION}={version}"), [], [BUCKET])


def _read_heads(spark, path, current, touched, shape_of_rows: DataFrame, logged: DataFrame) -> DataFrame:
    """Newest sequences before this batch, of the touched buckets."""
    if current.get("heads") is None:
        # a table from before heads were kept: from the log
        keys = [f"`{c}`" for c in shape_of_rows.columns if c != "__last"]
        before = logged.where((F.col(VERSION) <= current["version"]) & F.col(BUCKET).isin(touched))
        return before.groupBy(*keys).agg(F.max(cdc.SEQ).alias("__last"))
    if not storage.exists(spark, storage.join(path, "heads")):
        return no_rows(spark, shape_of_rows.schema)
    stored = T.StructType(
        [*shape_of_rows.schema.fields, T.StructField(VERSION, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
    )
    rows = spark.read.schema(stored).parquet(storage.join(path, "heads"))
    rows = rows.where(_bucket_condition(current["heads"])).where(F.col(BUCKET).isin(touched))
    return rows.drop(VERSION, BUCKET)


def _merged_heads(heads: DataFrame, spans: DataFrame, keys: list[str], small: bool) -> DataFrame:
    mine, others = skew.with_keys(heads, spans, keys, small), skew.without_keys(heads, spans, keys, small)
    merged = mine.unionByName(spans).groupBy(*[f"`{k}`" for k in keys]).agg(F.max("__last").alias("__last"))
    return others.unionByName(merged)


def _cuts(old: DataFrame, earliest: DataFrame, shape: cdc.Shape, small: bool) -> DataFrame:
    """Per key of the batch, the sequence from which its history is rebuilt.

    A version that ended before the first event of the batch cannot change. The
    version that this event falls into, or borders on, is rebuilt from its start.
    """
    keys = [f"`{k}`" for k in shape.keys]
    begun = old.select(*keys, F.col(cdc.START).alias("__cut"), F.col(cdc.END).alias("__end"))
    begun = skew.join_per_key(begun, earliest, shape.keys, small)
    begun = begun.where(F.col("__end").isNull() | (F.col("__end") >= F.col("__from")))
    starts = begun.select(*keys, "__cut").unionByName(
        earliest.select(*keys, F.col("__from").alias("__cut"))
    )
    return starts.groupBy(*keys).agg(F.min("__cut").alias("__cut"))


def _carried_on(old: DataFrame, cuts: DataFrame, shape: cdc.Shape, small: bool) -> DataFrame:
    """The versions that end where the rebuilding of their key begins.

    Where nulls are ignored, such a version has all values that the events before have
    left; so a history goes on from it as from an open version, and no older event
    is read. A version that a delete ended leaves nothing, and ends before.
    """
    ending = skew.join_per_key(old, cuts, shape.keys, small)
    return ending.where(F.col(cdc.END) == F.col("__cut")).drop("__cut")


def _write_buckets(df, target: Target, keys, version: int, buckets: int) -> list[int]:
    """Write rows by bucket; returns the buckets that got any."""
    spark = df.sparkSession
    rows = df.withColumn(BUCKET, bucket_of(keys, buckets))
    if target.cluster_by:
        order = [BUCKET, *target.partition_by, *target.cluster_by]
        rows = rows.sortWithinPartitions(*[f"`{c}`" for c in order])
    folder = storage.join(target.location(spark), "state", f"{VERSION}={version}")
    _store(rows, folder, target.partition_by, [BUCKET])
    return _numbers(spark, folder, BUCKET)


def _numbers(spark, folder: str, column: str) -> list[int]:
    """Values of an integer folder column below a folder."""
    prefix = f"{column}="
    names = storage.list_names(spark, folder)
    return [int(n[len(prefix):]) for n in names if n.startswith(prefix)]


# ---- snapshot targets and whole rewrites ------------------------------------


def last_snapshot(spark: SparkSession, target: Target):
    current = manifest(spark, target.location(spark))
    return _number(current) if current else None


def next_version(spark: SparkSession, target: Target) -> int:
    current = manifest(spark, target.location(spark))
    return (current["version"] if current else 0) + 1


def _number(current: dict):
    """Snapshot version of a manifest in its Python type."""
    text = current["snapshot"]
    if text is None:
        return None
    read = {
        "bigint": int, "double": float, "string": str,
        "date": dt.date.fromisoformat, "timestamp": dt.datetime.fromisoformat,
    }
    return read[current["number"]](text)


def apply_snapshot(df: DataFrame, target: Target, spec: snap.SnapshotSpec, number) -> None:
    """Bring the target to the state of the next snapshot."""
    spark = df.sparkSession
    path = target.location(spark)
    history = spec.scd_type == "2"
    schema = df.schema
    if history:
        kind = T.DataType.fromDDL(snap.version_type(number))
        schema = T.StructType(
            [*schema.fields, T.StructField(cdc.START, kind), T.StructField(cdc.END, kind)]
        )
    folders = [(VERSION, T.LongType())]
    if history:
        folders += [(OPEN, T.IntegerType()), (BUCKET, T.IntegerType())]
    _declare(
        spark, target, "snapshot2" if history else "full", schema, schema, folders,
        [OPEN, BUCKET] if history else [], keys=spec.keys,
    )
    current = manifest(spark, path)
    latest = _number(current) if current else None
    if latest is not None and not number > latest:
        raise ValueError(f"snapshot version {number!r} is not above {latest!r}")
    version = next_version(spark, target)
    folder = storage.join(path, "state", f"{VERSION}={version}")
    more = {}
    if not history:
        snap.check_unique(df, spec.keys, "a snapshot")
        _store(_laid_out(df, target), folder, target.partition_by)
    else:
        more["buckets"] = _next_history(df, target, spec, number, current, version, schema, folders)
    text = number.isoformat() if isinstance(number, dt.date) else str(number)
    _commit(
        spark, target,
        {"version": version, "snapshot": text, "number": snap.version_type(number), **more},
    )


def _next_history(df, target, spec, number, current, version, schema, folders) -> list[int]:
    """Write what the snapshot opens and closes; returns the version of each bucket's open rows.

    Hashes tell which keys change. Open rows of buckets without such a key stay
    where they are; an unchanged snapshot writes nothing.
    """
    spark = df.sparkSession
    path = target.location(spark)
    if current is None:
        versions = [version] * target.buckets(spark)
        rows = snap.next_history(None, df, number, spec)
    else:
        versions = current.get("buckets")
        if versions is None:
            raise ValueError(f"{path} was written without buckets; reset it and load it again")
        stored = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in folders]])
        open_rows = _load(spark, storage.join(path, "state"), stored, target.partition_by).where(
            f"CAST({OPEN} AS INT) = 1 AND {_bucket_condition(versions)}"
        )
        bucket = bucket_of(spec.keys, len(versions))
        changed = snap.changed_keys(open_rows.drop(VERSION, OPEN, BUCKET), df, spec)
        touched = sorted(r["b"] for r in changed.select(bucket.alias("b")).distinct().collect())
        if not touched:
            return versions
        versions = [version if i in set(touched) else v for i, v in enumerate(versions)]
        mine = open_rows.where(F.col(BUCKET).isin(touched)).drop(VERSION, OPEN, BUCKET)
        rows = snap.next_history(mine, df.where(bucket.isin(touched)), number, spec)
    rows = rows.withColumns(
        {OPEN: F.col(cdc.END).isNull().cast("int"), BUCKET: bucket_of(spec.keys, len(versions))}
    )
    laid_out = rows.hint("rebalance", OPEN, BUCKET, *target.partition_by)
    _store(laid_out, storage.join(path, "state", f"{VERSION}={version}"), target.partition_by, [OPEN, BUCKET])
    return versions


def overwrite(df: DataFrame, target: Target) -> None:
    """Replace all rows; ``df`` may read the table itself."""
    spark = df.sparkSession
    path = target.location(spark)
    _declare(spark, target, "full", df.schema, df.schema, [(VERSION, T.LongType())], [])
    version = next_version(spark, target)
    folder = storage.join(path, "state", f"{VERSION}={version}")
    described = describe(spark, path)
    full = T.StructType.fromJson(described["schema"])
    _store(_laid_out(_align(df, full), target), folder, target.partition_by)
    _commit(spark, target, {"version": version, "snapshot": None})


# ---- clean-up ---------------------------------------------------------------


def _vacuum(spark, target: Target, version: int) -> None:
    """Delete versions that none of the kept manifests shows."""
    keep = int(target.properties.get(KEEP_PROPERTY, "3"))
    path = target.location(spark)
    names = [n for n in storage.list_names(spark, _meta(path, "versions")) if n.endswith(".json")]
    if len(names) <= keep:
        return
    read_on = _versions_of_readers(spark, path)
    kept_names = [n for n in names[:-keep] if n in read_on] + names[-keep:]
    kept = [storage.read_json(spark, _meta(path, "versions", n)) for n in kept_names]
    kind = describe(spark, path)["kind"]
    doomed = []
    for number in _numbers(spark, storage.join(path, "state"), VERSION):
        folder = storage.join(path, "state", f"{VERSION}={number}")
        if number < 0 or number > version:
            continue
        if kind in ("type1", "type2"):
            shown = {b for m in kept for b, v in enumerate(m["buckets"]) if v == number}
            doomed += [
                storage.join(folder, f"{BUCKET}={b}")
                for b in _numbers(spark, folder, BUCKET)
                if shown and b not in shown
            ]
            if not shown:
                doomed.append(folder)
        elif kind == "snapshot2":
            # closed versions stay; open rows go once their bucket was written again
            shown = {b for m in kept for b, v in enumerate(m["buckets"]) if v == number}
            opened = storage.join(folder, f"{OPEN}=1")
            doomed += [
                storage.join(opened, f"{BUCKET}={b}") for b in _numbers(spark, opened, BUCKET) if b not in shown
            ]
        elif number not in {m["version"] for m in kept}:
            doomed.append(folder)
    for number in _numbers(spark, storage.join(path, "heads"), VERSION):
        folder = storage.join(path, "heads", f"{VERSION}={number}")
        shown = {b for m in kept for b, v in enumerate(m.get("heads") or []) if v == number}
        if number <= version and not shown:
            doomed.append(folder)
        elif number <= version:
            doomed += [
                storage.join(folder, f"{BUCKET}={b}") for b in _numbers(spark, folder, BUCKET) if b not in shown
            ]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda folder: storage.delete(spark, folder), doomed))
    for name in set(names) - set(kept_names):
        storage.delete(spark, _meta(path, "versions", name))
