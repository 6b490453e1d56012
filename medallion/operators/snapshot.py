"""Slowly changing dimensions from full snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.expressions import comparable_struct, struct_of
from .cdc import END, START, _selected


@dataclass(frozen=True)
class SnapshotSpec:
    keys: list[str]
    scd_type: str = "1"
    track_history_column_list: list[str] | None = None
    track_history_except_column_list: list[str] | None = None

    def __post_init__(self):
        object.__setattr__(self, "scd_type", str(self.scd_type))
        if not self.keys:
            raise ValueError("keys are missing")
        if self.scd_type not in ("1", "2"):
            raise ValueError(f"scd_type {self.scd_type!r} is neither 1 nor 2")

    def tracked(self, columns: list[str]) -> list[str]:
        values = [c for c in columns if c not in self.keys]
        return _selected(
            values, self.track_history_column_list, self.track_history_except_column_list, True
        )


class DuplicateKeys(ValueError):
    """Rows that must be unique by key are not."""


def check_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Only the key columns are read and shuffled, the rows stay where they are."""
    twice = df.groupBy(*[f"`{k}`" for k in keys]).count().where("count > 1")
    row = twice.first()
    if row is not None:
        raise DuplicateKeys(f"{what} has {row['count']} rows of key {tuple(row)[:-1]}")


def _duplicate(keys) -> str:
    return f"a snapshot has several rows of one key ({', '.join(keys)})"


def next_history(open_rows: DataFrame | None, snapshot: DataFrame, version, spec: SnapshotSpec):
    """Compare the open versions with the next snapshot, in one shuffle.

    Returns rows of the target schema: versions closed by this snapshot (end
    set) and all versions open after it (end null). Versions closed earlier are
    not part of the input and never change again.

    Both sides are stacked and grouped by key, which is a full outer join that
    treats null keys as equal and sees duplicates in the snapshot.
    """
    keys = spec.keys
    columns = snapshot.columns
    values = [c for c in columns if c not in keys]
    kind = version_type(version)
    version, none = F.lit(version).cast(kind), F.lit(None).cast(kind)
    new = snapshot.select(
        *[f"`{k}`" for k in keys],
        struct_of(values, "__new"),
        F.lit(1).alias("__n"),
    )
    if open_rows is None:
        check_unique(snapshot, keys, "a snapshot")
        return snapshot.withColumn(START, version).withColumn(END, none)
    old = open_rows.select(
        *[f"`{k}`" for k in keys],
        struct_of(values, "__old"),
        F.col(START).alias("__since"),
        F.lit(0).alias("__n"),
    )
    pairs = (
        old.unionByName(new, allowMissingColumns=True)
        .groupBy(*[f"`{k}`" for k in keys])
        .agg(
            F.first("__old", ignorenulls=True).alias("__old"),
            F.first("__new", ignorenulls=True).alias("__new"),
            F.first("__since", ignorenulls=True).alias("__since"),
            F.sum("__n").alias("__n"),
        )
    )
    checked = F.when(F.col("__n") > 1, F.raise_error(_duplicate(keys))).otherwise(F.lit(True))
    pairs = pairs.where(checked)

    tracked = spec.tracked(columns)
    schema = snapshot.schema

    def compared(side: str):
        return F.struct(
            *[_comparable(schema[c], side) for c in tracked] or [F.lit(True).alias("__none")]
        )

    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    same = has_old & has_new & compared("__old").eqNullSafe(compared("__new"))

    def row(values_from: str, since, until):
        return F.struct(F.col(values_from).alias("v"), since.alias("s"), until.alias("e"))

    versions = F.filter(
        F.array(
            F.when(has_old & ~same, row("__old", F.col("__since"), version)),
            F.when(same, row("__new", F.col("__since"), none)),
            F.when(has_new & ~same, row("__new", version, none)),
        ),
        lambda x: x.isNotNull(),
    )
    out = pairs.select(*[f"`{k}`" for k in keys], F.explode(versions).alias("r"))
    return out.select(
        *[
            F.col(f"`{c}`") if c in keys else F.col(f"r.v.`{c}`").alias(c)
            for c in columns
        ],
        F.col("r.s").alias(START),
        F.col("r.e").alias(END),
    )


def changed_keys(open_rows: DataFrame, snapshot: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Keys that the snapshot opens, changes or closes, by the hashes of their rows.

    Only keys and hashes are shuffled. Null keys are equal to each other; a key that
    occurs twice in the snapshot is an error.
    """
    keys = [f"`{k}`" for k in spec.keys]
    values = [c for c in snapshot.columns if c not in spec.keys]

    def text_or_value(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.AtomicType):
            return [column, column.isNull()]
        # hashes pass over nulls, also those within values
        return [F.to_json(F.struct(_comparable(field)), {"ignoreNullFields": "false"})]

    parts = [x for c in values for x in text_or_value(snapshot.schema[c])]
    row = F.xxhash64(*parts) if parts else F.lit(0).cast("long")

    def hashed(rows: DataFrame, side: str, number: int) -> DataFrame:
        return rows.select(*keys, row.alias(side), F.lit(number).alias("__n"))

    both = hashed(open_rows, "__old", 0).unionByName(hashed(snapshot, "__new", 1), allowMissingColumns=True)
    found = both.groupBy(*keys).agg(
        F.max("__old").alias("__old"), F.max("__new").alias("__new"), F.sum("__n").alias("__n")
    )
    twice = F.when(F.col("__n") > 1, F.raise_error(_duplicate(spec.keys)).cast("boolean")).otherwise(F.lit(True))
    return found.where(twice & ~F.col("__old").eqNullSafe(F.col("__new"))).select(*keys)


def _comparable(field: T.StructField, side: str | None = None):
    column = F.col(f"{side}.`{field.name}`" if side else f"`{field.name}`")
    if isinstance(field.dataType, T.MapType):
        return F.array_sort(F.map_entries(column)).alias(field.name)
    return column.alias(field.name)


def version_type(version) -> str:
    """SQL type of a snapshot version given as a Python value."""
    import datetime as dt

    if isinstance(version, bool):
        raise TypeError("a snapshot version must be orderable")
    if isinstance(version, int):
        return "bigint"
    if isinstance(version, float):
        return "double"
    if isinstance(version, dt.datetime):
        return "timestamp"
    if isinstance(version, dt.date):
        return "date"
    return "string"


def history(snapshots: list[tuple[DataFrame, object]], spec: SnapshotSpec) -> DataFrame:
    """Type 1 or 2 table after a sequence of snapshots, as one batch plan.

    All snapshots are stacked and meet once per key: a key has at most one row
    per snapshot, so the window never sees a large group.
    """
    versions = [version for _, version in snapshots]
    for earlier, later in zip(versions, versions[1:]):
        if not later > earlier:
            raise ValueError(f"snapshot version {later!r} is not above {earlier!r}")
    if spec.scd_type == "1":
        check_unique(snapshots[-1][0], spec.keys, "a snapshot")
        return snapshots[-1][0]
    columns = snapshots[0][0].columns
    stacked = None
    for i, (snapshot, _) in enumerate(snapshots):
        part = snapshot.select(*[f"`{c}`" for c in columns], F.lit(i).alias("__i"))
        stacked = part if stacked is None else stacked.unionByName(part)
    number = F.array(*[F.lit(v).cast(version_type(v)) for v in versions])
    tracked = comparable_struct(stacked.schema, spec.tracked(columns))
    window = Window.partitionBy(*[f"`{k}`" for k in spec.keys]).orderBy("__i")
    here = F.struct(F.col("__i").alias("i"), tracked.alias("t"))
    rows = stacked.select(
        "*", F.lag(here).over(window).alias("__before"), F.lead(here).over(window).alias("__after")
    )

    def breaks(other: str, neighbour):
        return (
            F.col(other).isNull()
            | (F.col(f"{other}.i") != neighbour)
            | ~F.col(f"{other}.t").eqNullSafe(tracked)
        )

    unique = F.when(
        F.col("__before.i") == F.col("__i"), F.raise_error(_duplicate(spec.keys))
    ).otherwise(F.lit(True))
    edges = (
        rows.where(unique)
        .withColumn("__first", breaks("__before", F.col("__i") - 1))
        .withColumn("__final", breaks("__after", F.col("__i") + 1))
        .where("__first OR __final")
        .withColumn("__opened", F.lag("__i").over(window))
    )
    return edges.where("__final").select(
        *[f"`{c}`" for c in columns],
        F.get(number, F.when(F.col("__first"), F.col("__i")).otherwise(F.col("__opened"))).alias(START),
        F.get(number, F.col("__i") + 1).alias(END),
    )
