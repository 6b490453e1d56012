"""Slowly changing dimensions from change events, as DataFrame functions.

Every function depends only on the set of change rows it gets, not on their
order of arrival, so a table may be built in any number of batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.expressions import comparable_struct, named_list, row_hash, struct_of
from . import skew

START, END = "__START_AT", "__END_AT"
SEQ, DEL, TIE, TRUNC = "__seq", "__del", "__tie", "__trunc"
# rows per sequence of a hot key from which equal sequences are reduced first
MEAN_REPEATS = 2


@dataclass(frozen=True)
class ChangeSpec:
    """How change events become a table."""

    keys: list[str]
    sequence_by: str
    scd_type: str = "1"
    where: str | None = None
    ignore_null_updates: bool = False
    apply_as_deletes: str | None = None
    apply_as_truncates: str | None = None
    column_list: list[str] | None = None
    except_column_list: list[str] | None = None
    track_history_column_list: list[str] | None = None
    track_history_except_column_list: list[str] | None = None
    flow_name: str | None = None
    once: bool = False
    ignore_null_updates_column_list: list[str] | None = None
    ignore_null_updates_except_column_list: list[str] | None = None

    def __post_init__(self):
        object.__setattr__(self, "scd_type", str(self.scd_type))
        problems = []
        if not self.keys:
            problems.append("keys are missing")
        if not self.sequence_by:
            problems.append("sequence_by is missing")
        if self.scd_type not in ("1", "2"):
            problems.append(f"scd_type {self.scd_type!r} is neither 1 nor 2")
        if self.column_list and self.except_column_list:
            problems.append("column_list and except_column_list exclude each other")
        if self.apply_as_truncates and self.scd_type == "2":
            problems.append("apply_as_truncates needs scd_type 1")
        lost = set(self.keys or []) & set(named_list(self.except_column_list))
        if self.column_list:
            lost |= set(self.keys or []) - set(named_list(self.column_list))
        if lost:
            problems.append(f"keys {sorted(lost)} must stay in the output")
        if problems:
            raise ValueError("; ".join(problems))


@dataclass(frozen=True)
class Shape:
    """Columns of a change target, derived from the input schema."""

    keys: list[str]
    columns: list[str]
    values: list[str]
    tracked: list[str]
    fill: list[str]
    sequence: T.DataType = field(compare=False)
    schema: T.StructType = field(compare=False)


def shape_of(df: DataFrame, spec: ChangeSpec) -> Shape:
    if spec.column_list:
        wanted = set(named_list(spec.column_list))
        columns = [c for c in df.columns if c in wanted]
    else:
        dropped = set(named_list(spec.except_column_list))
        columns = [c for c in df.columns if c not in dropped]
    values = [c for c in columns if c not in spec.keys]
    return Shape(
        keys=list(spec.keys),
        columns=columns,
        values=values,
        tracked=_selected(
            values, spec.track_history_column_list, spec.track_history_except_column_list, True
        ),
        fill=_selected(
            values,
            spec.ignore_null_updates_column_list,
            spec.ignore_null_updates_except_column_list,
            spec.ignore_null_updates,
        ),
        sequence=df.select(F.expr(spec.sequence_by)).schema.fields[0].dataType,
        schema=df.select(*[f"`{c}`" for c in columns]).schema,
    )


def _selected(values, listed, excepted, otherwise: bool) -> list[str]:
    if listed:
        return [v for v in values if v in set(named_list(listed))]
    if excepted:
        return [v for v in values if v not in set(named_list(excepted))]
    return list(values) if otherwise else []


def target_schema(df: DataFrame, spec: ChangeSpec) -> T.StructType:
    shape = shape_of(df, spec)
    fields = list(shape.schema.fields)
    if spec.scd_type == "2":
        fields += [T.StructField(START, shape.sequence), T.StructField(END, shape.sequence)]
    return T.StructType(fields)


def change_rows(df: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The change log: output columns, sequence, delete mark and tie-break.

    Deletes and truncates are evaluated on the input, before columns go.
    """
    shape = shape_of(df, spec)
    if spec.where and spec.where.strip():
        df = df.where(spec.where)
    sequence = F.coalesce(
        F.expr(spec.sequence_by),
        F.raise_error(f"null in sequence_by {spec.sequence_by}").cast(shape.sequence),
    )
    marks = [sequence.alias(SEQ), _mark(spec.apply_as_deletes).alias(DEL)]
    if spec.apply_as_truncates:
        marks.append(_mark(spec.apply_as_truncates).alias(TRUNC))
    log = df.select(*[f"`{c}`" for c in shape.columns], *marks)
    return log.withColumn(TIE, row_hash(shape.schema, shape.values))


def _mark(predicate: str | None):
    if not predicate or not predicate.strip():
        return F.lit(False)
    return F.coalesce(F.expr(predicate).cast("boolean"), F.lit(False))


# ---- type 1 -----------------------------------------------------------------


def truncate_floor(log: DataFrame) -> str | None:
    """Greatest sequence of a truncate, as text that casts back exactly."""
    if not isinstance(log.schema[SEQ].dataType, T.AtomicType):
        raise ValueError("apply_as_truncates needs a sequence of a simple type")
    row = log.where(TRUNC).agg(F.max(SEQ).cast("string")).first()
    return row[0]


def apply_floor(log: DataFrame, floor: str | None) -> DataFrame:
    """Forget truncate rows and everything not after the last truncate."""
    if TRUNC in log.columns:
        log = log.where(~F.col(TRUNC)).drop(TRUNC)
    if floor is not None:
        log = log.where(F.col(SEQ) > F.lit(floor).cast(log.schema[SEQ].dataType))
    return log


def _order():
    # at equal sequence an upsert wins over a delete
    return F.struct(F.col(SEQ), (~F.col(DEL)).alias("alive"), F.col(TIE))


def type1_state(log: DataFrame, shape: Shape) -> DataFrame:
    """Change rows in the form of state rows."""
    plain = [c for c in shape.columns if c not in shape.fill]
    present = [
        F.when(
            ~F.col(DEL) & F.col(f"`{c}`").isNotNull(),
            F.struct(F.col(SEQ), F.col(TIE), F.col(f"`{c}`").alias("v")),
        ).alias(c)
        for c in shape.fill
    ]
    deleted = [F.when(F.col(DEL), F.col(SEQ)).alias("__deleted_at")] if shape.fill else []
    return log.select(*[f"`{c}`" for c in plain], *present, SEQ, DEL, TIE, *deleted)


def type1_merge(state: DataFrame, shape: Shape) -> DataFrame:
    """One state row per key; associative, hence also used to fold in a batch."""
    plain = [c for c in shape.values if c not in shape.fill]
    winner = F.max_by(struct_of([*plain, SEQ, DEL, TIE]), _order()).alias("__w")
    extra = []
    if shape.fill:
        extra = [
            F.max_by(
                f"`{c}`",
                F.when(F.col(f"`{c}`").isNotNull(), F.struct(f"`{c}`.{SEQ}", f"`{c}`.{TIE}")),
            ).alias(c)
            for c in shape.fill
        ] + [F.max("__deleted_at").alias("__deleted_at")]
    merged = state.groupBy(*[f"`{k}`" for k in shape.keys]).agg(winner, *extra)
    return merged.select(
        *[f"`{k}`" for k in shape.keys],
        *[F.col(f"__w.`{c}`").alias(c) for c in plain],
        *[f"`{c}`" for c in shape.fill],
        *[F.col(f"__w.{c}").alias(c) for c in (SEQ, DEL, TIE)],
        *(["__deleted_at"] if shape.fill else []),
    )


def type1_visible(state: DataFrame, shape: Shape) -> DataFrame:
    return state.where(f"NOT {DEL}").selectExpr(*type1_expressions(shape))


def type1_expressions(shape: Shape) -> list[str]:
    """The visible columns of state rows, as SQL."""
    return [
        f"CASE WHEN __deleted_at IS NULL OR `{c}`.{SEQ} >= __deleted_at THEN `{c}`.v END AS `{c}`"
        if c in shape.fill
        else f"`{c}`"
        for c in shape.columns
    ]


def type1(df: DataFrame, spec: ChangeSpec) -> DataFrame:
    shape = shape_of(df, spec)
    log = change_rows(df, spec)
    floor = truncate_floor(log) if spec.apply_as_truncates else None
    state = type1_merge(type1_state(apply_floor(log, floor), shape), shape)
    return type1_visible(state, shape)


# ---- type 2 -----------------------------------------------------------------


def _sorted_by() -> list:
    # the winner of an equal sequence comes last; plain columns, so that
    # one sort serves all windows
    return [F.col(SEQ).asc(), F.col(DEL).desc(), F.col(TIE).asc()]


def _winners(rows: DataFrame, window: Window) -> DataFrame:
    """Drop the losers of equal sequences."""
    following = F.lead(F.struct(SEQ)).over(window)
    return (
        rows.withColumn("__following", following)
        .where(F.col("__following").isNull() | (F.col("__following") != F.struct(SEQ)))
        .drop("__following")
    )


def _filled(rows: DataFrame, shape: Shape) -> DataFrame:
    """Replace nulls of an update by the latest value since the last delete."""
    types = {f.name: f.dataType for f in shape.schema.fields}
    latest = {
        f"__last_{i}": F.when(
            ~F.col(DEL) & F.col(f"`{c}`").isNotNull(),
            F.struct(F.col(SEQ), F.col(f"`{c}`").alias("v")),
        )
        for i, c in enumerate(shape.fill)
    }
    latest["__last_delete"] = F.when(F.col(DEL), F.struct(SEQ))
    filled = skew.latest_so_far(rows, shape.keys, _sorted_by(), SEQ, latest)
    deleted = F.col(f"__last_delete.{SEQ}")
    values = {
        c: F.when(
            deleted.isNull() | (F.col(f"__last_{i}.{SEQ}") >= deleted), F.col(f"__last_{i}.v")
        ).cast(types[c])
        for i, c in enumerate(shape.fill)
    }
    return filled.select(
        *[values[c].alias(c) if c in values else F.col(f"`{c}`") for c in rows.columns]
    )


def _runs(rows: DataFrame, shape: Shape, window: Window, deletes: bool = False) -> DataFrame:
    """Join neighbouring rows of equal tracked values into one row each.

    Input rows are versions that start at ``SEQ``. Only where ``__open_start``
    and ``__open_end`` hold may a version go on in its neighbour. Of each run
    only the first and the last row matter: the first gives the start, the last
    the values and the end.
    """
    tracked = comparable_struct(shape.schema, shape.tracked)
    here = F.struct(F.col(SEQ), F.col(DEL), tracked.alias("t"))
    rows = rows.select(
        "*", F.lag(here).over(window).alias("__before"), F.lead(here).over(window).alias("__after")
    )

    def breaks(other: str, may_go_on: str):
        return (
            ~F.col(may_go_on)
            | F.col(other).isNull()
            | F.col(DEL)
            | F.col(f"{other}.{DEL}")
            | ~F.col(f"{other}.t").eqNullSafe(tracked)
        )

    keep = F.col("__first") | F.col("__final")
    edges = (
        rows.withColumn("__first", breaks("__before", "__open_start"))
        .withColumn("__final", breaks("__after", "__open_end"))
        .where(keep if deletes else keep & ~F.col(DEL))
        .withColumn("__begun", F.struct(F.col(SEQ), F.col("__before").isNull().alias("open")))
        .withColumn("__opened", F.lag("__begun").over(window))
        .where("__final")
        .withColumn("__from", F.when(F.col("__first"), F.col("__begun")).otherwise(F.col("__opened")))
    )
    return edges.select(
        *[
            F.col(f"`{c}`")
            for c in edges.columns
            if c not in (SEQ, END, "__first", "__final", "__begun", "__opened", "__from", "__before",
                         "__after", "__open_start", "__open_end")
        ],
        F.col(f"__from.{SEQ}").alias(SEQ),
        F.when(F.col("__open_end"), F.col(f"__after.{SEQ}")).otherwise(F.col(END)).alias(END),
        # a run may go on beyond these rows only at their ends
        F.col("__from.open").alias("__open_start"),
        F.col("__after").isNull().alias("__open_end"),
    )


def _as_versions(rows: DataFrame, shape: Shape) -> DataFrame:
    return rows.withColumns(
        {
            END: F.lit(None).cast(shape.sequence),
            "__open_start": F.lit(True),
            "__open_end": F.lit(True),
        }
    )


def _cold_history(log: DataFrame, shape: Shape, buckets: int | None) -> DataFrame:
    """Keys of ordinary size meet in one window each; one shuffle in all."""
    keys = [F.col(f"`{k}`") for k in shape.keys]
    if buckets:
        log = log.repartition(buckets, *keys)
    window = Window.partitionBy(*keys).orderBy(*_sorted_by())
    rows = _winners(log, window)
    if shape.fill:
        rows = _filled(rows, shape)
    return _runs(_as_versions(rows, shape), shape, window)


def _hot_history(log: DataFrame, shape: Shape, hot: DataFrame, limit: int) -> DataFrame:
    """Hot keys are cut into slices; runs are found per slice, then joined.

    Only the first and the last run of a slice take part in the joining. Where
    rows share sequences (a date, say), an aggregation that combines before the
    shuffle removes the losers first: slices are cut between sequences, so a key
    must not have many more rows than sequences.
    """
    keys = [F.col(f"`{k}`") for k in shape.keys]
    repeats = (
        log.groupBy(*keys, SEQ).agg(F.count(F.lit(1)).alias("__n"))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("__d"), F.max("__n").alias("__m"), F.sum("__n").alias("__n"))
        .agg(F.max("__m").alias("most"), F.max(F.col("__n") / F.col("__d")).alias("mean"))
    ).first()
    rows = log
    reduced = repeats["most"] > limit or repeats["mean"] > MEAN_REPEATS
    if reduced:
        payload = [*shape.values, DEL, TIE]
        rows = (
            log.groupBy(*keys, SEQ)
            .agg(F.max_by(struct_of(payload), _order()).alias("__w"))
            .select(*keys, SEQ, *[F.col(f"__w.`{c}`").alias(c) for c in payload])
        )
        hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    rows = skew.add_slices(rows, hot, shape.keys, SEQ, limit)
    in_slice = Window.partitionBy(*keys, skew.SLICE).orderBy(*_sorted_by())
    if repeats["most"] > 1 and not reduced:
        rows = _winners(rows, in_slice)
    if shape.fill:
        rows = _filled(rows, shape)
    runs = _runs(_as_versions(rows, shape), shape, in_slice, deletes=True)
    at_border = F.col("__open_start") | F.col("__open_end")
    across = Window.partitionBy(*keys).orderBy(SEQ)
    joined = _runs(runs.where(at_border), shape, across)
    return runs.where(~at_border & ~F.col(DEL)).unionByName(joined)


def type2_history(
    log: DataFrame, shape: Shape, buckets: int | None = None, most: int | None = None
) -> DataFrame:
    """Versions with their validity interval, from a change log.

    With ``buckets`` the rows come out partitioned by bucket of the key, except
    that hot keys are spread over several partitions. ``most``: rows of a key at most, if the
    caller knows; keys are then only counted where one may be hot.
    """
    limit = skew.slice_rows(log.sparkSession)
    hot, limit = (None, limit) if most is not None and most <= limit else skew.hot_keys(log, shape.keys)
    if hot is None:
        history = _cold_history(log, shape, buckets)
    else:
        hot_log, cold_log = skew.split_by_keys(log, hot, shape.keys)
        hot_part = _hot_history(hot_log, shape, hot, limit)
        history = _cold_history(cold_log, shape, buckets).unionByName(
            hot_part, allowMissingColumns=True
        )
    return history.select(
        *[f"`{c}`" for c in shape.columns], F.col(SEQ).alias(START), F.col(END).alias(END)
    )


def open_as_changes(versions: DataFrame, shape: Shape) -> DataFrame:
    """Open versions as the changes that began them, for a history that goes on.

    An open version has the values of the last event before, nulls filled where the
    table ignores them, so newer events see the same as after all older ones.
    """
    return versions.select(
        *[f"`{c}`" for c in shape.columns],
        F.col(START).alias(SEQ),
        F.lit(False).alias(DEL),
        row_hash(shape.schema, shape.values).alias(TIE),
    )


def type2(df: DataFrame, spec: ChangeSpec) -> DataFrame:
    return type2_history(change_rows(df, spec), shape_of(df, spec))


def apply_changes(df: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The target table that the change events in ``df`` lead to."""
    return type1(df, spec) if spec.scd_type == "1" else type2(df, spec)
