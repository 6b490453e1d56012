"""Keys that hold a large share of the rows.

A window partitioned by key puts a whole key into one task. Keys with more rows
than one task should get are cut into slices of their order, so that a window is
partitioned by (key, slice); what crosses a slice border is settled on a table
with a few rows per slice.

A key is hot if it has more rows than a slice, whatever the other keys have. Hot
keys are broadcast, so there may be at most ``HOT_KEYS``: only with more rows than
that many slices hold does the slice grow.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_SLICE = "medallion.slice.rows"
KEY, SLICE = "__k", "__slice"
SAMPLES_PER_SLICE = 16
HOT_KEYS = 100_000


def slice_rows(spark) -> int:
    return int(spark.conf.get(ROWS_PER_SLICE, "2000000"))


def hot_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame | None, int]:
    """Keys with more rows than a slice, with their counts, and the slice size."""
    spark = df.sparkSession
    limit = slice_rows(spark)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total, top = counts.agg(F.sum("__n"), F.max("__n")).first()
    if top is None or top <= limit:
        return None, limit
    limit = max(limit, math.ceil(total / HOT_KEYS))
    hot = counts.where(F.col("__n") > limit)
    # fewer than HOT_KEYS rows, see above
    found = hot.collect()
    return (spark.createDataFrame(found, hot.schema) if found else None), limit


def _on(keys: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"`{k}`").eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)],
    )


def _renamed(per_key: DataFrame, keys: list[str], extra: list[str] = ()) -> DataFrame:
    named = [F.col(f"`{k}`").alias(f"__key_{i}") for i, k in enumerate(keys)]
    return per_key.select(*named, *[f"`{c}`" for c in extra])


def with_keys(df: DataFrame, listed: DataFrame, keys: list[str], small: bool = True) -> DataFrame:
    """Rows whose key is listed; null keys are equal to each other."""
    other = _renamed(listed, keys)
    return df.join(F.broadcast(other) if small else other, _on(keys), "left_semi")


def without_keys(df: DataFrame, listed: DataFrame, keys: list[str], small: bool = True) -> DataFrame:
    other = _renamed(listed, keys)
    return df.join(F.broadcast(other) if small else other, _on(keys), "left_anti")


def split_by_keys(df: DataFrame, listed: DataFrame, keys: list[str]):
    """(rows of the listed keys, all other rows); ``listed`` is a bounded table."""
    return with_keys(df, listed, keys), without_keys(df, listed, keys)


def join_per_key(
    df: DataFrame, per_key: DataFrame, keys: list[str], small: bool, how: str = "inner"
) -> DataFrame:
    """Rows of ``df`` with the other columns of ``per_key``, which has one row per key.

    A small ``per_key`` (the caller checked its size) is broadcast. Otherwise
    the hot keys of ``df``, of which there are few, are broadcast and the rest
    is shuffled.
    """
    extra = [c for c in per_key.columns if c not in keys]

    def joined(rows: DataFrame, other: DataFrame, broadcast: bool) -> DataFrame:
        other = _renamed(other, keys, extra)
        found = rows.join(F.broadcast(other) if broadcast else other, _on(keys), how)
        return found.select(*[f"`{c}`" for c in [*df.columns, *extra]])

    if small:
        return joined(df, per_key, True)
    hot, _ = hot_keys(df, keys)
    if hot is None:
        return joined(df, per_key, False)
    hot_rows, cold_rows = split_by_keys(df, hot, keys)
    few = with_keys(per_key, hot, keys)
    return joined(hot_rows, few, True).unionByName(joined(cold_rows, per_key, False))


def _slice_borders(hot_rows: DataFrame, hot: DataFrame, keys, order: str, limit: int):
    """Per hot key the sorted order values at which a new slice begins."""
    spark = hot_rows.sparkSession
    # a deterministic sample decides where to cut; every row is kept
    sample = hot_rows.select(*keys, order).where(
        F.pmod(F.xxhash64(order), F.lit(limit)) < SAMPLES_PER_SLICE
    )
    positions = (
        join_per_key(sample, hot, keys, True)
        .groupBy(*keys)
        .agg(
            F.sort_array(F.collect_set(order)).alias("__values"),
            F.ceil(F.first("__n") / F.lit(limit)).cast("int").alias("__slices"),
        )
        .where("__slices > 1")
    )
    borders = positions.select(
        *keys,
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.col("__slices") - 1),
                lambda i: F.get(
                    "__values",
                    F.floor(i * F.size("__values") / F.col("__slices")).cast("int"),
                ),
            )
        ).alias("__borders"),
    )
    return spark.createDataFrame(borders.collect(), borders.schema)


def add_slices(hot_rows: DataFrame, hot: DataFrame, keys, order: str, limit: int):
    borders = _slice_borders(hot_rows, hot, keys, order, limit)
    longest = borders.select(F.max(F.size("__borders"))).first()[0] or 1
    steps = [2**i for i in reversed(range(int(longest).bit_length()))]
    # binary search: the number of borders that are not above the order value
    position = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, step: F.when(
            F.get("__borders", low + step - 1) <= F.col(order), low + step
        ).otherwise(low),
    )
    joined = join_per_key(hot_rows, borders, keys, True, "left")
    return joined.select(
        *[f"`{c}`" for c in hot_rows.columns],
        F.when(F.col("__borders").isNull(), F.lit(0)).otherwise(position).alias(SLICE),
    )


def latest_so_far(
    rows: DataFrame, keys: list[str], order: list[Column], by: str, values: dict[str, Column]
) -> DataFrame:
    """Add, per entry, its latest value in the key that is not null, up to each row.

    ``order`` sorts the rows of a key, ``by`` is the column the slices follow.
    Values from earlier slices come from a table with one row per slice.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    sliced = SLICE in rows.columns
    if sliced:
        rows = rows.withColumn(KEY, F.struct(*keys))
    parts = [KEY, SLICE] if sliced else keys
    window = Window.partitionBy(*parts).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = rows.select("*", *[v.alias(f"__in_{n}") for n, v in values.items()])
    local = {n: F.last(f"__in_{n}", ignorenulls=True).over(window) for n in values}
    if not sliced:
        return rows.select(*columns, *[c.alias(n) for n, c in local.items()])
    edges = rows.groupBy(KEY, SLICE).agg(
        *[
            F.max_by(f"__in_{n}", F.when(F.col(f"__in_{n}").isNotNull(), F.col(by))).alias(f"__edge_{n}")
            for n in values
        ]
    )
    earlier = Window.partitionBy(KEY).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        KEY,
        SLICE,
        *[
            F.last(f"__edge_{n}", ignorenulls=True).over(earlier).alias(f"__carry_{n}")
            for n in values
        ],
    )
    joined = rows.join(carried, [KEY, SLICE], "left")
    return joined.select(
        *columns, *[F.coalesce(c, F.col(f"__carry_{n}")).alias(n) for n, c in local.items()]
    )
