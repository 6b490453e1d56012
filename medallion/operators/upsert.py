"""Keyed upsert of one DataFrame into another."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .snapshot import check_unique


def upsert(
    target: DataFrame, source: DataFrame, keys: Iterable[str], keep: Iterable[str] = ()
) -> DataFrame:
    """Rows of the target with the source merged in by key.

    Matched rows take the source's values except for the columns to ``keep``;
    source rows without a match are added. A key must be unique in the source.
    """
    keys, keep = list(keys), set(keep)
    columns = target.columns
    check_unique(source, keys, "the source of an upsert")
    incoming = source.select(*columns).withColumn("__in", F.lit(True)).alias("s")
    current = target.withColumn("__out", F.lit(True)).alias("t")
    on = reduce(
        lambda a, b: a & b, [F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in keys]
    )
    joined = current.join(incoming, on, "full_outer")
    matched, added = F.col("s.__in").isNotNull(), F.col("t.__out").isNull()
    return joined.select(
        *[
            F.when(matched & added if c in keep else matched, F.col(f"s.`{c}`"))
            .otherwise(F.col(f"t.`{c}`"))
            .alias(c)
            for c in columns
        ]
    )
