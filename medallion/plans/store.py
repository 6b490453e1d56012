"""Spec tables: write, upsert, and the newest version of each spec."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.upsert import upsert
from ..streaming import tables
from ..streaming.tables import Target
from . import specs

SpecTable = Target

IDENTITY = ("dataFlowGroup", "dataFlowId")


def write_specs(rows: DataFrame, table: SpecTable) -> None:
    tables.overwrite(rows, table)


def merge_specs(rows: DataFrame, table: SpecTable, keep_history: bool = False) -> None:
    """Replace specs of the same group and id, keep all others.

    With ``keep_history`` a new version is added beside the older ones.
    """
    spark = rows.sparkSession
    path = table.location(spark)
    if not tables.is_ours(spark, path):
        write_specs(rows, table)
        return
    current = tables.read(spark, path)
    # columns of later versions are null in older rows
    current = rows.limit(0).unionByName(current, allowMissingColumns=True)
    keys = [*IDENTITY, "version"] if keep_history else list(IDENTITY)
    write_specs(upsert(current, rows, keys, specs.AUDIT_COLUMNS), table)


def version_order(column: str = "version"):
    """Versions by their numbers first: v10 is above v9."""
    numbers = F.transform(
        F.regexp_extract_all(F.col(column), F.lit(r"(\d+)"), F.lit(1)),
        lambda n: n.cast("decimal(38,0)"),
    )
    return F.struct(numbers.alias("numbers"), F.col(column).alias("text"))


def latest_versions(df: DataFrame, identity: Iterable[str] = IDENTITY, version: str = "version"):
    """The newest row of each identity; combined before the shuffle."""
    identity = list(identity)
    newest = df.groupBy(*identity).agg(
        F.max_by(F.struct(*df.columns), version_order(version)).alias("__row")
    )
    return newest.select("__row.*")


def select_specs(df: DataFrame, group: str | None = None, ids=None) -> DataFrame:
    """Specs of a group and/or with given ids, newest version each."""
    if group:
        df = df.where(F.col("dataFlowGroup") == group)
    if ids:
        listed = ids.split(",") if isinstance(ids, str) else ids
        df = df.where(F.col("dataFlowId").isin([str(i).strip().strip("'\"") for i in listed]))
    return latest_versions(df)


def load_specs(
    spark: SparkSession, layer: str, table: SpecTable, group: str | None = None, ids=None
) -> list[specs.Spec]:
    """Spec objects to run; spec tables are metadata and fit on the driver."""
    kind = {"bronze": specs.BronzeSpec, "silver": specs.SilverSpec}[layer]
    rows = select_specs(tables.read(spark, table.location(spark)), group, ids)
    return [kind.from_row(r) for r in rows.orderBy(*IDENTITY).collect()]
