"""Projection, filters, user functions and fan-out."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.expressions import no_rows


def project(df: DataFrame, expressions: Iterable[str] | None) -> DataFrame:
    expressions = [e for e in expressions or [] if e and e.strip()]
    return df.selectExpr(*expressions) if expressions else df


def filter_all(df: DataFrame, predicates: Iterable[str] | None) -> DataFrame:
    for predicate in predicates or []:
        if predicate and predicate.strip():
            df = df.where(predicate)
    return df


def project_and_filter(df, expressions=None, predicates=None) -> DataFrame:
    """The filters see the projected columns; Catalyst pushes them to the scan."""
    return filter_all(project(df, expressions), predicates)


def apply_user_function(df: DataFrame, function: Callable | None, spec) -> DataFrame:
    return df if function is None else df.transform(function, spec)


def output_schema(df: DataFrame, expressions=None, predicates=None):
    """Schema of a projection; only the plan is analysed, nothing runs."""
    return project_and_filter(df, expressions, predicates).schema


def fan_out(df: DataFrame, branches: dict[str, tuple[list[str], list[str]]]):
    """Named branches of one input, each with its own projection and filters."""
    return {
        name: project_and_filter(df, expressions, predicates)
        for name, (expressions, predicates) in branches.items()
    }


def _within(spark: SparkSession, schema: T.StructType, condition: str) -> bool:
    """Does a condition name columns of the schema only?"""
    try:
        return bool(no_rows(spark, schema).where(condition).schema)
    except AnalysisException:
        return False


def fan_out_labelled(df: DataFrame, branches, label: str = "target", own_columns: bool = False) -> DataFrame:
    """All branches as one DataFrame with a label, from a single scan.

    Each row is mapped to the branches that want it, so the input is read once
    however many branches there are. The branches must agree on their columns, or, with
    ``own_columns``, on the types of those they share; the columns that a branch lacks
    are null in its rows.
    """
    shapes = {name: project(df.limit(0), expressions).schema for name, (expressions, _) in branches.items()}
    columns: dict[str, T.DataType] = {}
    for name, schema in shapes.items():
        if columns and not own_columns and schema.names != list(columns):
            raise ValueError(f"branch {name} has other columns than the first one")
        for f in schema.fields:
            if columns.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"branch {name}: column {f.name} has another type than in an earlier branch")
    entries, keep = [], F.lit(False)
    for name, (expressions, predicates) in branches.items():
        own = F.expr(f"struct({', '.join(expressions) if expressions else '*'})")
        row = F.struct(*[
            (own.getField(c) if c in shapes[name].names else F.lit(None)).cast(kind).alias(c)
            for c, kind in columns.items()
        ])
        entries.append(F.struct(F.lit(name).alias(label), row.alias("row")))
        condition = " AND ".join(f"({p})" for p in predicates if p and p.strip()) or "true"
        hidden = (set(columns) - set(shapes[name].names)) & set(df.columns)
        if hidden and not _within(df.sparkSession, shapes[name], condition):
            raise ValueError(f"branch {name}: a filter may mean {sorted(hidden)} of the input or of another branch")
        keep = keep | ((F.col(label) == name) & F.coalesce(F.expr(condition), F.lit(False)))
    rows = df.select(F.explode(F.array(*entries)).alias("b")).select(f"b.{label}", "b.row.*")
    return rows.where(keep)
