"""Table sources: tables of this package, and any other table Spark can stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..streaming import tables
from .base import Source, SourceRequest, reader, register_source


def table_source(request: SourceRequest) -> Source:
    spark, details = request.spark, request.details
    database = details.get("source_database") or details.get("database")
    table = details.get("source_table") or details.get("table")
    name = f"{database}.{table}" if database else table

    def rows(streaming: bool) -> DataFrame:
        path = details.get("path") or tables.path_of(spark, name)
        if path and tables.is_ours(spark, path):
            return tables.read(spark, path, streaming, request.options)
        source = reader(spark, streaming).options(**request.options)
        if not table:
            if request.schema is not None:
                source = source.schema(request.schema)
            return source.format("parquet").load(path)
        return source.table(name)

    return Source(rows, columnar=True)


for _name in ("delta", "table"):
    register_source(_name, table_source)
