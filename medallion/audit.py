"""Row-count reconciliation and synthetic feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

COUNTS = "table_name string, rows long"


def count_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count; all tables in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def file_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Parquet tables for ``count_rows``, which takes their counts from the file footers.

    Only Spark's newer reader hands an aggregation down to the files, so they are opened
    in a session that uses it.
    """
    session = spark.newSession()
    older = [f for f in session.conf.get("spark.sql.sources.useV1SourceList").split(",") if f.strip() != "parquet"]
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(older))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return {name: session.read.parquet(path) for name, path in paths.items()}


def reconcile(frames: dict[str, DataFrame], expected: DataFrame, at_least: bool = False) -> DataFrame:
    """Counts beside the expected ones, with the outcome of each table.

    ``expected`` has ``table_name`` and ``expected_rows``. A table that is
    missing on either side fails.
    """
    counts = count_rows(frames)
    joined = counts.join(expected, "table_name", "full_outer")
    agrees = (F.col("rows") >= F.col("expected_rows")) if at_least else (
        F.col("rows") == F.col("expected_rows")
    )
    return joined.select(
        "table_name",
        "expected_rows",
        "rows",
        F.when(F.coalesce(agrees, F.lit(False)), F.lit("passed")).otherwise(F.lit("failed")).alias("result"),
    )


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def synthetic_value(row: Column, column: int, bound: int) -> Column:
    """A value in [0, bound) that depends on row and column only."""
    # both factors are reduced first, so that no product leaves the range of a long
    factor, shift = 1103515245 % bound, (12345 + 7919 * column) % bound
    return F.pmod(F.pmod(row, F.lit(bound)) * F.lit(factor).cast("long") + F.lit(shift).cast("long"), F.lit(bound))


def synthetic_rows(ids: DataFrame, row: str, columns: int, bound: int = 1000) -> DataFrame:
    """A feed with one row per id and ``columns`` value columns."""
    row_id = F.col(row).cast("long")
    return ids.select(
        row_id.alias("id"),
        *[synthetic_value(row_id, i, bound).alias(f"col_{i}") for i in range(1, columns + 1)],
    )


def synthetic_feeds(
    spark: SparkSession, path: str, feeds: int, columns: int, rows: int, fmt: str = "csv"
) -> list[str]:
    """Write feeds for a load test: one folder each, from a single job."""
    generated = spark.range(rows).select(
        "id", F.explode(F.sequence(F.lit(1), F.lit(feeds))).alias("feed")
    )
    row_id = F.col("id") * F.lit(feeds) + F.col("feed")
    feed_rows = generated.select(
        "feed",
        "id",
        *[synthetic_value(row_id, i, 1000).alias(f"col_{i}") for i in range(1, columns + 1)],
    )
    feed_rows.write.mode("overwrite").partitionBy("feed").option("header", True).format(fmt).save(path)
    return [f"{path}/feed={i}" for i in range(1, feeds + 1)]


def feed_records(paths: list[str], database: str, env: str, fmt: str = "csv") -> list[dict]:
    """Onboarding records for synthetic feeds."""
    return [
        {
            "data_flow_id": str(i),
            "data_flow_group": "synthetic",
            "source_format": "cloudFiles",
            "source_details": {f"source_path_{env}": path},
            f"bronze_database_{env}": database,
            "bronze_table": f"feed_{i}",
            "bronze_reader_options": {"cloudFiles.format": fmt, "header": "true"},
        }
        for i, path in enumerate(paths, 1)
    ]


def records_as_json(records: DataFrame) -> DataFrame:
    """All spec records as one JSON array; for spec tables, which are small."""
    return records.agg(F.to_json(F.sort_array(F.collect_list(F.struct("*")))).alias("records"))
