"""Onboarding: JSON records become checked rows of the spec tables.

Records are read with an explicit schema, so an absent key is a null. Nested
objects arrive as JSON text and are parsed by column expressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import storage
from ..functions.expressions import text_list, without_null_values
from ..sources import known_formats
from . import specs, store

_MAP = "map<string,string>"
Z_ORDER = "pipelines.autoOptimize.zOrderCols"
PROJECTION_COLUMNS = (
    "target_table string, select_exp array<string>, where_clause array<string>, "
    "target_partition_cols array<string>"
)

# Keys of an onboarding record; "{env}" stands for the environment.
RECORD_KEYS = {
    "string": (
        "data_flow_id", "data_flow_group", "source_system", "source_format",
        "bronze_database_{env}", "bronze_database", "bronze_table",
        "bronze_table_path_{env}", "bronze_table_path",
        "bronze_partition_columns", "bronze_table_partitions", "bronze_cluster_by",
        "bronze_cdc_apply_changes", "bronze_apply_changes_from_snapshot", "bronze_append_flows",
        "bronze_data_quality_expectations_json_{env}", "bronze_data_quality_expectations_json",
        "bronze_database_quarantine_{env}", "bronze_database_quarantine",
        "bronze_quarantine_table", "bronze_quarantine_table_path_{env}",
        "bronze_quarantine_table_path", "bronze_quarantine_table_partitions",
        "bronze_quarantine_table_cluster_by",
        "silver_database_{env}", "silver_database", "silver_table",
        "silver_table_path_{env}", "silver_table_path",
        "silver_partition_columns", "silver_cluster_by",
        "silver_cdc_apply_changes", "silver_append_flows",
        "silver_transformation_json_{env}", "silver_transformation_json",
        "silver_data_quality_expectations_json_{env}", "silver_data_quality_expectations_json",
    ),
    _MAP: (
        "source_details", "bronze_reader_options", "bronze_table_properties",
        "bronze_quarantine_table_properties", "silver_table_properties",
    ),
}
MANDATORY = {
    "bronze": ("data_flow_id", "data_flow_group", "source_details", "bronze_database",
               "bronze_table", "bronze_reader_options", "source_format"),
    "silver": ("data_flow_id", "data_flow_group", "silver_database", "silver_table",
               "silver_transformation_json"),
}
ENVIRONMENT_KEYS = (
    "bronze_database", "bronze_table_path", "bronze_data_quality_expectations_json",
    "bronze_database_quarantine", "bronze_quarantine_table_path",
    "silver_database", "silver_table_path", "silver_transformation_json",
    "silver_data_quality_expectations_json",
)


class OnboardingError(ValueError):
    """Records that cannot become specs; ``problems`` lists (id, problem)."""

    def __init__(self, problems: list[tuple[str, str]]):
        self.problems = problems
        super().__init__("; ".join(f"{i}: {p}" for i, p in problems))


# ---- records ----------------------------------------------------------------


def read_records(spark: SparkSession, path: str, env: str) -> DataFrame:
    """Records with the values of one environment under plain names."""
    if not path.lower().endswith(".json"):
        raise ValueError(f"onboarding file {path} is not a JSON file")
    schema = ", ".join(
        f"`{key.format(env=env)}` {kind}" for kind, keys in RECORD_KEYS.items() for key in keys
    )
    records = spark.read.schema(schema).option("multiLine", True).json(path)
    chosen = {
        key: F.coalesce(F.col(f"{key}_{env}"), F.col(key)) for key in ENVIRONMENT_KEYS
    }
    return records.withColumns(chosen).drop(*[f"{key}_{env}" for key in ENVIRONMENT_KEYS])


def violations(
    records: DataFrame, layer: str, env: str, with_catalog: bool = True, formats=None
) -> DataFrame:
    """All problems of all records as (data_flow_id, problem)."""
    checks: list[Column] = []

    def check(bad: Column, problem: str) -> None:
        checks.append(F.when(bad, F.lit(problem)))

    def blank(key: str) -> Column:
        column = F.col(key)
        if isinstance(records.schema[key].dataType, T.MapType):
            return column.isNull() | (F.size(column) == 0)
        return column.isNull() | (F.trim(column) == "")

    for key in MANDATORY[layer]:
        check(blank(key), f"{key} is missing")
    if not with_catalog:
        check(blank(f"{layer}_table_path"), f"{layer}_table_path is missing")
    if layer == "bronze":
        known = [f.lower() for f in formats or known_formats()] + ["snapshot"]
        check(
            ~blank("source_format") & ~F.lower("source_format").isin(known),
            f"source_format is not one of {sorted(known)}",
        )
        check(
            (F.lower("source_format") == "snapshot")
            & F.get(F.map_values(F.map_filter("source_details", lambda k, _: k == "snapshot_format")), F.lit(0)).isNull(),
            "snapshot_format is missing in source_details",
        )
        snapshot = F.from_json("bronze_apply_changes_from_snapshot", specs.SNAPSHOT_TYPE)
        given = ~blank("bronze_apply_changes_from_snapshot")
        for key in ("keys", "scd_type"):
            check(
                given & snapshot[key].isNull(),
                f"{key} is missing in bronze_apply_changes_from_snapshot",
            )
    changes = F.from_json(f"{layer}_cdc_apply_changes", specs.CHANGES_TYPE)
    given = ~blank(f"{layer}_cdc_apply_changes")
    for key in ("keys", "sequence_by", "scd_type"):
        check(given & changes[key].isNull(), f"{key} is missing in {layer}_cdc_apply_changes")
    check(
        given & changes["column_list"].isNotNull() & changes["except_column_list"].isNotNull(),
        f"column_list and except_column_list exclude each other in {layer}_cdc_apply_changes",
    )
    check(
        given & changes["apply_as_truncates"].isNotNull() & (changes["scd_type"] == "2"),
        f"apply_as_truncates needs scd_type 1 in {layer}_cdc_apply_changes",
    )
    flows = F.from_json(f"{layer}_append_flows", specs.FLOW_TYPE)
    for key in ("name", "source_format", "source_details", "create_streaming_table"):
        check(
            F.exists(flows, lambda f: f[key].isNull()),
            f"{key} is missing in {layer}_append_flows",
        )
    tables = [layer] + (["bronze_quarantine"] if layer == "bronze" else [])
    for table in tables:
        prefix = layer if table == layer else "bronze_quarantine_table"
        properties = f"{layer}_table_properties" if table == layer else "bronze_quarantine_table_properties"
        check(
            text_list(F.col(f"{prefix}_cluster_by")).isNotNull()
            & F.coalesce(F.map_contains_key(properties, F.lit(Z_ORDER)), F.lit(False)),
            f"{prefix}_cluster_by and {Z_ORDER} exclude each other",
        )
    found = records.select(
        "data_flow_id",
        F.explode(F.filter(F.array(*checks), lambda p: p.isNotNull())).alias("problem"),
    )
    return found.unionByName(duplicate_ids(records))


def duplicate_ids(records: DataFrame) -> DataFrame:
    """Ids that occur more than once, as problems."""
    counts = records.groupBy("data_flow_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counts.select("data_flow_id", F.lit("data_flow_id occurs more than once").alias("problem"))


def check_records(records: DataFrame, layer: str, env: str, with_catalog: bool = True) -> None:
    # spec records are metadata, their problems fit on the driver
    found = violations(records, layer, env, with_catalog)
    if layer == "silver":
        paths = _distinct(records, F.col("silver_transformation_json"))
        found = found.unionByName(without_projection(records, read_projections(records.sparkSession, paths)))
    found = found.distinct().collect()
    if found:
        raise OnboardingError(sorted((r.data_flow_id, r.problem) for r in found))


def without_projection(records: DataFrame, projections: DataFrame) -> DataFrame:
    """Silver records whose table no projection names, as problems."""
    named = projections.select(F.col("target_table").alias("silver_table")).distinct()
    return records.join(named, "silver_table", "left_anti").where("silver_table IS NOT NULL").select(
        "data_flow_id", F.lit("silver_table has no projection in silver_transformation_json").alias("problem")
    )


# ---- linked files -----------------------------------------------------------


def _texts(paths: list[str], read: Callable[[str], str | None]) -> Column:
    """A map from path to content as one literal; linked files are small."""
    found = {p: read(p) for p in sorted({p for p in paths if p})}
    found = {p: t for p, t in found.items() if t is not None}
    return F.from_json(F.lit(json.dumps(found)), _MAP)


def schema_from_ddl(path: str, spark: SparkSession) -> str:
    """Schema JSON of a DDL file; both ``a int`` and ``a: int`` are accepted."""
    return T.StructType.fromDDL(storage.read_text(spark, path).strip()).json()


def _distinct(df: DataFrame, column: Column) -> list[str]:
    return [r[0] for r in df.select(column.alias("p")).where("p IS NOT NULL").distinct().collect()]


def read_projections(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Silver projections of several files; one scan over the distinct paths."""
    return (
        spark.read.schema(PROJECTION_COLUMNS).option("multiLine", True).json(sorted(set(paths)))
    )


# ---- rows of the spec tables --------------------------------------------------


def _map_of(pairs: dict[str, Column]) -> Column:
    return without_null_values(F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)]))


def _properties(key: str) -> Column:
    return F.coalesce(without_null_values(F.col(key)), F.create_map().cast(_MAP))


def _details(source: Column, env: str) -> Column:
    """Source details with the path of the environment as ``path``."""
    path = F.coalesce(source[f"source_path_{env}"], source["source_path"], source["path"])
    kept = F.map_filter(
        source,
        lambda k, v: v.isNotNull() & ~k.startswith("source_path") & (k != "source_schema_path") & (k != "path"),
    )
    return F.map_concat(kept, without_null_values(F.create_map(F.lit("path"), path)))


def _without_nulls(text: Column) -> Column:
    """A JSON object without its null attributes."""
    parsed = F.from_json(text, "map<string,variant>")
    return F.when(
        text.isNotNull() & (F.trim(text) != ""),
        F.to_json(F.map_filter(parsed, lambda _, v: v.isNotNull() & ~F.is_variant_null(v))),
    )


def _flow_columns(records: DataFrame, layer: str, env: str, schemas: Column) -> dict[str, Column]:
    flows = F.from_json(f"{layer}_append_flows", specs.FLOW_TYPE)
    resolved = F.transform(
        flows,
        lambda f: f.withField("source_details", _details(f["source_details"], env)),
    )
    with_schema = F.filter(flows, lambda f: schemas[f["source_details"]["source_schema_path"]].isNotNull())
    return {
        "appendFlows": F.when(F.size(flows) > 0, F.to_json(resolved)),
        "appendFlowsSchemas": F.coalesce(
            F.map_from_arrays(
                F.transform(with_schema, lambda f: f["name"]),
                F.transform(with_schema, lambda f: schemas[f["source_details"]["source_schema_path"]]),
            ),
            F.create_map().cast(_MAP),
        ),
    }


def _flow_schema_paths(records: DataFrame, layer: str) -> list[str]:
    flows = records.select(F.explode(F.from_json(f"{layer}_append_flows", specs.FLOW_TYPE)).alias("f"))
    return _distinct(flows, F.col("f.source_details")["source_schema_path"])


def _audited(df: DataFrame, layer: str, version: str, author: str) -> DataFrame:
    df = df.withColumns(
        {
            "version": F.lit(version),
            "createDate": F.current_timestamp(),
            "createdBy": F.lit(author),
            "updateDate": F.current_timestamp(),
            "updatedBy": F.lit(author),
        }
    )
    schema = specs.table_schema(layer)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def bronze_rows(
    records: DataFrame,
    env: str,
    version: str,
    author: str,
    schema_mapper: Callable[[str, SparkSession], str] | None = None,
) -> DataFrame:
    spark = records.sparkSession
    mapper = schema_mapper or schema_from_ddl
    source = F.col("source_details")
    paths = _distinct(records, source["source_schema_path"]) + _flow_schema_paths(records, "bronze")
    schemas = _texts(paths, lambda p: mapper(p, spark))
    rules = _texts(
        _distinct(records, F.col("bronze_data_quality_expectations_json")),
        lambda p: storage.read_text(spark, p) if p.endswith(".json") else None,
    )
    quality = rules[F.col("bronze_data_quality_expectations_json")]
    quarantined = quality.isNotNull() & F.col("bronze_quarantine_table").isNotNull()
    rows = records.select(
        F.col("data_flow_id").alias("dataFlowId"),
        F.col("data_flow_group").alias("dataFlowGroup"),
        F.col("source_format").alias("sourceFormat"),
        _details(source, env).alias("sourceDetails"),
        _properties("bronze_reader_options").alias("readerConfigOptions"),
        F.lit("parquet").alias("targetFormat"),
        _map_of(
            {
                "database": F.col("bronze_database"),
                "table": F.col("bronze_table"),
                "path": F.col("bronze_table_path"),
            }
        ).alias("targetDetails"),
        _properties("bronze_table_properties").alias("tableProperties"),
        schemas[source["source_schema_path"]].alias("schema"),
        text_list(F.coalesce("bronze_partition_columns", "bronze_table_partitions")).alias("partitionColumns"),
        _without_nulls(F.col("bronze_cdc_apply_changes")).alias("cdcApplyChanges"),
        _without_nulls(F.col("bronze_apply_changes_from_snapshot")).alias("applyChangesFromSnapshot"),
        quality.alias("dataQualityExpectations"),
        F.when(
            quarantined,
            F.struct(
                F.coalesce("bronze_database_quarantine", "bronze_database").alias("database"),
                F.col("bronze_quarantine_table").alias("table"),
                F.col("bronze_quarantine_table_path").alias("path"),
                text_list(F.col("bronze_quarantine_table_partitions")).alias("partition_columns"),
                text_list(F.col("bronze_quarantine_table_cluster_by")).alias("cluster_by"),
            ),
        ).alias("quarantineTargetDetails"),
        F.when(quarantined, _properties("bronze_quarantine_table_properties")).alias(
            "quarantineTableProperties"
        ),
        text_list(F.col("bronze_cluster_by")).alias("clusterBy"),
        *[c.alias(n) for n, c in _flow_columns(records, "bronze", env, schemas).items()],
    )
    return _audited(rows, "bronze", version, author)


def silver_rows(
    records: DataFrame, env: str, version: str, author: str, projections: DataFrame | None = None
) -> DataFrame:
    spark = records.sparkSession
    schemas = _texts(_flow_schema_paths(records, "silver"), lambda p: schema_from_ddl(p, spark))
    rules = _texts(
        _distinct(records, F.col("silver_data_quality_expectations_json")),
        lambda p: storage.read_text(spark, p) if p.endswith(".json") else None,
    )
    if projections is None:
        projections = read_projections(spark, _distinct(records, F.col("silver_transformation_json")))
    rows = records.select(
        F.col("data_flow_id").alias("dataFlowId"),
        F.col("data_flow_group").alias("dataFlowGroup"),
        F.lit("table").alias("sourceFormat"),
        _map_of(
            {
                "database": F.col("bronze_database"),
                "table": F.col("bronze_table"),
                "path": F.col("bronze_table_path"),
            }
        ).alias("sourceDetails"),
        F.create_map().cast(_MAP).alias("readerConfigOptions"),
        F.lit("parquet").alias("targetFormat"),
        _map_of(
            {
                "database": F.col("silver_database"),
                "table": F.col("silver_table"),
                "path": F.col("silver_table_path"),
            }
        ).alias("targetDetails"),
        _properties("silver_table_properties").alias("tableProperties"),
        text_list(F.col("silver_partition_columns")).alias("partitionColumns"),
        _without_nulls(F.col("silver_cdc_apply_changes")).alias("cdcApplyChanges"),
        rules[F.col("silver_data_quality_expectations_json")].alias("dataQualityExpectations"),
        text_list(F.col("silver_cluster_by")).alias("clusterBy"),
        *[c.alias(n) for n, c in _flow_columns(records, "silver", env, schemas).items()],
    )
    return _audited(join_projections(rows, projections), "silver", version, author)


def join_projections(rows: DataFrame, projections: DataFrame) -> DataFrame:
    """Each spec with the projection of its target table; others drop out."""
    named = projections.select(
        "target_table",
        F.col("select_exp").alias("selectExp"),
        F.col("where_clause").alias("whereClause"),
    )
    return rows.join(named, rows.targetDetails["table"] == named.target_table, "inner").drop("target_table")


# ---- the jobs -----------------------------------------------------------------


def onboard(
    spark: SparkSession,
    path: str,
    env: str,
    version: str,
    author: str,
    layers: dict[str, store.SpecTable],
    overwrite: bool = True,
    with_catalog: bool = True,
    schema_mapper: Callable[[str, SparkSession], str] | None = None,
    keep_history: bool = False,
) -> None:
    """Write the records of a file to the spec table of each layer.

    ``layers`` maps "bronze" and/or "silver" to its spec table. All checks run
    before the first write.
    """
    unknown = set(layers) - {"bronze", "silver"}
    if unknown or not layers:
        raise ValueError(f"layers are bronze and silver, not {sorted(unknown)}")
    # read once: records are metadata and used by several small jobs
    records = read_records(spark, path, env).persist()
    try:
        for layer in layers:
            check_records(records, layer, env, with_catalog)
        for layer, table in layers.items():
            if layer == "bronze":
                rows = bronze_rows(records, env, version, author, schema_mapper)
            else:
                rows = silver_rows(records, env, version, author)
            if overwrite:
                store.write_specs(rows, table)
            else:
                store.merge_specs(rows, table, keep_history)
    finally:
        records.unpersist()
