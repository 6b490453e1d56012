"""Records of the spec tables, and the objects a pipeline runs on."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field

from pyspark.sql import types as T

from ..operators.cdc import ChangeSpec
from ..operators.snapshot import SnapshotSpec

_MAP = "map<string,string>"
_AUDIT = "version string, createDate timestamp, createdBy string, updateDate timestamp, updatedBy string"
QUARANTINE_TYPE = (
    "struct<database:string,table:string,path:string,"
    "partition_columns:array<string>,cluster_by:array<string>>"
)

# Columns of the spec tables.
BRONZE_COLUMNS = (
    f"dataFlowId string, dataFlowGroup string, sourceFormat string, sourceDetails {_MAP}, "
    f"readerConfigOptions {_MAP}, targetFormat string, targetDetails {_MAP}, "
    f"tableProperties {_MAP}, schema string, partitionColumns array<string>, "
    f"cdcApplyChanges string, applyChangesFromSnapshot string, dataQualityExpectations string, "
    f"quarantineTargetDetails {QUARANTINE_TYPE}, quarantineTableProperties {_MAP}, "
    f"appendFlows string, appendFlowsSchemas {_MAP}, {_AUDIT}, clusterBy array<string>"
)
SILVER_COLUMNS = (
    f"dataFlowId string, dataFlowGroup string, sourceFormat string, sourceDetails {_MAP}, "
    f"readerConfigOptions {_MAP}, targetFormat string, targetDetails {_MAP}, "
    f"tableProperties {_MAP}, selectExp array<string>, whereClause array<string>, "
    f"partitionColumns array<string>, cdcApplyChanges string, dataQualityExpectations string, "
    f"appendFlows string, appendFlowsSchemas {_MAP}, {_AUDIT}, clusterBy array<string>"
)
AUDIT_COLUMNS = ("createDate", "createdBy")

FLOW_TYPE = (
    f"array<struct<name:string,comment:string,create_streaming_table:string,"
    f"source_format:string,source_details:{_MAP},reader_options:{_MAP},"
    f"spark_conf:{_MAP},once:string>>"
)
CHANGES_TYPE = (
    "struct<keys:array<string>,sequence_by:string,where:string,ignore_null_updates:string,"
    "apply_as_deletes:string,apply_as_truncates:string,column_list:array<string>,"
    "except_column_list:array<string>,scd_type:string,track_history_column_list:array<string>,"
    "track_history_except_column_list:array<string>,flow_name:string,once:string,"
    "ignore_null_updates_column_list:array<string>,"
    "ignore_null_updates_except_column_list:array<string>>"
)
SNAPSHOT_TYPE = (
    "struct<keys:array<string>,scd_type:string,track_history_column_list:array<string>,"
    "track_history_except_column_list:array<string>>"
)


def table_schema(layer: str) -> T.StructType:
    return T.StructType.fromDDL(BRONZE_COLUMNS if layer == "bronze" else SILVER_COLUMNS)


def _flag(value) -> bool:
    return str(value).lower() == "true"


def _from_json(kind, text: str | None):
    if not text:
        return None
    record = json.loads(text)
    names = {f.name for f in dataclasses.fields(kind)}
    unknown = set(record) - names
    if unknown:
        raise ValueError(f"unknown attributes {sorted(unknown)} of {kind.__name__}")
    for flag in ("ignore_null_updates", "once"):
        if flag in record:
            record[flag] = _flag(record[flag])
    missing = [
        f.name
        for f in dataclasses.fields(kind)
        if f.name in ("keys", "sequence_by", "scd_type") and not record.get(f.name)
    ]
    if missing:
        raise ValueError(f"missing attributes {missing} of {kind.__name__}")
    return kind(**{k: v for k, v in record.items() if v is not None})


@dataclass
class AppendFlow:
    """One more source of a target."""

    name: str
    source_format: str
    source_details: dict[str, str]
    create_streaming_table: bool = False
    comment: str | None = None
    reader_options: dict[str, str] = field(default_factory=dict)
    spark_conf: dict[str, str] = field(default_factory=dict)
    once: bool = False

    @classmethod
    def parse(cls, text: str | None) -> list["AppendFlow"]:
        flows = []
        for record in json.loads(text) if text else []:
            record = {k: v for k, v in record.items() if v is not None}
            missing = {"name", "source_format", "source_details", "create_streaming_table"} - set(record)
            if missing:
                raise ValueError(f"missing attributes {sorted(missing)} of an append flow")
            for flag in ("create_streaming_table", "once"):
                record[flag] = _flag(record.get(flag))
            flows.append(cls(**record))
        return flows


@dataclass
class Spec:
    """One row of a spec table."""

    dataFlowId: str
    dataFlowGroup: str
    sourceFormat: str
    sourceDetails: dict
    readerConfigOptions: dict
    targetFormat: str
    targetDetails: dict
    tableProperties: dict
    partitionColumns: list
    cdcApplyChanges: str | None
    dataQualityExpectations: str | None
    appendFlows: str | None
    appendFlowsSchemas: dict
    version: str
    createDate: object
    createdBy: str
    updateDate: object
    updatedBy: str
    clusterBy: list

    @property
    def table(self) -> str:
        database, table = self.targetDetails.get("database"), self.targetDetails["table"]
        return f"{database}.{table}" if database else table

    @property
    def changes(self) -> ChangeSpec | None:
        return _from_json(ChangeSpec, self.cdcApplyChanges)

    @property
    def flows(self) -> list[AppendFlow]:
        return AppendFlow.parse(self.appendFlows)

    def flow_schema(self, name: str) -> T.StructType | None:
        text = (self.appendFlowsSchemas or {}).get(name)
        return T.StructType.fromJson(json.loads(text)) if text else None

    @classmethod
    def from_row(cls, row):
        """Columns that an older spec table lacks are null."""
        values = row.asDict(recursive=True)
        return cls(**{f.name: values.get(f.name) for f in dataclasses.fields(cls)})


@dataclass
class BronzeSpec(Spec):
    schema: str | None = None
    applyChangesFromSnapshot: str | None = None
    quarantineTargetDetails: dict | None = None
    quarantineTableProperties: dict | None = None

    @property
    def struct(self) -> T.StructType | None:
        return T.StructType.fromJson(json.loads(self.schema)) if self.schema else None

    @property
    def snapshots(self) -> SnapshotSpec | None:
        return _from_json(SnapshotSpec, self.applyChangesFromSnapshot)


@dataclass
class SilverSpec(Spec):
    selectExp: list | None = None
    whereClause: list | None = None
