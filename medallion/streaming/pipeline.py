"""Run the specs of a layer: build the flows of each spec and run them."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .. import storage
from ..functions.rules import Rules
from ..operators.transform import apply_user_function, fan_out_labelled, project_and_filter
from ..plans import store
from ..plans.specs import AppendFlow, BronzeSpec, SilverSpec, Spec
from ..sources import Source, SourceRequest, open_source
from ..sources.snapshots import NextSnapshot, new_snapshots, numbered_files
from . import tables
from .flows import (
    Branch, Flow, FlowFailed, fan_groups, flow_session, run_fan_out, run_flow, run_flows, run_on_version,
    scheduler_pool, write_snapshot,
)
from .tables import Target

UserFunction = Callable[[DataFrame, Spec], DataFrame]


@dataclass
class Pipeline:
    """What a run needs besides the specs."""

    spark: SparkSession
    checkpoints: str
    bronze_transform: UserFunction | None = None
    silver_transform: UserFunction | None = None
    next_snapshot: NextSnapshot | None = None
    secrets: Callable[[str, str], str] | None = None
    at_once: int = 8
    # extra options for every table source, such as maxFilesPerTrigger
    table_options: dict[str, str] = field(default_factory=dict)
    # silver tables of appended rows over one bronze table share a scan of it
    fan_out: bool = False

    # ---- targets ----

    def target(self, spec: Spec) -> Target:
        layer = "bronze" if isinstance(spec, BronzeSpec) else "silver"
        return Target(
            name=spec.table,
            path=spec.targetDetails.get("path"),
            partition_by=spec.partitionColumns or [],
            cluster_by=spec.clusterBy or [],
            properties=spec.tableProperties or {},
            comment=f"{layer} table {spec.targetDetails['table']}",
        )

    def quarantine(self, spec: Spec) -> Target | None:
        details = getattr(spec, "quarantineTargetDetails", None)
        if not details or not details.get("table"):
            return None
        return Target(
            name=f"{details['database']}.{details['table']}",
            path=details.get("path"),
            partition_by=details.get("partition_columns") or [],
            cluster_by=details.get("cluster_by") or [],
            properties=spec.quarantineTableProperties or {},
            comment=f"quarantined rows of {spec.table}",
        )

    def checkpoint(self, target: Target, flow: str) -> str:
        name = (target.name or target.path).replace("/", "_")
        return storage.join(self.checkpoints, name, flow)

    # ---- flows ----

    def flows(self, spec: Spec) -> list[Flow]:
        """The main flow of a spec and its append flows."""
        target, rules = self.target(spec), Rules.parse(spec.dataQualityExpectations)
        changes, quarantine = spec.changes, self.quarantine(spec)
        name = (changes.flow_name if changes else None) or "main"
        checkpoint = self.checkpoint(target, name)
        silver = isinstance(spec, SilverSpec)
        request = SourceRequest(
            self.spark,
            spec.sourceFormat,
            dict(spec.sourceDetails or {}),
            {**(self.table_options if silver else {}), **(spec.readerConfigOptions or {})},
            None if silver else spec.struct,
            checkpoint,
            self.secrets,
        )
        main = Flow(
            name,
            open_source(request),
            target,
            checkpoint,
            rules,
            self._shape_silver(spec) if silver else self._shape_bronze(spec),
            changes,
            quarantine,
            bool(changes and changes.once),
        )
        return [main, *[self._append_flow(spec, f, main) for f in spec.flows]]

    def _shape_bronze(self, spec: BronzeSpec):
        return lambda df: apply_user_function(df, self.bronze_transform, spec)

    def _shape_silver(self, spec: SilverSpec):
        return lambda df: apply_user_function(
            project_and_filter(df, spec.selectExp, spec.whereClause), self.silver_transform, spec
        )

    def _append_flow(self, spec: Spec, flow: AppendFlow, main: Flow) -> Flow:
        checkpoint = self.checkpoint(main.target, flow.name)
        request = SourceRequest(
            flow_session(self.spark, flow.spark_conf),
            flow.source_format,
            flow.source_details,
            flow.reader_options,
            spec.flow_schema(flow.name),
            checkpoint,
            self.secrets,
        )
        # a flow that declares its own target brings no rules with it
        rules = Rules() if flow.create_streaming_table else main.rules
        return Flow(
            flow.name,
            open_source(request),
            main.target,
            checkpoint,
            rules,
            changes=main.changes,
            quarantine=None if flow.create_streaming_table else main.quarantine,
            once=flow.once,
        )

    # ---- snapshots ----

    def run_snapshots(self, spec: BronzeSpec) -> None:
        """Apply every snapshot after the last one, in order."""
        snapshots, target = spec.snapshots, self.target(spec)
        if snapshots is None:
            raise ValueError(f"{spec.dataFlowId}: a snapshot source needs apply_changes_from_snapshot")
        following = self.next_snapshot
        if following is None:
            path = (spec.sourceDetails or {}).get("path")
            if not path:
                raise ValueError(f"{spec.dataFlowId}: a snapshot source needs a path or a function")
            following = numbered_files(
                self.spark, path, spec.sourceDetails["snapshot_format"],
                spec.readerConfigOptions, spec.struct,
            )
        rules = Rules.parse(spec.dataQualityExpectations)
        latest = tables.last_snapshot(self.spark, target)
        for snapshot, version in new_snapshots(following, latest, spec):
            rows = apply_user_function(snapshot, self.bronze_transform, spec)
            write_snapshot(rows, version, target, snapshots, rules, self.quarantine(spec))

    # ---- sources that are rewritten ----

    def rewritten_source(self, spec: Spec) -> str | None:
        """Path of a silver spec's bronze table if changes or snapshots rewrite it."""
        if not isinstance(spec, SilverSpec):
            return None
        details = spec.sourceDetails or {}
        database, table = details.get("database"), details.get("table")
        path = details.get("path")
        if path is None and table:
            path = tables.path_of(self.spark, f"{database}.{table}" if database else table)
        described = tables.describe(self.spark, path) if path else None
        return path if described and described["kind"] != "append" else None

    def run_versions(self, spec: SilverSpec, source: str) -> None:
        """A silver spec over the current version of its bronze table."""
        main, *more = self.flows(spec)
        if more and main.changes is None:
            raise ValueError(
                f"{spec.table}: append flows need a bronze table of appended rows, or changes"
            )
        main.keeps_keys = self._keeps_keys(spec, source)
        run_on_version(self.spark, main, source)
        for flow in more:
            run_flow(self.spark, flow)

    def _keeps_keys(self, spec: SilverSpec, source: str) -> bool:
        """Are the keys of a silver table those of its bronze table, taken over as they are?"""
        keys = set((tables.describe(self.spark, source) or {}).get("keys") or [])
        named = {e.strip().strip("`") for e in spec.selectExp or []}
        return bool(
            spec.changes and keys == set(spec.changes.keys) and self.silver_transform is None
            and (not named or "*" in named or keys <= named)
        )

    # ---- fan-out ----

    def _fans_out(self, spec: Spec) -> bool:
        """Silver specs whose flow is nothing but a projection and a filter of a table, not begun on its own."""
        if not isinstance(spec, SilverSpec) or self.silver_transform or spec.changes or spec.flows:
            return False
        if spec.partitionColumns or spec.clusterBy or Rules.parse(spec.dataQualityExpectations) != Rules():
            return False
        return not storage.exists(self.spark, self.checkpoint(self.target(spec), "main"))

    def fan_outs(self, specs: list[Spec]) -> list[tuple[str, Source, list[Branch], str]]:
        """What ``run_fan_out`` takes, for the silver specs that share a bronze table."""
        sources: dict[str, list[SilverSpec]] = {}
        for spec in specs:
            if self._fans_out(spec):
                details = json.dumps([spec.sourceFormat, spec.sourceDetails, spec.readerConfigOptions], sort_keys=True)
                sources.setdefault(details, []).append(spec)
        found = []
        for group in sources.values():
            flows = {spec.table: self.flows(spec)[0] for spec in group}
            by_name = {spec.table: spec for spec in group}
            table = (group[0].sourceDetails or {}).get("table") or group[0].sourceDetails.get("path")
            folder = storage.join(self.checkpoints, "fan_out", str(table).replace("/", "_"))
            known = storage.exists(self.spark, folder)
            if not known and (len(group) == 1 or not self._agree(flows, group)):
                continue
            for number, names in enumerate(fan_groups(self.spark, folder, sorted(flows))):
                branches = [
                    Branch(flows[n], by_name[n].selectExp or [], by_name[n].whereClause or []) for n in names
                ]
                if branches:
                    found.append((f"fan-out {number} of {table}", branches[0].flow.source, branches, storage.join(folder, str(number))))
        return found

    def _agree(self, flows: dict[str, Flow], group: list[SilverSpec]) -> bool:
        """Can one projection make the rows of all of these specs?"""
        rows = next(iter(flows.values())).source.open(False).limit(0)
        branches = {s.table: (s.selectExp or [], s.whereClause or []) for s in group}
        try:
            return fan_out_labelled(rows, branches, own_columns=True).schema is not None
        except (AnalysisException, ValueError):
            return False

    # ---- running ----

    def run(self, specs: list[Spec]) -> None:
        """Process what is new for all specs, then stop."""
        _check_targets(specs)
        snapshots = [
            s for s in specs if isinstance(s, BronzeSpec) and s.sourceFormat.lower() == "snapshot"
        ]
        flows, versions, failures = [], [], {}
        together = self.fan_outs([s for s in specs if not self.rewritten_source(s)]) if self.fan_out else []
        fanned = {b.flow.target.name or b.flow.target.path for _, _, branches, _ in together for b in branches}
        for spec in specs:
            if spec in snapshots or spec.table in fanned:
                continue
            try:
                source = self.rewritten_source(spec)
                if source:
                    versions.append((spec, source))
                else:
                    flows += self.flows(spec)
            except Exception as error:
                failures[spec.table] = error

        def one(spec: Spec, source: str | None) -> None:
            try:
                if source:
                    self.run_versions(spec, source)
                else:
                    with scheduler_pool(self.spark, spec.table):
                        self.run_snapshots(spec)
            except Exception as error:
                failures[spec.table] = error

        with ThreadPoolExecutor(max(1, self.at_once)) as pool:
            list(pool.map(lambda given: one(*given), [*[(s, None) for s in snapshots], *versions]))
        def fan(name: str, source: Source, branches: list[Branch], checkpoint: str) -> None:
            try:
                run_fan_out(self.spark, name, source, branches, checkpoint)
            except Exception as error:
                failures[name] = error

        with ThreadPoolExecutor(max(1, self.at_once)) as pool:
            list(pool.map(lambda given: fan(*given), together))
        try:
            run_flows(self.spark, flows, self.at_once)
        except FlowFailed as error:
            failures.update(error.failures)
        if failures:
            raise FlowFailed(failures)


def _check_targets(specs: list[Spec]) -> None:
    names = [s.table for s in specs]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several specs write to {twice}")


def run(
    pipeline: Pipeline,
    layer: str,
    bronze: store.SpecTable | None = None,
    silver: store.SpecTable | None = None,
    group: str | None = None,
    ids=None,
) -> None:
    """Run "bronze", "silver", or both in this order with "bronze_silver"."""
    wanted = {"bronze": ["bronze"], "silver": ["silver"], "bronze_silver": ["bronze", "silver"]}
    if layer.lower() not in wanted:
        raise ValueError(f"layer {layer!r} is not one of {sorted(wanted)}")
    spec_tables = {"bronze": bronze, "silver": silver}
    for name in wanted[layer.lower()]:
        table = spec_tables[name]
        if table is None:
            raise ValueError(f"the {name} layer needs its spec table")
        pipeline.run(store.load_specs(pipeline.spark, name, table, group, ids))
