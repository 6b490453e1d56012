"""Flows: a source, rules and a target, run until the input is used up."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import storage
from ..functions.expressions import named_list, no_rows
from ..functions.rules import Rules
from ..operators import cdc, quality, skew
from ..operators.snapshot import SnapshotSpec
from ..operators.transform import fan_out_labelled, project
from ..sources import Source
from . import tables
from .tables import Target

SNAPSHOTS = "snapshots"
# the column that says which target of a fan-out a row is for
TARGET = "__target"
POOL = "spark.scheduler.pool"
# marks the rows of a batch whose keys have left a rewritten source
GONE, LEFT_AT = "__gone", "__left_at"
METRICS_SCHEMA = "effect string, rule string, passed long, failed long"


@dataclass
class Flow:
    """One streaming query into one target."""

    name: str
    source: Source
    target: Target
    checkpoint: str
    rules: Rules = field(default_factory=Rules)
    transform: Callable[[DataFrame], DataFrame] = lambda df: df
    changes: cdc.ChangeSpec | None = None
    quarantine: Target | None = None
    once: bool = False
    # each row of the source has a key of its own in the target
    keeps_keys: bool = False

    def __post_init__(self):
        # the name becomes part of folder names
        self.name = re.sub(r"[^A-Za-z0-9_.-]", "_", self.name)

    @property
    def title(self) -> str:
        return f"{self.target.name or self.target.path} {self.name}"


class FlowFailed(Exception):
    """Flows that did not end; the other flows of the run did."""

    def __init__(self, failures: dict[str, BaseException]):
        self.failures = failures
        detail = "; ".join(f"{name}: {error}" for name, error in failures.items())
        super().__init__(f"{len(failures)} flow(s) failed: {detail}")


def stream_id(spark: SparkSession, flow: Flow) -> str:
    """The flow together with its checkpoint.

    Batches are numbered from 0 by each checkpoint, so a number says which batch
    it is only along with the checkpoint. The id lives beside it: who starts again
    with a new or an emptied folder gets a new one. Checkpoints from before there
    were ids go by the name of the flow alone.
    """
    path = storage.join(flow.checkpoint, "identity.json")
    kept = storage.read_json(spark, path)
    if kept is None:
        older = [storage.join(flow.checkpoint, n) for n in ("stream", "once.json")]
        known = any(storage.exists(spark, o) for o in older)
        kept = {"id": flow.name if known else f"{flow.name}-{uuid.uuid4().hex[:16]}"}
        storage.write_json(spark, path, kept)
    return kept["id"]


# ---- one batch --------------------------------------------------------------


def write_batch(flow: Flow, batch: DataFrame, number: int, stream: str) -> None:
    """Rules, then the target, the quarantine and the metrics.

    Every write is repeatable, so a batch of a stream that failed half-way is simply
    run again. Rules are counted while rows are written, where that is exact: in the
    last stage, whose tasks count once however often they run. Where a shuffle lays
    out the rows, the rules they break travel with them. Fail rules, and rules on
    changes, which are merged before they are written, are counted by one aggregation
    before the write. A batch that must be parsed is kept in executor memory and disk
    if it is needed more than once; a lost executor recomputes its part.
    """
    spark = batch.sparkSession
    rows = flow.transform(flow.source.expand(batch))
    rules, target = flow.rules, flow.target
    shuffled = bool(target.partition_by or target.cluster_by)
    marked = shuffled and flow.changes is None and 0 < len(rules.counted()) <= quality.MOST_MARKED
    counted_first = bool(rules.fail or (rules.counted() and not marked and (shuffled or flow.changes is not None)))
    # sampling for a clustered layout is a pass too
    passes = 1 + counted_first + bool(rules.quarantine and flow.quarantine) + bool(target.cluster_by)
    kept_in_memory = passes > 1 and not flow.source.columnar
    if kept_in_memory:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts, observation = None, None
        if counted_first:
            counts = quality.checked_counts(rows, rules, target.name or target.path)
        if flow.changes is not None:
            kept = quality.keep_rows(rows, rules)
            written = tables.apply_changes(kept, target, flow.changes, stream, number)
        elif marked and not counted_first:
            observed = []

            def behind(laid_out: DataFrame) -> DataFrame:
                kept, seen = quality.observe_broken(laid_out, rules)
                observed.append(seen)
                return kept

            written = tables.append(
                quality.mark_broken(rows, rules), target, stream, number, behind, [quality.BROKEN]
            )
            observation = observed[0] if observed else None
        else:
            kept, observation = (rows, None) if counted_first else quality.observe_rules(rows, rules)
            written = tables.append(quality.keep_rows(kept, rules), target, stream, number)
        if rules.quarantine and flow.quarantine:
            bad = quality.quarantine_rows(rows, rules)
            tables.append(bad, flow.quarantine, stream, number)
        if rules.counted():
            if counts is None and written:
                counts = quality.observed_rows(rules, observation)
            if counts is None:
                # written before its metrics, or not observed: count once more
                counts = [tuple(r) for r in quality.rule_counts(rows, rules).collect()]
            _write_metrics(spark, flow.name, target, stream, number, counts)
    finally:
        if kept_in_memory:
            rows.unpersist()


def write_snapshot(
    rows: DataFrame, version, target: Target, spec: SnapshotSpec, rules: Rules, quarantine: Target | None
) -> None:
    """The next snapshot of a target, under the same rules as a batch of a flow."""
    spark = rows.sparkSession
    number = tables.next_version(spark, target)
    counts = quality.checked_counts(rows, rules, target.name or target.path)
    if rules.quarantine and quarantine:
        tables.append(quality.quarantine_rows(rows, rules), quarantine, SNAPSHOTS, number)
    if rules.counted():
        _write_metrics(spark, SNAPSHOTS, target, SNAPSHOTS, number, counts)
    # the table comes last: until then a repeated run finds the same number
    tables.apply_snapshot(quality.keep_rows(rows, rules), target, spec, version)


def metrics_target(target: Target, spark: SparkSession) -> Target:
    return Target(path=storage.join(target.location(spark), "_medallion", "metrics"))


def _write_metrics(
    spark, flow: str, target: Target, stream: str, number: int, rows: list[tuple]
) -> None:
    # one row per rule, as literals
    counts = F.array(
        *[
            F.struct(
                F.lit(effect).alias("effect"),
                F.lit(rule).alias("rule"),
                F.lit(passed).cast("long").alias("passed"),
                F.lit(failed).cast("long").alias("failed"),
            )
            for effect, rule, passed, failed in rows
        ]
    )
    df = spark.range(0, 1, 1, 1).select(
        F.lit(flow).alias("flow"), F.lit(number).cast("long").alias("batch"), F.inline(counts)
    )
    tables.append(df, metrics_target(target, spark), stream, number)


def read_metrics(spark: SparkSession, target: Target) -> DataFrame:
    """Rows per flow, batch and rule; no rows if no batch ran yet."""
    path = metrics_target(target, spark).path
    if not tables.is_ours(spark, path):
        columns = f"flow string, batch long, {METRICS_SCHEMA}"
        return no_rows(spark, T.StructType.fromDDL(columns))
    return tables.read(spark, path)


# ---- one flow ---------------------------------------------------------------


def flow_session(spark: SparkSession, conf: dict[str, str] | None) -> SparkSession:
    """A session with the settings of one flow; open the flow's source with it."""
    if not conf:
        return spark
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in conf.items():
        session.conf.set(name, value)
    return session


@contextmanager
def scheduler_pool(spark: SparkSession, name: str):
    """The jobs that this thread starts go to a pool of their own.

    With ``spark.scheduler.mode`` FAIR pools share the executors evenly, so a large
    table does not hold back the small ones of the same run. Streams that are started
    here take the pool along.
    """
    context = spark.sparkContext
    before = context.getLocalProperty(POOL)
    context.setLocalProperty(POOL, name)
    try:
        yield
    finally:
        context.setLocalProperty(POOL, before)


def run_flow(spark: SparkSession, flow: Flow) -> None:
    """Process what is new, then stop."""
    with scheduler_pool(spark, flow.title):
        if flow.once:
            _run_once(spark, flow)
        else:
            _run_stream(spark, flow)


def _run_stream(spark: SparkSession, flow: Flow) -> None:
    errors: list[BaseException] = []
    stream = stream_id(spark, flow)

    def each(batch: DataFrame, number: int) -> None:
        try:
            write_batch(flow, batch, number, stream)
        except BaseException as error:
            errors.append(error)
            raise

    query = (
        flow.source.open(True)
        .writeStream.queryName(flow.title)
        .option("checkpointLocation", storage.join(flow.checkpoint, "stream"))
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    try:
        query.awaitTermination()
    except Exception as error:
        raise (errors[0] if errors else error) from error


def _run_once(spark: SparkSession, flow: Flow) -> None:
    """A backfill: the whole source in one batch, a single time."""
    marker = storage.join(flow.checkpoint, "once.json")
    if storage.exists(spark, marker):
        return
    write_batch(flow, flow.source.open(False), 0, stream_id(spark, flow))
    storage.write_json(spark, marker, {"flow": flow.name})


def run_on_version(spark: SparkSession, flow: Flow, source: str) -> None:
    """A flow whose source table is rewritten by changes or snapshots: one batch per version.

    Such a table has no stream of new rows. A flow with changes gets what changed since
    the version it last took over; the number of the batch is the version, so each
    version is processed once. Keys that have left the source, or its filter, are
    deleted at the time they left. A target without changes shows what the version
    became, so rows that left the source leave it too.
    """
    with scheduler_pool(spark, flow.title):
        _run_on_version(spark, flow, source)


def _run_on_version(spark: SparkSession, flow: Flow, source: str) -> None:
    current = tables.manifest(spark, source)
    if current is None:
        return
    version, stream = current["version"], stream_id(spark, flow)
    markers = storage.join(flow.checkpoint, "versions")
    done = [int(n[: -len(".json")]) for n in storage.list_names(spark, markers) if n.endswith(".json")]
    if version in done:
        tables.note_reader(spark, source, stream, version)
        return
    rules, target = flow.rules, flow.target
    if flow.changes is None:
        rows = flow.transform(flow.source.read())
        counts = quality.checked_counts(rows, rules, target.name or target.path)
        tables.overwrite(quality.keep_rows(rows, rules), target)
    else:
        feed = tables.changes_since(spark, source, max(done, default=None))
        rows = flow.transform(feed.rows)
        counts = quality.checked_counts(rows, rules, target.name or target.path)
        batch, changes = _with_deletes(flow, feed, quality.keep_rows(rows, rules))
        tables.apply_changes(batch, target, changes, stream, version)
    if rules.counted():
        _write_metrics(spark, flow.name, target, stream, version, counts)
    storage.write_json(spark, storage.join(markers, f"{version:020d}.json"), {"flow": flow.name})
    tables.note_reader(spark, source, stream, version)


def _with_deletes(flow: Flow, feed: tables.Feed, rows: DataFrame) -> tuple[DataFrame, cdc.ChangeSpec]:
    """Changed rows and, marked, the last rows of the target keys that none of them has.

    Where the source does not know when they went, they go at its newest sequence.
    """
    spec = flow.changes
    if feed.before is None:
        return rows, spec
    keys = spec.keys
    gone = skew.without_keys(flow.transform(feed.before), flow.transform(feed.after).select(*_names(keys)), keys, False)
    if not flow.keeps_keys:
        # several rows of the source may stand for one key here: one that is left is enough
        still = flow.transform(flow.source.read()).select(*_names(keys))
        gone = skew.without_keys(gone, still, keys, False)
    deletes = GONE if not (spec.apply_as_deletes or "").strip() else f"{GONE} OR ({spec.apply_as_deletes})"
    rows, gone = rows.withColumn(GONE, F.lit(False)), gone.withColumn(GONE, F.lit(True))
    sequence, added = spec.sequence_by, [GONE]
    if not feed.timed:
        newest = flow.transform(flow.source.read()).agg(F.max(F.expr(sequence)).alias("m"))
        kind = newest.schema["m"].dataType
        if isinstance(kind, T.AtomicType):
            at = newest.select(F.col("m").cast("string")).first()[0]
            rows = rows.withColumn(LEFT_AT, F.lit(None).cast(kind))
            gone = gone.withColumn(LEFT_AT, F.lit(at).cast(kind))
            sequence, added = f"coalesce({LEFT_AT}, {sequence})", [GONE, LEFT_AT]
    dropped = None if spec.column_list else [*named_list(spec.except_column_list), *added]
    return rows.unionByName(gone), replace(
        spec, apply_as_deletes=deletes, except_column_list=dropped, sequence_by=sequence
    )


def _names(columns: list[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


# ---- fan-out ----------------------------------------------------------------


@dataclass
class Branch:
    """What one target takes of a source: expressions, and conditions on their columns."""

    flow: Flow
    expressions: list[str]
    predicates: list[str]


def run_fan_out(spark: SparkSession, name: str, source: Source, branches: list[Branch], checkpoint: str) -> None:
    """Several targets of appended rows from one stream over their source.

    A batch is scanned once: each row is mapped to the targets that want it, and one
    write lays the rows out by target. The folder of a target then becomes its batch. The
    checkpoint belongs to this set of targets; ``fan_groups`` keeps sets together.
    """
    stream = stream_id(spark, Flow(name, source, branches[0].flow.target, checkpoint))
    staged = storage.join(checkpoint, "staged")
    errors: list[BaseException] = []

    def each(batch: DataFrame, number: int) -> None:
        try:
            targets = [b.flow.target for b in branches]
            if all(tables.has_batch(batch.sparkSession, t, stream, number) for t in targets):
                return
            folder = storage.join(staged, str(number))
            labelled = fan_out_labelled(
                source.expand(batch), {str(i): (b.expressions, b.predicates) for i, b in enumerate(branches)},
                TARGET, own_columns=True,
            )
            tables.append_staged(labelled, TARGET, targets, folder, stream, number, [
                project(batch.limit(0), b.expressions).schema for b in branches
            ])
        except BaseException as error:
            errors.append(error)
            raise

    with scheduler_pool(spark, name):
        query = (
            source.open(True).writeStream.queryName(name)
            .option("checkpointLocation", storage.join(checkpoint, "stream"))
            .trigger(availableNow=True).foreachBatch(each).start()
        )
        try:
            query.awaitTermination()
        except Exception as error:
            raise (errors[0] if errors else error) from error


def fan_groups(spark: SparkSession, checkpoint: str, names: list[str]) -> list[list[str]]:
    """Which of the targets of a source run together: those that began together.

    A target that comes later has other rows to catch up with, so it begins a group of
    its own with the others of that run. All targets of a group must be there.
    """
    path = storage.join(checkpoint, "groups")
    kept = sorted(n for n in storage.list_names(spark, path) if n.endswith(".json"))
    groups = [storage.read_json(spark, storage.join(path, n))["targets"] for n in kept]
    for group in groups:
        missing = sorted(set(group) - set(names))
        if missing and set(group) & set(names):
            raise ValueError(f"{sorted(set(group) & set(names))} are written together with {missing}: run them together")
    new = [n for n in names if not any(n in g for g in groups)]
    if new:
        storage.write_json(spark, storage.join(path, f"{len(kept):020d}.json"), {"targets": new})
        groups.append(new)
    return [g if set(g) <= set(names) else [] for g in groups]


# ---- many flows -------------------------------------------------------------


def run_flows(spark: SparkSession, flows: Iterable[Flow], at_once: int = 8) -> None:
    """Run flows side by side; flows into one change target take turns."""
    lanes: dict[object, list[Flow]] = {}
    for flow in flows:
        key = ("changes", flow.target.location(spark)) if flow.changes else ("append", id(flow))
        lanes.setdefault(key, []).append(flow)
    failures: dict[str, BaseException] = {}

    def run_lane(lane: list[Flow]) -> None:
        for flow in lane:
            try:
                run_flow(spark, flow)
            except Exception as error:
                failures[flow.title] = error
                return

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        list(pool.map(run_lane, lanes.values()))
    if failures:
        raise FlowFailed(failures)
