"""Full snapshots, one version after the other."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, types as T

from .. import storage

# (last applied version or None, spec) -> (rows, version), or None if there is no next one
NextSnapshot = Callable[[object, object], "tuple[DataFrame, object] | None"]


def numbered_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    options: dict[str, str] | None = None,
    schema: T.StructType | None = None,
    first: int = 1,
) -> NextSnapshot:
    """Snapshots at ``<path><version>.<format>``, counted from ``first``."""

    def next_snapshot(latest, _spec):
        version = first if latest is None else int(latest) + 1
        file = f"{path}{version}.{fmt}"
        if not storage.exists(spark, file):
            return None
        snapshot = spark.read.format(fmt).options(**(options or {}))
        if schema is not None:
            snapshot = snapshot.schema(schema)
        return snapshot.load(file), version

    return next_snapshot


def new_snapshots(next_snapshot: NextSnapshot, latest, spec) -> Iterator[tuple[DataFrame, object]]:
    """Snapshots after ``latest`` until there are no more; versions must rise."""
    while True:
        found = next_snapshot(latest, spec)
        if found is None:
            return
        snapshot, version = found
        if latest is not None and not version > latest:
            raise ValueError(f"snapshot version {version!r} is not above {latest!r}")
        yield snapshot, version
        latest = version
