"""What a source is, and the registry of formats."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T


@dataclass
class SourceRequest:
    """A source as a spec describes it."""

    spark: SparkSession
    format: str
    details: dict[str, str] = field(default_factory=dict)
    options: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None
    state: str | None = None
    secrets: Callable[[str, str], str] | None = None


@dataclass
class Source:
    """Opens a stream or a batch; ``expand`` turns a micro-batch into rows.

    Most sources stream their rows. A source whose reading needs a look at the
    files first streams the file names and reads them in ``expand``. Columnar
    sources are read again rather than kept where a batch needs several passes:
    each pass reads only its columns.
    """

    open: Callable[[bool], DataFrame]
    expand: Callable[[DataFrame], DataFrame] = lambda batch: batch
    columnar: bool = False

    def read(self) -> DataFrame:
        """Everything the source holds, as a batch."""
        return self.expand(self.open(False))


_FORMATS: dict[str, Callable[[SourceRequest], Source]] = {}


def register_source(name: str, factory: Callable[[SourceRequest], Source]) -> None:
    _FORMATS[name.lower()] = factory


def known_formats() -> list[str]:
    return sorted(_FORMATS)


def open_source(request: SourceRequest) -> Source:
    factory = _FORMATS.get((request.format or "").lower())
    if factory is None:
        raise ValueError(f"source format {request.format!r} is not one of {known_formats()}")
    return factory(request)


def reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read
