"""Sources by format name; ``register_source`` adds others."""

from .base import Source, SourceRequest, known_formats, open_source, register_source
from . import files, tables, topics  # noqa: F401  (they register themselves)

__all__ = ["Source", "SourceRequest", "known_formats", "open_source", "register_source"]
