"""Data quality rules: SQL predicates by name, grouped by what a failure does."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, functions as F

# The rule kinds of a rules file, by effect. The singular form
# of a kind wins over the plural one for a rule of the same name.
KINDS = {
    "warn": ("expect_all", "expect"),
    "fail": ("expect_all_or_fail", "expect_or_fail"),
    "drop": ("expect_all_or_drop", "expect_or_drop"),
    "quarantine": ("expect_all_or_quarantine", "expect_or_quarantine"),
}


def holds(predicate: str) -> Column:
    """True where the rule is satisfied; an unknown result counts as failed."""
    return F.coalesce(F.expr(predicate).cast("boolean"), F.lit(False))


def all_hold(predicates: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [holds(p) for p in predicates.values()], F.lit(True))


@dataclass(frozen=True)
class Rules:
    warn: dict[str, str] = field(default_factory=dict)
    fail: dict[str, str] = field(default_factory=dict)
    drop: dict[str, str] = field(default_factory=dict)
    quarantine: dict[str, str] = field(default_factory=dict)

    @classmethod
    def parse(cls, source: str | dict | None) -> "Rules":
        if not source:
            return cls()
        groups = json.loads(source) if isinstance(source, str) else source
        known = {kind for kinds in KINDS.values() for kind in kinds}
        unknown = set(groups) - known
        if unknown:
            raise ValueError(f"unknown rule kinds: {sorted(unknown)}")
        merged = {
            effect: {n: p for kind in kinds for n, p in (groups.get(kind) or {}).items()}
            for effect, kinds in KINDS.items()
        }
        return cls(**merged)

    def __bool__(self) -> bool:
        return bool(self.warn or self.fail or self.drop or self.quarantine)

    def counted(self) -> list[tuple[str, str, str]]:
        """(effect, rule, predicate) of every rule whose failures are counted."""
        return [
            (effect, name, predicate)
            for effect in ("warn", "fail", "drop")
            for name, predicate in getattr(self, effect).items()
        ]
