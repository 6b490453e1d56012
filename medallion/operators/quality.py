"""Rules applied to DataFrames: count, reject, drop and quarantine."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..functions.expressions import no_rows
from ..functions.rules import Rules, all_hold, holds

BROKEN = "__broken"
# bits of BROKEN
MOST_MARKED = 62
RESULT_SCHEMA = "effect string, rule string, passed long, failed long"


class RuleViolation(Exception):
    """A fail rule was broken; nothing of the batch has been written."""

    def __init__(self, target: str, broken: dict[str, int]):
        self.target, self.broken = target, broken
        detail = ", ".join(f"{name}: {n} rows" for name, n in sorted(broken.items()))
        super().__init__(f"{target} broke fail rules ({detail})")


def _counters(rules: Rules) -> list[Column]:
    counted = rules.counted()
    return [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(~holds(predicate)).alias(f"r{i}")
        for i, (_, _, predicate) in enumerate(counted)
    ]


def _result_rows(rules: Rules, metrics: dict) -> list[tuple]:
    total = metrics.get("rows") or 0
    out = []
    for i, (effect, rule, _) in enumerate(rules.counted()):
        failed = metrics.get(f"r{i}") or 0
        out.append((effect, rule, total - failed, failed))
    return out


def rule_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with passed and failed rows; a single pass over ``df``."""
    counted = rules.counted()
    if not counted:
        return no_rows(df.sparkSession, T.StructType.fromDDL(RESULT_SCHEMA))
    row = df.agg(*_counters(rules))
    results = F.array(
        *[
            F.struct(
                F.lit(effect).alias("effect"),
                F.lit(rule).alias("rule"),
                (F.col("rows") - F.col(f"r{i}")).alias("passed"),
                F.col(f"r{i}").alias("failed"),
            )
            for i, (effect, rule, _) in enumerate(counted)
        ]
    )
    return row.select(F.inline(results))


def observe_rules(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation | None]:
    """Count failures while ``df`` is written, without a pass of its own.

    Exact only if no shuffle lies between here and the write: the tasks of an earlier
    stage may run, and count, more than once.
    """
    if not rules.counted():
        return df, None
    observation = Observation()
    return df.observe(observation, *_counters(rules)), observation


def mark_broken(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows with one bit per counted rule that they break, in the column BROKEN.

    The bits travel with the rows, so that they can be counted behind a shuffle.
    """
    bits = [
        F.when(holds(predicate), F.lit(0)).otherwise(F.lit(1 << i)).cast("long")
        for i, (_, _, predicate) in enumerate(rules.counted())
    ]
    return df.withColumn(BROKEN, reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long")))


def observe_broken(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation]:
    """Count the bits of ``mark_broken`` while rows are written; the rows to keep, without the bits."""
    counted = rules.counted()
    observation = Observation()
    counters = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(F.getbit(BROKEN, F.lit(i)) == 1).alias(f"r{i}") for i in range(len(counted))
    ]
    drops = sum(1 << i for i, (effect, _, _) in enumerate(counted) if effect == "drop")
    kept = F.col(BROKEN).bitwiseAND(F.lit(drops).cast("long")) == 0
    return df.observe(observation, *counters).where(kept).drop(BROKEN), observation


def observed_rows(rules: Rules, observation: Observation | None) -> list[tuple] | None:
    """Counts of a finished write; None if Spark dropped the observation.

    That happens where the optimizer finds that no row can be kept.
    """
    if observation is None:
        return []
    try:
        metrics = observation.get
    except Py4JJavaError:
        return None
    return _result_rows(rules, metrics)


def checked_counts(df: DataFrame, rules: Rules, target: str) -> list[tuple]:
    """Counts of all counted rules in one pass, once the fail rules among them hold."""
    if not rules.counted():
        return []
    counts = _result_rows(rules, df.agg(*_counters(rules)).first().asDict())
    broken = {rule: failed for effect, rule, _, failed in counts if effect == "fail" and failed}
    if broken:
        raise RuleViolation(target, broken)
    return counts


def check_fail_rules(df: DataFrame, rules: Rules, target: str) -> None:
    checked_counts(df, Rules(fail=rules.fail), target)


def keep_rows(df: DataFrame, rules: Rules) -> DataFrame:
    return df.where(all_hold(rules.drop)) if rules.drop else df


def quarantine_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that satisfy all quarantine rules, whether or not they are kept."""
    if not rules.quarantine:
        return df.limit(0)
    return df.where(all_hold(rules.quarantine))
