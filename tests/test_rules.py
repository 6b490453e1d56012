import pytest

import model
from medallion.functions.rules import Rules
from medallion.operators import quality, transform


def numbers(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (4, "d")], "n int, s string")


def test_all_kinds_and_their_effects(spark):
    rules = Rules.parse("""{"expect": {"r": "n > 1"}, "expect_all": {"r": "n > 100", "s": "s IS NOT NULL"},
        "expect_or_fail": {"f": "true"}, "expect_or_drop": {"d": "n < 4"},
        "expect_or_quarantine": {"q": "n > 1", "t": "s = 'd'"}}""")
    # the singular form wins for the same name, other names are merged
    assert rules.warn == {"r": "n > 1", "s": "s IS NOT NULL"}
    df = numbers(spark)
    assert model.rows(quality.rule_counts(df, rules)) == [
        ("drop", "d", 2, 2), ("fail", "f", 4, 0), ("warn", "r", 2, 2), ("warn", "s", 3, 1)]
    assert model.rows(quality.keep_rows(df, rules)) == [(1, "a"), (2, None)]
    # quarantine takes rows that satisfy all its rules, independent of drops
    assert model.rows(quality.quarantine_rows(df, rules)) == [(4, "d")]
    quality.check_fail_rules(df, rules, "t")
    with pytest.raises(quality.RuleViolation) as error:
        quality.check_fail_rules(df, Rules(fail={"x": "n > 1", "y": "s <> 'z'"}), "t")
    assert error.value.broken == {"x": 2, "y": 1}


def test_unknown_kinds_and_empty_rules(spark):
    with pytest.raises(ValueError, match="unknown rule kinds"):
        Rules.parse({"expect_maybe": {}})
    assert not Rules.parse(None)
    df = numbers(spark)
    assert quality.keep_rows(df, Rules()).count() == 4
    assert quality.quarantine_rows(df, Rules()).count() == 0
    assert quality.rule_counts(df, Rules()).count() == 0


def test_projection_then_filters(spark):
    df = numbers(spark)
    got = transform.project_and_filter(df, ["n * 2 AS m", "s"], ["m > 2", "  ", "s IS NOT NULL"])
    assert model.rows(got) == [(8, "d")]
    assert transform.project_and_filter(df, None, [""]).count() == 4
    assert transform.output_schema(df, ["n AS x"], ["x > 1"]).names == ["x"]


def test_fan_out(spark):
    df = numbers(spark)
    branches = {"small": (["n", "s"], ["n < 3"]), "all": (["n", "upper(s) AS s"], [])}
    parts = transform.fan_out(df.where("n IS NOT NULL"), {"one": (["n"], ["n > 1"])})
    assert parts["one"].count() == 2
    got = transform.fan_out_labelled(df, branches)
    assert got.columns == ["target", "n", "s"]
    assert got.groupBy("target").count().count() == 2
    with pytest.raises(ValueError, match="other columns"):
        transform.fan_out_labelled(df, {"a": (["n"], []), "b": (["s"], [])})
