from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import Rule, merge_rule_states, rule_report, rule_state, run_rules

SCHEMA = "load int, id long, code string, amount double"
RULES = [
    Rule(1, ("code",), "completeness", "completeness", "HIGH"),
    Rule(2, ("amount",), "accuracy", "range", "LOW", low=0, high=50),
    Rule(3, ("id",), "uniqueness", "uniqueness", "HIGH", "ids"),
    Rule(4, ("code", "amount"), "uniqueness", "uniqueness"),
    Rule(4, ("amount",), "uniqueness", "uniqueness"),
]


def sample(spark, n=3000):
    """Ids that repeat within and across loads, NULLs, signed zeros, NaN and a hot value."""
    rng = random.Random(1)
    amounts = [None, 0.0, -0.0, float("nan"), *map(float, range(100))]
    rows = [
        (rng.randrange(3), rng.choice([None, rng.randrange(4 * n)]), "hot" if i % 3 == 0 else rng.choice([None, "a", ""]),
         rng.choice(amounts))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def lines(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merged_loads_equal_one_run_over_all(spark):
    df = sample(spark)
    states = [rule_state(df.where(F.col("load") == load), RULES) for load in range(3)]
    together = states[0].unionByName(states[1]).unionByName(states[2])
    expected = lines(run_rules(df, RULES))
    assert lines(rule_report(together, RULES)) == expected
    # Merging first changes nothing, nor does the order.
    early = merge_rule_states(states[2].unionByName(states[0])).unionByName(states[1])
    assert lines(rule_report(early, RULES)) == expected
    # One load alone misses values that repeat across loads.
    alone = {r.rule_id: r.failed_count for r in rule_report(states[0], RULES[:3]).collect()}
    assert alone[3] < {r[0]: r[4] for r in expected}[3]


def test_state_holds_no_more_than_the_load(spark):
    df = sample(spark)
    load = df.where("load = 1")
    unique = sum(rule.kind == "uniqueness" for rule in RULES)
    assert rule_state(load, RULES).count() <= unique * load.count() + len(RULES)


def test_empty_load_new_and_repeated_rules(spark):
    df = sample(spark)
    empty = rule_state(df.limit(0), RULES)
    assert {r.failed_count for r in rule_report(empty, RULES).collect()} == {0}
    whole = rule_state(df, RULES[:2] + RULES[:1])
    report = rule_report(whole, RULES[:1] + RULES[:1] + RULES[2:3]).collect()
    found = sorted((r.rule_id, r.failed_count) for r in report if r.rule_id == 1)
    assert found == [(1, df.where("code is null").count())] * 2
    # A rule no load has run has no count.
    assert [r.failed_count for r in report if r.rule_id == 3] == [None]


def test_only_unique_rules_and_unknown_columns(spark):
    df = sample(spark)
    only = RULES[2:4]
    assert lines(rule_report(rule_state(df, only), only)) == lines(run_rules(df, only))
    with pytest.raises(ValueError, match="unknown"):
        rule_state(df, [Rule(1, ("nope",), "completeness", "completeness")])
    with pytest.raises(ValueError, match="no rules"):
        rule_state(df, [])
