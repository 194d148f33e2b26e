"""Quality rules whose results are kept and merged, so a load checks its own rows only.

The state of a load has one count a row-level rule and, for uniqueness rules, how
often each value occurs, by a hash of 128 bits. States of several loads are added
up: a value that occurs once in each of two loads then fails as it should.
``save_state`` stores them by load, and a repeated load replaces its own.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.quality import RESULT_COLUMNS, Rule, _require_columns, failing, parse_rules

STATE_COLUMNS = ("rule", "value_1", "value_2", "n")


def rule_state(df: DataFrame, rules: DataFrame | Sequence[Rule]) -> DataFrame:
    """``rule, value_1, value_2, n`` of one load, in two passes however many rules there are.

    Rules about rows have one row without a value. Uniqueness rules have one for
    each value, counted before it is shuffled, and one without that says they ran.
    """
    parsed = _distinct(parse_rules(rules) if isinstance(rules, DataFrame) else list(rules))
    _require_columns(df, list(parsed.values()))
    if not parsed:
        raise ValueError("no rules to run")
    counts = [
        F.lit(0).cast("long") if rule.kind == "uniqueness" else F.count_if(failing(rule, df.schema))
        for rule in parsed.values()
    ]
    # The row count keeps this an aggregate where every rule is about uniqueness.
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(f"r{i}") for i, c in enumerate(counts)])
    lines = [_line(key, None, F.col(f"r{i}")) for i, key in enumerate(parsed)]
    state = totals.select(F.inline(F.array(*lines)))
    unique = [(key, rule) for key, rule in parsed.items() if rule.kind == "uniqueness"]
    if unique:
        values = df.select(F.inline(F.array(*[_line(key, rule, F.lit(1).cast("long")) for key, rule in unique])))
        per_value = values.where("value_1 is not null").groupBy("rule", "value_1", "value_2")
        state = state.unionByName(per_value.agg(F.sum("n").alias("n")))
    return state


def merge_rule_states(state: DataFrame) -> DataFrame:
    """The state of several loads together."""
    return state.groupBy("rule", "value_1", "value_2").agg(F.sum("n").alias("n"))


def rule_report(state: DataFrame, rules: DataFrame | Sequence[Rule]) -> DataFrame:
    """What :func:`run_rules` gives over the rows of all loads in ``state``.

    A rule is known by its id and what it checks. One that no load ran, as it is
    new or was changed, has NULL for its count.
    """
    parsed = parse_rules(rules) if isinstance(rules, DataFrame) else list(rules)
    failed = F.sum(F.when(F.col("value_1").isNull(), F.col("n")).otherwise((F.col("n") > 1).cast("long")))
    totals = merge_rule_states(state).groupBy("rule").agg(failed.alias("failed_count"))
    rows = [
        (_key(rule), rule.rule_id, rule.column_name, rule.rule_type, rule.severity, rule.comments)
        for rule in parsed
    ]
    schema = "rule string, rule_id int, column_name string, rule_type string, severity string, comments string"
    listed = state.sparkSession.createDataFrame(rows, schema)
    return listed.join(totals, "rule", "left").select(*RESULT_COLUMNS)


def _key(rule: Rule) -> str:
    columns = tuple(name.lower() for name in rule.columns)
    return repr((rule.rule_id, columns, rule.kind, rule.low, rule.high, rule.pattern, rule.allowed))


def _distinct(rules: Sequence[Rule]) -> dict[str, Rule]:
    return {_key(rule): rule for rule in rules}


def _line(key: str, rule: Rule | None, n: Column) -> Column:
    """A row of the state; with ``rule``, that of its value, which is NULL if a column is."""
    hashes = [F.lit(None).cast("long")] * 2
    if rule is not None:
        values = [F.col(name) for name in rule.columns]
        known = reduce(and_, [value.isNotNull() for value in values])
        # A first column of its own makes the second hash independent of the first.
        hashes = [F.when(known, F.xxhash64(*values)), F.when(known, F.xxhash64(F.lit(1), *values))]
    return F.struct(*[c.alias(name) for c, name in zip([F.lit(key), *hashes, n], STATE_COLUMNS)])
