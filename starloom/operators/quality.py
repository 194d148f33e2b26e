"""Rule-driven data quality: counts per rule, and the rows that fail.

All rules about single rows are counted in one aggregate, so the table is read
once however many there are. A uniqueness rule needs its own grouping and reads
only its columns. NULL passes every rule but completeness, whose subject it is.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from functools import reduce
from operator import and_, or_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.scratch import materialize

RESULT_COLUMNS = ("rule_id", "column_name", "rule_type", "severity", "failed_count", "comments")


@dataclass(frozen=True)
class Rule:
    """A parsed rule. ``kind`` says what is checked, ``rule_type`` how it was named."""

    rule_id: int
    columns: tuple[str, ...]
    rule_type: str
    kind: str
    severity: str | None = None
    description: str | None = None
    low: int | Decimal | None = None
    high: int | Decimal | None = None
    pattern: str | None = None
    allowed: tuple[tuple[str, str], ...] = ()

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)

    @property
    def comments(self) -> str:
        return self.description or f"{self.kind} rule failed for {self.column_name}"


def parse_rules(rules_df: DataFrame) -> list[Rule]:
    """Rules from a table of ``rule_id, column_name, rule_type, rule_value, ...``.

    ``rule_value`` is ``NOT_NULL``, ``UNIQUE``, ``RANGE:low:high``,
    ``REGEX:pattern`` or ``MAP:a=x,y;b=z``. Anything else raises, as does a rule
    without an id. Rules are metadata and are read whole.
    """
    return [_parse(row.asDict()) for row in rules_df.collect()]


def failing(rule: Rule, schema: T.StructType) -> Column:
    """Condition that holds exactly for the rows failing a row-level rule."""
    values = [F.col(name) for name in rule.columns]
    if rule.kind == "completeness":
        return values[0].isNull()
    if rule.kind == "range":
        number = _as_number(values[0], schema[rule.columns[0]].dataType)
        unreadable = values[0].isNotNull() & number.isNull()
        condition = unreadable | (number < F.lit(rule.low)) | (number > F.lit(rule.high))
    elif rule.kind == "regex":
        condition = ~values[0].cast("string").rlike(rule.pattern)
    elif rule.kind == "consistency":
        # A long list of pairs becomes a set lookup in the optimizer.
        pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in rule.allowed]
        pair = F.struct(
            values[0].cast("string").alias("a"), values[1].cast("string").alias("b")
        )
        condition = values[0].isNotNull() & values[1].isNotNull() & ~pair.isin(*pairs)
    else:
        raise ValueError(f"{rule.kind} is not a row-level rule")
    return F.coalesce(condition, F.lit(False))


def run_rules(
    df: DataFrame, rules: DataFrame | Sequence[Rule], write_once: bool = False
) -> DataFrame:
    """One row per rule: how many rows fail it, or how many values repeat.

    Each uniqueness rule reads ``df`` once more. Where that is no plain scan but
    a join, ``write_once`` writes the columns the rules name to scratch first.
    """
    parsed = parse_rules(rules) if isinstance(rules, DataFrame) else list(rules)
    _require_columns(df, parsed)
    passes = sum(rule.kind == "uniqueness" for rule in parsed)
    if write_once and passes and len(parsed) > 1:
        named = {name.lower() for rule in parsed for name in rule.columns}
        df = materialize(df.select(*[c for c in df.columns if c.lower() in named]), "checked")
    by_row = [rule for rule in parsed if rule.kind != "uniqueness"]
    results = [
        duplicate_values(df, rule)
        .agg(F.count(F.lit(1)).alias("failed_count"))
        .select(*_result(rule, F.col("failed_count")))
        for rule in parsed
        if rule.kind == "uniqueness"
    ]
    if by_row:
        counts = df.agg(
            *[F.count_if(failing(rule, df.schema)).alias(f"r{i}") for i, rule in enumerate(by_row)]
        )
        lines = [F.struct(*_result(rule, F.col(f"r{i}"))) for i, rule in enumerate(by_row)]
        results.append(counts.select(F.inline(F.array(*lines))))
    if not results:
        raise ValueError("no rules to run")
    return reduce(DataFrame.unionByName, results)


def duplicate_values(df: DataFrame, rule: Rule) -> DataFrame:
    """Values of a uniqueness rule's columns that occur more than once."""
    known = reduce(and_, [F.col(name).isNotNull() for name in rule.columns])
    return (
        df.where(known)
        .groupBy(*rule.columns)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def failing_rows(df: DataFrame, rules: DataFrame | Sequence[Rule]) -> DataFrame:
    """Rows that fail at least one row-level rule, with the ids of those rules.

    Uniqueness is a property of values, see :func:`duplicate_values`.
    """
    parsed = parse_rules(rules) if isinstance(rules, DataFrame) else list(rules)
    _require_columns(df, parsed)
    # Rules may share an id; each is checked.
    conditions = [
        (rule.rule_id, failing(rule, df.schema)) for rule in parsed if rule.kind != "uniqueness"
    ]
    if not conditions:
        raise ValueError("no row-level rules")
    # Rules that hold leave a value no rule has, which array_remove takes out;
    # it is compiled with the rest, where array_compact runs a lambda per row.
    none = min(rule_id for rule_id, _ in conditions) - 1
    marks = [F.when(failed, rule_id).otherwise(none) for rule_id, failed in conditions]
    ids = F.array_remove(F.array(*marks), none)
    return df.where(reduce(or_, [failed for _, failed in conditions])).withColumn("failed_rules", ids)


def _parse(row: dict) -> Rule:
    if row["rule_id"] is None:
        raise ValueError(f"a rule on {row['column_name']} has no id")
    rule_type, value = row["rule_type"], (row.get("rule_value") or "").strip()
    columns = tuple(name.strip() for name in row["column_name"].split(","))
    shared = {
        "rule_id": row["rule_id"],
        "columns": columns,
        "rule_type": rule_type,
        "severity": row.get("severity"),
        "description": row.get("description"),
    }
    form, _, rest = value.partition(":")
    if rule_type == "completeness" and len(columns) == 1:
        return Rule(kind="completeness", **shared)
    if rule_type == "uniqueness":
        return Rule(kind="uniqueness", **shared)
    if rule_type == "accuracy" and form == "RANGE" and len(columns) == 1:
        low, _, high = rest.partition(":")
        return Rule(kind="range", low=_number(low, row), high=_number(high, row), **shared)
    if rule_type == "accuracy" and form == "REGEX" and rest and len(columns) == 1:
        return Rule(kind="regex", pattern=rest, **shared)
    if rule_type == "consistency" and form == "MAP" and len(columns) == 2:
        return Rule(kind="consistency", allowed=_pairs(rest, row), **shared)
    raise ValueError(f"rule {row['rule_id']}: cannot read {rule_type} {value!r} on {columns}")


def _number(text: str, row: dict) -> int | Decimal:
    try:
        number = Decimal(text.strip())
    except InvalidOperation:
        raise ValueError(f"rule {row['rule_id']}: {text!r} is not a number") from None
    return int(number) if number == number.to_integral_value() else number


def _pairs(text: str, row: dict) -> tuple[tuple[str, str], ...]:
    pairs = []
    for group in text.strip().split(";"):
        first, found, seconds = group.partition("=")
        if not found:
            raise ValueError(f"rule {row['rule_id']}: {group!r} has no '='")
        pairs += [(first.strip(), second.strip()) for second in seconds.split(",")]
    return tuple(pairs)


def _as_number(value: Column, kind: T.DataType) -> Column:
    # Text that is no number gives NULL, which a range rule counts as failing.
    return value.try_cast("double") if isinstance(kind, T.StringType) else value


def _require_columns(df: DataFrame, rules: Sequence[Rule]) -> None:
    known = {name.lower() for name in df.columns}
    for rule in rules:
        missing = [name for name in rule.columns if name.lower() not in known]
        if missing:
            raise ValueError(f"rule {rule.rule_id} names unknown columns {missing}")


def _result(rule: Rule, failed: Column) -> list[Column]:
    values = (rule.rule_id, rule.column_name, rule.rule_type, rule.severity)
    kinds = ("int", "string", "string", "string")
    fixed = [F.lit(value).cast(kind) for value, kind in zip(values, kinds)]
    columns = [*fixed, failed.cast("long"), F.lit(rule.comments)]
    return [column.alias(name) for column, name in zip(columns, RESULT_COLUMNS)]
