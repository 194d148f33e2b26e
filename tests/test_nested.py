from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from starloom.operators.nested import replace_text_deep


def test_every_depth_but_keys(spark):
    record = (
        "named_struct('name', 'Dev one', 'n', 1, 'Dev', cast(null as string), "
        "'list', array('Dev', null, 'x'), 'map', map('Dev', array('a Dev b')), "
        "'inner', array(named_struct('t', 'Dev')))"
    )
    df = spark.sql(f"select 'Dev' as top, {record} as r, cast(null as struct<s:string>) as none")
    row = replace_text_deep(df, "Dev", "QA").head()
    assert row["top"] == "QA"
    assert row["none"] is None
    assert row["r"].asDict(recursive=True) == {
        "name": "QA one",
        "n": 1,
        "Dev": None,
        "list": ["QA", None, "x"],
        "map": {"Dev": ["a QA b"]},
        "inner": [{"t": "QA"}],
    }


def test_chosen_columns_and_types(spark):
    df = spark.sql("select 'a' as x, 'a' as y, 1 as n, current_date() as d")
    out = replace_text_deep(df, "a", "b", ["x", "n"])
    assert out.schema.simpleString() == df.schema.simpleString()
    assert out.select("x", "y").head()[:] == ("b", "a")


def test_pattern_characters_are_literal(spark):
    df = spark.createDataFrame([("Finance (Dev) $1.x",)], "t STRING")
    assert replace_text_deep(df, "(Dev) $1.", "[QA]\\1").head()[0] == "Finance [QA]\\1x"


def test_no_text_is_no_change(spark):
    df = spark.range(2).select(F.struct("id").alias("s"))
    assert replace_text_deep(df, "a", "b") is df


def walked(tree, old, new):
    if isinstance(tree, str):
        return tree.replace(old, new)
    if isinstance(tree, list):
        return [walked(item, old, new) for item in tree]
    if isinstance(tree, dict):
        return {key: walked(item, old, new) for key, item in tree.items()}
    return tree


TREES = [
    {"Dev": "a Dev", "list": ["Dev", None, 1, [{"Dev": {"x": "Dev:Dev"}}]], "n": 1.5},
    {'q"Dev\\': 'say "Dev"', "b": "c:\\Dev\\", "c": "line\nDev\t\u0001", "d": "\\u0044ev", "e": ":Dev"},
    {"k": ["Dev", ":Dev", "", {"": "Dev"}], "colon": "Dev:", "é": "Grüße Dev 中 😀"},
    "Dev", "", [], {}, None, 12, True, "n", {"a": {"b": "long " * 20000 + 'Dev "\\"' * 5000}},
]


@pytest.mark.parametrize("old, new", [("Dev", "QA"), ("Dev", 'Q"A\\'), ("n", "N"), ('"', "'"), ("\\", "/"), ("u0", "x"), (":", ";"), ("", "x")])
def test_variants(spark, old, new):
    texts = [(i, json.dumps(tree, ensure_ascii=i % 2 == 0)) for i, tree in enumerate(TREES)]
    df = spark.createDataFrame([*texts, (99, None)], "i int, t string")
    df = df.select("i", F.parse_json("t").alias("v"), F.array(F.parse_json("t")).alias("a"))
    out = replace_text_deep(df, old, new)
    assert out.schema == df.schema
    got = {r["i"]: r for r in out.select("i", F.to_json("v").alias("v"), F.to_json(F.col("a")[0]).alias("a")).collect()}
    assert got.pop(99)[1:] == (None, None)
    for i, tree in enumerate(TREES):
        expected = walked(tree, old, new) if old else tree
        assert json.loads(got[i]["v"]) == json.loads(got[i]["a"]) == expected


def test_variants_of_other_types(spark):
    df = spark.sql(
        "select s, to_variant_object(named_struct('d', date'2024-01-02', 's', s, 'm', 1.25BD)) as v"
        " from values ('Dev'), ('other') as t(s)"
    )
    untouched = replace_text_deep(df.where("s = 'other'"), "Dev", "QA", ["v"])
    assert untouched.select(F.schema_of_variant("v")).head()[0] == "OBJECT<d: DATE, m: DECIMAL(3,2), s: STRING>"
    with pytest.raises(Exception, match="JSON has no type"):
        replace_text_deep(df, "Dev", "QA", ["v"]).collect()
