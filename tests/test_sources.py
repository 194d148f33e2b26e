from __future__ import annotations

from pathlib import Path

import pytest

from starloom.sources import materialize, read_csv, read_csv_apart, read_table_list, schemas, write_csv
from starloom.sources.scratch import scratch_path, scratch_root


def put(folder: str, name: str, text: str) -> str:
    path = Path(folder) / name
    path.write_text(text)
    return str(path)


def test_csv_with_declared_schema(spark, scratch):
    path = put(
        scratch, "orders.csv",
        "order_id,customer_id,product_id,date_id,quantity,unit_price,Discount,Status\n"
        "O1,C1,P1,2026-01-01,1,80000.00,120.00,COMPLETED\n",
    )
    read = read_csv(spark, path, schemas.ORDER_DETAILS)
    assert read.columns[-2:] == ["discount", "status"]
    row = read.head()
    assert (str(row["date_id"]), row["unit_price"], row["discount"]) == ("2026-01-01", 80000.0, 120.0)
    write_csv(read, f"{scratch}/out")
    assert read_csv(spark, f"{scratch}/out", schemas.ORDER_DETAILS).collect() == [row]


def test_swapped_columns_fail(spark, scratch):
    path = put(
        scratch, "rules.csv",
        "column_name,rule_id,rule_type,rule_value,severity,description\nage,1,a,b,c,d\n",
    )
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, schemas.DQ_RULES).collect()


def test_quoted_rule_values(spark, scratch):
    path = put(
        scratch, "rules.csv",
        "rule_id,column_name,rule_type,rule_value,severity,description\n"
        '5,"country,state",consistency,"MAP:India=MP;USA=CA,TX",MEDIUM,Valid country-state mapping\n',
    )
    row = read_csv(spark, path, schemas.DQ_RULES).head()
    assert (row["column_name"], row["rule_value"]) == ("country,state", "MAP:India=MP;USA=CA,TX")


def test_table_list(spark, scratch):
    path = put(scratch, "tables.csv", "table,owner\norders,a\nlineitem,b\n")
    assert read_table_list(spark, path) == ["orders", "lineitem"]
    long = put(scratch, "long.csv", "table\n" + "\n".join(f"t{i}" for i in range(10_001)) + "\n")
    assert read_table_list(spark, long) == [f"t{i}" for i in range(10_001)]


def test_malformed_lines_fail_or_are_set_apart(spark, scratch):
    path = put(scratch, "feed.csv", "a,b\n1,2\nx,3\n5,6,7\n8\n9,10\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, path, "a INT, b INT").select("b").collect()
    good, bad = read_csv_apart(spark, path, "a INT, b INT")
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2), (9, 10)]
    assert sorted(r["malformed_line"] for r in bad.collect()) == ["5,6,7", "8", "x,3"]
    assert good.count() + bad.count() == 5


def test_scratch_is_the_checkpoint_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    stored = materialize(spark.range(10), "ten")
    assert stored.count() == 10
    assert all(scratch_root(spark) in name for name in stored.inputFiles())
