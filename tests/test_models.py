"""Random small inputs against plain Python models of the same operators."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from starloom.operators import late, quality, scd2, star
from starloom.operators.lookup import Lookup, resolve
from starloom.operators.scd2 import ScdSpec
from starloom.operators.star import DimensionKey
from starloom.sources import schemas

OPEN = dt.date(9999, 12, 31)
DAYS = [dt.date(2024, month, 1) for month in (1, 2, 3, 4)]
SPEC = ScdSpec(
    rename={"k": "key", "a": "tracked_a", "b": "tracked_b", "c": "other"},
    key="key",
    tracked=("tracked_a", "tracked_b"),
    sk="sk",
)


def random_snapshots(rng):
    """Keys come, go and return; attributes change, also from and to NULL."""
    for _ in DAYS:
        keys = rng.sample(range(40), rng.randint(5, 35))
        yield [
            (k, rng.choice(["x", "y", None]), rng.choice([1.0, None]), rng.choice("pqr"))
            for k in keys
        ]


def model_history(snapshots):
    """Versions as ``[sk, key, a, b, c, from, to, current]``, one snapshot at a time."""
    versions, current = [], {}
    for day, rows in zip(DAYS, snapshots):
        for key, a, b, c in sorted(rows):
            old = current.get(key)
            if old is not None and (old[2], old[3]) == (a, b):
                continue
            if old is not None:
                old[6:] = [day - dt.timedelta(days=1), False]
            current[key] = [len(versions) + 1, key, a, b, c, day, OPEN, True]
            versions.append(current[key])
    return versions


@pytest.mark.parametrize("seed", range(3))
def test_history(spark, seed):
    snapshots = list(random_snapshots(random.Random(seed)))
    frames = [spark.createDataFrame(rows, "k INT, a STRING, b DOUBLE, c STRING") for rows in snapshots]
    expected = model_history(snapshots)
    replayed = scd2.scd2_replay(list(zip(DAYS, frames)), SPEC)
    assert [list(r) for r in replayed.orderBy("sk").collect()] == expected
    dim = scd2.initial_dimension(frames[0], SPEC, DAYS[0])
    for day, frame in zip(DAYS[1:], frames[1:]):
        dim = scd2.scd2_apply(dim, frame, SPEC, day)
    assert [list(r) for r in dim.orderBy("sk").collect()] == expected


@pytest.mark.parametrize("seed", range(3))
def test_late_cycles(spark, seed):
    """Three cycles with ever more dimension rows, some of them inactive."""
    rng = random.Random(seed)
    rows = [
        [(cycle * 100 + i, rng.randint(0, 9), rng.randint(0, 9)) for i in range(30)]
        for cycle in range(3)
    ]
    rows[1] += rows[1][:5]
    dims = [
        [(k, 100 + k, rng.random() < 0.8) for k in range(10) if rng.random() < 0.4 + 0.3 * cycle]
        for cycle in range(3)
    ]
    suspended, waiting = None, []
    for cycle in range(3):
        dim = spark.createDataFrame(dims[cycle], "id INT, sk INT, is_active BOOLEAN")
        keys = [
            DimensionKey(dim.withColumnRenamed("sk", f"{side}_sk"), "id", f"{side}_sk", side)
            for side in ("left", "right")
        ]
        new = spark.createDataFrame(rows[cycle], "order_id INT, left INT, right INT")
        ready, suspended = late.next_cycle(new, suspended, keys)
        active = {k: sk for k, sk, on in dims[cycle] if on}
        todo = set(rows[cycle]) | set(waiting)
        done = {r for r in todo if r[1] in active and r[2] in active}
        waiting = sorted(todo - done)
        got = sorted(tuple(r) for r in ready.collect())
        assert got == sorted((*r, active[r[1]], active[r[2]]) for r in done)
        left = sorted(tuple(r)[:3] for r in suspended.collect())
        assert left == waiting
        suspended = spark.createDataFrame(suspended.collect(), suspended.schema)


@pytest.mark.parametrize("seed", range(2))
def test_lookup(spark, seed):
    rng = random.Random(seed)
    facts = [(i, rng.choice([3, 3, 3, None, rng.randint(0, 50)])) for i in range(500)]
    dim = [(k, rng.choice(["v", None])) for k in range(0, 50, 2)]
    rows = spark.createDataFrame(facts, "i INT, k INT").repartition(20)
    table = spark.createDataFrame(dim, "key INT, v STRING")
    known = dict(dim)
    for how in ("left", "inner"):
        expected = [(i, k, known.get(k)) for i, k in facts if how == "left" or k in known]
        for limit in (-1, 10**9):
            found = resolve(rows, [Lookup(table, {"k": "key"}, ["v"], how)], limit, hot_rows=60)
            assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_quality_counts(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice([None, "ab", "b1", ""]), rng.choice([None, *range(-3, 12)]), rng.choice("xyz"),
         rng.choice([None, "1", "2"]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "t STRING, n INT, p STRING, q STRING")
    rules = spark.createDataFrame(
        [
            (1, "t", "completeness", "NOT_NULL", None, None),
            (2, "t", "accuracy", "REGEX:^a", None, None),
            (3, "n", "accuracy", "RANGE:0:9", None, None),
            (4, "p,q", "consistency", "MAP:x=1,2;y=2", None, None),
            (5, "n,q", "uniqueness", "UNIQUE", None, None),
        ],
        schemas.DQ_RULES,
    )
    pairs = {("x", "1"), ("x", "2"), ("y", "2")}
    keyed = [(r[1], r[3]) for r in rows if r[1] is not None and r[3] is not None]
    expected = {
        1: sum(r[0] is None for r in rows),
        2: sum(r[0] is not None and not r[0].startswith("a") for r in rows),
        3: sum(r[1] is not None and not 0 <= r[1] <= 9 for r in rows),
        4: sum(r[3] is not None and (r[2], r[3]) not in pairs for r in rows),
        5: sum(keyed.count(value) > 1 for value in set(keyed)),
    }
    found = {r["rule_id"]: r["failed_count"] for r in quality.run_rules(df, rules).collect()}
    assert found == expected


def test_reports_from_sql(spark):
    """The report operators against SQL text over the same frames."""
    rng = random.Random(2)
    facts = [
        (i // 3, rng.randint(1, 6), rng.randint(1, 4), rng.randint(1, 5), rng.randint(1, 900) / 4,
         rng.randint(0, 8) / 4, rng.choice(["COMPLETED", "PENDING"]))
        for i in range(300)
    ]
    fact = spark.createDataFrame(
        facts,
        "order_id INT, customer_sk INT, product_sk INT, quantity INT, unit_price DOUBLE, "
        "discount DOUBLE, status STRING",
    )
    product = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "product_sk INT, category STRING")
    customer = spark.createDataFrame(
        [(i, f"name {i}") for i in range(1, 6)], "customer_sk INT, customer_name STRING"
    )
    by_category = spark.sql(
        """select p.category as product_category, sum(f.quantity) as total_quantity,
                  sum(f.unit_price - f.discount) as total_sales_amount,
                  count(distinct f.order_id) as order_count
           from {fact} f join {product} p on f.product_sk = p.product_sk
           where f.status = 'COMPLETED' group by p.category""",
        fact=fact, product=product,
    )
    assert sorted(star.category_sales(fact, product).collect()) == sorted(by_category.collect())
    ranked = spark.sql(
        """select c.customer_sk, c.customer_name, count(f.order_id) as order_count,
                  sum(f.unit_price - f.discount) as total_sales_amount,
                  avg(f.unit_price - f.discount) as average_sales_amount,
                  sum(f.quantity) as total_quantity_purchased
           from {fact} f join {customer} c on f.customer_sk = c.customer_sk
           where f.status = 'COMPLETED' group by all
           order by total_sales_amount desc, c.customer_sk limit 3""",
        fact=fact, customer=customer,
    )
    assert star.top_customers(fact, customer, 3).collect() == ranked.collect()
