from __future__ import annotations

import datetime as dt

import samples
from pyspark.sql import functions as F

from starloom.operators import late, star
from test_star import keys

NAMES = ["customer_sk", "product_sk"]


def first_cycle(spark, **dims):
    raw = samples.orders(spark, samples.ORDERS, samples.LATE_ORDERS)
    return star.load_fact(raw, keys(spark, **dims), "suspend")


def arrived(spark):
    return keys(spark, samples.customers(spark, late=True), samples.products(spark, late=True))


def test_two_cycles_of_the_sample(spark):
    ready, suspended = late.split_suspended(first_cycle(spark), NAMES)
    assert ready.count() == 15
    assert sorted(r["order_id"] for r in suspended.collect()) == ["O1016", "O1017", "O1018"]
    assert not suspended.where("processed_flag").count()

    retried = late.retry_suspended(suspended, arrived(spark))
    assert retried.columns == suspended.columns
    assert retried.where("processed_flag").count() == 3

    facts, still = late.next_cycle(
        samples.orders(spark, samples.NEXT_ORDERS), suspended, arrived(spark)
    )
    got = [
        (r["order_id"], r["customer_sk"], r["product_sk"], r["date_sk"])
        for r in facts.orderBy("order_id").collect()
    ]
    assert got == [
        ("O1016", 6, 6, 376), ("O1017", 7, 7, 377), ("O1018", 8, 8, 378),
        ("O1019", 1, 1, 435), ("O1020", 2, 2, 436), ("O1021", 3, 3, 437),
    ]
    assert still.count() == 0


def test_inactive_dimension_suspends(spark):
    customers = samples.customers(spark).withColumn("is_active", F.col("customer_id") != "C003")
    ready, suspended = late.split_suspended(first_cycle(spark, customers=customers), NAMES)
    assert ready.count() + suspended.count() == 18
    assert suspended.where("customer_id = 'C003'").count() == 3


def test_unresolved_facts_wait_on(spark):
    _, suspended = late.split_suspended(first_cycle(spark), NAMES)
    only_customers = keys(spark, samples.customers(spark, late=True))
    new = samples.orders(spark, samples.NEXT_ORDERS.replace("O1020,C002", "O1020,C999"))
    facts, still = late.next_cycle(new, suspended, only_customers)
    assert sorted(r["order_id"] for r in facts.collect()) == ["O1019", "O1021"]
    assert sorted(r["order_id"] for r in still.collect()) == ["O1016", "O1017", "O1018", "O1020"]
    # The same suspense table without what was released: nothing comes out twice.
    again, rest = late.next_cycle(new.limit(0), still, arrived(spark))
    assert sorted(r["order_id"] for r in again.collect()) == ["O1016", "O1017", "O1018"]
    assert [r["order_id"] for r in rest.collect()] == ["O1020"]
    last, _ = late.next_cycle(new.limit(0), rest, arrived(spark))
    assert last.count() == 0


def test_processed_facts_are_not_retried(spark):
    _, suspended = late.split_suspended(first_cycle(spark), NAMES)
    done = late.retry_suspended(suspended, arrived(spark))
    assert late.retry_suspended(done, arrived(spark)).count() == 0


def test_exact_duplicates_are_loaded_once(spark):
    _, none = late.split_suspended(first_cycle(spark).limit(0), NAMES)
    twice = samples.orders(spark, samples.NEXT_ORDERS, samples.NEXT_ORDERS)
    facts, _ = late.next_cycle(twice, none, arrived(spark))
    assert facts.count() == 3


def test_date_never_suspends_by_default(spark):
    raw = samples.orders(spark).withColumn("date_id", F.lit("2030-01-01").cast("date"))
    fact = star.load_fact(raw, keys(spark), "suspend")
    assert late.split_suspended(fact, late.required_keys(keys(spark)))[1].count() == 0
    assert late.split_suspended(fact, [*NAMES, "date_sk"])[1].count() == 15


def test_waiting_since(spark):
    day, later = dt.date(2026, 1, 31), dt.date(2026, 3, 31)
    _, suspended = late.split_suspended(first_cycle(spark), NAMES, first_seen=day)
    new = samples.orders(spark, samples.NEXT_ORDERS.replace("P002", "P999"))
    facts, still = late.next_cycle(new, suspended, keys(spark), first_seen=later)
    seen = {r["order_id"]: r["first_seen"] for r in still.collect()}
    assert seen == {"O1016": day, "O1017": day, "O1018": day, "O1020": later}
    assert "first_seen" not in facts.columns


def test_landing_writes_once_and_splits_by_partition(spark, scratch):
    _, suspended = late.split_suspended(first_cycle(spark), NAMES)
    new = samples.orders(spark, samples.NEXT_ORDERS)
    resolved = late.resolve_cycle(new, suspended, keys(spark))
    ready, still = late.land_cycle(resolved, f"{scratch}/cycle")
    facts, waiting = late.split_cycle(resolved)
    assert sorted(ready.collect()) == sorted(facts.collect())
    assert sorted(still.collect()) == sorted(waiting.collect())
    assert still.schema.names == suspended.schema.names


def test_facts_without_a_flag_still_wait(spark):
    _, suspended = late.split_suspended(first_cycle(spark), NAMES)
    unflagged = suspended.withColumn("processed_flag", F.lit(None).cast("boolean"))
    assert late.retry_suspended(unflagged, arrived(spark)).count() == suspended.count() == 3
    new = samples.orders(spark, samples.NEXT_ORDERS)
    facts, still = late.next_cycle(new, unflagged, keys(spark))
    assert facts.count() + still.count() == new.count() + 3
    released, waiting = late.split_cycle(unflagged)
    assert (released.count(), waiting.count()) == (0, 3)


def test_one_side_may_have_no_date_of_first_sight(spark):
    new = samples.orders(spark, samples.NEXT_ORDERS.replace("O1020,C002", "O1020,C999"))
    for before, now in ((None, "2026-03-01"), ("2026-02-01", None)):
        _, suspended = late.split_suspended(first_cycle(spark), NAMES, before)
        facts, still = late.next_cycle(new, suspended, keys(spark), now)
        seen = {r["order_id"]: r["first_seen"] and str(r["first_seen"]) for r in still.collect()}
        assert seen == {"O1020": now, **{o: before for o in ("O1016", "O1017", "O1018")}}
        assert facts.count() == 2


def test_a_repeated_cycle_replaces_all_its_partitions(spark, scratch):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for found in (keys(spark), arrived(spark)):
            raw = samples.orders(spark, samples.ORDERS, samples.LATE_ORDERS)
            resolved = late.resolve_cycle(raw, None, found)
            ready, waiting = late.land_cycle(resolved, f"{scratch}/cycle", "overwrite")
        assert (ready.count(), waiting.count()) == (18, 0)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
