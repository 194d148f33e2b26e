from __future__ import annotations

import os
import shutil

import pytest

import samples
from starloom.streaming import release_waiting, released_facts, start_late_feed
from test_star import keys


def test_cycles_of_a_stream(spark, scratch):
    landing, root, checkpoint = (f"{scratch}/{name}" for name in ("in", "out", "check"))
    first = samples.orders(spark, samples.ORDERS, samples.LATE_ORDERS)
    first.coalesce(1).write.parquet(landing)
    raw = spark.readStream.schema(first.schema).parquet(landing)

    def run(late):
        def current(session):
            return keys(session, samples.customers(session, late), samples.products(session, late))

        query = start_late_feed(raw, current, root, checkpoint)
        query.awaitTermination()

    run(late=False)
    assert released_facts(spark, root).count() == 15

    samples.orders(spark, samples.NEXT_ORDERS).coalesce(1).write.mode("append").parquet(landing)
    run(late=True)
    released = released_facts(spark, root)
    assert released.count() == released.select("order_id").distinct().count() == 21
    second = released.where("cycle = 1").orderBy("order_id").collect()
    assert [(r["order_id"], r["customer_sk"], r["product_sk"], r["date_sk"]) for r in second] == [
        ("O1016", 6, 6, 376), ("O1017", 7, 7, 377), ("O1018", 8, 8, 378),
        ("O1019", 1, 1, 435), ("O1020", 2, 2, 436), ("O1021", 3, 3, 437),
    ]

    run(late=True)
    assert released_facts(spark, root).count() == 21


def test_facts_are_released_without_new_ones(spark, scratch):
    landing, root = f"{scratch}/in", f"{scratch}/out"
    first = samples.orders(spark, samples.ORDERS, samples.LATE_ORDERS)
    first.coalesce(1).write.parquet(landing)
    raw = spark.readStream.schema(first.schema).parquet(landing)

    def late(session):
        return keys(session, samples.customers(session, True), samples.products(session, True))

    assert release_waiting(raw, keys, root) == 0
    start_late_feed(raw, keys, root, f"{scratch}/check").awaitTermination()
    assert release_waiting(raw, keys, root) == 0
    assert released_facts(spark, root).count() == 15
    assert release_waiting(raw, late, root) == 3
    assert release_waiting(raw, late, root) == 0
    samples.orders(spark, samples.NEXT_ORDERS).coalesce(1).write.mode("append").parquet(landing)
    start_late_feed(raw, late, root, f"{scratch}/check").awaitTermination()
    released = released_facts(spark, root)
    assert released.count() == released.select("order_id").distinct().count() == 21


def test_another_streams_root_is_refused(spark, scratch):
    landing, root = f"{scratch}/in", f"{scratch}/out"
    first = samples.orders(spark, samples.ORDERS)
    first.coalesce(1).write.parquet(landing)
    raw = spark.readStream.schema(first.schema).parquet(landing)
    start_late_feed(raw, keys, root, f"{scratch}/check").awaitTermination()
    before = released_facts(spark, root).count()
    with pytest.raises(ValueError, match="belongs to the stream"):
        start_late_feed(raw, keys, root, f"{scratch}/other")
    assert released_facts(spark, root).count() == before


@pytest.mark.parametrize("lost", ["stream commit", "commit record"])
def test_a_replayed_batch_releases_nothing_twice(spark, scratch, lost):
    """The driver dies after a batch landed; dimensions arrive; the stream replays the batch."""
    landing, root, checkpoint = (f"{scratch}/{name}" for name in ("in", "out", "check"))
    first = samples.orders(spark, samples.ORDERS, samples.LATE_ORDERS)
    first.coalesce(1).write.parquet(landing)
    raw = spark.readStream.schema(first.schema).parquet(landing)

    def late(session):
        return keys(session, samples.customers(session, True), samples.products(session, True))

    start_late_feed(raw, keys, root, checkpoint).awaitTermination()
    for name in ("0", ".0.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    if lost == "commit record":
        shutil.rmtree(f"{root}/_commits/0")
        # What is not committed is neither released nor retried.
        assert released_facts(spark, root).count() == 0
    assert release_waiting(raw, late, root) == (3 if lost == "stream commit" else 0)
    start_late_feed(raw, late, root, checkpoint).awaitTermination()
    released = released_facts(spark, root)
    assert released.count() == released.select("order_id").distinct().count() == 18
    assert release_waiting(raw, late, root) == 0
    samples.orders(spark, samples.NEXT_ORDERS).coalesce(1).write.mode("append").parquet(landing)
    start_late_feed(raw, late, root, checkpoint).awaitTermination()
    released = released_facts(spark, root)
    assert released.count() == released.select("order_id").distinct().count() == 21


def test_a_release_given_up_counts_for_nobody(spark, scratch):
    landing, root, checkpoint = (f"{scratch}/{name}" for name in ("in", "out", "check"))
    first = samples.orders(spark, samples.ORDERS, samples.LATE_ORDERS)
    first.coalesce(1).write.parquet(landing)
    raw = spark.readStream.schema(first.schema).parquet(landing)

    def late(session):
        return keys(session, samples.customers(session, True), samples.products(session, True))

    start_late_feed(raw, keys, root, checkpoint).awaitTermination()
    assert release_waiting(raw, late, root) == 3
    shutil.rmtree(f"{root}/_commits/0/1")
    assert released_facts(spark, root).count() == 15
    samples.orders(spark, samples.NEXT_ORDERS).coalesce(1).write.mode("append").parquet(landing)
    start_late_feed(raw, late, root, checkpoint).awaitTermination()
    released = released_facts(spark, root)
    assert released.count() == released.select("order_id").distinct().count() == 21
