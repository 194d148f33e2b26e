"""The registered queries: every operator run over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import previous_quarter
from starloom.operators import archive, late, quality, scd2, star
from starloom.operators.buckets import create_buckets, load_buckets, read_buckets
from starloom.operators.calendar import date_dimension_over
from starloom.operators.distinct import distinct_counts, distinct_state, read_state, save_state
from starloom.operators.keys import assign_surrogate_keys
from starloom.operators.lookup import Lookup, resolve
from starloom.operators.nested import replace_text_deep
from starloom.operators.rule_state import rule_report, rule_state
from starloom.operators.validity import resolve_valid
from starloom.plans import inputs
from starloom.plans.inputs import COMPLETED, CUSTOMER_SPEC, SNAPSHOT_DAYS
from starloom.sources import read_csv_apart, read_table_list, schemas, write_csv
from starloom.sources.files import MALFORMED
from starloom.sources.scratch import materialize, scratch_path
from starloom.streaming import released_facts, start_late_feed

Query = Callable[[SparkSession, str], DataFrame]

ARCHIVE_AS_OF = "1998-02-10"
REPEATED_MONTH = "1998-02"
EXPIRY_NOW = "1999-03-15"
HISTORY_KEY = 27
BROKEN_EVERY = 97
DIMENSION_BUCKETS = 16
KEYWORD, REPLACEMENT = "e", "<E>"


# Calendar -------------------------------------------------------------------


def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over all order dates, with the number of orders of each day."""
    orders = inputs.table(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("calendar_date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    calendar = date_dimension_over(orders, "o_orderdate")
    return calendar.join(per_day, "calendar_date", "left").na.fill(0, ["orders"])


# Star schema ----------------------------------------------------------------


def fact_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = inputs.dimension_keys(spark, sf_dir, late_arrived=False)
    return star.load_fact(inputs.raw_orders(spark, sf_dir), keys, "keep")


def fact_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = inputs.dimension_keys(spark, sf_dir, late_arrived=False)
    return star.load_fact(inputs.raw_orders(spark, sf_dir), keys, "active")


def _net() -> Column:
    return inputs.money(F.col("unit_price")) - inputs.money(F.col("discount"))


def _as_double(report: DataFrame, *names: str) -> DataFrame:
    """Exact totals as the doubles they are reported in."""
    return report.withColumns({name: F.col(name).cast("double") for name in names})


def category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = inputs.product_dim(spark, sf_dir)
    fact = fact_keep(spark, sf_dir)
    report = star.category_revenue(fact, products, _net(), completed=COMPLETED)
    return _as_double(report, "total_amount")


def category_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = inputs.product_dim(spark, sf_dir)
    bought = inputs.table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") + 1).alias("product_sk")
    )
    report = star.category_sales(
        fact_active(spark, sf_dir), products, _net(), completed=COMPLETED, keys_from=bought
    )
    return _as_double(report, "total_sales_amount")


def customer_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = inputs.customer_dim(spark, sf_dir)
    price = inputs.money(F.col("unit_price"))
    report = star.customer_revenue(
        fact_keep(spark, sf_dir), customers, _net(), completed=COMPLETED, price=price
    )
    return _as_double(report, "total_amount", "max_price", "min_price")


def category_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each category from the bitmaps of each month, one of which is loaded twice."""
    sold = resolve(
        inputs.raw_orders(spark, sf_dir).select(
            "order_id", "product_id", F.date_format("date_id", "yyyy-MM").alias("month")
        ),
        [
            Lookup(
                inputs.product_dim(spark, sf_dir),
                {"product_id": "product_id"},
                ["category"],
                keys_from=inputs.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id")),
            )
        ],
    )
    state = distinct_state(sold, ["month", "category"], "order_id")
    path = scratch_path(spark, "orders-by-month")
    save_state(state, path, "month")
    again = sold.where(F.col("month") == REPEATED_MONTH)
    save_state(distinct_state(again, ["month", "category"], "order_id"), path, "month")
    return distinct_counts(read_state(spark, path, state), ["category"], "orders")


def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = inputs.customer_dim(spark, sf_dir)
    fact = fact_active(spark, sf_dir)
    report = star.top_customers(fact, customers, 5, _net(), completed=COMPLETED)
    return _as_double(report, "total_sales_amount")


def customer_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = inputs.customer_dim(spark, sf_dir)
    fact = fact_active(spark, sf_dir)
    report = star.top_customers(fact, customers, None, _net(), completed=COMPLETED)
    return _as_double(report, "total_sales_amount")


# Slowly changing dimension --------------------------------------------------


def _snapshot(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    return inputs.customer_snapshot(spark, sf_dir, SNAPSHOT_DAYS[number])


def dim_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.initial_dimension(_snapshot(spark, sf_dir, 0), CUSTOMER_SPEC, SNAPSHOT_DAYS[0])


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = inputs.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey"
    )
    order = ["c_mktsegment", "c_nationkey", "c_custkey"]
    return assign_surrogate_keys(customers, order, start=1000, sk="customer_sk")


def _classified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    dim = dim_initial(spark, sf_dir)
    return dim, scd2.classify_changes(_snapshot(spark, sf_dir, 1), dim, CUSTOMER_SPEC)


def scd2_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, classified = _classified(spark, sf_dir)
    return classified.select("customer_key", "prev_customer_sk", "change")


def scd2_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, classified = _classified(spark, sf_dir)
    return scd2.new_rows(classified).select(*CUSTOMER_SPEC.attributes)


def scd2_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, classified = _classified(spark, sf_dir)
    return scd2.expire_changed(classified, CUSTOMER_SPEC, SNAPSHOT_DAYS[1])


def scd2_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, classified = _classified(spark, sf_dir)
    last = scd2.max_key(dim, CUSTOMER_SPEC.sk)
    return scd2.build_inserts(classified, CUSTOMER_SPEC, SNAPSHOT_DAYS[1], last)


def scd2_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, classified = _classified(spark, sf_dir)
    return scd2.carry_unchanged(dim, classified, CUSTOMER_SPEC)


def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dim_initial(spark, sf_dir)
    return scd2.scd2_apply(dim, _snapshot(spark, sf_dir, 1), CUSTOMER_SPEC, SNAPSHOT_DAYS[1])


def scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = [(day, inputs.customer_snapshot(spark, sf_dir, day)) for day in SNAPSHOT_DAYS]
    return scd2.scd2_replay(dated, CUSTOMER_SPEC)


def scd2_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history, stored by bucket and loaded twice; the second load is repeated."""
    first, path = dim_initial(spark, sf_dir), scratch_path(spark, "buckets")
    store = create_buckets(first, path, CUSTOMER_SPEC, DIMENSION_BUCKETS, SNAPSHOT_DAYS[0])
    for number in (1, 2, 2):
        load_buckets(spark, store, _snapshot(spark, sf_dir, number), SNAPSHOT_DAYS[number])
    return read_buckets(spark, store)


def current_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.current_rows(scd2_replay(spark, sf_dir))


def key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.key_history(scd2_replay(spark, sf_dir), CUSTOMER_SPEC, HISTORY_KEY)


def fact_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer as known on the day of the order."""
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_day")
    )
    take = ["customer_sk", "customer_best_priority", "customer_credit_tier"]
    history = scd2_replay(spark, sf_dir)
    return resolve_valid(orders, history, "o_custkey", "order_day", take, version_key="customer_key")


# Late-arriving dimensions ---------------------------------------------------


def _cycle(spark: SparkSession, sf_dir: str, first: bool) -> DataFrame:
    early = F.col("date_id") < F.lit(inputs.LATE_CUT).cast("date")
    return inputs.raw_orders(spark, sf_dir).where(early if first else ~early)


def late_first_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = inputs.dimension_keys(spark, sf_dir, late_arrived=False)
    return star.load_fact(_cycle(spark, sf_dir, first=True), keys, "suspend")


def _first_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return late.split_suspended(
        late_first_cycle(spark, sf_dir), ["customer_sk", "product_sk"]
    )


def late_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_split(spark, sf_dir)[0]


def late_suspended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_split(spark, sf_dir)[1]


def late_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = inputs.dimension_keys(spark, sf_dir, late_arrived=True)
    return late.retry_suspended(late_suspended(spark, sf_dir), keys)


def _second_cycle(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    keys = inputs.dimension_keys(spark, sf_dir, late_arrived=True)
    new_raw = _cycle(spark, sf_dir, first=False)
    resolved = late.resolve_cycle(new_raw, late_suspended(spark, sf_dir), keys)
    return late.land_cycle(resolved, scratch_path(spark, "cycle"))


def late_next_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_cycle(spark, sf_dir)[0]


def late_still_suspended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_cycle(spark, sf_dir)[1]


def late_stream_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both cycles over a stream: all released facts, with the cycle that released them."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "feed")
    checkpoint = scratch_path(spark, "stream")
    for late_arrived in (False, True):
        arriving = _cycle(spark, sf_dir, first=not late_arrived)
        arriving.write.mode("append").parquet(landing)
        raw = spark.readStream.schema(arriving.schema).parquet(landing)

        def keys(session: SparkSession, late_arrived: bool = late_arrived) -> list[star.DimensionKey]:
            return inputs.dimension_keys(session, sf_dir, late_arrived)

        start_late_feed(raw, keys, root, checkpoint).awaitTermination()
    return released_facts(spark, root)


# Data quality ---------------------------------------------------------------


def _rules(spark: SparkSession, *ids: int) -> DataFrame:
    chosen = [rule for rule in inputs.DQ_RULES if not ids or rule[0] in ids]
    return spark.createDataFrame(chosen, schemas.DQ_RULES)


def _dq(*ids: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = inputs.checked_lines(spark, sf_dir)
        return quality.run_rules(lines, _rules(spark, *ids), write_once=True)

    return run


def dq_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from the stored state of two loads, of which the second came twice."""
    lines = materialize(inputs.checked_lines(spark, sf_dir), "checked")
    rules = quality.parse_rules(_rules(spark))
    path = scratch_path(spark, "rule-state")
    for load in ("F", "O", "O"):
        state = rule_state(lines.where(F.col("l_linestatus") == load), rules)
        state = state.withColumn("load", F.lit(load))
        save_state(state, path, "load")
    return rule_report(read_state(spark, path, state), rules)


def dq_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = quality.failing_rows(inputs.checked_lines(spark, sf_dir), _rules(spark))
    return failed.withColumn("failed_rules", F.array_join("failed_rules", ","))


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    (rule,) = quality.parse_rules(_rules(spark, 4))
    return quality.duplicate_values(inputs.table(spark, sf_dir, "lineitem"), rule)


# Archive --------------------------------------------------------------------


def previous_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("as_of")
    )
    start, end = previous_quarter(F.col("as_of"))
    return days.distinct().select("as_of", start.alias("qstart_date"), end.alias("qend_date"))


ARCHIVED = {"orders": "o_orderdate", "lineitem": "l_shipdate"}


def archive_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    out = scratch_path(spark, "archive")
    written = archive.archive_quarter(orders, "orders", "o_orderdate", ARCHIVE_AS_OF, out)
    return archive.read_archive(spark, written)


def archive_by_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of every table a control file lists, found by its partition column."""
    name = f"orders_by_month_{uuid.uuid4().hex}"
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    orders = inputs.table(spark, sf_dir, "orders").withColumn("order_month", month)
    listed = scratch_path(spark, "control")
    write_csv(spark.createDataFrame([(name,)], "table_name STRING"), listed)
    writer = orders.hint("rebalance", "order_month").write.partitionBy("order_month")
    writer.option("path", scratch_path(spark, "table")).saveAsTable(name)
    try:
        tables = read_table_list(spark, listed)
        out = scratch_path(spark, "archive")
        done = archive.archive_tables(spark, tables, ARCHIVE_AS_OF, out)
    finally:
        spark.sql(f"drop table {name}")
    return reduce(DataFrame.unionByName, [archive.read_archive(spark, one) for one in done])


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV, some with a broken customer, read back and told apart."""
    orders = inputs.table(spark, sf_dir, "orders")
    broken = F.concat(F.lit("C-"), F.col("o_custkey"))
    feed = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % BROKEN_EVERY == 0, broken)
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("o_custkey"),
        "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
    )
    path = scratch_path(spark, "feed")
    write_csv(feed, path)
    good, bad = read_csv_apart(
        spark, path, "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_orderdate DATE"
    )
    line = F.col(MALFORMED)
    return good.withColumn(MALFORMED, F.lit(None).cast("string")).unionByName(
        bad.select(
            F.split_part(line, F.lit(","), F.lit(1)).cast("long").alias("o_orderkey"),
            F.lit(None).cast("long").alias("o_custkey"),
            F.lit(None).cast("string").alias("o_orderstatus"),
            F.lit(None).cast("date").alias("o_orderdate"),
            MALFORMED,
        )
    )


def archive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of two archives, each checked against the rows it came from."""
    out = scratch_path(spark, "archive")
    written, sources = [], []
    for name, column in ARCHIVED.items():
        rows = inputs.table(spark, sf_dir, name)
        done = archive.archive_quarter(rows, name, column, ARCHIVE_AS_OF, out)
        kept = archive.rows_between(rows, column, done.start, done.end)
        written.append(done)
        sources.append(
            kept.agg(archive.checksum(kept).alias("source")).withColumn("of", F.lit(done.name))
        )
    manifest = archive.archive_manifest(spark, written, ARCHIVE_AS_OF)
    expected = sources[0].unionByName(sources[1])
    return manifest.join(expected, F.col("archive_name") == F.col("of")).select(
        "table_name",
        "archive_name",
        "quarter_start",
        "quarter_end",
        "row_count",
        (F.col("checksum") == F.col("source")).alias("intact"),
        "expires_at",
    )


def expired_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What could be dropped if every quarter of orders had been archived at its end."""
    quarter = F.trunc(F.col("o_orderdate").cast("date"), "quarter")
    end = F.date_sub(F.add_months(F.col("quarter_start"), 3), 1)
    manifest = (
        inputs.table(spark, sf_dir, "orders")
        .groupBy(quarter.alias("quarter_start"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("quarter_end", end)
        .withColumn(
            "expires_at",
            F.date_add("quarter_end", archive.RETENTION_DAYS).cast("timestamp_ntz"),
        )
        .withColumn(
            "archive_name",
            F.concat_ws(
                "_",
                F.lit("orders_snapshot"),
                F.date_format("quarter_start", "yyyyMMdd"),
                F.date_format("quarter_end", "yyyyMMdd"),
            ),
        )
    )
    return archive.expired_archives(manifest, EXPIRY_NOW)


def archive_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter that comes into its working copy in two loads, one of them repeated."""
    orders = inputs.table(spark, sf_dir, "orders")
    out = scratch_path(spark, "archive")
    for load, part in (("even", 0), ("odd", 1), ("even", 0)):
        rows = orders.where(F.pmod("o_orderkey", F.lit(2)) == part)
        done = archive.archive_quarter(
            rows, "orders", "o_orderdate", ARCHIVE_AS_OF, out, kind="copy", load=load
        )
    return archive.read_archive(spark, done)


def archive_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarter of orders archived and noted, and what could be deleted later.

    The last two quarters also have working copies, and a run that failed has left a
    copy of the first one which no manifest row names.
    """
    orders = inputs.table(spark, sf_dir, "orders")
    out, log = scratch_path(spark, "archive"), scratch_path(spark, "manifest")
    day = F.col("o_orderdate").cast("date")
    ends = orders.select(F.add_months(F.trunc(day, "quarter"), 3).alias("day")).distinct()
    days = sorted(row["day"] for row in ends.collect())
    made = archive.archive_quarters(spark, orders, "orders", "o_orderdate", days, out)
    made += archive.archive_quarters(spark, orders, "orders", "o_orderdate", days[-2:], out, "copy")
    if failed := [one for one in made if one.error]:
        raise RuntimeError(f"{len(failed)} archives failed, first {failed[0]}")
    archive.archive_quarter(orders, "orders", "o_orderdate", days[0], out, kind="copy")
    done = archive.done_archives(spark, out)
    archive.store_manifest(archive.archive_manifest(spark, done), log)
    can_go = [copy.name for copy in archive.droppable_copies(done, done)]
    swept = archive.sweep(spark, out, log, EXPIRY_NOW)
    return swept.withColumn("droppable_copy", F.col("archive_name").isin(can_go))


# Nested records -------------------------------------------------------------


def replace_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rewritten = replace_text_deep(
        inputs.nested_events(spark, sf_dir), KEYWORD, REPLACEMENT, ["record"]
    )
    record = F.col("record")
    labels = record.getField("labels")
    return rewritten.select(
        "event_id",
        "event_type",
        record.getField("name").alias("name"),
        F.array_join(record.getField("tags"), "|").alias("tags"),
        F.map_keys(labels)[0].alias("label_key"),
        F.map_values(labels)[0].alias("label_value"),
        record.getField("user_id").alias("user_id"),
    )


def replace_text_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in untyped trees: an event's properties as they came, within a tree of its own."""
    e = F.col("event_type").alias("e")
    tree = F.struct(
        F.col("event_type").alias("name"),
        F.array(
            F.struct(F.col("props").alias("text"), F.col("user_id").alias("user"), e),
            F.struct(F.lit(None).cast("string").alias("text"), F.col("user_id").alias("user"), e),
        ).alias("entries"),
        F.parse_json("props").alias("props"),
    )
    events = inputs.table(spark, sf_dir, "events")
    trees = events.select("event_id", "event_type", F.to_variant_object(tree).alias("tree"))

    def at(path: str, kind: str) -> Column:
        return F.variant_get("tree", path, kind)

    return replace_text_deep(trees, KEYWORD, REPLACEMENT, ["tree"]).select(
        "event_id",
        "event_type",
        at("$.name", "string").alias("name"),
        at("$.entries[0].text", "string").alias("text"),
        at("$.entries[0].user", "long").alias("user_id"),
        at("$.entries[1].e", "string").alias("label"),
        at("$.props.k", "long").alias("k"),
    )


QUERIES: dict[str, Query] = {
    "date_dimension": date_dimension,
    "fact_keep": fact_keep,
    "fact_active": fact_active,
    "category_revenue": category_revenue,
    "category_sales": category_sales,
    "customer_revenue": customer_revenue,
    "top_customers": top_customers,
    "category_orders": category_orders,
    "customer_ranking": customer_ranking,
    "dim_initial": dim_initial,
    "surrogate_keys": surrogate_keys,
    "scd2_classify": scd2_classify,
    "scd2_new_rows": scd2_new_rows,
    "scd2_expired": scd2_expired,
    "scd2_inserts": scd2_inserts,
    "scd2_unchanged": scd2_unchanged,
    "scd2_apply": scd2_apply,
    "scd2_replay": scd2_replay,
    "scd2_buckets": scd2_buckets,
    "current_rows": current_rows,
    "key_history": key_history,
    "fact_valid": fact_valid,
    "late_first_cycle": late_first_cycle,
    "late_ready": late_ready,
    "late_suspended": late_suspended,
    "late_retry": late_retry,
    "late_next_cycle": late_next_cycle,
    "late_still_suspended": late_still_suspended,
    "late_stream_cycles": late_stream_cycles,
    "dq_completeness": _dq(1),
    "dq_regex": _dq(2),
    "dq_range": _dq(3, 6),
    "dq_uniqueness": _dq(4),
    "dq_consistency": _dq(5),
    "dq_report": _dq(),
    "dq_by_load": dq_by_load,
    "dq_failing_rows": dq_failing_rows,
    "dq_duplicates": dq_duplicates,
    "previous_quarter": previous_quarters,
    "archive_quarter": archive_quarter,
    "archive_append": archive_append,
    "archive_by_catalog": archive_by_catalog,
    "archive_cycle": archive_cycle,
    "archive_manifest": archive_manifest,
    "csv_round_trip": csv_round_trip,
    "expired_archives": expired_archives,
    "replace_text_deep": replace_text,
    "replace_text_variant": replace_text_variant,
}
