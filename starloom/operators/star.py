"""Fact loads into a star schema, and the sales reports over it."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numbers import mean_of, sum_of
from starloom.operators.lookup import Lookup, resolve

MODES = ("keep", "active", "suspend")


@dataclass(frozen=True)
class DimensionKey:
    """One surrogate key to look up for a fact.

    ``fact_key`` names the natural key in the facts if it differs from
    ``natural_key``, its name in ``dim``. ``active`` is the dimension's boolean
    flag, if it has one. A date dimension is not ``required``: facts may lack
    it. With ``latest_by`` a dimension with several rows per key is reduced to
    the latest row; without, such a dimension is refused, as it would multiply
    facts, unless ``unique`` vouches for its keys. ``keys_from`` is where to look
    for frequent keys, see :class:`~starloom.operators.lookup.Lookup`.
    """

    dim: DataFrame
    natural_key: str
    sk: str
    fact_key: str | None = None
    active: str | None = "is_active"
    required: bool = True
    latest_by: str | None = None
    unique: bool = False
    keys_from: DataFrame | None = None

    @property
    def on(self) -> str:
        return self.fact_key or self.natural_key


def load_fact(raw: DataFrame, keys: Sequence[DimensionKey], mode: str = "keep") -> DataFrame:
    """Replace the natural keys of ``raw`` by surrogate keys.

    ``keep``     every fact, all dimension rows; unmatched keys are NULL.
    ``active``   only facts whose required dimensions exist and are active.
    ``suspend``  every fact with its natural keys kept; rows flagged inactive
                 count as missing, rows without a flag as active.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode}")
    lookups = [
        Lookup(
            _usable(key, mode),
            {key.on: key.natural_key},
            [key.sk],
            how="inner" if mode == "active" and key.required else "left",
            check_unique=key.latest_by is None and not key.unique,
            keys_from=key.keys_from,
        )
        for key in keys
    ]
    natural = [key.on for key in keys]
    kept = [name for name in raw.columns if mode == "suspend" or name not in natural]
    return resolve(raw, lookups).select(*kept, *[key.sk for key in keys])


def category_revenue(
    fact: DataFrame,
    product: DataFrame,
    amount: Column | None = None,
    completed: str = "COMPLETED",
    sk: str = "product_sk",
    category: str = "category",
) -> DataFrame:
    """Revenue of completed orders by product category.

    Sales are summed per product before the join, which so moves one row per
    product and not the sales of a best-seller. A product must have one row.
    """
    sold = _completed(fact, completed, sk).select(sk, _amount(amount).alias("amount"))
    per_product = sold.groupBy(sk).agg(sum_of(sold, F.col("amount")).alias("amount"))
    labelled = _labelled(per_product, product, sk, category)
    return labelled.groupBy(category).agg(
        sum_of(per_product, F.col("amount")).alias("total_amount")
    )


def category_sales(
    fact: DataFrame,
    product: DataFrame,
    amount: Column | None = None,
    completed: str = "COMPLETED",
    sk: str = "product_sk",
    category: str = "category",
    order_id: str = "order_id",
    quantity: str = "quantity",
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Quantity, revenue and number of orders by product category.

    Sales are labelled as they are and only then summed: hardly any two are of one
    product and order, so a row for each would be nearly as many, held in memory
    besides the (category, order) pairs. A product must have one row. Where products
    are too many to broadcast, best-sellers are looked for in ``keys_from``, a frame
    with the column ``sk``; the fact itself is not run a second time for that, so
    without it skew is left to Spark. Spark deduplicates (category, order) pairs
    before counting them, so one large category is spread over tasks.
    """
    sold = _completed(fact, completed, sk).select(
        sk, order_id, quantity, _amount(amount).alias("amount")
    )
    labelled = _labelled(sold, product, sk, category, keys_from)
    return labelled.groupBy(F.col(category).alias("product_category")).agg(
        sum_of(sold, F.col(quantity)).alias("total_quantity"),
        sum_of(sold, F.col("amount")).alias("total_sales_amount"),
        F.countDistinct(order_id).alias("order_count"),
    )


def customer_revenue(
    fact: DataFrame,
    customer: DataFrame,
    amount: Column | None = None,
    completed: str = "COMPLETED",
    sk: str = "customer_sk",
    name: str = "customer_name",
    price: str | Column = "unit_price",
) -> DataFrame:
    """Revenue and average, highest and lowest unit price by customer, who must have one row."""
    price = F.col(price) if isinstance(price, str) else price
    sold = _completed(fact, completed, sk).select(
        sk, price.alias("price"), _amount(amount).alias("amount")
    )
    profile = sold.groupBy(sk).agg(
        sum_of(sold, F.col("amount")).alias("total_amount"),
        mean_of(sold, F.col("price")).alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
    )
    return _named(profile, customer, sk, name)


def top_customers(
    fact: DataFrame,
    customer: DataFrame,
    k: int | None = 5,
    amount: Column | None = None,
    completed: str = "COMPLETED",
    sk: str = "customer_sk",
    name: str = "customer_name",
    order_id: str = "order_id",
    quantity: str = "quantity",
) -> DataFrame:
    """Customers by revenue, highest first; the ``k`` first, or all for None. Each must have one row."""
    sold = _completed(fact, completed, sk).select(
        sk, order_id, quantity, _amount(amount).alias("amount")
    )
    profile = sold.groupBy(sk).agg(
        F.count(order_id).alias("order_count"),
        sum_of(sold, F.col("amount")).alias("total_sales_amount"),
        mean_of(sold, F.col("amount")).alias("average_sales_amount"),
        sum_of(sold, F.col(quantity)).alias("total_quantity_purchased"),
    )
    ranked = _named(profile, customer, sk, name).orderBy(F.desc("total_sales_amount"), sk)
    return ranked if k is None else ranked.limit(k)


def _usable(key: DimensionKey, mode: str) -> DataFrame:
    """The dimension rows a load may point at, at most one per key."""
    dim = key.dim
    if key.latest_by is not None:
        # An aggregate, not a window: versions of one key are reduced where
        # they are read and never gathered in one task.
        rest = [name for name in (key.sk, key.active) if name]
        latest = F.max_by(F.struct(*rest), F.struct(key.latest_by, key.sk))
        dim = dim.groupBy(key.natural_key).agg(latest.alias("row")).select(
            key.natural_key, *[F.col("row").getField(name).alias(name) for name in rest]
        )
    if key.active and mode == "active":
        dim = dim.where(F.col(key.active))
    elif key.active and mode == "suspend":
        dim = dim.where(F.coalesce(F.col(key.active), F.lit(True)))
    return dim.select(key.natural_key, key.sk)


def _completed(fact: DataFrame, completed: str, sk: str) -> DataFrame:
    return fact.where((F.col("status") == completed) & F.col(sk).isNotNull())


def _amount(amount: Column | None) -> Column:
    return F.col("unit_price") - F.col("discount") if amount is None else amount


def _labelled(
    rows: DataFrame, dim: DataFrame, sk: str, take: str, keys_from: DataFrame | None = None
) -> DataFrame:
    """``rows`` with a column of the dimension, whose keys may not repeat."""
    skewed = keys_from is not None
    lookup = Lookup(
        dim, {sk: sk}, [take], "inner", skewed=skewed, check_unique=True, keys_from=keys_from
    )
    return resolve(rows, [lookup])


def _named(profile: DataFrame, customer: DataFrame, sk: str, name: str) -> DataFrame:
    """Add names to one row per customer; facts are summed before this join."""
    rest = [column for column in profile.columns if column != sk]
    return _labelled(profile, customer, sk, name).select(sk, name, *rest)
