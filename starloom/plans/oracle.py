"""SQL that states each registered query a second time, for another engine.

Written from the meaning of the queries, not from their Spark plans: the
three-snapshot history, for example, is two loads on top of a first one here
and one windowed pass there.
"""

from __future__ import annotations

from starloom.plans.inputs import (
    CALENDAR,
    COMPLETED,
    LATE_CUT,
    LATE_SEGMENT,
    LATE_TYPE,
    SNAPSHOT_DAYS,
    SNAPSHOT_REACH,
)
from starloom.plans.queries import (
    ARCHIVE_AS_OF,
    BROKEN_EVERY,
    EXPIRY_NOW,
    HISTORY_KEY,
    KEYWORD,
    REPLACEMENT,
)

# Building blocks ------------------------------------------------------------

RAW = """raw as (
  select l_orderkey as order_id, o_custkey as customer_id, l_partkey as product_id,
         cast(o_orderdate as date) as date_id, l_quantity as quantity,
         l_extendedprice as unit_price, l_extendedprice * l_discount as discount,
         o_orderstatus as status
  from lineitem join orders on l_orderkey = o_orderkey)"""

DIMS = f"""customer_all as (
  select c_custkey + 1 as customer_sk, c_custkey as customer_id, c_name as customer_name,
         c_mktsegment as segment, c_acctbal >= 0 as is_active
  from customer),
product_all as (
  select p_partkey + 1 as product_sk, p_partkey as product_id, p_name as product_name,
         p_type as category, p_size <= 45 as is_active
  from part),
customer_early as (select * from customer_all where segment <> '{LATE_SEGMENT}'),
product_early as (select * from product_all where category <> '{LATE_TYPE}'),
date_dim as (
  select cast(row_number() over (order by d) as integer) as date_sk, cast(d as date) as day
  from generate_series(timestamp '{CALENDAR[0]}', timestamp '{CALENDAR[1]}', interval 1 day) t(d))"""

BASE = f"{RAW},\n{DIMS}"

LOOKED_UP = "c.customer_sk, p.product_sk, d.date_sk"
PLAIN = f"""select order_id, quantity, unit_price, discount, status, {LOOKED_UP} from raw r"""

KEEP = f"""fact as (
  {PLAIN}
  left join customer_early c on r.customer_id = c.customer_id
  left join product_early p on r.product_id = p.product_id
  left join date_dim d on r.date_id = d.day)"""

ACTIVE = f"""fact as (
  {PLAIN}
  join customer_early c on r.customer_id = c.customer_id and c.is_active
  join product_early p on r.product_id = p.product_id and p.is_active
  left join date_dim d on r.date_id = d.day)"""

LATE_COLUMNS = """order_id, customer_id, product_id, date_id, quantity, unit_price,
  discount, status, customer_sk, product_sk, date_sk"""


def _late(name: str, rows: str, dims: str) -> str:
    return f"""{name} as (
  select r.order_id, r.customer_id, r.product_id, r.date_id, r.quantity, r.unit_price,
         r.discount, r.status, {LOOKED_UP}
  from ({rows}) r
  left join (select * from customer_{dims} where is_active) c on r.customer_id = c.customer_id
  left join (select * from product_{dims} where is_active) p on r.product_id = p.product_id
  left join date_dim d on r.date_id = d.day)"""


FIRST_CYCLE = _late("cycle", f"select * from raw where date_id < date '{LATE_CUT}'", "early")
MISSING = "(customer_sk is null or product_sk is null)"
SUSPENDED = f"suspended as (select * from cycle where {MISSING})"
RETRIED = _late("retried", "select * from suspended", "all")
NEWER = _late("newer", f"select * from raw where date_id >= date '{LATE_CUT}'", "all")
LATE = f"with {BASE},\n{FIRST_CYCLE},\n{SUSPENDED},\n{RETRIED},\n{NEWER}\n"


def _money(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(18,4))) as double)"


NET = "unit_price - discount"

# Slowly changing dimension --------------------------------------------------

ATTRIBUTES = """customer_key, customer_name, customer_nationkey, customer_market_segment,
  customer_best_priority, customer_last_urgent, customer_credit_tier, customer_spent"""
TRACKED = ("customer_best_priority", "customer_last_urgent", "customer_credit_tier")


def _feed(day: str) -> str:
    return f"""select c_custkey as customer_key, c_name as customer_name,
         c_nationkey as customer_nationkey, c_mktsegment as customer_market_segment,
         best_priority as customer_best_priority, last_urgent as customer_last_urgent,
         floor(spent / 500000) * 500000.0 as customer_credit_tier, spent as customer_spent
  from customer join (
    select o_custkey, min(cast(substr(o_orderpriority, 1, 1) as integer)) as best_priority,
           cast(max(case when o_orderpriority = '1-URGENT' then o_orderdate end) as date)
             as last_urgent,
           {_money("o_totalprice")} as spent
    from orders where o_orderdate < timestamp '{day}'
    group by o_custkey
    having max(o_orderdate) >= timestamp '{day}' - interval {SNAPSHOT_REACH} day
  ) on c_custkey = o_custkey"""


def _load(number: int) -> str:
    """CTEs ``feed<n>``, ``change<n>``, ``dim<n>`` of load ``number``."""
    day = SNAPSHOT_DAYS[number]
    feed = f"feed{number} as ({_feed(day)})"
    opened = f"{ATTRIBUTES}, date '{day}' as valid_from, date '9999-12-31' as valid_to"
    if number == 0:
        return f"""{feed},
dim0 as (
  select row_number() over (order by customer_key) as customer_sk, {opened}, true as is_current
  from feed0)"""
    old = number - 1
    differs = " or ".join(f"f.{c} is distinct from d.{c}" for c in TRACKED)
    return f"""{feed},
change{number} as (
  select f.*, d.customer_sk as prev_customer_sk,
         case when d.customer_key is null then 'New' when {differs} then 'Changed'
              else 'Unchanged' end as change
  from feed{number} f
  left join (select * from dim{old} where is_current) d on f.customer_key = d.customer_key),
expired{number} as (
  select * replace (date '{day}' - 1 as valid_to, false as is_current) from dim{old}
  where is_current
    and customer_key in (select customer_key from change{number} where change = 'Changed')),
inserted{number} as (
  select (select max(customer_sk) from dim{old}) + row_number() over (order by customer_key)
           as customer_sk, {opened}, true as is_current
  from change{number} where change in ('New', 'Changed')),
unchanged{number} as (
  select * from dim{old}
  where customer_sk not in (select customer_sk from expired{number})),
dim{number} as (
  select * from expired{number} union all select * from inserted{number}
  union all select * from unchanged{number})"""


def _loads(last: int) -> str:
    return "with " + ",\n".join(_load(n) for n in range(last + 1)) + "\n"


DIM_COLUMNS = f"customer_sk, {ATTRIBUTES}, valid_from, valid_to, is_current"

# Data quality ---------------------------------------------------------------

LINES = """with lines as (
  select l_orderkey, l_linenumber, l_quantity, l_discount, o_orderpriority,
         nullif(l_tax, 0.0) as l_tax, nullif(l_returnflag, 'A') as l_returnflag, l_linestatus
  from lineitem join orders on l_orderkey = o_orderkey)
"""

FAILS = {
    1: "l_tax is null",
    2: "not regexp_matches(o_orderpriority, '^[1-3]-[A-Z]+$')",
    3: "(l_quantity < 3 or l_quantity > 47)",
    5: "(l_returnflag is not null and l_linestatus is not null and "
    "(l_returnflag, l_linestatus) not in (('R', 'F'), ('N', 'O'), ('N', 'F')))",
    6: "(l_discount < 0.01 or l_discount > 0.09)",
}

RULE_TEXT = {
    1: ("l_tax", "completeness", "HIGH", "Tax should not be null"),
    2: ("o_orderpriority", "accuracy", "HIGH", "Valid priority"),
    3: ("l_quantity", "accuracy", "MEDIUM", "Valid quantity range"),
    4: ("l_orderkey,l_linenumber", "uniqueness", "HIGH", "Unique order line"),
    5: ("l_returnflag,l_linestatus", "consistency", "MEDIUM", "Valid flag pair"),
    6: ("l_discount", "accuracy", "LOW", "Valid discount range"),
}

DUPLICATES = """select l_orderkey, l_linenumber, count(*) as occurrences
  from lineitem group by all having count(*) > 1"""


def _rule(number: int) -> str:
    column, rule_type, severity, description = RULE_TEXT[number]
    rows = f"from ({DUPLICATES})" if number == 4 else f"from lines where {FAILS[number]}"
    return f"""select cast({number} as integer) as rule_id, '{column}' as column_name,
       '{rule_type}' as rule_type, '{severity}' as severity,
       count(*) as failed_count, '{description}' as comments
{rows}"""


def _rules(*numbers: int) -> str:
    return LINES + "\nunion all\n".join(_rule(n) for n in numbers)


_LABELS = ", ".join(
    f"case when {FAILS[n]} then '{n}' end" for n in (1, 2, 3, 5, 6)
)

# Calendar and archive -------------------------------------------------------

QSTART = "cast(date_trunc('quarter', {0}) - interval 3 month as date)"
QEND = "cast(date_trunc('quarter', {0}) as date) - 1"
ARCHIVED_FROM = QSTART.format(f"date '{ARCHIVE_AS_OF}'")
ARCHIVED_TO = QEND.format(f"date '{ARCHIVE_AS_OF}'")


def _manifest(table: str, column: str) -> str:
    return f"""select '{table}' as table_name,
       '{table}_snapshot_' || strftime({ARCHIVED_FROM}, '%Y%m%d') || '_'
         || strftime({ARCHIVED_TO}, '%Y%m%d') as archive_name,
       {ARCHIVED_FROM} as quarter_start, {ARCHIVED_TO} as quarter_end,
       count(*) as row_count, true as intact,
       timestamp '{ARCHIVE_AS_OF}' + interval 365 day as expires_at
from {table} where cast({column} as date) between {ARCHIVED_FROM} and {ARCHIVED_TO}"""


ORACLE: dict[str, str] = {
    "date_dimension": """with span as (
  select min(o_orderdate) as a, max(o_orderdate) as b from orders),
days as (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as d from span)
select cast(row_number() over (order by d) as integer) as date_sk, d as calendar_date,
       strftime(d, '%Y-%m-%d') as full_date, cast(year(d) as integer) as year,
       cast(month(d) as integer) as month, monthname(d) as month_name,
       cast(day(d) as integer) as day, dayname(d) as day_name,
       cast(isodow(d) as integer) as day_of_week,
       cast(isodow(d) <= 5 as integer) as is_weekday,
       cast(isodow(d) > 5 as integer) as is_weekend,
       (select count(*) from orders where cast(o_orderdate as date) = d) as orders
from days""",
    "fact_keep": f"with {BASE},\n{KEEP}\nselect * from fact",
    "fact_active": f"with {BASE},\n{ACTIVE}\nselect * from fact",
    "category_revenue": f"""with {BASE},
{KEEP}
select category, {_money(NET)} as total_amount
from fact join product_all using (product_sk) where status = '{COMPLETED}' group by category""",
    "category_sales": f"""with {BASE},
{ACTIVE}
select category as product_category, {_money("quantity")} as total_quantity,
       {_money(NET)} as total_sales_amount, count(distinct order_id) as order_count
from fact join product_all using (product_sk) where status = '{COMPLETED}' group by category""",
    "customer_revenue": f"""with {BASE},
{KEEP}
select customer_sk, customer_name, {_money(NET)} as total_amount,
       {_money("unit_price")} / count(unit_price) as avg_price,
       max(unit_price) as max_price, min(unit_price) as min_price
from fact join customer_all using (customer_sk) where status = '{COMPLETED}'
group by customer_sk, customer_name""",
    "customer_ranking": f"""with {BASE},
{ACTIVE}
select customer_sk, customer_name, count(order_id) as order_count,
       {_money(NET)} as total_sales_amount,
       {_money(NET)} / count({NET}) as average_sales_amount,
       {_money("quantity")} as total_quantity_purchased
from fact join customer_all using (customer_sk) where status = '{COMPLETED}'
group by customer_sk, customer_name""",
    "dim_initial": f"{_loads(0)}select {DIM_COLUMNS} from dim0",
    "surrogate_keys": """select c_custkey, c_mktsegment, c_nationkey,
       1000 + row_number() over (order by c_mktsegment, c_nationkey, c_custkey) as customer_sk
from customer""",
    "scd2_classify": f"""{_loads(1)}
select customer_key, prev_customer_sk, change from change1""",
    "scd2_new_rows": f"{_loads(1)}select {ATTRIBUTES} from change1 where change = 'New'",
    "scd2_expired": f"{_loads(1)}select {DIM_COLUMNS} from expired1",
    "scd2_inserts": f"{_loads(1)}select {DIM_COLUMNS} from inserted1",
    "scd2_unchanged": f"{_loads(1)}select {DIM_COLUMNS} from unchanged1",
    "scd2_apply": f"{_loads(1)}select {DIM_COLUMNS} from dim1",
    "scd2_replay": f"{_loads(2)}select {DIM_COLUMNS} from dim2",
    "scd2_buckets": f"{_loads(2)}select {DIM_COLUMNS} from dim2",
    "current_rows": f"{_loads(2)}select {DIM_COLUMNS} from dim2 where is_current",
    "key_history": f"{_loads(2)}select {DIM_COLUMNS} from dim2 where customer_key = {HISTORY_KEY}",
    "category_orders": """
select p_type as category, count(distinct l_orderkey) as orders
from lineitem join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey
group by p_type""",
    "fact_valid": f"""{_loads(2)}
select o_orderkey, o_custkey, cast(o_orderdate as date) as order_day,
    customer_sk, customer_best_priority, customer_credit_tier
from orders left join dim2
    on customer_key = o_custkey and cast(o_orderdate as date) between valid_from and valid_to""",
    "late_first_cycle": f"{LATE}select {LATE_COLUMNS} from cycle",
    "late_ready": f"{LATE}select {LATE_COLUMNS} from cycle where not {MISSING}",
    "late_suspended": f"{LATE}select {LATE_COLUMNS}, false as processed_flag from suspended",
    "late_retry": f"{LATE}select {LATE_COLUMNS}, not {MISSING} as processed_flag from retried",
    "late_next_cycle": f"""{LATE}
select {LATE_COLUMNS} from newer where not {MISSING}
union
select {LATE_COLUMNS} from retried where not {MISSING}""",
    "late_still_suspended": f"""{LATE}
select {LATE_COLUMNS}, false as processed_flag from newer where {MISSING}
union
select {LATE_COLUMNS}, false as processed_flag from retried where {MISSING}""",
    "late_stream_cycles": f"""{LATE}
select distinct {LATE_COLUMNS}, 0 as cycle from cycle where not {MISSING}
union all
(select {LATE_COLUMNS}, 1 as cycle from newer where not {MISSING}
union
select {LATE_COLUMNS}, 1 as cycle from retried where not {MISSING})""",
    "dq_completeness": _rules(1),
    "dq_regex": _rules(2),
    "dq_range": _rules(3, 6),
    "dq_uniqueness": _rules(4),
    "dq_consistency": _rules(5),
    "dq_report": _rules(1, 2, 3, 4, 5, 6),
    "dq_by_load": _rules(1, 2, 3, 4, 5, 6),
    "dq_failing_rows": f"""{LINES}
select *, concat_ws(',', {_LABELS}) as failed_rules from lines
where {" or ".join(FAILS.values())}""",
    "dq_duplicates": DUPLICATES,
    "previous_quarter": f"""select distinct cast(o_orderdate as date) as as_of,
       {QSTART.format("o_orderdate")} as qstart_date, {QEND.format("o_orderdate")} as qend_date
from orders""",
    "archive_quarter": f"""select * from orders
where cast(o_orderdate as date) between {ARCHIVED_FROM} and {ARCHIVED_TO}""",
    "archive_by_catalog": f"""select *, cast(date_trunc('month', o_orderdate) as date) as order_month
from orders where cast(o_orderdate as date) between {ARCHIVED_FROM} and {ARCHIVED_TO}""",
    "csv_round_trip": f"""select o_orderkey,
       case when o_orderkey % {BROKEN_EVERY} <> 0 then o_custkey end as o_custkey,
       case when o_orderkey % {BROKEN_EVERY} <> 0 then o_orderstatus end as o_orderstatus,
       case when o_orderkey % {BROKEN_EVERY} <> 0 then cast(o_orderdate as date) end as o_orderdate,
       case when o_orderkey % {BROKEN_EVERY} = 0 then
         concat_ws(',', o_orderkey, 'C-' || o_custkey, o_orderstatus, cast(o_orderdate as date))
       end as malformed_line
from orders""",
    "archive_manifest": f"""{_manifest("orders", "o_orderdate")}
union all
{_manifest("lineitem", "l_shipdate")}""",
    "expired_archives": f"""with quarters as (
  select cast(date_trunc('quarter', o_orderdate) as date) as quarter_start, count(*) as row_count
  from orders group by 1),
ended as (
  select *, cast(quarter_start + interval 3 month as date) - 1 as quarter_end from quarters)
select quarter_start, quarter_end, row_count,
       cast(quarter_end + 365 as timestamp) as expires_at,
       'orders_snapshot_' || strftime(quarter_start, '%Y%m%d') || '_'
         || strftime(quarter_end, '%Y%m%d') as archive_name
from ended where quarter_end + 365 <= date '{EXPIRY_NOW}'""",
    "archive_append": f"""select * from orders
where cast(o_orderdate as date) between {ARCHIVED_FROM} and {ARCHIVED_TO}""",
    "archive_cycle": f"""with quarters as (
  select cast(date_trunc('quarter', o_orderdate) as date) as q, count(*) as n from orders group by 1),
dated as (
  select *, strftime(q, '%Y%m%d') || '_' || strftime(q + interval 3 month - interval 1 day, '%Y%m%d') as days,
         cast(q + interval 3 month as date) - 1 + 365 <= date '{EXPIRY_NOW}' as expired,
         row_number() over (order by q) as first_of, row_number() over (order by q desc) as last_of
  from quarters)
select 'orders_snapshot_' || days as archive_name, case when expired then 'expired' else 'kept' end as fate,
       n as row_count, false as droppable_copy from dated
union all
select 'orders_copy_' || days, 'copied', n, true from dated where last_of <= 2
union all
select 'orders_copy_' || days, 'unnamed', null, false from dated where first_of = 1""",
    "replace_text_deep": f"""select event_id, event_type,
       replace(event_type, '{KEYWORD}', '{REPLACEMENT}') as name,
       replace(event_type, '{KEYWORD}', '{REPLACEMENT}') || '|'
         || replace(props, '{KEYWORD}', '{REPLACEMENT}') as tags,
       event_type as label_key,
       replace(event_type || ':' || props, '{KEYWORD}', '{REPLACEMENT}') as label_value, user_id
from events""",
    "replace_text_variant": f"""select event_id, event_type,
       replace(event_type, '{KEYWORD}', '{REPLACEMENT}') as name,
       replace(props, '{KEYWORD}', '{REPLACEMENT}') as text, user_id,
       replace(event_type, '{KEYWORD}', '{REPLACEMENT}') as label,
       cast(json_extract(props, '$.k') as bigint) as k
from events""",
}
ORACLE["top_customers"] = (
    ORACLE["customer_ranking"] + "\norder by total_sales_amount desc, customer_sk limit 5"
)
