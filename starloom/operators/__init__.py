from starloom.operators.archive import (
    Archive,
    Outcome,
    archive_list,
    archive_manifest,
    archive_name,
    archive_quarter,
    archive_quarters,
    archive_tables,
    checksum,
    done_archives,
    droppable_copies,
    expired_archives,
    live_manifest,
    rows_between,
    store_manifest,
    sweep,
)
from starloom.operators.buckets import (
    BucketLoad,
    BucketStore,
    create_buckets,
    load_buckets,
    read_buckets,
    superseded,
)
from starloom.operators.calendar import date_dimension, date_dimension_over, days_between
from starloom.operators.distinct import (
    distinct_counts,
    distinct_state,
    merge_states,
    read_state,
    save_state,
)
from starloom.operators.keys import assign_surrogate_keys, max_key
from starloom.operators.late import (
    land_cycle,
    next_cycle,
    resolve_cycle,
    retry_suspended,
    split_cycle,
    split_suspended,
)
from starloom.operators.lookup import Lookup, Skew, find_skew, fits_broadcast, resolve
from starloom.operators.nested import replace_text_deep
from starloom.operators.quality import (
    Rule,
    duplicate_values,
    failing_rows,
    parse_rules,
    run_rules,
)
from starloom.operators.rule_state import merge_rule_states, rule_report, rule_state
from starloom.operators.scd2 import (
    ScdSpec,
    build_inserts,
    carry_unchanged,
    classify_changes,
    current_rows,
    expire_changed,
    initial_dimension,
    key_history,
    new_rows,
    scd2_apply,
    scd2_replay,
)
from starloom.operators.star import (
    DimensionKey,
    category_revenue,
    category_sales,
    customer_revenue,
    load_fact,
    top_customers,
)
from starloom.operators.validity import resolve_valid

__all__ = [
    "Archive",
    "BucketLoad",
    "BucketStore",
    "DimensionKey",
    "Lookup",
    "Outcome",
    "Rule",
    "ScdSpec",
    "Skew",
    "archive_list",
    "archive_manifest",
    "archive_name",
    "archive_quarter",
    "archive_quarters",
    "archive_tables",
    "assign_surrogate_keys",
    "build_inserts",
    "carry_unchanged",
    "category_revenue",
    "category_sales",
    "checksum",
    "classify_changes",
    "create_buckets",
    "current_rows",
    "customer_revenue",
    "date_dimension",
    "date_dimension_over",
    "days_between",
    "distinct_counts",
    "distinct_state",
    "done_archives",
    "droppable_copies",
    "duplicate_values",
    "expire_changed",
    "expired_archives",
    "failing_rows",
    "find_skew",
    "fits_broadcast",
    "initial_dimension",
    "key_history",
    "land_cycle",
    "live_manifest",
    "load_buckets",
    "load_fact",
    "max_key",
    "merge_rule_states",
    "merge_states",
    "new_rows",
    "next_cycle",
    "parse_rules",
    "read_buckets",
    "read_state",
    "replace_text_deep",
    "resolve",
    "resolve_cycle",
    "resolve_valid",
    "retry_suspended",
    "rows_between",
    "rule_report",
    "rule_state",
    "run_rules",
    "save_state",
    "scd2_apply",
    "scd2_replay",
    "split_cycle",
    "split_suspended",
    "store_manifest",
    "superseded",
    "sweep",
    "top_customers",
]
