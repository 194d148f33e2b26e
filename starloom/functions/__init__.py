from starloom.functions.compare import any_differs, row_hash
from starloom.functions.dates import (
    OPEN_END,
    as_date,
    calendar_columns,
    date_column,
    previous_quarter,
    previous_quarter_dates,
)
from starloom.functions.numbers import mean_of, sum_of
from starloom.functions.text import holds_text, replace_text

__all__ = [
    "OPEN_END",
    "any_differs",
    "as_date",
    "calendar_columns",
    "date_column",
    "holds_text",
    "mean_of",
    "previous_quarter",
    "previous_quarter_dates",
    "replace_text",
    "row_hash",
    "sum_of",
]
