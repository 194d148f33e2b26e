from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.functions.dates import previous_quarter, previous_quarter_dates
from starloom.operators.calendar import date_dimension, date_dimension_over, days_between


def test_default_range(spark):
    dates = date_dimension(spark)
    assert dates.count() == days_between("2025-01-01", "2026-12-31") == 730
    first = dates.where("date_sk = 1").head().asDict()
    assert first == {
        "date_sk": 1,
        "calendar_date": dt.date(2025, 1, 1),
        "full_date": "2025-01-01",
        "year": 2025,
        "month": 1,
        "month_name": "January",
        "day": 1,
        "day_name": "Wednesday",
        "day_of_week": 3,
        "is_weekday": 1,
        "is_weekend": 0,
    }
    assert dates.where("full_date = '2026-01-01'").head()["date_sk"] == 366
    assert not dates.schema["date_sk"].nullable


def test_weekend_flags(spark):
    week = date_dimension(spark, "2026-03-02", "2026-03-08").orderBy("date_sk").collect()
    assert [row["day_of_week"] for row in week] == [1, 2, 3, 4, 5, 6, 7]
    assert [row["is_weekend"] for row in week] == [0, 0, 0, 0, 0, 1, 1]
    assert all(row["is_weekday"] + row["is_weekend"] == 1 for row in week)


def test_range_of_a_column(spark):
    days = [(dt.date(2024, 2, 27),), (dt.date(2024, 3, 1),), (None,)]
    over = date_dimension_over(spark.createDataFrame(days, "d DATE"), "d")
    expected = date_dimension(spark, "2024-02-27", "2024-03-01")
    assert over.orderBy("date_sk").collect() == expected.orderBy("date_sk").collect()
    assert date_dimension_over(spark.createDataFrame([], "d DATE"), "d").count() == 0


@pytest.mark.parametrize(
    ("as_of", "start", "end"),
    [
        ("1998-02-10", "1997-10-01", "1997-12-31"),
        ("2024-04-01", "2024-01-01", "2024-03-31"),
        ("2024-12-31", "2024-07-01", "2024-09-30"),
    ],
)
def test_previous_quarter(spark, as_of, start, end):
    expected = (dt.date.fromisoformat(start), dt.date.fromisoformat(end))
    assert previous_quarter_dates(as_of) == expected
    given = spark.createDataFrame([(as_of,)], "d STRING")
    assert tuple(given.select(*previous_quarter(F.to_date("d"))).head()) == expected
    assert tuple(given.select(*previous_quarter(as_of)).head()) == expected
