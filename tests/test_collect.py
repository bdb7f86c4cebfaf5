"""Days of a backfill: bounds as text, defaults and order."""

import datetime as dt

import pytest

from fleetlens.operators import collect as C

TODAY = dt.date(2025, 3, 2)


@pytest.mark.parametrize(
    "start, end, first, last",
    [
        ("2-1-2025", "05-01-2025", dt.date(2025, 1, 2), dt.date(2025, 1, 5)),
        # without bounds, or with ones that are no dates, the year so far
        (None, None, dt.date(2025, 1, 1), TODAY),
        ("2025-01-02", "31-2-2025", dt.date(2025, 1, 1), TODAY),
        # the year of the end counts
        (None, "3-2-2024", dt.date(2024, 1, 1), dt.date(2024, 2, 3)),
        ("29-2-2024", "1-3-2024", dt.date(2024, 2, 29), dt.date(2024, 3, 1)),
        ("7-7-2024", "7-7-2024", dt.date(2024, 7, 7), dt.date(2024, 7, 7)),
    ],
)
def test_backfill_days(spark, start, end, first, last):
    days = [r.day for r in C.backfill_days(spark, start, end, TODAY).orderBy("day").collect()]
    assert (days[0], days[-1]) == (first, last) and len(days) == (last - first).days + 1 == len(set(days))


def test_backfill_without_days(spark):
    assert C.backfill_days(spark, "5-3-2025", "4-3-2025", TODAY).count() == 0


def test_backfill_deals_each_row_to_the_day_after(spark):
    rows = [(i, dt.datetime(2025, 1, 1) + dt.timedelta(hours=i)) for i in range(96)]
    got = C.backfill(spark.createDataFrame(rows, "id long, at timestamp"), "at", dt.date(2025, 1, 2), dt.date(2025, 1, 3)).collect()
    assert {r.load_day for r in got} == {dt.date(2025, 1, 2), dt.date(2025, 1, 3)} and len(got) == 48
    assert all(r.load_day == r["at"].date() + dt.timedelta(days=1) for r in got)
