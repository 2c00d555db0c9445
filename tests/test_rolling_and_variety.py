import datetime as dt
import random
from collections import defaultdict
from statistics import median

import pytest

from ordermill.operators import rolling, variety

SALES = "order_date date, status string, qty int, size string, ship_state string"
ITEMS = "order_date date, size string, sku string, style string, ship_state string"
DAY = dt.date(2022, 4, 8)


def purchases(spark, rows):
    return rolling.shipped_purchases(spark.createDataFrame(rows, SALES))


def test_which_rows_are_purchases(spark):
    rows = [
        (DAY, "Shipped - Returned to Seller", 1, "m", " goa "),
        (DAY, "Unshipped", 2, "M", "Goa"),
        (DAY, "Cancelled", 1, "M", "GOA"),
        (DAY, "Shipped", 0, "M", "GOA"),
        (DAY, "Shipped", -1, "M", "GOA"),
        (DAY, "Shipped", 1, " ", "GOA"),
        (DAY, "Shipped", 1, "M", None),
        (None, "Shipped", 1, "M", "GOA"),
        (DAY, None, 1, "M", "GOA"),
    ]
    found = sorted((r.state, r.size, r.qty) for r in purchases(spark, rows).collect())
    assert found == [("GOA", "M", 1), ("GOA", "M", 2)]


def test_one_order_reaches_the_seven_days_after_it(spark):
    rows = [(DAY, "Shipped", 1, "M", "GOA")]
    result = rolling.rolling_top_size(spark.createDataFrame(rows, SALES))
    found = sorted(r.window_date for r in result.collect())
    assert found == [DAY + dt.timedelta(days=k) for k in range(1, 8)]


def test_tie_goes_to_the_smallest_size(spark):
    rows = [(DAY, "Shipped", 2, "M", "GOA"), (DAY, "Shipped", 2, "L", "GOA"),
            (DAY, "Shipped", 1, "A", "GOA")]
    result = rolling.rolling_top_size(spark.createDataFrame(rows, SALES), days=1)
    assert [r.most_bought_size for r in result.collect()] == ["L"]


@pytest.mark.parametrize("days", [1, 2, 7, 8])
def test_against_brute_force(spark, days):
    """50 random cases, each in a state of its own, in one table."""
    rng = random.Random(days)
    rows = [(DAY + dt.timedelta(days=rng.randint(0, 20)), "Shipped", rng.randint(1, 3),
             rng.choice("SML"), f"STATE {case}")
            for case in range(50) for _ in range(rng.randint(1, 30))]
    table = spark.createDataFrame(rows, SALES)
    sums = defaultdict(int)
    for day, _, qty, size, state in rows:
        for k in range(1, days + 1):
            sums[day + dt.timedelta(days=k), state, size] += qty
    best = {}
    for (day, state, size), qty in sums.items():
        best[day, state] = min(best.get((day, state), (0, "")), (-qty, size))
    expected = sorted((d, s, size) for (d, s), (_, size) in best.items())
    direct = rolling.rolling_top_size(table, days)
    by_window = rolling.top_size(rolling.rolling_size_qty_event_time(table, days))
    assert sorted(map(tuple, direct.collect())) == expected
    assert sorted(map(tuple, by_window.collect())) == expected


def test_size_classes(spark):
    rows = [(DAY, s, "k", "t", "goa") for s in ["xxl", "2XL", "Free", " 6XL", "XL", None]]
    rows += [(DAY, "XXL", " ", "t", "goa"), (DAY, "XXL", "k", None, "goa"),
             (None, "XXL", "k", "t", "goa"), (DAY, "XXL", "k", "t", "")]
    items = variety.sized_items(spark.createDataFrame(rows, ITEMS))
    assert [tuple(r) for r in items.collect()] == [("2022-04", "Goa", "t", "k")] * 2


def test_medians(spark):
    def rows(state, counts):
        return [
            (DAY, "XXL", f"k{i}", f"t{style}", state)
            for style, n in enumerate(counts)
            for i in list(range(n)) + [0]
        ]

    table = spark.createDataFrame(rows("even", [1, 2, 3, 10]) + rows("odd", [1, 2, 9]), ITEMS)
    found = {r.state: r.median_variety for r in variety.median_variety(table).collect()}
    assert found == {"Even": median([1, 2, 3, 10]), "Odd": 2.0} == {"Even": 2.5, "Odd": 2.0}
