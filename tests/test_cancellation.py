import datetime as dt
import random
from collections import defaultdict

import pytest

from ordermill.operators import cancellation as cc
from ordermill.sources.shared import settle

SCHEMA = ("row_key long, order_date date, amount double, status string, fulfilment string, "
          "service_level string, courier_status string, ship_city string, ship_state string, "
          "promotion_ids string")
DAY = dt.date(2022, 4, 8)


def row(key, day=0, amount=10.0, status="Shipped", fulfilment="Merchant", level="Standard",
        courier="Shipped", city="Pune", state="MH", promos="a,b,c"):
    return (key, DAY + dt.timedelta(days=day), amount, status, fulfilment, level, courier, city,
            state, promos)


def prepared(spark, rows):
    return cc.prepare_orders(spark.createDataFrame(rows, SCHEMA))


def both_ways(orders):
    """The final table by order-level operators and by promotion lists."""
    valid, averages = cc.valid_promotions(orders), cc.state_avg_amount(orders)
    by_orders = cc.cancellation_by_city(cc.qualified_orders(orders, valid, averages))
    by_lists = cc.city_cancellation(orders, valid, averages)
    return [sorted(map(tuple, t.collect())) for t in (by_orders, by_lists)]


# Three promotions a, b, c that are valid, and one dear order that lifts the average.
BASE = [row(1, 0, 100.0), row(2, 2, 100.0)]


def test_incomplete_orders_are_dropped(spark):
    rows = [row(1), row(2, city=" "), row(3, state=None), row(4, city=None), row(5, amount=None),
            (6, None) + row(6)[2:]]
    assert [r.row_key for r in prepared(spark, rows).collect()] == [1]


def test_promo_rows_equal_the_exploded_array(spark):
    lists = ["a, b", " a ,, ,b c  , ", "", None, ",", "x,x"]
    orders = prepared(spark, [row(k, promos=p) for k, p in enumerate(lists)])
    exploded = orders.selectExpr("row_key", "order_date", "explode(promo_array)")
    assert sorted(cc.promo_rows(orders).collect()) == sorted(exploded.collect())


@pytest.mark.parametrize("last_day, expected", [(1, []), (2, ["p"])])
def test_promotion_span(spark, last_day, expected):
    orders = prepared(spark, [row(1, 0, promos="p"), row(2, last_day, promos=" p ,")])
    assert [r.promotion_id for r in cc.valid_promotions(orders).collect()] == expected


def test_strictly_below_the_average(spark):
    same = [row(k, k, 50.0) for k in range(4)]
    assert both_ways(prepared(spark, same)) == [[], []]


def test_state_without_average_has_no_qualified_orders(spark):
    rows = BASE + [row(3, 1, 5.0, fulfilment="Amazon", state="GA")]
    assert both_ways(prepared(spark, rows)) == [[], []]


def test_repeats_count_once(spark):
    orders = prepared(spark, BASE + [row(3, 1, 5.0, promos="a,a,b"), row(4, 1, 5.0)])
    counts = cc.valid_promo_count(orders, cc.valid_promotions(orders))
    assert {r.row_key: r.valid_promotion_count for r in counts.collect()} == {
        1: 3, 2: 3, 3: 2, 4: 3
    }
    by_orders, by_lists = both_ways(orders)
    assert by_orders == by_lists == [("PUNE", "MH", 1, 0, 0.0, 52.5)]


def test_percentage(spark):
    cheap = [row(10 + k, 1, 5.0, status=s, fulfilment="Amazon")
             for k, s in enumerate(["Cancelled", "cancelled by buyer", "Shipped"])]
    by_orders, by_lists = both_ways(prepared(spark, BASE + cheap))
    assert by_orders == by_lists == [("PUNE", "MH", 3, 2, 66.6667, 100.0)]


def test_generated_keys_are_unique_and_stored(spark):
    orders = prepared(spark, BASE * 5).drop("row_key").repartition(4)
    keyed = cc.with_row_key(orders)
    keys = [r.row_key for r in keyed.collect()]
    assert len(set(keys)) == 10
    assert keys and sorted(keys) == sorted(r.row_key for r in keyed.collect())


def random_case(rng, case):
    """Up to 60 orders; places and promotions carry the case, so cases do not mix."""
    def promos():
        return ",".join(f"{p}{case}" if p.strip() else p
                        for p in rng.choices(["a", "b", "c", "d", " e", ""], k=rng.randint(0, 6)))

    return [
        row(case * 1000 + k, rng.randint(0, 4), float(rng.randint(1, 9)),
            rng.choice(["Shipped", "Cancelled"]), rng.choice(["Merchant", "Amazon "]),
            rng.choice([" Standard", "Expedited"]), "Shipped", rng.choice("xy"),
            f"{rng.choice('st')}{case}", promos())
        for k in range(rng.randint(10, 60))
    ]


def brute_force(rows):
    seen, paid, found = defaultdict(set), defaultdict(list), defaultdict(list)
    pieces = {r[0]: {p.strip() for p in r[9].split(",")} - {""} for r in rows}
    for r in rows:
        for p in pieces[r[0]]:
            seen[p].add(r[1])
        if r[4] == "Merchant":
            paid[r[8].upper()].append(r[2])
    valid = {p for p, days in seen.items() if (max(days) - min(days)).days >= 2}
    for r in rows:
        state = r[8].upper()
        if (r[5] == " Standard" and state in paid and len(pieces[r[0]] & valid) >= 3
                and r[2] < sum(paid[state]) / len(paid[state])):
            found[r[7].upper(), state].append(r[3] == "Cancelled")
    return sorted(
        (*place, len(hits), sum(hits), round(100 * sum(hits) / len(hits), 4),
         pytest.approx(sum(paid[place[1]]) / len(paid[place[1]])))
        for place, hits in found.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_both_ways_against_brute_force(spark, seed):
    """50 random cases in one table."""
    rng = random.Random(seed)
    rows = [r for case in range(50) for r in random_case(rng, case)]
    by_orders, by_lists = both_ways(settle(prepared(spark, rows), "orders"))
    assert by_orders == by_lists == brute_force(rows)
    assert len(by_orders) > 50


def test_lists_of_the_same_promotions_meet(spark):
    orders = prepared(spark, BASE + [row(3, 1, 5.0, promos="c,a,b"),
                                     row(4, 1, 5.0, promos="b, c,,a,a")])
    by_orders, by_lists = both_ways(orders)
    assert by_orders == by_lists
    assert [r[2] for r in by_lists] == [2]
