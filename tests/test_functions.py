import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.functions import dates, numbers, promos, text


def values(spark, inputs, expression):
    rows = [(i, v) for i, v in enumerate(inputs)]
    table = spark.createDataFrame(rows, "i int, x string").select("i", expression.alias("y"))
    return [r.y for r in table.orderBy("i").collect()]


def test_any_date(spark):
    good = ["4/5/22", "4-5-22", "04-05-22", "04-05-2022", "2022-04-05", "4/5/2022",
            "04/05/2022", " 04-05-22\t"]
    bad = ["02-30-22", "2022/04/05", "", None, "4-5-2022", "soon"]
    found = values(spark, good + bad, dates.parse_any_date("x"))
    assert found == [dt.date(2022, 4, 5)] * len(good) + [None] * len(bad)


def test_sale_date(spark):
    found = values(spark, ["04-30-22", "04-31-22", "2022-04-30", None], dates.parse_sale_date("x"))
    assert found == [dt.date(2022, 4, 30), None, None, None]


def test_days_a_month_does_not_have(spark):
    late = ["02-30-22", "02-29-24", "04-31-22", "02-32-22", "13-30-22", "01-31-22", None]
    expected = [dt.date(2022, 2, 28), dt.date(2024, 2, 29), dt.date(2022, 4, 30), None, None,
                dt.date(2022, 1, 31), None]
    assert values(spark, late, dates.parse_sale_date("x", clamp=True)) == expected
    more = ["2/30/22", "2-30-22", "02-30-2022", "2022-02-30", "2/31/2022"]
    found = values(spark, late + more, dates.parse_any_date("x", clamp=True))
    assert found == expected + [dt.date(2022, 2, 28)] * len(more)


def test_state_title(spark):
    inputs = [" ORISSA", "rajsthan", "JAMMU  &  KASHMIR", "delhi\t", "Orissa ", None]
    assert values(spark, inputs, text.title_state("x")) == [
        "Odisha", "Rajasthan", "Jammu & Kashmir", "Delhi", "Odisha", None
    ]


def test_strip_takes_control_characters_and_trim_does_not(spark):
    inputs = ["\t a b\x01 ", " a"]
    assert values(spark, inputs, text.strip("x")) == ["a b", " a"]
    assert values(spark, inputs, text.upper_trimmed("x")) == ["\t A B\x01", " A"]


@pytest.mark.parametrize("blank", ["", " ", "\t\x00 ", None])
def test_blank_is_not_present(spark, blank):
    kept = spark.createDataFrame([(blank,), ("a",)], "x string").filter(text.is_present("x"))
    assert [r.x for r in kept.collect()] == ["a"]


def test_int_or_zero(spark):
    inputs = ["3", "0", "-1", "x", "1.0", "", None, "99999999999"]
    assert values(spark, inputs, numbers.int_or_zero(F.col("x"))) == [3, 0, -1, 0, 0, 0, 0, 0]


def test_double_or_null(spark):
    found = values(spark, ["3.5", "7", "x", "", None], numbers.double_or_null(F.col("x")))
    assert found == [3.5, 7.0, None, None, None]


PROMOS = ["a,b,", None, "", " ", "a,a,b", "PROMO-10, PROMO-11", " x ", " a ,, ,b c  , ", ","]


def test_promo_array_keeps_ids_whole(spark):
    assert values(spark, PROMOS, promos.promo_array("x")) == [
        ["a", "b"], [], [], [], ["a", "a", "b"], ["PROMO-10", "PROMO-11"], ["x"], ["a", "b c"], []
    ]


def test_raw_promo_count(spark):
    assert values(spark, PROMOS, promos.raw_promo_count("x")) == [3, 0, 0, 0, 3, 2, 1, 5, 2]


def test_raw_count_is_never_below_the_array(spark):
    counts = values(spark, PROMOS, promos.raw_promo_count("x"))
    arrays = values(spark, PROMOS, promos.promo_array("x"))
    assert all(n >= len(a) for n, a in zip(counts, arrays))
