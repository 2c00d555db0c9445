import datetime as dt
import glob

import os

import pytest

from ordermill.__main__ import main
from ordermill.plans.jobs import JOBS
from ordermill.sources import orders_csv, shared, sinks

HEADER = ("index,Order ID,Date,Status,Fulfilment,ship-service-level,Style,SKU,Size,"
          "Courier Status,Qty,Amount,ship-city,ship-state,promotion-ids")


def export(tmp_path, lines, header=HEADER):
    path = tmp_path / "orders.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def line(date="04-08-22", status="Shipped", size="M", qty="1", amount="10", city="Pune",
         state="MH", promos="", sku="k", style="t"):
    return (f"0,id,{date},{status},Merchant,Standard,{style},{sku},{size},Shipped,{qty},{amount},"
            f'{city},{state},"{promos}"')


def test_header_names():
    assert orders_csv.normalise_header(" Ship  State ") == "ship_state"
    assert orders_csv.normalise_header("ship-service-level") == "ship_service_level"


@pytest.mark.parametrize("name", ["ship-state", "Ship State", "ShipState", "state"])
def test_column_aliases(name):
    header = ["Date", name]
    assert orders_csv.resolve_columns(header, ["ship_state"]) == {"ship_state": name}


def test_first_alias_wins_over_first_column():
    found = orders_csv.resolve_columns(["state", "ship-state"], ["ship_state"])
    assert found == {"ship_state": "ship-state"}


def test_missing_column_is_named():
    with pytest.raises(ValueError, match="'qty' not found in header: Date,Size"):
        orders_csv.resolve_columns(["Date", "Size"], ["date", "qty"])


def test_scan(spark, tmp_path):
    path = export(tmp_path, [
        line(city='"say ""hi"", z"', promos="a, b"),
        "",
        "1,id,04-09-22,Shipped",
        line(date="02-30-22", qty="x", amount="n/a"),
    ])
    rows = orders_csv.type_orders(orders_csv.read_orders(spark, path)).collect()
    assert len(rows) == 3
    full, short, bad = rows
    assert full.order_date == dt.date(2022, 4, 8)
    assert (full.ship_city, full.promotion_ids, full.amount) == ('say "hi", z', "a, b", 10.0)
    assert (short.order_date, short.ship_state, short.qty) == (dt.date(2022, 4, 9), None, 0)
    assert (bad.order_date, bad.qty, bad.amount) == (None, 0, None)


def test_scan_reads_only_the_wanted_columns(spark, tmp_path):
    path = export(tmp_path, [line()])
    found = orders_csv.read_orders(spark, path, ["sku", "ship_state"])
    assert found.columns == ["sku", "ship_state"]
    assert found.first() == ("k", "MH")


def written(folder):
    (path,) = glob.glob(f"{folder}/part-*")
    return open(path).read()


def test_bare_csv(spark, tmp_path):
    table = spark.createDataFrame(
        [("b", 'x "y", z', 1.0), ("a", None, 2.5), ("c", " p ", 3.0)], "k string, v string, n double")
    sinks.write_csv(table, str(tmp_path / "out"), ["k"], single_file=True)
    assert written(tmp_path / "out") == 'k,v,n\na,,2.5\nb,x "y", z,1.0\nc, p ,3.0\n'


def test_quoted_csv_reads_back(spark, tmp_path):
    table = spark.createDataFrame([("b", "x, z"), ("a", "y")], "k string, v string")
    path = str(tmp_path / "out")
    sinks.write_csv(table, path, ["k"], single_file=True, quoted=True)
    assert written(path) == 'k,v\na,y\nb,"x, z"\n'
    assert sorted(map(tuple, spark.read.option("header", True).csv(path).collect())) == [
        ("a", "y"), ("b", "x, z")]


def test_parquet_is_sorted_and_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (50, 20):
        table = spark.range(n).repartition(4).withColumnRenamed("id", "k")
        sinks.write_parquet(table, path, ["k"], single_file=True)
    assert [r.k for r in spark.read.parquet(path).collect()] == list(range(20))


class Session:
    """Stands for a session with the given settings."""

    def __init__(self, **settings):
        self.conf = {"spark.sql.warehouse.dir": "hdfs:///warehouse"} | settings
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.conf.get("context")


def test_shared_folder_is_the_configured_one():
    session = Session(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared.shared_folder(session) == "hdfs:///shared/"
    first, second = shared.new_path(session, "a"), shared.new_path(session, "a")
    assert first.startswith("hdfs:///shared/a-") and first != second


def test_shared_folder_is_else_the_contexts_or_in_the_warehouse():
    assert shared.shared_folder(Session(context="hdfs:///own")) == "hdfs:///own"
    assert shared.shared_folder(Session()).startswith("hdfs:///warehouse/")


def test_scratch_tables_go_with_the_job(spark):
    with shared.Scratch(spark) as scratch:
        table = scratch.settle(spark.range(3), "brief")
        (folder,) = {os.path.dirname(f.removeprefix("file:")) for f in table.inputFiles()}
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_settled_table_lies_in_the_shared_folder(spark):
    table = shared.settle(spark.range(3), "three")
    assert table.count() == 3
    folder = shared.shared_folder(spark).removeprefix("file:").rstrip("/")
    assert all(f"{folder}/three-" in path for path in table.inputFiles())


def test_settled_empty_table_keeps_its_schema(spark):
    table = shared.settle(spark.range(0), "none")
    assert table.columns == ["id"] and table.count() == 0


ORDERS = [
    line(size="XXL", state="goa", promos="a,b,c", amount="100"),
    line(date="04-10-22", size="XXL", state="goa", promos="a,b,c", amount="100", sku="k2"),
    line(date="04-10-22", size="L", state="goa", promos="c,b,a", amount="10", qty="3"),
    line(date="bad", state="goa"),
]
EXPECTED = {
    "rolling-top-size": ("window_date,state,most_bought_size", 9),
    "median-variety": ("month,state,median_variety", 1),
}


@pytest.mark.parametrize("job", sorted(JOBS))
def test_jobs_from_csv(spark, tmp_path, job):
    source, target = export(tmp_path, ORDERS), str(tmp_path / "out")
    folder = shared.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    main([job, source, target])
    main([job, source, target])  # replaces its result
    assert set(os.listdir(folder) if os.path.isdir(folder) else []) == before
    if job in EXPECTED:
        header, *rows = written(target).splitlines()
        assert (header, len(rows)) == EXPECTED[job]
        assert rows == sorted(rows)
        if job == "median-variety":
            assert rows == ["2022-04,Goa,2.0"]
        else:
            assert rows[0] == "2022-04-09,GOA,XXL" and rows[-1] == "2022-04-17,GOA,L"
    elif job == "city-cancellation":
        assert [tuple(r) for r in spark.read.parquet(target).collect()] == [
            ("PUNE", "GOA", 1, 0, 0.0, 70.0)]
    else:
        found = spark.read.parquet(target)
        assert found.columns == ["SKU", "year", "month", "std_p90_approx", "std_p80_approx",
                                 "std_p90_exact", "std_p80_exact"]
        assert [(r.SKU, r.std_p90_exact) for r in found.collect()] == [("k", 45.0), ("k2", 0.0)]
