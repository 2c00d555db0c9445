"""The ``sales`` order table as a view over star-schema tables (orders, customer, ...)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Size labels by p_size modulo 8.
SIZES = ["S", "M", "L", "XL", "XXL", "3XL", "4XL", "6XL"]

SALES_COLUMNS = [
    "row_key", "order_date", "status", "fulfilment", "courier_status", "service_level",
    "qty", "amount", "size", "sku", "style", "ship_city", "ship_state", "promotion_ids",
]


def sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Sales rows with the asked-for columns (all when none are named).

    Only the tables those columns need are joined: every order has exactly one
    customer, nation, region and part, so leaving a join out keeps all rows.
    """
    wanted = list(columns) or SALES_COLUMNS

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    rows = table("orders")
    if {"fulfilment", "ship_city", "ship_state"} & set(wanted):
        rows = rows.join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    if {"ship_city", "ship_state"} & set(wanted):
        rows = rows.join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    if "ship_state" in wanted:
        rows = rows.join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    if {"size", "sku", "style"} & set(wanted):
        part = table("part")
        n_parts = part.select(F.count(F.lit(1))).scalar()
        rows = rows.withColumn("sale_partkey", F.col("o_orderkey") % n_parts).join(
            part, F.col("sale_partkey") == F.col("p_partkey")
        )
    definitions = _definitions()
    return rows.select(*[definitions[c]().alias(c) for c in wanted])


def _definitions() -> dict[str, Callable[[], Column]]:
    return {
        "row_key": lambda: F.col("o_orderkey"),
        "order_date": lambda: F.col("o_orderdate").cast("date"),
        "status": lambda: F.when(
            F.col("o_orderstatus") == "F", "Shipped - Delivered to Buyer"
        ).when(F.col("o_orderstatus") == "O", "Shipped").otherwise("Cancelled"),
        "fulfilment": lambda: F.when(
            F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"), "Merchant"
        ).otherwise("Amazon"),
        "courier_status": lambda: F.when(
            F.col("o_orderstatus") == "P", "Cancelled"
        ).otherwise("Shipped"),
        "service_level": lambda: F.when(
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Expedited"
        ).otherwise("Standard"),
        "qty": lambda: (F.col("o_orderkey") % 4).cast("int"),
        "amount": lambda: F.col("o_totalprice"),
        "size": lambda: F.element_at(
            F.array(*[F.lit(s) for s in SIZES]), (F.col("p_size") % 8 + 1).cast("int")
        ),
        "sku": lambda: F.col("p_brand"),
        "style": lambda: F.col("p_type"),
        "ship_city": lambda: F.col("n_name"),
        "ship_state": lambda: F.col("r_name"),
        "promotion_ids": _promotion_ids,
    }


def _promotion_ids() -> Column:
    """Text list of o_orderkey % 7 promotions, some tied to the order's own day."""
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date").cast("string")

    def promotion(i: int) -> Column:
        name = F.when((key + i) % 3 == 0, F.concat(F.lit("FLASH-"), day)).otherwise(
            F.concat(F.lit("PROMO-"), ((key * 31 + i * 17) % 40).cast("string"))
        )
        return F.when(key % 7 > i, name)

    # concat_ws leaves out the nulls of the unused places and stays in codegen.
    return F.concat_ws(",", *[promotion(i) for i in range(6)])
