"""SQL for the queries of ``upkeep``, on the same tables."""

from __future__ import annotations

from ordermill.plans.oracles import (
    COARSE, COMPARED, EXACT, ITEMS, SET_DIFF, SKU_ORDERS, STEPS, TOP_SIZE_SQL, sql,
)

# Sales with the faults of the export: as the two CSV jobs read them, and as the others do.
_KIND = "row_key % 13"
_CENTURY = "make_date(2000 + year(order_date) % 100, month(order_date), day(order_date))"
_LAST_DAY = "last_day(make_date(2000 + year(order_date) % 100, 2, 1))"


def _faulty(date: str, state: str) -> str:
    return f"""
        SELECT row_key,
               CASE WHEN {_KIND} = 1 THEN {date} WHEN {_KIND} <> 2 THEN {_CENTURY} END AS order_date,
               status, fulfilment, service_level, courier_status,
               CAST(CASE WHEN {_KIND} = 5 THEN 0 ELSE qty END AS INTEGER) AS qty, amount,
               CASE WHEN {_KIND} <> 3 THEN size END AS size,
               CASE WHEN {_KIND} <> 0 THEN sku END AS sku,
               CASE WHEN {_KIND} <> 0 THEN style END AS style,
               CASE WHEN {_KIND} <> 0 THEN ship_city END AS ship_city,
               CASE WHEN {_KIND} <> 0 THEN {state} END AS ship_state,
               CASE WHEN {_KIND} <> 0 THEN promotion_ids END AS promotion_ids
        FROM ({STEPS["sales"]})"""


_TRIMMED = {"sales": _faulty(_LAST_DAY, "ship_state")}
_PLAIN = {"sales": _faulty("NULL", f"CASE WHEN {_KIND} = 4 THEN ship_state || chr(9) ELSE ship_state END")}
_USED_PURCHASES = {"purchases": STEPS["purchases"] + """
        AND size IS NOT NULL AND ship_state IS NOT NULL AND order_date IS NOT NULL"""}
_USED_ITEMS = {"items": STEPS["items"] + """
        AND sku IS NOT NULL AND style IS NOT NULL AND ship_state IS NOT NULL
        AND order_date IS NOT NULL"""}


def _job_counts() -> str:
    def rows(job: str, steps: list[str], bodies: dict[str, str], points: dict[str, str]) -> str:
        counts = " UNION ALL ".join(
            f"SELECT '{job}' AS job, '{point}' AS point, count(*) AS n_rows FROM {table}"
            for point, table in points.items())
        return f"SELECT * FROM ({sql(steps, counts, bodies=bodies)})"

    return " UNION ALL ".join([
        rows("rolling-top-size", ["sales", "purchases", "fanned", "size_qty", "top_size"],
             _TRIMMED | _USED_PURCHASES, {"read": "sales", "kept": "purchases", "result": "top_size"}),
        rows("median-variety", ["sales", "items"], _TRIMMED | _USED_ITEMS,
             {"read": "sales", "kept": "items",
              "result": "(SELECT DISTINCT month, state FROM items)"}),
        rows("city-cancellation",
             ["sales", "prepared", "exploded", "spans", "valid", "valid_rows", "valid_counts",
              "averages", "enriched", "qualified", "cities"], _PLAIN,
             {"read": "sales", "kept": "prepared", "valid_promotions": "valid", "result": "cities"}),
        rows("sku-month-std", ["sales", "sku_orders"], _PLAIN,
             {"read": "sales", "kept": "sku_orders",
              "result": "(SELECT DISTINCT sku, year, month FROM sku_orders)"}),
    ])


_REJECTED = sql(["sales"], """
        SELECT 'rolling-top-size' AS question,
               CASE WHEN row_key % 13 = 0 THEN 'short line'
                    WHEN lower(status) NOT LIKE '%shipped%' THEN 'not shipped'
                    WHEN qty <= 0 THEN 'no quantity' WHEN size IS NULL THEN 'no size'
                    WHEN order_date IS NULL THEN 'unreadable date' ELSE 'kept' END AS reason,
               count(*) AS n_lines
        FROM sales GROUP BY ALL
        UNION ALL
        SELECT 'median-variety',
               CASE WHEN row_key % 13 = 0 THEN 'short line'
                    WHEN size IS NULL OR size NOT IN ('XXL', '3XL', '4XL', '5XL', '6XL') THEN 'other size'
                    WHEN order_date IS NULL THEN 'unreadable date' ELSE 'kept' END,
               count(*)
        FROM sales GROUP BY ALL""", bodies=_TRIMMED)

ORACLES: dict[str, str] = {
    "thresholds_percentile_approx": sql(
        EXACT, """SELECT sku, year, month, p90_thresh_exact AS p90_thresh, p80_thresh_exact AS p80_thresh
                  FROM exact"""),
    # Groups of no more than the sketch's 200 values have exact sketches.
    "thresholds_sketch": sql(
        EXACT, """SELECT sku, year, month, n_orders, p90_thresh_exact, p80_thresh_exact,
                         p90_thresh_exact AS p90_thresh_sketch, p80_thresh_exact AS p80_thresh_sketch,
                         n_orders <= 200 AS p90_within, n_orders <= 200 AS p80_within
                  FROM exact JOIN (SELECT sku, year, month, count(*) AS n_orders FROM sku_orders
                                   GROUP BY sku, year, month) USING (sku, year, month)"""),
    "thresholds_sketch_by_sku": sql(
        SKU_ORDERS, """SELECT sku, count(*) AS n_orders,
                              quantile_disc(promo_count, 0.9) AS p90_thresh_exact,
                              quantile_disc(promo_count, 0.8) AS p80_thresh_exact,
                              true AS p90_within, true AS p80_within
                       FROM sku_orders GROUP BY sku"""),
    "rolling_top_size_incremental": TOP_SIZE_SQL,
    "rolling_top_size_stream": TOP_SIZE_SQL,
    "largest_groups_by_summary": sql(
        SKU_ORDERS, """SELECT sku, year, month, count(*) AS n_orders,
                              round(count(*) * 200 / 1048576.0::DOUBLE, 4) AS est_size_mb
                       FROM sku_orders GROUP BY sku, year, month HAVING count(*) > 10
                       ORDER BY n_orders DESC, sku, year, month LIMIT 20"""),
    "variety_by_month_bitmaps": sql(
        ITEMS, """SELECT month, state, style, count(DISTINCT sku) AS variety
                  FROM items GROUP BY month, state, style"""),
    "variety_by_year_bitmaps": sql(
        ITEMS, """SELECT CAST(month[:4] AS INTEGER) AS year, state, count(DISTINCT sku) AS variety
                  FROM items GROUP BY ALL"""),
    "median_variety_by_year": sql(
        ITEMS, """SELECT year, state, CAST(median(variety) AS DOUBLE) AS median_variety
                  FROM (SELECT CAST(month[:4] AS INTEGER) AS year, state, style,
                               count(DISTINCT sku) AS variety FROM items GROUP BY ALL)
                  GROUP BY year, state"""),
    "threshold_compare_stored": sql(COMPARED, "SELECT * FROM compared", COARSE),
    "qualifying_set_diff_stored": sql(SET_DIFF, "SELECT * FROM set_diff", COARSE),
    "scan_csv_padded": sql(
        ["sales"], "SELECT order_date, qty, status, coalesce(size, '') AS size, sku, style, ship_state FROM sales",
        bodies=_TRIMMED),
    "rejected_lines": _REJECTED,
    "job_counts": _job_counts(),
}
