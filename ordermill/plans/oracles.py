"""SQL for the catalog's queries, written from the question, not from the Spark code.

Each text runs on the star-schema tables alone. Common steps are spelled as
WITH clauses; a query lists the ones it needs, in order.
"""

from __future__ import annotations


def _approx(accuracy: int) -> str:
    """The smallest promotion counts whose shares reach p - 1 / accuracy."""
    return f"""
        SELECT sku, year, month,
               min(promo_count) FILTER (cume_dist >= {0.9 - 1 / accuracy!r}::DOUBLE) AS p90_thresh,
               min(promo_count) FILTER (cume_dist >= {0.8 - 1 / accuracy!r}::DOUBLE) AS p80_thresh
        FROM shares GROUP BY sku, year, month"""


STEPS = {
    "sales": """
        SELECT o_orderkey AS row_key,
               CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'Shipped - Delivered to Buyer'
                                  WHEN 'O' THEN 'Shipped' ELSE 'Cancelled' END AS status,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
                    THEN 'Merchant' ELSE 'Amazon' END AS fulfilment,
               CASE WHEN o_orderstatus = 'P' THEN 'Cancelled' ELSE 'Shipped' END
                    AS courier_status,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                    THEN 'Expedited' ELSE 'Standard' END AS service_level,
               CAST(o_orderkey % 4 AS INTEGER) AS qty,
               o_totalprice AS amount,
               CASE p_size % 8 WHEN 0 THEN 'S' WHEN 1 THEN 'M' WHEN 2 THEN 'L' WHEN 3 THEN 'XL'
                    WHEN 4 THEN 'XXL' WHEN 5 THEN '3XL' WHEN 6 THEN '4XL' ELSE '6XL' END AS size,
               p_brand AS sku,
               p_type AS style,
               n_name AS ship_city,
               r_name AS ship_state,
               array_to_string(
                   [CASE WHEN (o_orderkey + i) % 3 = 0
                         THEN 'FLASH-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
                         ELSE 'PROMO-' || CAST((o_orderkey * 31 + i * 17) % 40 AS VARCHAR)
                    END for i in range(0, 7) if i < o_orderkey % 7], ',') AS promotion_ids
        FROM (SELECT *, o_orderkey % (SELECT count(*) FROM part) AS o_partkey FROM orders)
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        JOIN part ON p_partkey = o_partkey""",
    # rolling top size
    "purchases": """
        SELECT row_key, order_date, upper(ship_state) AS state, upper(size) AS size, qty
        FROM sales WHERE lower(status) LIKE '%shipped%' AND qty > 0""",
    "fanned": """
        SELECT order_date + CAST(k AS INTEGER) AS window_date, order_date, state, size, qty
        FROM purchases, range(1, 8) AS days(k)""",
    "size_qty": """
        SELECT window_date, state, size, CAST(sum(qty) AS BIGINT) AS qty
        FROM fanned GROUP BY window_date, state, size""",
    "top_size": """
        SELECT window_date, state, size AS most_bought_size
        FROM (SELECT *, row_number() OVER (PARTITION BY window_date, state
                                           ORDER BY qty DESC, size) AS place FROM size_qty)
        WHERE place = 1""",
    # median variety
    "items": """
        SELECT row_key, strftime(order_date, '%Y-%m') AS month,
               array_to_string([upper(w[1]) || w[2:]
                                for w in string_split(lower(ship_state), ' ')], ' ') AS state,
               style, sku
        FROM sales WHERE size IN ('XXL', '3XL', '4XL', '5XL', '6XL')""",
    "variety": """
        SELECT month, state, style, count(DISTINCT sku) AS variety
        FROM items GROUP BY month, state, style""",
    # city cancellation
    "prepared": """
        SELECT row_key, order_date, amount, lower(status) AS status,
               lower(fulfilment) AS fulfilment, lower(service_level) AS service_level,
               lower(courier_status) AS courier_status, upper(ship_city) AS ship_city,
               upper(ship_state) AS ship_state, promotion_ids
        FROM sales
        WHERE order_date IS NOT NULL AND amount IS NOT NULL
          AND length(ship_city) > 0 AND length(ship_state) > 0""",
    "exploded": """
        SELECT row_key, order_date, trim(piece) AS promotion_id
        FROM (SELECT row_key, order_date, unnest(string_split(promotion_ids, ',')) AS piece
              FROM prepared)
        WHERE length(trim(piece)) > 0""",
    "spans": """
        SELECT promotion_id, min(order_date) AS first_seen_date,
               max(order_date) AS last_seen_date,
               CAST(max(order_date) - min(order_date) AS INTEGER) AS active_days
        FROM exploded GROUP BY promotion_id""",
    "valid": "SELECT * FROM spans WHERE active_days >= 2",
    "valid_rows": """
        SELECT row_key, promotion_id FROM exploded JOIN valid USING (promotion_id)""",
    "valid_counts": """
        SELECT row_key, count(DISTINCT promotion_id) AS valid_promotion_count
        FROM valid_rows GROUP BY row_key""",
    "averages": """
        SELECT ship_state, avg(amount) AS state_avg_merchant_shipped_amount
        FROM prepared WHERE fulfilment = 'merchant' AND courier_status = 'shipped'
        GROUP BY ship_state""",
    "enriched": """
        SELECT prepared.*, coalesce(valid_promotion_count, 0) AS valid_promotion_count,
               state_avg_merchant_shipped_amount
        FROM prepared LEFT JOIN valid_counts USING (row_key)
        LEFT JOIN averages USING (ship_state)""",
    "qualified": """
        SELECT * FROM enriched
        WHERE service_level = 'standard' AND valid_promotion_count >= 3
          AND amount < state_avg_merchant_shipped_amount""",
    "cities": """
        SELECT ship_city, ship_state, count(*) AS qualified_standard_order_count,
               CAST(sum(CASE WHEN status LIKE '%cancelled%' THEN 1 ELSE 0 END) AS BIGINT)
                   AS cancelled_order_count,
               round(sum(CASE WHEN status LIKE '%cancelled%' THEN 1 ELSE 0 END) * 100.0
                     / count(*), 4) AS cancelled_percentage,
               round(max(state_avg_merchant_shipped_amount), 4)
                   AS state_avg_merchant_shipped_amount
        FROM qualified GROUP BY ship_city, ship_state""",
    # deviation per SKU and month
    "sku_orders": """
        SELECT row_key, sku, CAST(year(order_date) AS INTEGER) AS year,
               CAST(month(order_date) AS INTEGER) AS month,
               CAST(CASE WHEN trim(coalesce(promotion_ids, '')) = '' THEN 0
                    ELSE len(string_split(trim(promotion_ids), ',')) END AS BIGINT)
                    AS promo_count,
               amount
        FROM sales
        WHERE order_date IS NOT NULL AND sku IS NOT NULL AND amount IS NOT NULL""",
    "shares": """
        SELECT row_key, sku, year, month, promo_count, amount,
               cume_dist() OVER (PARTITION BY sku, year, month ORDER BY promo_count)
                   AS cume_dist
        FROM sku_orders""",
    "exact": """
        SELECT sku, year, month,
               quantile_disc(promo_count, 0.9) AS p90_thresh_exact,
               quantile_disc(promo_count, 0.8) AS p80_thresh_exact
        FROM sku_orders GROUP BY sku, year, month""",
    "approx": _approx(1_000_000),
    "bounded": """
        SELECT * FROM sku_orders JOIN exact USING (sku, year, month)""",
    "stds": """
        SELECT sku, year, month,
               coalesce(stddev_pop(amount) FILTER (promo_count >= p90_thresh_exact), 0.0) AS p90,
               coalesce(stddev_pop(amount) FILTER (promo_count >= p80_thresh_exact), 0.0) AS p80
        FROM bounded GROUP BY sku, year, month""",
    "approx_bounded": """
        SELECT * FROM sku_orders JOIN approx USING (sku, year, month)""",
    "approx_stds": """
        SELECT sku, year, month,
               coalesce(stddev_pop(amount) FILTER (promo_count >= p90_thresh), 0.0) AS a90,
               coalesce(stddev_pop(amount) FILTER (promo_count >= p80_thresh), 0.0) AS a80
        FROM approx_bounded GROUP BY sku, year, month""",
    "std_diffs": """
        SELECT sku AS "SKU", year, month,
               round(a90, 4) AS std_p90_approx, round(a80, 4) AS std_p80_approx,
               round(p90, 4) AS std_p90_exact, round(p80, 4) AS std_p80_exact,
               round(abs(a90 - p90), 4) AS diff_std_p90, round(abs(a80 - p80), 4) AS diff_std_p80
        FROM stds JOIN approx_stds USING (sku, year, month)""",
    "approx_passing": """
        SELECT sku, year, month, count(*) FILTER (promo_count >= p90_thresh) AS m
        FROM approx_bounded GROUP BY sku, year, month""",
    "set_diff": """
        SELECT sku, year, month, m AS n_qualified_approx, n AS n_qualified_exact,
               m - n AS diff_count
        FROM passing JOIN approx_passing USING (sku, year, month)""",
    "compared": """
        SELECT sku, year, month, p90_thresh, p80_thresh, p90_thresh_exact, p80_thresh_exact,
               CAST(p90_thresh AS DOUBLE) - CAST(p90_thresh_exact AS DOUBLE) AS diff_p90,
               CAST(p80_thresh AS DOUBLE) - CAST(p80_thresh_exact AS DOUBLE) AS diff_p80
        FROM approx JOIN exact USING (sku, year, month)""",
    "passing": """
        SELECT sku, year, month,
               count(*) FILTER (promo_count >= p90_thresh_exact) AS n
        FROM bounded GROUP BY sku, year, month""",
    "sizes": """
        SELECT sku, year, month, count(*) AS n_orders,
               count(*) * 200 / 1048576.0::DOUBLE AS est_size_mb
        FROM sku_orders GROUP BY sku, year, month""",
}

_PURCHASES = ["sales", "purchases"]
_SIZE_QTY = [*_PURCHASES, "fanned", "size_qty"]
_TOP_SIZE = [*_SIZE_QTY, "top_size"]
ITEMS = ["sales", "items"]
_SPANS = ["sales", "prepared", "exploded", "spans"]
_VALID_ROWS = [*_SPANS, "valid", "valid_rows"]
_ENRICHED = [*_VALID_ROWS, "valid_counts", "averages", "enriched"]
_CITIES = [*_ENRICHED, "qualified", "cities"]
SKU_ORDERS = ["sales", "sku_orders"]
EXACT = [*SKU_ORDERS, "exact"]
_STDS = [*EXACT, "bounded", "stds"]
_APPROX = [*SKU_ORDERS, "shares", "approx"]
COMPARED = [*EXACT, "shares", "approx", "compared"]
_APPROX_STDS = [*_APPROX, "approx_bounded", "approx_stds"]
_STD_DIFFS = [*_STDS, *_APPROX_STDS[2:], "std_diffs"]
SET_DIFF = [*EXACT, "bounded", "passing", "shares", "approx", "approx_bounded",
             "approx_passing", "set_diff"]


def sql(
    steps: list[str], select: str, accuracy: int | None = None, bodies: dict[str, str] | None = None
) -> str:
    """A query over these steps; ``bodies`` replaces some of them."""
    bodies = STEPS | ({"approx": _approx(accuracy)} if accuracy else {}) | (bodies or {})
    clauses = ",\n".join(f"{name} AS MATERIALIZED ({bodies[name]})" for name in steps)
    return f"WITH {clauses}\n{select}"


TOP_SIZE_SQL = sql(_TOP_SIZE, "SELECT * FROM top_size")
_CITIES_SQL = sql(_CITIES, "SELECT * FROM cities")
_STD_SQL = sql(_STD_DIFFS, "SELECT * EXCLUDE (diff_std_p90, diff_std_p80) FROM std_diffs")
_DIFF_SUMMARY = """SELECT count(*) AS n_groups,
                  count(*) FILTER (diff_p90 <> 0) AS n_diff_p90,
                  round(100.0 * count(*) FILTER (diff_p90 <> 0) / count(*), 2) AS pct_diff_p90,
                  avg(abs(diff_p90)) AS mean_abs_diff_p90,
                  max(abs(diff_p90)) AS max_abs_diff_p90,
                  count(*) FILTER (diff_p80 <> 0) AS n_diff_p80,
                  round(100.0 * count(*) FILTER (diff_p80 <> 0) / count(*), 2) AS pct_diff_p80,
                  avg(abs(diff_p80)) AS mean_abs_diff_p80,
                  max(abs(diff_p80)) AS max_abs_diff_p80
           FROM compared"""
_DISAGREEMENTS = """SELECT sku, year, month, p90_thresh, p90_thresh_exact, diff_p90,
                  p80_thresh, p80_thresh_exact, diff_p80
           FROM compared WHERE diff_p90 <> 0 OR diff_p80 <> 0
           ORDER BY sku, year, month LIMIT 10"""
_SET_SUMMARY = """SELECT count(*) AS n_groups, count(*) FILTER (diff_count <> 0) AS n_diff,
                  round(100.0 * count(*) FILTER (diff_count <> 0) / count(*), 2) AS pct_diff
           FROM set_diff"""
_STD_SUMMARY = """SELECT count(*) AS n_groups,
                  count(*) FILTER (diff_std_p90 > 1e-9) AS n_diff_std_p90,
                  count(*) FILTER (diff_std_p80 > 1e-9) AS n_diff_std_p80 FROM std_diffs"""
_SET_DISAGREEMENTS = """SELECT * FROM set_diff WHERE diff_count <> 0
           ORDER BY abs(diff_count) DESC, sku, year, month LIMIT 10"""
_LARGEST_STD_DIFFS = """SELECT * FROM std_diffs
           ORDER BY diff_std_p90 DESC, "SKU", year, month LIMIT 10"""
# The low accuracy of the coarse queries.
COARSE = 2

# Promotion lists with blanks and empty pieces in every fifth row.
_RAGGED = """CASE WHEN row_key % 5 = 0 THEN replace(promotion_ids, ',', ' , ') || ', ,'
                 ELSE promotion_ids END"""

ORACLES: dict[str, str] = {
    "scan_csv_normalised": sql(
        ["sales"],
        "SELECT * EXCLUDE (row_key) REPLACE (round(amount, 4) AS amount) FROM sales",
    ),
    "parse_dates": sql(
        ["sales"],
        """SELECT row_key, shown AS date,
                  CASE WHEN form IN (0, 1, 2) THEN this_century
                       WHEN form IN (3, 4, 5, 6) THEN order_date END AS any_date,
                  CASE WHEN form = 2 OR form = 1 AND shown LIKE '__-__-__'
                       THEN this_century END AS sale_date
           FROM (SELECT *, row_key % 9 AS form,
                   make_date(2000 + year(order_date) % 100, month(order_date), day(order_date))
                       AS this_century,
                   CASE row_key % 9
                     WHEN 0 THEN strftime(order_date, '%-m/%-d/%y')
                     WHEN 1 THEN strftime(order_date, '%-m-%-d-%y')
                     WHEN 2 THEN strftime(order_date, '%m-%d-%y')
                     WHEN 3 THEN strftime(order_date, '%m-%d-%Y')
                     WHEN 4 THEN strftime(order_date, '%Y-%m-%d')
                     WHEN 5 THEN strftime(order_date, '%-m/%-d/%Y')
                     WHEN 6 THEN strftime(order_date, '%m/%d/%Y')
                     WHEN 7 THEN strftime(order_date, '%Y/%m/%d')
                     ELSE '02-30-22' END AS shown
                 FROM sales)""",
    ),
    "month_key": sql(
        ["sales"], "SELECT row_key, strftime(order_date, '%Y-%m') AS month FROM sales"
    ),
    "normalise_state": sql(
        ["sales"],
        """SELECT row_key, CASE row_key % 5 WHEN 0 THEN 'Odisha' WHEN 1 THEN 'Rajasthan'
                  ELSE array_to_string(
                      [upper(w[1]) || w[2:]
                       for w in string_split(lower(ship_state || ' & ' || ship_city), ' ')],
                      ' ') END AS state
           FROM sales""",
    ),
    "filter_shipped": sql(_PURCHASES, "SELECT * FROM purchases"),
    "rolling_fanout": sql(
        [*_PURCHASES, "fanned"],
        """SELECT window_date, order_date, state, size, CAST(sum(qty) AS BIGINT) AS qty
           FROM fanned GROUP BY window_date, order_date, state, size""",
    ),
    "rolling_size_qty": sql(_SIZE_QTY, "SELECT * FROM size_qty"),
    "rolling_top_size": TOP_SIZE_SQL,
    "rolling_top_size_window": TOP_SIZE_SQL,
    "write_csv_result": TOP_SIZE_SQL,
    "filter_size_class": sql(ITEMS, "SELECT * FROM items"),
    "distinct_style_skus": sql(
        ITEMS, "SELECT DISTINCT month, state, style, sku FROM items"
    ),
    "variety_per_style": sql([*ITEMS, "variety"], "SELECT * FROM variety"),
    "median_variety": sql(
        [*ITEMS, "variety"],
        """SELECT month, state, CAST(median(variety) AS DOUBLE) AS median_variety
           FROM variety GROUP BY month, state""",
    ),
    "prepare_orders": sql(
        ["sales", "prepared"],
        """SELECT * REPLACE (round(amount, 4) AS amount),
                  CAST(len([p for p in string_split(promotion_ids, ',') if p <> ''])
                       AS INTEGER) AS n_promos
           FROM prepared""",
    ),
    "promo_arrays": sql(
        ["sales"],
        f"""SELECT row_key, CAST(len(promos) AS INTEGER) AS n_promos,
                  array_to_string(promos, '|') AS promos
           FROM (SELECT row_key, list_filter(
                     list_transform(string_split({_RAGGED}, ','), lambda p: trim(p)), lambda p: p <> '') AS promos
                 FROM sales)""",
    ),
    "promo_count": sql(
        ["sales"],
        f"""SELECT row_key, CASE WHEN trim(coalesce(ragged, '')) = '' THEN 0
                                ELSE CAST(len(string_split(ragged, ',')) AS BIGINT) END AS promo_count
           FROM (SELECT row_key, {_RAGGED} AS ragged FROM sales)""",
    ),
    "promo_rows": sql(["sales", "prepared", "exploded"], "SELECT * FROM exploded"),
    "promo_active_span": sql(_SPANS, "SELECT * FROM spans"),
    "valid_promotions": sql([*_SPANS, "valid"], "SELECT * FROM valid"),
    "valid_promo_rows": sql(_VALID_ROWS, "SELECT * FROM valid_rows"),
    "valid_promo_rows_stored": sql(_VALID_ROWS, "SELECT * FROM valid_rows"),
    "valid_promo_count": sql(
        [*_VALID_ROWS, "valid_counts"], "SELECT * FROM valid_counts"
    ),
    "orders_with_promo_count": sql(
        _ENRICHED, "SELECT row_key, ship_city, ship_state, valid_promotion_count FROM enriched"
    ),
    "state_avg_amount": sql(
        ["sales", "prepared", "averages"],
        """SELECT ship_state, round(state_avg_merchant_shipped_amount, 4)
                  AS state_avg_merchant_shipped_amount FROM averages""",
    ),
    "orders_with_state_avg": sql(
        _ENRICHED,
        """SELECT row_key, ship_state, round(amount, 4) AS amount,
                  round(state_avg_merchant_shipped_amount, 4)
                  AS state_avg_merchant_shipped_amount FROM enriched""",
    ),
    "qualified_orders": sql(
        [*_ENRICHED, "qualified"],
        """SELECT row_key, ship_city, ship_state, status, round(amount, 4) AS amount,
                  valid_promotion_count, round(state_avg_merchant_shipped_amount, 4)
                  AS state_avg_merchant_shipped_amount FROM qualified""",
    ),
    "city_cancellation": _CITIES_SQL,
    "city_cancellation_by_orders": _CITIES_SQL,
    "city_cancellation_generated_key": _CITIES_SQL,
    "clean_counts": sql(
        [*_SPANS, "valid", "sku_orders"],
        """SELECT (SELECT count(*) FROM sales) AS rows_in,
                  (SELECT count(*) FROM prepared) AS city_rows_kept,
                  (SELECT count(*) FROM sku_orders) AS sku_rows_kept,
                  (SELECT count(*) FROM sales) - (SELECT count(*) FROM sku_orders)
                      AS sku_rows_dropped,
                  (SELECT count(*) FROM valid) AS valid_promotions""",
    ),
    "prepare_sku_orders": sql(
        SKU_ORDERS, "SELECT * REPLACE (round(amount, 4) AS amount) FROM sku_orders"
    ),
    "promo_profile": sql(
        SKU_ORDERS,
        """SELECT sku, year, month, promo_count, count(*) AS n_orders,
                  round(sum(amount), 2) AS amount_total,
                  CAST(sum(count(*)) OVER (PARTITION BY sku, year, month
                                           ORDER BY promo_count) AS BIGINT) AS cume_orders,
                  CAST(sum(count(*)) OVER (PARTITION BY sku, year, month) AS BIGINT)
                      AS group_orders
           FROM sku_orders GROUP BY sku, year, month, promo_count""",
    ),
    "promo_cume_dist": sql(
        [*SKU_ORDERS, "shares"],
        """SELECT row_key, sku, year, month, promo_count, round(cume_dist, 4) AS cume_dist
           FROM shares""",
    ),
    "thresholds_exact": sql(EXACT, "SELECT * FROM exact"),
    "thresholds_exact_by_rows": sql(
        [*SKU_ORDERS, "shares"],
        """SELECT sku, year, month,
                  min(promo_count) FILTER (cume_dist >= 0.9) AS p90_thresh_exact,
                  min(promo_count) FILTER (cume_dist >= 0.8) AS p80_thresh_exact
           FROM shares GROUP BY sku, year, month""",
    ),
    "thresholds_approx": sql(_APPROX, "SELECT * FROM approx"),
    "thresholds_approx_coarse": sql(_APPROX, "SELECT * FROM approx", COARSE),
    "orders_with_thresholds": sql(
        [*EXACT, "bounded"], "SELECT * EXCLUDE (amount) FROM bounded"
    ),
    "qualifying_orders": sql(
        [*EXACT, "bounded"],
        "SELECT * EXCLUDE (amount) FROM bounded WHERE promo_count >= p90_thresh_exact",
    ),
    "sku_month_spine": sql(SKU_ORDERS, "SELECT DISTINCT sku, year, month FROM sku_orders"),
    "spine_left_join": sql(
        [*_STDS, "passing"],
        """SELECT sku, year, month, n AS cnt_p90_exact, round(p90, 4) AS std_p90_exact
           FROM stds JOIN passing USING (sku, year, month)""",
    ),
    "sku_month_std_exact": sql(
        _STDS, """SELECT sku, year, month, round(p90, 4) AS std_p90_exact, round(p80, 4) AS std_p80_exact
           FROM stds"""
    ),
    "sku_month_std_approx": sql(
        _APPROX_STDS,
        """SELECT sku, year, month, round(a90, 4) AS std_p90_approx, round(a80, 4) AS std_p80_approx
           FROM approx_stds""",
    ),
    "sku_month_std": _STD_SQL,
    "write_parquet_result": _STD_SQL,
    "threshold_compare": sql(COMPARED, "SELECT * FROM compared"),
    "threshold_diff_summary": sql(COMPARED, _DIFF_SUMMARY),
    "threshold_diff_summary_coarse": sql(COMPARED, _DIFF_SUMMARY, COARSE),
    "threshold_disagreements": sql(COMPARED, _DISAGREEMENTS),
    "threshold_disagreements_coarse": sql(COMPARED, _DISAGREEMENTS, COARSE),
    "qualifying_set_diff": sql(SET_DIFF, "SELECT * FROM set_diff"),
    "qualifying_diff_summary": sql(SET_DIFF, _SET_SUMMARY),
    "qualifying_diff_summary_coarse": sql(SET_DIFF, _SET_SUMMARY, COARSE),
    "qualifying_disagreements": sql(SET_DIFF, _SET_DISAGREEMENTS),
    "qualifying_disagreements_coarse": sql(SET_DIFF, _SET_DISAGREEMENTS, COARSE),
    "sku_month_sizes": sql(
        [*SKU_ORDERS, "sizes"],
        "SELECT sku, year, month, n_orders, round(est_size_mb, 4) AS est_size_mb FROM sizes",
    ),
    "largest_groups": sql(
        [*SKU_ORDERS, "sizes"],
        """SELECT sku, year, month, n_orders, round(est_size_mb, 4) AS est_size_mb
           FROM sizes WHERE n_orders > 10
           ORDER BY n_orders DESC, sku, year, month LIMIT 20""",
    ),
    "group_size_summary": sql(
        [*SKU_ORDERS, "sizes"],
        """SELECT count(*) AS n_large_groups, round(max(est_size_mb), 8) AS max_size_mb,
                  round(max(est_size_mb) / 128.0, 8) AS partition_ratio
           FROM sizes WHERE n_orders > 10""",
    ),
    "std_diff": sql(_STD_DIFFS, "SELECT * FROM std_diffs"),
    "std_diff_summary": sql(_STD_DIFFS, _STD_SUMMARY),
    "std_diff_summary_coarse": sql(_STD_DIFFS, _STD_SUMMARY, COARSE),
    "largest_std_diffs": sql(_STD_DIFFS, _LARGEST_STD_DIFFS),
    "largest_std_diffs_coarse": sql(_STD_DIFFS, _LARGEST_STD_DIFFS, COARSE),
}
