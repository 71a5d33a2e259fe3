"""ANSI SQL equivalents of the registered queries, run by another engine as a check.

Every text is self-contained: the fixture views it needs are prepended as CTEs.
Averages are CAST(SUM AS DOUBLE) / COUNT and rounding goes through DECIMAL, which both
engines evaluate to the same bits.
"""

from __future__ import annotations

_AMOUNT = (
    "CAST(unit_price * ordered * (CAST(1 AS DECIMAL(4,2)) - discount_pct) AS DECIMAL(18,2))"
)

_VIEWS = {
    "raw_orders": (
        (),
        f"""
    SELECT order_line_id, customer_id, product_id, warehouse_id, order_date, ship_date,
           delivery_date, quantity, unit_price, discount_pct,
           CAST(CASE WHEN negated THEN -{_AMOUNT} ELSE {_AMOUNT} END AS DECIMAL(18,2))
             AS total_amount,
           order_status, shipping_cost
    FROM (
      SELECT l_orderkey * 10 + l_linenumber AS order_line_id,
             CASE WHEN l_orderkey % 100 = 0 THEN NULL ELSE o_custkey END AS customer_id,
             l_partkey AS product_id,
             l_suppkey AS warehouse_id,
             CAST(o_orderdate AS DATE) AS order_date,
             CASE WHEN (l_orderkey + l_linenumber) % 25 = 0 THEN NULL
                  ELSE CAST(CAST(o_orderdate AS DATE) + CAST(1 + l_partkey % 5 AS INT) AS DATE)
             END AS ship_date,
             CAST(CAST(o_orderdate AS DATE)
                  + CAST(2 + l_partkey % 5 + l_suppkey % 7 AS INT) AS DATE) AS delivery_date,
             CASE WHEN l_partkey % 33 = 0 THEN -CAST(l_quantity AS INT)
                  ELSE CAST(l_quantity AS INT) END AS quantity,
             CAST(CAST(1000 + (l_partkey * 7919 + l_suppkey * 104729) % 99001 AS DECIMAL(12,0))
                  * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS unit_price,
             CAST(l_discount AS DECIMAL(4,2)) AS discount_pct,
             CAST(l_quantity AS DECIMAL(4,0)) AS ordered,
             (l_orderkey + l_partkey) % 50 = 7 AS negated,
             CASE WHEN l_returnflag = 'R' AND o_orderstatus = 'F' THEN 'Returned'
                  WHEN l_returnflag = 'A' AND o_orderstatus = 'O' THEN 'Cancelled'
                  WHEN o_orderstatus = 'F' THEN 'Delivered'
                  WHEN o_orderstatus = 'O' THEN 'Shipped'
                  ELSE 'Processing' END AS order_status,
             CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2))
                  AS DECIMAL(18,2)) AS shipping_cost
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ) base""",
    ),
    "customers": (
        (),
        """
    SELECT c_custkey AS customer_id, c_name AS customer_name,
           CASE WHEN c_custkey % 20 = 0 THEN NULL
                ELSE concat('c', CAST(c_custkey AS VARCHAR), '@example.com') END AS email,
           c_mktsegment AS segment, n_name AS city, n_name AS state, r_name AS country,
           CAST(DATE '1990-01-01' + CAST(c_custkey % 1600 AS INT) AS DATE) AS registration_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey""",
    ),
    "products": (
        (),
        """
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
           p_brand AS sub_category,
           CASE WHEN p_partkey % 50 = 0 THEN NULL
                ELSE CAST(p_retailprice * CAST(0.6 AS DOUBLE) AS DECIMAL(18,2)) END AS cost_price,
           CAST(p_retailprice AS DECIMAL(18,2)) AS list_price
    FROM part""",
    ),
    "warehouses": (
        (),
        """
    SELECT s_suppkey AS warehouse_id, s_name AS warehouse_name, n_name AS city,
           n_name AS state, r_name AS region,
           CAST(20000 + (s_suppkey * 977) % 30000 AS INT) AS capacity
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey""",
    ),
    "raw_inventory": (
        (),
        """
    SELECT p * 100000 + w AS inventory_id, p AS product_id, w AS warehouse_id,
           DATE '2001-08-02' AS snapshot_date,
           CASE WHEN (p + w) % 50 = 0 THEN NULL
                ELSE CAST((p * 37 + w * 101) % 501 AS INT) END AS quantity_on_hand,
           CAST((p * 11 + w * 3) % (1 + least((p * 37 + w * 101) % 501, 100)) AS INT)
             AS quantity_reserved,
           CAST(20 + (p * 13 + w * 7) % 81 AS INT) AS reorder_point
    FROM (SELECT DISTINCT l_partkey AS p, l_suppkey AS w FROM lineitem) pairs""",
    ),
    "clean_products": (
        ("products",),
        "\n    SELECT * REPLACE (COALESCE(cost_price, 0) AS cost_price) FROM products",
    ),
    "clean_inventory": (
        ("raw_inventory",),
        "\n    SELECT * REPLACE (COALESCE(quantity_on_hand, 0) AS quantity_on_hand)"
        " FROM raw_inventory",
    ),
    # ---- operators other queries build on
    "deduped": (
        ("raw_orders",),
        """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (
        PARTITION BY order_line_id
        ORDER BY product_id NULLS FIRST, warehouse_id NULLS FIRST, quantity NULLS FIRST,
                 unit_price NULLS FIRST, discount_pct NULLS FIRST, total_amount NULLS FIRST,
                 order_status NULLS FIRST, shipping_cost NULLS FIRST) AS rn
      FROM raw_orders) ranked WHERE rn = 1""",
    ),
    "passed": (
        ("deduped",),
        """
    SELECT * FROM deduped
    WHERE customer_id IS NOT NULL AND quantity > 0 AND total_amount > 0""",
    ),
    "stg_orders": (
        ("raw_orders",),
        """
    SELECT *, CAST(date_diff('day', order_date, delivery_date) AS INT) AS delivery_days,
           CAST(CASE WHEN order_status = 'Delivered' THEN 1 ELSE 0 END AS INT) AS is_delivered
    FROM raw_orders WHERE quantity > 0 AND total_amount > 0""",
    ),
    "stg_customers": (
        ("customers",),
        """
    SELECT customer_id, customer_name, COALESCE(email, 'unknown@example.com') AS email,
           segment, city, state, country, registration_date,
           CAST(date_diff('day', registration_date, DATE '2001-08-02') AS INT)
             AS customer_age_days
    FROM customers""",
    ),
    "known_orders": (
        ("raw_orders",),
        "\n    SELECT * FROM raw_orders",
    ),
    "rfm_base": (
        ("known_orders",),
        """
    SELECT customer_id,
           CAST(date_diff('day', MAX(order_date), DATE '2001-08-02') AS INT) AS recency_days,
           COUNT(order_line_id) AS frequency,
           SUM(total_amount) AS monetary
    FROM known_orders WHERE order_status <> 'Cancelled' GROUP BY customer_id""",
    ),
    "rfm_scores": (
        ("rfm_base",),
        """
    SELECT customer_id, recency_days, frequency, monetary,
      CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS LAST, customer_id NULLS FIRST) AS INT) AS r_score,
      CAST(ntile(5) OVER (ORDER BY frequency NULLS FIRST, customer_id NULLS FIRST) AS INT) AS f_score,
      CAST(ntile(5) OVER (ORDER BY monetary NULLS FIRST, customer_id NULLS FIRST) AS INT) AS m_score
    FROM rfm_base""",
    ),
    "churn_features": (
        ("known_orders",),
        """
    SELECT *, CAST(CASE WHEN recency_days > 90 THEN 1 ELSE 0 END AS INT) AS churned FROM (
      SELECT customer_id,
             CAST(date_diff('day', MAX(order_date), DATE '2001-08-02') AS INT) AS recency_days,
             COUNT(order_line_id) AS frequency,
             CAST(SUM(total_amount) AS DOUBLE) AS monetary,
             CAST(SUM(total_amount) AS DOUBLE) / COUNT(total_amount) AS avg_order_value,
             COUNT(DISTINCT product_id) AS unique_products,
             COUNT(DISTINCT warehouse_id) AS unique_warehouses,
             CAST(SUM(CASE WHEN order_status = 'Cancelled' THEN 1 ELSE 0 END) AS DOUBLE)
               / COUNT(order_line_id) AS cancel_rate
      FROM known_orders GROUP BY customer_id) grouped""",
    ),
    "rule_scores": (
        ("churn_features",),
        """
    SELECT customer_id,
           CAST(ROUND(CAST(p AS DECIMAL(28,8)), 4) AS DOUBLE) AS churn_probability,
           CASE WHEN p > 0 AND p <= 0.3 THEN 'Low Risk'
                WHEN p > 0.3 AND p <= 0.6 THEN 'Medium Risk'
                WHEN p > 0.6 AND p <= 1 THEN 'High Risk' END AS risk_segment,
           DATE '2001-08-02' AS scored_date
    FROM (SELECT customer_id,
                 LEAST(CAST(recency_days AS DOUBLE) / 365, CAST(1 AS DOUBLE)) AS p
          FROM churn_features) s""",
    ),
    "demand_orders": (
        ("raw_orders",),
        """
    SELECT o.*, CAST(substring(p_brand, 7) AS BIGINT) AS brand_id,
           CAST(n_regionkey AS BIGINT) AS region_id
    FROM raw_orders o JOIN part ON product_id = p_partkey
                      JOIN supplier ON warehouse_id = s_suppkey
                      JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "demand_cells": (
        ("demand_orders",),
        """
    SELECT brand_id, region_id, CAST(YEAR(order_date) AS INT) AS year,
           CAST(MONTH(order_date) AS INT) AS month,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity,
           CAST(SUM(total_amount) AS DOUBLE) AS total_revenue,
           COUNT(order_line_id) AS order_count,
           CAST(SUM(quantity) AS DOUBLE) / COUNT(quantity) AS avg_quantity
    FROM demand_orders WHERE order_status <> 'Cancelled'
    GROUP BY brand_id, region_id, YEAR(order_date), MONTH(order_date)""",
    ),
    "demand_windowed": (
        ("demand_cells",),
        """
    SELECT *,
           lag(total_quantity, 1) OVER w AS lag_1_qty,
           lag(total_quantity, 2) OVER w AS lag_2_qty,
           lag(total_quantity, 3) OVER w AS lag_3_qty,
           CASE WHEN COUNT(total_quantity) OVER r = 3
                THEN CAST(SUM(total_quantity) OVER r AS DOUBLE) / 3 END AS rolling_3m_avg,
           CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
                WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
           CAST(CASE WHEN month IN (12, 1, 2) THEN 4 WHEN month IN (3, 4, 5) THEN 1
                     WHEN month IN (6, 7, 8) THEN 2 ELSE 3 END AS INT) AS season_num
    FROM demand_cells
    WINDOW w AS (PARTITION BY brand_id, region_id ORDER BY year, month),
           r AS (PARTITION BY brand_id, region_id ORDER BY year, month
                 ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""",
    ),
    "demand_features": (
        ("demand_windowed",),
        """
    SELECT * FROM demand_windowed
    WHERE lag_1_qty IS NOT NULL AND lag_2_qty IS NOT NULL AND lag_3_qty IS NOT NULL
      AND rolling_3m_avg IS NOT NULL AND total_quantity IS NOT NULL
      AND total_revenue IS NOT NULL AND avg_quantity IS NOT NULL""",
    ),
    "lag_forecast": (
        ("raw_orders",),
        """
    SELECT product_id, warehouse_id, make_date(year, month, 1) AS forecast_date,
           CAST(previous AS DOUBLE) AS predicted_demand, 'previous_month' AS model_name
    FROM (SELECT product_id, warehouse_id, YEAR(order_date) AS year, MONTH(order_date) AS month,
                 lag(SUM(quantity)) OVER (PARTITION BY product_id, warehouse_id
                   ORDER BY YEAR(order_date), MONTH(order_date)) AS previous
          FROM raw_orders WHERE order_status <> 'Cancelled'
          GROUP BY product_id, warehouse_id, YEAR(order_date), MONTH(order_date)) cells
    WHERE previous IS NOT NULL""",
    ),
}


def _needed(name: str, seen: list[str]) -> list[str]:
    for parent in _VIEWS[name][0]:
        _needed(parent, seen)
    if name not in seen:
        seen.append(name)
    return seen


def with_views(sql: str, *names: str) -> str:
    seen: list[str] = []
    for name in names:
        _needed(name, seen)
    ctes = ",\n  ".join(f"{name} AS ({_VIEWS[name][1]})" for name in seen)
    return f"WITH {ctes}\n{sql}"


def _from_clean(sql: str) -> str:
    """The same text with the cleaned orders in place of the raw ones."""
    body = _VIEWS["raw_orders"][1]
    ranked = _VIEWS["deduped"][1].replace("FROM raw_orders", "FROM feed")
    clean = "customer_id IS NOT NULL AND quantity > 0 AND total_amount > 0"
    return sql.replace(
        f"raw_orders AS ({body})",
        f"feed AS ({body}),\n  first_rows AS ({ranked}),\n"
        f"  raw_orders AS (SELECT * FROM first_rows WHERE {clean})",
    )


_ORDER_COLUMNS = """order_line_id, customer_id, product_id, warehouse_id, order_date,
  ship_date, delivery_date, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(total_amount AS DOUBLE) AS total_amount,
  order_status, CAST(shipping_cost AS DOUBLE) AS shipping_cost"""

_ROUND = "CAST(ROUND(CAST({} AS DECIMAL(28,8)), {}) AS DOUBLE)"


def _round(expr: str, places: int = 2) -> str:
    return _ROUND.format(expr, places)


def _orders(view: str, where: str = "") -> str:
    return with_views(f"SELECT {_ORDER_COLUMNS} FROM {view} {where}", view)


def _customer_summary(mid: int, high: int) -> str:
    mean = _round("CAST(revenue AS DOUBLE) / priced")
    days = _round("CAST(days AS DOUBLE) / timed", 1)
    return with_views(
        f"""
SELECT c.customer_id, customer_name, segment, city, state, customer_age_days, total_orders,
       CAST(revenue AS DOUBLE) AS total_revenue,
       {mean} AS avg_order_value,
       first_order_date, last_order_date,
       CAST(date_diff('day', last_order_date, DATE '2001-08-02') AS INT) AS recency_days,
       total_returns,
       {days} AS avg_delivery_days,
       CASE WHEN revenue > {high} THEN 'High Value' WHEN revenue > {mid} THEN 'Mid Value'
            ELSE 'Low Value' END AS value_segment
FROM stg_customers c LEFT JOIN (
  SELECT customer_id, COUNT(order_line_id) AS total_orders, SUM(total_amount) AS revenue,
         COUNT(total_amount) AS priced, MIN(order_date) AS first_order_date,
         MAX(order_date) AS last_order_date,
         CAST(SUM(CASE WHEN order_status = 'Returned' THEN 1 ELSE 0 END) AS BIGINT)
           AS total_returns,
         SUM(delivery_days) AS days, COUNT(delivery_days) AS timed
  FROM stg_orders GROUP BY customer_id) m ON c.customer_id = m.customer_id""",
        "stg_customers",
        "stg_orders",
    )


def _gold(key: str, columns: str, view: str = "raw_orders") -> str:
    return with_views(
        f"""
SELECT {key}, COUNT(order_line_id) AS total_orders,
       CAST(SUM(total_amount) AS DOUBLE) AS total_revenue{columns}
FROM {view} WHERE quantity > 0 GROUP BY ALL""",
        view,
    )


_MEAN_TOTAL = "CAST(SUM(total_amount) AS DOUBLE) / COUNT(total_amount)"
_QUANTITY = ", CAST(SUM(quantity) AS BIGINT) AS total_quantity"

_STATUS = """CASE WHEN quantity_on_hand > reorder_point * 2 THEN 'Overstocked'
            WHEN quantity_on_hand < reorder_point THEN 'Understocked' ELSE 'Normal' END"""



def _inventory_status(stock: str) -> str:
    return with_views(
        f"""
SELECT i.product_id, product_name, category, warehouse_name, region, quantity_on_hand,
       reorder_point, quantity_reserved, {_STATUS} AS stock_status
FROM {stock} i JOIN products p ON i.product_id = p.product_id
JOIN warehouses w ON i.warehouse_id = w.warehouse_id
WHERE quantity_on_hand IS NOT NULL""",
        stock,
        "products",
        "warehouses",
    )


def _rebalancing(stock: str, costs: str, limit: int = 100) -> str:
    units = "LEAST(o.quantity_on_hand - o.reorder_point, u.reorder_point - u.quantity_on_hand)"
    status = (
        f"(SELECT *, {_STATUS} AS stock_status FROM {stock} WHERE quantity_on_hand IS NOT NULL)"
    )
    return with_views(
        f"""
SELECT product_id, source_warehouse_id, dest_warehouse_id, recommended_qty,
       CAST(savings AS DOUBLE) AS estimated_savings,
       CASE WHEN needed > 100 THEN 'High' WHEN needed > 50 THEN 'Medium' ELSE 'Low' END
         AS priority
FROM (
  SELECT o.product_id, o.warehouse_id AS source_warehouse_id,
         u.warehouse_id AS dest_warehouse_id, {units} AS recommended_qty,
         {units} * cost_price AS savings, u.reorder_point - u.quantity_on_hand AS needed
  FROM {status} o JOIN {status} u ON o.product_id = u.product_id
  JOIN {costs} p ON p.product_id = o.product_id
  WHERE o.stock_status = 'Overstocked' AND u.stock_status = 'Understocked'
    AND o.warehouse_id <> u.warehouse_id) t
ORDER BY savings DESC NULLS LAST, product_id, source_warehouse_id, dest_warehouse_id
LIMIT {limit}""",
        stock,
        costs,
    )


_ERROR = "CAST(ABS(CAST(total_quantity AS DOUBLE) - rolling_3m_avg) AS DECIMAL(28,8))"
_SHARE = """CASE WHEN total_quantity > 10 THEN CAST(ABS(CAST(total_quantity AS DOUBLE)
         - rolling_3m_avg) / ABS(CAST(total_quantity AS DOUBLE)) AS DECIMAL(28,8)) END"""


def _json_field(name: str, kind: str) -> str:
    if kind == "text":
        value = f"'\"' || CAST({name} AS VARCHAR) || '\"'"
    else:
        value = f"CAST({name} AS VARCHAR)"
    return f"'\"{name}\":' || COALESCE({value}, 'null')"


_JSON = " || ',' || ".join(
    _json_field(name, kind)
    for name, kind in {
        "order_line_id": "number",
        "customer_id": "number",
        "product_id": "number",
        "warehouse_id": "number",
        "order_date": "text",
        "ship_date": "text",
        "delivery_date": "text",
        "quantity": "number",
        "unit_price": "number",
        "discount_pct": "number",
        "total_amount": "number",
        "order_status": "text",
        "shipping_cost": "number",
    }.items()
)

_UNIQUE = """SELECT COUNT(*) FROM (SELECT {0} FROM {1} WHERE {0} IS NOT NULL
                       GROUP BY {0} HAVING COUNT(*) > 1) d"""


def _check(model: str, kind: str, column: str) -> str:
    if kind == "unique":
        failing = _UNIQUE.format(column, model)
    else:
        failing = f"SELECT COUNT(*) FROM {model} WHERE {column} IS NULL"
    return (
        f"SELECT '{model}' AS model, '{kind}_{column}' AS check_name, failing,"
        f" failing = 0 AS passed FROM (SELECT ({failing}) AS failing) v"
    )


_DQ = "\nUNION ALL\n".join(
    [
        _check("stg_orders", "unique", "order_line_id"),
        *[
            _check("stg_orders", "not_null", c)
            for c in ("order_line_id", "customer_id", "quantity", "total_amount")
        ],
        _check("stg_customers", "unique", "customer_id"),
        *[_check("stg_customers", "not_null", c) for c in ("customer_id", "email")],
    ]
)

_REPORT = """
SELECT 'orders' AS table_name, 'start' AS measure, COUNT(*) AS row_count FROM raw_orders
UNION ALL SELECT 'orders', 'after_dedupe', COUNT(*) FROM deduped
UNION ALL SELECT 'orders', 'quarantined_no_customer', COUNT(*) FROM deduped
  WHERE customer_id IS NULL
UNION ALL SELECT 'orders', 'negative_quantity', COUNT(*) FROM deduped
  WHERE customer_id IS NOT NULL AND quantity <= 0
UNION ALL SELECT 'orders', 'negative_total', COUNT(*) FROM deduped
  WHERE customer_id IS NOT NULL AND quantity > 0 AND total_amount <= 0
UNION ALL SELECT 'orders', 'clean', COUNT(*) FROM passed
UNION ALL SELECT 'orders', 'removed',
  (SELECT COUNT(*) FROM raw_orders) - (SELECT COUNT(*) FROM passed)
UNION ALL SELECT 'customers', 'null_emails_fixed', COUNT(*) FROM customers WHERE email IS NULL
UNION ALL SELECT 'customers', 'clean', COUNT(*) FROM customers
UNION ALL SELECT 'products', 'null_costs_fixed', COUNT(*) FROM products WHERE cost_price IS NULL
UNION ALL SELECT 'products', 'clean', COUNT(*) FROM products
UNION ALL SELECT 'inventory', 'null_quantities_fixed', COUNT(*) FROM raw_inventory
  WHERE quantity_on_hand IS NULL
UNION ALL SELECT 'inventory', 'clean', COUNT(*) FROM raw_inventory"""

_PRODUCT_COLUMNS = """product_id, product_name, category, sub_category,
  CAST({} AS DOUBLE) AS cost_price, CAST(list_price AS DOUBLE) AS list_price"""

_CELLS = """brand_id, region_id, year, month, total_quantity, total_revenue, order_count,
  avg_quantity"""


FROM_CLEAN = (
    "customer_summary",
    "executive_overview",
    "warehouse_scoring",
    "rfm_segmentation",
    "churn_features",
    "demand_features",
    "dq_report",
)


_REJECTS = """
SELECT 'malformed' AS reason, '{broken ' || CAST(order_line_id AS VARCHAR) AS message
FROM raw_orders WHERE order_line_id % 89 = 3
UNION ALL
SELECT 'bad_date', '{"order_line_id":' || CAST(order_line_id AS VARCHAR)
       || ',"order_date":"31.02.2024"}'
FROM raw_orders WHERE order_line_id % 97 = 5"""


_SORTED_COLUMNS = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "order_line_id customer_id product_id warehouse_id order_date ship_date delivery_date"
        " quantity unit_price discount_pct total_amount order_status shipping_cost"
    ).split()
)


def _numbered(columns: str, where: str = "") -> str:
    """Orders in three waves of copies, numbered one wave after the other."""
    first = _VIEWS["deduped"][1]
    order = first[first.index("ORDER BY") : first.index(") AS rn")].removeprefix("ORDER BY")
    return with_views(
        f"""
SELECT {columns}, message_number FROM (
  SELECT *, row_number() OVER (ORDER BY wave, {_SORTED_COLUMNS}) AS message_number FROM (
    SELECT *, LEAST(row_number() OVER (
      PARTITION BY order_line_id ORDER BY {order},
        customer_id NULLS FIRST, order_date NULLS FIRST, ship_date NULLS FIRST,
        delivery_date NULLS FIRST), 3) AS wave
    FROM raw_orders) sent) numbered
{where}""",
        "raw_orders",
    )


_ANOMALY_COUNTS = f"""
SELECT segment, CAST(n AS BIGINT) AS row_count,
       {_round("n * CAST(100 AS DOUBLE) / total")} AS share_pct
FROM (
  SELECT total, unnest([1, 0]) AS segment,
         unnest([total - 1 - floor((total - 1) * 0.95), floor((total - 1) * 0.95) + 1]) AS n
  FROM (SELECT COUNT(*) AS total FROM raw_orders) rows)"""


def _stored(sql: dict[str, str]) -> dict[str, str]:
    """What the jobs store equals what the operators return."""
    wide = """product_name || ' 6" wide, "best"' || chr(10) || 'second line, "' AS product_name"""
    return {
        "csv_scan_orders": _orders("raw_orders"),
        "csv_quoted_products": with_views(
            f"""
SELECT product_id, {wide}, category, sub_category, CAST(cost_price AS DOUBLE) AS cost_price,
       CAST(list_price AS DOUBLE) AS list_price FROM products""",
            "products",
        ),
        "optional_tables": with_views(
            """
SELECT 'dim_customers' AS table_name, COUNT(*) AS stored_rows FROM customers
UNION ALL SELECT 'dim_products', CAST(NULL AS BIGINT)""",
            "customers",
        ),
        "layer_orders_by_month": with_views(
            f"SELECT {_ORDER_COLUMNS}, strftime(order_date, '%Y-%m') AS month_key FROM raw_orders",
            "raw_orders",
        ),
        "named_views": with_views(
            """
SELECT c.customer_id, NULLIF(COUNT(o.order_line_id), 0) AS total_orders,
       COUNT(o.order_line_id) AS lines
FROM stg_customers c LEFT JOIN stg_orders o ON c.customer_id = o.customer_id
GROUP BY c.customer_id""",
            "stg_customers",
            "stg_orders",
        ),
        "stored_model": with_views(
            "SELECT COUNT(*) AS scored, CAST(0 AS BIGINT) AS changed FROM churn_features",
            "churn_features",
        ),
        "etl_fact_orders": sql["clean_orders"],
        "etl_dim_customers": sql["clean_customers"],
        "etl_quarantine": sql["quarantine_orders"],
        "etl_audit": sql["cleaning_report"],
        "bronze_orders": sql["scan_orders"],
        "medallion_silver_orders": sql["silver_orders"],
        "medallion_gold_monthly": sql["monthly_sales"],
        "medallion_gold_from_silver": sql["monthly_sales_from_silver"],
        "marts_customer_summary": sql["customer_summary"],
        "export_executive_overview": sql["executive_overview"],
        "export_customer_analytics": sql["customer_analytics"],
        "export_demand_forecast": sql["forecast_report"],
        "export_inventory_status": sql["inventory_status"],
        "export_anomaly_orders": _orders("raw_orders", "WHERE quantity > 45"),
        "published_fact_orders": sql["clean_orders"],
        "published_audit": sql["cleaning_report"],
        "load_churn_scores": with_views(
            """
SELECT customer_id, churn_probability, risk_segment, scored_date FROM rule_scores
WHERE customer_id IN (SELECT customer_id FROM customers)
  AND churn_probability IS NOT NULL AND risk_segment IS NOT NULL""",
            "rule_scores",
            "customers",
        ),
        "load_fact_orders": sql["silver_orders"],
        "publish_raw_orders": sql["scan_orders"],
        "demand_forecast_rows": with_views(
            """
SELECT brand_id, region_id, make_date(year, month, 1) AS forecast_date,
       'boosted_trees' AS model_name
FROM demand_features
WHERE substring(md5(CAST(brand_id AS VARCHAR) || '|' || CAST(region_id AS VARCHAR) || '|'
      || CAST(year AS VARCHAR) || '|' || CAST(month AS VARCHAR)), 1, 2) < '33'""",
            "demand_features",
        ),
        "churn_score_contract": with_views(
            """
SELECT COUNT(*) AS scored, COUNT(DISTINCT customer_id) AS customers,
       CAST(0 AS BIGINT) AS not_probabilities, CAST(0 AS BIGINT) AS in_another_bin,
       DATE '2001-08-02' AS scored_date
FROM churn_features""",
            "churn_features",
        ),
    }


def oracle_sql() -> dict[str, str]:
    sql = {
        # sources and cleaning
        "scan_orders": _orders("raw_orders"),
        "scan_customers": with_views("SELECT * FROM customers", "customers"),
        "scan_products": with_views(
            f"SELECT {_PRODUCT_COLUMNS.format('cost_price')} FROM products", "products"
        ),
        "scan_warehouses": with_views("SELECT * FROM warehouses", "warehouses"),
        "scan_inventory": with_views("SELECT * FROM raw_inventory", "raw_inventory"),
        "dedupe_orders": _orders("deduped"),
        "dedupe_orders_in_place": _orders("deduped"),
        "quarantine_orders": _orders("deduped", "WHERE customer_id IS NULL"),
        "reject_quantity": _orders("raw_orders", "WHERE quantity > 0"),
        "reject_total": _orders("raw_orders", "WHERE total_amount > 0"),
        "parse_dates": with_views(
            """
SELECT order_line_id, product_id, warehouse_id, order_date,
       CASE WHEN order_status = 'Processing' THEN NULL ELSE ship_date END AS ship_date,
       delivery_date
FROM raw_orders""",
            "raw_orders",
        ),
        "clean_orders": _orders("passed"),
        "silver_orders": _orders("passed"),
        "clean_customers": with_views(
            "SELECT * REPLACE (COALESCE(email, 'unknown@example.com') AS email) FROM customers",
            "customers",
        ),
        "clean_products": with_views(
            f"SELECT {_PRODUCT_COLUMNS.format('COALESCE(cost_price, 0)')} FROM products",
            "products",
        ),
        "clean_inventory": with_views(
            "SELECT * REPLACE (COALESCE(quantity_on_hand, 0) AS quantity_on_hand)"
            " FROM raw_inventory",
            "raw_inventory",
        ),
        "cleaning_report": with_views(
            _REPORT, "passed", "customers", "products", "raw_inventory"
        ),
        "line_totals": with_views(
            """
SELECT order_line_id, product_id, warehouse_id, quantity,
       CAST(CAST(unit_price * CAST(quantity AS DECIMAL(10,0))
            * (CAST(1 AS DECIMAL(4,2)) - discount_pct) AS DECIMAL(18,2)) AS DOUBLE) AS line_total
FROM raw_orders""",
            "raw_orders",
        ),
        "orders_with_replays": with_views(
            f"""
SELECT {_ORDER_COLUMNS} FROM raw_orders
UNION ALL SELECT {_ORDER_COLUMNS} FROM raw_orders WHERE order_status = 'Returned'""",
            "raw_orders",
        ),
        # staging, marts, gold
        "stg_orders": with_views(
            f"SELECT {_ORDER_COLUMNS}, delivery_days, is_delivered FROM stg_orders", "stg_orders"
        ),
        "stg_customers": with_views("SELECT * FROM stg_customers", "stg_customers"),
        "customer_summary": _customer_summary(10_000, 50_000),
        "customer_summary_scaled": _customer_summary(300_000, 500_000),
        "monthly_sales": _gold(
            "strftime(order_date, '%Y-%m') AS year_month",
            f"{_QUANTITY}, {_round(_MEAN_TOTAL)} AS avg_order_value",
        ),
        "product_performance": _gold("product_id", _QUANTITY),
        "warehouse_performance": _gold("warehouse_id", f", {_MEAN_TOTAL} AS avg_order_val"),
        "monthly_sales_from_silver": _gold(
            "strftime(order_date, '%Y-%m') AS year_month",
            f"{_QUANTITY}, {_round(_MEAN_TOTAL)} AS avg_order_value",
            "passed",
        ),
        # reports
        "executive_overview": with_views(
            """
SELECT order_date, order_status, CAST(total_amount AS DOUBLE) AS total_amount, quantity,
       CAST(shipping_cost AS DOUBLE) AS shipping_cost, category, sub_category, product_name,
       warehouse_name, w.region, c.segment AS customer_segment
FROM raw_orders o JOIN products p ON o.product_id = p.product_id
JOIN warehouses w ON o.warehouse_id = w.warehouse_id
JOIN customers c ON o.customer_id = c.customer_id""",
            "raw_orders",
            "products",
            "warehouses",
            "customers",
        ),
        "customer_analytics": with_views(
            """
SELECT c.*, churn_probability, risk_segment, scored_date
FROM customers c LEFT JOIN rule_scores s ON c.customer_id = s.customer_id""",
            "customers",
            "rule_scores",
        ),
        "forecast_report": with_views(
            """
SELECT forecast_date, predicted_demand, model_name, product_name, category, warehouse_name,
       region
FROM lag_forecast f JOIN products p ON f.product_id = p.product_id
JOIN warehouses w ON f.warehouse_id = w.warehouse_id""",
            "lag_forecast",
            "products",
            "warehouses",
        ),
        "inventory_status": _inventory_status("raw_inventory"),
        "inventory_status_clean": _inventory_status("clean_inventory"),
        "inventory_rebalancing": _rebalancing("raw_inventory", "products"),
        "inventory_rebalancing_top_1000": _rebalancing("raw_inventory", "products", 1000),
        "inventory_rebalancing_clean": _rebalancing("clean_inventory", "clean_products"),
        "warehouse_scoring": with_views(
            f"""
SELECT w.warehouse_id, warehouse_name, region, COALESCE(n, 0) AS total_orders,
       CAST(revenue AS DOUBLE) AS total_revenue,
       {_round("CAST(revenue AS DOUBLE) / priced")} AS avg_order_value,
       {_round("on_time * CAST(100 AS DOUBLE) / n")} AS on_time_pct,
       {_round("cancelled * CAST(100 AS DOUBLE) / n")} AS cancellation_pct,
       {_round('''n * CAST(0.3 AS DOUBLE) / 100 + CAST(revenue AS DOUBLE)
         * CAST(0.0001 AS DOUBLE) + CAST(revenue AS DOUBLE) / priced
         * CAST(0.01 AS DOUBLE)''')} AS performance_score
FROM warehouses w LEFT JOIN (
  SELECT warehouse_id, COUNT(order_line_id) AS n, SUM(total_amount) AS revenue,
         COUNT(total_amount) AS priced,
         COUNT(*) FILTER (WHERE date_diff('day', order_date, delivery_date) <= 7) AS on_time,
         COUNT(*) FILTER (WHERE order_status = 'Cancelled') AS cancelled
  FROM raw_orders GROUP BY warehouse_id) o ON w.warehouse_id = o.warehouse_id
ORDER BY performance_score DESC NULLS LAST, w.warehouse_id""",
            "warehouses",
            "raw_orders",
        ),
        # customer segments
        "rfm_base": with_views(
            """
SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary
FROM rfm_base""",
            "rfm_base",
        ),
        "rfm_scores": with_views(
            """
SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
       r_score, f_score, m_score FROM rfm_scores""",
            "rfm_scores",
        ),
        "rfm_segmentation": with_views(
            """
SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
       r_score, f_score, m_score, r_score + f_score + m_score AS total_score,
       CASE WHEN r_score + f_score + m_score >= 13 THEN 'VIP'
            WHEN r_score + f_score + m_score >= 10 THEN 'Loyal'
            WHEN r_score + f_score + m_score >= 7 THEN 'Potential'
            WHEN r_score + f_score + m_score >= 4 THEN 'At Risk' ELSE 'Lost' END AS segment
FROM rfm_scores ORDER BY total_score DESC, customer_id""",
            "rfm_scores",
        ),
        "churn_features": with_views("SELECT * FROM churn_features", "churn_features"),
        "churn_risk_segments": with_views("SELECT * FROM rule_scores", "rule_scores"),
        "segment_counts": with_views(
            f"""
SELECT risk_segment AS segment, COUNT(*) AS row_count,
       {_round("COUNT(*) * CAST(100 AS DOUBLE) / SUM(COUNT(*)) OVER ()")} AS share_pct
FROM rule_scores GROUP BY risk_segment""",
            "rule_scores",
        ),
        "classification_accuracy": with_views(
            """
SELECT COUNT(*) AS row_count, CAST(SUM(hit) AS DOUBLE) / COUNT(*) AS accuracy,
       CAST(SUM(hit) AS DOUBLE) / COUNT(*) > 0.65 AS passed
FROM (SELECT CASE WHEN churned = CASE WHEN frequency < 40 THEN 1 ELSE 0 END
             THEN 1 ELSE 0 END AS hit FROM churn_features) h""",
            "churn_features",
        ),
        # demand
        "demand_cells": with_views(f"SELECT {_CELLS} FROM demand_cells", "demand_cells"),
        "demand_lags": with_views(
            f"SELECT {_CELLS}, lag_1_qty, lag_2_qty, lag_3_qty FROM demand_windowed",
            "demand_windowed",
        ),
        "demand_rolling": with_views(
            f"SELECT {_CELLS}, rolling_3m_avg FROM demand_windowed", "demand_windowed"
        ),
        "demand_season": with_views(
            f"SELECT {_CELLS}, season, season_num FROM demand_windowed", "demand_windowed"
        ),
        "demand_features": with_views("SELECT * FROM demand_features", "demand_features"),
        "forecast_metrics": with_views(
            f"""
SELECT COUNT(*) AS row_count, CAST(SUM({_ERROR}) AS DOUBLE) / COUNT(*) AS mae,
       COALESCE(CAST(SUM({_SHARE}) AS DOUBLE) / COUNT({_SHARE}) * 100, 999) AS mape,
       CAST(SUM({_ERROR}) AS DOUBLE) / COUNT(*) < 50 AS passed
FROM demand_features""",
            "demand_features",
        ),
        "train_test_split": with_views(
            """
SELECT *, substring(md5(CAST(brand_id AS VARCHAR) || '|' || CAST(region_id AS VARCHAR) || '|'
       || CAST(year AS VARCHAR) || '|' || CAST(month AS VARCHAR)), 1, 2) < '33' AS is_test
FROM demand_features""",
            "demand_features",
        ),
        # quality
        "dq_unique": with_views(
            """
SELECT order_line_id, COUNT(*) AS row_count FROM raw_orders
WHERE order_line_id IS NOT NULL GROUP BY order_line_id HAVING COUNT(*) > 1""",
            "raw_orders",
        ),
        "dq_not_null": with_views(
            "\nUNION ALL\n".join(
                f"SELECT '{c}' AS column_name, COUNT(*) AS failing FROM raw_orders"
                f" WHERE {c} IS NULL"
                for c in ("order_line_id", "customer_id", "ship_date", "quantity", "total_amount")
            ),
            "raw_orders",
        ),
        "dq_report": with_views(_DQ, "stg_orders", "stg_customers"),
        # messages and streams
        "orders_to_json": with_views(
            f"""
SELECT CAST(order_line_id AS VARCHAR) AS key, '{{' || {_JSON} || '}}' AS value
FROM raw_orders""",
            "raw_orders",
        ),
        "order_stream": _orders("raw_orders"),
        "order_stream_count": with_views(
            "SELECT COUNT(*) AS messages FROM raw_orders", "raw_orders"
        ),
        "order_stream_clean": _orders("passed"),
        "order_stream_quarantine": _orders("deduped", "WHERE customer_id IS NULL"),
    }
    sql["order_stream_numbered"] = _numbered(_ORDER_COLUMNS)
    sql["order_stream_first_n"] = _numbered(
        f"""{_ORDER_COLUMNS}, CASE WHEN message_number <= 20 THEN 0
  WHEN message_number <= 500 THEN 1 ELSE 2 END AS run""",
        "WHERE message_number <= 1200",
    )
    sql["anomaly_counts"] = with_views(_ANOMALY_COUNTS, "raw_orders")
    sql["order_stream_rejects"] = with_views(_REJECTS, "raw_orders")
    sql |= _stored(sql)
    for name in FROM_CLEAN:
        sql[f"{name}_from_clean"] = _from_clean(sql[name])
    return sql
