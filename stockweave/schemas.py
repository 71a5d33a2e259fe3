"""Declared schemas of the star-schema tables. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(18, 2)
PRICE = DecimalType(15, 2)
RATE = DecimalType(4, 2)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


CUSTOMERS = _table(
    customer_id=LongType(),
    customer_name=StringType(),
    email=StringType(),
    segment=StringType(),
    city=StringType(),
    state=StringType(),
    country=StringType(),
    registration_date=DateType(),
)

PRODUCTS = _table(
    product_id=LongType(),
    product_name=StringType(),
    category=StringType(),
    sub_category=StringType(),
    cost_price=MONEY,
    list_price=MONEY,
)

WAREHOUSES = _table(
    warehouse_id=LongType(),
    warehouse_name=StringType(),
    city=StringType(),
    state=StringType(),
    region=StringType(),
    capacity=IntegerType(),
)

ORDERS = _table(
    order_line_id=LongType(),
    customer_id=LongType(),
    product_id=LongType(),
    warehouse_id=LongType(),
    order_date=DateType(),
    ship_date=DateType(),
    delivery_date=DateType(),
    quantity=IntegerType(),
    unit_price=PRICE,
    discount_pct=RATE,
    total_amount=MONEY,
    order_status=StringType(),
    shipping_cost=MONEY,
)

INVENTORY = _table(
    inventory_id=LongType(),
    product_id=LongType(),
    warehouse_id=LongType(),
    snapshot_date=DateType(),
    quantity_on_hand=IntegerType(),
    quantity_reserved=IntegerType(),
    reorder_point=IntegerType(),
)

DEMAND_FORECASTS = _table(
    product_id=LongType(),
    warehouse_id=LongType(),
    forecast_date=DateType(),
    predicted_demand=DoubleType(),
    model_name=StringType(),
)

CHURN_SCORES = _table(
    customer_id=LongType(),
    churn_probability=DoubleType(),
    risk_segment=StringType(),
    scored_date=DateType(),
)

# Extracts that later stages read back.
CUSTOMER_ANALYTICS = StructType([*CUSTOMERS, *CHURN_SCORES[1:]])

FORECAST_REPORT = _table(
    forecast_date=DateType(),
    predicted_demand=DoubleType(),
    model_name=StringType(),
    product_name=StringType(),
    category=StringType(),
    warehouse_name=StringType(),
    region=StringType(),
)

TABLES = {
    "dim_customers": CUSTOMERS,
    "dim_products": PRODUCTS,
    "dim_warehouses": WAREHOUSES,
    "fact_orders": ORDERS,
    "fact_inventory": INVENTORY,
    "ml_demand_forecasts": DEMAND_FORECASTS,
    "ml_churn_scores": CHURN_SCORES,
    "customer_analytics": CUSTOMER_ANALYTICS,
    "demand_forecast": FORECAST_REPORT,
}

DIMENSIONS = ("dim_customers", "dim_products", "dim_warehouses")
FACTS = ("fact_orders", "fact_inventory")
