"""Hand-written order, customer and inventory rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from stockweave import schemas

DAY = dt.date(2024, 1, 10)

_ORDER = {
    "order_line_id": 1,
    "customer_id": 7,
    "product_id": 3,
    "warehouse_id": 2,
    "order_date": DAY,
    "ship_date": DAY + dt.timedelta(days=2),
    "delivery_date": DAY + dt.timedelta(days=5),
    "quantity": 4,
    "unit_price": Decimal("10.00"),
    "discount_pct": Decimal("0.10"),
    "total_amount": Decimal("36.00"),
    "order_status": "Delivered",
    "shipping_cost": Decimal("5.00"),
}


def _frame(spark, schema, defaults, rows):
    return spark.createDataFrame(
        [tuple({**defaults, **row}[f.name] for f in schema) for row in rows], schema
    )


def orders(spark, *rows):
    numbered = [{"order_line_id": i + 1, **row} for i, row in enumerate(rows)]
    return _frame(spark, schemas.ORDERS, _ORDER, numbered)


def customers(spark, *rows):
    defaults = dict(
        customer_id=1, customer_name="A", email="a@example.com", segment="SMB", city="C",
        state="S", country="X", registration_date=dt.date(2020, 1, 1),
    )
    return _frame(spark, schemas.CUSTOMERS, defaults, rows)


def products(spark, *rows):
    defaults = dict(
        product_id=1, product_name="P", category="Cat", sub_category="Sub",
        cost_price=Decimal("2.00"), list_price=Decimal("3.00"),
    )
    return _frame(spark, schemas.PRODUCTS, defaults, rows)


def warehouses(spark, *rows):
    defaults = dict(
        warehouse_id=1, warehouse_name="W", city="C", state="S", region="R", capacity=10
    )
    return _frame(spark, schemas.WAREHOUSES, defaults, rows)


def inventory(spark, *rows):
    defaults = dict(
        inventory_id=1, product_id=1, warehouse_id=1, snapshot_date=DAY, quantity_on_hand=10,
        quantity_reserved=0, reorder_point=10,
    )
    return _frame(spark, schemas.INVENTORY, defaults, rows)


def ids(df, column="order_line_id"):
    return sorted(r[0] for r in df.select(column).collect())
