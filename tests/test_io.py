import datetime as dt
from decimal import Decimal

import pytest

from helpers import customers, orders, products, warehouses, inventory
from stockweave import schemas
from stockweave.sources import databases, sinks, tables

HEADER = ",".join(schemas.ORDERS.names)


def test_csv_types_and_null_markers(spark, tmp_path):
    path = tmp_path / "fact_orders.csv"
    path.write_text(
        HEADER + "\n"
        "1,7.0,3,2,2024-01-10,,2024-01-15,4,10.0,0,36.0,Delivered,5.25\n"
        "2,,3,2,2024-01-10,later,2024-01-15,-4,10.0,0.05,-36.0,NA,5.25\n"
    )
    first, second = tables.read_table(spark, "fact_orders", str(path)).orderBy("order_line_id").collect()
    assert first.customer_id == 7 and first.ship_date is None and first.quantity == 4
    assert first.order_date == dt.date(2024, 1, 10) and first.unit_price == Decimal("10.00")
    assert second.customer_id is None and second.ship_date is None and second.order_status is None


def test_bad_order_date_is_an_error(spark, tmp_path):
    path = tmp_path / "fact_orders.csv"
    path.write_text(HEADER + "\n1,7,3,2,yesterday,,2024-01-15,4,10,0,36,Delivered,5\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_table(spark, "fact_orders", str(path)).collect()


def test_wrong_header_is_an_error(spark, tmp_path):
    path = tmp_path / "dim_products.csv"
    path.write_text("product_id,name,category,sub_category,cost_price,list_price\n1,a,b,c,1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_table(spark, "dim_products", str(path)).collect()


ODD = ['6" pipe, steel', 'a "quoted" name', "comma, only", 'ends with "', "back\\slash", "two\nlines"]


def test_quotes_written_by_other_tools(spark, tmp_path):
    import csv

    path = tmp_path / "dim_products.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(schemas.PRODUCTS.names)
        out.writerows([i, text, "c", "s", "1.00", "2.00"] for i, text in enumerate(ODD))
    got = tables.read_table(spark, "dim_products", str(path), multi_line=True)
    assert [r.product_name for r in got.orderBy("product_id").collect()] == ODD


def test_quotes_read_by_other_tools(spark, tmp_path):
    import csv

    rows = [{"product_id": i, "product_name": text} for i, text in enumerate(ODD)]
    sinks.write_csv(products(spark, *rows).coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    with open(part, newline="") as f:
        assert [r["product_name"] for r in csv.DictReader(f)] == ODD
    back = tables.read_table(spark, "dim_products", str(tmp_path / "out"), multi_line=True)
    assert [r.product_name for r in back.orderBy("product_id").collect()] == ODD


def test_wrong_number_of_fields_is_an_error(spark, tmp_path):
    path = tmp_path / "dim_products.csv"
    path.write_text(",".join(schemas.PRODUCTS.names) + "\n1,a,b,c,1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_table(spark, "dim_products", str(path)).collect()


def test_missing_table(spark, tmp_path):
    assert tables.read_if_exists(spark, "fact_orders", str(tmp_path / "none")) is None


@pytest.mark.parametrize("fmt", ["csv", "parquet", "orc", "json"])
def test_layer_round_trip(spark, tmp_path, fmt):
    df = orders(spark, {}, {"customer_id": None, "ship_date": None})
    path = sinks.write_layer(df, str(tmp_path), "silver", "fact_orders", fmt)
    back = tables.read_table(spark, "fact_orders", path, fmt)
    assert back.schema == df.schema and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_month_partitions_prune(spark, tmp_path):
    df = orders(spark, {}, {"order_date": dt.date(2024, 2, 1)})
    path = sinks.write_layer(df, str(tmp_path), "silver", "fact_orders", month_of="order_date")
    one = spark.read.parquet(path).filter("month_key = '2024-02'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and "PartitionFilters: [isnotnull(month_key" in plan


def test_full_refresh_replaces(spark, tmp_path):
    warehouse = sinks.Warehouse(location=str(tmp_path))
    sinks.full_refresh(products(spark, {}, {"product_id": 2, "cost_price": None}), "dim_products", warehouse)
    sinks.full_refresh(products(spark, {"product_id": 3, "cost_price": None}), "dim_products", warehouse)
    rows = spark.read.parquet(f"{tmp_path}/dim_products").collect()
    assert [(r.product_id, r.cost_price) for r in rows] == [(3, None)]


def test_catalog_tables(spark):
    warehouse = sinks.Warehouse(fmt="table")
    sinks.full_refresh(warehouses(spark, {}), "dim_warehouses", warehouse)
    assert spark.table("default.dim_warehouses").count() == 1
    spark.sql("DROP TABLE default.dim_warehouses")


def test_star_refresh_order(spark):
    steps = []

    class Recorder:
        def clear(self, df, table):
            steps.append(("clear", table))

        def replace(self, df, table):
            steps.append(("load", table))

    sinks.refresh_star_schema(
        {
            "fact_orders": orders(spark, {}),
            "fact_inventory": inventory(spark, {}),
            "dim_customers": customers(spark, {}),
            "dim_products": products(spark, {}),
            "dim_warehouses": warehouses(spark, {}),
        },
        Recorder(),
    )
    assert [t for _, t in steps[:2]] == ["fact_orders", "fact_inventory"]
    assert steps[5:] == [
        ("load", t)
        for t in ("dim_customers", "dim_products", "dim_warehouses", "fact_orders", "fact_inventory")
    ]


def test_database_options():
    plain = databases.read_options("jdbc:x", "SELECT 1", single_task=True)
    with pytest.raises(ValueError, match="single task"):
        databases.read_options("jdbc:x", "SELECT 1")
    assert plain["dbtable"] == "(SELECT 1) source_query" and "numPartitions" not in plain
    split = databases.read_options("jdbc:x", "SELECT 1", "id", (1, 9), 4)
    assert (split["partitionColumn"], split["lowerBound"], split["numPartitions"]) == ("id", "1", "4")
    with pytest.raises(ValueError):
        databases.read_options("jdbc:x", "SELECT 1", "id")
    assert databases.write_options("jdbc:x", "t")["truncate"] == "true"
    assert databases.write_options("jdbc:x", "t", connections=5)["numPartitions"] == "5"


def test_named_views(spark):
    tables.register_views({"known_products": products(spark, {})})
    assert spark.sql("SELECT count(*) FROM known_products").first()[0] == 1
