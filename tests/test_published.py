import pytest

from stockweave.plans import jobs
from stockweave.plans import fixtures as fx
from stockweave.sources.sinks import PublishedWarehouse, published


def values(spark, table):
    return sorted(r[0] for r in spark.table(table).collect())


@pytest.fixture
def star(spark, tmp_path):
    return PublishedWarehouse(location=str(tmp_path / "files"), database="published_test")


def test_readers_see_whole_loads_only(spark, star):
    with published(star, spark):
        for name in ("dim_a", "fact_b"):
            star.replace(spark.range(3).toDF("x"), name)
    with pytest.raises(RuntimeError), published(star, spark):
        star.replace(spark.range(10, 12).toDF("x"), "dim_a")
        assert values(spark, "published_test.dim_a") == [0, 1, 2]
        raise RuntimeError("the load fails midway")
    for name in ("dim_a", "fact_b"):
        assert values(spark, f"published_test.{name}") == [0, 1, 2]
    with published(star, spark):
        for name in ("dim_a", "fact_b"):
            star.replace(spark.range(7, 8).toDF("x"), name)
    for name in ("dim_a", "fact_b"):
        assert values(spark, f"published_test.{name}") == [7]


def test_a_failing_etl_leaves_the_old_star(spark, small, star, tmp_path, monkeypatch):
    raw = {
        "dim_customers": fx.customers(spark, small),
        "dim_products": fx.products(spark, small),
        "dim_warehouses": fx.warehouses(spark, small),
        "fact_orders": fx.raw_orders(spark, small),
        "fact_inventory": fx.raw_inventory(spark, small),
    }
    jobs.run_etl(raw, star, str(tmp_path / "q"), fx.ORDER_TIEBREAK)
    tables = ("dim_customers", "dim_products", "dim_warehouses", "fact_orders", "fact_inventory")
    before = {t: spark.table(f"published_test.{t}").inputFiles() for t in tables}
    broken = raw | {"fact_inventory": raw["fact_inventory"].drop("quantity_on_hand")}
    with pytest.raises(Exception):
        jobs.run_etl(broken, star, str(tmp_path / "q2"), fx.ORDER_TIEBREAK)
    write = PublishedWarehouse.replace

    def replace(self, df, table):
        if table == "fact_inventory":
            raise OSError("the disk is full")
        write(self, df, table)

    monkeypatch.setattr(PublishedWarehouse, "replace", replace)
    with pytest.raises(OSError):
        jobs.run_etl(raw, star, str(tmp_path / "q3"), fx.ORDER_TIEBREAK)
    assert {t: spark.table(f"published_test.{t}").inputFiles() for t in tables} == before


def test_an_etl_run_scans_raw_orders_once(spark, small, star, tmp_path):
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    raw = {
        "dim_customers": fx.customers(spark, small),
        "dim_products": fx.products(spark, small),
        "dim_warehouses": fx.warehouses(spark, small),
        "fact_orders": fx.raw_orders(spark, small).withColumn(
            "order_line_id", counted.asNondeterministic()("order_line_id")
        ),
        "fact_inventory": fx.raw_inventory(spark, small),
    }
    rows = fx.raw_orders(spark, small).count()
    jobs.run_etl(raw, star, str(tmp_path / "q"), fx.ORDER_TIEBREAK)
    assert seen.value == rows
