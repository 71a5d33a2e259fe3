"""End-to-end jobs over CSV files written from the driver's tables."""

import os

import pytest

from stockweave.plans import fixtures as fx
from stockweave.plans import jobs
from stockweave.schemas import DIMENSIONS, FACTS, TABLES
from stockweave.sources.sinks import Warehouse
from stockweave.sources.tables import read_if_exists, read_tables


@pytest.fixture(scope="module")
def raw_dir(spark, small, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("raw"))
    for name, df in {
        "dim_customers": fx.customers(spark, small),
        "dim_products": fx.products(spark, small),
        "dim_warehouses": fx.warehouses(spark, small),
        "fact_orders": fx.raw_orders(spark, small),
        "fact_inventory": fx.raw_inventory(spark, small),
    }.items():
        df.coalesce(1).write.option("header", True).csv(f"{base}/{name}.csv")
    return base


@pytest.fixture(scope="module")
def loaded(spark, raw_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("load"))
    jobs.run_etl(
        read_tables(spark, raw_dir), Warehouse(location=f"{base}/wh"), base, fx.ORDER_TIEBREAK
    )
    return base


def test_etl(spark, small, loaded):
    from stockweave.operators.cleaning import clean_orders

    clean, quarantine = clean_orders(fx.raw_orders(spark, small), fx.ORDER_TIEBREAK)
    stored = spark.read.parquet(f"{loaded}/wh/fact_orders")
    assert stored.exceptAll(clean).count() == 0 and stored.count() == clean.count()
    kept = spark.read.parquet(f"{loaded}/quarantine/orders_no_customer")
    assert kept.count() == quarantine.count() > 0
    assert spark.read.parquet(f"{loaded}/wh/dim_customers").filter("email IS NULL").count() == 0


def test_medallion(spark, raw_dir, tmp_path):
    lake = str(tmp_path)
    jobs.run_medallion(spark, raw_dir, lake, extracts=f"{lake}/none", order=fx.ORDER_TIEBREAK)
    for name in (*DIMENSIONS, *FACTS):
        assert os.path.isdir(f"{lake}/bronze/{name}") and os.path.isdir(f"{lake}/silver/{name}")
    bronze = spark.read.parquet(f"{lake}/bronze/fact_orders")
    assert set(t for _, t in bronze.dtypes) == {"string"} and bronze.count() == 6000
    from_raw = spark.read.parquet(f"{lake}/gold/monthly_sales_summary").agg({"total_orders": "sum"})
    jobs.run_medallion(spark, raw_dir, f"{lake}/2", gold_from="silver", order=fx.ORDER_TIEBREAK)
    from_silver = spark.read.parquet(f"{lake}/2/gold/monthly_sales_summary").agg({"total_orders": "sum"})
    assert from_raw.first()[0] > from_silver.first()[0] > 0
    assert not os.path.exists(f"{lake}/gold/customer_analytics")


def test_marts(spark, loaded):
    tables = read_tables(spark, f"{loaded}/wh", "parquet")
    jobs.run_marts(tables, fx.AS_OF, Warehouse(location=f"{loaded}/marts"))
    assert spark.sql("SELECT * FROM customer_summary").count() == 150
    assert spark.read.parquet(f"{loaded}/marts/customer_summary").count() == 150


def test_models_exports_and_warehouse_load(spark, raw_dir, loaded):
    tables = read_tables(spark, f"{loaded}/wh", "parquet")
    # the small tables hold too little history per product and warehouse for the model
    keyed = {
        **tables,
        "fact_orders": tables["fact_orders"].selectExpr(
            "*", "product_id % 5 AS product_group", "warehouse_id % 3 AS warehouse_group"
        ),
    }
    out = jobs.run_models(
        keyed, Warehouse(location=f"{loaded}/wh"), f"{loaded}/models", loaded, fx.AS_OF,
        keys=("product_group", "warehouse_group"), max_iter=2,
    )
    assert out["forecasts"].count() > 0 and out["anomalies"].count() > 0
    assert os.path.isdir(f"{loaded}/models/churn/metadata")

    forecasts = out["forecasts"].withColumnsRenamed(
        {"product_group": "product_id", "warehouse_group": "warehouse_id"}
    )
    extracts = f"{loaded}/extracts"
    jobs.run_exports(tables, forecasts, out["scores"], out["anomalies"], extracts)
    analytics = read_if_exists(spark, "customer_analytics", f"{extracts}/customer_analytics")
    assert analytics.count() == 150

    raw = read_tables(spark, raw_dir)
    target = Warehouse(location=f"{loaded}/cloud")
    found = {
        name: read_if_exists(spark, name, f"{extracts}/{name}")
        for name in ("customer_analytics", "demand_forecast")
    }
    jobs.run_warehouse_load(raw, target, found, fx.ORDER_TIEBREAK)
    scores = spark.read.parquet(f"{loaded}/cloud/ml_churn_scores")
    assert 0 < scores.count() <= 150
    assert spark.read.parquet(f"{loaded}/cloud/ml_demand_forecasts").columns == TABLES["ml_demand_forecasts"].names
    # dimensions are loaded as they come
    assert spark.read.parquet(f"{loaded}/cloud/dim_customers").filter("email IS NULL").count() > 0

    jobs.publish_files(spark, raw_dir, extracts, loaded, f"{loaded}/zones")
    assert sorted(os.listdir(f"{loaded}/zones")) == ["clean", "ml-outputs", "raw"]
    assert sorted(os.listdir(f"{loaded}/zones/ml-outputs")) == [
        "anomaly_orders", "orders_no_customer",
    ]


def test_command_line(spark, raw_dir, tmp_path):
    from stockweave.__main__ import main

    where = {n: f"{tmp_path}/{n}" for n in ("warehouse", "quarantine", "extracts", "cloud", "lake")}
    main(["etl", "--raw", raw_dir, "--warehouse", where["warehouse"], "--quarantine", where["quarantine"]], spark)
    main(["marts", "--warehouse", where["warehouse"], "--as-of", "2001-08-02"], spark)
    assert spark.read.parquet(f"{where['warehouse']}/customer_summary").count() == 150
    assert spark.read.parquet(f"{where['warehouse']}/dq_report").count() == 8
    assert spark.read.parquet(f"{where['warehouse']}/cleaning_audit").count() == 13
    main(["procedures", "--warehouse", where["warehouse"], "--as-of", "2001-08-02", "--limit", "7"], spark)
    assert spark.read.parquet(f"{where['warehouse']}/inventory_transfers").count() == 7
    assert spark.read.parquet(f"{where['warehouse']}/warehouse_scores").count() > 0
    assert spark.read.parquet(f"{where['warehouse']}/rfm_segments").count() > 0

    # stand-ins for what the model job leaves behind
    orders = spark.read.parquet(f"{where['warehouse']}/fact_orders")
    orders.selectExpr(
        "product_id", "warehouse_id", "order_date AS forecast_date",
        "CAST(quantity AS DOUBLE) AS predicted_demand", "'m' AS model_name",
    ).write.parquet(f"{where['warehouse']}/ml_demand_forecasts")
    orders.selectExpr(
        "customer_id", "0.5D AS churn_probability", "'Medium Risk' AS risk_segment",
        "order_date AS scored_date",
    ).dropDuplicates(["customer_id"]).write.parquet(f"{where['warehouse']}/ml_churn_scores")
    orders.write.parquet(f"{where['quarantine']}/quarantine/anomaly_orders")

    main(["exports", "--warehouse", where["warehouse"], "--quarantine", where["quarantine"], "--extracts", where["extracts"]], spark)
    main(["load", "--raw", raw_dir, "--warehouse", where["cloud"], "--extracts", where["extracts"]], spark)
    assert spark.read.parquet(f"{where['cloud']}/ml_churn_scores").count() == 150
    main(["publish", "--raw", raw_dir, "--extracts", where["extracts"], "--quarantine", where["quarantine"], "--lake", where["lake"]], spark)
    assert len(os.listdir(f"{where['lake']}/clean")) == 5


def test_stream_command(spark, small, tmp_path):
    from stockweave.__main__ import main
    from stockweave.sources.feeds import write_messages
    from stockweave.streaming.orders import encode_orders

    write_messages(encode_orders(fx.raw_orders(spark, small)), f"{tmp_path}/feed", fmt="text")
    folders = [x for n in ("feed", "clean", "quarantine", "rejects", "checkpoint") for x in (f"--{n}", f"{tmp_path}/{n}")]
    main(["stream", *folders, "--delay", "2 days"], spark)
    assert spark.read.parquet(f"{tmp_path}/clean").count() > 0
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 0
