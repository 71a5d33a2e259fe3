"""Registered queries that run a source, sink or job and return what it stored.

The input is written to shared scratch space as the files the jobs expect, the job runs as
it would in production, and the stored table is read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.durable import durable, scratch_path
from stockweave.functions.scalar import risk_segment
from stockweave.learning import churn
from stockweave.learning import demand as boosted
from stockweave.operators import cleaning, demand, reports, segments
from stockweave.plans import fixtures as fx
from stockweave.plans import jobs
from stockweave.plans.queries import AS_OF, FIRST, query, scored
from stockweave.sources.sinks import (
    PublishedWarehouse,
    Warehouse,
    save_model,
    write_csv,
    write_layer,
)
from stockweave.sources.tables import CSV, conform, read_if_exists, read_table, read_tables

_TABLES = {
    "dim_customers": fx.customers,
    "dim_products": fx.products,
    "dim_warehouses": fx.warehouses,
    "fact_orders": fx.raw_orders,
    "fact_inventory": fx.raw_inventory,
}


_COMPRESSION = "gzip"  # of the CSV files in scratch space


def _raw_files(
    spark: SparkSession, sf_dir: str, tables: Mapping[str, DataFrame] | None = None
) -> str:
    """The five tables as CSV, and the folder that holds them."""
    folder = scratch_path(spark, "raw-csv")
    for name, table in (tables or _tables(spark, sf_dir)).items():
        write_csv(table, f"{folder}/{name}.csv", _COMPRESSION)
    return folder


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir) for name, table in _TABLES.items()}


def _stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables with the facts stored: a job that reads them several times doesn't join
    orders and lines, or look for the pairs in stock, each time anew."""
    tables = _tables(spark, sf_dir)
    return tables | {n: durable(tables[n], n) for n in ("fact_orders", "fact_inventory")}


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(location=scratch_path(spark, "warehouse"), options={"compression": "zstd"})


# ---- sources and sinks


@query
def csv_scan_orders(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    write_csv(fx.raw_orders(spark, sf_dir), path)
    return read_table(spark, "fact_orders", path)


@query
def csv_quoted_products(spark, sf_dir):
    """Quotes, commas and line breaks survive the way to a file and back."""
    path = scratch_path(spark, "products-csv")
    odd = F.concat("product_name", F.lit(' 6" wide, "best"\nsecond line, "'))
    write_csv(fx.products(spark, sf_dir).withColumn("product_name", odd), path)
    return read_table(spark, "dim_products", path, multi_line=True)


@query
def optional_tables(spark, sf_dir):
    """Rows of a table that is stored, and null for one that isn't."""
    path = scratch_path(spark, "optional")
    write_csv(fx.customers(spark, sf_dir), f"{path}/dim_customers")
    found = {
        name: read_if_exists(spark, name, f"{path}/{name}")
        for name in ("dim_customers", "dim_products")
    }
    counts = [
        (
            spark.range(1).select(F.lit(None).cast("long").alias("stored_rows"))
            if table is None
            else table.agg(F.count("*").alias("stored_rows"))
        ).select(F.lit(name).alias("table_name"), "stored_rows")
        for name, table in found.items()
    ]
    return counts[0].unionByName(counts[1])


@query
def layer_orders_by_month(spark, sf_dir):
    base = scratch_path(spark, "layer")
    path = write_layer(
        fx.raw_orders(spark, sf_dir), base, "silver", "fact_orders", month_of="order_date"
    )
    return spark.read.parquet(path)


@query
def named_views(spark, sf_dir):
    """Models are known to SQL by name after the marts job."""
    jobs.run_marts({n: t(spark, sf_dir) for n, t in _TABLES.items()}, AS_OF)
    return spark.sql(
        "SELECT c.customer_id, c.total_orders, COUNT(o.order_line_id) AS lines"
        " FROM customer_summary c LEFT JOIN stg_orders o ON c.customer_id = o.customer_id"
        " GROUP BY c.customer_id, c.total_orders"
    )


@query
def stored_model(spark, sf_dir):
    """A model scores the same after it was saved and loaded."""
    features = durable(
        segments.churn_features(fx.raw_orders(spark, sf_dir), AS_OF), "stored-features"
    )
    model = churn.churn_scores(features, AS_OF)[0]
    path = scratch_path(spark, "model")
    save_model(model, path)
    ready = churn.complete_features(features)[0]
    before = churn.score_churn(model, ready, AS_OF)
    after = churn.score_churn(PipelineModel.load(path), ready, AS_OF).select(
        F.col("customer_id").alias("same"), F.col("churn_probability").alias("again")
    )
    pairs = before.join(after, F.col("customer_id").eqNullSafe(F.col("same")))
    return pairs.agg(
        F.count("*").alias("scored"),
        F.count_if(~F.col("churn_probability").eqNullSafe(F.col("again"))).alias("changed"),
    )


# ---- jobs


def _etl(spark, sf_dir):
    raw = read_tables(spark, _raw_files(spark, sf_dir))
    target, quarantine = _warehouse(spark), scratch_path(spark, "quarantine")
    jobs.run_etl(raw, target, quarantine, FIRST)
    return target.location, quarantine


@query
def etl_fact_orders(spark, sf_dir):
    return spark.read.parquet(f"{_etl(spark, sf_dir)[0]}/fact_orders")


@query
def etl_dim_customers(spark, sf_dir):
    return spark.read.parquet(f"{_etl(spark, sf_dir)[0]}/dim_customers")


@query
def etl_quarantine(spark, sf_dir):
    return spark.read.parquet(f"{_etl(spark, sf_dir)[1]}/quarantine/orders_no_customer")


@query
def etl_audit(spark, sf_dir):
    return spark.read.parquet(f"{_etl(spark, sf_dir)[0]}/cleaning_audit")


def _lake(spark, sf_dir, gold_from="raw"):
    lake = scratch_path(spark, "lake")
    jobs.run_medallion(
        spark, _raw_files(spark, sf_dir), lake, gold_from=gold_from, order=FIRST
    )
    return lake


@query
def bronze_orders(spark, sf_dir):
    lake = scratch_path(spark, "lake")
    jobs.store_bronze(spark, _raw_files(spark, sf_dir), lake)
    return conform(spark.read.parquet(f"{lake}/bronze/fact_orders"), "fact_orders")


@query
def medallion_silver_orders(spark, sf_dir):
    stored = spark.read.parquet(f"{_lake(spark, sf_dir)}/silver/fact_orders")
    return stored.drop("month_key")


@query
def medallion_gold_monthly(spark, sf_dir):
    return spark.read.parquet(f"{_lake(spark, sf_dir)}/gold/monthly_sales_summary")


@query
def medallion_gold_from_silver(spark, sf_dir):
    return spark.read.parquet(f"{_lake(spark, sf_dir, 'silver')}/gold/monthly_sales_summary")


@query
def marts_customer_summary(spark, sf_dir):
    target = _warehouse(spark)
    jobs.run_marts({n: t(spark, sf_dir) for n, t in _TABLES.items()}, AS_OF, target)
    return spark.read.parquet(f"{target.location}/customer_summary")


def _extracts(spark, sf_dir):
    """The job's extracts, from rule-based scores, last month's demand and large orders."""
    tables = _stored_tables(spark, sf_dir)
    lagged = demand.add_lags(demand.demand_cells(tables["fact_orders"]), k=1)
    forecasts = demand.forecast_rows(
        lagged.filter(F.col("lag_1_qty").isNotNull()), F.col("lag_1_qty"), "previous_month"
    )
    large = tables["fact_orders"].filter(F.col("quantity") > 45)
    out = scratch_path(spark, "extracts")
    jobs.run_exports(tables, forecasts, scored(tables["fact_orders"]), large, out, _COMPRESSION)
    return tables, out


@query
def export_executive_overview(spark, sf_dir):
    tables, out = _extracts(spark, sf_dir)
    same = reports.executive_overview(
        tables["fact_orders"],
        tables["dim_products"],
        tables["dim_warehouses"],
        tables["dim_customers"],
    )
    return spark.read.schema(same.schema).options(**CSV).csv(f"{out}/executive_overview")


def _extract(spark: SparkSession, out: str, name: str, same: DataFrame) -> DataFrame:
    return spark.read.schema(same.schema).options(**CSV).csv(f"{out}/{name}")


@query
def export_customer_analytics(spark, sf_dir):
    tables, out = _extracts(spark, sf_dir)
    same = reports.customer_analytics(tables["dim_customers"], scored(tables["fact_orders"]))
    return _extract(spark, out, "customer_analytics", same)


@query
def export_demand_forecast(spark, sf_dir):
    out = _extracts(spark, sf_dir)[1]
    return read_table(spark, "demand_forecast", f"{out}/demand_forecast")


@query
def export_inventory_status(spark, sf_dir):
    tables, out = _extracts(spark, sf_dir)
    same = reports.inventory_report(
        tables["fact_inventory"], tables["dim_products"], tables["dim_warehouses"]
    )
    return _extract(spark, out, "inventory_status", same)


@query
def export_anomaly_orders(spark, sf_dir):
    tables, out = _extracts(spark, sf_dir)
    return _extract(spark, out, "anomaly_orders", tables["fact_orders"])


def _published_star(spark: SparkSession, sf_dir: str) -> str:
    """The database whose views a load has published."""
    name = f"star_{uuid.uuid4().hex}"
    target = PublishedWarehouse(location=scratch_path(spark, "published"), database=name)
    raw = {n: t(spark, sf_dir) for n, t in _TABLES.items()}
    jobs.run_etl(raw, target, scratch_path(spark, "quarantine"), FIRST)
    return name


@query
def published_fact_orders(spark, sf_dir):
    return spark.table(f"{_published_star(spark, sf_dir)}.fact_orders")


@query
def published_audit(spark, sf_dir):
    return spark.table(f"{_published_star(spark, sf_dir)}.cleaning_audit")


@query
def load_churn_scores(spark, sf_dir):
    """Scores of an extract, loaded into the warehouse: rows without a score are left out."""
    raw, out = _extracts(spark, sf_dir)
    target = _warehouse(spark)
    extract = read_table(spark, "customer_analytics", f"{out}/customer_analytics")
    jobs.run_warehouse_load(raw, target, {"customer_analytics": extract}, FIRST)
    return spark.read.parquet(f"{target.location}/ml_churn_scores")


@query
def load_fact_orders(spark, sf_dir):
    target = _warehouse(spark)
    jobs.run_warehouse_load(
        {n: t(spark, sf_dir) for n, t in _TABLES.items()}, target, order=FIRST
    )
    return spark.read.parquet(f"{target.location}/fact_orders")


@query
def publish_raw_orders(spark, sf_dir):
    tables, out = _extracts(spark, sf_dir)
    raw, lake = _raw_files(spark, sf_dir, tables), scratch_path(spark, "zones")
    jobs.publish_files(spark, raw, out, scratch_path(spark, "no-quarantine"), lake)
    return conform(spark.read.parquet(f"{lake}/raw/fact_orders"), "fact_orders")


# ---- what holds for the outputs of the models, whatever they learned


@query
def demand_forecast_rows(spark, sf_dir):
    """Which cells are forecast, for which month, by which model."""
    features = demand.demand_features(fx.demand_orders(spark, sf_dir), fx.DEMAND_KEYS)
    made = boosted.demand_forecast(features, fx.DEMAND_KEYS)[1]
    return made.drop("predicted_demand")


@query
def churn_score_contract(spark, sf_dir):
    """One score for each customer, a probability, in the segment of its bin."""
    features = segments.churn_features(fx.raw_orders(spark, sf_dir), AS_OF)
    scores = churn.churn_scores(features, AS_OF)[1]
    p = F.col("churn_probability")
    near = F.least(*[F.abs(p - F.lit(edge).cast("double")) for edge in (0.3, 0.6, 1.0)]) < 0.0001
    right = near | F.col("risk_segment").eqNullSafe(risk_segment(p.cast("double")))
    return scores.agg(
        F.count("*").alias("scored"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_if(~p.between(0, 1)).alias("not_probabilities"),
        F.count_if(~right).alias("in_another_bin"),
        F.min("scored_date").alias("scored_date"),
    )
