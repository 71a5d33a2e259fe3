"""End-to-end jobs: cleaning load, lake layers, marts, warehouse load, extracts and models."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.learning.churn import churn_scores
from stockweave.learning.demand import demand_forecast
from stockweave.learning.isolation import INPUTS, anomalies, detect_anomalies
from stockweave.operators import cleaning, gold, quality, reports, staging
from stockweave.operators.cleaning import MISSING_CUSTOMER
from stockweave.operators.demand import DEFAULT_KEYS, demand_features
from stockweave.operators.inventory import inventory_rebalancing
from stockweave.operators.segments import churn_features, rfm_segmentation
from stockweave.operators.warehouses import warehouse_scoring
from stockweave.schemas import DIMENSIONS, FACTS, TABLES
from stockweave.sources.sinks import (
    Warehouse,
    full_refresh,
    published,
    publish_zone,
    refresh_star_schema,
    save_model,
    write_csv,
    write_layer,
    write_quarantine,
)
from stockweave.sources.tables import (
    CSV,
    conform,
    if_exists,
    read_if_exists,
    read_raw,
    register_views,
)

Tables = Mapping[str, DataFrame]


def run_etl(
    raw: Tables,
    warehouse: Warehouse,
    quarantine: str,
    order: Sequence[str] = (),
    unknown_email: str = cleaning.UNKNOWN_EMAIL,
) -> dict[str, DataFrame]:
    """Clean the five tables and load them; orders without a customer go to quarantine.

    Raw orders are scanned once: duplicates are resolved and counted in that scan, and the clean
    table, the quarantine and the audit counts, stored as `cleaning_audit`, read its
    result. Returns what was loaded.
    """
    counted = durable(cleaning.classify_counted(raw["fact_orders"], order), "classified")
    classified = counted.drop("copies")
    write_quarantine(
        cleaning.rejected(classified, MISSING_CUSTOMER), quarantine, "orders_no_customer"
    )
    loaded = {
        "dim_customers": cleaning.clean_customers(raw["dim_customers"], unknown_email),
        "dim_products": cleaning.clean_products(raw["dim_products"]),
        "dim_warehouses": raw["dim_warehouses"],
        "fact_orders": cleaning.normalise_types(
            cleaning.parse_dates(cleaning.accepted(classified))
        ),
        "fact_inventory": cleaning.clean_inventory(raw["fact_inventory"]),
    }
    audit = cleaning.audit_report(
        counted, raw["dim_customers"], raw["dim_products"], raw["fact_inventory"]
    )
    with published(warehouse, counted.sparkSession):
        refresh_star_schema(loaded, warehouse)
        warehouse.replace(audit, "cleaning_audit")
    return {**loaded, "cleaning_audit": audit}


def store_bronze(spark: SparkSession, raw_dir: str, lake: str) -> None:
    """The input files unchanged, every column as the text it was."""
    for name in (*DIMENSIONS, *FACTS):
        write_layer(read_raw(spark, name, f"{raw_dir}/{name}.csv"), lake, "bronze", name)


def silver_tables(
    raw: Tables, order: Sequence[str] = (), unknown_email: str = cleaning.UNKNOWN_EMAIL
) -> dict[str, DataFrame]:
    return {
        "fact_orders": cleaning.silver_orders(raw["fact_orders"], order),
        "dim_customers": cleaning.clean_customers(
            raw["dim_customers"], unknown_email, parse=False
        ),
        "dim_products": cleaning.clean_products(raw["dim_products"]),
        "fact_inventory": cleaning.clean_inventory(raw["fact_inventory"]),
        "dim_warehouses": raw["dim_warehouses"],
    }


def gold_tables(orders: DataFrame) -> dict[str, DataFrame]:
    return {
        "monthly_sales_summary": gold.monthly_sales(orders),
        "product_performance": gold.product_performance(orders),
        "warehouse_performance": gold.warehouse_performance(orders),
    }


def run_medallion(
    spark: SparkSession,
    raw_dir: str,
    lake: str,
    extracts: str | None = None,
    gold_from: str = "raw",
    order: Sequence[str] = (),
) -> None:
    """Bronze, silver and gold layers under `lake`.

    Bronze holds the text as it came. It is parsed once, into a typed copy in scratch space
    that silver and gold scan, so filters and columns reach the scan. Gold is computed from
    raw orders unless `gold_from="silver"`. Model extracts are copied to gold if they exist.
    """
    store_bronze(spark, raw_dir, lake)
    raw = {
        name: durable(conform(spark.read.parquet(f"{lake}/bronze/{name}"), name), f"typed-{name}")
        for name in (*DIMENSIONS, *FACTS)
    }
    for name, df in silver_tables(raw, order).items():
        write_layer(
            df, lake, "silver", name, month_of="order_date" if name == "fact_orders" else None
        )
    if gold_from == "silver":
        orders = spark.read.parquet(f"{lake}/silver/fact_orders")
    else:
        orders = raw["fact_orders"]
    for name, df in gold_tables(orders).items():
        write_layer(df, lake, "gold", name)
    if extracts:
        for name, target in (
            ("demand_forecast", "demand_forecasts"),
            ("customer_analytics", "customer_analytics"),
        ):
            found = read_if_exists(spark, name, f"{extracts}/{name}")
            if found is not None:
                write_layer(found, lake, "gold", target)


def run_marts(
    tables: Tables,
    as_of: dt.date | None = None,
    warehouse: Warehouse | None = None,
    unknown_email: str = cleaning.UNKNOWN_EMAIL,
) -> dict[str, DataFrame]:
    """Staging models as views; the customer mart and the report of the data-quality checks
    as views, or as tables where a warehouse is given. All of them are known to SQL by name
    afterwards."""
    models = {
        "stg_orders": staging.stg_orders(tables["fact_orders"]),
        "stg_customers": staging.stg_customers(tables["dim_customers"], as_of, unknown_email),
    }
    models["customer_summary"] = staging.customer_summary(
        models["stg_orders"], models["stg_customers"], as_of
    )
    models["dq_report"] = quality.dq_report(models["stg_orders"], models["stg_customers"])
    register_views({**tables, **models})
    if warehouse:
        for name in ("customer_summary", "dq_report"):
            full_refresh(models[name], name, warehouse)
    return models


def run_procedures(
    tables: Tables, warehouse: Warehouse, as_of: dt.date | None = None, limit: int = 100
) -> None:
    """Customer segments, stock transfers and warehouse scores as warehouse tables."""
    orders = tables["fact_orders"]
    warehouse.replace(rfm_segmentation(orders, as_of), "rfm_segments")
    warehouse.replace(
        inventory_rebalancing(tables["fact_inventory"], tables["dim_products"], limit),
        "inventory_transfers",
    )
    warehouse.replace(warehouse_scoring(tables["dim_warehouses"], orders), "warehouse_scores")


def run_warehouse_load(
    raw: Tables,
    warehouse: Warehouse,
    extracts: Tables | None = None,
    order: Sequence[str] = (),
) -> None:
    """Load the cloud warehouse: dimensions as they come, orders under the row rules,
    inventory with its gaps filled, and the model outputs of the extracts."""
    with published(warehouse, raw["fact_orders"].sparkSession):
        refresh_star_schema(
            {
                **{name: raw[name] for name in DIMENSIONS},
                "fact_orders": cleaning.silver_orders(raw["fact_orders"], order),
                "fact_inventory": cleaning.clean_inventory(raw["fact_inventory"]),
            },
            warehouse,
        )
        extracts = extracts or {}
        if "demand_forecast" in extracts:
            # an extract has names in place of ids: those columns stay null
            found = extracts["demand_forecast"]
            full_refresh(
                found.select(
                    *[
                        F.col(f.name) if f.name in found.columns else F.lit(None).alias(f.name)
                        for f in TABLES["ml_demand_forecasts"]
                    ]
                ),
                "ml_demand_forecasts",
                warehouse,
            )
        if "customer_analytics" in extracts:
            warehouse.replace(
                extracts["customer_analytics"]
                .select("customer_id", "churn_probability", "risk_segment", "scored_date")
                .na.drop("any"),
                "ml_churn_scores",
            )


def run_exports(
    tables: Tables,
    forecasts: DataFrame,
    scores: DataFrame,
    anomalous: DataFrame,
    out: str,
    compression: str | None = None,
) -> None:
    """The five reporting extracts as CSV, plain unless a `compression` is named."""
    products, warehouses = tables["dim_products"], tables["dim_warehouses"]
    extracts = {
        "executive_overview": reports.executive_overview(
            tables["fact_orders"], products, warehouses, tables["dim_customers"]
        ),
        "customer_analytics": reports.customer_analytics(tables["dim_customers"], scores),
        "demand_forecast": reports.forecast_report(forecasts, products, warehouses),
        "inventory_status": reports.inventory_report(
            tables["fact_inventory"], products, warehouses
        ),
        "anomaly_orders": anomalous,
    }
    for name, df in extracts.items():
        write_csv(df, f"{out}/{name}", compression)


def publish_files(
    spark: SparkSession, raw_dir: str, extracts: str, quarantine: str, lake: str
) -> None:
    """Copy raw tables, extracts and quarantined rows to the zones of the lake."""
    for name in (*DIMENSIONS, *FACTS):
        publish_zone(read_raw(spark, name, f"{raw_dir}/{name}.csv"), lake, "raw", name)
    for name in (
        "executive_overview",
        "customer_analytics",
        "demand_forecast",
        "inventory_status",
        "anomaly_orders",
    ):
        text = spark.read.options(**CSV).csv(f"{extracts}/{name}")
        publish_zone(text, lake, "clean", name)
    for name in ("orders_no_customer", "anomaly_orders"):
        rows = if_exists(lambda name=name: spark.read.parquet(f"{quarantine}/quarantine/{name}"))
        if rows is not None:
            publish_zone(rows, lake, "ml-outputs", name)


def run_models(
    tables: Tables,
    warehouse: Warehouse,
    models: str,
    quarantine: str,
    as_of: dt.date | None = None,
    keys: Sequence[str] = DEFAULT_KEYS,
    **boosting,
) -> dict[str, DataFrame]:
    """Train the three models on cleaned orders, store them under `models`, load the
    forecasts and churn scores, and quarantine the anomalies.

    Returns forecasts, scores, anomalies and the metrics of the two supervised models.
    """
    orders = tables["fact_orders"]
    demand_model, forecasts, error = demand_forecast(
        demand_features(orders, keys), keys, **boosting
    )
    churn_model, scores, hit_rate = churn_scores(churn_features(orders, as_of), as_of)
    forest, detected = detect_anomalies(orders.select(*INPUTS))
    demand_model.save(f"{models}/demand", orders.sparkSession)
    save_model(churn_model, f"{models}/churn")
    forest.save(f"{models}/anomaly")
    with published(warehouse, orders.sparkSession):
        warehouse.replace(forecasts, "ml_demand_forecasts")
        full_refresh(scores, "ml_churn_scores", warehouse)
    write_quarantine(anomalies(detected), quarantine, "anomaly_orders")
    return {
        "forecasts": forecasts,
        "scores": scores,
        "anomalies": anomalies(detected),
        "forecast_metrics": error,
        "churn_accuracy": hit_rate,
    }
