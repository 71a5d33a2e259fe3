"""The registered queries: every operator over the driver's tables, whole."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stockweave.durable import RELEASE, durable, scratch_path
from stockweave.functions.scalar import line_total
from stockweave.learning import churn, isolation
from stockweave.learning import demand as boosted
from stockweave.operators import (
    cleaning,
    demand,
    evaluation,
    gold,
    inventory,
    quality,
    reports,
    segments,
    staging,
    warehouses,
)
from stockweave.plans import fixtures as fx
from stockweave.schemas import ORDERS
from stockweave.session import usually
from stockweave.sources.feeds import read_order_stream, write_messages
from stockweave.sources.tables import if_exists
from stockweave.streaming import numbering
from stockweave.streaming import orders as feed

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = fx.AS_OF
FIRST = fx.ORDER_TIEBREAK
_REGISTRY: dict[str, Query] = {}


def _portable(df: DataFrame) -> DataFrame:
    """Amounts leave as doubles, which every client compares the same way."""
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema):
        return df
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _portable(fn(spark, sf_dir))

    _REGISTRY[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    from stockweave.plans import stored  # noqa: F401 - registers what runs whole jobs

    return dict(_REGISTRY)


# ---- sources and cleaning


@query
def scan_orders(spark, sf_dir):
    return fx.raw_orders(spark, sf_dir)


@query
def scan_customers(spark, sf_dir):
    return fx.customers(spark, sf_dir)


@query
def scan_products(spark, sf_dir):
    return fx.products(spark, sf_dir)


@query
def scan_warehouses(spark, sf_dir):
    return fx.warehouses(spark, sf_dir)


@query
def scan_inventory(spark, sf_dir):
    return fx.raw_inventory(spark, sf_dir)


@query
def dedupe_orders(spark, sf_dir):
    return cleaning.dedupe_first(fx.raw_orders(spark, sf_dir), [cleaning.ORDER_KEY], FIRST)


@query
def dedupe_orders_in_place(spark, sf_dir):
    stored = durable(fx.raw_orders(spark, sf_dir), "raw-orders")
    return cleaning.dedupe_in_place(stored, [cleaning.ORDER_KEY], FIRST)


@query
def quarantine_orders(spark, sf_dir):
    return cleaning.clean_orders(fx.raw_orders(spark, sf_dir), FIRST)[1]


@query
def reject_quantity(spark, sf_dir):
    return cleaning.reject_quantity(fx.raw_orders(spark, sf_dir))


@query
def reject_total(spark, sf_dir):
    return cleaning.reject_total(fx.raw_orders(spark, sf_dir))


@query
def parse_dates(spark, sf_dir):
    """Dates arrive as text; lines still in processing have an unreadable ship date."""
    text = fx.raw_orders(spark, sf_dir).select(
        "order_line_id",
        "product_id",
        "warehouse_id",
        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
        F.when(F.col("order_status") == "Processing", "not shipped")
        .otherwise(F.date_format("ship_date", "yyyy-MM-dd"))
        .alias("ship_date"),
        F.date_format("delivery_date", "yyyy-MM-dd").alias("delivery_date"),
    )
    return cleaning.parse_dates(text)


@query
def clean_orders(spark, sf_dir):
    return cleaning.clean_orders(fx.raw_orders(spark, sf_dir), FIRST)[0]


@query
def silver_orders(spark, sf_dir):
    return cleaning.silver_orders(fx.raw_orders(spark, sf_dir), FIRST)


@query
def clean_customers(spark, sf_dir):
    return cleaning.clean_customers(fx.customers(spark, sf_dir))


@query
def clean_products(spark, sf_dir):
    return cleaning.clean_products(fx.products(spark, sf_dir))


@query
def clean_inventory(spark, sf_dir):
    return cleaning.clean_inventory(fx.raw_inventory(spark, sf_dir))


@query
def cleaning_report(spark, sf_dir):
    return cleaning.cleaning_report(
        fx.raw_orders(spark, sf_dir),
        fx.customers(spark, sf_dir),
        fx.products(spark, sf_dir),
        fx.raw_inventory(spark, sf_dir),
        FIRST,
    )


@query
def line_totals(spark, sf_dir):
    return fx.raw_orders(spark, sf_dir).select(
        "order_line_id",
        "product_id",
        "warehouse_id",
        "quantity",
        line_total(F.col("unit_price"), F.col("quantity"), F.col("discount_pct")).alias(
            "line_total"
        ),
    )


@query
def orders_with_replays(spark, sf_dir):
    """The feed with its returned lines sent twice."""
    raw = fx.raw_orders(spark, sf_dir)
    return cleaning.with_replays(raw, raw.filter(F.col("order_status") == "Returned"))


# ---- staging, mart and gold


@query
def stg_orders(spark, sf_dir):
    return staging.stg_orders(fx.raw_orders(spark, sf_dir))


@query
def stg_customers(spark, sf_dir):
    return staging.stg_customers(fx.customers(spark, sf_dir), AS_OF)


def _summary(spark, sf_dir, **thresholds):
    return staging.customer_summary(
        staging.stg_orders(fx.raw_orders(spark, sf_dir)),
        staging.stg_customers(fx.customers(spark, sf_dir), AS_OF),
        AS_OF,
        **thresholds,
    )


@query
def customer_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query
def customer_summary_scaled(spark, sf_dir):
    """Thresholds that spread the driver's customers over all three segments."""
    return _summary(spark, sf_dir, mid=300_000, high=500_000)


@query
def monthly_sales(spark, sf_dir):
    return gold.monthly_sales(fx.raw_orders(spark, sf_dir))


@query
def product_performance(spark, sf_dir):
    return gold.product_performance(fx.raw_orders(spark, sf_dir))


@query
def warehouse_performance(spark, sf_dir):
    return gold.warehouse_performance(fx.raw_orders(spark, sf_dir))


@query
def monthly_sales_from_silver(spark, sf_dir):
    return gold.monthly_sales(cleaning.silver_orders(fx.raw_orders(spark, sf_dir), FIRST))


# ---- reports


@query
def executive_overview(spark, sf_dir):
    return reports.executive_overview(
        fx.raw_orders(spark, sf_dir),
        fx.products(spark, sf_dir),
        fx.warehouses(spark, sf_dir),
        fx.customers(spark, sf_dir),
    )


def rule_scores(spark, sf_dir):
    return scored(fx.raw_orders(spark, sf_dir))


def scored(orders: DataFrame) -> DataFrame:
    """Score rows from a rule instead of a model: the idle share of the last year."""
    features = segments.churn_features(orders, AS_OF)
    idle = F.least(F.col("recency_days").cast("double") / 365, F.lit(1.0))
    return segments.churn_score_rows(features, idle, AS_OF)


@query
def customer_analytics(spark, sf_dir):
    return reports.customer_analytics(fx.customers(spark, sf_dir), rule_scores(spark, sf_dir))


@query
def forecast_report(spark, sf_dir):
    """Forecast each cell by the month before it, at product and warehouse grain."""
    lagged = demand.add_lags(demand.demand_cells(fx.raw_orders(spark, sf_dir)), k=1)
    forecasts = demand.forecast_rows(
        lagged.filter(F.col("lag_1_qty").isNotNull()), F.col("lag_1_qty"), "previous_month"
    )
    return reports.forecast_report(
        forecasts, fx.products(spark, sf_dir), fx.warehouses(spark, sf_dir)
    )


@query
def inventory_status(spark, sf_dir):
    return reports.inventory_report(
        fx.raw_inventory(spark, sf_dir), fx.products(spark, sf_dir), fx.warehouses(spark, sf_dir)
    )


@query
def inventory_rebalancing(spark, sf_dir):
    return inventory.inventory_rebalancing(
        fx.raw_inventory(spark, sf_dir), fx.products(spark, sf_dir)
    )


@query
def inventory_rebalancing_top_1000(spark, sf_dir):
    return inventory.inventory_rebalancing(
        fx.raw_inventory(spark, sf_dir), fx.products(spark, sf_dir), limit=1000
    )


@query
def inventory_status_clean(spark, sf_dir):
    """Missing counts become 0 in cleaning and then read as understocked."""
    return reports.inventory_report(
        cleaning.clean_inventory(fx.raw_inventory(spark, sf_dir)),
        fx.products(spark, sf_dir),
        fx.warehouses(spark, sf_dir),
    )


@query
def inventory_rebalancing_clean(spark, sf_dir):
    """Cleaned inputs: missing counts are needs, missing costs save nothing."""
    return inventory.inventory_rebalancing(
        cleaning.clean_inventory(fx.raw_inventory(spark, sf_dir)),
        cleaning.clean_products(fx.products(spark, sf_dir)),
    )


@query
def warehouse_scoring(spark, sf_dir):
    return warehouses.warehouse_scoring(fx.warehouses(spark, sf_dir), fx.raw_orders(spark, sf_dir))


# ---- customer segments


@query
def rfm_base(spark, sf_dir):
    return segments.rfm_base(fx.raw_orders(spark, sf_dir), AS_OF)


@query
def rfm_scores(spark, sf_dir):
    return segments.rfm_scores(segments.rfm_base(fx.raw_orders(spark, sf_dir), AS_OF))


@query
def rfm_segmentation(spark, sf_dir):
    return segments.rfm_segmentation(fx.raw_orders(spark, sf_dir), AS_OF)


@query
def churn_features(spark, sf_dir):
    return segments.churn_features(fx.raw_orders(spark, sf_dir), AS_OF)


@query
def churn_risk_segments(spark, sf_dir):
    return rule_scores(spark, sf_dir)


@query
def segment_counts(spark, sf_dir):
    return segments.segment_counts(rule_scores(spark, sf_dir), "risk_segment")


@query
def classification_accuracy(spark, sf_dir):
    """Call a customer with fewer than 40 order lines churned."""
    features = segments.churn_features(fx.raw_orders(spark, sf_dir), AS_OF)
    guess = F.when(F.col("frequency") < 40, 1).otherwise(0)
    return evaluation.accuracy(features, "churned", guess)


# ---- demand


def _cells(spark, sf_dir):
    return demand.demand_cells(fx.demand_orders(spark, sf_dir), fx.DEMAND_KEYS)


def _features(spark, sf_dir):
    return demand.demand_features(fx.demand_orders(spark, sf_dir), fx.DEMAND_KEYS)


@query
def demand_cells(spark, sf_dir):
    return _cells(spark, sf_dir)


@query
def demand_lags(spark, sf_dir):
    return demand.add_lags(_cells(spark, sf_dir), fx.DEMAND_KEYS)


@query
def demand_rolling(spark, sf_dir):
    return demand.add_rolling(_cells(spark, sf_dir), fx.DEMAND_KEYS)


@query
def demand_season(spark, sf_dir):
    return demand.add_season(_cells(spark, sf_dir))


@query
def demand_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def forecast_metrics(spark, sf_dir):
    """Error of the rolling mean as a forecast."""
    return evaluation.forecast_metrics(
        _features(spark, sf_dir), demand.TARGET, "rolling_3m_avg"
    )


@query
def train_test_split(spark, sf_dir):
    return evaluation.hash_split(
        _features(spark, sf_dir), [*fx.DEMAND_KEYS, "year", "month"]
    )


# ---- data quality


@query
def dq_unique(spark, sf_dir):
    return quality.check_unique(fx.raw_orders(spark, sf_dir), ["order_line_id"])


@query
def dq_not_null(spark, sf_dir):
    return quality.check_not_null(
        fx.raw_orders(spark, sf_dir),
        ["order_line_id", "customer_id", "ship_date", "quantity", "total_amount"],
    )


@query
def dq_report(spark, sf_dir):
    return quality.dq_report(
        staging.stg_orders(fx.raw_orders(spark, sf_dir)),
        staging.stg_customers(fx.customers(spark, sf_dir), AS_OF),
    )


# ---- the same reports over the cleaned orders a warehouse holds


def cleaned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_orders(fx.raw_orders(spark, sf_dir), FIRST)[0]


@query
def customer_summary_from_clean(spark, sf_dir):
    return staging.customer_summary(
        staging.stg_orders(cleaned_orders(spark, sf_dir)),
        staging.stg_customers(fx.customers(spark, sf_dir), AS_OF),
        AS_OF,
    )


@query
def executive_overview_from_clean(spark, sf_dir):
    return reports.executive_overview(
        cleaned_orders(spark, sf_dir),
        fx.products(spark, sf_dir),
        fx.warehouses(spark, sf_dir),
        fx.customers(spark, sf_dir),
    )


@query
def warehouse_scoring_from_clean(spark, sf_dir):
    return warehouses.warehouse_scoring(
        fx.warehouses(spark, sf_dir), cleaned_orders(spark, sf_dir)
    )


@query
def rfm_segmentation_from_clean(spark, sf_dir):
    return segments.rfm_segmentation(cleaned_orders(spark, sf_dir), AS_OF)


@query
def churn_features_from_clean(spark, sf_dir):
    return segments.churn_features(cleaned_orders(spark, sf_dir), AS_OF)


@query
def demand_features_from_clean(spark, sf_dir):
    orders = fx.demand_orders(spark, sf_dir, cleaned_orders(spark, sf_dir))
    return demand.demand_features(orders, fx.DEMAND_KEYS)


@query
def dq_report_from_clean(spark, sf_dir):
    return quality.dq_report(
        staging.stg_orders(cleaned_orders(spark, sf_dir)),
        staging.stg_customers(fx.customers(spark, sf_dir), AS_OF),
    )


# ---- messages and streams


@query
def orders_to_json(spark, sf_dir):
    return feed.encode_orders(fx.raw_orders(spark, sf_dir))


# Messages repeat every name: compressed they take a fifth of the room, and half of a shuffle's.
# A file is read by one task.
_FEED = {
    "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "1000000"
}


def _published(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Publish orders as messages and open them as a stream."""
    topic = scratch_path(spark, "feed")
    write_messages(feed.encode_orders(orders), topic, fmt="text", **_FEED)
    return feed.decode_orders(read_order_stream(spark, "text", path=topic))


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out = scratch_path(spark, "drained")
    feed.drain(stream, out, scratch_path(spark, "offsets"))
    return spark.read.schema(stream.schema).parquet(out)


@query
def order_stream(spark, sf_dir):
    return _drained(spark, _published(spark, fx.raw_orders(spark, sf_dir)))


@query
def order_stream_count(spark, sf_dir):
    out = scratch_path(spark, "counted")
    counted = feed.running_count(_published(spark, fx.raw_orders(spark, sf_dir)))
    feed.drain_batches(
        counted,
        lambda df, batch: df.write.mode("overwrite").parquet(out),
        scratch_path(spark, "offsets"),
    )
    return spark.read.schema(counted.schema).parquet(out)


WAVES = 3
ALL_FILES = (1 << 31) - 1
# A task has the files of all waves open; with one at a time it would sort its messages by wave.
_OPEN_WAVES = {"spark.sql.maxConcurrentOutputFileWriters": str(WAVES + 1)}


def _raw_feed(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """Orders as they come: first copies, second copies and further ones in three waves, with
    messages among the first that can't be read. The feed is given as it stands after each wave;
    a run that takes all it holds then takes one wave as its batch.

    Orders are scanned and their copies numbered once, and the messages of all waves written by
    that one job, each wave to a folder of its own.
    """
    raw = fx.raw_orders(spark, sf_dir)
    rest = [c for c in raw.columns if c not in FIRST and c != cleaning.ORDER_KEY]
    copies = W.partitionBy(cleaning.ORDER_KEY).orderBy(*FIRST, *rest)
    sent = raw.withColumn("wave", F.least(F.row_number().over(copies), F.lit(WAVES)))
    key = F.col(cleaning.ORDER_KEY)
    broken = F.concat(F.lit("{broken "), key)
    undated = F.concat(F.lit('{"order_line_id":'), key, F.lit(',"order_date":"31.02.2024"}'))

    def first(when: Column, text: Column) -> Column:
        return F.when(when, F.struct(F.lit(1).alias("wave"), text.alias("value")))

    messages = F.array_compact(
        F.array(
            F.struct("wave", feed.order_message().alias("value")),
            first(key % 89 == 3, broken),
            first(key % 97 == 5, undated),
        )
    )
    topic = scratch_path(spark, "feed")
    with usually(spark, RELEASE | _OPEN_WAVES):
        sent.select(F.inline(messages)).write.partitionBy("wave").options(**_FEED).text(topic)
    for wave in range(1, WAVES + 1):
        folder = f"{topic}/wave={wave}"
        if if_exists(lambda folder=folder: spark.read.text(folder)) is None:
            # no order has so many copies: the wave comes all the same, without messages
            spark.createDataFrame([], "value string").write.options(**_FEED).text(folder)
        arrived = f"{topic}/wave=[1-{wave}]"
        yield feed.decode_feed(
            read_order_stream(spark, "text", per_batch=ALL_FILES, path=arrived)
        )


def _loaded(spark, sf_dir) -> dict[str, str]:
    """The streaming load over three batches: where its outputs are."""
    out = {n: scratch_path(spark, n) for n in ("clean", "quarantine", "rejects", "offsets")}
    for messages in _raw_feed(spark, sf_dir):
        feed.load_order_stream(
            messages, out["clean"], out["quarantine"], out["offsets"], "7 days", out["rejects"]
        )
    return out


@query
def order_stream_clean(spark, sf_dir):
    return spark.read.parquet(_loaded(spark, sf_dir)["clean"]).select(*ORDERS.names)


@query
def order_stream_quarantine(spark, sf_dir):
    return spark.read.parquet(_loaded(spark, sf_dir)["quarantine"]).select(*ORDERS.names)


@query
def order_stream_rejects(spark, sf_dir):
    return spark.read.parquet(_loaded(spark, sf_dir)["rejects"]).drop("batch")


@query
def order_stream_numbered(spark, sf_dir):
    """Numbers over three batches; orders of a batch are numbered by their columns."""
    out, offsets = scratch_path(spark, "numbered"), scratch_path(spark, "offsets")
    for messages in _raw_feed(spark, sf_dir):
        numbering.number_stream(feed.readable(messages), out, offsets, ORDERS.names)
    return numbering.numbered_messages(spark, out)


@query
def order_stream_first_n(spark, sf_dir):
    """The first 20 messages, and what two further runs take from where the last one stopped."""
    out, offsets = scratch_path(spark, "taken"), scratch_path(spark, "offsets")
    sizes = (20, 480, 700)
    waves = [feed.readable(messages) for messages in _raw_feed(spark, sf_dir)]
    last = waves.pop()
    for stream in waves:  # a feed of few orders: its later waves are wanted too
        numbering.number_stream(stream, out, offsets, ORDERS.names)
        if numbering.numbered_messages(spark, out).limit(sum(sizes)).count() == sum(sizes):
            last = stream
            break
    runs = [
        numbering.consume_first(last, n, out, offsets, ORDERS.names).withColumn("run", F.lit(k))
        for k, n in enumerate(sizes)
    ]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


# ---- models


@query
def demand_forecast(spark, sf_dir):
    return boosted.demand_forecast(_features(spark, sf_dir), fx.DEMAND_KEYS)[1]


@query
def churn_scores(spark, sf_dir):
    return churn.churn_scores(
        segments.churn_features(fx.raw_orders(spark, sf_dir), AS_OF), AS_OF
    )[1]


@query
def churn_accuracy(spark, sf_dir):
    return churn.churn_scores(
        segments.churn_features(fx.raw_orders(spark, sf_dir), AS_OF), AS_OF
    )[2]


def _detected(spark, sf_dir):
    orders = fx.raw_orders(spark, sf_dir).select(*isolation.INPUTS)
    return isolation.detect_anomalies(orders)[1]


@query
def anomaly_orders(spark, sf_dir):
    return isolation.anomalies(_detected(spark, sf_dir))


@query
def anomaly_counts(spark, sf_dir):
    return segments.segment_counts(_detected(spark, sf_dir), "is_anomaly")


@query
def anomaly_sample(spark, sf_dir):
    """The five most isolated lines, in a total order."""
    found = isolation.anomalies(_detected(spark, sf_dir))
    rest = [c for c in found.columns if c != isolation.SCORE]
    return (
        found.orderBy(F.desc(isolation.SCORE), *rest).limit(5).select(*isolation.FEATURES)
    )
