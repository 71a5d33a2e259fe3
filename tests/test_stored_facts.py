"""Jobs that read the facts several times join orders and lines once."""

import glob
import gzip

from helpers import customers, orders, products, warehouses
from stockweave.operators import reports
from stockweave.plans import queries, stored
from stockweave.sources.sinks import write_csv, write_layer


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_extracts_read_stored_facts(spark, small):
    tables, out = stored._extracts(spark, small)
    for name in ("fact_orders", "fact_inventory"):
        assert not any("lineitem" in f for f in tables[name].inputFiles())
    text = glob.glob(f"{out.removeprefix('file:')}/executive_overview/part-*")
    assert text and all(f.endswith(".csv.gz") for f in text)
    found = queries.queries()["export_executive_overview"](spark, small)
    assert found.count() == queries.queries()["executive_overview"](spark, small).count()


def test_a_stored_model_scores_stored_features(spark, small):
    pairs = queries.queries()["stored_model"](spark, small)
    assert not any("lineitem" in f for f in pairs.inputFiles())
    assert [r.changed for r in pairs.collect()] == [0]


def test_text_of_products_joins_last(spark):
    found = reports.executive_overview(
        orders(spark, {}), products(spark, {"product_id": 3}),
        warehouses(spark, {"warehouse_id": 2}), customers(spark, {"customer_id": 7}),
    )
    joins = [line for line in _plan(found).splitlines() if "Join Inner" in line]
    assert ["product_id" in joins[0], "customer_id" in joins[-1]] == [True, True]
    assert found.count() == 1


def test_csv_is_plain_unless_told(spark, tmp_path):
    rows = spark.range(5).selectExpr("id", "'a \"b\", c' AS text")
    write_csv(rows, f"{tmp_path}/plain")
    write_csv(rows, f"{tmp_path}/packed", "gzip")
    packed = "".join(gzip.open(f, "rt").read() for f in glob.glob(f"{tmp_path}/packed/part-*.csv.gz"))
    assert packed.count('a ""b"", c') == 5
    assert glob.glob(f"{tmp_path}/plain/part-*.csv")


def test_layers_are_compressed_with_zstandard(spark, tmp_path):
    path = write_layer(spark.range(5).toDF("id"), str(tmp_path), "bronze", "numbers")
    assert glob.glob(f"{path}/*.zstd.parquet") and spark.read.parquet(path).count() == 5
