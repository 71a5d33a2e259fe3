import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import orders

from stockweave.learning import isolation as iso
from stockweave.learning.churn import FEATURES, churn_scores, complete_features
from stockweave.learning.demand import demand_forecast
from stockweave.operators.demand import demand_features
from stockweave.plans import fixtures as fx


def walk(x, feature, cut, path):
    node = 0
    while node < len(feature):
        node = 2 * node + 1 + int(x[feature[node]] > cut[node])
    return path[node - len(feature)]


def test_arrays_equal_a_row_by_row_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    x[:, 3] = 1.0  # a constant feature is never split
    trees = [iso.grow_tree(x[rng.choice(500, 64)], 6, np.random.default_rng([1, i])) for i in range(7)]
    feature, cut, path = (np.array([t[k] for t in trees]) for k in range(3))
    assert not (np.isfinite(cut) & (feature == 3)).any()
    want = [np.mean([walk(row, *t) for t in trees]) for row in x]
    assert np.allclose(iso.path_lengths(x, feature, cut, path, block=37), want)


def test_mean_path():
    assert [iso.mean_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert abs(iso.mean_path(256) - 10.2448) < 1e-3


@pytest.fixture(scope="module")
def lines(spark):
    rng = np.random.default_rng(0)
    rows = [(i, *map(float, rng.normal(100, 5, 5))) for i in range(1000)]
    rows.append((1000, 9999.0, 9999.0, -9999.0, 9999.0, 9999.0))
    return spark.createDataFrame(rows, ["order_line_id", *iso.FEATURES]).repartition(3)


def test_outlier_is_flagged_and_share_is_kept(spark, lines, tmp_path):
    forest, found = iso.detect_anomalies(lines, trees=40)
    flagged = {r.order_line_id for r in iso.anomalies(found).collect()}
    assert 1000 in flagged and len(flagged) == 50  # of 1001, above the 951st
    top = found.orderBy(found[iso.SCORE].desc()).first()
    assert top.order_line_id == 1000 and top.anomaly_score == -1
    forest.save(str(tmp_path / "forest"))
    again = iso.IsolationForest.load(spark, str(tmp_path / "forest")).score(lines)
    assert {r[0]: r[1] for r in again.select("order_line_id", iso.SCORE).collect()} == {
        r[0]: r[1] for r in found.select("order_line_id", iso.SCORE).collect()
    }


def test_copies_do_not_swamp_the_sample(spark, lines):
    one = tuple(lines.first())
    copies = spark.createDataFrame([one] * 3000, lines.schema)
    forest = iso.fit_forest(lines.unionByName(copies), trees=5, sample_size=64)
    assert forest.trees.count() == 5 and forest.sample_size == 64


def test_sample_depends_on_the_rows_alone(spark, lines):
    def flags(df):
        found = iso.detect_anomalies(df, trees=8, sample_size=32)[1]
        return {tuple(r) for r in found.drop(iso.SCORE).collect()}

    assert flags(lines) == flags(lines.repartition(7)) == flags(lines.orderBy("order_line_id"))


def test_saved_forest_knows_its_features(spark, lines, tmp_path):
    forest = iso.fit_forest(lines, ("quantity", "unit_price"), trees=4, sample_size=16)
    forest.save(str(tmp_path / "forest"))
    again = iso.IsolationForest.load(spark, str(tmp_path / "forest"))
    assert (again.features, again.sample_size) == (("quantity", "unit_price"), forest.sample_size)


def test_tiny_and_empty_inputs(spark, lines):
    assert iso.detect_anomalies(lines.limit(3), trees=5)[1].count() == 3
    assert iso.detect_anomalies(lines.limit(0), trees=5)[1].count() == 0
    one = iso.detect_anomalies(lines.limit(1), trees=5)[1]
    assert [r.is_anomaly for r in one.collect()] == [0]
    unknown = lines.limit(2).withColumn("quantity", F.lit(None).cast("double"))
    assert {r.is_anomaly for r in iso.detect_anomalies(unknown, trees=5)[1].collect()} == {0}


def test_churn_model(spark, small):
    from stockweave.operators.segments import churn_features

    features = churn_features(fx.raw_orders(spark, small), fx.AS_OF)
    unknown = {c: F.lit(None).cast(features.schema[c].dataType) for c in ("monetary", "avg_order_value")}
    hollow = features.limit(1).withColumns({"customer_id": F.lit(10**9).cast("long"), **unknown})
    features = features.unionByName(hollow)
    filled, counts = complete_features(features)
    assert counts.first().monetary == 1 and filled.filter("monetary IS NULL").count() == 0
    assert "recency_days" not in FEATURES
    _, scores, hit = churn_scores(features, fx.AS_OF, num_trees=10, max_depth=4)
    assert scores.count() == features.count()
    assert scores.filter("churn_probability NOT BETWEEN 0 AND 1").count() == 0
    assert hit.first().row_count > 0


def test_demand_model_beats_the_mean(spark):
    rows = [
        {"product_id": p, "order_date": dt.date(2020 + y, m, 3), "quantity": 40 * p + 3 * m}
        for p in range(1, 9) for y in range(3) for m in range(1, 13)
    ]
    features = demand_features(orders(spark, *rows))
    _, forecasts, error = demand_forecast(features, max_iter=8, step_size=0.5)
    row = error.first()
    assert forecasts.count() == row.row_count > 0
    actual = [r[0] for r in features.select("total_quantity").collect()]
    mean = sum(actual) / len(actual)
    assert row.mae < 0.2 * sum(abs(a - mean) for a in actual) / len(actual)
    assert row.passed and row.mape < 50
