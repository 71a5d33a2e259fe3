import numpy as np
import pytest

from stockweave.learning.boosting import BoostedTrees, train_boosted

FEATURES = ("a", "b", "c")


def table(n=900, seed=1):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 30, n).astype(float)
    b = np.round(rng.normal(size=n), 1)
    c = rng.integers(0, 4, n).astype(float)
    y = np.rint(10 * a + 25 * (b > 0.3) * c + rng.normal(size=n) * 5)
    b[rng.random(n) < 0.15] = np.nan
    return np.stack([a, b, c]), y


def frame(spark, x, y):
    rows = [
        (*(None if np.isnan(v) else float(v) for v in row), float(t)) for row, t in zip(x.T, y)
    ]
    return spark.createDataFrame(rows, "a double, b double, c double, y double")


def plain_booster(x, y, rounds, depth, rate, l2=1.0):
    """Row by row, every cut of every feature, no bins and no histograms."""
    prediction = np.full(len(y), y.mean())

    def grow(rows, level):
        g, h = (prediction - y)[rows].sum(), float(len(rows))
        best = (1e-6, None)
        if level < depth:
            for f in range(len(x)):
                v = x[f, rows]
                gone = np.isnan(v)
                for cut in np.unique(x[f][~np.isnan(x[f])])[1:]:
                    for to_left in (False, True) if gone.any() else (False,):
                        left = np.where(gone, to_left, v < cut)
                        hl = float(left.sum())
                        if hl < 1 or h - hl < 1:
                            continue
                        gl = (prediction - y)[rows][left].sum()
                        gain = gl**2 / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g**2 / (h + l2)
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
        if best[1] is None:
            return [(rows, -rate * g / (h + l2))]
        return grow(rows[best[1]], level + 1) + grow(rows[~best[1]], level + 1)

    for _ in range(rounds):
        step = np.zeros(len(y))
        for rows, value in grow(np.arange(len(y)), 0):
            step[rows] = value
        prediction = prediction + step
    return prediction


def predictions(df):
    return np.array([r[0] for r in df.select("prediction").collect()])


@pytest.fixture(scope="module")
def trained(spark):
    x, y = table()
    df = frame(spark, x, y)
    return x, y, df, train_boosted(df, FEATURES, "y", rounds=6, max_depth=3, learning_rate=0.4)


def test_predictions_equal_those_of_a_plain_booster(trained):
    x, y, df, model = trained
    expected = plain_booster(x, y, 6, 3, 0.4)
    assert np.abs(predictions(model.transform(df)) - expected).max() < 1e-6
    assert np.abs(expected - y).mean() < 0.35 * np.abs(y - y.mean()).mean()


def test_trees_do_not_depend_on_partitions_or_blocks(trained):
    _, _, df, model = trained
    settings = dict(rounds=6, max_depth=3, learning_rate=0.4)
    for other in (
        train_boosted(df.repartition(7), FEATURES, "y", block_rows=100, **settings),
        train_boosted(df.orderBy("y"), FEATURES, "y", block_rows=1 << 14, **settings),
    ):
        for mine, theirs in zip(model.trees, other.trees, strict=True):
            assert (mine.feature == theirs.feature).all() and (mine.cut == theirs.cut).all()
            assert (mine.left == theirs.left).all() and (mine.value == theirs.value).all()


def test_saved_model_predicts_the_same(spark, trained, tmp_path):
    _, _, df, model = trained
    model.save(str(tmp_path / "model"), spark)
    again = BoostedTrees.load(spark, str(tmp_path / "model"))
    assert again.features == model.features and again.base == model.base
    assert (predictions(again.transform(df)) == predictions(model.transform(df))).all()


def test_level_pushes_sums_not_rows(spark, trained):
    from stockweave.learning import boosting
    from stockweave.learning.histograms import Tree

    df = spark.createDataFrame([(b"\x00\x01", b"", b"")], "bins binary, target binary, margin binary")
    seen = {}
    original = boosting.F.sum
    try:
        boosting.F.sum = lambda c: seen.setdefault(c, original(c))
        empty = boosting._level(df.limit(0), [], Tree.empty(2), 0, 2, 1.0)
    finally:
        boosting.F.sum = original
    assert set(seen) == {"gradient", "hessian"} and empty.num_rows == 0


def test_degenerate_tables(spark):
    schema = "a double, b double, c double, y double"
    empty = spark.createDataFrame([], schema)
    assert train_boosted(empty, FEATURES, "y", rounds=2).trees == []
    same = spark.createDataFrame([(1.0, None, 2.0, 7.0)] * 5 + [(1.0, None, 2.0, None)], schema)
    model = train_boosted(same, FEATURES, "y", rounds=2)
    assert set(predictions(model.transform(same))) == {7.0}
