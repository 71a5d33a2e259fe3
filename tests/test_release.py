"""What a job shuffled doesn't stay on disk while the jobs after it run."""

import time

from stockweave.durable import RELEASE, durable
from stockweave.session import usually
from stockweave.sources.sinks import Warehouse, write_csv

CLEANUP = next(iter(RELEASE))


def _shuffles(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def _left(spark, before):
    for _ in range(50):  # files are removed beside the job
        left = _shuffles(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    before = _shuffles(spark)
    rows = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    kept = [rows, durable(rows, "release"), write_csv(rows, f"{tmp_path}/csv")]
    Warehouse(location=str(tmp_path)).replace(rows, "rows")
    assert not _left(spark, before)
    assert kept[1].count() == rows.count() == spark.read.parquet(f"{tmp_path}/rows").count() == 7


def test_settings_of_the_session_stay(spark):
    spark.conf.set(CLEANUP, "false")
    try:
        with usually(spark, RELEASE):
            assert spark.conf.get(CLEANUP) == "false"
        assert spark.conf.get(CLEANUP) == "false"
    finally:
        spark.conf.unset(CLEANUP)
    with usually(spark, RELEASE):
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP, None) is None


def test_the_warehouse_of_the_load_is_zstandard(spark, small):
    from stockweave.plans import queries

    scores = queries.queries()["load_churn_scores"](spark, small)
    assert scores.count() > 0 and all(f.endswith(".zstd.parquet") for f in scores.inputFiles())
