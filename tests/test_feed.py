"""The registered stream queries over rows of their own: what a feed holds and what it takes."""

import glob
import os

import pytest

from stockweave.plans import queries
from stockweave.streaming import orders as feed

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
)
HEADS = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date"


def tables(spark, folder, lines, heads=200):
    """`lines` are (order, part) pairs; a pair's line number is 1, so an order repeated is a copy."""
    spark.createDataFrame(
        [(o, p, 1, 1, 4.0, 100.0, 0.05, 0.02, "N") for o, p in lines], LINES
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(1, heads + 1).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "DATE '1999-01-02' AS o_orderdate"
    ).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def stored(spark):
    return set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir').removeprefix('file:')}/feed-*"))


def size(folders):
    return sum(
        os.path.getsize(f) for d in folders for f in glob.glob(f"{d}/**/part-*", recursive=True)
    )


@pytest.mark.parametrize("name", ["order_stream", "order_stream_clean"])
def test_feed_is_small_and_split_into_files(spark, small, name):
    before = stored(spark)
    found = queries.queries()[name](spark, small)
    assert found.count() > 4000
    assert size(stored(spark) - before) < 6000 * 100  # nearly 300 bytes each as they are


def test_a_feed_without_copies_has_empty_waves(spark, tmp_path):
    data = tables(spark, tmp_path / "in", [(o, 7) for o in range(1, 61)])
    found = queries.queries()
    numbered = found["order_stream_numbered"](spark, data)
    assert sorted(r.message_number for r in numbered.collect()) == list(range(1, 61))
    assert found["order_stream_clean"](spark, data).count() == 59  # one has a negative total
    runs = found["order_stream_first_n"](spark, data).groupBy("run").count().collect()
    assert sorted(map(tuple, runs)) == [(0, 20), (1, 40)]


def test_runs_go_on_through_the_waves(spark, tmp_path):
    lines = [(o, p) for o in range(1, 9) for p in (7, 8, 9, 10)]
    data = tables(spark, tmp_path / "in", lines)
    taken = queries.queries()["order_stream_first_n"](spark, data).collect()
    by_number = {r.message_number: (r.product_id, r.run) for r in taken}
    assert sorted(by_number) == list(range(1, 33))
    assert [by_number[n][0] for n in range(1, 17)] == [7] * 8 + [8] * 8
    assert by_number[20][1] == 0 and by_number[21][1] == 1


def test_a_feed_without_orders(spark, tmp_path):
    data = tables(spark, tmp_path / "in", [(999, 7)])  # a line of no order
    found = queries.queries()
    for name in ("order_stream_clean", "order_stream_numbered", "order_stream_first_n"):
        assert found[name](spark, data).count() == 0


def test_a_load_keeps_text_of_unreadable_messages_only(spark, tmp_path, monkeypatch):
    """Readable messages aren't moved and stored a second time beside their columns."""
    seen = []

    def looked(batch, label):
        seen.append(batch.filter("unreadable IS NULL AND message IS NOT NULL").count())
        return kept(batch, label)

    kept = feed.scratch_copy
    monkeypatch.setattr(feed, "scratch_copy", looked)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"order_line_id": 1, "customer_id": 2}\n{broken\n')
    stream = spark.readStream.text(str(tmp_path / "in"))
    out = {n: str(tmp_path / n) for n in ("clean", "quarantine", "offsets", "rejects")}
    feed.load_order_stream(
        feed.decode_feed(stream), out["clean"], out["quarantine"], out["offsets"],
        rejected_to=out["rejects"],
    )
    assert seen and set(seen) == {0}
    assert [r.message for r in spark.read.parquet(out["rejects"]).collect()] == ["{broken"]
