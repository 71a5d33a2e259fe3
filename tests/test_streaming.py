import datetime as dt
import json
import os
from decimal import Decimal

import pytest

from helpers import DAY, ids, orders
from stockweave.operators import cleaning
from stockweave.sources.feeds import read_order_stream, topic_options, write_messages
from stockweave.streaming import orders as feed


def append(folder, *lines):
    folder.mkdir(exist_ok=True)
    number = len(list(folder.iterdir()))
    path = folder / f"part-{number}.txt"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1.7e9 + number, 1.7e9 + number))  # files are taken by age


def message(**changes):
    order = {
        "order_line_id": 1, "customer_id": 7, "product_id": 3, "warehouse_id": 2,
        "order_date": "2024-01-10", "ship_date": "2024-01-12", "delivery_date": "2024-01-15",
        "quantity": 4, "unit_price": 10.0, "discount_pct": 0.1, "total_amount": 36.0,
        "order_status": "Delivered", "shipping_cost": 5.0,
    }
    return json.dumps({**order, **changes})


def opened(spark, folder, **options):
    return feed.decode_orders(read_order_stream(spark, "text", path=str(folder), **options))


def test_round_trip(spark):
    df = orders(spark, {}, {"customer_id": None, "ship_date": None, "total_amount": Decimal("-0.05")})
    messages = feed.encode_orders(df)
    first = json.loads(messages.orderBy("key").first().value)
    assert first["order_date"] == "2024-01-10" and first["unit_price"] == 10.0
    assert json.loads(messages.orderBy("key").collect()[1].value)["customer_id"] is None
    assert sorted(map(repr, feed.decode_orders(messages).collect())) == sorted(map(repr, df.collect()))


def test_decode_skips_broken_messages(spark, tmp_path):
    append(tmp_path / "in", message(), "{broken", message(order_line_id=2, ship_date="soon"))
    out = str(tmp_path / "out")
    feed.drain(opened(spark, tmp_path / "in"), out, str(tmp_path / "offsets"))
    rows = spark.read.parquet(out).orderBy("order_line_id").collect()
    assert [(r.order_line_id, r.ship_date) for r in rows] == [(1, dt.date(2024, 1, 12)), (2, None)]
    assert rows[0].order_date == DAY and rows[0].total_amount == Decimal("36.00")


def test_restart_adds_nothing(spark, tmp_path):
    append(tmp_path / "in", message())
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    feed.drain(opened(spark, tmp_path / "in"), out, offsets)
    feed.drain(opened(spark, tmp_path / "in"), out, offsets)
    assert spark.read.parquet(out).count() == 1
    append(tmp_path / "in", message(order_line_id=2))
    feed.drain(opened(spark, tmp_path / "in"), out, offsets)
    assert ids(spark.read.parquet(out)) == [1, 2]


def test_clean_stream_drops_replays_in_and_across_batches(spark, tmp_path):
    folder, out, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")

    def run():
        feed.drain(feed.clean_order_stream(opened(spark, folder), "30 days"), out, offsets)

    append(folder, message(), message(), message(order_line_id=2, quantity=-1))
    run()
    append(folder, message(), message(order_line_id=3, customer_id=None), message(order_line_id=4))
    run()
    assert ids(spark.read.parquet(out)) == [1, 4]


def test_load_splits_the_stream(spark, tmp_path):
    folder = tmp_path / "in"
    clean, quarantine, offsets = (str(tmp_path / n) for n in ("clean", "quarantine", "offsets"))

    def run():
        feed.load_order_stream(opened(spark, folder), clean, quarantine, offsets)

    append(folder, message(), message(), message(order_line_id=2, customer_id=None))
    run()
    append(folder, message(), message(order_line_id=3), message(order_line_id=4, quantity=0))
    run()
    run()
    assert ids(spark.read.parquet(clean)) == [1, 3]
    assert ids(spark.read.parquet(quarantine)) == [2]


def test_old_orders_are_not_late(spark, tmp_path):
    folder, out, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")

    def run():
        feed.drain(feed.clean_order_stream(opened(spark, folder), "1 day"), out, offsets)

    append(folder, message(order_date="2024-06-01", delivery_date="2024-06-02"))
    run()
    append(folder, message(order_line_id=8, order_date="1994-01-01"), message(order_line_id=9))
    run()
    assert ids(spark.read.parquet(out)) == [1, 8, 9]


def test_every_message_ends_somewhere(spark, tmp_path):
    """Three batches of one file each; conflicting copies, dirty rows and unreadable messages."""
    folder = tmp_path / "in"
    names = ("clean", "quarantine", "rejects", "offsets")
    clean, quarantine, rejects, offsets = (str(tmp_path / n) for n in names)
    append(folder, message(), message(order_line_id=2, customer_id=None), "{broken", "{broken")
    append(folder, message(quantity=99), message(order_line_id=3, order_date="31.02.2024"), "[]")
    append(
        folder,
        message(order_line_id=4, order_date="1990-05-05", ship_date="soon"),
        message(order_line_id=5, quantity=0),
        message(order_line_id=2),
    )
    stream = feed.decode_feed(read_order_stream(spark, "text", per_batch=1, path=str(folder)))
    feed.load_order_stream(stream, clean, quarantine, offsets, "1 day", rejects)
    kept = spark.read.parquet(clean)
    assert ids(kept) == [1, 4] and ids(spark.read.parquet(quarantine)) == [2]
    assert kept.filter("order_line_id = 1").first().quantity == 4
    bad = spark.read.parquet(rejects)
    assert sorted(r.reason for r in bad.collect()) == ["bad_date", "malformed", "malformed", "malformed"]
    assert bad.filter("reason = 'bad_date'").first().message == message(
        order_line_id=3, order_date="31.02.2024"
    )
    rule_drops, duplicates, messages = 1, 2, 10
    stored = kept.count() + spark.read.parquet(quarantine).count() + bad.count()
    assert stored + rule_drops + duplicates == messages
    assert {r.batch for r in kept.select("batch").collect()} == {0, 2}


def test_rejects_need_a_place(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = feed.decode_feed(read_order_stream(spark, "text", path=str(tmp_path / "in")))
    with pytest.raises(ValueError, match="rejects"):
        feed.load_order_stream(stream, "a", "b", "c")


def test_scratch_copies_are_removed(spark):
    from stockweave import durable

    with pytest.raises(RuntimeError), durable.scratch_copy(spark.range(3), "gone") as copy:
        path = copy.inputFiles()[0].rsplit("/", 1)[0]
        assert copy.count() == 3
        raise RuntimeError
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="scratch"):
        durable.remove(spark, "/somewhere/else")


def test_stream_equals_batch(spark, small, tmp_path):
    from stockweave.plans import fixtures as fx

    lines = cleaning.dedupe_first(fx.raw_orders(spark, small), ["order_line_id"], fx.ORDER_TIEBREAK)
    write_messages(feed.encode_orders(lines), str(tmp_path / "in"), fmt="text")
    out = str(tmp_path / "out")
    stream = feed.clean_order_stream(opened(spark, tmp_path / "in", maxFilesPerTrigger="2"), "4000 days")
    feed.drain(stream, out, str(tmp_path / "offsets"))
    batch = cleaning.clean_orders(lines)[0]
    got = spark.read.parquet(out).select(batch.columns)
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_kafka_options():
    options = topic_options("broker:9092", failOnDataLoss="false")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "orders"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_order_stream(spark, "kafka", **topic_options("broker:9092"))
