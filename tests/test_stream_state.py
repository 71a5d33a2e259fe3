"""Where the state of a stream lies, and how the waves of a feed are written."""

import glob
import json

import pytest

from stockweave.plans import queries
from stockweave.streaming import orders as feed


@pytest.fixture
def plain(spark):
    """The session as Spark makes it, without the package's own choice of a state store."""
    before = {k: spark.conf.get(k, None) for k in feed.STATE}
    for k in before:
        spark.conf.unset(k)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _load(spark, folder):
    stream = feed.decode_feed(spark.readStream.text(str(folder / "in")))
    out = {n: str(folder / n) for n in ("clean", "quarantine", "offsets", "rejects")}
    return out, feed.load_order_stream(
        stream, out["clean"], out["quarantine"], out["offsets"], "7 days", out["rejects"]
    )


def _message(key, customer=2):
    return json.dumps({"order_line_id": key, "customer_id": customer, "quantity": 1, "total_amount": 3})


def test_state_lies_on_disk_in_any_session(plain, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([_message(1), _message(1), _message(2, None), "{"]))
    out, first = _load(plain, tmp_path)
    (tmp_path / "in" / "b.txt").write_text("\n".join([_message(2), _message(3)]))
    second = _load(plain, tmp_path)[1]
    for run in (first, second):
        assert any("rocksdbPutCount" in p.stateOperators[0].customMetrics for p in run.recentProgress)
    assert glob.glob(f"{out['offsets']}/state/0/0/**/*.zip", recursive=True)
    assert sorted(r.order_line_id for r in plain.read.parquet(out["clean"]).collect()) == [1, 3]
    assert plain.read.parquet(out["quarantine"]).count() == 1
    assert plain.read.parquet(out["rejects"]).count() == 1
    assert all(plain.conf.get(k, None) is None for k in feed.STATE)


def test_waves_are_written_side_by_side(spark, small, monkeypatch):
    """With fewer files open than there are waves, a task sorts its messages by wave."""
    writers, seen = "spark.sql.maxConcurrentOutputFileWriters", []

    def looked(session, settings):
        seen.append(settings)
        return kept(session, settings)

    kept = queries.usually
    monkeypatch.setattr(queries, "usually", looked)
    assert next(queries._raw_feed(spark, small)).isStreaming
    assert [int(s[writers]) > queries.WAVES for s in seen] == [True]
    assert spark.conf.get(writers, None) is None
