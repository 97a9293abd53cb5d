"""Streaming ingest: change feed files -> foreachBatch landing -> latest live
rows equal the batch reading; restart and replay are idempotent."""

import datetime as dt
import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from mart_helpers import SF0001

from tidemart.operators.cdc import latest_live, latest_version
from tidemart.plans import marts as M
from tidemart.plans.landing import Landing
from tidemart.sources.changelog import po_change_log
from tidemart.sources.fixtures import Fixtures
from tidemart.sources.schemas import LANDING
from tidemart.sources.tables import TableSource
from tidemart.streaming.apply import change_feed, land_changes, read_landed, to_envelope

PO_KEY = LANDING["fact_po_raw"].sort_key


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _checkpoint(stream_id):
    """A folder like a stream's checkpoint, for calling a batch function directly."""
    path = tempfile.mkdtemp(prefix="ckpt-", dir="/tmp")
    with open(f"{path}/metadata", "w") as f:
        json.dump({"id": stream_id}, f)
    return path


def _write_batches(log, feed_dir, batches):
    for b in batches:
        (to_envelope(log.filter(F.col("_batch") == b).drop("_batch"), "fact_po_raw")
         .coalesce(1).write.mode("append").parquet(feed_dir))


def test_stream_lands_change_log_idempotently(spark):
    fx = Fixtures(TableSource(spark, SF0001))
    log = po_change_log(fx, with_batch=True).cache()
    base = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    feed, root, ckpt = f"{base}/feed", f"{base}/landing", f"{base}/ckpt"
    # arrival batches 3, 1, 0, 2: tombstones may land before what they delete
    _write_batches(log, feed, [3, 1])
    land_changes(change_feed(spark, feed, max_files_per_trigger=1), root, ckpt,
                 ["fact_po_raw", "fact_rfq_raw"]).awaitTermination()
    _write_batches(log, feed, [0, 2])
    # restart on the same checkpoint: only the new files are read
    land_changes(change_feed(spark, feed, max_files_per_trigger=1), root, ckpt, ["fact_po_raw"]).awaitTermination()
    landed = read_landed(spark, root, "fact_po_raw").drop("month")
    assert landed.count() == log.count()
    expected = latest_live(log.drop("_batch"), PO_KEY)
    assert _rows(latest_live(landed, PO_KEY)) == _rows(expected)
    # a replayed batch (duplicate delivery) changes nothing once versions resolve
    _write_batches(log, feed, [1])
    land_changes(change_feed(spark, feed), root, ckpt, ["fact_po_raw"]).awaitTermination()
    landed = read_landed(spark, root, "fact_po_raw").drop("month")
    assert landed.count() > log.count()
    assert _rows(latest_live(landed, PO_KEY)) == _rows(expected)
    log.unpersist()


def test_marts_over_streamed_landing_equal_batch(spark, landing_small):
    base = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    feed, root, ckpt = f"{base}/feed", f"{base}/landing", f"{base}/ckpt"
    tables = ["fact_po_raw", "dim_organization_raw"]
    for t in tables:
        to_envelope(landing_small.raw(t), t).write.mode("append").parquet(feed)
    land_changes(change_feed(spark, feed), root, ckpt, tables).awaitTermination()
    streamed = Landing(lambda t: read_landed(spark, root, t))
    as_of = dt.date(2001, 8, 1)
    assert _rows(M.daily_revenue_territory(streamed, as_of)) == _rows(M.daily_revenue_territory(landing_small, as_of))


def test_processing_time_trigger_keeps_landing(spark, landing_small):
    base = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    feed, root = f"{base}/feed", f"{base}/landing"
    po = landing_small.raw("fact_po_raw")
    to_envelope(po.filter("id % 2 = 0"), "fact_po_raw").write.mode("append").parquet(feed)
    q = land_changes(change_feed(spark, feed), root, None, ["fact_po_raw"],
                     processing_time="1 second", name=f"pt-{base.rsplit('-', 1)[-1]}")
    try:
        q.processAllAvailable()
        to_envelope(po.filter("id % 2 = 1"), "fact_po_raw").write.mode("append").parquet(feed)
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_landed(spark, root, "fact_po_raw").count() == po.count()


def test_upsert_into_current_state(spark):
    from tidemart.streaming.apply import read_state, upsert_changes
    fx = Fixtures(TableSource(spark, SF0001))
    log = po_change_log(fx, with_batch=True).cache()
    base = tempfile.mkdtemp(prefix="upsert-", dir="/tmp")
    feed, state, ckpt = f"{base}/feed", f"{base}/state", f"{base}/ckpt"
    for order in ([2, 0], [3, 1]):
        _write_batches(log, feed, order)
        upsert_changes(change_feed(spark, feed, max_files_per_trigger=1), state, "fact_po_raw", ckpt).awaitTermination()
    cur = read_state(spark, state, "fact_po_raw")
    cols = [f.name for f in LANDING["fact_po_raw"].schema.fields]
    assert _rows(cur.select(*cols)) == _rows(latest_version(log.drop("_batch"), PO_KEY).select(*cols))
    assert _rows(cur.filter("_cdc_is_deleted = 0").select(*cols)) == _rows(latest_live(log.drop("_batch"), PO_KEY).select(*cols))
    log.unpersist()


def test_pipeline_feed_to_marts_equals_batch(spark, landing_small):
    from tidemart.plans import refresh as R
    from tidemart.streaming.pipeline import start_pipeline
    base = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    feed, land, marts = f"{base}/feed", f"{base}/landing", f"{base}/marts"
    tables = ["fact_po_raw", "fact_po_item_raw", "dim_organization_raw"]
    for t in tables:
        to_envelope(landing_small.raw(t), t).write.mode("append").parquet(feed)
    as_of = dt.date(2001, 8, 1)
    start_pipeline(change_feed(spark, feed), land, marts, tables, lambda: as_of, group="agg",
                   checkpoint=f"{base}/ckpt", refresh_every=0).awaitTermination()
    batch_root = f"{base}/batch"
    for name in ["agg_daily_category_spend", "agg_daily_revenue_territory"]:
        R.refresh_mart(spark, landing_small, name, as_of, batch_root)
        got = R.read_mart(spark, marts, name).drop("_etl_loaded_at")
        want = R.read_mart(spark, batch_root, name).drop("_etl_loaded_at")
        assert _rows(got.select(*want.columns)) == _rows(want)


def test_cli_land_then_compact(spark):
    from tidemart.cli import main
    fx = Fixtures(TableSource(spark, SF0001))
    log = po_change_log(fx, with_batch=True)
    base = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    _write_batches(log, f"{base}/feed", [0, 1, 2, 3])
    assert main(["land", "--feed", f"{base}/feed", "--landing", f"{base}/landing", "--tables", "fact_po_raw",
                 "--checkpoint", f"{base}/ckpt"], spark=spark) == 0
    assert main(["compact", "--landing", f"{base}/landing", "--out", f"{base}/compact/fact_po_raw",
                 "--table", "fact_po_raw"], spark=spark) == 0
    compacted = spark.read.parquet(f"{base}/compact/fact_po_raw").drop("month")
    cols = [f.name for f in LANDING["fact_po_raw"].schema.fields]
    assert _rows(latest_live(compacted, PO_KEY).select(*cols)) == \
        _rows(latest_live(log.drop("_batch"), PO_KEY).select(*cols))


def test_upsert_replayed_batch_id_is_idempotent(spark):
    from tidemart.streaming.apply import read_state, upsert_writer
    fx = Fixtures(TableSource(spark, SF0001))
    log = po_change_log(fx, with_batch=True)
    env = {b: to_envelope(log.filter(F.col("_batch") == b).drop("_batch"), "fact_po_raw") for b in range(4)}
    state = tempfile.mkdtemp(prefix="upsert-", dir="/tmp") + "/state"
    ckpt = _checkpoint("u")
    write = upsert_writer(state, "fact_po_raw", ckpt)
    for b in range(4):
        write(env[b], b)
    once = _rows(read_state(spark, state, "fact_po_raw"))
    write(env[3], 3)            # the last batch delivered again under the same id
    write(env[2], 2)            # an earlier one too: its versions lose or tie
    write(env[3], 3)
    assert _rows(read_state(spark, state, "fact_po_raw")) == once
    cols = [f.name for f in LANDING["fact_po_raw"].schema.fields]
    assert once == _rows(latest_version(log.drop("_batch"), PO_KEY).select(*cols))


def _envelope(spark, rows):
    from tidemart.streaming.apply import ENVELOPE
    at = dt.datetime(2024, 2, 1)
    return spark.createDataFrame([(t, v, 0, at, p) for t, v, p in rows], ENVELOPE)


def test_two_feeds_and_a_lost_checkpoint_erase_nothing(spark):
    from tidemart.streaming.apply import batch_writer
    root = tempfile.mkdtemp(prefix="land-", dir="/tmp") + "/landing"
    one, two, new = (_checkpoint(x) for x in ("one", "two", "new"))
    row = lambda i: _envelope(spark, [("fact_po_raw", 1, json.dumps({"id": i, "buyer_org_id": 2, "po_date": "2001-05-06T00:00:00"}))])
    batch_writer(root, ["fact_po_raw", "fact_rfq_raw"], "a", one)(row(1), 0)
    batch_writer(root, ["fact_po_raw"], "b", two)(row(2), 0)
    batch_writer(root, ["fact_po_raw"], "a", one)(row(1), 0)      # a restart replays its batch
    batch_writer(root, ["fact_po_raw"], "a", new)(row(3), 0)      # its checkpoint was lost and the feed trimmed
    landed = read_landed(spark, root, "fact_po_raw")
    assert sorted(r["id"] for r in landed.collect()) == [1, 2, 3]
    assert {r["month"] for r in landed.collect()} == {200105}
    assert read_landed(spark, root, "fact_rfq_raw").count() == 0
    assert not os.path.exists(f"{root}/fact_rfq_raw")             # no folder for a table without records


def test_malformed_and_unlisted_records_are_kept_aside(spark):
    from tidemart.streaming.apply import TooManyRejects, batch_writer, read_rejected
    root = tempfile.mkdtemp(prefix="land-", dir="/tmp") + "/landing"
    batch = _envelope(spark, [("fact_po_raw", 1, "{broken"), ("fact_po_raw", 1, '{"id":"abc"}'), ("other", 1, "{}"),
                              ("fact_po_raw", 1, "null"), ("fact_po_raw", 1, '{"id":7,"status":null}')])
    batch_writer(root, ["fact_po_raw"], "s", _checkpoint("s"), max_malformed=0.9)(batch, 0)
    assert [(r["id"], r["status"]) for r in read_landed(spark, root, "fact_po_raw").collect()] == [(7, 0)]
    got = sorted((r["reason"], r["payload"]) for r in read_rejected(spark, root).collect())
    assert got == [("malformed payload", "null"), ("malformed payload", '{"id":"abc"}'), ("malformed payload", "{broken"),
                   ("unlisted table", "{}")]
    with pytest.raises(TooManyRejects):
        batch_writer(root, ["fact_po_raw"], "s", _checkpoint("t"))(batch, 0)


def test_upsert_survives_a_crash_before_commit(spark):
    from tidemart.streaming.apply import read_state, upsert_writer
    state, ckpt = tempfile.mkdtemp(prefix="upsert-", dir="/tmp") + "/state", _checkpoint("c")
    write = upsert_writer(state, "fact_po_raw", ckpt)
    row = lambda i, v: ("fact_po_raw", v, json.dumps({"id": i, "buyer_org_id": 2, "po_date": "2001-05-06T00:00:00"}))
    write(_envelope(spark, [row(1, 1), row(2, 1)]), 0)
    os.makedirs(f"{state}/gen-000000001-c-1")                     # a generation that was never committed
    assert read_state(spark, state, "fact_po_raw").count() == 2
    write(_envelope(spark, [row(2, 2)]), 1)
    got = {r["id"]: r["_cdc_version"] for r in read_state(spark, state, "fact_po_raw").collect()}
    assert got == {1: 1, 2: 2}
    for b in range(2, 6):
        write(_envelope(spark, [row(2, b + 1)]), b)
    assert len([n for n in os.listdir(state) if n.startswith("gen-")]) <= 3
    upsert_writer(state, "fact_po_raw", _checkpoint("lost"))(_envelope(spark, [row(3, 1)]), 0)
    assert sorted(r["id"] for r in read_state(spark, state, "fact_po_raw").collect()) == [1, 2, 3]


def test_pipeline_raises_when_a_mart_fails(spark, landing_small, monkeypatch):
    from tidemart.plans import refresh as R
    from tidemart.streaming.pipeline import start_pipeline
    base = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    to_envelope(landing_small.raw("fact_po_raw"), "fact_po_raw").write.parquet(f"{base}/feed")

    def broken(*args, **kwargs):
        raise ValueError("no mart today")
    monkeypatch.setattr(R, "refresh_mart", broken)
    q = start_pipeline(change_feed(spark, f"{base}/feed"), f"{base}/land", f"{base}/marts", ["fact_po_raw"],
                       lambda: dt.date(2001, 8, 1), checkpoint=f"{base}/ckpt")
    with pytest.raises(Exception, match="no mart today"):
        q.awaitTermination()


def _marts_equal_batch(spark, landing, marts, batch_root, as_of):
    from tidemart.plans import refresh as R
    for name in ["agg_daily_category_spend", "agg_daily_revenue_territory"]:
        R.refresh_mart(spark, landing, name, as_of, batch_root)
        want = R.read_mart(spark, batch_root, name).drop("_etl_loaded_at")
        got = R.read_mart(spark, marts, name).select(*want.columns)
        if _rows(got) != _rows(want):
            return False
    return True


def _backlog(landing, feed):
    """The change records of three tables, POs in three files: a feed of several batches."""
    tables = ["fact_po_item_raw", "dim_organization_raw", "fact_po_raw"]
    for t in tables:
        to_envelope(landing.raw(t), t).repartition(3 if t == "fact_po_raw" else 1).write.mode("append").parquet(feed)
    return tables


def _some_marts(monkeypatch):
    from tidemart.plans import refresh as R
    monkeypatch.setitem(R.GROUPS, "agg", ["agg_daily_category_spend", "agg_daily_revenue_territory"])


def test_pipeline_backlog_of_several_batches_reaches_the_marts(spark, landing_small, monkeypatch):
    from tidemart.streaming.pipeline import start_pipeline
    _some_marts(monkeypatch)
    base = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    tables, as_of = _backlog(landing_small, f"{base}/feed"), dt.date(2001, 8, 1)
    q = start_pipeline(change_feed(spark, f"{base}/feed", 1), f"{base}/land", f"{base}/marts", tables, lambda: as_of,
                       group="agg", checkpoint=f"{base}/ckpt")
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 4 and not q.isActive
    assert _marts_equal_batch(spark, landing_small, f"{base}/marts", f"{base}/batch", as_of)


def test_pipeline_timer_refreshes_without_a_further_batch(spark, landing_small, monkeypatch):
    import time
    from tidemart.plans import refresh as R
    from tidemart.streaming.pipeline import start_pipeline
    _some_marts(monkeypatch)
    passes, run = [], R.run
    monkeypatch.setattr(R, "run", lambda *a, **k: (run(*a, **k), passes.append(1))[0])
    base = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    tables, as_of = _backlog(landing_small, f"{base}/feed"), dt.date(2001, 8, 1)
    q = start_pipeline(change_feed(spark, f"{base}/feed", 1), f"{base}/land", f"{base}/marts", tables, lambda: as_of,
                       group="agg", checkpoint=f"{base}/ckpt", processing_time="1 second", refresh_every=25)
    try:
        q.processAllAvailable()
        end = time.monotonic() + 90
        while time.monotonic() < end and not (os.path.exists(f"{base}/marts") and len(passes) > 1):
            time.sleep(1)
        assert len(passes) > 1
        assert _marts_equal_batch(spark, landing_small, f"{base}/marts", f"{base}/batch", as_of)
    finally:
        q.stop()
