"""Upsert through the state store: equals the newest versions of the log, writes what a batch moves forward."""

import tempfile

from tidemart.operators.cdc import latest_version
from tidemart.plans.store import LandingStore
from tidemart.sources.rows import landing_rows
from tidemart.sources.schemas import LANDING
from tidemart.streaming.apply import change_feed, to_envelope
from tidemart.streaming.state import newer_records, upsert_stream

PO = LANDING["fact_po_raw"]
COLUMNS = [f.name for f in PO.schema.fields]


def _po(i, version, deleted=0, day="2001-06-01"):
    return {"id": i, "buyer_org_id": 1, "supplier_org_id": 7, "status": version, "total_amount": f"{i}.25", "po_date": f"{day} 00:00:00",
            "_cdc_version": version, "_cdc_is_deleted": deleted}


def _rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_upsert_by_state(spark):
    base = tempfile.mkdtemp(prefix="state-", dir="/tmp")
    store = LandingStore(spark, f"{base}/landing")
    runs = [
        [_po(1, 1), _po(2, 1), _po(2, 2), _po(3, 5, 1), _po(4, 2)],   # newest of several versions in a batch
        [_po(1, 1), _po(2, 1), _po(3, 4), _po(4, 3, 1), _po(5, 1)],   # a replay, late versions (one of a deleted key), news
        [_po(4, 2), _po(3, 6), _po(1, 1)],                            # back after its deletion
    ]
    written = []
    for rows in runs:
        to_envelope(landing_rows(spark, "fact_po_raw", rows), "fact_po_raw").coalesce(1).write.mode("append").parquet(f"{base}/feed")
        upsert_stream(change_feed(spark, f"{base}/feed"), store, "fact_po_raw", f"{base}/ckpt").awaitTermination()
        written.append(store.landing().raw("fact_po_raw").count())
    assert written == [4, 6, 7]  # only keys that moved forward: 4, then 4 and 5, then 3
    log = landing_rows(spark, "fact_po_raw", sum(runs, []))
    assert _rows(store.landing().latest("fact_po_raw")) == _rows(latest_version(log, PO.sort_key))



def test_upsert_runs_without_python_per_key(spark):
    base = tempfile.mkdtemp(prefix="state-", dir="/tmp")
    to_envelope(landing_rows(spark, "fact_po_raw", [_po(1, 1)]), "fact_po_raw").write.parquet(f"{base}/feed")
    plan = newer_records(change_feed(spark, f"{base}/feed"), "fact_po_raw")._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "Pandas" not in plan and "max_by" in plan
