"""One-pass routing: equals the per-table landing, rejects with reasons, replays and restarts, lag after each batch."""

import tempfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemart.session import child_names
from tidemart.sources.rows import landing_rows
from tidemart.sources.schemas import LANDING
from tidemart.streaming import routing as R
from tidemart.streaming.apply import change_feed, land_changes, read_landed, to_envelope

TABLES = ["fact_po_raw", "fact_rfq_raw", "dim_organization_raw"]


def _feed(spark, path, tables, bad=()):
    """Append the records of some tables (rows by table) and ``bad`` ones (table, payload) as one file."""
    out = None
    for t, rows in tables.items():
        e = to_envelope(landing_rows(spark, t, rows), t)
        out = e if out is None else out.unionByName(e)
    for t, payload in bad:
        e = out.limit(1).withColumn("_table", F.lit(t)).withColumn("payload", F.lit(payload))
        out = out.unionByName(e)
    out.coalesce(1).write.mode("append").parquet(path)


def _po(i, version=1, day="2001-06-01", deleted=0):
    return {"id": i, "buyer_org_id": i % 3, "total_amount": f"{i}.2500", "status": version, "po_number": f"PO-{i} \"é\"", "expected_delivery": "2001-07-01",
            "po_date": f"{day} 10:00:00", "_cdc_version": version, "_cdc_is_deleted": deleted}


def _rfq(i, version=1):
    return {"id": i, "buyer_org_id": i % 3, "rfq_date": "2001-05-0%d 00:00:00" % (1 + i % 9), "_cdc_version": version}


def _rows(df, table):
    return sorted((tuple(r) for r in df.select(*[f.name for f in LANDING[table].schema.fields]).collect()), key=repr)


def _run(spark, base, **kw):
    R.route_changes(change_feed(spark, f"{base}/feed", 1), f"{base}/routed", f"{base}/ckpt", TABLES, **kw).awaitTermination()


@pytest.fixture
def base():
    return tempfile.mkdtemp(prefix="routing-", dir="/tmp")


def test_equals_the_landing_by_table(spark, base):
    _feed(spark, f"{base}/feed", {"fact_po_raw": [_po(i) for i in range(20)], "fact_rfq_raw": [_rfq(i) for i in range(9)],
                                  "dim_organization_raw": [{"id": 4, "name": "x", "buyer_avg_rating": 4.5}]})
    _feed(spark, f"{base}/feed", {"fact_po_raw": [_po(3, 2, "2001-08-01"), _po(4, 2, deleted=1)]})
    _run(spark, base)
    land_changes(change_feed(spark, f"{base}/feed"), f"{base}/landed", f"{base}/ckpt2", TABLES).awaitTermination()
    for t in TABLES:
        got = R.read_routed(spark, f"{base}/routed", t)
        assert _rows(got, t) == _rows(read_landed(spark, f"{base}/landed", t), t)
        assert ("month" in got.columns) == bool(LANDING[t].month_of)
    assert R.read_routed(spark, f"{base}/routed", "fact_po_raw").filter("month = 200108").count() == 1
    assert R.read_routed(spark, f"{base}/routed", "fact_invoice_raw").count() == 0  # nothing landed


def test_a_batch_is_read_once(spark):
    batch = to_envelope(landing_rows(spark, "fact_po_raw", [_po(1)]), "fact_po_raw")
    path = tempfile.mkdtemp(prefix="routing-", dir="/tmp") + "/b"
    batch.write.parquet(path)
    plan = R.routed(spark.read.parquet(path), list(LANDING))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan


def test_rejects_keep_payload_and_reason(spark, base):
    bad = [("fact_po_raw", "{\"id\":"), ("fact_po_raw", "{\"id\":\"x\"}"), ("fact_po_raw", "{\"id\":1.5}"), ("fact_po_raw", "[1]"),
           ("fact_po_raw", "7"), ("fact_po_raw", "null"), ("fact_rfq_raw", "{\"rfq_date\":\"soon\"}"), ("nowhere", "{\"id\":1}"), (None, "{}")]
    _feed(spark, f"{base}/feed", {"fact_po_raw": [_po(i) for i in range(5)]}, bad + [("fact_po_raw", "{\"id\":null,\"more\":1}")])
    _run(spark, base, max_malformed=0.9)
    got = [(r["table_name"], r["payload"], r["reason"]) for r in R.read_routed_rejects(spark, f"{base}/routed").collect()]
    want = [(t, p, "unlisted table" if t in ("nowhere", None) else "malformed payload") for t, p in bad]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # a missing or null field is the type's default, an unknown one is ignored
    assert sorted(r["id"] for r in R.read_routed(spark, f"{base}/routed", "fact_po_raw").collect()) == [0, 0, 1, 2, 3, 4]


def test_too_many_rejects_leave_nothing(spark, base):
    _feed(spark, f"{base}/feed", {"fact_po_raw": [_po(1), _po(2)]}, [("fact_po_raw", "{")])
    with pytest.raises(StreamingQueryException, match="1 of 3 records are malformed"):
        _run(spark, base)
    assert R.read_routed(spark, f"{base}/routed", "fact_po_raw").count() == 0
    assert R.landed_progress(spark, f"{base}/routed").count() == 0


def test_replay_and_lag_after_each_batch(spark, base):
    def lag():
        end = R.log_end(spark.read.parquet(f"{base}/feed"))
        got = R.stream_lag(end, R.landed_progress(spark, f"{base}/routed")).collect()
        return {r["table_name"]: (r["log_records"], r["landed_records"], r["pending_records"], r["version_lag"]) for r in got}

    _feed(spark, f"{base}/feed", {"fact_po_raw": [_po(1), _po(2)], "fact_rfq_raw": [_rfq(1)]})
    assert lag() == {"fact_po_raw": (2, 0, 2, None), "fact_rfq_raw": (1, 0, 1, None)}
    _run(spark, base)
    assert lag() == {"fact_po_raw": (2, 2, 0, 0), "fact_rfq_raw": (1, 1, 0, 0)}
    _feed(spark, f"{base}/feed", {"fact_po_raw": [_po(1, 5)]})
    assert lag()["fact_po_raw"] == (3, 2, 1, 4)
    _run(spark, base)
    assert lag() == {"fact_po_raw": (3, 3, 0, 0), "fact_rfq_raw": (1, 1, 0, 0)}
    # the last batch again, as after a crash before Spark noted its end
    last = to_envelope(landing_rows(spark, "fact_po_raw", [_po(1, 5)]), "fact_po_raw")
    R.routing_writer(f"{base}/routed", TABLES, "routing", f"{base}/ckpt")(last, 1)
    assert lag() == {"fact_po_raw": (3, 3, 0, 0), "fact_rfq_raw": (1, 1, 0, 0)}
    assert R.read_routed(spark, f"{base}/routed", "fact_po_raw").count() == 3
    assert len(child_names(spark, f"{base}/routed/_progress")) == 1


def test_each_image_is_read_once_a_record(spark):
    path = tempfile.mkdtemp(prefix="routing-", dir="/tmp") + "/b"
    to_envelope(landing_rows(spark, "fact_po_raw", [_po(1)]), "fact_po_raw").write.parquet(path)
    plan = R.routed(spark.read.parquet(path), TABLES)._jdf.queryExecution().optimizedPlan().toString()
    # typed and as texts, for each table; not again for every field that is checked
    assert plan.count("try_variant_get(") == 2 * len(TABLES)
