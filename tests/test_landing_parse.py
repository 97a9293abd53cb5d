"""A landed batch is parsed once: counts, rejects and rows come from the same images."""

import datetime as dt

from pyspark.sql import functions as F

from tidemart.sources.schemas import IS_DELETED, SYNCED_AT, VERSION
from tidemart.streaming.apply import ENVELOPE, checked_records, checked_rows

TABLES = ["fact_po_raw", "fact_rfq_raw"]
AT = dt.datetime(2024, 2, 1)


def _batch(spark):
    rows = [("fact_po_raw", 1, 0, AT, '{"id": 1, "status": 5}'), ("fact_po_raw", 1, 0, AT, '{"id": "x"}'),
            ("fact_po_raw", 1, 0, AT, "{"), ("fact_rfq_raw", 2, 1, AT, '{"id": 2}'), ("other", 1, 0, AT, '{"id": 3}')]
    return spark.createDataFrame(rows, ENVELOPE)


def test_each_record_has_one_fate(spark):
    checked = checked_records(_batch(spark), TABLES)
    found = {(r[0], r[1]): r[2] for r in checked.groupBy("_table", "reason").count().collect()}
    assert found == {("fact_po_raw", None): 1, ("fact_po_raw", "malformed payload"): 2, ("fact_rfq_raw", None): 1,
                     ("other", "unlisted table"): 1}
    po = checked_rows(checked, "fact_po_raw").collect()
    assert [(r["id"], r["status"], r["currency"], r[VERSION]) for r in po] == [(1, 5, "", 1)]
    rfq = checked_rows(checked, "fact_rfq_raw").collect()
    assert [(r["id"], r[IS_DELETED], r[SYNCED_AT]) for r in rfq] == [(2, 1, AT)]


def test_a_payload_is_parsed_once(spark):
    plan = checked_records(_batch(spark), TABLES).agg(F.count("reason"))
    full = checked_records(_batch(spark), TABLES)._jdf.queryExecution().optimizedPlan().toString()
    assert full.count("from_json(") == len(TABLES)
    assert plan.first()[0] == 3
