"""A batch is landed in one pass a table, with nothing of it held in executors between jobs."""

import json
import os

import pytest

from pyspark.sql import functions as F

from test_landing_parse import TABLES, _batch
from test_streaming import _checkpoint

from tidemart.streaming.apply import (
    TooManyRejects, batch_writer, checked_records, checked_rows, counted, read_landed, read_rejected,
)


def test_a_batch_is_landed_without_being_persisted(spark, tmp_path, monkeypatch):
    def persist(*args, **kwargs):
        raise AssertionError("a batch is held in executors")
    for held in ("persist", "cache", "checkpoint", "localCheckpoint"):
        monkeypatch.setattr(type(_batch(spark)), held, persist)
    root, ckpt = str(tmp_path / "landing"), _checkpoint("m")
    for _ in range(2):  # a replay changes nothing
        batch_writer(root, TABLES, "s", ckpt, max_malformed=0.9)(_batch(spark), 0)
        assert [r["id"] for r in read_landed(spark, root, "fact_po_raw").collect()] == [1]
        assert [r["id"] for r in read_landed(spark, root, "fact_rfq_raw").collect()] == [2]
        assert sorted((r["reason"], r["payload"]) for r in read_rejected(spark, root).collect()) == [
            ("malformed payload", "{"), ("malformed payload", '{"id": "x"}'), ("unlisted table", '{"id": 3}')]


def test_a_refused_batch_leaves_what_was_landed(spark, tmp_path):
    root, ckpt = str(tmp_path / "landing"), _checkpoint("m")
    batch_writer(root, TABLES, "s", ckpt)(_batch(spark).filter(F.col("payload") == '{"id": 2}'), 0)
    with pytest.raises(TooManyRejects, match="2 of 4"):
        batch_writer(root, TABLES, "s", ckpt)(_batch(spark), 1)
    assert [r["id"] for r in read_landed(spark, root, "fact_rfq_raw").collect()] == [2]
    assert not os.path.exists(f"{root}/fact_po_raw") and not os.path.exists(f"{root}/_rejected")
    assert os.listdir(f"{root}/_staged") == []


def test_rows_and_their_count_parse_a_payload_once(spark):
    checked, seen = counted(checked_records(_batch(spark).filter("_table = 'fact_po_raw'"), ["fact_po_raw"]))
    rows = checked_rows(checked, "fact_po_raw")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert [json.loads(x)["id"] for x in rows.toJSON().collect()] == [1]
    checked, seen = counted(checked_records(_batch(spark), TABLES))
    assert checked.filter("reason IS NOT NULL").count() == 3 == seen.get["rejected"]


def test_records_without_a_table_are_kept_aside(spark, tmp_path):
    root = str(tmp_path / "landing")
    batch = _batch(spark).filter(F.col("payload") == '{"id": 2}')
    nameless = batch.withColumn("_table", F.lit(None).cast("string"))
    batch_writer(root, TABLES, "s", _checkpoint("m"))(batch.unionByName(nameless), 0)
    assert [(r["_table"], r["reason"]) for r in read_rejected(spark, root).collect()] == [(None, "unlisted table")]
    assert read_landed(spark, root, "fact_rfq_raw").count() == 1
