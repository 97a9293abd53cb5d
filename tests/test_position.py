"""Position-based source: a restart in mid-log equals one run, limits, start positions, refused segments."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tidemart.session import child_names
from tidemart.sources import position as P
from tidemart.sources.rows import landing_rows
from tidemart.sources.schemas import LANDING
from tidemart.streaming.apply import land_changes, read_landed, to_envelope

PO = LANDING["fact_po_raw"]


def _segment(spark, log, positions):
    rows = [{"id": p % 7, "po_number": f"at {p}", "po_date": "2001-06-01 00:00:00", "_cdc_version": p} for p in positions]
    e = to_envelope(landing_rows(spark, "fact_po_raw", rows), "fact_po_raw").withColumn(P.POSITION, F.col("_cdc_version"))
    P.append_segment(e, log)


def _run(spark, log, base, **kw):
    land_changes(P.position_feed(spark, log, f"{base}/ckpt", **kw).drop(P.POSITION), f"{base}/landed", f"{base}/ckpt", ["fact_po_raw"]).awaitTermination()
    return sorted(r[0] for r in read_landed(spark, f"{base}/landed", "fact_po_raw").select("_cdc_version").collect())


def _batches(base, spark):
    own = child_names(spark, f"{base}/landed/fact_po_raw")[0]
    return child_names(spark, f"{base}/landed/fact_po_raw/{own}")


@pytest.fixture
def base():
    return tempfile.mkdtemp(prefix="position-", dir="/tmp")


def test_restart_in_mid_log_equals_one_run(spark, base):
    log, all_positions = f"{base}/log", list(range(0, 300, 3))
    for i in range(0, 100, 20):
        _segment(spark, log, all_positions[i:i + 20])
    assert [s[2] for s in P.segments(spark, log)] == [20] * 5
    # at most 40 rows a batch, a restart after each
    seen = [_run(spark, log, f"{base}/a", max_rows=40) for _ in range(4)]
    assert [len(s) for s in seen] == [40, 80, 100, 100] and seen[-1] == all_positions
    assert _run(spark, log, f"{base}/b") == all_positions
    assert len(_batches(f"{base}/a", spark)) == 3 and len(_batches(f"{base}/b", spark)) == 1
    # the log goes on
    _segment(spark, log, [1000, 2000])
    assert _run(spark, log, f"{base}/a", max_rows=40) == _run(spark, log, f"{base}/b") == [*all_positions, 1000, 2000]


def test_lost_planned_position_and_small_limit(spark, base):
    log = f"{base}/log"
    for p in ([1, 2, 3], [5], [8, 9]):
        _segment(spark, log, p)
    assert _run(spark, log, f"{base}/a", max_rows=1) == [1, 2, 3]  # a segment larger than the limit is taken whole
    assert _run(spark, log, f"{base}/a", max_rows=1) == [1, 2, 3, 5]
    assert _run(spark, log, f"{base}/a", max_rows=100) == [1, 2, 3, 5, 8, 9]


def test_start_within_a_segment(spark, base):
    log = f"{base}/log"
    _segment(spark, log, range(10))
    _segment(spark, log, range(20, 25))
    assert _run(spark, log, f"{base}/a", start=6) == [7, 8, 9, 20, 21, 22, 23, 24]
    assert _run(spark, log, f"{base}/b", start=9) == [20, 21, 22, 23, 24]


def test_segments_lie_behind_the_end(spark, base):
    log = f"{base}/log"
    assert P.segments(spark, log) == []
    _segment(spark, log, [5, 6])
    for bad in ([6, 7], [1], [-4]):
        with pytest.raises(ValueError):
            _segment(spark, log, bad)
    P.append_segment(spark.createDataFrame([], P.SCHEMA), log)
    assert P.segments(spark, log) == [(5, 6, 2)] and child_names(spark, log) == ["segment=5-6-2"]
