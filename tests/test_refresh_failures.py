"""A failed mart is an error where its table is read next, not a row count."""

import datetime as dt

import pytest

from mart_helpers import SF0001

from tidemart.plans import refresh as R
from tidemart.plans.landing import Landing
from tidemart.plans.stateful_queries import AS_OF, refresh_group_run, report_mart_row_counts

DAY_BEFORE = dt.date(2001, 7, 31)


def _fail_on(monkeypatch, mart, day):
    real, tried = R.refresh_mart, []

    def refresh(spark, L, name, as_of, *args, **kwargs):
        tried.append((name, as_of))
        if (name, as_of) == (mart, day):
            raise RuntimeError("an executor was lost too often")
        return real(spark, L, name, as_of, *args, **kwargs)
    monkeypatch.setattr(R, "refresh_mart", refresh)
    return tried


@pytest.mark.parametrize("day", [DAY_BEFORE, AS_OF])
def test_row_counts_are_not_given_for_a_failed_mart(spark, monkeypatch, day):
    tried = _fail_on(monkeypatch, "snapshot_org_daily", day)
    with pytest.raises(R.RefreshFailed, match="snapshot_org_daily: an executor was lost too often"):
        report_mart_row_counts(spark, SF0001).collect()
    assert {name for name, d in tried if d == day} == set(R.SNAPSHOT_GROUP)  # the others were refreshed


def test_a_failed_mart_has_no_row_count(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(R, "refresh_mart", lambda s, L, name, *a, **k: (0, 0) if name != "snapshot_org_daily" else 1 / 0)
    status = R.run(spark, Landing(lambda t: None), str(tmp_path), AS_OF, group="snapshot")
    assert {r["mart"]: (r["status"], r["rows"]) for r in status.collect()} == {
        "snapshot_org_daily": ("failed", None), "snapshot_inventory_sku_daily": ("ok", 0)}
    with pytest.raises(R.RefreshFailed, match="snapshot_org_daily: division by zero"):
        R.all_refreshed(status)
    R.all_refreshed(status.filter("status = 'ok'"))


def test_a_group_run_expects_one_failure_only(spark, monkeypatch):
    _fail_on(monkeypatch, "agg_daily_rfq_pipeline", AS_OF)
    with pytest.raises(R.RefreshFailed, match="^agg_daily_rfq_pipeline: an executor was lost too often$"):
        refresh_group_run(spark, SF0001).collect()
