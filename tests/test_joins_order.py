"""The chained joins of the organisation snapshot: fanned-out rows do not cross the network."""

import datetime as dt
import re

from mart_helpers import SF0001

from tidemart.plans import marts as M
from tidemart.plans.landing import Landing


def test_org_joins_shuffle_pos_while_they_are_single(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = M.snapshot_org(Landing.from_fixtures(spark, SF0001), dt.date(2001, 8, 1), plan="joins")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the PO side is dealt once to its invoices and once by its organisation; no join result of the
    # sides by organisation, nor their grouping, is dealt again
    dealt = re.findall(r"hashpartitioning\((p_buyer_org_id|p_id)#", plan)
    assert dealt == ["p_buyer_org_id", "p_id"], dealt
