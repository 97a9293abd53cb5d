"""Property test: the factorised plans equal the literal default-filled joins on
small random landing tables with dense key collisions, deleted right-hand rows,
key drift (duplicate ids) and deliveries/quotes pointing at id 0."""

import datetime as dt
import random

import pytest

from mart_helpers import make_landing

from tidemart.plans import marts as M

AS_OF = dt.date(2001, 8, 1)
DAYS = [AS_OF - dt.timedelta(days=d) for d in (0, 1, 2, 95)]


def _ts(rng):
    d = rng.choice(DAYS)
    return dt.datetime(d.year, d.month, d.day, rng.randrange(24), rng.randrange(60))


def random_tables(seed: int) -> dict:
    rng = random.Random(seed)
    buyers, sups = [1, 2, 3], [7, 8]
    pos = []
    for i in range(rng.randrange(1, 9)):
        pid = rng.choice([1, 2, 3, 4, 5, 6])           # repeated ids = key drift
        pos.append({"id": pid, "buyer_org_id": rng.choice(buyers), "supplier_org_id": rng.choice(sups),
                    "status": rng.randrange(1, 6), "total_amount": f"{rng.randrange(1, 10**6) / 100:.2f}",
                    "po_date": _ts(rng), "is_deleted": int(rng.random() < 0.1),
                    "_cdc_is_deleted": int(rng.random() < 0.1)})
    rfqs = [{"id": 100 + rng.randrange(6), "buyer_org_id": rng.choice(buyers), "rfq_date": _ts(rng),
             "status": rng.choice([0, 1, 3, 6, 12, 14]), "quote_count": rng.randrange(0, 4),
             "total_budget": f"{rng.randrange(1, 10**5)}.5", "_cdc_is_deleted": int(rng.random() < 0.1)}
            for _ in range(rng.randrange(0, 7))]
    quotes = [{"id": 300 + i, "rfq_id": rng.choice([100, 101, 102, 103, 999]), "supplier_org_id": rng.choice(sups),
               "status": rng.choice([2, 6, 11, 14]), "quoted_at": _ts(rng), "_cdc_is_deleted": int(rng.random() < 0.1)}
              for i in range(rng.randrange(0, 7))]
    invoices = [{"id": rng.choice([0, 400, 401, 402, 403]), "po_id": rng.choice([0, 1, 2, 3, 4, 9]),
                 "buyer_org_id": rng.randrange(3), "invoice_date": rng.choice(DAYS),
                 "status": rng.choice(["paid", "overdue", "pending", "cancelled"]),
                 "amount": f"{rng.randrange(100, 10**5)}.25", "paid_amount": f"{rng.randrange(0, 100)}.5"}
                for _ in range(rng.randrange(0, 7))]
    deliveries = [{"id": 500 + i, "po_id": rng.choice([0, 1, 2, 3, 4, 9]), "delay_days": rng.randrange(-3, 4),
                   "_cdc_is_deleted": int(rng.random() < 0.1)}
                  for i in range(rng.randrange(0, 7))]
    ratings = [{"id": 600 + i, "rater_org_id": rng.choice(buyers), "rated_org_id": rng.choice(sups),
                "rated_at": _ts(rng), "rating": float(rng.randrange(0, 6))}
               for i in range(rng.randrange(0, 6))]
    movements = [{"id": 700 + i, "org_id": rng.choice(buyers), "warehouse_id": 1, "product_id": 1,
                  "movement_type": rng.choice(["inbound", "outbound", "reserved"]),
                  "quantity": f"{rng.randrange(1, 50)}", "unit_cost": f"{rng.randrange(1, 999)}.1234",
                  "movement_date": rng.choice(DAYS)}
                 for i in range(rng.randrange(0, 6))]
    return {"fact_po_raw": pos, "fact_rfq_raw": rfqs, "fact_rfq_quote_raw": quotes,
            "fact_invoice_raw": invoices, "fact_delivery_raw": deliveries,
            "fact_rating_raw": ratings, "fact_inventory_movement_raw": movements}


def _rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("mart", sorted(M.FACTORISED))
def test_factorised_equals_joins(spark, mart, seed):
    L = make_landing(spark, random_tables(seed))
    fn = M.MARTS[mart]
    assert _rows(fn(L, AS_OF, plan="factorised")) == _rows(fn(L, AS_OF, plan="joins"))
