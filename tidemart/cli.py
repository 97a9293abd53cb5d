"""Command line: one refresh pass, or the refresh status.

    python -m tidemart.cli run    --landing PATH --marts PATH [--group agg|snapshot|all]
                                  [--as-of YYYY-MM-DD] [--mode replace_window|literal]
                                  [--semantics literal|strict]
    python -m tidemart.cli status --marts PATH
    python -m tidemart.cli land    --feed PATH --landing PATH [--tables t1,t2] [--max-files N]
    python -m tidemart.cli compact --landing PATH --out PATH --table T [--drop-deleted]

``run`` is a single pass (what an external scheduler calls every 10 / 60
minutes); ``--as-of`` defaults to today's UTC date, used for every mart.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from tidemart.plans import refresh as R
from tidemart.plans.landing import Landing
from tidemart.operators.cdc import write_compacted
from tidemart.session import build_session
from tidemart.sources.schemas import LANDING
from tidemart.streaming.apply import change_feed, land_changes


def main(argv: list[str] | None = None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="tidemart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="refresh a group of marts once")
    r.add_argument("--landing", required=True)
    r.add_argument("--marts", required=True)
    r.add_argument("--group", choices=sorted(R.GROUPS), default="all")
    r.add_argument("--as-of", type=_dt.date.fromisoformat, default=None)
    r.add_argument("--mode", choices=["replace_window", "literal"], default="replace_window")
    r.add_argument("--semantics", choices=["literal", "strict"], default="literal")
    st = sub.add_parser("status", help="last refresh per mart")
    st.add_argument("--marts", required=True)
    ld = sub.add_parser("land", help="land the change records available in a feed folder")
    ld.add_argument("--feed", required=True)
    ld.add_argument("--landing", required=True)
    ld.add_argument("--tables", default=",".join(LANDING))
    ld.add_argument("--max-files", type=int, default=None)
    ld.add_argument("--checkpoint", default=None)
    cp = sub.add_parser("compact", help="rewrite a landing table to one version per key")
    cp.add_argument("--landing", required=True)
    cp.add_argument("--out", required=True)
    cp.add_argument("--table", required=True, choices=sorted(LANDING))
    cp.add_argument("--drop-deleted", action="store_true")
    args = ap.parse_args(argv)
    spark = spark or build_session()
    if args.cmd == "land":
        tables = [t for t in args.tables.split(",") if t]
        q = land_changes(change_feed(spark, args.feed, args.max_files), args.landing, args.checkpoint,
                         tables, name="cli-landing")
        q.awaitTermination()
        return 0
    if args.cmd == "compact":
        df = spark.read.parquet(f"{args.landing.rstrip('/')}/{args.table}")
        cols = [f.name for f in LANDING[args.table].schema.fields]
        write_compacted(df.select(*cols), args.table, args.out, keep_tombstones=not args.drop_deleted)
        return 0
    if args.cmd == "run":
        as_of = args.as_of or _dt.datetime.now(_dt.timezone.utc).date()
        status = R.run(spark, Landing.from_path(spark, args.landing), args.marts, as_of,
                       group=args.group, mode=args.mode, semantics=args.semantics)
        status.show(truncate=False)
        return 0 if all(row["status"] == "ok" for row in status.collect()) else 1
    R.refresh_status(spark, args.marts).orderBy("mart").show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
