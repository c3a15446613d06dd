"""Command line: run pipeline steps or profile a warehouse table.

    python -m tenderlake --warehouse PATH load-contracts PATH [--multi-line]
    python -m tenderlake --warehouse PATH refresh-contracts
    python -m tenderlake --warehouse PATH load-registry PATH
    python -m tenderlake --warehouse PATH refresh-registry
    python -m tenderlake --warehouse PATH load-statements PATH [--no-header]
    python -m tenderlake --warehouse PATH refresh-statements
    python -m tenderlake --warehouse PATH load-codes PATH
    python -m tenderlake --warehouse PATH refresh-codes
    python -m tenderlake --warehouse PATH reports
    python -m tenderlake --warehouse PATH show dwh.fact_per_suppliername [-n 20]
    python -m tenderlake --warehouse PATH profile dwh.decp_marches [--numeric montant] [--key decp_uid]
"""

from __future__ import annotations

import argparse
import json

from tenderlake.operators import profile
from tenderlake.plans.pipeline import Pipeline
from tenderlake.session import build_session, cluster_conf, drop_scratch
from tenderlake.sinks.warehouse import Warehouse


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tenderlake")
    ap.add_argument("--warehouse", required=True, help="root folder of the warehouse tables")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    ap.add_argument("--input-bytes", type=int, default=0, help="size of the landed data, sizes shuffles")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("load-contracts", "load-registry", "load-statements", "load-codes"):
        p = sub.add_parser(name)
        p.add_argument("path")
        p.add_argument("--multi-line", action="store_true",
                       help="pretty-printed documents / newlines inside quoted fields")
        if name == "load-contracts":
            p.add_argument("--tolerant", action="store_true", help="keep and count malformed documents, go on")
        if name == "load-statements":
            p.add_argument("--no-header", action="store_true")
    for name in ("refresh-contracts", "refresh-registry", "refresh-statements", "refresh-codes", "reports"):
        sub.add_parser(name)
    p = sub.add_parser("show")
    p.add_argument("table", help="layer.table")
    p.add_argument("-n", type=int, default=20)
    p = sub.add_parser("profile")
    p.add_argument("table", help="layer.table")
    p.add_argument("--numeric", action="append", default=[])
    p.add_argument("--key", default=None)
    args = ap.parse_args(argv)

    conf = cluster_conf(args.input_bytes) if args.input_bytes else None
    spark = build_session(args.master, conf=conf)
    pipe = Pipeline(spark, Warehouse(spark, args.warehouse))
    steps = {
        "load-contracts": lambda: pipe.load_contracts(args.path, multi_line=args.multi_line, tolerant=args.tolerant),
        "refresh-contracts": pipe.refresh_contracts,
        "load-registry": lambda: pipe.load_registry(args.path, multi_line=args.multi_line),
        "refresh-registry": pipe.refresh_registry,
        "load-statements": lambda: pipe.load_statements(args.path, header=not args.no_header,
                                                        multi_line=args.multi_line),
        "refresh-statements": pipe.refresh_statements,
        "load-codes": lambda: pipe.load_codes(args.path, multi_line=args.multi_line),
        "refresh-codes": pipe.refresh_codes,
        "reports": pipe.refresh_reports,
    }
    if args.cmd in steps:
        report = steps[args.cmd]()
        print(json.dumps({"step": report.step, "checks": report.checks,
                          "notes": report.notes,
                          "upserts": {k: vars(v) for k, v in report.upserts.items()}}, default=str))
        drop_scratch(spark)
        return
    layer, table = args.table.split(".", 1)
    df = pipe.wh.read(layer, table)
    if args.cmd == "show":
        df.show(args.n, truncate=False)
        return
    profile.row_count(df).show()
    profile.null_share(df).show(len(df.columns), truncate=False)
    if args.key:
        profile.key_uniqueness(df, args.key).show()
    if args.numeric:
        profile.numeric_summaries(df, args.numeric).show(len(args.numeric), truncate=False)
        profile.box_stats_of(df, args.numeric).show(len(args.numeric), truncate=False)


if __name__ == "__main__":
    main()
