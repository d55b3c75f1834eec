"""Command line: ``python -m aurum <command> --sf DIR``.

  run        land, build and gate every layer as versioned tables (exit 1 if the gate closes)
  gate       promotion gate report on freshly built layers (exit 1 if closed)
  schema     the 23 schema tests
  drill      inject the corrupt file, rebuild, show the quarantine delta
  train      train the regressor and append a run record
  lift       weather-feature lift and KEEP/CUT verdict
  validate   experiment apparatus check (control vs known effect)
  query NAME any registered query
  list       registered query names
"""

from __future__ import annotations

import argparse
import os
import sys

COMMANDS = {"gate": "gate_report", "schema": "schema_tests_report", "drill": "defect_drill",
            "train": "run_record", "lift": "feature_lift", "validate": "apparatus_check"}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="aurum", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("command", choices=["run", "query", "list", *COMMANDS])
    ap.add_argument("name", nargs="?")
    ap.add_argument("--sf", default=os.environ.get("AURUM_SF_DIR", "/root/testdata/sf0.01"))
    ap.add_argument("--root", default=None, help="layer root (default: inside spark.checkpoint.dir)")
    ap.add_argument("--master", default=os.environ.get("AURUM_MASTER"))
    ap.add_argument("--rows", type=int, default=50)
    a = ap.parse_args(argv)

    from aurum.plans.catalog import QUERIES
    if a.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0

    from aurum.operators import quality as Q
    from aurum.session import build_session
    spark = build_session(a.master)
    if a.command == "run":
        from aurum.plans.build import run
        written, report = run(spark, a.sf, a.root)
        written.show(100, truncate=False)
        report.orderBy("check_no").show(100, truncate=False)
        try:
            Q.assert_open(report)
        except Q.GateClosed as e:
            print(e, file=sys.stderr)
            return 1
        return 0
    name = a.name if a.command == "query" else COMMANDS[a.command]
    if name not in QUERIES:
        ap.error(f"unknown query {name!r}")
    df = QUERIES[name](spark, a.sf)
    if a.command in ("gate", "schema"):
        df = df.orderBy("check_no")
        df.show(100, truncate=False)
        try:
            Q.assert_open(df)
        except Q.GateClosed as e:
            print(e, file=sys.stderr)
            return 1
        return 0
    df.show(a.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
