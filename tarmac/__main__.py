"""Command line: ``python -m tarmac [--cluster] [--conf K=V] <report|sql|prepare> ...``.

  report q1|q2|q3|routes|months|airport_month_means|cancel_causes INPUT OUTPUT
         [--rate-scale N] [--single-file] [--merge-schema] [--log FOLDER]
  report all INPUT OUTPUT      q1, q2, q3, airport_month_means and cancel_causes from one scan
  sql    q1|q2|q3|PATH.sql INPUT OUTPUT [--sep S] [--db NAME] [--log FOLDER]
  prepare RAW_CSV BASE_DIR
  runlog LOCAL_CSV CLUSTER_CSV OUTPUT
"""

from __future__ import annotations

import argparse
import sys

from tarmac.plans import jobs
from tarmac.session import CLUSTER_CONF, get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tarmac")
    ap.add_argument("--cluster", action="store_true",
                    help="apply tarmac.session.CLUSTER_CONF")
    ap.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE",
                    help="extra Spark setting (repeatable)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("report")
    r.add_argument("name", choices=[*sorted(jobs.REPORTS), "all"])
    r.add_argument("input")
    r.add_argument("output")
    r.add_argument("--rate-scale", type=int, default=2)
    r.add_argument("--single-file", action="store_true",
                   help="join the finished part files of the report into one")
    r.add_argument("--merge-schema", action="store_true",
                   help="read the footers of all files instead of the declared schema")
    r.add_argument("--log", help="run log folder that gets a line of this run")
    s = sub.add_parser("sql")
    s.add_argument("name")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--sep", default=",")
    s.add_argument("--db", help="database that holds the table and is current")
    s.add_argument("--log", help="run log folder that gets a line of this run")
    p = sub.add_parser("prepare")
    p.add_argument("raw")
    p.add_argument("base")
    g = sub.add_parser("runlog")
    g.add_argument("local")
    g.add_argument("cluster_log")
    g.add_argument("output")
    a = ap.parse_args(argv)

    conf = dict(CLUSTER_CONF) if a.cluster else {}
    for item in a.conf:
        key, sep, value = item.partition("=")
        if not sep:
            ap.error(f"--conf needs KEY=VALUE, got {item!r}")
        conf[key] = value
    spark = get_session(app=f"tarmac-{a.cmd}", conf=conf)
    try:
        if a.cmd == "report" and a.name == "all":
            out = jobs.report_all_job(spark, a.input, a.output, a.rate_scale, a.single_file, a.log)
        elif a.cmd == "report":
            out = jobs.report_job(spark, a.input, a.name, a.output, a.rate_scale,
                                  single_file=a.single_file, merge_schema=a.merge_schema, log=a.log)
        elif a.cmd == "sql":
            out = jobs.sql_job(spark, a.input, a.name, a.output, sep=a.sep, db=a.db, log=a.log)
        elif a.cmd == "runlog":
            out = jobs.runlog_job(spark, a.local, a.cluster_log, a.output)
        else:
            out = jobs.prepare_job(spark, a.raw, a.base)
        print(f"written: {out}")
        return 0
    except Exception as e:  # noqa: BLE001  - one message, non-zero exit
        print(f"ERROR {a.cmd}: {e}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
