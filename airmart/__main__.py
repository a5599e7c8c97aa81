"""Cluster entry point: ``spark-submit --py-files airmart.zip -m airmart <command> ...``.

Commands:

* ``build --landing DIR --out DIR [--layout lines|document]``: batch rebuild of
  every layer from landing files (raw, clean, hourly, star).
* ``refresh --landing DIR --out DIR --checkpoint DIR [--every "30 minutes"]``:
  incremental refresh; without ``--every`` it processes the files present and
  stops (a scheduled run), with it it keeps running on that trigger.
* ``quality --out DIR``: the quality report of a build, written next to it.

The session comes from the launcher (master, executors, ``spark.checkpoint.dir``);
only the library defaults (UTC zone, AQE, dynamic partition overwrite) are set.
"""

from __future__ import annotations

import argparse

from .operators.quality import quality_report
from .plans.warehouse import build_warehouse, open_warehouse
from .session import get_session
from .sources.landing import read_landing
from .streaming.incremental import run_incremental


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="airmart")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build")
    b.add_argument("--landing", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--layout", default="document", choices=("lines", "document"))
    r = sub.add_parser("refresh")
    r.add_argument("--landing", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--checkpoint", required=True)
    r.add_argument("--layout", default="document", choices=("lines", "document"))
    r.add_argument("--every", default=None, help='processing-time trigger, e.g. "30 minutes"')
    q = sub.add_parser("quality")
    q.add_argument("--out", required=True)
    args = p.parse_args(argv)

    spark = get_session()
    if args.command == "build":
        build_warehouse(spark, read_landing(spark, args.landing, layout=args.layout), args.out)
    elif args.command == "refresh":
        query = run_incremental(spark, args.landing, args.out, args.checkpoint, layout=args.layout,
                                available_now=args.every is None, processing_time=args.every or "30 minutes")
        query.awaitTermination()
    else:
        wh = open_warehouse(spark, args.out)
        quality_report(wh.raw, wh.clean).write.mode("overwrite").parquet(f"{args.out}/quality_report")


if __name__ == "__main__":
    main()
