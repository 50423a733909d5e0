"""Command-line entry points of the two jobs.

    python -m tessera sales --rows 100000000 [--seed 42] [--local N]
    python -m tessera load --source DIR --target DIR [--since ISO] [--policy unique|as_coded] [--local N]

``sales`` prints a 5-row preview, the row count, and the four analytics
(20 rows each, the console default); ``load`` prints the published version.
Errors propagate (non-zero exit), so a scheduler sees a failed run.
"""

from __future__ import annotations

import argparse
import time

from tessera.plans.jobs import run_load, run_sales
from tessera.session import create_tuned_session
from tessera.sinks.writer import counted, preview
from tessera.sources.synth import sales_table


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessera")
    sub = parser.add_subparsers(dest="job", required=True)
    sales = sub.add_parser("sales", help="generate, enrich and report the sales table")
    sales.add_argument("--rows", type=int, default=100_000_000)
    sales.add_argument("--seed", type=int, default=42)
    load = sub.add_parser("load", help="merge new call-record files into the target")
    load.add_argument("--source", required=True)
    load.add_argument("--target", required=True)
    load.add_argument("--since", default=None, help="ISO time; default: the last listing")
    load.add_argument("--policy", choices=["unique", "as_coded"], default="unique")
    load.add_argument("--watermark", choices=["global", "per_key"], default="global")
    load.add_argument("--allowed-lateness", default=None, help='move the watermark back, e.g. "2 days"')
    load.add_argument("--buckets", type=int, default=None, help="buckets of the id (0: none; default: by the target's size)")
    load.add_argument("--skip-foreign", action="store_true", help="leave files out that are not Parquet")
    load.add_argument("--one-schema", action="store_true", help="read all files with the declared schema, without their footers")
    load.add_argument("--file-bytes", type=int, default=None, help="size of the target's files")
    load.add_argument("--single-file", action="store_true")
    for p in (sales, load):
        p.add_argument("--local", type=int, default=None, help="run on local[N] instead of the cluster")
    args = parser.parse_args(argv)

    started = time.time()
    spark = create_tuned_session(f"tessera-{args.job}", local_threads=args.local)
    try:
        if args.job == "sales":
            table = sales_table(spark, args.rows, args.seed)
            preview(table, 5).show()
            print(f"partitions: {table.rdd.getNumPartitions()}")
            # The observation is filled by the one full pass over the table.
            observed, rows = counted(table)
            observed.write.format("noop").mode("overwrite").save()
            print(f"rows: {rows.get['rows']}")
            for name, df in run_sales(spark, args.rows, args.seed).items():
                print(name)
                df.show()
        else:
            result = run_load(
                spark, args.source, args.target, since=args.since, policy=args.policy,
                watermark=args.watermark, single_file=args.single_file, allowed_lateness=args.allowed_lateness,
                buckets=args.buckets, foreign="skip" if args.skip_foreign else "error",
                group_by_schema=not args.one_schema, target_file_bytes=args.file_bytes,
            )
            print(result)
    finally:
        spark.stop()
    print(f"elapsed: {time.time() - started:.2f} s")


if __name__ == "__main__":
    main()
