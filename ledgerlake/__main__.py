"""Command line: ``python -m ledgerlake <command> ...`` (or via ``spark-submit``).

    run       --input DIR --warehouse DIR [--file NAME] [--entity customers|orders|products] [--processed DIR]
              [--versioned]
    load-all  --processed DIR --warehouse DIR [--versioned]
    verify    --expect TABLE=ROWS [TABLE=ROWS ...]
    reconcile --tables TABLE [TABLE ...]
    status    --warehouse DIR

The session comes from ``SparkSession.builder.getOrCreate()``, so master, memory
and ``spark.checkpoint.dir`` are whatever the submitter configured; the Spark web
UI is off. Results are printed as one JSON document.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlake")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="load, profile, clean and load one dataset")
    run.add_argument("--input", required=True)
    run.add_argument("--warehouse", required=True)
    run.add_argument("--file", default=None, help="file name (case-insensitive); default: first in sort order")
    run.add_argument("--entity", choices=["customers", "orders", "products"], default=None,
                     help="typed cleaning for this entity instead of the generic cleaner")
    run.add_argument("--processed", default=None, help="also write the processed CSV here")
    run.add_argument("--one-line", action="store_true",
                     help="the file has one record a line (no quoted newlines, JSON lines): read it in parallel")
    run.add_argument("--schema", default=None, help="the input's columns and types, as DDL: nothing is inferred")
    run.add_argument("--row-tags", nargs="+", default=None, metavar="TAG", help="record tags of an XML input")
    run.add_argument("--root-tag", default=None, help="XML: records of documents with this root only")
    run.add_argument("--num-files", type=int, default=None, help="files of the clustered table, default by size")
    load = sub.add_parser("load-all", help="load every *_processed.csv into its table")
    load.add_argument("--processed", required=True)
    load.add_argument("--warehouse", required=True)
    for command in (run, load):
        command.add_argument("--versioned", action="store_true",
                             help="versioned tables: readers see a load at once, of two loaders at once one is refused")
    reconcile = sub.add_parser("reconcile", help="compare tables' content and layout with what their loads recorded")
    reconcile.add_argument("--tables", nargs="+", required=True)
    verify = sub.add_parser("verify", help="compare table row counts with expected counts")
    verify.add_argument("--expect", nargs="+", required=True, metavar="TABLE=ROWS")
    status = sub.add_parser("status", help="the latest run record")
    status.add_argument("--warehouse", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    """Parse ``argv``, run the command, print and return its JSON result."""
    args = _parser().parse_args(argv)
    if spark is None:
        spark = SparkSession.builder.appName("ledgerlake").config("spark.ui.enabled", "false").getOrCreate()
    from ledgerlake.plans import pipeline as P
    from ledgerlake.sinks import content
    from ledgerlake.sinks import warehouse as W

    if args.command == "run":
        options = {"multi_line": not args.one_line, "row_tags": args.row_tags, "root_tag": args.root_tag}
        if args.schema:
            options["schema"] = T.StructType.fromDDL(args.schema)
        res = P.run_pipeline(spark, args.input, args.warehouse, selected=args.file, processed_dir=args.processed,
                             entity=args.entity, num_files=args.num_files, versioned=args.versioned, **options)
        out = {k: res[k] for k in ("source_file", "processed_file", "table_name", "rows_loaded", "status")}
        out.update(raw_report=res["raw_report"], processed_report=res["processed_report"])
    elif args.command == "status":
        rows = P.pipeline_status(spark, args.warehouse).collect()
        out = rows[0].asDict() if rows else {"status": "never run"}
    elif args.command == "load-all":
        counts = P.load_all_tables(spark, args.processed, args.warehouse, versioned=args.versioned)
        out = {r.table_name: r.total_rows for r in counts.collect()}
    elif args.command == "reconcile":
        rows = content.reconcile(spark, args.tables).collect()
        out = {"passed": all(r.matches for r in rows), "checks": [r.asDict() for r in rows]}
    else:
        expected = {k: int(v) for k, v in (e.split("=", 1) for e in args.expect)}
        rows = W.verify_tables(spark, expected).collect()
        out = {"passed": all(r.matches for r in rows), "tables": [r.asDict() for r in rows]}
    print(json.dumps(out, default=str, indent=2))
    return out


if __name__ == "__main__":
    result = main()
    sys.exit(0 if result.get("passed", True) and result.get("status", "success") == "success" else 1)
