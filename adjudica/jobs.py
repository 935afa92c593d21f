"""Job entries for ``spark-submit``: generate, flow, drift, rewrite.

    python -m adjudica.jobs drift --profile P --current C --report R --fail-on-alert
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from .operators.contracts import LOAN_CONTRACT, TARGET_COLUMN
from .operators.rewrite import rewrite_tables
from .plans import stages
from .session import drop_work
from .sources import synth, tables


def _read(spark: SparkSession, path: str) -> DataFrame:
    """CSV with the loan schema by suffix, parquet otherwise."""
    if path.rstrip("/").endswith(".csv"):
        return tables.read_csv(spark, path, LOAN_CONTRACT.struct_type())
    return tables.read_parquet(spark, path)


def _generate(spark: SparkSession, args) -> int:
    df = synth.generate_loan_dataset(spark, args.rows, args.missing_rate, args.seed)
    (tables.write_csv if args.out.rstrip("/").endswith(".csv") else tables.write_parquet)(df, args.out)
    return 0


def _flow(spark: SparkSession, args) -> int:
    out = stages.run_flow(_read(spark, args.raw), args.workspace)
    shown = " ".join(f"{k}={v}" for k, v in out["metrics"].items())
    print(f"selected {out['best_model']}: {shown}")
    return 0


def _drift(spark: SparkSession, args) -> int:
    current = _read(spark, args.current)
    report = stages.check_drift(spark, args.profile, current, report_path=args.report)
    row = report.select("status", "max_psi").first()
    print(f"drift {row.status}, largest index {row.max_psi}")
    return 1 if args.fail_on_alert and row.status == "alert" else 0


def _rewrite(spark: SparkSession, args) -> int:
    name = args.table.rstrip("/").rsplit("/", 1)[-1]
    source = {name: tables.read_parquet(spark, args.table)}
    out, report = rewrite_tables(source, {name: args.column}, args.name, args.dry_run)
    for r in report.collect():  # one row per column
        print(f"{r.location}: {r.rows_changed} paths {'to cut' if args.dry_run else 'cut'}")
    if not args.dry_run:
        tables.write_parquet(out[name], args.out)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="adjudica.jobs", description=__doc__.splitlines()[0])
    sub = top.add_subparsers(dest="job", required=True)

    job = sub.add_parser("generate", help="write synthetic applications")
    job.add_argument("--rows", type=int, default=3000)
    job.add_argument("--missing-rate", type=float, default=0.04)
    job.add_argument("--seed", type=int, default=42)
    job.add_argument("--out", required=True)
    job.set_defaults(run=_generate)

    job = sub.add_parser("flow", help=f"run all stages over a raw table labelled by {TARGET_COLUMN}")
    job.add_argument("--raw", required=True)
    job.add_argument("--workspace", required=True)
    job.set_defaults(run=_flow)

    job = sub.add_parser("drift", help="compare a batch with a stored profile")
    job.add_argument("--profile", required=True)
    job.add_argument("--current", required=True)
    job.add_argument("--report")
    job.add_argument("--fail-on-alert", action="store_true")
    job.set_defaults(run=_drift)

    job = sub.add_parser("rewrite", help="cut path columns at a folder name")
    job.add_argument("--table", required=True)
    job.add_argument("--column", nargs="+", required=True)
    job.add_argument("--name", required=True)
    job.add_argument("--out", help="target folder; the source is never overwritten")
    job.add_argument("--dry-run", action="store_true")
    job.set_defaults(run=_rewrite)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.job == "rewrite" and not args.dry_run and not args.out:
        parser().error("rewrite needs --out unless --dry-run is given")
    spark = SparkSession.builder.appName(f"adjudica-{args.job}").getOrCreate()
    try:
        return args.run(spark, args)
    finally:
        drop_work(spark)


if __name__ == "__main__":
    sys.exit(main())
