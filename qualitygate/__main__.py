"""Jobs for spark-submit: ``python -m qualitygate loop ...`` and ``python -m qualitygate export ...``."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from qualitygate.operators.checks import check_statuses
from qualitygate.operators.evaluators import Evaluator, ExpressionEvaluator, get_evaluator
from qualitygate.operators.gate import OPEN
from qualitygate.plans.loop import run_loop
from qualitygate.sources import MetricsLog, export_all, read_table
from qualitygate.spec import Options, dataset_names, get_dataset


def load_evaluator(text: str) -> Evaluator:
    """A JSON file of SQL expressions, ``module:object``, or a registered name."""
    if text.endswith(".json"):
        return ExpressionEvaluator(**json.loads(Path(text).read_text()))
    if ":" in text:
        module, name = text.split(":", 1)
        return getattr(importlib.import_module(module), name)
    return get_evaluator(text)


def loop(spark: SparkSession, args: argparse.Namespace) -> int:
    spec = get_dataset(args.dataset)
    options = Options(
        sample_rate=args.rate, drift_threshold=args.drift_threshold, quality_floor=args.quality_floor, review_k=args.review_k,
        max_rejected=args.max_rejected,
    )
    result = run_loop(
        read_table(spark, spec, args.table),
        spec,
        load_evaluator(args.evaluator),
        MetricsLog(spark, args.log),
        args.baseline,
        args.candidate,
        as_of=F.lit(args.as_of).cast("date") if args.as_of else None,
        options=options,
        rejects=args.rejects,
        skip_scored=args.skip_scored,
        slices=args.slices,
        tie_break=args.tie_break,
    )
    labels = spark.read.parquet(args.labels) if args.labels else None
    tables = {
        "report": check_statuses(result.report),
        "decisions": result.decisions,
        "review": result.review(),
        "metrics": result.metrics(labels),
        "trend": result.trend(),
        "history": result.history(),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        print(f"{name}: {spark.read.parquet(f'{args.out}/{name}').count()} rows -> {args.out}/{name}")
    return 1 if result.decisions.filter(F.col("state") == OPEN).limit(1).count() else 0


def export(spark: SparkSession, args: argparse.Namespace) -> int:
    spec = get_dataset(args.dataset)
    counts = export_all({spec.name: (spec, read_table(spark, spec, args.table))}, args.out)
    for name, (n_rows, drifted) in counts.items():
        print(f"{name}: {n_rows} rows, {drifted} changed columns -> {args.out}")
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="qualitygate", description="Status 1 means that a version is blocked.")
    jobs = top.add_subparsers(required=True)
    defaults = Options()

    one = jobs.add_parser("loop", help="check, score, append, decide")
    one.set_defaults(job=loop)
    one.add_argument("--log", required=True, help="folder of the metrics log")
    one.add_argument("--evaluator", required=True, help="answers.json, module:object or a registered name")
    one.add_argument("--baseline", default="v1")
    one.add_argument("--candidate", nargs="+", default=["v2"])
    one.add_argument("--as-of", help="day to measure freshness from; today by default")
    one.add_argument("--rate", type=float, default=defaults.sample_rate)
    one.add_argument("--drift-threshold", type=float, default=defaults.drift_threshold)
    one.add_argument("--quality-floor", type=float, default=defaults.quality_floor)
    one.add_argument("--review-k", type=int, default=defaults.review_k)
    one.add_argument("--rejects", help="folder for rows that cannot be scored; without it they end the job")
    one.add_argument("--skip-scored", action="store_true", help="leave out keys the log already has")
    one.add_argument("--max-rejected", type=float, default=defaults.max_rejected, help="share of rows that may stay unscored")
    one.add_argument("--slices", type=int, default=1)
    one.add_argument("--tie-break", nargs="*", default=[], help="columns that say which row of equal keys comes first")
    one.add_argument("--labels", help="Parquet folder of human labels: row_id, deployment_version, is_good")
    one.add_argument("--out", required=True, help="folder for the tables of the loop, each written whole as Parquet")

    two = jobs.add_parser("export", help="write the table and its drift manifest as CSV and JSON")
    two.set_defaults(job=export)
    two.add_argument("--out", required=True)

    for job in (one, two):
        job.add_argument("--dataset", default="tickets", help=f"one of: {', '.join(dataset_names())}")
        job.add_argument("--table", required=True, help="folder of the data table")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("qualitygate").getOrCreate()
    return args.job(spark, args)


if __name__ == "__main__":
    sys.exit(main())
