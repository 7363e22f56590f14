"""Command line for spark-submit: one run, or one part of it.

    python -m dailybars all --root hdfs:///data/bars --landing hdfs:///landing --as-of 2024-01-31
"""

from __future__ import annotations

import argparse
import json
from datetime import date

from pyspark.sql import SparkSession

from dailybars.plans.etl import run_etl
from dailybars.plans.forecasts import run_forecast
from dailybars.plans.full import run_all, store_for
from dailybars.plans.models import run_models
from dailybars.session import REQUIRED_CONF, scale_conf
from dailybars.settings import METHODS, SNAPSHOT_STRATEGIES, Settings


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="dailybars")
    parser.add_argument("part", choices=["etl", "forecast", "models", "all"])
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--landing", help="folder of the landed bars")
    parser.add_argument("--format", default="records", help="records, parquet, orc, csv or json")
    parser.add_argument("--as-of", required=True, type=date.fromisoformat)
    parser.add_argument("--variables", type=json.loads, default={}, help="run variables as JSON")
    parser.add_argument("--all-symbols", action="store_true")
    parser.add_argument("--method", choices=METHODS, default="trend")
    parser.add_argument("--business-days", action="store_true")
    parser.add_argument("--strict-replace", action="store_true")
    parser.add_argument("--snapshot-strategy", choices=SNAPSHOT_STRATEGIES, default="timestamp")
    parser.add_argument("--incremental", action="store_true")
    parser.add_argument("--lenient", action="store_true", help="leave out and count rows that do not fit")
    parser.add_argument("--legacy-final", action="store_true", help="older column names of the final views")
    parser.add_argument("--landed-since", type=date.fromisoformat, help="open only what landed from that day on")
    parser.add_argument("--shuffled-bytes", type=int, help="size of the largest shuffle; sets partition counts")
    parser.add_argument("--cores", type=int, default=8, help="cores of the cluster, with --shuffled-bytes")
    args = parser.parse_args(argv)
    if args.part in ("etl", "all") and not args.landing:
        parser.error(f"{args.part} needs --landing")
    return args


def settings_of(args: argparse.Namespace) -> Settings:
    more = {"symbols": None} if args.all_symbols else {}
    return Settings.from_variables(
        args.variables,
        args.as_of,
        method=args.method,
        business_days=args.business_days,
        strict_replace=args.strict_replace,
        snapshot_strategy=args.snapshot_strategy,
        lenient=args.lenient,
        legacy_final=args.legacy_final,
        **more,
    )


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    settings = settings_of(args)
    spark = SparkSession.builder.appName(f"dailybars {args.part}").getOrCreate()
    conf = scale_conf(args.shuffled_bytes, args.cores) if args.shuffled_bytes else REQUIRED_CONF
    for key, value in conf.items():
        spark.conf.set(key, value)
    store = store_for(spark, args.root, settings)
    since = settings.ingest_start if args.incremental and store.exists("stock_summary") else None
    if args.part == "etl":
        result = run_etl(store, settings, args.landing, args.format, args.landed_since)
        print(f"loaded {result.n_rows} rows")
    elif args.part == "forecast":
        run_forecast(store, settings).groupBy("stage", "status").count().show()
    elif args.part == "models":
        print(*run_models(store, settings, since), sep="\n")
    else:
        result = run_all(store, settings, args.landing, args.format, args.incremental, args.landed_since)
        print(f"loaded {result.loaded} rows")
        print(*result.checks, sep="\n")
        result.outcomes.groupBy("stage", "status").count().show()


if __name__ == "__main__":
    main()
