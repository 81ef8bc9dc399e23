"""Command line of the flows, for spark-submit.

    spark-submit run.py batch    --lake URI --source policies=URI --source claims=URI ...
    spark-submit run.py ingest   --lake URI --entity claims --source claims=URI
    spark-submit run.py clean    --lake URI --entity claims
    spark-submit run.py clean    --lake URI --entity claims --incremental   (new bronze files only)
    spark-submit run.py gold     --lake URI --table risk_features
    spark-submit run.py realtime --lake URI --events URI [--lateness "7 days"]
    spark-submit run.py alerts   --lake URI --out URI    (high-value events of the last hour)
    spark-submit run.py statuses --lake URI --out URI    (events per status of the last day)
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from smelter.contracts import load_contract
from smelter.entities import ENTITIES, REALTIME_CLAIMS, with_contract_files
from smelter.operators import monitor
from smelter.plans import batch, realtime
from smelter.session import Run, build_session
from smelter.sources.lake import Lake
from smelter.streaming.fanout import TABLE, TYPED_LAYER

GOLD = {
    "claims_features": batch.build_claims_features,
    "customer_features": batch.build_customer_features,
    "risk_features": batch.build_risk_features,
    "monthly_claims_summary": batch.build_monthly_summary,
}
QUERIES = {"alerts": monitor.high_value_alerts, "statuses": monitor.status_counts}


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="smelter")
    parser.add_argument("flow", choices=["batch", "ingest", "clean", "gold", "realtime", "alerts", "statuses"])
    parser.add_argument("--lake", required=True, help="root folder of the tables")
    parser.add_argument("--format", default="parquet", help="table format Spark knows")
    parser.add_argument("--database", help="catalog database for described tables")
    parser.add_argument("--contracts", help="folder with contract files")
    parser.add_argument("--input-bytes", type=int, help="input size, to size the shuffles by")
    parser.add_argument("--source", action="append", default=[], metavar="ENTITY=URI")
    parser.add_argument("--entity", choices=sorted(ENTITIES))
    parser.add_argument("--order", default="dedup_first", choices=["dedup_first", "validate_first"])
    parser.add_argument("--incremental", action="store_true", help="clean new bronze files only")
    parser.add_argument("--table", choices=sorted(GOLD))
    parser.add_argument("--events", help="folder of JSON event files, one event per line")
    parser.add_argument("--max-files", type=int, help="event files per micro-batch")
    parser.add_argument("--out", help="folder for a query's result, as JSON lines")
    parser.add_argument("--lateness", help="how long to remember claims; for ever if left out")
    args = parser.parse_args(argv)
    required = {"ingest": "entity", "clean": "entity", "gold": "table", "realtime": "events"}
    needs = {**required, **dict.fromkeys(QUERIES, "out")}.get(args.flow)
    if needs and not getattr(args, needs):
        parser.error(f"{args.flow} needs --{needs}")
    if args.incremental and args.order != "dedup_first":
        parser.error("--incremental keeps the newest row of a key, valid or not")
    args.sources = dict(s.split("=", 1) for s in args.source)
    if args.flow == "ingest" and args.entity not in args.sources:
        parser.error(f"ingest needs --source {args.entity}=URI")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(input_bytes=args.input_bytes)
    lake, run = Lake(args.lake, args.format, args.database), Run()
    entities = ENTITIES
    if args.contracts:
        entities = {n: with_contract_files(spark, e, args.contracts) for n, e in ENTITIES.items()}
    report = None
    if args.flow == "batch":
        report = batch.run_batch(spark, lake, args.sources, run, entities, args.incremental)
    elif args.flow == "ingest":
        report = batch.ingest(spark, lake, entities[args.entity], args.sources[args.entity], run)
    elif args.flow == "clean" and args.incremental:
        report = batch.clean_new(spark, lake, entities[args.entity], run)
    elif args.flow == "clean":
        report = batch.clean(spark, lake, entities[args.entity], run, args.order)
    elif args.flow == "gold":
        GOLD[args.table](spark, lake, run)
    elif args.flow in QUERIES:
        events = lake.read(spark, TYPED_LAYER, TABLE)
        QUERIES[args.flow](events).write.mode("overwrite").json(args.out)
    else:
        how = {"lateness": args.lateness, "max_files_per_batch": args.max_files}
        if args.contracts:
            file = f"{args.contracts.rstrip('/')}/silver/silver_claims_realtime.yaml"
            how["contract"] = load_contract(spark, file, on_missing="skip") or REALTIME_CLAIMS
        report = realtime.run_realtime(spark, lake, args.events, run, **how)
    if report is not None:
        print(json.dumps(report, default=float))
