"""Command line for scheduled runs (one ``spark-submit`` per step, or all steps at once).

    python -m estatelake.cli feed   --csv /data/listings.csv --inbox /data/inbox   # or --kafka host:9092 --topic t
    python -m estatelake.cli bronze --root s3a://bucket/lake --kafka host:9092 --topic t
    python -m estatelake.cli silver --root /data/lake [--silver-mode stream|state|new_only|reappend]
    python -m estatelake.cli gold   --root /data/lake [--jdbc-url jdbc:postgresql://... --jdbc-user u]
    python -m estatelake.cli compact --root /data/lake     # few files per district of silver again
    python -m estatelake.cli run    --root /data/lake --inbox /data/inbox
    python -m estatelake.cli sql    --root /data/lake "SELECT * FROM mart_avg_price_by_rooms"

Every setting is an argument (no environment files); ``--input-bytes`` with ``--cores`` sizes the
partitions of the run, ``--s3-endpoint`` with its keys names an object store.  ``--gold-mode merge`` makes the marts from
the sums of the appends.  ``sql`` reads the marts written by ``gold``, and silver as ``silver_listings``, and prints the
columns, the first 20 rows and the total row count; a statement that takes more than ``--seconds`` is stopped.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from estatelake.plans.feed import SAMPLE_FRACTION, publish_from_csv
from estatelake.plans.pipeline import Layout, run_gold, run_pipeline, run_silver
from estatelake.plans.sqlapi import execute_sql, register
from estatelake.schemas import MART_TABLES
from estatelake.session import build_session, object_store_conf, scale_conf
from estatelake.sources.files import read_mart, read_silver
from estatelake.sources.messages import file_messages, kafka_messages
from estatelake.streaming.append_log import AppendLog
from estatelake.streaming.ingest import run_bronze


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="estatelake")
    p.add_argument("step", choices=["feed", "bronze", "silver", "gold", "run", "compact", "sql"])
    p.add_argument("statement", nargs="?", help="SQL text for the sql step")
    p.add_argument("--root", help="lake root (bronze/, silver/, gold/, checkpoints/)")
    p.add_argument("--inbox", help="folder of JSON-lines message files (offline source)")
    p.add_argument("--kafka", help="Kafka bootstrap servers")
    p.add_argument("--topic", help="Kafka topic")
    p.add_argument("--max-files-per-trigger", type=int, help="bound of a micro-batch of bronze and of silver")
    p.add_argument("--max-offsets-per-trigger", type=int, help="bound of a Kafka micro-batch")
    p.add_argument("--csv", help="listing CSV of the feed step")
    p.add_argument("--multiline", action="store_true", help="the CSV has line breaks inside quotes")
    p.add_argument("--fraction", type=float, default=SAMPLE_FRACTION, help="share of the CSV sent per run")
    p.add_argument("--seed", type=int, help="seed of the sample (default: a new one per run)")
    p.add_argument("--input-bytes", type=int, help="size of the input, for partition sizing")
    p.add_argument("--cores", type=int, help="cores of the cluster, for partition sizing")
    p.add_argument("--s3-endpoint")
    p.add_argument("--s3-access-key")
    p.add_argument("--s3-secret-key")
    p.add_argument("--lenient-ints", action="store_true", help="accept 2.0 for integer fields")
    p.add_argument("--silver-mode", default="stream", choices=["stream", "state", "new_only", "reappend"])
    p.add_argument("--max-files", type=int, default=8, help="files of a district above which compact rewrites it")
    p.add_argument("--gold-mode", default="full", choices=["full", "merge"])
    p.add_argument("--seconds", type=float, default=60.0, help="time limit of an SQL statement")
    p.add_argument("--exact-key", nargs="+", help="columns that tell CSV rows apart: the feed sends an exact share of them")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--jdbc-driver")
    return p


def _messages(spark: SparkSession, args: argparse.Namespace):
    if args.kafka:
        bound = args.max_offsets_per_trigger
        return kafka_messages(spark, args.kafka, args.topic, {"maxOffsetsPerTrigger": str(bound)} if bound else None)
    if args.inbox:
        return file_messages(spark, args.inbox, args.max_files_per_trigger)
    raise SystemExit("give --kafka/--topic or --inbox")


def _jdbc(args: argparse.Namespace) -> tuple[str | None, dict[str, str]]:
    props = {
        k: v
        for k, v in (("user", args.jdbc_user), ("password", args.jdbc_password), ("driver", args.jdbc_driver))
        if v
    }
    return args.jdbc_url, props


def _conf(args: argparse.Namespace) -> dict[str, str]:
    """Session settings that the arguments ask for."""
    conf: dict[str, str] = {}
    if args.input_bytes and args.cores:
        conf.update(scale_conf(args.input_bytes, args.cores))
    if args.s3_endpoint:
        conf.update(object_store_conf(args.s3_endpoint, args.s3_access_key, args.s3_secret_key))
    return conf


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    parser = _parser()
    args = parser.parse_intermixed_args(argv)
    if args.step != "feed" and not args.root:
        parser.error("--root is needed")
    spark = spark or build_session(app_name=f"estatelake-{args.step}", extra_conf=_conf(args))
    layout = Layout((args.root or "").rstrip("/"))
    out: dict = {"step": args.step}
    if args.step == "feed":
        if not args.csv or not (args.inbox or args.kafka):
            parser.error("give --csv, and --inbox or --kafka/--topic")
        sink = {"fmt": "text", "path": args.inbox} if args.inbox else {
            "fmt": "kafka", "bootstrap_servers": args.kafka, "topic": args.topic}
        publish_from_csv(spark, args.csv, fraction=args.fraction, seed=args.seed,
                         exact_key=args.exact_key, multiline=args.multiline, **sink)
    elif args.step == "bronze":
        run_bronze(_messages(spark, args), layout.bronze, layout.checkpoint("bronze"),
                   lenient_ints=args.lenient_ints)
    elif args.step == "silver":
        out.update(run_silver(spark, layout, args.silver_mode, args.max_files_per_trigger))
    elif args.step == "gold":
        url, props = _jdbc(args)
        out.update(run_gold(spark, layout, url, props, args.gold_mode))
    elif args.step == "run":
        url, props = _jdbc(args)
        out.update(run_pipeline(spark, _messages(spark, args), layout, args.silver_mode, url, props,
                                args.lenient_ints, args.max_files_per_trigger, args.gold_mode))
    elif args.step == "compact":
        out["files_replaced"] = AppendLog(spark, layout.silver).compact(args.max_files)
    elif args.step == "sql":
        if not args.statement:
            raise SystemExit("give the SQL text")
        register({name: read_mart(spark, layout.gold, name) for name in MART_TABLES})
        register({"silver_listings": read_silver(spark, layout.silver)})
        got = execute_sql(spark, args.statement, n=20, seconds=args.seconds)
        out.update({"error": got.error} if got.error else {"total_rows": got.total, "columns": got.columns, "rows": got.rows})
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
