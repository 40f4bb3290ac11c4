"""Command line for the jobs (``spark-submit -m clickweave.plans.cli ...`` or ``python -m``).

Subcommands mirror the reference's runnable jobs:

* ``provision``     - create the curated (and raw) databases and tables (K2, R4)
* ``batch``         - JSONL files -> curated tables, append, truncate or replace days (K1, K6, K7)
* ``page-views``    - message stream -> page views per window + alerts, raw landing (T1-T5, K3, K5, K8)
* ``live-ingest``   - message or file stream -> visits/events/purchase_items/rejects (K4, S7)

Streaming subcommands default to ``--trigger available-now`` (catch up and
stop, for scheduled runs); ``--trigger continuous-seconds N`` keeps running
with a processing-time trigger.
"""

from __future__ import annotations

import argparse
import json
import os

from clickweave.operators import extract
from clickweave.session import get_spark
from clickweave.sinks.tables import MODES
from clickweave.streaming import pageviews


def _trigger(args) -> dict:
    if args.trigger_seconds:
        return {"processingTime": f"{args.trigger_seconds} seconds"}
    return {"availableNow": True}


def _messages(spark, args):
    from clickweave.streaming import ingest

    if args.source == "kafka":
        return ingest.kafka_messages_stream(spark, args.bootstrap_servers, args.topic)
    return ingest.message_files_stream(spark, args.input)


def cmd_provision(spark, args) -> dict:
    from clickweave.sinks import tables

    return {"tables": tables.provision(spark, args.database)}


def cmd_batch(spark, args) -> dict:
    from clickweave.plans.batch import run_batch

    return run_batch(
        spark, args.input, database=args.database, mode=args.mode, profile=args.profile, glob=args.glob,
        min_partitions=args.min_partitions, land_raw_lines=args.land_raw, fanout=args.fanout, run_id=args.run_id, archive_dir=args.archive,
        skip_known=args.skip_known,
    )


def cmd_derive(spark, args) -> dict:
    from clickweave.plans.curate import derive

    return derive(spark, args.database, args.raw_database, version=args.decoder_version, profile=args.profile)


def cmd_publish(spark, args) -> dict:
    from clickweave.sinks import by_session

    state = by_session.publish(spark, args.database, args.buckets)
    return {"state": state, "dropped": by_session.drop_old(spark, args.database)}


def cmd_page_views(spark, args) -> dict:
    from clickweave.streaming import ingest

    ck = args.checkpoint.rstrip("/")
    queries = [
        ingest.start_page_views(
            _messages(spark, args), args.database, f"{ck}/page_views", window_minutes=args.window_minutes, threshold=args.threshold,
            watermark=args.watermark, trigger=_trigger(args),
        )
    ]
    if args.raw_output:
        queries.append(
            ingest.start_raw_landing(
                _messages(spark, args), args.raw_output, f"{ck}/raw_landing", num_shards=args.num_shards,
                trigger=_trigger(args),
            )
        )
    for q in queries:
        q.awaitTermination()
    return {"queries": len(queries)}


def cmd_live_ingest(spark, args) -> dict:
    from clickweave.sources.decode import parse_messages
    from clickweave.streaming import ingest

    if args.source == "files-jsonl":
        parsed = ingest.parse_file_stream(
            ingest.file_sessions_stream(spark, args.input, glob=args.glob, archive_dir=args.archive)
        )
    else:
        parsed = parse_messages(_messages(spark, args))
    q = ingest.start_live_ingest(parsed, args.database, args.checkpoint, profile=args.profile, trigger=_trigger(args), skip_known=args.skip_known)
    q.awaitTermination()
    return {"database": args.database}


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickweave")
    p.add_argument("--master", default=os.environ.get("CLICKWEAVE_MASTER"))
    sub = p.add_subparsers(dest="command", required=True)

    pr = sub.add_parser("provision")
    pr.add_argument("--database", default="curated")

    b = sub.add_parser("batch")
    b.add_argument("--input", required=True, help="folder or glob of JSONL session files")
    b.add_argument("--database", default="curated")
    b.add_argument("--mode", choices=list(MODES), default=MODES[0])
    b.add_argument("--profile", choices=list(extract.PROFILES), default=extract.BATCH)
    b.add_argument("--glob", default="*.jsonl")
    b.add_argument("--min-partitions", type=int, default=None)
    b.add_argument("--land-raw", action="store_true")
    b.add_argument("--run-id", default=None, help="the same id again replaces what that run wrote")
    b.add_argument("--archive", default=None, help="folder that the files go to after they are read")
    b.add_argument("--skip-known", action="store_true", help="leave out rows whose key another load has")
    b.add_argument("--fanout", choices=["checkpoint", "persist"], default="checkpoint")

    d = sub.add_parser("derive", help="decode what the raw zone has and the curated tables lack")
    d.add_argument("--database", default="curated")
    d.add_argument("--raw-database", default="raw")
    d.add_argument("--decoder-version", type=int, default=1, help="a higher one than before decodes everything again")
    d.add_argument("--profile", choices=list(extract.PROFILES), default=extract.BATCH)

    bs = sub.add_parser("publish", help="lay the curated tables out by session")
    bs.add_argument("--database", default="curated")
    bs.add_argument("--buckets", type=int, default=None)

    def stream_common(sp, *more):
        sp.add_argument("--source", choices=["kafka", "files-parquet", *more], default="kafka")
        sp.add_argument("--bootstrap-servers")
        sp.add_argument("--topic")
        sp.add_argument("--input", help="input folder for file sources")
        sp.add_argument("--checkpoint", required=True)
        sp.add_argument("--trigger-seconds", type=int, default=None)

    pv = sub.add_parser("page-views")
    stream_common(pv)
    pv.add_argument("--database", default="curated")
    pv.add_argument("--window-minutes", type=int, default=pageviews.DEFAULT_WINDOW_MINUTES)
    pv.add_argument("--threshold", type=int, default=pageviews.DEFAULT_DOS_THRESHOLD)
    pv.add_argument("--watermark", default="0 seconds")
    pv.add_argument("--raw-output", default=None)
    pv.add_argument("--num-shards", type=int, default=pageviews.DEFAULT_NUM_SHARDS)

    li = sub.add_parser("live-ingest")
    stream_common(li, "files-jsonl")
    li.add_argument("--database", default="curated")
    li.add_argument("--profile", choices=list(extract.PROFILES), default=extract.LIVE)
    li.add_argument("--glob", default="*.jsonl")
    li.add_argument("--archive", default=None)
    li.add_argument("--skip-known", action="store_true", help="leave out rows whose key another load has")
    return p


COMMANDS = {
    "provision": cmd_provision,
    "batch": cmd_batch,
    "derive": cmd_derive,
    "publish": cmd_publish,
    "page-views": cmd_page_views,
    "live-ingest": cmd_live_ingest,
}


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = build_parser().parse_args(argv)
    spark = spark or get_spark(args.master)
    result = COMMANDS[args.command](spark, args)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
