"""Command line for the ingestion jobs (for spark-submit or a scheduler).

    python -m weir sensor-stream --bootstrap kafka:9092 --topic sensor_metrics \
        --table s3a://wh/sensor_metrics --checkpoint s3a://wh/_ck/sensor [--trigger "10 seconds"]
    python -m weir sensor-stream --topic-files /landing/sensor --table ... --checkpoint ...
    python -m weir weather-load --path s3a://weather/ --url jdbc:... --table default.weather [--core-only]
    python -m weir records-refresh --path /landing/posts --csv /landing/posts_csv --url jdbc:... --table public.test
    python -m weir land --source /landing/raw.json --column payload --path s3a://weather/raw

JDBC credentials come from ``--driver``, ``--user`` and ``--password-env``
(the name of an environment variable holding the password).
"""

from __future__ import annotations

import argparse
import os
import sys

from weir.session import build_session


def _jdbc_conn(args: argparse.Namespace) -> dict:
    conn = {}
    if args.driver:
        conn["driver"] = args.driver
    if args.user:
        conn["user"] = args.user
    if args.password_env:
        conn["password"] = os.environ[args.password_env]
    return conn


def _add_jdbc(p: argparse.ArgumentParser) -> None:
    p.add_argument("--url", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--driver")
    p.add_argument("--user")
    p.add_argument("--password-env")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="weir")
    sub = ap.add_subparsers(dest="command", required=True)

    s = sub.add_parser("sensor-stream", help="sensor messages -> flattened, valid rows -> table")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--bootstrap", help="Kafka bootstrap servers")
    src.add_argument("--topic-files", help="directory of Kafka-shaped Parquet files")
    s.add_argument("--topic", default="sensor_metrics")
    s.add_argument("--max-offsets-per-trigger", type=int)
    s.add_argument("--files-per-trigger", type=int)
    s.add_argument("--bytes-per-trigger", type=int)
    s.add_argument("--table", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--log")
    s.add_argument("--trigger", default="availableNow",
                   help='"availableNow" (default) or an interval such as "10 seconds"')

    w = sub.add_parser("weather-load", help="weather documents -> flat columns -> JDBC append")
    w.add_argument("--path", required=True)
    w.add_argument("--core-only", action="store_true")
    _add_jdbc(w)

    r = sub.add_parser("records-refresh", help="JSON records -> CSV -> rename -> full refresh")
    r.add_argument("--path", required=True)
    r.add_argument("--csv", required=True)
    _add_jdbc(r)

    land = sub.add_parser("land", help="replace a raw landing with the payloads of a JSON-lines source")
    land.add_argument("--source", required=True)
    land.add_argument("--column", default="payload")
    land.add_argument("--path", required=True)
    return ap


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    spark = spark or build_session(f"weir-{args.command}")
    from weir import sources
    from weir.plans import ingest
    from weir.schemas import WEATHER_DOCUMENT, WEATHER_DOCUMENT_TYPED_TIME

    if args.command == "sensor-stream":
        if args.bootstrap:
            messages = sources.read_kafka_stream(spark, args.bootstrap, args.topic,
                                                 max_offsets_per_trigger=args.max_offsets_per_trigger)
        else:
            messages = sources.stream_topic_files(spark, args.topic_files, args.files_per_trigger, args.bytes_per_trigger)
        query = ingest.sensor_stream_to_table(messages, args.table, args.checkpoint,
                                              log_path=args.log, trigger=args.trigger)
        query.awaitTermination()
    elif args.command == "weather-load":
        schema = WEATHER_DOCUMENT_TYPED_TIME if args.core_only else WEATHER_DOCUMENT
        ingest.weather_to_jdbc(spark, args.path, args.url, args.table, schema=schema,
                               core_only=args.core_only, **_jdbc_conn(args))
    elif args.command == "records-refresh":
        report = ingest.refresh_records(spark, args.path, args.csv, args.url, args.table, **_jdbc_conn(args))
        row = report.first()
        print(f"loaded rows={row['rows']} columns={row['columns']} unreadable={row['null_rows']}")
    elif args.command == "land":
        # declared as text: no pass to infer types, and an object stays the text it is
        payloads = spark.read.schema(f"`{args.column}` string").json(args.source)
        landed = ingest.land_payloads(payloads, args.path, [args.column])
        print("landed" if landed else "nothing to land")
    return 0


if __name__ == "__main__":
    sys.exit(main())
