"""Command line of the lake jobs.

    python -m shoreline <job> --lake <folder> [--date YYYY-MM-DD] [options]

The date comes from ``--date``, else from PROCESSING_DATE, else it is yesterday (UTC).
"""

from __future__ import annotations

import argparse
import os

from shoreline import schemas
from shoreline.plans import daily, quality
from shoreline.session import build_session, size_session
from shoreline.sources.drops import land_drop
from shoreline.sources.lake import Lake, read_all
from shoreline.streaming.ingest import start_raw_ingest
from shoreline.streaming.lateness import Lateness
from shoreline.streaming.rolling import RollPolicy, roll_all
from shoreline.streaming.records import file_records, kafka_records


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shoreline")
    parser.add_argument("job", choices=[
        "ingest", "roll", "vacuum", "land", "late", "silver", "gold", "day", "load", "validate", "verify"])
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    parser.add_argument("--date", default=os.environ.get("PROCESSING_DATE"))
    parser.add_argument("--domain", nargs="+", choices=list(schemas.DOMAINS), help="for silver")
    parser.add_argument("--kpi", nargs="+", choices=list(schemas.KPIS), help="for gold")
    parser.add_argument("--allow-missing", action="store_true", help="absent input is no failure")
    parser.add_argument("--wide", action="store_true", help="the wide form of the tables")
    parser.add_argument("--retention-days", type=int, default=1)
    parser.add_argument("--input-bytes", type=int, help="size of the input, for partitioning")
    parser.add_argument("--kafka", help="bootstrap servers, for ingest")
    parser.add_argument("--files", help="folder of topic=<name> folders, for ingest")
    parser.add_argument("--checkpoint", help="checkpoint folder, for ingest")
    parser.add_argument("--available-now", action="store_true", help="ingest what is there, stop")
    parser.add_argument("--history", action="store_true", help="retention by first days ever")
    parser.add_argument("--late-to-dead-letter", action="store_true", help="keep late rows apart, for ingest")
    parser.add_argument("--roll", action="store_true", help="roll small files while ingesting")
    parser.add_argument("--keep-days", type=float, default=7, help="age of what vacuum deletes")
    parser.add_argument("--source", choices=list(schemas.BATCH_SOURCES), help="for land")
    parser.add_argument("--drop", help="path of the drop, for land")
    parser.add_argument("--drop-id", help="name of the drop, else its path, for land")
    parser.add_argument("--url", default=os.environ.get("SERVING_URL"), help="JDBC URL, for load and day")
    return parser


def main(argv: list[str] | None = None) -> int:
    """Run one job; the exit code tells whether checks passed."""
    given = _parser().parse_args(argv)
    spark = build_session(f"shoreline-{given.job}", input_bytes=given.input_bytes)
    lake = Lake(given.lake)
    date = given.date or daily.previous_day()
    if not given.input_bytes and given.job in ("silver", "gold", "day", "validate"):
        size_session(spark, *daily.read_by(spark, lake, date, given.wide, given.retention_days))
    properties = {"user": os.environ.get("SERVING_USER", ""),
                  "password": os.environ.get("SERVING_PASSWORD", "")}
    if given.job == "ingest":
        records = kafka_records(spark, given.kafka) if given.kafka else file_records(
            spark, given.files)
        running = start_raw_ingest(
            records, lake, given.checkpoint, available_now=given.available_now,
            policy=RollPolicy() if given.roll else None,
            lateness=Lateness() if given.late_to_dead_letter else None)
        running.awaitTermination()
    elif given.job == "roll":
        print(roll_all(spark, lake, schemas.RAW_SOURCES, [given.date] if given.date else None))
    elif given.job == "vacuum":
        daily.vacuum(spark, lake, given.keep_days * 86400)
    elif given.job == "land":
        land_drop(spark, given.drop, given.source, lake, date, given.drop_id)
    elif given.job == "silver":
        counts = daily.build_silver(
            spark, lake, date, given.wide, only=given.domain, allow_missing=given.allow_missing)
        quality.ledger(spark, counts).show()
    elif given.job == "gold":
        counts = daily.build_gold(
            spark, lake, date, given.wide, given.retention_days, given.kpi, given.allow_missing, given.history)
        quality.ledger(spark, counts).show()
    elif given.job == "day":
        serving = (given.url, properties) if given.url else None
        daily.run_day(
            spark, lake, date, given.wide, given.retention_days, serving, given.allow_missing, given.history).show()
    elif given.job == "late":
        for day, counts in daily.rebuild_late(
                spark, lake, wide=given.wide, retention_days=given.retention_days, history=given.history).items():
            print(day)
            quality.ledger(spark, counts).show()
    elif given.job == "load":
        print(daily.load_serving(spark, lake, date, given.url, properties))
    elif given.job == "validate":
        report = quality.collected(quality.validate_lake(spark, lake.wide if given.wide else lake, date))
        report.show(50, truncate=False)
        return 0 if quality.lake_verdict(report).first().passed else 1
    else:
        for kpi in schemas.KPIS:
            found = quality.attempt(lambda path=lake.kpi(kpi): read_all(spark, path))
            if not isinstance(found, str | None):
                quality.preview(found)
        report = quality.collected(quality.verify_gold(spark, lake))
        report.show(truncate=False)
        return 0 if quality.all_ok(report).first().passed else 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
