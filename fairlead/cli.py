"""``python -m fairlead.cli process | validate | stats | download``"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession

from fairlead.config import Config
from fairlead.operators.catalog import catalog_stats
from fairlead.plans.runs import process
from fairlead.sources import sinks, store
from fairlead.sources.downloads import download_range

log = logging.getLogger(__name__)


def session() -> SparkSession:
    return SparkSession.builder.appName("fairlead").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def show(title: str, data: dict) -> None:
    print(title)
    for k, v in data.items():
        print(f"  {k}: {v:.2f}" if isinstance(v, float) else f"  {k}: {v}")


def options() -> argparse.ArgumentParser:
    """Names of commands and options are fixed values."""
    parser = argparse.ArgumentParser(prog="fairlead", description="Clean vessel positions into tracks.")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("process", help="clean the pending raw files")
    run.add_argument("--resume", "-r", action="store_true", help="go on where the last run ended")
    run.add_argument("--reset", action="store_true", help="start anew, even with --resume")
    run.add_argument("--max-files", "-n", type=int, default=None)
    run.add_argument("--output-stats", "-o", dest="report", help="also write the result to this JSON file")
    audit = commands.add_parser("validate", help="audit the sizes of the written files")
    audit.add_argument("--input", "-i", help="another folder than the settings' clean_dir")
    audit.add_argument("--report", "-r", help="also write the result to this JSON file")
    stats = commands.add_parser("stats", help="statistics of the track catalog")
    stats.add_argument("--output", "-o", dest="report", help="also write the result to this JSON file")
    fetch = commands.add_parser("download", help="fetch the published files of a date range")
    fetch.add_argument("--start", type=date.fromisoformat, required=True)
    fetch.add_argument("--end", type=date.fromisoformat, required=True)
    fetch.add_argument("--base-url", required=True)
    fetch.add_argument("--force", action="store_true", help="also fetch files that are there")
    for c in (run, audit, stats, fetch):
        c.add_argument("--config", "-c", default="config/production.yaml")
    return parser


def audit(spark: SparkSession, folder: str) -> dict:
    """The report of ``validate``: how many files, and the sizes of the first ones by path."""
    sizes = sinks.parquet_sizes(spark, folder)
    first = [r["size_mb"] for r in sizes.orderBy("path").limit(sinks.AUDITED).collect()]
    for size in first:
        if not sinks.SMALL_MB <= size <= sinks.LARGE_MB:
            log.warning("a file of %.1f MB, outside %d to %d", size, sinks.SMALL_MB, sinks.LARGE_MB)
    return sinks.audit_sizes(sizes).first().asDict() | {"file_sizes_mb": first}


def main(args: list[str] | None = None) -> int:
    given = options().parse_args(args)
    config, spark = Config.load(given.config), session()
    clean_dir = config.path("clean_dir")
    if given.command == "download":
        got, skipped = download_range(spark, given.base_url, config.path("raw_dir"), given.start, given.end, given.force)
        show("download", {"downloaded": got, "skipped": skipped})
        return 0
    if given.command == "process":
        result = process(spark, config, resume=given.resume and not given.reset, max_files=given.max_files)
    elif given.command == "validate":
        folder = given.input or clean_dir
        result = audit(spark, folder) if store.files(spark, folder, ".parquet") else {"error": f"no Parquet files under {folder}"}
    else:
        path = f"{clean_dir}/{sinks.CATALOG}"
        result = catalog_stats(spark.read.parquet(path)).first().asDict() if store.exists(spark, path) else {"error": f"no catalog at {path}; run process first"}
    show(given.command, result)
    if given.report and "error" not in result:
        Path(given.report).parent.mkdir(parents=True, exist_ok=True)
        Path(given.report).write_text(json.dumps(result, indent=2), encoding="utf-8")
    return 1 if "error" in result else 0


if __name__ == "__main__":
    sys.exit(main())
