"""Command line: check the configuration, preview a selection, or build, from the host or from landed pages and archives."""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import load_config
from ..shipping import ship
from ..sources import archives, host, search
from ..state import transitions
from ..state.snapshots import Snapshots
from . import build as plans


def setup_logging(level: str, work_dir: str | None = None) -> logging.Logger:
    """Messages on the console, and in a file of the work folder where that is the driver's own."""
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    scheme, _, path = work_dir.partition("://") if work_dir and "://" in work_dir else ("file", "", work_dir)
    if path and scheme == "file":
        Path(path).mkdir(parents=True, exist_ok=True)
        handlers.append(logging.FileHandler(Path(path) / "sievecraft.log", encoding="utf-8"))
    logger = logging.getLogger("sievecraft")
    logger.setLevel(level)
    logger.propagate = False
    for old in list(logger.handlers):
        logger.removeHandler(old)
        old.close()
    for handler in handlers:
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        logger.addHandler(handler)
    return logger


def landed_files(spark: SparkSession, folder: str, cfg):
    """The files of archives landed as <owner>__<name>.zip or .tar.*, for ``build``."""

    def of(selected: DataFrame) -> DataFrame:
        f = cfg.file_filter
        found = archives.read_archives(spark, folder, archives.admitting(f.extensions, f.ignore_directories))
        name = F.regexp_replace(F.regexp_extract("archive", r"([^/]+?)(\.zip|\.tar(\.[a-z0-9]+)?|\.tgz)$", 1), "__", "/")
        return archives.decode(found.withColumn("repository", name)).select("repository", "ord", "file_path", "size", "text")

    return of


def searched(spark: SparkSession, cfg) -> tuple[DataFrame, DataFrame]:
    """The hits of the queries that are not exhausted, from where the last run ended, and the progress after them."""
    stored = Snapshots(spark, cfg.output.state_file).read()["query_progress"]
    at = {q.name: transitions.progress(stored, q.name, q.query) for q in cfg.github.queries}
    open_ = replace(cfg.github, queries=tuple(q for q in cfg.github.queries if not at[q.name][1]))
    rows = plans.landed(search.search(spark, open_, {k: page for k, (page, _) in at.items()}), f"{cfg.runtime.work_dir}/landed/search")
    return rows, search.progress(rows, open_)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sievecraft", description="Build a source-code corpus.")
    parser.add_argument("-c", "--config", default="config.yaml")
    parser.add_argument("--dry-run", action="store_true", help="check the configuration only")
    parser.add_argument("--preview", action="store_true", help="show what would be selected; write nothing")
    parser.add_argument("--pages", help="a dump of search results (JSON lines); else the service is asked")
    parser.add_argument("--archives", help="a folder of landed archives; else they are fetched")
    args = parser.parse_args(argv)
    try:
        cfg = load_config(args.config)
    except (OSError, ValueError) as e:
        print(f"Configuration error: {e}", file=sys.stderr)
        return 2
    log = setup_logging(cfg.runtime.log_level, cfg.runtime.work_dir)
    if cfg.github.token() is None:
        log.warning("%s is not set; requests go without authentication", cfg.github.token_env)
    if args.dry_run:
        log.info("the configuration is good")
        return 0
    try:
        spark = SparkSession.builder.appName("sievecraft").getOrCreate()
        ship(spark)
        rows, progress = (search.read_dump(spark, args.pages), None) if args.pages else searched(spark, cfg)
        hits = search.hits(rows)
        if args.preview:
            chosen, counts = plans.preview(hits, Snapshots(spark, cfg.output.state_file).read(), cfg)
            chosen.show(1000, truncate=False)
            print(counts)
            return 0
        fetched = landed_files(spark, args.archives, cfg) if args.archives else lambda selected: host.fetch_files(selected, cfg)
        run = plans.build(spark, cfg, hits, fetched, progress)
        print(run.stats)
        run.release()
        return 0
    except KeyboardInterrupt:
        return 130
    except Exception:
        log.exception("the run failed")
        return 1
