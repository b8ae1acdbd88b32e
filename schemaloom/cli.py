"""Command line: migrate, validate, version."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import os
import signal
import sys

import schemaloom
from schemaloom import config as cfg

#: Flag, section.setting it overrides, kind.
FLAGS = (
    ("--registry-names", "aws.registry_names", "list"),
    ("--registry-all", "aws.registry_all", "flag"),
    ("--registry-exclude", "aws.registry_exclude", "list"),
    ("--schema-filter", "aws.schema_filter", "text"),
    ("--target-url", "confluent_cloud.url", "text"),
    ("--subject-strategy", "naming.subject_strategy", "text"),
    ("--context-mapping", "naming.context_mapping", "text"),
    ("--name-mapping-file", "naming.name_mapping_file", "text"),
    ("--version-strategy", "migration.version_strategy", "text"),
    ("--workers", "concurrency.workers", "int"),
    ("--checkpoint-file", "checkpoint.file", "text"),
    ("--report-file", "output.report_file", "text"),
    ("--resume", "checkpoint.resume", "flag"),
    ("--dry-run", "output.dry_run", "flag"),
    ("--log-level", "output.log_level", "text"),
)


#: Where a provider's key is looked for if the settings have none (fixed values).
PROVIDER_KEYS = {"openai": "OPENAI_API_KEY", "anthropic": "ANTHROPIC_API_KEY"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="schemaloom")
    sub = p.add_subparsers(dest="command", required=True)
    m = sub.add_parser("migrate", help="plan a migration and carry it out")
    m.add_argument("--config")
    source = m.add_mutually_exclusive_group(required=True)
    source.add_argument("--catalog", help="folder of the catalog's tables")
    source.add_argument("--registry-option", action="append", metavar="NAME=VALUE", help="read from a registry service, with this option of the data source; repeatable")
    for flag, _, kind in FLAGS:
        m.add_argument(flag, default=None, **({"action": "store_true"} if kind == "flag" else {"nargs": "*"} if kind == "list" else {"type": int} if kind == "int" else {}))
    v = sub.add_parser("validate", help="check a configuration file")
    v.add_argument("--config")
    sub.add_parser("version")
    return p


def merged(args: argparse.Namespace) -> cfg.Config:
    """The file's settings, with the flags that were given on top and keys from the environment."""
    c = cfg.load(args.config) if args.config else cfg.Config()
    for flag, path, _ in FLAGS:
        given = getattr(args, flag[2:].replace("-", "_"))
        if given is not None:
            section, _, name = path.partition(".")
            setattr(getattr(c, section), name, given)
    c.confluent_cloud.api_key = os.environ.get("CC_API_KEY", c.confluent_cloud.api_key)
    c.confluent_cloud.api_secret = os.environ.get("CC_API_SECRET", c.confluent_cloud.api_secret)
    if not c.llm.api_key and c.llm.provider in PROVIDER_KEYS:
        c.llm.api_key = os.environ.get(PROVIDER_KEYS[c.llm.provider], "")
    return c


def _stop(spark):
    """Interrupts end the run: the jobs under way are cancelled, the ledger keeps what was done."""

    def handle(number, frame):
        spark.sparkContext.cancelAllJobs()
        raise KeyboardInterrupt

    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, handle)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "version":
        print(schemaloom.__version__)
        return 0
    try:
        if args.command == "validate":
            cfg.check(cfg.load(args.config) if args.config else cfg.Config())
            print("configuration is valid")
            return 0
        c = cfg.check(merged(args))
    except cfg.ConfigError as e:
        print(e, file=sys.stderr)
        return 1
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stderr)]
    if c.output.log_file:
        handlers.append(logging.FileHandler(c.output.log_file))
    logging.basicConfig(level=c.output.log_level.upper(), handlers=handlers, force=True)
    from schemaloom.session import clean, local_session

    spark = local_session(c.concurrency.workers)
    _stop(spark)
    try:
        return migrate(spark, c, args)
    except KeyboardInterrupt:
        print("interrupted", file=sys.stderr)
        return 130
    finally:
        clean(spark)


def migrate(spark, c: cfg.Config, args: argparse.Namespace, make=None) -> int:
    """Plans, reports and, unless it is a dry run, executes; 1 if schemas failed."""
    from schemaloom.operators import catalog
    from schemaloom.plans import plan
    from schemaloom.sinks.registry import HttpTarget

    started = dt.datetime.now(dt.timezone.utc)
    cat = None
    if args.registry_option:
        options = dict(o.split("=", 1) for o in args.registry_option)
        given = {"calls_per_second": str(c.concurrency.aws_rate_limit), "parallel": str(c.concurrency.workers), "schema_filter": c.aws.schema_filter, "region": c.aws.region, "profile": c.aws.profile, "access_key_id": c.aws.access_key_id, "secret_access_key": c.aws.secret_access_key}
        cat = catalog.from_registry(spark, {k: v for k, v in given.items() if v} | options, () if c.aws.registry_all else c.aws.registry_names)
    p = plan.build(spark, args.catalog, c, catalog=cat)
    done = None
    if c.output.dry_run:
        plan.show(p)
    else:
        target = c.confluent_cloud
        done = plan.execute(spark, p, c, c.checkpoint.file or "ledger", make or (lambda: HttpTarget(target.url, target.api_key, target.api_secret)))
    if c.output.report_file:
        plan.write_report(p, c.output.report_file, "csv" if c.output.format == "csv" else "json", done, started, c.output.dry_run)
    n = plan.totals(p, done).first()
    print("dry run complete" if done is None else "completed with errors" if n["n_failed"] else "completed")
    print(f"duration {(dt.datetime.now(dt.timezone.utc) - started).total_seconds():.1f} s")
    for label, value in n.asDict().items():
        print(f"{label.removeprefix('n_')} {value}")
    if n["n_failed"]:
        done.where("not ok").show(50, truncate=False)
    return 1 if n["n_failed"] else 0


if __name__ == "__main__":
    sys.exit(main())
