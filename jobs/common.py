"""What the jobs share: config files, logging, a session of the command line's own."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

from strandmark.session import ensure_importable

LOG = logging.getLogger("strandmark.jobs")


def config_of(defaults: dict, given: dict | None) -> dict:
    """defaults overlaid by what is given; unknown keys are a fault, so that a misspelt threshold doesn't pass for the default."""
    given = given or {}
    if unknown := sorted(set(given) - set(defaults)):
        raise ValueError(f"unknown keys in the config: {unknown}")
    return defaults | given


def read_config(path: str | Path) -> dict:
    return json.loads(Path(path).read_text())


def command_line(name: str, about: str, config: Path, arguments: dict[str, str], run: Callable[[SparkSession, argparse.Namespace, dict], None], argv: list[str] | None = None) -> None:
    """Parses the arguments, starts a session, runs, and stops it."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=about)
    for argument, what in arguments.items():
        parser.add_argument(f"--{argument}", required=True, help=what)
    parser.add_argument("--config", default=str(config), help="a JSON file (default: the one beside the job)")
    given = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        ensure_importable(spark)
        run(spark, given, read_config(given.config))
    finally:
        spark.stop()
