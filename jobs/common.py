"""Settings and logging that the jobs share."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import sequence as S

log = logging.getLogger("strandloom.jobs")


def settings(defaults: Path, *more: dict) -> dict:
    """The values of a job's settings file, changed by each further dict; unknown names raise."""
    out = json.loads(defaults.read_text())
    for values in more:
        unknown = sorted(set(values) - set(out))
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        out |= {k: v for k, v in values.items() if v is not None}
    return out


def bases(column: str, letters: bool) -> Column:
    """The sequence in a column: its own symbols in upper case, or the bases that the letters of a text stand for."""
    return S.as_bases(column) if letters else F.upper(F.col(column).cast("string"))


def name_of(column: str) -> Column:
    """A name to partition by: blank and missing ones are ``unnamed``, as a folder cannot tell them apart."""
    c = F.trim(F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.when(c == "", "unnamed").otherwise(c)


def command(name: str, defaults: Path, run: Callable[[SparkSession, dict], dict], argv: list[str] | None = None) -> None:
    """``--config FILE`` and one option a setting; creates the session, runs the job, stops the session."""
    known = settings(defaults)
    parser = argparse.ArgumentParser(prog=name)
    parser.add_argument("--config", help="JSON file of settings")
    for k, v in known.items():
        parser.add_argument(f"--{k}", type=json.loads if isinstance(v, (bool, int, float)) else str)
    given = vars(parser.parse_args(argv))
    file = given.pop("config")
    values = settings(defaults, json.loads(Path(file).read_text()) if file else {}, given)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        run(spark, values)
    finally:
        spark.stop()
