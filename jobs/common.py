"""What the jobs share: their command line, their settings and their log."""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
from collections.abc import Callable
from dataclasses import fields
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

S = TypeVar("S")
log = logging.getLogger("jobs")


def settings(kind: type[S], path: str | None, **given: object) -> S:
    """A job's settings from its JSON file, under those given on the command line; a name that the job doesn't know is an error."""
    held: dict = {}
    if path:
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
    known = {f.name for f in fields(kind)}
    if odd := sorted(set(held) - known):
        raise ValueError(f"{path}: unknown settings {', '.join(odd)}; known are {', '.join(sorted(known))}")
    return kind(**held | {k: v for k, v in given.items() if v is not None})


def write_partitions(df: DataFrame, path: str, *by: str, whole: bool = False, **options: object) -> None:
    """df as Parquet, partitioned: replaces the partitions that df has rows of, or with `whole` all there are. Doing it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic").options(**options).partitionBy(*by).parquet(path)


def main(doc: str, config: str, kind: type[S], job: Callable[[SparkSession, str, str, S], dict], argv: list[str] | None = None) -> int:
    """Command line of a job: makes the session and stops it."""
    p = argparse.ArgumentParser(description=doc.splitlines()[0])
    p.add_argument("input", help="path of the documents table (Parquet), local or remote")
    p.add_argument("output", help="folder of the job's output")
    p.add_argument("--config", default=os.path.join(os.path.dirname(os.path.abspath(__file__)), config), help="settings (JSON); default: %(default)s")
    p.add_argument("--company", help="only companies whose name contains this")
    p.add_argument("--master", help="Spark master; default: that of spark-submit")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s", stream=sys.stderr)
    builder = SparkSession.builder.appName(config.partition(".")[0]).config("spark.sql.session.timeZone", "UTC")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    try:
        told = job(spark, a.input, a.output, settings(kind, a.config, company=a.company))
        print(json.dumps(told))
    finally:
        spark.stop()
    return 0
