"""The command: python -m folioscope INPUT OUTPUT [--company PART] [--skip-vision] [--dry-run].

Exit codes: 0 done, 1 no input folder, 4 no usable key for vision, 130 interrupted.
"""

from __future__ import annotations

import argparse
import importlib
import logging
import sys
import time
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .plans import flow
from .sources import classifier, files


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="folioscope", description="Finds sections in folders of paged documents, one folder a company.")
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--company", default="", help="only companies whose name contains this")
    p.add_argument("--skip-vision", action="store_true", help="don't ask the page classifier")
    p.add_argument("--dry-run", action="store_true", help="say what would be done, write no section or copy")
    p.add_argument("--decode", default="folioscope.sources.files:pypdf_pages", help="module:function from bytes to page texts")
    p.add_argument("--write", default="folioscope.sources.files:pypdf_write", help="module:function that writes pages of a file")
    p.add_argument("--oracle", default="", help="module:function that judges a page; else a model is asked about its image")
    return p.parse_args(argv)


def _named(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


class _Lines(logging.Handler):
    """Keeps the run's log, which goes to the output folder at the end."""

    def __init__(self):
        super().__init__()
        self.setFormatter(logging.Formatter("%(asctime)s  %(levelname)-8s  %(message)s", "%H:%M:%S"))
        self.lines: list[str] = []

    def emit(self, record: logging.LogRecord) -> None:
        self.lines.append(self.format(record))

    def write(self, spark: SparkSession, path: str) -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop)
        out.write(bytearray("\n".join([*self.lines, ""]).encode()))
        out.close()


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = arguments(argv)
    spark = spark or SparkSession.builder.appName("folioscope").getOrCreate()
    lines, log = _Lines(), logging.getLogger("folioscope")
    log.setLevel(logging.INFO)
    if not log.handlers:
        log.addHandler(logging.StreamHandler())
    log.addHandler(lines)
    try:
        if not files.exists(spark, a.input):
            log.error("no input folder: %s", a.input)
            return 1
        oracle = None
        if not a.skip_vision and a.oracle:
            oracle = _named(a.oracle)
        elif not a.skip_vision:
            keys = classifier.usable_keys()
            if not keys:
                log.error("no usable key for vision; set one or pass --skip-vision")
                return 4
            oracle = classifier.ImageOracle(keys)
        try:
            flow.run(spark, a.input, a.output, flow.Adapters(_named(a.decode), _named(a.write), oracle), a.company, a.dry_run)
        except KeyboardInterrupt:
            log.warning("interrupted; what the ledger holds is kept")
            return 130
        lines.write(spark, f"{a.output}/run_log_{time.strftime('%Y%m%d_%H%M%S')}.txt")
        return 0
    finally:
        log.removeHandler(lines)


if __name__ == "__main__":
    sys.exit(main())
