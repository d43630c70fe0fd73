"""Extracts the audit sections of an archive into a partitioned table, with a report of the years that have none.

Reads the documents table, pages it, judges every page, locates each file's section (first pass), searches deferred files by the
positions that the company's other files agree on (second pass, with `vision`), and writes below the output folder

- sections/company=.../: a row for each file, its decision and, where one was found, the section's pages as one text;
- coverage/company=.../: a row for each year of a company, present_clean or missing_extract;
- pages/: the pages' verdicts without texts, bucketed by file, which both passes read without a shuffle of their own.

A run over all companies replaces all output, a run with `company` only the partitions of the companies it read, so running
again gives the same result. Every company read has a row in sections for each of its files, so none of its partitions is stale.
"""

from __future__ import annotations

import logging
import sys
import uuid
from dataclasses import dataclass
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from folioscope.config import EngineConfig  # noqa: E402
from folioscope.functions import text as T  # noqa: E402
from folioscope.operators import ledger, locate, verdict  # noqa: E402
from folioscope.operators.locate import FILE  # noqa: E402
from folioscope.plans import passes  # noqa: E402
from folioscope.sources import corpus, files as sources  # noqa: E402
from folioscope.sources.tables import discard, spread, stored  # noqa: E402
from jobs.common import main, write_partitions  # noqa: E402

log = logging.getLogger("jobs.extract_sections")
#: Columns of the output tables; given when they are read, as they may be empty and partitions' names may look like numbers.
SECTIONS = "source_pdf string, source_hash string, year string, phase string, action string, result string, method string, evidence string, extract_page int, extract_end_page int, new_path string, text string, n_section_pages bigint, company string"
COVERAGE = "year string, status string, source_filename string, extract_path string, company string"


@dataclass(frozen=True)
class Settings:
    #: Only companies whose name contains this; empty: all.
    company: str = ""
    #: Whether deferred files are searched by the page classifier.
    vision: bool = True
    #: Buckets of the pages' verdicts; a bucket holds all pages of its files, and a task of either pass reads one. For a large archive, as many as make a bucket some 100 MB.
    buckets: int = 16


def _bucketed(pages: DataFrame, path: str, settings: Settings) -> tuple[DataFrame, str]:
    """pages written by file into buckets, as an external table of a name of its own; the table, and that name."""
    name = f"judged_{uuid.uuid4().hex}"
    # dealt as buckets are, so that each is one file
    pages.repartition(settings.buckets, *FILE).write.mode("overwrite").bucketBy(settings.buckets, *FILE).sortBy(*FILE).option("path", path).saveAsTable(name)
    return pages.sparkSession.table(name), name


def run(spark: SparkSession, documents: str, output: str, settings: Settings = Settings()) -> dict:
    """Does the job and returns how many rows it read and wrote."""
    config = EngineConfig()
    archive = sources.companies(corpus.active(corpus.files_of(spark.read.parquet(documents))), settings.company).where("source_pdf is not null")
    files = stored(archive.select(*FILE, "stem", T.content_hash(F.coalesce("text", F.lit(""))).alias("source_hash")), "files")
    pages = corpus.pages(spread(archive))
    judged, table = _bucketed(verdict.judged(pages, config).select(*verdict.LOCATING), f"{output}/pages", settings)
    try:
        first = stored(passes.pass1(files, judged, config), "pass1")
        replies = corpus.replies(archive.drop("text")) if settings.vision else None
        second = passes.pass2(passes.pass2_plan(first, judged, config), files, replies, config)
        # the second pass decides on what the first deferred
        decided = stored(first.where("result <> 'deferred'").unionByName(second), "decided")
        ranges = decided.where("result = 'ok'").select(*FILE, F.col("extract_page").alias("start"), F.col("extract_end_page").alias("end"))
        texts = locate.section_texts(ranges, pages, ranges.count()).withColumnRenamed("n_pages", "n_section_pages")
        rows = decided.drop("pass1_action").join(locate.met(texts), FILE, "left")
        whole = not settings.company
        write_partitions(rows.select(*(c.split()[0] for c in SECTIONS.split(", "))), f"{output}/sections", "company", whole=whole)
        report = ledger.coverage(files, decided.where("result = 'ok'").select("company", "year", F.col("new_path").alias("path")), config)
        write_partitions(report.select(*(c.split()[0] for c in COVERAGE.split(", "))), f"{output}/coverage", "company", whole=whole)
        told = {"files": files.count(), "pages": judged.count()} | {r["action"].lower(): r["n"] for r in decided.groupBy("action").agg(F.count("*").alias("n")).collect()}
        discard(first, decided)
    finally:
        spark.sql(f"drop table if exists {table}")  # the files stay
        discard(files)
    log.info("read %s files of %s pages from %s; wrote sections, coverage and pages to %s: %s", told["files"], told["pages"], documents, output, told)
    return told


def read_back(spark: SparkSession, output: str) -> DataFrame:
    """The output as one table: each file's decision, its section's size and hash, and its year's status."""
    sections = spark.read.schema(SECTIONS).parquet(f"{output}/sections")
    coverage = spark.read.schema(COVERAGE).parquet(f"{output}/coverage").select("company", "year", "status")
    return sections.join(coverage, ["company", "year"], "left").select("company", "source_pdf", "source_hash", "year", "phase", "action", "result", "method", "evidence", "extract_page", "extract_end_page", "new_path", "n_section_pages", F.sha2("text", 256).alias("text_sha256"), "status")


if __name__ == "__main__":
    sys.exit(main(__doc__, "extract_sections.json", Settings, run))
