"""A whole run over folders of files: list, resume, decode, both passes, write, organise, report. Every step is a plan over all companies at once."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import EngineConfig
from ..operators import ledger, locate, recover, verdict
from ..operators.locate import FILE
from ..sources import classifier, files as sources, paged
from ..sources.tables import discard, spread, stored
from . import passes

log = logging.getLogger("folioscope")


@dataclass(frozen=True)
class Adapters:
    """What the caller gives: bytes to page texts, a writer of page ranges, and a page classifier (None: no vision)."""

    decode: sources.Decoder = sources.pypdf_pages
    write: Callable[[str, int, int, str], None] = sources.pypdf_write
    oracle: classifier.PageOracle | None = None


def pending_files(listed: DataFrame, output_root: str, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Files without output and without a record of success of their content; only files without output are read for their hash."""
    spark = listed.sparkSession
    names = ledger.not_present(listed, sources.list_outputs(spark, output_root, config))
    return ledger.pending(paged.hashed(spread(names)), ledger.read(spark, f"{output_root}/{config.ledger_dir}"))


def _failed(pages: DataFrame) -> DataFrame:
    return pages.where("error is not null").select(*FILE, F.concat(F.lit("could_not_open_source|"), F.col("error")).alias("reason"))


def _saved(records: DataFrame, located: DataFrame, adapters: Adapters, root: str, name: str) -> DataFrame:
    """records, stored, after their sections have been written."""
    with_size = records.join(locate.page_counts(located), FILE, "left")
    return stored(sources.write_sections(spread(with_size), adapters.write, root), name)


def _tell(records: DataFrame, title: str) -> None:
    counts = ledger.action_histogram(records).collect()  # a row for each kind of action
    log.info("%s: %s", title, ", ".join(f"{r.action}={r.n}" for r in counts) or "nothing")


def run(spark: SparkSession, input_root: str, output_root: str, adapters: Adapters = Adapters(), company: str = "", dry_run: bool = False, config: EngineConfig = EngineConfig(), run_id: str | None = None) -> DataFrame:
    """Does what is still to do below input_root and returns the coverage report. Run again, it goes on where the last run ended.

    A dry run only appends what it would do. Files that can't be read, pages that can't be rendered and sections that can't be
    written are records of result error; they stop nothing.
    """
    run_id = run_id or time.strftime("%Y%m%d-%H%M%S-") + uuid.uuid4().hex[:6]
    book = f"{output_root}/{config.ledger_dir}"
    listed = stored(sources.companies(sources.list_files(spark, input_root, config=config), company), "listed")
    files = stored(pending_files(listed, output_root, config).select("company", "source_pdf", "stem", "bytes", "source_hash"), "files")
    empty = stored(sources.companies_without_files(spark, input_root, listed, company), "empty")
    log.info("run %s: %s companies, %s without files, %s files to do%s", run_id, listed.select("company").distinct().count() + empty.count(), empty.count(), files.count(), ", dry run" if dry_run else "")
    if not dry_run:
        empty.orderBy("company").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{output_root}/{config.empty_dir}")
    discard(empty)

    pages = stored(sources.read_pages(files, adapters.decode), "pages")
    texts = pages.where("page is not null").select("company", "source_pdf", "page", "text")
    located = stored(verdict.judged(texts, config).select(*verdict.LOCATING), "judged")
    first = passes.pass1(files, located, config, dry_run).join(_failed(pages), FILE, "left").withColumn("evidence", F.coalesce("reason", "evidence")).drop("reason")
    first = _saved(first, located, adapters, output_root, "pass1")
    ledger.append(first, book, f"{run_id}-1")
    _tell(first, "pass 1")

    plan = stored(passes.pass2_plan(first, located, config, ledger.read(spark, book).where(F.col("run_id") != f"{run_id}-1") if config.use_ledger_consensus else None), "plan")
    replies = None
    if adapters.oracle is not None:
        wanted = plan.where("pass1_action = 'DEFER_VISION' or evidence").select(*FILE, "n_pages", recover.sample_pages(F.col("ws"), F.col("we"), F.col("centre"), config).alias("pages"))
        replies = stored(classifier.ask_files(wanted if not dry_run else wanted.limit(0), adapters.oracle, config, config.ask_tasks), "replies")
        used = sorted(map(tuple, classifier.usage(replies).collect()))  # a row for each key and outcome
        log.info("calls by key and outcome: %s", ", ".join(f"{k} {o}={n}" for k, o, n in used) or "none")
    second = _saved(passes.pass2(plan, files, replies, config, dry_run), located, adapters, output_root, "pass2")
    ledger.append(second, book, f"{run_id}-2")
    _tell(second, "pass 2")

    if not dry_run:
        outputs = sources.list_outputs(spark, output_root, config)
        missing = ledger.to_organise(listed, ledger.read(spark, book), outputs.where("kind = 'copy'").select("company", F.col("name").alias("stem")))
        target = F.concat_ws("/", F.lit(output_root), "company", F.lit(config.missing_dir), F.element_at(F.split("source_pdf", "/"), -1))
        copied = stored(sources.copy_files(missing.select(F.col("source_pdf").alias("source"), target.alias("target"))), "copied")
        log.info("copied without section: %s", {r.status: r.n for r in copied.groupBy(F.regexp_replace("status", ":.*", "").alias("status")).agg(F.count("*").alias("n")).collect()})
    report = coverage(spark, listed, output_root, config)
    if not dry_run:
        report = stored(report, "coverage")
        ledger.write_coverage(report, f"{output_root}/{config.report_dir}")
    totals = ledger.coverage_totals(report).first()
    log.info("coverage: %s present, %s missing", totals.n_present, totals.n_missing)
    discard(files, pages, located, first, plan, second, *([replies] if replies is not None else []), *([listed, copied] if not dry_run else []))
    return report


def coverage(spark: SparkSession, files: DataFrame, output_root: str, config: EngineConfig = EngineConfig()) -> DataFrame:
    """The report on all sections that are there, whichever run or pass wrote them."""
    outputs = sources.list_outputs(spark, output_root, config).where("kind = 'section'")
    return ledger.coverage(files, outputs.select("company", "year", "path"), config)
