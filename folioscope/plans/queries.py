"""The registered queries: one for each operator, over the whole derived corpus."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import EngineConfig
from ..functions import text as T
from ..operators import ledger, locate, recover, verdict
from ..operators.locate import FILE
from ..sources import corpus, files as sources
from ..sources.tables import shared_root, spread, stored
from ..streaming import assembled, usual_pages
from . import passes

CONFIG = EngineConfig()
KEY = list(verdict.KEY)


class Case:
    """The corpus and what is derived from it, each built once for a query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    all_files = cached_property(lambda s: corpus.files(s.spark, s.sf_dir))
    files = cached_property(lambda s: corpus.active(s.all_files))
    pages = cached_property(lambda s: corpus.pages(spread(s.files)).select(*KEY, "text"))
    judged = cached_property(lambda s: verdict.judged(s.pages))
    # read by several stages of a plan, so written once, without texts
    located = cached_property(lambda s: stored(s.judged.select(*verdict.LOCATING), "judged"))
    entries = cached_property(lambda s: locate.toc_entries(s.located))
    jump = cached_property(lambda s: locate.toc_jump(s.entries, s.located))
    starts = cached_property(lambda s: locate.section_starts(s.located, s.jump))
    ranges = cached_property(lambda s: locate.section_ends(s.starts, s.located))
    records = cached_property(lambda s: s.files.select("company", "source_pdf", "source_hash", "stem"))
    pass1 = cached_property(lambda s: stored(passes.pass1(s.records, s.located), "pass1"))
    plan = cached_property(lambda s: passes.pass2_plan(s.pass1, s.located))
    replies = cached_property(lambda s: corpus.replies(s.files.drop("text")))
    pass2 = cached_property(lambda s: passes.pass2(s.plan, s.records, s.replies))
    ledger = cached_property(lambda s: ledger.parse_lines(corpus.ledger_lines(s.files)))
    samples = cached_property(lambda s: s.plan.select(*FILE, "n_pages", "ws", "we", "centre", recover.sample_pages(F.col("ws"), F.col("we"), F.col("centre")).alias("pages")))
    sections = cached_property(lambda s: s.pass1.unionByName(s.pass2).where("result = 'ok'").select("company", "year", F.col("new_path").alias("path")))
    report = cached_property(lambda s: ledger.coverage(s.all_files, s.sections))
    outputs = cached_property(
        lambda s: s.pass1.where("result = 'ok' and extract_page % 2 = 0").select("company", sources.presence(F.element_at(F.split("new_path", "/"), -1)).alias("o")).select("company", "o.*").unionByName(
            s.files.where("doc_id % 6 = 0").select("company", F.lit("copy").alias("kind"), F.lit(None).cast("string").alias("year"), F.lit(None).cast("string").alias("short"), F.col("stem").alias("name")))
    )


def _flags(*names: str) -> Callable[[Case], DataFrame]:
    return lambda s: s.judged.select(*KEY, *names)


def _modes(s: Case) -> DataFrame:
    off, dry = passes.pass2(s.plan, s.records, None), passes.pass2(s.plan, s.records, s.replies, dry_run=True)
    return s.pass2.withColumn("mode", F.lit("on")).unionByName(off.withColumn("mode", F.lit("off"))).unionByName(dry.withColumn("mode", F.lit("dry")))


def _usual_pages(s: Case) -> DataFrame:
    """The first pass's records as a ledger, taken by the stream that keeps where sections begin."""
    root = f"{shared_root(s.pass1)}/usual-{uuid.uuid4().hex}"
    ledger.append(s.pass1, f"{root}/ledger", "first")
    usual_pages.run_available(s.spark, f"{root}/ledger", f"{root}/usual", f"{root}/checkpoint")
    return usual_pages.read(s.spark, f"{root}/usual")


def _paged_stream(s: Case) -> DataFrame:
    """All pages as a stream that is run three times, each time with some new pages of every file; both passes' decisions on the files that it puts together."""
    root = f"{shared_root(s.files)}/paged-{uuid.uuid4().hex}"
    rows = corpus.pages(spread(s.files), "stem", "source_hash", "n").withColumnRenamed("n", "n_pages").select(*(c.split()[0] for c in assembled.PAGES.split(", ")))
    for k in range(3):
        rows.where(F.col("page") % 3 == k).write.mode("append").parquet(f"{root}/pages")
        # what files agree on is known of a batch, so what has come is one, of however many Parquet files
        assembled.run_available(s.spark, f"{root}/pages", f"{root}/ledger", f"{root}/checkpoint", s.replies, files_a_batch=1_000_000)
    return ledger.read(s.spark, f"{root}/ledger").select("source_pdf", "phase", "action", "result", "extract_page")


_REPLIES = ("YES", "yes.", "No", "YES and NO", "NOT SURE", "UNKNOWN", "")

CASES: dict[str, Callable[[Case], DataFrame]] = {
    # sources and sinks
    "company_filter": lambda s: sources.companies(s.files, "SRC1").select("company", "source_pdf"),
    "company_nonempty": lambda s: s.all_files.groupBy("company").agg(F.count("*").alias("n_files"), F.count_if(F.col("stem") == "Report").alias("n_undated")),
    "page_count": lambda s: locate.page_counts(s.pages),
    "ledger_done_keys": lambda s: ledger.done_keys(s.ledger),
    "resume_presence": lambda s: ledger.not_present(s.files.select("company", "source_pdf", "stem"), s.outputs).select("source_pdf"),
    "section_text": lambda s: locate.section_texts(s.ranges, s.pages),
    "ledger_append": lambda s: s.ledger.unionByName(s.pass1.withColumn("seq", F.lit(10_000_000).cast("bigint")), allowMissingColumns=True).select("seq", "source_pdf", "phase", "action", "result"),
    "organize_no_section": lambda s: ledger.to_organise(s.files.select("company", "source_pdf", "stem"), s.ledger, s.files.where("doc_id % 8 = 0").select("company", "stem")).select("company", "source_pdf"),
    "coverage_report": lambda s: s.report,
    "output_name": lambda s: s.ranges.join(s.files, FILE).select("source_pdf", T.output_name(F.col("stem"), F.col("company"), F.col("start"), F.col("end")).alias("name"), ledger.output_path(CONFIG, F.col("company"), T.output_name(F.col("stem"), F.col("company"), F.col("start"), F.col("end"))).alias("path")),
    # scalar functions
    "fiscal_year": lambda s: s.all_files.select("source_pdf", T.fiscal_year(F.col("stem")).alias("year")),
    "short_name": lambda s: s.all_files.select("company", T.short_name(F.col("company")).alias("short")).distinct(),
    "content_hash": lambda s: s.spark.read.parquet(f"{s.sf_dir}/documents.parquet").select("doc_id", T.content_hash(F.col("text")).alias("hash")),
    "text_slices": lambda s: s.pages.select(*KEY, F.substring("text", 1, 300).alias("head"), F.substring("text", 1, 600).alias("walk_head"), T.bottom(F.col("text"), CONFIG).alias("bottom")),
    "continuation_flags": _flags("n_stripped", "dq_walk", "cont"),
    "script_ratio": lambda s: s.judged.select(*KEY, F.round("script_ratio", 9).alias("script_ratio"), (F.col("script_ratio") > 0.3).alias("hindi")),
    "toc_line_counts": _flags("toc_dotted_n", "toc_dotless_n"),
    "evidence_render": lambda s: s.judged.select(*KEY, verdict.evidence(s.judged).alias("evidence")),
    "search_window": lambda s: s.plan.select("source_pdf", "eligible", "ws", "we", "centre"),
    "reply_parse": lambda s: s.pages.select(*KEY, F.element_at(F.array(*map(F.lit, _REPLIES)), F.col("page") % len(_REPLIES) + 1).alias("reply")).withColumn("verdict", T.reply_verdict(F.col("reply"))),
    # predicates
    "rule_flags": _flags("canonical", "short_header", "nil_comments", "body", "nil_body", "signature", "redirect", "any_evidence", "dq_head"),
    "toc_match": _flags("toc_reason"),
    "signature_bottom": _flags("signature_bottom"),
    "ca_firm_signature": _flags("ca_firm"),
    "strong_signature": _flags("score", "strong"),
    "redirect_page": _flags("is_redirect"),
    "page_verdict": _flags("ok", "kind", "scan_kind"),
    "any_evidence": lambda s: locate.text_layer(s.judged).select(*FILE, "evidence"),
    "toc_like": _flags("toc_like"),
    # finders
    "toc_entries": lambda s: s.entries,
    "toc_jump": lambda s: s.jump,
    "toc_evidence": lambda s: locate.toc_outcome(locate.text_layer(s.located), s.jump),
    "page_signals": _flags("signals"),
    "first_section_page": lambda s: locate.first_pages(s.located).where("start is not null").select(*FILE, "start", "kind"),
    "scan_position": lambda s: locate.first_pages(s.located).select(*FILE, "scanned"),
    "priority_scan": lambda s: locate.first_pages(s.located, centre="6", radius=2).where("start is not null").select(*FILE, "start", "kind"),
    "section_start": lambda s: s.starts,
    "section_range": lambda s: s.ranges,
    "vision_sample": lambda s: s.samples.select("source_pdf", F.size("pages").cast("bigint").alias("n_sampled"), F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("sampled")),
    "vision_first_yes": lambda s: recover.first_yes(s.samples, s.replies),
    "vision_range": lambda s: recover.yes_range(recover.first_yes(s.samples, s.replies), s.replies),
    # joins, windows and aggregates over files and the ledger
    "resume_done_anti": lambda s: ledger.pending(s.files, s.ledger).select("source_pdf"),
    "ledger_latest": lambda s: ledger.latest(s.ledger).select("source_pdf", "seq", "action", "result"),
    "text_layer": lambda s: locate.text_layer(s.judged).select(*FILE, "n_chars", "has_text"),
    "company_consensus": lambda s: passes.agreed(s.pass1).withColumn("pages", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",")),
    "action_histogram": lambda s: ledger.action_histogram(s.pass1.unionByName(s.pass2)),
    "coverage_totals": lambda s: ledger.coverage_totals(s.report),
    # streams
    "stream_usual_pages": _usual_pages,
    "stream_paged_files": _paged_stream,
    # whole passes
    "pass1_actions": lambda s: s.pass1,
    "pass2_plan": lambda s: s.plan,
    "pass2_actions": _modes,
    "actions_all": lambda s: s.pass1.unionByName(s.pass2).select("source_pdf", "phase", "action", "result", "extract_page"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: f(Case(spark, sf_dir))) for name, f in CASES.items()}
