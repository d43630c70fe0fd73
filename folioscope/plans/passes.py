"""Both passes as DataFrame plans. A company is a grouping key, never a loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import EngineConfig
from ..functions.text import fiscal_year, output_name
from ..operators import ledger, locate, recover, verdict
from ..operators.locate import FILE, met
from ..sources.tables import stored

FIELDS = ["company", "source_pdf", "source_hash", "year", "phase", "pass1_action", "action", "result", "method", "evidence", "extract_page", "extract_end_page", "new_path"]


def pass1(files: DataFrame, judged: DataFrame, config: EngineConfig = EngineConfig(), dry_run: bool = False) -> DataFrame:
    """A record for each file (company, source_pdf, source_hash, stem). Files without pages were unreadable.

    Evidence says what the contents gave, what the page showed and what ended the walk.
    """
    layer = locate.text_layer(judged, config)
    jump = locate.toc_jump(locate.toc_entries(judged, config), judged, config)
    found = locate.section_ends(locate.section_starts(judged, jump), judged, config)
    rows = files.join(met(layer), FILE, "left").join(met(locate.toc_outcome(layer, jump)), FILE, "left").join(met(found), FILE, "left")
    hit = F.col("has_text") & F.col("start").isNotNull()
    action = F.when(F.col("n_pages").isNull(), "ERROR").when(~F.col("has_text"), "DEFER_VISION").when(F.col("start").isNull(), "DEFER_XY").otherwise("EXTRACT")
    rows = rows.withColumns({"year": fiscal_year(F.col("stem")), "action": action, "hit": F.coalesce(hit, F.lit(False))})
    result = F.when(F.col("action") == "ERROR", "error").when(F.col("action") != "EXTRACT", "deferred").otherwise("dry_run" if dry_run else "ok")
    path = ledger.output_path(config, F.col("company"), output_name(F.col("stem"), F.col("company"), F.col("start"), F.col("end"), F.col("year")))
    why = (
        F.when(F.col("action") == "ERROR", "could_not_open_source").when(F.col("action") == "DEFER_VISION", F.concat(F.lit("no_text_layer|n_pages="), F.col("n_pages").cast("string")))
        .when(F.col("action") == "DEFER_XY", F.concat(F.lit("toc:"), F.col("toc"), F.lit("|scanned="), F.col("n_written").cast("string")))
        .otherwise(F.concat(F.col("kind"), F.lit("|"), F.col("signals"), F.lit("|toc:"), F.col("toc"), F.lit("|walk:"), F.col("stop")))
    )
    return rows.select(
        "company", "source_pdf", "source_hash", "year", F.lit("pass1").alias("phase"), F.lit(None).cast("string").alias("pass1_action"), "action", result.alias("result"),
        F.when(F.col("hit"), F.col("method")).alias("method"), why.alias("evidence"),
        F.when(F.col("hit"), F.col("start")).alias("extract_page"), F.when(F.col("hit"), F.col("end")).alias("extract_end_page"), F.when(F.col("hit"), path).alias("new_path"),
    )


def agreed(first: DataFrame, config: EngineConfig = EngineConfig(), earlier: DataFrame | None = None) -> DataFrame:
    """Consensus of this run's first pass; with use_ledger_consensus also of earlier records. A dry run confirms nothing."""
    rows = first.select("company", "source_pdf", "action", "result", "extract_page")
    if config.use_ledger_consensus and earlier is not None:
        rows = rows.unionByName(ledger.latest(earlier.where("phase = 'pass1'")).select(rows.columns).join(rows.select("source_pdf"), "source_pdf", "left_anti"))
    return recover.consensus(rows.where("action = 'EXTRACT' and result = 'ok'").select("company", F.col("extract_page").alias("start")), config)


def pass2_plan(first: DataFrame, judged: DataFrame, config: EngineConfig = EngineConfig(), earlier: DataFrame | None = None) -> DataFrame:
    """Deferred files with the window that a classifier would search; without consensus the whole file."""
    late = first.where("result = 'deferred'").select(*FILE, "source_hash", "year", F.col("action").alias("pass1_action"))
    rows = late.join(met(locate.text_layer(judged, config).select(*FILE, "n_pages", "evidence")), FILE, "left").join(agreed(first, config, earlier), "company", "left")
    some = F.col("n_years").isNotNull()
    ws, we = recover.search_window(F.col("min_page"), F.col("max_page"), F.col("n_pages"), config)
    return rows.select(*FILE, "source_hash", "year", "pass1_action", "n_pages", "evidence", some.alias("eligible"), F.when(some, ws).otherwise(1).alias("ws"), F.when(some, we).otherwise(F.col("n_pages")).alias("we"), F.when(some, F.col("median_page")).otherwise(F.floor(F.col("n_pages") / 2).cast("int")).alias("centre"))


def pass2(plan: DataFrame, files: DataFrame, replies: DataFrame | None, config: EngineConfig = EngineConfig(), dry_run: bool = False) -> DataFrame:
    """Records of deferred files. replies: source_pdf, company, page, verdict of the classifier, or None where it is off."""
    stems = files.select(*FILE, "stem")
    pages = recover.sample_pages(F.col("ws"), F.col("we"), F.col("centre"), config)
    scanned = F.col("pass1_action") == "DEFER_VISION"
    looks = scanned | F.coalesce("evidence", F.lit(False))
    known = F.col("pass1_action").isin("DEFER_VISION", "DEFER_XY")
    rows = plan.join(met(stems), FILE)
    if replies is None or dry_run:
        rows = rows.withColumns({"start": F.lit(None).cast("int"), "end": F.lit(None).cast("int")})
    else:
        samples = rows.where(looks).select(*FILE, pages.alias("pages"))
        hits = recover.yes_range(recover.first_yes(samples, replies), replies, config)
        rows = rows.join(met(hits), FILE, "left")
    hit = F.col("start").isNotNull()
    sees = F.when(scanned, "VISION").otherwise("VISION_AGG")
    action = F.when(F.col("n_pages").isNull() | ~known, "ERROR").when(~looks, "TRULY_MISSING").when(F.lit(replies is None), "TRULY_MISSING").when(F.lit(dry_run) | hit, sees).otherwise("TRULY_MISSING")
    result = F.when(action == "ERROR", "error").when(action == "TRULY_MISSING", "no_match").otherwise("dry_run" if dry_run else "ok")
    window = F.concat(F.lit("p"), F.col("ws").cast("string"), F.lit("-p"), F.col("we").cast("string"))
    sampled = F.concat(F.lit("|sampled="), F.size(pages).cast("string"))
    why = (
        F.when(F.col("n_pages").isNull(), "could_not_open_source").when(~known, F.concat(F.lit("unexpected_pass1_action:"), F.col("pass1_action")))
        .when(~looks, F.when(F.col("eligible"), "no_keywords_anywhere|skipped_vision").otherwise("no_keywords_anywhere|not_eligible_xy"))
        .when(F.lit(replies is None), F.when(scanned, "scanned_pdf|vision_disabled").otherwise("deterministic_failed|vision_disabled")).when(F.lit(dry_run), F.concat(F.lit("would_look|"), window))
        .when(hit, F.concat(F.lit("vision_hit"), sampled)).otherwise(F.concat(F.lit("vision_no_match|window="), window, sampled))
    )
    path = ledger.output_path(config, F.col("company"), output_name(F.col("stem"), F.col("company"), F.col("start"), F.col("end"), F.col("year")))
    return rows.select("company", "source_pdf", "source_hash", "year", F.lit("pass2").alias("phase"), "pass1_action", action.alias("action"), result.alias("result"), F.lit(None).cast("string").alias("method"), why.alias("evidence"), F.col("start").alias("extract_page"), F.col("end").alias("extract_end_page"), F.when(hit, path).alias("new_path"))


def both(files: DataFrame, pages: DataFrame, replies: DataFrame | None, config: EngineConfig = EngineConfig(), dry_run: bool = False) -> DataFrame:
    judged = stored(verdict.judged(pages, config).select(*verdict.LOCATING), "judged")
    first = stored(pass1(files, judged, config, dry_run), "pass1")
    return first.unionByName(pass2(pass2_plan(first, judged, config), files, replies, config, dry_run))
