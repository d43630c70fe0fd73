"""Page features and the ordered page verdict: projections only, one select for the flags and one for what follows from them.

pages: company, source_pdf, page, text. Null text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import EngineConfig
from ..functions.rules import PRESET, Catalogue, folded
from ..functions.text import bottom, script_ratio, stripped_length

KEY = ("company", "source_pdf", "page")


def features(pages: DataFrame, config: EngineConfig = EngineConfig(), rules: Catalogue = PRESET, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flags of each page, and columns to keep, beside its text (null: empty) and folded text, by which patterns that can't match are passed over."""
    t, f = F.col("text"), F.col("folded")
    low = bottom(t, config)
    after = lambda r: F.regexp_extract(t, f"{r.java}([\\s\\S]{{0,{config.toc_tail_chars}}})", 1)
    base = pages.select(*KEY, *keep, F.coalesce("text", F.lit("")).alias("text")).withColumn("folded", folded(t))
    flags = base.select(
        *KEY,
        *keep,
        "text",
        "folded",
        F.length(t).alias("n_chars"),
        *(getattr(rules, r).found(t, f).alias(r) for r in ("canonical", "short_header", "nil_comments", "signature", "redirect", "any_evidence", "nil_body")),
        (rules.body_behalf.found(t, f) | rules.body_section.found(t, f) | rules.body_decl.found(t, f)).alias("body"),
        rules.toc_dotted_line.count(t, f).alias("toc_dotted_n"),
        rules.toc_dotless_line.count(t, f).alias("toc_dotless_n"),
        rules.firm.found(low, f).alias("firm_bottom"),
        rules.signature.found(low, f).alias("signature_bottom"),
        rules.disqualifier.found(F.substring(t, 1, config.head_chars), f).alias("dq_head"),
        rules.disqualifier.found(F.substring(t, 1, config.walk_head_chars), f).alias("dq_walk"),
        stripped_length(t).alias("n_stripped"),
        script_ratio(t).alias("script_ratio"),
    )
    tail = F.when(F.col("canonical"), after(rules.canonical)).when(F.col("short_header"), after(rules.short_header))
    return flags.withColumn("tail_hit", F.coalesce(rules.toc_tail.found(tail), F.lit(False)))


def verdicts(flags: DataFrame, config: EngineConfig = EngineConfig(), rules: Catalogue = PRESET) -> DataFrame:
    """flags with head, toc_reason, ca_firm, strong, is_redirect, kind, ok, cont, stop, toc_like, signals and the kind under which a scan takes the page.

    stop: why a page doesn't continue a section. signals: the kind and what it rests on. toc_numbers and toc_texts: of contents pages, the numbers and texts of each kind of entry.
    """
    c = F.col
    head = c("canonical") | c("short_header")
    nil = c("nil_comments") | c("nil_body")
    one = flags.withColumns({
        "head": head,
        "toc_reason": F.when(~head, "").when(c("tail_hit"), "toc_tail").when(c("toc_dotted_n") >= config.toc_lines, "toc_dotted").when(c("toc_dotless_n") >= config.toc_lines, "toc_dotless").otherwise(""),
        "ca_firm": c("firm_bottom") & ~c("signature_bottom"),
        "is_redirect": head & c("redirect") & ~c("body") & ~c("signature"),
        "stop": F.when(c("n_stripped") < config.walk_min_chars, "short").when(c("script_ratio") > config.script_share, "script").when(c("dq_walk"), "disqualifier").otherwise(""),
        "toc_like": (c("n_chars") >= config.toc_like_chars) & ((c("toc_dotted_n") >= config.toc_like_dotted) | (c("toc_dotless_n") >= config.toc_like_dotless)),
        "score": head.cast("int") + c("body").cast("int") + c("signature").cast("int"),
    })
    toc, both = c("toc_reason") != "", c("body") & c("signature")
    name = F.when(c("canonical"), "canonical").otherwise("short_header")
    kind = (
        F.when(c("n_chars") == 0, "")
        .when(c("is_redirect"), "rejected_redirect")
        .when(~c("head") & c("nil_comments"), "nil_comments")
        .when(~c("head"), "no_canonical_heading")
        .when(~(c("body") | c("signature") | nil), F.concat(name, F.lit("_without_body_or_sig")))
        .when(toc & ~both, F.concat(name, F.lit("_rejected_as_toc")))
        .otherwise(name)
    )
    # a firm's name is looked for only where it decides
    low = bottom(c("text"), config)
    firm = rules.firm.found(low, c("folded")) & ~rules.signature.found(low, c("folded"))
    each = lambda group: F.when(c("toc_like") & (c("page") <= config.toc_pages), F.array(*(F.regexp_extract_all("text", F.lit(r.java), F.lit(group)) for r in rules.toc_entries)))
    two = one.withColumns({"kind": kind, "strong": (c("score") >= 2) & ~firm, "cont": c("stop") == "", "toc_numbers": each(1), "toc_texts": each(0)}).withColumn("ok", F.col("kind").isin("canonical", "short_header", "nil_comments"))
    scan = F.when(c("n_chars") == 0, F.lit(None)).when(c("dq_head"), F.when(c("strong"), "strong_cag_overrides_dq")).when(c("ok"), c("kind"))
    three = two.withColumn("scan_kind", scan)
    # what looked like a contents list: overridden where the page is accepted all the same, else why it is rejected
    listed = F.when(~toc, "").when(c("ok"), F.concat(F.lit("|overrides_toc("), c("toc_reason"), F.lit(")"))).when(c("kind").endswith("_as_toc"), F.concat(F.lit("|"), c("toc_reason"))).otherwise("")
    return three.withColumn("signals", F.concat(F.coalesce("scan_kind", "kind"), F.lit("("), evidence(three), F.lit(")"), listed)).drop("text", "folded")


#: What finding, walking and reports need of a page.
LOCATING = (*KEY, "n_chars", "any_evidence", "toc_like", "toc_numbers", "toc_texts", "ok", "kind", "scan_kind", "signals", "cont", "stop", "signature")


def judged(pages: DataFrame, config: EngineConfig = EngineConfig(), rules: Catalogue = PRESET, keep: tuple[str, ...] = ()) -> DataFrame:
    return verdicts(features(pages, config, rules, keep), config, rules)


def evidence(v: DataFrame) -> Column:
    """Parts of the evidence that a verdict rests on, joined by plus."""
    part = lambda name, flag: F.when(F.col(flag), name)
    return F.concat_ws("+", part("canonical", "canonical"), part("short", "short_header"), part("body", "body"), part("sig", "signature"), part("nil_body", "nil_body"))
