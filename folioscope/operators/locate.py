"""Where a file's section begins and ends.

Everything groups by file: one shuffle by (company, source_pdf) of narrow rows, flags and numbers, never of texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import EngineConfig
from ..functions.rules import PRESET, Catalogue

FILE = ["company", "source_pdf"]


def met(rows: DataFrame) -> DataFrame:
    """rows of pages or files, to be met in a shuffle by what they are joined with.

    Stored verdicts are packed some hundredfold, and exploded rows count as those they came from, so by Spark's estimate millions
    of rows are small enough to be collected in the driver and sent to every executor.
    """
    return rows.hint("merge")


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy(*FILE).agg(F.max("page").alias("n_pages"))


def text_layer(judged: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    total = F.sum("n_chars")
    return judged.groupBy(*FILE).agg(total.cast("bigint").alias("n_chars"), (total >= config.text_layer_chars).alias("has_text"), F.max("page").alias("n_pages"), F.bool_or("any_evidence").alias("evidence"), F.count_if(F.col("n_chars") > 0).cast("bigint").alias("n_written"), F.array_join(F.sort_array(F.collect_list(F.when(F.col("toc_like") & (F.col("page") <= config.toc_pages), F.col("page")))), ",").alias("toc_pages"))


def toc_entries(judged: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """All entries of contents pages with a page number of the file, in order (toc_page, pattern, position)."""
    # Unicode digits count, as they do for the patterns
    digits = F.translate("number", "०१२३४५६७८९", "0123456789").try_cast("int")
    both = F.zip_with("toc_numbers", "toc_texts", lambda n, t: F.arrays_zip(n.alias("number"), t.alias("text")))
    out = judged.where("toc_numbers is not null").select(*FILE, F.col("page").alias("toc_page"), F.posexplode(both).alias("pattern", "found")).select(*FILE, "toc_page", "pattern", F.posexplode("found").alias("position", "entry"))
    out = out.withColumns({"number": F.col("entry")["number"], "matched": F.btrim(F.regexp_replace(F.substring(F.col("entry")["text"], 1, config.matched_chars), r"[ \t\n\r\f]+", " "))})
    return out.withColumn("target", digits).join(met(page_counts(judged)), FILE).where("target between 1 and n_pages").select(*FILE, "toc_page", "pattern", "position", "target", "matched")


def toc_jump(entries: DataFrame, judged: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Each file's first entry, and the first page from its target on, within the offsets, that the verdict accepts (else null).

    tried: what each page that was looked at gave, up to the first that is accepted.
    """
    chosen = entries.groupBy(*FILE).agg(F.min_by(F.struct("target", "toc_page", "matched"), F.struct("toc_page", "pattern", "position")).alias("e")).select(*FILE, "e.*")
    looked = chosen.join(met(page_counts(judged)), FILE).select(*FILE, "n_pages", F.explode(F.sequence("target", F.col("target") + config.toc_offsets)).alias("page"))
    seen = looked.join(met(judged.select(*FILE, "page", "ok", "kind", "signals", "n_chars")), [*FILE, "page"], "left")
    said = F.when(F.col("page") > F.col("n_pages"), "out_of_range").when(F.coalesce("n_chars", F.lit(0)) == 0, "no_text").when(F.col("ok"), "OK").otherwise("no")
    per = seen.groupBy(*FILE).agg(F.sort_array(F.collect_list(F.struct("page", said.alias("said"), "kind", "signals"))).alias("pages"))
    hit = F.array_position(F.transform("pages", lambda p: p["said"]), "OK")
    per = per.withColumn("_hit", hit.cast("int"))
    tried = F.transform(F.slice("pages", F.lit(1), F.when(F.col("_hit") > 0, F.col("_hit")).otherwise(F.size("pages"))), lambda p: F.concat(F.lit("p"), p["page"].cast("string"), F.lit("="), p["said"]))
    found = F.when(F.col("_hit") > 0, F.get("pages", F.col("_hit") - 1))
    got = per.select(*FILE, found.alias("f"), F.array_join(tried, ",").alias("tried"))
    return chosen.join(met(got), FILE).select(*FILE, "toc_page", "matched", "target", F.col("f.page").alias("start"), "f.kind", "f.signals", "tried")


def toc_outcome(layer: DataFrame, jump: DataFrame) -> DataFrame:
    """What the contents gave for each file: no contents page, no entry of the section in those there are, an entry that no page bears out, or a valid one; with the entry and the pages tried."""
    rows = layer.select(*FILE, "toc_pages").join(met(jump.select(*FILE, "toc_page", "matched", "target", F.col("start").alias("hit"), "kind", "tried")), FILE, "left")
    p = lambda name, c: F.concat(F.lit(f"|{name}_p"), F.col(c).cast("string"))
    failed = F.concat(F.lit("toc_validation_failed"), p("toc", "toc_page"), p("target", "target"), F.lit("|tried:"), "tried")
    valid = F.concat(F.lit("toc_validated"), p("toc", "toc_page"), F.lit("|matched:"), "matched", p("target", "target"), p("hit", "hit"), F.lit("|validation:"), "tried", F.lit("|"), "kind")
    none = F.concat(F.lit("no_entries_in_toc(toc_pages="), "toc_pages", F.lit(")"))
    return rows.select(*FILE, F.when(F.col("toc_pages") == "", "no_toc_pages").when(F.col("target").isNull(), none).when(F.col("hit").isNull(), failed).otherwise(valid).alias("toc"))


def first_pages(judged: DataFrame, low: str = "1", high: str = "2147483647", centre: str | None = None, radius: int = 0) -> DataFrame:
    """The first page of [low, high] that a scan takes, and how many pages with text it has then seen.

    low, high and centre are SQL over judged's columns. With a centre, pages within the radius come first, if the range is more than twice the radius and five.
    """
    w = judged.where(f"page between {low} and {high}")
    rank = F.lit(False) if centre is None else F.expr(f"abs(page - ({centre})) > {radius} and least({high}, max(page) over (partition by company, source_pdf)) - greatest(1, {low}) > {2 * radius + 5}")
    w = w.withColumn("_at", F.struct(rank.alias("r"), "page"))
    hit = w.where("scan_kind is not null").groupBy(*FILE).agg(F.min("_at").alias("_hit"), F.min_by("scan_kind", "_at").alias("kind"), F.min_by("signals", "_at").alias("signals"))
    seen = w.where("n_chars > 0").join(met(hit), FILE, "left").groupBy(*FILE).agg(F.count_if(F.col("_hit").isNull() | (F.col("_at") <= F.col("_hit"))).cast("bigint").alias("scanned"))
    return hit.join(met(seen), FILE, "full").select(*FILE, F.col("_hit.page").alias("start"), "kind", "signals", "scanned")


def section_starts(judged: DataFrame, jump: DataFrame) -> DataFrame:
    """The contents' page where it holds, else the scan's. signals say what the page itself showed."""
    a = jump.where("start is not null").select(*FILE, F.col("start").alias("a"), F.lit("toc_jump").alias("ak"), F.col("signals").alias("sa"))
    b = first_pages(judged).where("start is not null").select(*FILE, F.col("start").alias("b"), F.col("kind").alias("bk"), F.col("signals").alias("sb"))
    return a.join(met(b), FILE, "full").select(*FILE, F.coalesce("a", "b").alias("start"), F.when(F.col("a").isNotNull(), "toc").otherwise("strict_rule").alias("method"), F.coalesce("ak", "bk").alias("kind"), F.coalesce("sa", "sb").alias("signals"))


def section_ends(starts: DataFrame, judged: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """starts with end: pages follow while they continue, up to and with the first signature after the start; and with stop, what ended it."""
    after = starts.select(*FILE, "start").join(met(judged.select(*FILE, "page", "stop", "signature")), FILE).where(F.col("page").between(F.col("start") + 1, F.col("start") + config.walk_pages))
    w = Window.partitionBy(*FILE).orderBy("page")
    # a missing page stops the walk as an empty one does
    before = F.col("start") + F.row_number().over(w) - 1
    why = F.when(before != F.col("page") - 1, "short").when(F.col("stop") != "", F.col("stop")).when(F.col("signature"), "signature")
    marked = after.withColumns({"_why": why, "_upto": before}).withColumn("_upto", F.col("_upto") + (F.col("_why") == "signature").cast("int"))
    # the first page with a reason ends the walk; a signed one still belongs to it
    first = marked.groupBy(*FILE).agg(F.min(F.when(F.col("_why").isNotNull(), F.struct("page", "_why", "_upto"))).alias("_first"), F.max("page").alias("_last"))
    found = first.select(*FILE, F.coalesce("_first._upto", "_last").alias("_end"), F.col("_first._why").alias("_why"), "_last")
    ended = starts.join(met(found), FILE, "left")
    why = F.coalesce("_why", F.when(F.col("_last") - F.col("start") >= config.walk_pages, "cap").otherwise("eof"))
    return ended.select(*starts.columns, F.greatest("start", F.coalesce("_end", "start")).alias("end"), why.alias("stop"))


#: Sections whose pages' keys are sent to every executor at most; some 200 bytes a page.
SENT = 50_000


def section_texts(ranges: DataFrame, pages: DataFrame, n: int | None = None) -> DataFrame:
    """Pages of each section, in order, as one text. Ranges become their few pages first, so that the join is by page.

    n: how many ranges there are, where the caller has them stored and counted. Up to SENT, they go to the pages, and only texts
    of sections travel; of more, pages and ranges meet in a shuffle.
    """
    wanted = ranges.select(*FILE, F.explode(F.sequence("start", "end")).alias("page"))
    wanted = F.broadcast(wanted) if n is not None and n <= SENT else met(wanted)
    return joined_texts(pages.join(wanted, [*FILE, "page"]))


def joined_texts(own: DataFrame) -> DataFrame:
    """Each file's pages, in order, as one text, and their number."""
    ordered = F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text"))))
    return own.groupBy(*FILE).agg(F.array_join(F.transform(ordered, lambda s: s["text"]), "\n").alias("text"), F.count("*").cast("bigint").alias("n_pages"))
