"""Scalar functions over names and page texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..config import EngineConfig
from .rules import DROPPED_WORDS, YEAR_PATTERNS


def fiscal_year(stem: Column) -> Column:
    """The first shape that the stem has, as `yyyy-yyyy` or `yyyy`; else empty. Each shape is looked for once."""
    seen = F.array(*(F.struct(F.lit(i).alias("i"), F.regexp_extract(stem, "(?dU)" + p, 0).alias("x")) for i, p in enumerate(YEAR_PATTERNS)))

    def made(s: Column) -> Column:
        x, i = s["x"], s["i"]
        y = F.substring(x, 1, 4)
        return (
            F.when(i <= 1, F.concat((y.try_cast("int") - 1).cast("string"), F.lit("-"), y)).when(i <= 3, F.translate(x, "_", "-"))
            .when(i == 4, F.concat(y, F.lit("-"), F.substring(x, 1, 2), F.substring(x, 6, 2))).when(i == 5, F.substring(x, 5, 4)).otherwise(x)
        )

    return F.coalesce(F.get(F.transform(F.filter(seen, lambda s: s["x"] != ""), made), 0), F.lit(""))


def short_name(company: Column) -> Column:
    words = F.filter(F.split(F.regexp_replace(company, r"(?U)[^\w\s&]", ""), r"(?U)\s+"), lambda w: w != "")
    said = F.filter(words, lambda w: ~F.lower(w).isin(*DROPPED_WORDS) & (F.length(w) > 1))
    name = F.regexp_replace(F.array_join(F.slice(F.when(F.size(said) > 0, said).otherwise(F.slice(words, 1, 2)), 1, 3), "_"), "_{2,}", "_")
    return F.coalesce(F.nullif(F.regexp_replace(name, "^_+|_+$", ""), F.lit("")), F.lit("Unknown"))


def content_hash(content: Column) -> Column:
    return F.substring(F.sha1(content), 1, 16)


#: What Unicode takes for white space.
_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def stripped_length(text: Column) -> Column:
    return F.length(F.btrim(text, F.lit(_SPACE)))


def bottom(text: Column, config: EngineConfig) -> Column:
    """What stands below the first `bottom` share of the characters."""
    return F.substr(text, F.floor(F.length(text) * F.lit(config.bottom)).cast("int") + 1)


def script_ratio(text: Column) -> Column:
    """Devanagari characters by letters; vowel signs aren't letters, so this can exceed 1. 0 without letters."""
    letters = F.nullif(F.regexp_count(text, F.lit(r"\p{L}")), F.lit(0))
    share = F.regexp_count(text, F.lit(r"[\x{0900}-\x{097F}]")) / letters
    return F.when(text.rlike(r"[\x{0900}-\x{097F}]"), F.coalesce(share, F.lit(0.0))).otherwise(0.0)


def output_name(stem: Column, company: Column, start: Column, end: Column, year: Column | None = None) -> Column:
    """year: the stem's fiscal year, where a column has it already."""
    year = fiscal_year(stem) if year is None else year
    pages = F.concat(F.lit("cag_p"), start.cast("string"), F.when(end > start, F.concat(F.lit("-"), end.cast("string"))).otherwise(""), F.lit("_en.pdf"))
    return F.when(year != "", F.concat_ws("__", year, short_name(company), pages)).otherwise(F.concat_ws("__", stem, pages))


def reply_verdict(reply: Column) -> Column:
    """Whether a classifier's reply says yes and not no; null without a reply."""
    said = F.upper(reply)
    return said.contains("YES") & ~said.contains("NO")
