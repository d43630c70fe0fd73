"""The rule catalogue: patterns as data, and the one place where their flags are chosen.

Spark's patterns get (?dU): only a newline ends a line, and classes and case are Unicode's. Where Python would also count
U+001C to U+001F as space, or see no word boundary after a combining vowel sign, these differ; that is accepted.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# The preset's patterns.
_OFFICE = r"Comptroller\s+(?:and|&)\s+Auditor\s+General"
_SHORT = r"(?:CAG|C\s*&\s*AG|C\s+and\s+AG)"
_NO_AUDIT = r"have\s+decided\s+not\s+to\s+conduct\s+the\s+supplementary\s+audit"
CANONICAL = r"Comments\s+of\s+the\s+" + _OFFICE
SHORT_HEADER = r"\b(?:Comments\s+of\s+(?:the\s+)?" + _SHORT + r"|(?:CAG|C\s*&\s*AG)\s+Comments)\b"
NIL_COMMENTS = r"\b(?:Nil\s+Comments|No\s+Comments\s+by\s+(?:the\s+)?(?:CAG|C\s*&\s*AG|Comptroller)|" + _NO_AUDIT + r")\b"
BODY_BEHALF = r"I,?\s+on\s+behalf\s+of\s+the\s+" + _OFFICE
BODY_SECTION = r"have\s+conducted\s+a\s+supplementary\s+audit\s+under\s+(?:Section|S\.?)\s*(?:143\s*\(\s*6\s*\)|619\s*\(\s*[24]\s*\))"
BODY_DECLARATION = r"(?:The\s+)?" + _OFFICE + r"\s+of\s+India\s*(?:\(CAG\))?\s+(?:have|has)\s+conducted\s+a\s+supplementary\s+audit"
NIL_BODY = r"nothing\s+significant\s+has\s+come\s+to\s+(?:my|our)?\s*knowledge|no\s+comment\s+upon\s+or\s+supplement(?:ary)?\s+to|" + _NO_AUDIT + r"|nothing\s+has\s+come\s+to\s+(?:my|our)\s+notice"
SIGNATURE = r"For\s+(?:and\s+)?on\s+(?:the\s+)?behalf\s+of\s+the\s+" + _OFFICE + r"|Director\s+General\s+of\s+(?:Commercial\s+)?Audit|Pr\.?\s+Director\s+of\s+Audit|Principal\s+Director\s+of\s+(?:Commercial\s+)?Audit"
TOC_TAIL = r"\.{4,}|\.\s*\.\s*\.\s*\.|^\s*\d{1,4}\s*$"
TOC_DOTTED_LINE = r"^[^\n]{3,80}?\.{3,}[^\n]{0,20}\d{1,4}\s*$"
TOC_DOTLESS_LINE = r"^[A-Za-z][^\n\r]{5,80}?\s\d{1,4}\s*$"
DISQUALIFIERS = (
    r"Independent\s+Auditor'?s?\s+Report",
    r"Statutory\s+Auditor'?s?\s+Report",
    r"Secretarial\s+Auditor'?s?\s+Report",
    r"Cost\s+Audit(?:or'?s?)?\s+Report",
    r"Internal\s+Auditor'?s?\s+Report",
    r"Director'?s?\s+Report\s+to\s+the\s+Members",
    r"Notice\s+of\s+Annual\s+General\s+Meeting",
    r"Form\s+(?:AOC|MR|MGT)-?\s*\d",
)
FIRMS = (
    r"Deloitte\s+Haskins?\s*&\s*Sells",
    r"\bDeloitte\b",
    r"\bPrice\s+Waterhouse\b",
    r"\bPricewaterhouseCoopers\b",
    r"\bPwC\b",
    r"\bKPMG\b",
    r"BSR\s*&\s*Co",
    r"B\.?\s*S\.?\s*R\.?\s*&\s*Co",
    r"\bErnst\s*&\s*Young\b",
    r"\bE\.?Y\.?\b",
    r"S\.?R\.?B\.?C\.?\s*&\s*Co",
    r"SRBC\s*&\s*Co",
    r"Walker\s+Chandiok",
    r"Lodha\s*&\s*Co",
    r"Sharp\s*&\s*Tannan",
    r"Brahmayya\s*&\s*Co",
    r"Khimji\s+Kunverji",
    r"Khaitan\s*&\s*Co",
    r"Pijush\s+Gupta",
    r"Chartered\s+Accountants?\s*\nFirm'?s?\s+Registration",
    r"\(Firm'?s?\s+Registration\s+No\.?",
)
DEVANAGARI = r"[\x{0900}-\x{097F}]"
REDIRECT = (
    r"(?:are\s+)?placed\s+(?:next\s+to|after|alongside|with)|forms?\s+part\s+of\s+this\s+(?:annual\s+)?report|(?:is\s+|are\s+)?annexed\s+(?:hereto|to\s+this\s+report)?"
    r"|appended\s+(?:hereto|to\s+this\s+report)|(?:is\s+|are\s+)?enclosed(?:\s+herewith|\s+with\s+this)?|(?:is\s+|are\s+)?attached\s+(?:hereto|herewith|to\s+this\s+report)|placed\s+immediately\s+after\s+the\s+(?:Statutory\s+)?Audit"
)
ANY_EVIDENCE = _OFFICE + r"|\bCAG\b|\bC\s*&\s*AG\b|supplementary\s+audit|Section\s+143\s*\(\s*6|Section\s+619\s*\(\s*[24]"
TOC_ENTRIES = tuple(
    head + r".{0,80}?(\d{1,4})\s*$"
    for head in (CANONICAL, r"Comments\s+of\s+(?:the\s+)?" + _SHORT, r"(?:CAG|C\s*&\s*AG)\s+Comments", r"Comments\s+and\s+Audit\s+Certificate")
)
#: Words that a company's short name leaves out. Fixed values.
DROPPED_WORDS = ("and", "&", "the", "of", "company", "co", "co.", "limited", "ltd", "ltd.", "private", "pvt", "pvt.", "corporation", "corp", "corp.", "inc", "incorporated", "india", "indian", "republic")
#: Fiscal-year shapes of a file's stem, in order. Fixed values.
YEAR_PATTERNS = (r"(\d{4})-03-31", r"(\d{4})_03_31", r"(\d{4})-(\d{4})", r"(\d{4})_(\d{4})", r"(\d{4})_(\d{2})(?:_|$|\.)", r"_AR_(\d{4})\b", r"\b(20\d{2})\b")


@dataclass(frozen=True)
class Rule:
    """A pattern with its flags: i ignores case, m lets ^ and $ meet at lines.

    needs: words of which every match holds at least one, folded (see folded); texts without any skip the pattern. Empty: none are known.
    """

    pattern: str
    flags: str = "i"
    needs: tuple[str, ...] = ()

    @property
    def java(self) -> str:
        return f"(?dU{self.flags})" + self.pattern

    def may(self, folded_: Column | None) -> Column:
        """Whether a folded text holds one of the needed words; cheap, and true of every text that matches."""
        return F.lit(True) if folded_ is None or not self.needs else reduce(or_, (folded_.contains(w) for w in self.needs))

    def found(self, text: Column, folded_: Column | None = None) -> Column:
        return self.may(folded_) & text.rlike(self.java)

    def count(self, text: Column, folded_: Column | None = None) -> Column:
        return F.when(self.may(folded_), F.regexp_count(text, F.lit(self.java))).otherwise(0).cast("int")


def folded(text: Column) -> Column:
    """text so that letters which patterns without case take for one are one."""
    return F.lower(F.upper(F.translate(text, "\u0130", "i")))


@dataclass(frozen=True)
class Catalogue:
    """All that is specific to one kind of section; another preset locates other sections."""

    canonical: Rule = Rule(CANONICAL, needs=("comptroller",))
    short_header: Rule = Rule(SHORT_HEADER, needs=("comments",))
    nil_comments: Rule = Rule(NIL_COMMENTS, needs=("comments", "supplementary"))
    body_behalf: Rule = Rule(BODY_BEHALF, needs=("comptroller",))
    body_section: Rule = Rule(BODY_SECTION, needs=("supplementary",))
    body_decl: Rule = Rule(BODY_DECLARATION, needs=("comptroller",))
    nil_body: Rule = Rule(NIL_BODY, needs=("nothing", "comment", "supplementary"))
    signature: Rule = Rule(SIGNATURE, needs=("comptroller", "director"))
    toc_tail: Rule = Rule(TOC_TAIL, "m")
    toc_dotted_line: Rule = Rule(TOC_DOTTED_LINE, "m", ("...",))
    toc_dotless_line: Rule = Rule(TOC_DOTLESS_LINE, "m")
    disqualifier: Rule = Rule(r"^\s*(?:" + "|".join(DISQUALIFIERS) + ")", "im", ("report", "notice", "form"))
    firm: Rule = Rule("|".join(FIRMS))
    devanagari: Rule = Rule(DEVANAGARI, "")
    redirect: Rule = Rule(REDIRECT, needs=("placed", "form", "annexed", "appended", "enclosed", "attached"))
    any_evidence: Rule = Rule(ANY_EVIDENCE, needs=("comptroller", "cag", "&", "supplementary", "section"))
    toc_entries: tuple[Rule, ...] = tuple(Rule(p, "im") for p in TOC_ENTRIES)


PRESET = Catalogue()
