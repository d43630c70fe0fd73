"""PII: format-preserving pseudonyms of validated numbers and dates, by a keyed Feistel network in DataFrame functions only.

Found are payment card numbers (13 to 19 digits, single spaces or hyphens between them, valid by Luhn; in a longer run of digits
the first and then longest valid part between separators), telephone numbers
(`+1 (ddd) ddd-dddd`, `+1 ddd ddd dddd`, with points or hyphens, and forms without the code), dotted IPv4 addresses without leading zeros, US social security numbers
of valid areas, groups and serials, and dates (yyyy-mm-dd, mm/dd/yyyy or dd/mm/yyyy, dd.mm.yyyy; years 0001 to 9999) that the
calendar has. What touches a letter, digit or underscore, or isn't valid, stays, but for a yyyy-mm-dd that a time follows after a T. Each value is permuted among the valid values
of its format: a card stays valid with as many digits and separators in place, a date stays a date, a telephone number's ten
digits become any ten. Slashed dates are one format: all strings that either reading takes for a date.

One key gives one permutation of a format, so equal values stay equal across documents and different ones different. Where the
valid values don't fill the network's domain, it is applied until it gives a valid one, which keeps it a permutation. Null text
stays null, and nothing depends on other rows: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_ROUNDS = 10
#: First day, days up to 9999-12-31, and the side of a square that holds them.
_BASE, _DAYS, _SIDE = "0001-01-01", 3_652_059, 1912
#: Steps by which a value returns to the valid ones. At most 0.4 of a domain is invalid, so no key is known to need as many.
_WALK = 96
#: Fixed forms, tried in this order at each place.
FORMS = {
    "phone": r"(?:\+?\d{1,3}[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}",
    "ipv4": r"(?:\d{1,3}\.){3}\d{1,3}(?!\.\d)",
    "iso": r"\d{4}-\d{2}-\d{2}",
    "slashed": r"\d{2}/\d{2}/\d{4}",
    "dotted": r"\d{2}\.\d{2}\.\d{4}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "card": r"\d(?:[ -]?\d){12,18}",
}
_EDGE, _END = r"(?<![\p{L}\d_])(?<!\d[.])", r"(?![\p{L}\d_])"
#: The date of a timestamp.
_STAMPED = FORMS["iso"] + r"(?=T\d)"
ANY = _EDGE + "(?:(?:" + "|".join(FORMS.values()) + ")" + _END + "|" + _STAMPED + ")"
_FIXED = "(?:" + "|".join(v for k, v in FORMS.items() if k != "card") + ")"
#: At each place where a card may begin, the longest run of its digits; neither begins nor goes on where a fixed form does.
_RUN = _EDGE + f"(?!{_FIXED}{_END})" + rf"(?=(\d(?:(?:[ -](?!{_FIXED}{_END}))?\d){{12,18}}){_END})"
#: Cheap, and true of every text in which ANY occurs.
_GATE = "[0-9][ .-]?[0-9]"


def _feistel(a: Column, b: Column, m, n, key: str, kind: str) -> Column:
    """A permutation of pairs (a, b), 0 <= a < m, 0 <= b < n: struct of a and b. m and n are under 2**59."""
    m, n = (x.cast("bigint") if isinstance(x, Column) else F.lit(x).cast("bigint") for x in (m, n))

    def turn(s: Column, r: Column) -> Column:
        f = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), m.cast("string"), n.cast("string"), r.cast("string"), s["b"].cast("string")), 256), 1, 14), 16, 10).cast("bigint")
        return F.struct(s["b"].alias("a"), F.pmod(s["a"] + f, F.when(r % 2 == 0, m).otherwise(n)).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(_ROUNDS - 1)), F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b")), turn)


def _walked(a: Column, b: Column, m: int, n: int, key: str, kind: str, valid) -> Column:
    """A permutation of the pairs that valid(struct of a and b) admits, of which (a, b) is one."""
    step = lambda s: _feistel(s["a"], s["b"], m, n, key, kind)
    return F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), _feistel(a, b, m, n, key, kind), lambda s, _: F.when(valid(s), s).otherwise(step(s)))


def _number(x: Column) -> Column:
    return x.try_cast("bigint")


def _refill(form: Column, digits: Column) -> Column:
    """form with its digits replaced, in order."""
    step = F.aggregate(
        F.split(form, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(s["out"], F.substr(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
    )
    return step["out"]


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _check_digit(body: Column) -> Column:
    """The digit that makes body valid by Luhn."""
    total = F.aggregate(
        F.split(F.reverse(body), ""),
        F.struct(F.lit(0).alias("sum"), F.lit(True).alias("twice")),
        lambda s, c: F.struct((s["sum"] + F.when(s["twice"], F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)).otherwise(c.cast("int"))).alias("sum"), (~s["twice"]).alias("twice")),
    )["sum"]
    return F.pmod(-total, F.lit(10)).cast("string")


def _permuted(digits: Column, key: str, kind: str) -> Column:
    """digits permuted among all strings of as many digits."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    left, right = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1, n)
    got = _feistel(_number(left), _number(right), F.pow(F.lit(10), half), F.pow(F.lit(10), n - half), key, kind)
    return F.concat(F.lpad(got["a"].cast("string"), half, F.lit("0")), F.lpad(got["b"].cast("string"), n - half, F.lit("0")))


def _luhn(x: Column) -> Column:
    d = _digits(x)
    return _check_digit(F.substr(d, F.lit(1), F.length(d) - 1)) == F.right(d, F.lit(1))


def _card(x: Column, key: str) -> Column:
    d = _digits(x)
    body = F.substr(d, F.lit(1), F.length(d) - 1)
    new = _permuted(body, key, "card")
    return F.when(_luhn(x), _refill(x, F.concat(new, _check_digit(new))))


def _phone(x: Column, key: str) -> Column:
    d = _digits(x)
    code = F.length(d) - 10
    return _refill(x, F.concat(F.substr(d, F.lit(1), code), _permuted(F.substr(d, code + 1, F.lit(10)), key, "phone")))


def _ipv4(x: Column, key: str) -> Column:
    o = F.transform(F.split(x, r"\."), lambda v: _number(v))
    fits = F.forall(o, lambda v: v <= 255) & (F.array_join(F.transform(o, lambda v: v.cast("string")), ".") == x)
    s = _feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ipv4")
    return F.when(fits, F.concat_ws(".", *(v.cast("int").cast("string") for v in (F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256))))


def _ssn(x: Column, key: str) -> Column:
    p = F.transform(F.split(x, "-"), lambda v: _number(v))
    fits = (p[0] >= 1) & (p[0] <= 899) & (p[0] != 666) & (p[1] >= 1) & (p[2] >= 1)
    area = p[0] - 1 - F.when(p[0] > 666, 1).otherwise(0)
    s = _feistel(area, (p[1] - 1) * 9999 + p[2] - 1, 898, 99 * 9999, key, "ssn")
    back = s["a"] + 1 + F.when(s["a"] >= 665, 1).otherwise(0)
    return F.when(fits, F.concat_ws("-", F.lpad(back.cast("string"), 3, "0"), F.lpad((F.floor(s["b"] / 9999) + 1).cast("int").cast("string"), 2, "0"), F.lpad((s["b"] % 9999 + 1).cast("string"), 4, "0")))


def _day(year: Column, month: Column, day: Column) -> Column:
    """A date of such digits, else null."""
    return F.when(year != "0000", F.concat_ws("-", year, month, day).try_cast("date"))


def _date(x: Column, key: str, form: str, year: int, month: int, day: int) -> Column:
    """Null where x, read by positions, is no date."""
    at = F.datediff(_day(F.substring(x, year, 4), F.substring(x, month, 2), F.substring(x, day, 2)), F.lit(_BASE).cast("date"))
    s = _walked(F.floor(at / _SIDE), at % _SIDE, _SIDE, _SIDE, key, form, lambda s: s["a"] * _SIDE + s["b"] < _DAYS)
    return F.when(at.isNotNull(), F.date_format(F.date_add(F.lit(_BASE).cast("date"), (s["a"] * _SIDE + s["b"]).cast("int")), form))


def _slashed(x: Column, key: str) -> Column:
    """Of nn/nn/yyyy, in which either number may be the month; null where neither reading is a date."""
    padded = lambda v, n: F.lpad(v.cast("string"), n, "0")

    def fits(one: Column, two: Column, year: Column) -> Column:
        return _day(year, one, two).isNotNull() | _day(year, two, one).isNotNull()

    def parts(s: Column) -> tuple[Column, Column, Column]:
        return padded(F.floor(s["a"] / 31) + 1, 2), padded(s["a"] % 31 + 1, 2), padded(s["b"] + 1, 4)

    one, two, year = F.substring(x, 1, 2), F.substring(x, 4, 2), F.substring(x, 7, 4)
    s = _walked((_number(one) - 1) * 31 + _number(two) - 1, _number(year) - 1, 961, 9999, key, "slashed", lambda s: fits(*parts(s)))
    return F.when(fits(one, two, year), F.concat_ws("/", *parts(s)))


def pseudonym(x: Column, key: str) -> Column:
    """Of one string that ANY has matched; null where it isn't valid."""
    like = lambda kind: x.rlike("^(?:" + FORMS[kind] + ")$")
    return (
        F.when(like("phone"), _phone(x, key)).when(like("ipv4"), _ipv4(x, key)).when(like("iso"), _date(x, key, "yyyy-MM-dd", 1, 6, 9))
        .when(like("slashed"), _slashed(x, key))
        .when(like("dotted"), _date(x, key, "dd.MM.yyyy", 7, 4, 1)).when(like("ssn"), _ssn(x, key)).when(like("card"), _card(x, key))
    )


def _cards(text: Column) -> Column:
    """The different valid cards that occur in text, longer ones first: runs of digits and what they begin with, up to a separator."""
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(_RUN), F.lit(1)))
    starts = F.flatten(F.transform(runs, lambda x: F.array(*(F.regexp_extract(x, rf"^\d(?:[ -]?\d){{{n}}}(?!\d)", 0) for n in range(12, 19)))))
    valid = F.filter(F.array_distinct(starts), lambda x: (x != "") & _luhn(x))
    return F.transform(F.reverse(F.array_sort(F.transform(valid, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))), lambda s: s["x"])


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str = "n_pseudonyms") -> DataFrame:
    """docs with text rewritten and a column of how many values were (which replaces one of that name)."""
    base = docs.drop(count, "_cards", "_form", "_found", "_new")
    # every form has two digits with at most one separator between them; most texts end here
    # a text's valid cards are named in its pattern, so a number beside a card isn't taken with it
    form = F.when(F.col(text).rlike(_GATE), F.concat(F.lit(f"{_EDGE}(?=[+(\\d])(?:(?:"), F.array_join(F.concat("_cards", F.array(F.lit(_FIXED))), "|"), F.lit(f"){_END}|{_STAMPED})")))
    out = base.withColumn("_cards", F.when(F.col(text).rlike(_GATE), F.when(F.col(text).rlike(FORMS["card"]), _cards(F.col(text))).otherwise(F.array().cast("array<string>")))).withColumn("_form", form)
    out = out.withColumn("_found", F.when(F.col("_form").isNotNull(), F.regexp_extract_all(text, "_form", F.lit(0)))).withColumn("_new", F.when(F.size("_found") > 0, F.transform("_found", lambda x: pseudonym(x, key))))
    between = F.when(F.size("_found") > 0, F.split(text, F.col("_form"), -1))
    whole = F.array_join(F.zip_with(between, F.concat(F.zip_with("_new", "_found", lambda a, b: F.coalesce(a, b)), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    done = F.coalesce(F.size(F.filter("_new", lambda x: x.isNotNull())), F.lit(0)).cast("bigint")
    kept = [F.when(F.size("_found") > 0, whole).otherwise(F.col(text)).alias(text) if c == text else F.col(f"`{c}`") for c in base.columns]
    return out.select(*kept, F.when(F.size("_found") > 0, done).otherwise(F.lit(0).cast("bigint")).alias(count))
