"""The ten operators against brute force, round trips and edge cases."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from folioscope.llm import bpe, chat, decontaminate, jaccard, media, pseudonyms, substrings, toxicity, urlfilter, warc
from folioscope.llm.common import Words

NASTY = [None, "", " \n\t ", "one", "Tie tie", "ü" * 50, "a b c d e " * 60, "a b c d e " * 60, "x " * 5000]


def docs(spark, texts):
    """With null and repeated ids, and columns that clash with those the operators add."""
    rows = [(i if i != 3 else None, t, "kept", i) for i, t in enumerate(texts)] + [(0, texts[0] if texts else None, "kept", -1)] * bool(texts)
    return spark.createDataFrame(rows, "doc_id bigint, text string, hits string, score bigint")


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


# chat


def test_chat_round_trip(spark):
    random.seed(1)
    alphabet = ["<", "|", "\\", "N", "\n", "<|im_end|>", "<|im_start|>", "é", "assistant", ">"]
    texts = ["".join(random.choices(alphabet, k=random.randint(0, 12))) for _ in range(400)]
    def part():
        kind = random.choice(["text", "text", None, "image", "audio", "document", "video", "text:0|>"])
        return {"type": kind, "text": "".join(random.choices(alphabet, k=random.randint(0, 6))), "ref": "r", "width": 30, "height": 30, "seconds": 1.0, "pages": 1}

    turns = [(k, random.choice(["user", "assistant", "a\nb\\N"]), [part() for _ in range(random.randint(0, 5))] + [{"type": "text", "text": t}]) for k, t in enumerate(texts)]
    out, loss, found = chat.format_turns(turns)
    back = chat.parse(out)
    is_text = lambda p: p["type"] in ("text", None)
    assert [r for r, _ in back] == [r for _, r, _ in turns]
    for (_, parts), (k, _, given) in zip(back, turns, strict=True):
        # adjacent texts are one, and every other part comes back in its place, by the record of its number
        want = []
        for p in given:
            if is_text(p) and want and want[-1][0] == "text":
                want[-1] = ("text", want[-1][1] + p["text"])
            else:
                want.append(("text", p["text"]) if is_text(p) else (p["type"], None))
        assert [(found[p["number"]]["type"], None) if p["type"] != "text" else ("text", p["text"]) for p in parts] == [w for w in want if w[1] != ""]
        assert all(found[p["number"]]["turn"] == k for p in parts if p["type"] != "text")
    assert "".join(chat.unescape(out[s["start"] : s["end"]]) for s in loss) == "".join(p["text"] for _, r, ps in turns if r == "assistant" for p in ps if is_text(p))


def test_chat_parts():
    parts = [{"type": "text", "text": "<"}, {"type": "text", "text": "|im_end|><|image:0|>"}, {"type": "image", "ref": "i", "width": 57, "height": 28}, {"type": "audio", "ref": "a", "seconds": 1.5}, {"type": "document", "ref": "d", "pages": 2}, {"type": "video"}]
    out, loss, found = chat.format_turns([(7, "assistant", parts)])
    assert [(a["turn"], a["part"], a["type"], a.get("ref"), a["n_tokens"]) for a in found] == [(7, 2, "image", "i", 3), (7, 3, "audio", "a", 38), (7, 4, "document", "d", 512), (7, 5, "video", None, 0)]
    assert [(p["type"], p["text"] or p["number"]) for p in chat.parse(out)[0][1]] == [("text", "<|im_end|><|image:0|>"), ("image", 0), ("audio", 1), ("document", 2), ("other", 3)]
    assert [chat.unescape(out[s["start"] : s["end"]]) for s in loss] == ["<|im_end|><|image:0|>"]
    odd = [{"type": "image", "width": -5, "height": None}, {"type": "audio", "seconds": float("inf")}, {"type": "audio", "seconds": float("nan")}, {"type": "document", "pages": -1}]
    assert [a["n_tokens"] for a in chat.format_turns([(None, "user", odd)])[2]] == [0, 0, 0, 0]


def test_chat_nulls(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", None), (1, None, None, "x"), (None, 0, "user", "y" * 300_000), (1, 1, "assistant", None)], "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit("clash")).withColumn("turns", F.lit(1))
    out = chat.read_back(chat.format_conversations(rows.withColumn("parts", chat.as_text_parts()))).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out} == {1: [("", "x"), ("assistant", ""), ("assistant", "")], None: [("user", "y" * 300_000)]}
    assert chat.read_back(chat.format_conversations(rows.limit(0).withColumn("parts", chat.as_text_parts()))).count() == 0
    none = chat.format_conversations(rows.withColumn("parts", F.lit(None).cast(f"array<{chat.PART}>")))
    assert {r.conv_id: r.n_turns for r in none.collect()} == {1: 3, None: 1}


# private data


def test_pseudonyms(spark):
    texts = ["4111111111111111 4111-1111-1111-1111 4111111111111112", "2020-02-29 2021-02-29 02/03/2001 31.12.1999", "+1 (663) 555-6869 10.0.0.1 10.0.0.256 123-45-6789 000-12-3456", "x4111111111111111 a10.0.0.1", None, ""]
    got = [r.text for r in pseudonyms.pseudonymise(docs(spark, texts).orderBy("score"), "k").where("score >= 0").orderBy("score").collect()]
    a, b, bad = got[0].split(" ")
    assert a != "4111111111111111" and a == b.replace("-", "") and len(a) == 16 and bad == "4111111111111112"
    assert sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(a)) % 10 == 0
    assert got[1].split(" ")[1] == "2021-02-29" and got[2].split(" ")[-1] == "000-12-3456" and "10.0.0.256" in got[2]
    assert got[3:] == texts[3:]
    assert pseudonyms.pseudonymise(empty(spark), "k").count() == 0


def test_pseudonyms_are_permutations(spark):
    days = spark.range(0, 20000).select(F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    got = pseudonyms.pseudonymise(days, "k").where("n_pseudonyms = 1")
    assert got.select("text").distinct().count() == 20000 and got.where("try_cast(text as date) is null").count() == 0


def test_pseudonyms_of_lone_digits(spark):
    texts = ["dns 8.8.8.8 here", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1", "8.8.8.8 and 12", "4111111111111111", "1 2 3"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [(r.text, r.n_pseudonyms) for r in pseudonyms.pseudonymise(rows, "k").orderBy("doc_id").collect()]
    assert [n for _, n in got] == [1, 1, 1, 1, 1, 0] and got[5][0] == "1 2 3"
    assert "8.8.8.8" not in got[0][0] and got[0][0].split()[1] == got[3][0].split()[0]
    assert got[1][0].replace(" ", "") == got[2][0].replace("-", "") == got[4][0] != texts[4]


def test_pseudonyms_of_cards_beside_numbers(spark):
    card = "4111111111111111"
    texts = [card, "4111 1111 1111 1111 123", f"{card} 12 apples", f"7 {card}", f"12345678 {card} 12345678", f"{card} 123-45-6789", f"{card} 10.0.0.1", "1 2 " * 3000 + card]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [(r.text, r.n_pseudonyms) for r in pseudonyms.pseudonymise(rows, "k").orderBy("doc_id").collect()]
    new = got[0][0]
    assert new != card and [n for _, n in got[:7]] == [1, 1, 1, 1, 1, 2, 2]
    assert got[1][0] == " ".join(new[i : i + 4] for i in range(0, 16, 4)) + " 123"
    assert [t for t, _ in got[2:5]] == [f"{new} 12 apples", f"7 {new}", f"12345678 {new} 12345678"]
    assert got[5][0].startswith(new + " ") and "6789" not in got[5][0] and got[6][0].startswith(new + " ") and "10.0.0.1" not in got[6][0]
    assert card not in got[7][0]


def test_pseudonyms_of_timestamps(spark):
    texts = ["2024-03-05T10:00:00Z", "2024-03-05", "at 2024-03-05T10, 2024-03-05Tea", "2024-02-30T10:00", "x2024-03-05T10", "2024-03-05T4111111111111111"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [(r.text, r.n_pseudonyms) for r in pseudonyms.pseudonymise(rows, "k").orderBy("doc_id").collect()]
    new = got[1][0]
    assert new != "2024-03-05" and got[0] == (f"{new}T10:00:00Z", 1) and got[2] == (f"at {new}T10, 2024-03-05Tea", 1)
    assert [n for _, n in got[3:]] == [0, 0, 1] and got[5][0] == f"{new}T4111111111111111"


def test_pseudonyms_of_plain_telephone_numbers(spark):
    texts = ["(212) 555-0187", "212-555-0187", "212.555.0187", "+1 212 555 0187", "+1-212-555-0187", "1212-555-0187", "1799-12-31 2099-12-21 0000-01-01 2101-02-30"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [(r.text, r.n_pseudonyms) for r in pseudonyms.pseudonymise(rows, "k").orderBy("doc_id").collect()]
    assert [n for _, n in got] == [1, 1, 1, 1, 1, 0, 2] and got[3][0].startswith("+1 ") and got[5][0] == texts[5] and got[6][0].endswith(" 0000-01-01 2101-02-30")
    assert len({"".join(filter(str.isdigit, t))[-10:] for t, _ in got[:5]}) == 1 and "2125550187" not in got[0][0].replace("-", "")


def plain_feistel(a, b, m, n, key, kind):
    import hashlib

    for r in range(10):
        f = int(hashlib.sha256(f"{key}|{kind}|{m}|{n}|{r}|{b}".encode()).hexdigest()[:14], 16)
        a, b = b, (a + f) % (n if r % 2 else m)
    return a, b


def is_day(y, m, d):
    import datetime

    try:
        return bool(datetime.date(y, m, d))
    except ValueError:
        return False


def plain_pseudonym(kind, x, key="k"):
    """The same permutations without Spark; x is a valid value."""
    import datetime

    digits = "".join(c for c in x if c.isdigit())

    def string(d, name):
        h = len(d) // 2
        a, b = plain_feistel(int(d[:h]), int(d[h:]), 10**h, 10 ** (len(d) - h), key, name)
        return f"{a:0{h}}{b:0{len(d) - h}}"

    def refill(new):
        it = iter(new)
        return "".join(next(it) if c.isdigit() else c for c in x)

    if kind == "phone":
        return refill(digits[:-10] + string(digits[-10:], "phone"))
    if kind == "card":
        body = string(digits[:-1], "card")
        total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(body)))
        return refill(body + str(-total % 10))
    if kind == "ipv4":
        o = list(map(int, x.split(".")))
        a, b = plain_feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ipv4")
        return ".".join(map(str, (*divmod(a, 256), *divmod(b, 256))))
    if kind == "ssn":
        p, q, r = map(int, x.split("-"))
        areas = [i for i in range(1, 900) if i != 666]
        a, b = plain_feistel(areas.index(p), (q - 1) * 9999 + r - 1, 898, 99 * 9999, key, "ssn")
        return f"{areas[a]:03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}"
    if kind == "slashed":
        a, b, y = map(int, x.split("/"))
        s = ((a - 1) * 31 + b - 1, y - 1)
        while True:
            s = plain_feistel(*s, 961, 9999, key, "slashed")
            a, b, y = s[0] // 31 + 1, s[0] % 31 + 1, s[1] + 1
            if is_day(y, a, b) or is_day(y, b, a):
                return f"{a:02}/{b:02}/{y:04}"
    form, shape = {"iso": ("yyyy-MM-dd", "%Y-%m-%d"), "dotted": ("dd.MM.yyyy", "%d.%m.%Y")}[kind]
    s = divmod(datetime.datetime.strptime(x, shape).toordinal() - 1, 1912)
    while True:
        s = plain_feistel(*s, 1912, 1912, key, form)
        if s[0] * 1912 + s[1] < 3_652_059:
            d = datetime.date.fromordinal(s[0] * 1912 + s[1] + 1)
            return f"{d.year:04}-{d.month:02}-{d.day:02}" if kind == "iso" else f"{d.day:02}.{d.month:02}.{d.year:04}"


def test_pseudonyms_equal_plain_permutations(spark):
    """Each format against plain Python; a text too long for one line of thought holds them all."""
    import random

    random.seed(5)
    card = lambda b: b + str(-sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(b))) % 10)
    values = [("card", card("".join(random.choices("0123456789", k=n)))) for n in range(12, 19) for _ in range(6)]
    values += [("phone", f"({random.randint(0, 999):03}) {random.randint(0, 999):03}-{random.randint(0, 9999):04}") for _ in range(20)]
    values += [("ipv4", ".".join(str(random.randint(0, 255)) for _ in range(4))) for _ in range(20)]
    values += [("ssn", f"{random.choice([1, 665, 667, 899])}".zfill(3) + f"-{random.randint(1, 99):02}-{random.randint(1, 9999):04}") for _ in range(20)]
    values += [("iso", x) for x in ("0001-01-01", "9999-12-31", "2099-12-25", "1799-05-05", "2000-02-29")]
    values += [("dotted", x) for x in ("01.01.0001", "31.12.9999", "29.02.2096")]
    values += [("slashed", x) for x in ("02/29/2024", "29/02/2024", "12/12/2012", "31/01/0001", "01/31/9999", "02/03/2001")]
    rows = spark.createDataFrame([(i, f"a {v} b") for i, (_, v) in enumerate(values)] + [(-1, " ; ".join(v for _, v in values) + " word" * 200_000)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(rows, "k").collect()}
    want = [plain_pseudonym(k, v) for k, v in values]
    assert [got[i].text for i in range(len(values))] == [f"a {w} b" for w in want]
    assert got[-1].text == " ; ".join(want) + " word" * 200_000 and got[-1].n_pseudonyms == len(values)


def test_pseudonyms_of_dates_are_permutations(spark):
    """All slashed strings of some years that either reading takes for a date, and days near the calendar's ends: as many out as in."""
    slashed = spark.range(0, 33 * 33 * 40).selectExpr("concat(lpad(cast(id % 33 as string), 2, '0'), '/', lpad(cast(id div 33 % 33 as string), 2, '0'), '/', cast(1980 + id div 1089 as string)) as text")
    days = spark.range(0, 8000).selectExpr("date_format(date_add(date '0001-01-01', cast(if(id % 2 = 0, id, 3652058 - id) as int)), 'dd.MM.yyyy') as text")
    for rows in (slashed, days):
        got = pseudonyms.pseudonymise(rows.withColumn("was", F.col("text")), "k").where("n_pseudonyms = 1").cache()
        assert got.count() == got.select("text").distinct().count() == got.select("was").distinct().count() > 7000
        assert got.where("text rlike '^[0-9]{2}[/.][0-9]{2}[/.][0-9]{4}$'").count() == got.count()
    assert got.where("try_to_date(text, 'dd.MM.yyyy') is null").count() == 0


def test_pseudonyms_of_empty_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, None, "x", 7), (1, "", "y", 8), (2, "10.0.0.1", "z", 9), (2, "10.0.0.1", "z", 9)], "doc_id bigint, text string, _found string, n_pseudonyms int")
    got = pseudonyms.pseudonymise(rows, "k").orderBy("doc_id", F.col("text").asc_nulls_first()).collect()
    assert [r.n_pseudonyms for r in got] == [0, 0, 1, 1] and got[0].text is None and got[1].text == "" and got[2].text == got[3].text


# captures


def test_revisits(spark):
    schema = "record_id bigint, url string, ts bigint, status int, digest string, headers map<string,string>"
    rows = [
        (1, "http://www.a.org/x", 10, 200, "d1", {"ETag": '"1"', "Content-Type": "t"}), (2, "http://a.org/x/?", 100_000, 200, "d2", {"ETag": '"2"'}), (9, "http://a.org/v?id=1", 10, 200, "v1", {}), (10, "http://a.org/v/?id=2#x", 20, 304, None, {}), (11, "http://m.a.org/v/?id=1", 20, 304, None, {}), (3, "https://A.org/x#f", 200_000, 304, None, {"etag": 'W/"2"', "Date": "now", "Content-Type": "no"}),
        (4, "http://a.org/x", 50, 304, None, {"ETag": '"9"'}), (5, "http://a.org/y", 60, 304, None, None), (6, None, 60, 304, None, {}), (7, "http://a.org/x", 10, 304, None, {}), (8, "http://a.org/x", None, 304, None, {}),
    ]
    got = {r.record_id: r for r in warc.resolve(spark.createDataFrame(rows, schema)).collect()}
    assert {k: (r.base_id, r.outcome) for k, r in got.items()} == {3: (2, "resolved"), 4: (None, "stale"), 5: (None, "no_base"), 6: (None, "no_base"), 7: (1, "unchecked"), 8: (None, "no_base"), 10: (None, "no_base"), 11: (9, "unchecked")}
    assert got[3].headers == {"etag": 'W/"2"', "date": "now"} and got[7].headers == {"etag": '"1"', "content-type": "t"}
    assert warc.resolve(spark.createDataFrame([], schema)).count() == 0


def test_revisits_equal_brute_force(spark):
    """Repeated rows, ties, one hot URL of one day over many ranges, and columns with names that the operator uses."""
    import random

    random.seed(11)
    schema = "record_id bigint, url string, ts bigint, status int, digest string, headers map<string,string>, u string, _row int"
    urls = ["http://hot.org/a"] * 6 + ["http://b.org/x", "http://b.org/x?y", "http://c.org/"]
    rows = [(random.randint(1, 60), random.choice(urls), random.randint(0, 40), random.choice([200, 304, 304, 404]), random.choice(["p", "q", None]), {"ETag": f'"{random.randint(1, 2)}"'} if random.random() < 0.7 else {}, "x", 1) for _ in range(400)]
    rows += rows[:20]

    def want(r):
        full = [(x[2], x[0], x[4] or "") for x in rows if x[3] == 200 and x[1] == r[1] and (x[2], x[0]) < (r[2], r[0])]
        return max(full, default=None)

    got = warc.resolve(spark.createDataFrame(rows, schema), ranges=13).select("record_id", "base_id", "base_digest", "outcome").collect()
    expected = [(r[0], want(r)) for r in rows if r[3] == 304]
    assert len(got) == len(expected)
    assert sorted((r.record_id, r.outcome == "no_base") for r in got) == sorted((i, w is None) for i, w in expected)
    known = {}
    for i, w in expected:
        known.setdefault(i, set()).add(None if w is None else (w[1], w[2]))
    assert all((r.base_id, r.base_digest or "") in known[r.record_id] for r in got if r.base_id is not None)


# images


def scene(seed):
    rng = np.random.default_rng(seed)
    a = np.full((160, 160), 128.0)
    for _ in range(60):
        y, x, h, w = rng.integers(0, 140), rng.integers(0, 140), rng.integers(8, 40), rng.integers(8, 40)
        a[y : y + h, x : x + w] = rng.integers(0, 256)
    return a.astype(np.uint8)


def test_image_copies(spark):
    rows = [(50 * i, 160, scene(i)) for i in range(4)]
    rows += [(1, 120, scene(1)[20:140, 30:150]), (2, 160, np.clip(scene(2) * 0.9 + 12, 0, 255).astype(np.uint8)), (3, 160, scene(3)), (4, 160, scene(77)), (5, 160, None), (6, 0, b"")]
    table = spark.createDataFrame([(i, w, bytearray(p.tobytes() if hasattr(p, "tobytes") else p) if p is not None else None) for i, w, p in rows], "image_id bigint, width int, pixels binary")
    got = {r.image_id: (r.class_id, [c.query_class for c in r.copies]) for r in media.copies(table, F.col("image_id") % 50 == 0).collect()}
    assert got[1] == (1, [50]) and got[2] == (2, [100]) and got[3] == got[150] == (3, []) and got[4] == (4, []) and got[5][1] == []
    assert len(got) == len(rows)


def test_image_copies_equal_brute_force(spark):
    c = media.Config()
    images = {i: scene(i // 4) if i % 4 == 0 else scene(100 + i) for i in range(0, 48)}
    for i in range(0, 48, 4):
        whole = images[i]
        images[i + 1] = np.clip(whole[8:] * 0.8 + 20, 0, 255).astype(np.uint8)
        images[i + 2] = np.rot90(whole).copy()
        images[i + 3] = whole.copy()
        images[i + 3][60:90, 50:110] = 7
    table = spark.createDataFrame([(i, a.shape[1], bytearray(a.tobytes())) for i, a in images.items()], "image_id bigint, width int, pixels binary")
    got = {(r.image_id, k.query_class, k.votes) for r in media.copies(table, F.col("image_id") % 4 == 0).collect() for k in r.copies}
    seen = {i: media.describe(a, c) for i, a in images.items()}
    want = set()
    for q in range(0, 48, 4):
        for i in images:
            m = [(*x[:4], *y[:4]) for x in seen[q] for y in seen[i] if (int.from_bytes(x[4]) ^ int.from_bytes(y[4])).bit_count() <= c.radius]
            if i != q and len(m) >= c.votes and (votes := media.consensus(np.array(m, np.float32).astype(np.float64), c)) >= media.needed(len(seen[q]), len(seen[i]), c):
                want.add((i, q, votes))
    assert {x[:2] for x in got} == {x[:2] for x in want}
    assert len({(i, q) for i, q, _ in got if i // 4 == q // 4}) >= 30
    assert media.copies(table.limit(0), F.lit(True)).count() == 0


def mosaic(seed):
    rng = np.random.default_rng(seed)
    at = np.clip(np.searchsorted([0, *(np.arange(1, 8) * 15 + rng.integers(-3, 4, 7)), 120], np.arange(120), "right") - 1, 0, 7)
    return rng.integers(8, 249, (8, 8)).astype(np.uint8)[np.ix_(at, at)]


def edited(a, seed):
    h, m = len(a) // 8, len(a) // 2
    block = a.copy()
    block[m - 20 : m + 20, m - 30 : m + 30] = 7
    noisy = np.clip(a + np.random.default_rng(seed).normal(0, 6, a.shape), 0, 255).astype(np.uint8)
    smaller = np.rint(media._resized(media._blur(a.astype(float)), 1.5)).astype(np.uint8)
    return {"crop": a[h:-h, h:-h], "small crop": a[m - 32 : m + 32, m - 32 : m + 32], "gain": np.clip(a * 0.8 + 20, 0, 255).astype(np.uint8), "noise": noisy, "turn": np.rot90(a).copy(), "block": block, "smaller": smaller}


@pytest.mark.parametrize("draw", [scene, mosaic])
def test_edited_images_are_found(draw):
    c = media.Config()

    def found(x, y):
        m = [(*p[:4], *q[:4]) for p in x for q in y if (int.from_bytes(p[4]) ^ int.from_bytes(q[4])).bit_count() <= c.radius]
        return len(m) >= c.votes and media.consensus(np.array(m), c) >= media.needed(len(x), len(y), c)

    images = [draw(i) for i in range(25)]
    seen = [media.describe(a, c) for a in images]
    hits = {}
    for i, a in enumerate(images):
        for name, b in edited(a, i).items():
            hits[name] = hits.get(name, 0) + found(seen[i], media.describe(b, c))
    assert min(hits.values()) >= 0.9 * len(images), hits
    assert not any(found(seen[i], seen[k]) for i in range(len(images)) for k in range(i))


def test_descriptors_by_plain_tests():
    """Bits of a corner by the definition, pixel by pixel; unrelated noise and flat images have no links."""
    c = media.Config()
    a = scene(3).astype(float)
    kind = media._corner(c)
    blurred = media._blur(a)
    pattern, reach = media._pattern(c.seed, c.reach), c.reach
    for x, y, s, t, bits in [d for d in media.describe(a, c) if d[2] == 1][:20]:
        x, y = int(x), int(y)
        disc = [(dy, dx) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1) if dy * dy + dx * dx <= reach * reach]
        patch = np.array([blurred[y + dy, x + dx] for dy, dx in disc])
        assert abs(np.arctan2(sum(p * dy for p, (dy, _) in zip(patch, disc)), sum(p * dx for p, (_, dx) in zip(patch, disc))) - t) < 1e-6
        at = lambda u, v: blurred[int(np.rint(y + u * np.sin(t) + v * np.cos(t))), int(np.rint(x + u * np.cos(t) - v * np.sin(t)))]
        want = [at(p[2], p[3]) - at(p[0], p[1]) > m * patch.std() for m in c.margins for p in pattern]
        words = np.frombuffer(bits, "<u8")
        assert kind["h"].shape == words.shape
        got = [bool(np.frombuffer(words[k % len(words)].tobytes(), np.uint8)[k // len(words) // 8] >> (7 - k // len(words) % 8) & 1) for k in range(len(want))]
        assert sum(g != w for g, w in zip(got, want)) <= 2  # rounding at borders of pixels
    rng = np.random.default_rng(0)
    assert media.describe(np.full((90, 90), 7, np.uint8), c) == []
    noise = [media.describe(rng.integers(0, 256, (90, 90)).astype(np.uint8), c) for _ in range(2)]
    m = [(*p[:4], *q[:4]) for p in noise[0] for q in noise[1] if (int.from_bytes(p[4]) ^ int.from_bytes(q[4])).bit_count() <= c.radius]
    assert not m or media.consensus(np.array(m), c) < c.votes


def board(cell, dx, dy, low=40, high=215, side=256):
    y, x = np.mgrid[:side, :side]
    return np.where(((x + dx) // cell + (y + dy) // cell) % 2 == 0, low, high).astype(np.uint8)


def test_repeated_texture_is_bounded(spark):
    """Checkerboards, whose corners all look alike: few corners of a kind are kept, pairs are taken in portions, and copies are found."""
    import time

    images = [board(16, k % 8, k // 8, 40 + k) for k in range(32)]
    c = media.Config()
    seen = [media.describe(a, c) for a in images]
    assert all(max(Counter((d[2], d[4]) for d in own).values()) <= c.same for own in seen) and min(map(len, seen)) >= 16
    rows = [(k, 256, bytearray(a.tobytes())) for k, a in enumerate(images)] + [(100 + k, 160, bytearray(scene(k).tobytes())) for k in range(4)]
    table = spark.createDataFrame(rows, "image_id bigint, width int, pixels binary").repartition(1)
    began = time.time()
    got = {r.image_id: {k.query_class for k in r.copies} for r in media.copies(table, F.col("image_id") < 32).collect()}
    assert time.time() - began < 60
    # any two boards of one cell size are shifts of each other, and no scene is a board
    assert all(got[k] == set(range(32)) - {k} for k in range(32)) and not any(got[100 + k] for k in range(4))
    # the same in small portions
    q = media._Table([np.array([(*d[:4], np.frombuffer(d[4], "<u8")) for d in own], media._corner(c)).tobytes() for own in seen[:8]], c).sort()
    packed = [np.array([(*d[:4], np.frombuffer(d[4], "<u8")) for d in own], media._corner(c)).tobytes() for own in seen[8:16]]
    whole = sorted(media._agreeing(q, packed, c))
    kept, media._PAIRS = media._PAIRS, 1000
    try:
        assert sorted(media._agreeing(q, packed, c)) == whole and len(whole) == 64
    finally:
        media._PAIRS = kept


def packed(own, c):
    return np.array([(*d[:4], np.frombuffer(d[4], "<u8")) for d in own], media._corner(c)).tobytes()


def test_image_pairs_with_enough_votes_are_never_ruled_out():
    """Five corners whose turns lie at both ends of what may agree with the one in the middle, at any turn; on scales of even and odd steps."""
    c = media.Config()
    rng = np.random.default_rng(3)
    for k in range(24):
        bits = rng.integers(0, 1 << 32, (5, c.radius + 1)).astype("<u8")
        places = rng.uniform(20, 90, (5, 2))
        whole, off = 2 * np.pi * k / 24 + 0.05, np.array([0, -0.44, -0.44, 0.44, 0.44])
        turn = np.angle(np.exp(1j * (whole + off)))
        s, t = c.scales[k % 3], c.scales[(k + k // 3) % 3]
        moved = (places[:, 0] + 1j * places[:, 1]) * np.exp(1j * whole) * (t / s) + 7
        a = [(*p, s, 0.0, b.tobytes()) for p, b in zip(places, bits)]
        b = [(z.real, z.imag, t, u, d.tobytes()) for z, u, d in zip(moved, turn, bits)]
        assert list(media._agreeing(media._Table([packed([], c), packed(a, c)], c).sort(), [packed(b, c), packed([], c)], c)) == [(1, 0, 5)], k


def test_image_pairs_equal_plain_comparison():
    """All pairs of mosaics that share a corner of the picture, more or less of it, with their votes."""
    c = media.Config()
    images = []
    for i in range(24):
        a, b = mosaic(i % 4), mosaic(50 + i)
        cut = 20 + 4 * i
        b[:cut, :cut] = a[:cut, :cut]
        images.append(np.rot90(b, i % 3).copy())
    seen = [media.describe(a, c) for a in [mosaic(k) for k in range(4)] + images]
    want = set()
    for q in range(4):
        for i, own in enumerate(seen):
            m = [(*x[:4], *y[:4]) for x in seen[q] for y in own if (int.from_bytes(x[4]) ^ int.from_bytes(y[4])).bit_count() <= c.radius]
            if m and (votes := media.consensus(np.array(m, np.float32).astype(np.float64), c)) >= media.needed(len(seen[q]), len(own), c):
                want.add((q, i, votes))
    q = media._Table([packed(own, c) for own in seen[:4]], c).sort()
    assert set(media._agreeing(q, [packed(own, c) for own in seen], c)) == want
    assert 10 < len(want) < 60 and min(v for _, _, v in want) < 12


def test_image_pairs_take_little_time():
    """65,536 pairs of mosaics, by the time of a sort on the same machine."""
    import time

    c = media.Config()
    rows = [packed(media.describe(mosaic(k), c), c) for k in range(384)]
    mixed = np.random.default_rng(0).random(2_000_000)

    def least(run):
        took = []
        for _ in range(3):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    q = media._Table(rows[:256], c).sort()
    pairs, sort = least(lambda: list(media._agreeing(q, rows[128:], c))), least(lambda: np.sort(mixed.copy(), kind="stable"))
    assert pairs < 1.1 * sort


def test_images_of_odd_tables(spark):
    """Null and repeated ids, null widths, repeated pixels, clashing columns, an empty table."""
    a, b = bytearray(scene(1).tobytes()), bytearray(scene(2).tobytes())
    rows = [(None, 160, a), (50, 160, a), (50, 160, b), (7, None, a), (7, 160, a), (8, 160, None), (9, 160, bytearray(b"short"))]
    table = spark.createDataFrame(rows, "image_id bigint, width int, pixels binary").withColumns({"class_id": F.lit(1), "copies": F.lit(1), "digest": F.lit("x")})
    got = media.copies(table, F.col("image_id") == 50).collect()
    assert len(got) == len(rows) and sorted((r.image_id or -1, r.class_id) for r in got if r.class_id in (7, 50)) == [(-1, 7), (7, 7), (7, 7), (50, 7), (50, 50)]
    assert {r.class_id for r in got if r.image_id is None} == {7}
    assert media.copies(table.limit(0), F.lit(True)).count() == 0


# urls


def test_bloom_and_rules(spark):
    urls = ["http://WWW.Spam.org/a/?x", "https://spam.org/a", "http://x.example.org/es/1", "http://ok.com/de/", "nothing", None, "http://", "http://ok.net/#a"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id int, url string, listed string")
    listed = spark.createDataFrame([("http://m.spam.org/a/",), (None,), ("junk",)], "url string")
    rules = [("allow", "org", "/zz"), ("block", "example.org", "/es/"), ("block", "com", "/de/")]
    for c in (urlfilter.Config(), urlfilter.Config(broadcast=0), urlfilter.Config(inline=0)):
        got = {r.page_id: (r.rule, r.listed, r.verdict) for r in urlfilter.judge(pages, listed, rules, c).collect()}
        assert got == {0: (None, True, "block"), 1: (None, True, "block"), 2: ("example.org/es/", False, "block"), 3: ("com/de/", False, "block"), **{i: (None, False, "allow") for i in (4, 5, 6, 7)}}
    assert urlfilter.judge(pages.limit(0), listed, rules).count() == 0
    assert {r.listed for r in urlfilter.judge(pages, listed.limit(0), rules).collect()} == {False}
    twice = urlfilter.judge(pages.union(pages), listed, rules * 400)
    assert twice.count() == 2 * len(urls) and twice.where("rule = 'com/de/' and verdict = 'block'").count() == 2


def test_many_rules_are_as_few(spark):
    import random

    random.seed(2)
    hosts = ["a.org", "b.a.org", "c.b.a.org", "x.com", "org", "com", ""]
    rules = [(random.choice(["allow", "block"]), random.choice(hosts[:-1]), random.choice(["", "/", "/p", "/p/q", "/q"])) for _ in range(60)]
    pages = spark.createDataFrame([(i, f"http://{random.choice(hosts)}{random.choice(['', '/', '/p', '/p/q/r', '/qq', '?x'])}") for i in range(300)], "page_id int, url string")
    none = pages.limit(0).select("url")
    few, many = (sorted((r.page_id, r.rule or "", r.verdict) for r in urlfilter.judge(pages, none, rules, urlfilter.Config(inline=n)).collect()) for n in (200, 0))
    assert few == many


# benchmark


def edits(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("aeionrst", k=rng.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 8, 25])))) for i in range(12)]
    texts = []
    for _ in range(40):
        t = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 8)):
            k = rng.randrange(len(t))
            t[k : k + 1] = rng.choice([[], ["z"], [t[k], "é"]])
        texts.append(" ".join(word() for _ in range(20)) + " " + "".join(t) + "\n" + word())
    c = decontaminate.Config()
    want = {(i, k): d for i, t in enumerate(texts) for k, x in items if (d := edits(x, t.replace("\n", " "))) <= int(c.rate * len(x))}
    table = spark.createDataFrame(items + [(90, None), (91, "")], "item_id bigint, text string")
    got = {(r.score, h.item_id): h.edits for r in decontaminate.hits(docs(spark, texts).drop("hits").withColumn("hits", F.lit(1)), table).where("score >= 0").collect() for h in r.hits}
    assert got == want and want
    assert decontaminate.hits(docs(spark, NASTY), table).where("size(hits) > 0").count() == 0
    size = sum(len(t) for _, t in items)
    parts = {(r.score, h.item_id): h.edits for r in decontaminate.hits(docs(spark, texts), table, decontaminate.Config(most=size // 3)).where("score >= 0").collect() for h in r.hits}
    assert parts == want
    for most in (size, size // 3):
        assert decontaminate.hits(empty(spark), table, decontaminate.Config(most=most)).count() == 0
        assert decontaminate.hits(docs(spark, texts), table.limit(0), decontaminate.Config(most=most)).where("size(hits) > 0").count() == 0
    named = decontaminate.hits(docs(spark, texts), table.selectExpr("concat('i', item_id) as item_id", "text"))
    assert {(r.score, h.item_id): h.edits for r in named.where("score >= 0").collect() for h in r.hits} == {(a, f"i{b}"): d for (a, b), d in want.items()}


def test_decontamination_of_repetitive_texts():
    """Dashes, spaces and short periods: the hits of plain search, in time that follows the text's length."""
    import time

    c = decontaminate.Config()
    items = [(0, "-" * 300), (1, "x" * 20 + "-" * 280), (2, "ab" * 100), (3, "ab" * 60 + "cd" * 40), (4, "- " * 50 + "end of the rule"), (5, "abcabd" * 6)]
    index = decontaminate.Index(items, c)
    texts = ["-" * 700, "-" * 310 + "x" * 20 + "-" * 285, "ab" * 90 + "a" + "b" * 8 + "ab" * 40, "ab" * 63 + "cd" * 42, "- " * 80 + "end of thy rule", "abcabd" * 7, "abcab" * 9, "-" * 200]
    want = {(t, k): d for t, x in enumerate(texts) for k, i in items if (d := edits(i, x)) <= int(c.rate * len(i))}
    assert {(t, k): d for t, k, d, _ in decontaminate.find(texts, index)} == want and len(want) >= 6
    began = time.time()
    found = decontaminate.find(["-" * 1_000_000, "- " * 300_000, "ab" * 300_000], index)
    assert {(t, k) for t, k, _, _ in found} == {(0, 0), (2, 2)} and time.time() - began < 60


def test_decontamination_of_a_shared_stem():
    """Items that begin alike against texts that repeat the beginning: brute force at small size, and time and memory that don't multiply."""
    import time
    import tracemalloc

    rng, c = random.Random(12), decontaminate.Config()
    stem = "the following is a multiple choice question. choose an answer: "
    word = lambda: "".join(rng.choices("aeionrst", k=rng.randint(2, 6)))
    tail = lambda n: " ".join(word() for _ in range(n))
    items = [(k, stem + tail(rng.choice([4, 12, 20]))) for k in range(20)]
    # a family that differs in a few characters, which no q tells apart by rare q-grams
    long = tail(40)
    items += [(100 + k, long[: 7 * k] + "#" + long[7 * k :]) for k in range(12)]
    texts = [" ".join(stem + word() for _ in range(50)), stem * 30, "x " + items[3][1] + " y " + items[5][1].replace("choice", "chioce"), items[7][1][:-6], long, tail(5) + items[24][1] + tail(5), stem + tail(12)]
    want = {(t, k): d for t, x in enumerate(texts) for k, (_, i) in enumerate(items) if (d := edits(i, x)) <= int(c.rate * len(i))}
    for small in (c, decontaminate.Config(piece=64), decontaminate.Config(shared=1)):
        assert {(t, k): d for t, k, d, _ in decontaminate.find(texts, decontaminate.Index(items, small), small)} == want
    assert {(2, 3), (2, 5), (5, 24)} <= want.keys() and len(want) > 20
    items = [(k, stem + tail(16)) for k in range(1000)]
    text = " ".join(stem + word() for _ in range(3000)) + " " + items[17][1]
    tracemalloc.start()
    began, index = time.time(), decontaminate.Index(items, c)
    assert [(t, k, d) for t, k, d, _ in decontaminate.find([text], index)] == [(0, 17, 0)]
    assert time.time() - began < 30 and tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()
    # an item's own words many times over
    began = time.time()
    assert {(k, d) for _, k, d, _ in decontaminate.find([" ".join(items[3][1][60:] + word() for _ in range(2000))], index)} == set()
    assert time.time() - began < 30


# tokens


def test_bpe_equals_library(spark):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab \n\x1c\x85\xa0'sl1é中٣😀.!theontioer", k=rng.randint(0, 80))) for _ in range(500)] + ["a" * 30000, " " * 5000 + "x", *(t or "" for t in NASTY)]
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    assert codec.encode_all(texts) == [library.encode_ordinary(t) for t in texts]
    got = bpe.round_trip(docs(spark, NASTY), ranks, public_tokenizers.PATTERN).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in got) and len(got) == len(NASTY) + 1
    pieces = ["".join(rng.choices("theonrias", k=rng.randint(2, 40))).encode() for _ in range(300)]
    pieces = [p for p in pieces if p not in ranks]
    assert bpe.merge_many(pieces, codec.pairs) == [bpe.packed(bpe.merge(p, ranks, codec.longest)) for p in pieces]


def test_remembered_pieces_are_bounded(monkeypatch):
    """Far more pieces than are remembered: the same ids, and no more than two tables, each of the bound and one call's pieces."""
    monkeypatch.setattr(bpe, "REMEMBERED", 20_000)
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abc": 257}
    small, rng = bpe.Codec(ranks, r"\S+|\s"), random.Random(6)
    many = [["".join(rng.choices("abcd", k=rng.randint(1, 9))) for _ in range(40)] + ["abc", "x" * 90] for _ in range(60)]
    texts = [" ".join(t) for t in many]
    want = [bpe.Codec(ranks, r"\S+|\s").encode(t) for t in texts]
    for at in range(0, len(texts), 3):
        assert small.encode_all(texts[at : at + 3]) == want[at : at + 3]
        assert len(small) + len(small.older) < 2 * (20_000 / bpe._ENTRY + 130)
        assert "x" * 90 not in small
    small.forget()
    assert not small and not small.older and small.size == 0


# substrings


def test_substrings_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 90))) for _ in range(40)] + NASTY
    shared = rng.choices("mnopq", k=60)
    texts += [" ".join(rng.choices("xyz", k=9) + shared[a : a + 50] + rng.choices("xyz", k=9)) for a in (0, 3, 20, 20)]
    config = substrings.Config(window=12, look=1)
    table = docs(spark, texts)
    rows = table.collect()
    words = [(r.text or "").encode().split() for r in rows]
    n = Counter(tuple(w[i : i + 12]) for w in words for i in range(len(w) - 11))
    want = Counter()
    for r, w in zip(rows, words, strict=True):
        gone = {k for i in range(len(w) - 11) if n[tuple(w[i : i + 12])] > 1 for k in range(i, i + 12)}
        want[r.doc_id, r.score, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()] += 1
    assert Counter((r.doc_id, r.score, r.n_words, r.n_removed, r.kept) for r in substrings.deduplicate(table, config).collect()) == want
    assert substrings.deduplicate(empty(spark)).count() == 0


# n-grams


def test_jaccard_equals_brute_force(spark):
    rng = random.Random(8)
    base = [rng.choices([f"w{i}" for i in range(300)], k=80) for _ in range(6)]
    texts = list(NASTY)
    for _ in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(w))
            w[k : k + 1] = rng.choice([[], [f"n{rng.random()}"], [w[k], "extra"]])
        texts.append(" ".join(w[: rng.choice([80, 80, 70])]).upper() if rng.random() < 0.1 else " ".join(w))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()})
    top = list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if (both := len(sets[a] & sets[b])) and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = top[a], top[b]
            top = [min(x, y) if t in (x, y) else t for t in top]
    for config in (jaccard.Config(), jaccard.Config(look=1)):
        got = {r.id: (r.n, r.component) for r in jaccard.cluster(table, config).collect()}
        assert got == {i: (len(sets[i]), top[i]) for i in range(len(texts))}
    assert jaccard.cluster(empty(spark)).count() == 0
    assert jaccard.cluster(docs(spark, NASTY)).count() == len(NASTY) + 1


# toxicity


def test_toxicity_learns_and_generalises(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("aeionrst", k=rng.randint(2, 7)))
    rude = ["zgrok", "vufnat", "qelbix"]
    rows = []
    for _ in range(900):
        w, bad = [word() for _ in range(rng.randint(5, 160))], rng.random() < 0.2
        for _ in range(3 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(rude))
        rows.append((" ".join(w).encode(), int(bad)))
    m = toxicity.train([t for t, _ in rows[:600]], [y for _, y in rows[:600]])
    s = toxicity.scores(m, [t for t, _ in rows[600:]])
    y = np.array([y for _, y in rows[600:]])
    assert ((s >= 0.3) == y).mean() > 0.97
    out = toxicity.score(docs(spark, NASTY), m).collect()
    assert len(out) == len(NASTY) + 1 and all(0 <= r.score <= 1 for r in out)
    assert toxicity.scores(toxicity.train([], []), [b"", b"x"]).max() <= 1


def test_toxicity_of_odd_tables(spark):
    """Repeated and null ids, one label only, empty tables, clashing columns; the sample's bound in bytes and its order."""
    rows = [(i, f"text of row {i} " + ("zgrok " if i % 3 == 0 else ""), 0.5, 1) for i in range(60)] + [(3, "another text", 0.5, 1), (None, "nameless", 0.5, 1), (4, None, 0.5, 1)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, score double, predicted int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (5, None), (6, 1)], "doc_id bigint, toxic int")
    c = toxicity.Config(steps=5, epochs=1)
    ever = F.lit(True)
    models = [toxicity.fit(t, l, ever, c) for t, l in ((table, labels), (table.repartition(5), labels.repartition(3)), (table.orderBy(F.desc("text")), labels))]
    assert all((models[0].p[k] == m.p[k]).all() for m in models[1:] for k in m.p)
    out = toxicity.score(table, models[0]).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
    for one in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.limit(0)):
        assert len({r.score for r in toxicity.score(table, toxicity.fit(table, one, ever, c)).collect()}) == 1
    assert toxicity.score(table.limit(0), toxicity.fit(table.limit(0), labels, ever, c)).count() == 0
    seen = []
    kept = toxicity.train
    try:
        toxicity.train = lambda texts, toxic, config: seen.append(texts) or kept([], [], config)
        toxicity.fit(table, labels, ever, toxicity.Config(sample_bytes=200))
        toxicity.fit(table, labels, ever, toxicity.Config(sample=7))
    finally:
        toxicity.train = kept
    assert 0 < sum(map(len, seen[0])) <= 200 and len(seen[1]) == 7


def test_toxicity_sample_is_of_labels_with_texts(spark, monkeypatch):
    """Many labels without a text take no place of those with one."""
    table = spark.range(5000, 5040).selectExpr("id as doc_id", "concat('text ', id) as text")
    labels = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    seen, kept = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, config: seen.append((texts, toxic)) or kept([], [], config))
    toxicity.fit(table, labels, F.lit(True), toxicity.Config(sample=100))
    assert sorted(zip(*seen[0], strict=True)) == [(f"text {i}".encode(), i % 2) for i in range(5000, 5040)]


def plain_score(m, text):
    """The network's score of a text, step by step over lists, from its definition."""
    from math import exp, tanh

    c, p = m.config, {k: v.astype(float).tolist() for k, v in m.p.items()}
    sigmoid = lambda x: 1 / (1 + exp(-x)) if x > -700 else 0.0
    tokens, now = [], b""
    for b in text.lower() + b" ":
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            now += bytes([b])
        elif now:
            tokens.append(now)
            now = b""
    hashes = Words([b" ".join(tokens)]).hashes() if tokens else []

    def vector(word, h):
        spelt = b" " + word + b"  "
        grams = []
        for k in range(len(word) + 1):
            x = (spelt[k] * 65599 & 0xFFFFFFFF) ^ (spelt[k + 1] * 2654435761 & 0xFFFFFFFF) ^ (spelt[k + 2] * (40503 * 257) & 0xFFFFFFFF)
            grams.append(p["chars"][(x >> 7) % c.char_buckets])
        return p["words"][int(h) % c.word_buckets] + [sum(g[d] for g in grams) / len(grams) for d in range(c.char_dim)]

    vectors = [vector(t, h) for t, h in zip(tokens, hashes, strict=True)]
    times = lambda v, w: [sum(a * r[k] for a, r in zip(v, w, strict=True)) for k in range(len(w[0]))]

    def direction(window, name):
        state, out, h = [0.0] * c.hidden, [], c.hidden
        for v in window:
            a, rec = [x + b for x, b in zip(times(v, p["in_" + name]), p["bias_" + name], strict=True)], times(state, p["rec_" + name])
            r = [sigmoid(a[k] + rec[k]) for k in range(h)]
            z = [sigmoid(a[h + k] + rec[h + k]) for k in range(h)]
            new = [tanh(a[2 * h + k] + r[k] * rec[2 * h + k]) for k in range(h)]
            state = [(1 - z[k]) * new[k] + z[k] * state[k] for k in range(h)]
            out.append(state)
        return out

    def logit(window):
        states = [f + b for f, b in zip(direction(window, "f"), direction(window[::-1], "b")[::-1], strict=True)]
        weight = [exp(sum(tanh(x + b) * v for x, b, v in zip(times(s, p["att_w"]), p["att_b"], p["att_v"], strict=True))) for s in states]
        pooled = [sum(w * s[k] for w, s in zip(weight, states, strict=True)) / sum(weight) for k in range(2 * c.hidden)] if states else [0.0] * (2 * c.hidden)
        return sum(x * w for x, w in zip(pooled, p["out_w"], strict=True)) + p["out_b"][0]

    starts, n = [0], len(vectors)
    while starts[-1] + c.window < n:
        starts.append(min(starts[-1] + c.window * 3 // 4, n - c.window))
    return sigmoid(max(logit(vectors[s : s + c.window]) for s in starts))


def test_toxicity_scores_equal_plain_loops():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("aeiorsté9", k=rng.randint(1, 6)))
    texts = [" ".join(word() for _ in range(n)).encode() for n in (1, 2, 7, 47, 48, 49, 84, 85, 150)] + [b"", b" .,; ", "Ünï CODE, mixed-case".encode()]
    c = toxicity.Config(steps=20, epochs=1)
    m = toxicity.train(texts[:9] + [t + b" zgrok" for t in texts[:9]], [0] * 9 + [1] * 9, c)
    for x in m.p.values():
        x += np.random.default_rng(1).normal(0, 0.05, x.shape).astype(np.float32)
    got = toxicity.scores(m, texts)
    want = [plain_score(m, t) for t in texts]
    assert np.abs(got - want).max() < 1e-4 and np.ptp(got) > 0.001
    # a text's score doesn't depend on the texts beside it
    assert np.abs(np.concatenate([toxicity.scores(m, [t]) for t in texts]) - got).max() < 1e-6


def test_clashing_columns_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a b c d e f g", 1, "x"), (1, "a b c d e f g", 1, "x"), (None, None, None, None), (2, "", 3, "z")], "doc_id bigint, text string, n_words int, kept string")
    more = rows.withColumns({"id": F.lit(9), "component": F.lit(9), "n": F.lit(9), "ids": F.lit(9), "hits": F.lit(9), "_k": F.lit(9), "frag": F.lit(9)})
    cut = substrings.deduplicate(more, substrings.Config(window=5)).orderBy(F.col("doc_id").asc_nulls_first(), "n_words").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in cut] == [(0, 0, ""), (7, 7, ""), (7, 7, ""), (0, 0, "")]
    got = sorted(map(tuple, jaccard.cluster(more).collect()), key=str)
    assert got == sorted([(1, 3, 1), (1, 3, 1), (None, 0, None), (2, 0, 2)], key=str)
    for table in (more.limit(0), more.where("text is null")):
        assert substrings.deduplicate(table).count() == jaccard.cluster(table).count() == table.count()
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256}
    coded = bpe.encode(more, ranks, r"\S+|\s").collect()
    assert len(coded) == 4 and sorted(len(r.ids) for r in coded) == [0, 0, 13, 13]
    assert bpe.round_trip(more.limit(0), ranks, r"\S+|\s").count() == 0


def test_gradient():
    c = toxicity.Config(word_buckets=16, char_buckets=16, word_dim=2, char_dim=2, hidden=3, window=6)
    texts = [b"a bb ccc a dd", b"bb eee"]
    m = toxicity.train(texts, [0, 0], c)
    rng = np.random.default_rng(0)
    m.p = {k: rng.normal(0, 0.5, v.shape) for k, v in m.p.items()}
    t = toxicity.Tokens(texts, c)
    y = np.array([1.0, 0.0])

    def loss():
        z = toxicity._forward(m, toxicity._inputs(m, t), *toxicity._grid(t, np.arange(2), c.window))
        return float((np.logaddexp(0, z) - y * z).sum()), z

    grid = toxicity._grid(t, np.arange(2), c.window)
    x = toxicity._inputs(m, t)
    z, rest = toxicity._forward(m, x, *grid, keep=True)
    g = toxicity._gradient(m, t, x, *grid, rest, toxicity._sigmoid(z) - y)
    for k, v in m.p.items():
        at = tuple(int(i) for i in np.unravel_index(np.argmax(np.abs(g[k])), v.shape))
        old = v[at]
        v[at] = old + 1e-2
        up = loss()[0]
        v[at] = old - 1e-2
        down = loss()[0]
        v[at] = old
        assert abs((up - down) / 2e-2 - g[k][at]) < 0.03 * max(1, abs(g[k][at])), k
