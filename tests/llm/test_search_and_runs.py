"""Exact top-k search and periodic runs against brute force, and edge cases."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import nearest, periodic, queries
from folioscope.llm.common import Words

# exact top-k search


def nearest_by_brute_force(rows, k, scale=64, every=20):
    """Sorted (query_id, rank, vec_id, score)."""
    fine = [(i, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, x) in enumerate(fine):
        if q is None or q % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i is None, i or 0) for j, (i, y) in enumerate(fine) if j != at)[:k]
        out += [(q, r, None if null else i, -s) for r, (s, null, i) in enumerate(found, 1)]
    return sorted(out, key=str)


def search(spark, rows, c, every=20):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string")
    return sorted(map(tuple, nearest.neighbours(df, F.col("vec_id") % every == 0, c).collect()), key=str)


SMALL = nearest.Config(block=16, asked=4, together=2, judged=3, pivots=5, sample=40)


@pytest.mark.parametrize("c", [nearest.Config(), SMALL], ids=["whole", "blocks"])
def test_nearest_equals_brute_force(spark, c):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (5, 6))
    made = [(i, (centres[i % 5] + rng.normal(0, 0.2, 6)).tolist()) for i in range(300)]
    # a third of all rows are copies of one, ids repeat or are null, lengths differ, and some vectors take no part
    made += [(1000 + i, made[0][1]) for i in range(150)] + [(40, made[7][1]), (40, made[7][1]), (None, made[3][1]), (None, None), (2000, None), (2020, [1.0, None]), (2040, [float("nan")]), (2060, [float("inf"), 1.0])]
    made += [(2080, []), (2100, [0.5, -0.25]), (2120, [3.0] * 9), (2140, [0.0] * 6)]
    got = search(spark, [(i, v, "x") for i, v in made], c)
    assert got == nearest_by_brute_force(made, 20)
    assert sum(q == 40 for q, *_ in got) == 60


def test_nearest_few_and_no_rows(spark):
    assert search(spark, [], SMALL) == []
    assert search(spark, [(0, None, "")], SMALL) == []
    assert search(spark, [(0, [1.0], "")], SMALL) == []
    assert search(spark, [(0, [1.0], ""), (1, [2.0], "")], SMALL) == [(0, 1, 1, 64 * 128)]


def test_nearest_large_components(spark):
    """Scores beyond 2^53 are exact; vectors whose squared length exceeds 2^62 take no part."""
    big = float(2**23 - 1)
    rows = [(0, [big, 1.0], ""), (1, [big, 2.0], ""), (2, [big, -1.0], ""), (3, [-big, 1.0], ""), (4, [1e30, 0.0], "")]
    assert search(spark, rows, SMALL) == nearest_by_brute_force([(i, v) for i, v, _ in rows[:4]], 20)


def test_bounds_leave_most_rows_unevaluated():
    """On rows in groups, nearly all evaluations are of the query's own group."""
    rng = np.random.default_rng(2)
    rows = np.rint(np.repeat(rng.normal(0, 400, (20, 16)), 50, 0) + rng.normal(0, 4, (1000, 16)))
    lengths = (rows**2).sum(1).astype(np.int64)
    pivots = nearest.choose_pivots(rows, 16)
    d = nearest._to_pivots(rows, lengths.astype(float), pivots)
    b = nearest.Block(nearest.Block.pack([(i, int(lengths[i]), rows[i].astype(np.int32), d[i]) for i in range(1000)]))
    q = nearest.Block(nearest.Block.pack([(i, int(lengths[i]), rows[i].astype(np.int32), d[i]) for i in range(0, 1000, 100)]))
    found = list(nearest.best(q, b, np.full(10, -np.inf), np.arange(0, 1000, 100), 10))
    got = {i: s.tolist() for i, _, s, _ in found}
    scores = rows @ rows.T
    for k, i in enumerate(range(0, 1000, 100)):
        assert got[k] == sorted(np.delete(scores[i], i).astype(int).tolist(), reverse=True)[:10]
    assert max(n for *_, n in found) <= 120


# periodic runs


def runs_by_brute_force(words, least=6, power=4):
    out = {}
    for q in range(1, len(words) // power + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, power * q):
                out.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def without_repeats(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("c", [periodic.Config(), periodic.Config(least=4, power=2), periodic.Config(least=9, power=3)])
def test_runs_equal_brute_force(c):
    random.seed(4)
    texts = []
    for _ in range(1500):
        parts = []
        for _ in range(random.randint(0, 6)):
            parts += random.choices("abcdefghij"[: random.choice([1, 2, 3, 10])], k=random.randint(1, 6)) * random.randint(1, 7) + random.choices("abxyz", k=random.randint(0, 5))
        texts.append(" ".join(parts))
    w = Words([t.encode() for t in texts])
    rows = periodic.find(w, c)
    left = periodic.collapsed(w, rows)
    by = {}
    for t, *r in rows.tolist():
        by.setdefault(t, []).append(tuple(r))
    for t, x in enumerate(texts):
        want = runs_by_brute_force(x.split(), c.least, c.power)
        assert by.get(t, []) == want
        assert left[t].decode() == without_repeats(x.split(), want)


def test_overlap_is_the_least_of_all_periods():
    for least, power in ((6, 4), (4, 2), (9, 3), (20, 2), (2, 2)):
        c = periodic.Config(least, power)
        assert c.overlap() == min(max(least, power * q) - q for q in range(1, 200))
    with pytest.raises(ValueError):
        periodic.Config(6, 1)


def test_runs_of_long_and_odd_texts(spark):
    texts = [None, "", " \n\t ", "one", "ü " * 7, "a b " * 50_000, "x " * 100_000, " ".join(map(str, range(30_000))) + " " + " ".join(map(str, range(30_000))), "           "]
    rows = [(i if i != 3 else None, t, i, "x") for i, t in enumerate(texts)] + [(0, texts[5], -1, "x")]
    out = periodic.detect(spark.createDataFrame(rows, "doc_id bigint, text string, runs int, n_words string"))
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = sorted(((r.text or "", r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()))
    assert got == sorted((t or "", len((t or "").split(" ")) if " " in (t or "") else len((t or "").split()), runs, left) for t, runs, left in [
        (None, [], ""), ("", [], ""), (texts[2], [], ""), ("one", [], "one"), (texts[4], [(0, 7, 1)], "ü"), (texts[5], [(0, 100_000, 2)], "a b"), (texts[5], [(0, 100_000, 2)], "a b"),
        (texts[6], [(0, 100_000, 1)], "x"), (texts[7], [], texts[7]), (texts[8], [(0, 6, 1)], " "),
    ])
    assert periodic.detect(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    named = periodic.detect(spark.createDataFrame([("a a a a a a a",)], "collapsed string"), text="collapsed").first()
    assert (named.n_words, named.collapsed) == (7, "a")


def test_query_of_runs(spark, tmp_path):
    random.seed(6)
    docs = [(i, None if i % 50 == 7 else " ".join(random.choices("abcdefgh", k=random.randint(0, 60)))) for i in range(400)] + [(7, "a " * 9), (None, "b b b b b b c")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want, repeated = [], 0
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(w), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n > 0:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            repeated += 1
        runs = runs_by_brute_force(w)
        b = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        want.append((i, len(runs), *b, 1000 * b[1] // b[2] if runs else None, sha("".join(f"{x},{y},{z}\n" for x, y, z in runs)), sha(without_repeats(w, runs))))
    got = queries.op12_periodic(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert repeated > 20
