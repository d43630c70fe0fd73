"""Substring dedup: words of windows that occur more than once, found by super-k-mer partitioning.

1. Each text's windows of `window` words get a minimiser, the least hash of their `minimiser`-word grams. Consecutive windows
   of one minimiser travel together, as one string of their words, to the minimiser's bucket.
2. A bucket sorts its windows by hash and compares the bytes of those that meet, so its counts are exact.
3. The spans of repeated windows go back to their texts, whose words are then removed.

Equal strings of a chunk travel once; a repeat inside a chunk is known there, and only one of its places travels on, marked.
So a passage in a third of all rows sends one string a chunk, not one a row. Windows of frequent minimisers (found in a
bounded sample of rows; the list only decides the way, never the result) travel alone to the bucket of their own hash, so
that one minimiser with countless contexts spreads over all buckets. Texts are known by two 64-bit hashes, so equal rows
share their spans. Null text has no words; texts shorter than a window keep all; repeated rows repeat each other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import Words, byte_texts, chunks, mix, ngram_hashes, _powers, tidy


@dataclass(frozen=True)
class Config:
    window: int = 35
    minimiser: int = 4
    #: Buckets for each shuffle partition.
    buckets: int = 16
    #: One row in so many is looked at for frequent minimisers; listed are at most `hot`, or two for each bucket if these are more.
    look: int = 64
    hot: int = 4096


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    size = 1
    n = len(a) - width + 1
    if n <= 0:
        return a[:0]
    while size * 2 <= width:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return a if size == width else np.minimum(a[:n], a[width - size : width - size + n])


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Hash of each `window` consecutive words."""
    n = len(words) - window + 1
    if n <= 0:
        return words[:0]
    up, down = _powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=total[1:])
    return mix((total[window:] - total[:-window]) * down[:n])


def _windows(w: Words, c: Config) -> np.ndarray:
    """First words of windows that lie in one text."""
    last = np.repeat(w.first[1:], w.counts)  # end of each word's text
    return np.flatnonzero(np.arange(len(last)) + c.window <= last)


def _minimisers(w: Words, c: Config, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    return sliding_min(ngram_hashes(hashes, c.minimiser), c.window - c.minimiser + 1)[at]


def frequent_minimisers(texts: DataFrame, c: Config, most: int) -> np.ndarray:
    """Minimisers that stand out in the rows whose text hash is divisible by `look`, `most` at most: any other has a smaller share of all than 1 / most, so it overloads no bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for part in chunks(byte_texts(b.column("text"))):
                w = Words(part)
                at = _windows(w, c)
                key = _minimisers(w, c, w.hashes(), at)
                if len(key):
                    key = key[np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))]
                    seen.update(dict(zip(*(x.tolist() for x in np.unique(key.view(np.int64), return_counts=True)), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], names=["key", "n"])

    part = texts.where(F.pmod("k1", F.lit(c.look)) == 0).select("text").mapInArrow(tidy(count), "key bigint, n bigint")
    rows = part.groupBy("key").agg(F.sum("n").alias("n")).where("n >= 64").orderBy(F.desc("n"), "key").limit(most).collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64))


_RUN = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("at", "<i4"), ("words", "<i4"), ("many", "u1")])


def _spans(at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of words that windows starting at these (sorted) words cover."""
    cut = np.flatnonzero(np.diff(at) > window)
    return at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + window


def _scatter(part: list[tuple[bytes, int, int]], c: Config, hot: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Of some rows (text, k1, k2): by bucket, the places and the strings; places without string are known repeats."""
    rows = Counter(part)
    texts = list(rows)
    w = Words([t[0] for t in texts])
    at = _windows(w, c)
    if not len(at):
        return
    hashes = w.hashes()
    key = _minimisers(w, c, hashes, at)
    own = np.isin(key, hot) if len(hot) else np.zeros(len(key), bool)
    if own.any():
        key = np.where(own, window_hashes(hashes, c.window)[at], key)
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (np.diff(at) != 1) | own[1:] | own[:-1]]))
    first, last = at[new], at[np.concatenate([new[1:] - 1, [len(at) - 1]])]
    text = w.text_of()[first]
    joined, start, end = w.joined()
    bucket = (mix(key[new]) % np.uint64(buckets)).astype(np.int64)
    place: dict[tuple[int, bytes], list[int]] = {}
    for i, x in enumerate(zip(bucket.tolist(), start[first].tolist(), end[last + c.window - 1].tolist(), strict=True)):
        place.setdefault((x[0], joined[x[1] : x[2]]), []).append(i)
    runs = np.empty(len(new), _RUN)
    k = np.array([t[1:] for t in texts], np.int64)
    runs["k1"], runs["k2"], runs["at"], runs["words"] = k[text, 0], k[text, 1], first - w.first[text], last - first + c.window
    twice = np.array([rows[t] > 1 for t in texts])[text]
    runs["many"] = twice
    out: dict[int, tuple[list[int], list[bytes]]] = {}
    known = twice.copy()
    for (b, string), own_runs in place.items():
        if len(own_runs) > 1:
            known[own_runs] = True
            runs["many"][own_runs[0]] = 1
        o = out.setdefault(b, ([], []))
        o[0].append(own_runs[0])
        o[1].append(string)
    pack = zstandard.ZstdCompressor(level=3).compress
    for b, (ids, strings) in out.items():
        yield b, runs[ids].tobytes(), pack(b" ".join(strings))
    if known.any():
        told = runs[known]
        home = (mix(told["k1"].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        for b in np.unique(home).tolist():
            yield b, told[home == b].tobytes(), b""


def _repeats(runs: np.ndarray, text: bytes, c: Config) -> tuple[np.ndarray, np.ndarray]:
    """Of a bucket's strings (words of all runs, joined): the first words of windows that occur more than once, and each one's run."""
    w = Words([text])
    w.first = np.concatenate([[0], np.cumsum(runs["words"])]).astype(np.int64)
    w.counts = np.diff(w.first)
    run = w.text_of()
    at = _windows(w, c)
    h = window_hashes(w.hashes(), c.window)[at]
    order = np.argsort(h, kind="stable")
    new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    lead = np.empty(len(at), np.int64)
    lead[order] = at[order][np.flatnonzero(new)][group]
    many = np.bincount(group, runs["many"][run[at[order]]]) > 0
    hit = np.zeros(len(at), bool)
    hit[order] = (size > 1)[group] | many[group]
    # Bytes decide: runs of windows that follow each other as their leaders do are compared at once.
    raw, start, end = w.buf.tobytes(), w.start, w.end
    check = np.flatnonzero(hit & (lead != at))
    bad = set()
    if len(check):
        a, b = at[check], lead[check]
        cut = np.flatnonzero((np.diff(a) != 1) | (np.diff(b) != 1) | (np.diff(run[a]) != 0) | (np.diff(run[b]) != 0))
        lo, hi = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(check) - 1]])
        n = c.window - 1
        for x, y, i, j, k, l in zip(start[a[lo]].tolist(), end[a[hi] + n].tolist(), start[b[lo]].tolist(), end[b[hi] + n].tolist(), lo.tolist(), hi.tolist(), strict=True):
            if raw[x:y] != raw[i:j]:
                bad.update(h[check[k : l + 1]].tolist())
    if bad:  # different windows of one hash: count these by their bytes
        odd = np.flatnonzero(np.isin(h, np.array(list(bad), np.uint64)))
        words = [raw[start[at[i]] : end[at[i] + c.window - 1]] for i in odd]
        n: Counter = Counter()
        for i, x in zip(odd, words, strict=True):
            n[x] += 1 + int(runs["many"][run[at[i]]])
        hit[odd] = [n[x] > 1 for x in words]
    return at[hit], run[at[hit]]


def repeated_spans(texts: DataFrame, c: Config) -> DataFrame:
    """Of texts (text, k1, k2): k1, k2, s, e, ranges of words that repeated windows cover; ranges of a text may overlap."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = c.buckets * parts
    hot = frequent_minimisers(texts, c, max(c.hot, 2 * buckets))

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(byte_texts(b.column("text")), b.column("k1").to_pylist(), b.column("k2").to_pylist(), strict=True)
            for part in chunks(rows, size=lambda r: len(r[0])):
                got = list(_scatter(part, c, hot, buckets))
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary()), pa.array([g[2] for g in got], pa.binary())], names=["bucket", "runs", "words"])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        known, mine, strings = [], [], []
        unpack = zstandard.ZstdDecompressor().decompress
        for r, x in zip(pdf["runs"], pdf["words"], strict=True):
            runs = np.frombuffer(r, _RUN)
            if x:
                mine.append(runs)
                strings.append(unpack(x))
            else:
                known.append(runs)
        out = [(r["k1"], r["k2"], r["at"], r["at"] + r["words"]) for r in known]
        if mine:
            runs = np.concatenate(mine)
            at, run = _repeats(runs, b" ".join(strings), c)
            if len(at):
                base = np.concatenate([[0], np.cumsum(runs["words"])])[:-1]
                # a gap of a window and more between the runs keeps their spans apart
                s, e = _spans(at + run * (c.window + 1), c.window)
                own = run[np.searchsorted(at + run * (c.window + 1), s)]
                shift = runs["at"][own] - base[own] - own * (c.window + 1)
                out.append((runs["k1"][own], runs["k2"][own], s + shift, e + shift))
        k1, k2, s, e = (np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(4))
        return pd.DataFrame({"k1": k1, "k2": k2, "s": s.astype(np.int32), "e": e.astype(np.int32)})

    return texts.mapInArrow(tidy(scatter), "bucket bigint, runs binary, words binary").groupBy("bucket").applyInPandas(count, "k1 bigint, k2 bigint, s int, e int")


def deduplicate(docs: DataFrame, config: Config = Config(), text: str = "text") -> DataFrame:
    """docs with n_words, n_removed and kept (the remaining words joined by one space); columns of these names are replaced."""
    names = ["n_words", "n_removed", "kept"]
    base = docs.drop(*names, "_k1", "_k2", "_spans", "_k")
    keyed = base.withColumns({"_k1": F.xxhash64(text), "_k2": F.xxhash64(F.lit(1), text)})
    spans = repeated_spans(keyed.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col("_k1").alias("k1"), F.col("_k2").alias("k2")), config)
    # Grouped by one form of the key and joined by another: then both sides of the join are shuffled for it, and AQE can split a text that many rows have.
    spans = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e")).alias("_spans")).select(F.concat_ws("_", "k1", "k2").alias("_k"), "_spans")
    both = keyed.withColumn("_k", F.concat_ws("_", "_k1", "_k2")).drop("_k1", "_k2").join(spans, "_k", "left").drop("_k")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema) + ", n_words bigint, n_removed bigint, kept string"

    columns = base.columns

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for t, spans in zip(byte_texts(b.column(text)), b.column("_spans").to_pylist(), strict=True):
                words = t.split()
                n_words.append(len(words))
                if spans:
                    gone = np.zeros(len(words) + 1, np.int64)
                    np.add.at(gone, [x["s"] for x in spans], 1)
                    np.add.at(gone, [x["e"] for x in spans], -1)
                    stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                    words = [words[i] for i in stay]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in columns), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=[*columns, *names])

    return both.mapInArrow(tidy(remove), schema)
