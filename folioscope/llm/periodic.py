"""Periodic runs of words: stretches that repeat a period of q words, `power` times or more.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), of max(least, power * q) words or more,
that no neighbouring word extends with that period. All runs of a text are found, with exact starts, lengths and periods.

In a run of length l its first l - q words equal those q further on, so every word of it lies in a k-gram that occurs twice in the
text, where k is the least overlap l - q that any period allows. Words in no repeated k-gram of their text are masked, and only
the stretches between them (a small part of usual texts) go on. There, divide and conquer after Main and Lorentz: a run that
crosses the middle of a stretch pairs the middle with the word q further or q before, and the common extensions of that pair to
both sides give the whole run. Extensions compare ranks of the words' 1-, 2-, 4-, ... grams (each rank made of two of the level
before, from word identities that compare bytes), so they are exact, and all middles and periods of a level are tried at once.

Words are maximal runs of bytes other than ASCII white space, unchanged. Null and empty texts have no words, no runs and an empty
collapsed text. Texts are taken one by one, in one pass without a shuffle: rows with equal or null ids, copies and a hot source
change nothing, and a long text costs its own task n log n time and about 4 log n bytes a surviving word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Words, byte_texts, chunks, mix, ngram_hashes, tidy


@dataclass(frozen=True)
class Config:
    #: Words that a run has at least, and how often it holds its period at least.
    least: int = 6
    power: int = 4

    def __post_init__(self):
        if self.power < 2 or self.least < 2:
            raise ValueError("power and least must be 2 or more")

    def overlap(self) -> int:
        """Words, at least, of a run that recur one period later."""
        return min(max(self.least, self.power * q) - q for q in range(1, self.least + 1))


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ranges first, first + 1, ... of count members each: the range of each member, and the member."""
    own = np.repeat(np.arange(len(count)), count)
    return own, np.arange(len(own)) - np.repeat(np.cumsum(count) - count - first, count)


def _surviving(w: Words, c: Config) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 word of the stretches whose words lie in repeated k-grams of their text. A collision of hashes only keeps a word too many."""
    none, k = np.zeros(0, np.int64), c.overlap()
    text = w.text_of()
    grams = ngram_hashes(w.hashes(), k)
    inside = text[: len(grams)] == text[k - 1 :][: len(grams)]
    grams = mix(grams + text[: len(grams)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(grams[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return none, none
    at = np.flatnonzero(inside & (twice[np.minimum(np.searchsorted(twice, grams), len(twice) - 1)] == grams))
    turn = np.zeros(len(text) + 1, np.int32)
    np.add.at(turn, at, 1)
    np.add.at(turn, at + k, -1)
    covered = np.cumsum(turn[:-1]) > 0
    new = covered & np.concatenate([[True], ~covered[:-1] | (text[1:] != text[:-1])])
    last = covered & np.concatenate([~covered[1:] | (text[1:] != text[:-1]), [True]])
    first, end = np.flatnonzero(new), np.flatnonzero(last) + 1
    long = end - first >= c.least
    return first[long], end[long]


def _identities(w: Words, at: np.ndarray) -> np.ndarray:
    """Numbers of words, equal where the bytes are."""
    length = w.end[at] - w.start[at]
    _, where = _spread(w.start[at], length)
    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(w.buf[where])])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


class _Ranks:
    """Ranks of the 2^j-grams of a sequence, for common extensions of many pairs of places at once."""

    def __init__(self, ids: np.ndarray, longest: int):
        self.levels, n = [ids], len(ids)
        while (1 << len(self.levels)) <= longest:
            half, one = 1 << (len(self.levels) - 1), self.levels[-1]
            m = max(0, n - 2 * half + 1)
            pairs = one[:m] * (int(one.max()) + 1) + one[half : half + m]
            kinds, rank = np.unique(pairs, return_inverse=True)
            if len(kinds) == m:
                break  # nothing of this length or more recurs
            # grams that run over the end are equal to nothing
            self.levels.append(np.concatenate([rank.reshape(-1), np.arange(len(kinds), len(kinds) + n - m)]))

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on; b > a."""
        n, got = len(self.levels[0]), np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            x, y = a + got, b + got
            there = y < n
            rank = self.levels[j]
            got += (there & (rank[np.where(there, x, 0)] == rank[np.where(there, y, 0)])).astype(np.int64) << j
        return got

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words up to a (included) equal those up to b; b > a."""
        got = np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            x, y = a - got - (1 << j) + 1, b - got - (1 << j) + 1
            there = x >= 0
            rank = self.levels[j]
            got += (there & (rank[np.where(there, x, 0)] == rank[np.where(there, y, 0)])).astype(np.int64) << j
        return got


def _least(rows: np.ndarray) -> np.ndarray:
    """Of rows (start, end, period) of one stretch that of the smallest period, which divides the others."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate([[True], (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])])]


#: Pairs of a middle and a period tried at once.
_PAIRS = 1 << 20


def _crossing(ids: np.ndarray, low: np.ndarray, high: np.ndarray, c: Config) -> np.ndarray:
    """Rows (start, end, period) of the runs within the stretches low to high of a sequence in which every stretch ends with a word of its own."""
    ranks, found = _Ranks(ids, int((high - low).max())), []
    while len(low):
        middle, most = (low + high) // 2, (high - low) // c.power
        for part in np.split(np.arange(len(low)), np.flatnonzero(np.diff(np.cumsum(most) // _PAIRS)) + 1):
            own, q = _spread(np.ones(len(part), np.int64), most[part])
            m = middle[part][own]
            for a in (m, m - q):
                # the pair itself or the one before it must be equal
                some = np.flatnonzero((ids[a] == ids[a + q]) | ((a > 0) & (ids[a - 1] == ids[a + q - 1])))
                x, p = a[some], q[some]
                ahead, behind = ranks.forward(x, x + p), ranks.backward(x - 1, x + p - 1)
                fits = ahead + behind + p >= np.maximum(c.least, c.power * p)
                x, p, ahead, behind = x[fits], p[fits], ahead[fits], behind[fits]
                if len(x):
                    found.append(_least(np.stack([x - behind, x + p + ahead, p], 1)))
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
        long = high - low >= c.least
        low, high = low[long], high[long]
    return _least(np.concatenate(found)) if found else np.zeros((0, 3), np.int64)


def find(w: Words, c: Config = Config()) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, ascending; starts are word numbers in their text."""
    first, end = _surviving(w, c)
    if not len(first):
        return np.zeros((0, 4), np.int64)
    size = end - first
    own, at = _spread(first, size)
    low = np.cumsum(size + 1) - size - 1
    ids = np.empty(int((size + 1).sum()), np.int64)
    place = low[own] + at - first[own]
    ids[place] = _identities(w, at)
    ids[low + size] = int(ids[place].max()) + 1 + np.arange(len(size))
    rows = _crossing(ids, low, low + size, c)
    k = np.searchsorted(low, rows[:, 0], "right") - 1
    start = rows[:, 0] - low[k] + first[k]
    text = np.searchsorted(w.first, start, "right") - 1
    out = np.stack([text, start - w.first[text], rows[:, 1] - rows[:, 0], rows[:, 2]], 1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def collapsed(w: Words, runs: np.ndarray) -> list[bytes]:
    """Of each text the words that no run holds after its first period, joined by one space."""
    n, start = len(w.start), w.first[runs[:, 0]] + runs[:, 1]
    turn = np.zeros(n + 1, np.int32)
    np.add.at(turn, start + runs[:, 3], 1)
    np.add.at(turn, start + runs[:, 2], -1)
    kept = np.cumsum(turn[:-1]) == 0
    before = np.concatenate([[0], np.cumsum(kept)])[w.first]
    w.start, w.end = w.start[kept], w.end[kept]
    data, first, last = w.joined()
    return [data[first[a] : last[b - 1]] if b > a else b"" for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True)]


def detect(docs: DataFrame, config: Config = Config(), text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns `keep`) with n_words, runs (start, length and period, by start, then period) and collapsed, replacing columns of these names."""
    names = ["n_words", "runs", "collapsed"]
    kept = [f for f in docs.schema if f.name not in names and (keep is None or f.name in keep)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"])
    columns = [f.name for f in kept]
    base = docs if text not in names else docs.withColumnRenamed(text, "_text")
    source = text if text not in names else "_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for part in chunks(byte_texts(b.column(source))):
                w = Words(part)
                counts, rows = pa.array(w.counts.astype(np.int64)), find(w, config)
                fields = [pa.array(np.ascontiguousarray(rows[:, k])) for k in (1, 2, 3)]
                ends = np.searchsorted(rows[:, 0], np.arange(len(part) + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                own = b.slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays([*(own.column(k) for k in columns), counts, runs, pa.array(collapsed(w, rows), pa.binary()).cast(pa.string())], names=[*columns, *names])

    return base.select(*(f"`{x}`" for x in dict.fromkeys([*columns, source]))).mapInArrow(tidy(run), schema)
