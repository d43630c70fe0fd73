"""Benchmark decontamination by the q-gram lemma.

An item of m characters that occurs in a text with at most e edits (e = rate * m, rounded down) shares at least
m + 1 - q * (e + 1) q-grams with it, at different places of the text and all within e of one diagonal. So per text and item, the
places whose q-gram the item has are counted in diagonal bands of width 2 (e + 1) that overlap by half; bands that reach the
bound are kept, and a banded alignment of the whole item with each region of kept bands decides. Nothing that the lemma admits
is lost. A q-gram's places in a text and in an item are taken by runs.

Q-grams that more than `shared` items have (a stem that all questions of a benchmark begin with) are left out of the count, and
each item's bound is lowered by as many as it has of them, which again loses nothing. Of the q up to `q`, an item takes the
largest whose lowered bound is positive, so that a text that repeats the stem is no candidate for any item. Items with no such q
(they differ from many others in a few characters only) are looked for with all their q-grams, `shared` of them at a time: their
candidates are as many as they are, but memory stays bounded. All regions of an item in a text are aligned side by side.

Characters are code points; A-Z are lower-cased and ASCII white space counts as a space. An item too short for any q (m <= e)
can't exist for rates below 1. Null and empty texts hold nothing; null and empty items, and items given twice, are found nowhere
and once per item_id, respectively. Texts are looked through in pieces that overlap by more than the longest item.

The items' q-grams are broadcast in parts of about `most` characters. With one part, texts are scanned in one pass without
shuffle, in chunks, so hot sources, copies and lost executors cost their own tasks only. With more, each part has a pass of its
own over the texts, numbered and written once; its hits (narrow rows) are written before the next part is fetched, so the driver
holds one part at a time, and all hits are joined to the texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import ROWS, _powers, byte_texts, chunks, mix, stored, tidy

_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[9:14] = 32
_SIEVE = 20


@dataclass(frozen=True)
class Config:
    q: int = 16
    rate: float = 0.05
    #: Characters of items, about, that one pass looks for.
    most: int = 1_000_000
    #: Items that may have a q-gram which counts.
    shared: int = 8
    #: Characters of a text looked through at once, at least.
    piece: int = 1 << 18


def folded(text: str) -> np.ndarray:
    x = np.frombuffer(text.encode("utf-32-le"), np.uint32).copy()
    low = x < 128
    x[low] = _FOLD[x[low]]
    return x


def gram_hashes(x: np.ndarray, q: int) -> np.ndarray:
    n = len(x) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(x))
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(7)) * up[: len(x)], out=total[1:])
    return mix((total[q:] - total[:-q]) * down[:n])


class Index:
    """q-grams of the items by group: q, hashes, and for each the item and the run of places (no further apart than the item's width) it has there."""

    def __init__(self, items: list[tuple], c: Config):
        self.items = [(i, folded(t)) for i, t in items]
        self.edits = [int(c.rate * len(x)) for _, x in self.items]
        self.longest = max((len(x) + e for (_, x), e in zip(self.items, self.edits, strict=True)), default=0)
        #: Q-grams that a band must hold of each item.
        self.need = np.zeros(len(self.items), np.int64)
        self.groups: list[tuple] = []
        size = np.array([len(x) for _, x in self.items], np.int64)
        bound = lambda q: size + 1 - q * (np.array(self.edits, np.int64) + 1)
        left = np.arange(len(self.items))
        for q in range(c.q, 0, -1):
            own = left[bound(q)[left] > 0]
            if not len(own):
                continue
            # common: of all items, also those that have found their q
            h, item, at = self._grams(np.arange(len(self.items)), q)
            order = np.lexsort((item, h))
            once = np.concatenate([[True], (np.diff(h[order]) != 0) | (np.diff(item[order]) != 0)])[: len(h)]
            kinds, many = np.unique(h[order][once], return_counts=True)
            common = kinds[many > c.shared]
            rare = ~np.isin(h, common)
            lost = np.bincount(item[~rare], minlength=len(self.items))
            fine = own[(bound(q) - lost)[own] > 0]
            if len(fine):
                self.need[fine] = (bound(q) - lost)[fine]
                take = rare & np.isin(item, fine)
                self._add(q, h[take], item[take], at[take])
                left = left[~np.isin(left, fine)]
        for q in sorted({max(1, min(c.q, int(size[k]) // (self.edits[k] + 1))) for k in left.tolist()}, reverse=True):
            own = np.array([k for k in left.tolist() if max(1, min(c.q, int(size[k]) // (self.edits[k] + 1))) == q])
            self.need[own] = bound(q)[own]
            for one in range(0, len(own), c.shared):
                self._add(q, *self._grams(own[one : one + c.shared], q))

    def _grams(self, own: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = [gram_hashes(self.items[k][1], q) for k in own.tolist()]
        return np.concatenate([np.zeros(0, np.uint64), *h]), np.repeat(own, [len(x) for x in h]).astype(np.int64), np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) for x in h)])

    def _add(self, q: int, h: np.ndarray, item: np.ndarray, at: np.ndarray) -> None:
        if not len(h):
            return
        width = np.array(self.edits, np.int64) + 1
        order = np.lexsort((at, item, h))
        h, item, at = h[order], item[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (item[1:] != item[:-1]) | (np.diff(at) > width[item[1:]])]))
        last = np.append(first[1:], len(h)) - 1
        sieve = np.zeros(1 << _SIEVE, bool)
        sieve[(h >> np.uint64(64 - _SIEVE)).astype(np.int64)] = True
        self.groups.append((q, h[first], item[first], at[first], at[last], sieve))


#: Cells of an alignment step that are worked on at once.
_CELLS = 1 << 19


def distances(item: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Of each region, the least edits of the item against a part of text that begins on a diagonal from low to high, and the part's end; more than `most` may be too high."""
    width, m, n = int((high - low).max()) + 2 * most + 1, len(item), len(text)
    many = max(1, _CELLS // (width + m))
    for at in range(0, len(low), many):
        d = low[at : at + many, None] - most + np.arange(width + m)[None, :]
        chars = text[np.clip(d, 0, max(0, n - 1))] if n else np.zeros(d.shape, np.uint32)
        there, ends = (d >= 0) & (d < n), (d >= 0) & (d <= n)
        cost = np.where(ends[:, :width], 0, most + 1).astype(np.int32)
        step = np.arange(width, dtype=np.int32)
        skip = np.full_like(cost, most + 2)
        for i, c in enumerate(item):
            on = there[:, i : i + width]  # diagonal d meets the text at d + i
            same = cost + np.where(on, chars[:, i : i + width] != c, most + 1)
            skip[:, :-1] = cost[:, 1:] + 1
            now = np.where(ends[:, i + 1 : i + 1 + width], np.minimum(same, skip), most + 1)
            cost = np.minimum(np.minimum.accumulate(now - step, axis=1) + step, most + 1).astype(np.int32)
            if i % 16 == 15 and cost.min() > most:
                break
        best = cost.argmin(1)
        yield from zip(cost[np.arange(len(cost)), best].tolist(), (low[at : at + many] - most + best + m).tolist(), strict=True)


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ranges first, first + 1, ... of count members each: the range of each member, and the member."""
    own = np.repeat(np.arange(len(count)), count)
    return own, np.arange(len(own)) - np.repeat(np.cumsum(count) - count - first, count)


#: Places of one q-gram in a text that are no further apart are one run; diagonals that one alignment takes at most.
_NEAR, _SPAN = 16, 1 << 12


def _regions(flat: np.ndarray, first: np.ndarray, size: np.ndarray, index: Index, group: tuple) -> np.ndarray:
    """Rows (text, item, first band, last band) of neighbouring bands that reach the bound."""
    q, keys, item, a1, a2, sieve = group
    h = gram_hashes(flat, q)
    place = np.flatnonzero(sieve[(h >> np.uint64(64 - _SIEVE)).astype(np.int64)])
    lo, hi = np.searchsorted(keys, h[place]), np.searchsorted(keys, h[place], "right")
    text = np.searchsorted(first, place, "right") - 1
    inside = (hi > lo) & (place + q <= first[text] + size[text])
    place, text, lo, hi = place[inside], text[inside], lo[inside], hi[inside]
    if not len(place):
        return np.zeros((0, 4), np.int64)
    order = np.lexsort((place, lo, text))
    place, text, lo, hi = place[order], text[order], lo[order], hi[order]
    at = place - first[text]
    # groups: a q-gram of a text; runs: its places near each other
    group = np.cumsum(np.concatenate([[True], (text[1:] != text[:-1]) | (lo[1:] != lo[:-1])])) - 1
    run = np.flatnonzero(np.concatenate([[True], (np.diff(group) != 0) | (np.diff(at) > _NEAR)]))
    end = np.append(run[1:], len(at)) - 1
    # each run with each entry of its q-gram, and the bands that they touch
    own, entry = _spread(lo[run], (hi - lo)[run])
    width = np.array(index.edits, np.int64)[item[entry]] + 1
    low = np.floor_divide(at[run][own] - a2[entry], width) - 1
    which, band = _spread(low, np.floor_divide(at[end][own] - a1[entry], width) - low + 1)
    own, entry, width = own[which], entry[which], width[which]
    # of the run's places, those that the band has for any of the entry's places
    far = int(at.max()) + int(a2.max()) + 2 * int(width.max()) + 4
    line = group * (2 * far) + far + at
    base = group[run][own] * (2 * far) + far
    left = np.searchsorted(line, base + np.maximum(band * width + a1[entry], at[run][own]))
    count = np.searchsorted(line, base + np.minimum((band + 2) * width + a2[entry], at[end][own] + 1)) - left
    some = count > 0
    t, k, band, count = text[run][own][some], item[entry][some], band[some], count[some]
    order = np.lexsort((band, k, t))
    t, k, band, count = t[order], k[order], band[order], count[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(t) != 0) | (np.diff(k) != 0) | (np.diff(band) != 0)]))
    total = np.add.reduceat(count, new)
    t, k, band = t[new], k[new], band[new]
    enough = total >= index.need[k]
    t, k, band = t[enough], k[enough], band[enough]
    if not len(t):
        return np.zeros((0, 4), np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(t) != 0) | (np.diff(k) != 0) | (np.diff(band) > 2)]))
    return np.stack([t[new], k[new], band[new], band[np.append(new[1:], len(t)) - 1]], 1)


def _pieces(x: np.ndarray, piece: int, overlap: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where each piece of x begins, and the piece."""
    step = max(piece, 3 * overlap)
    for at in range(0, max(1, len(x) - overlap), step):
        yield at, x[at : at + step + overlap]


def find(texts: list[str], index: Index, c: Config = Config()) -> list[tuple[int, int, int, int]]:
    """(text, item, edits, end) for each text and item found, with the fewest edits."""
    out: dict[tuple[int, int], tuple[int, int]] = {}
    cut = [(t, at, x) for t, text in enumerate(texts) for at, x in _pieces(folded(text), c.piece, index.longest + c.q + 1)]
    for part in chunks(cut, size=lambda p: len(p[2]), limit=2 * c.piece):
        size = np.array([len(x) for _, _, x in part])
        first = np.cumsum(size) - size
        flat = np.concatenate([x for _, _, x in part])
        for group in index.groups:
            rows = _regions(flat, first, size, index, group)
            for one in np.split(rows, np.flatnonzero((np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)) + 1) if len(rows) else []:
                p, k = one[0, :2].tolist()
                t, at, text = part[p]
                x, e = index.items[k][1], index.edits[k]
                w = e + 1
                # wide regions in parts, so that all that stand side by side are about as wide
                own, nth = _spread(np.zeros(len(one), np.int64), -(-((one[:, 3] + 2 - one[:, 2]) * w) // _SPAN))
                low = one[own, 2] * w + nth * _SPAN
                high = np.minimum((one[own, 3] + 2) * w, low + _SPAN + 2 * w) - 1
                order = np.argsort(high - low, kind="stable")
                best = out.get((t, k), (e + 1, 0))
                for same in np.split(order, np.flatnonzero(np.diff((high - low)[order].astype(np.float64)) > 4 * w) + 1):
                    for dist, end in distances(x, text, low[same], high[same], e):
                        if (dist, at + end) < best and dist <= e:
                            best = dist, at + end
                if best[0] <= e:
                    out[t, k] = best
    return [(t, k, *v) for (t, k), v in sorted(out.items())]


#: Of this worker: the latest index, kept between tasks where it is small, by the key of its query.
_INDEXES: dict[str, Index] = {}
_KEPT = 1 << 20


def _searched(base: DataFrame, given: list[tuple], id_type, config: Config, text: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of base and the hits of these items."""
    spark = base.sparkSession
    shared, key, small = spark.sparkContext.broadcast(given), uuid.uuid4().hex, sum(len(t) for _, t in given) <= _KEPT
    kind = pa.list_(pa.struct([("item_id", to_arrow_type(id_type)), ("edits", pa.int32()), ("end", pa.int32())]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.select(*(f"`{k}`" for k in keep)).schema) + f", hits array<struct<item_id:{id_type.simpleString()},edits:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _INDEXES.get(key)
        if index is None:
            index = Index(shared.value, config)
            _INDEXES.clear()
            if small:
                _INDEXES[key] = index
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
            got: list[dict] = []
            for part in chunks(byte_texts(b.column(text)), limit=1 << 20):
                own: list[dict] = [{} for _ in part]
                for t, k, edits, end in find([x.decode() for x in part], index, config):
                    i = index.items[k][0]
                    if i not in own[t] or own[t][i]["edits"] > edits:
                        own[t][i] = {"item_id": i, "edits": edits, "end": end}
                got += own
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array([[*g.values()] for g in got], kind)], names=[*keep, "hits"])

    return base.mapInArrow(tidy(run), schema)


def hits(docs: DataFrame, items: DataFrame, config: Config = Config(), text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs with `hits` (replacing a column of this name): item_id, edits and end (in characters) of each item found."""
    rows = items.where(f"`{item_text}` is not null and `{item_text}` <> '' and `{item_id}` is not null").select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).distinct()
    parts = -(-(rows.agg(F.sum(F.length("t"))).first()[0] or 0) // config.most) or 1
    id_type = rows.schema["i"].dataType
    base = docs.drop("hits")
    one = F.pmod(F.xxhash64("i", "t"), F.lit(parts))

    def given(part: int) -> list[tuple]:
        return sorted((r[0], r[1]) for r in rows.where(one == part).collect())

    if parts == 1:
        return _searched(base, given(0), id_type, config, text, base.columns)
    keyed = stored(base.withColumn("_number", F.monotonically_increasing_id()), "numbered")
    each = []
    for k in range(parts):
        some = _searched(keyed.select("_number", text), given(k), id_type, config, text, ["_number"]).where(F.size("hits") > 0)
        each.append(stored(some.select("_number", F.explode("hits").alias("h")), "hits"))
    found = reduce(DataFrame.unionByName, each).groupBy("_number").agg(F.sort_array(F.collect_list("h")).alias("_all"))
    # an item_id whose texts are in several parts counts once, with its fewest edits
    best = F.filter("_all", lambda h, k: (k == 0) | (F.get(F.col("_all"), k - 1)["item_id"] != h["item_id"]))
    none = F.expr(f"cast(array() as array<struct<item_id:{id_type.simpleString()},edits:int,end:int>>)")
    return keyed.join(found.select("_number", best.alias("hits")), "_number", "left").select(*(f"`{c}`" for c in base.columns), F.coalesce("hits", none).alias("hits"))
