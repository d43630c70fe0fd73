"""Media columns: local image descriptors that find cropped or edited copies.

1. Corners: on each scale of a pyramid, local maxima of the Harris response, the `corners` strongest of a scale, and of those
   with equal bits the `same` strongest (bounds of the descriptor, whatever the table's size): of a texture that repeats itself,
   more say nothing new, and all would match all.
2. Each corner's patch, `reach` to each side, is turned by its intensity centroid; 128 pairs of points are compared, each at
   each of `margins`: a bit says that one point exceeds the other by so much of the patch's deviation, so noise in flat areas sets none.
3. Hamming tables: the bits are dealt to radius + 1 words, so descriptors within `radius` bits of each other are equal in one
   word at least, and a table for each word misses none. Each different descriptor is looked up once, whatever the number of its
   corners. Blocks of queries meet chunks of images in tasks; matching corners, whose number is in proportion to queries times
   images, never become rows. Counters by turn, then places, rule image pairs out; neither rules one out that has the votes.
4. Consensus: each matching pair of corners votes for scale and turn; an image pair is a copy where at least `votes` corners,
   and a `share` of those that the image with fewer corners has, agree on one similarity transform to within `tolerance` pixels
   and `turn` radians. Agreeing corners are counted up to `enough`; transforms that many pairs propose are tried once.

Images of equal pixels are one class, joined once through its least id, so copies aren't expanded. Queries are a stated set of
rows; every row is indexed. Null, empty or too small images have no corners and match only their equals.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored


@dataclass(frozen=True)
class Config:
    scales: tuple[float, ...] = (1.0, 1.5, 2.25)
    corners: int = 128
    #: Corners of equal bits that an image keeps of a scale.
    same: int = 16
    reach: int = 8
    margins: tuple[float, ...] = (0.2,)
    radius: int = 3
    votes: int = 5
    #: At least so many of the corners of the image that has fewer must agree.
    share: float = 0.08
    #: Agreeing corners beyond which they aren't counted.
    enough: int = 64
    tolerance: float = 3.0
    turn: float = 0.45
    seed: int = 5


_TESTS = 128


def _corner(c: Config) -> np.dtype:
    """x, y, scale, angle and the words of a descriptor, of which each is `radius` + 1-th of its bits."""
    return np.dtype([("x", "<f4"), ("y", "<f4"), ("s", "<f4"), ("t", "<f4"), ("h", "<u8", c.radius + 1)])


#: Log of the scale up to which two pairs of corners agree.
_RATIO = 0.2
#: Query classes and image classes that one group holds side by side, and query classes whose table is held at once. Of few
#: images there are chunks of `_LEAST`, up to `_GROUPS` of them, so that many tasks have some.
_BLOCK, _CHUNK, _TABLE, _LEAST, _GROUPS = 8192, 4096, 2048, 512, 48
#: Bins of turns, and bins to each side that may hold corners which agree with one of this bin: turns of two that agree with a
#: third differ by twice `turn` at most, and a difference of bins is less than one off for each of the two corners.
_TURNS = 32
#: Counters of a step: image pairs with ratios of scales, times bins.
_CELLS = 1 << 13


@functools.lru_cache(8)
def _pattern(seed: int, reach: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.clip(rng.normal(0, reach / 2.2, (_TESTS, 4)), -reach, reach)


def _blur(a: np.ndarray) -> np.ndarray:
    h, w = a.shape
    p = np.empty((h + 4, w))
    p[2:-2], p[:2], p[-2:] = a, a[0], a[-1]
    a = _weighed(p.reshape(-1), w)
    p = np.empty((h, w + 4))
    p[:, 2:-2] = a.reshape(h, w)
    p[:, :2], p[:, -2:] = p[:, 2:3], p[:, -3:-2]
    out = np.empty(h * (w + 4))
    out[:-4] = _weighed(p.reshape(-1), 1)  # of places past a row's end too
    return out.reshape(h, w + 4)[:, :w] * (1 / 256)


def _weighed(p: np.ndarray, step: int) -> np.ndarray:
    """Sums of five numbers a step apart, weighed 1, 4, 6, 4, 1."""
    n = len(p) - 4 * step
    a = p[:n] + p[4 * step :]
    side = p[step : n + step] + p[3 * step : n + 3 * step]
    side *= 4
    a += side
    np.multiply(p[2 * step : n + 2 * step], 6, out=side)
    a += side
    return a


@functools.lru_cache(64)
def _steps(n: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place of a side of n made smaller: the places before and after it, and how far it is from the first."""
    at = np.minimum((np.arange(max(1, int(n / factor))) + 0.5) * factor - 0.5, n - 1)
    lo = np.maximum(at.astype(int), 0)
    return lo, np.minimum(lo + 1, n - 1), at - lo


def _resized(a: np.ndarray, factor: float) -> np.ndarray:
    (y0, y1, fy), (x0, x1, fx) = (_steps(n, factor) for n in a.shape)
    a = a.take(x0, axis=1) * (1 - fx) + a.take(x1, axis=1) * fx
    fy = fy[:, None]
    return a.take(y0, axis=0) * (1 - fy) + a.take(y1, axis=0) * fy


def _gradient(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Differences by rows and by columns: of both neighbours, at borders of one."""
    y, x = np.empty_like(a), np.empty_like(a)
    np.subtract(a[2:], a[:-2], out=y[1:-1])
    np.subtract(a[:, 2:], a[:, :-2], out=x[:, 1:-1])
    y[1:-1] *= 0.5
    x[:, 1:-1] *= 0.5
    y[0], y[-1] = a[1] - a[0], a[-1] - a[-2]
    x[:, 0], x[:, -1] = a[:, 1] - a[:, 0], a[:, -1] - a[:, -2]
    return y, x


def _words(bits: np.ndarray, n: int) -> np.ndarray:
    """n words of the bits, dealt in turn."""
    out = np.zeros((len(bits), n, 64), bool)
    for k in range(n):
        own = bits[:, k::n]
        out[:, k, : own.shape[1]] = own
    return np.packbits(out, axis=2).view("<u8").reshape(len(bits), n)


@functools.lru_cache(8)
def _disc(reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a patch, from its middle."""
    side = np.arange(-reach, reach + 1)
    yy, xx = np.meshgrid(side, side, indexing="ij")
    inside = yy * yy + xx * xx <= reach * reach
    return yy[inside], xx[inside]


def describe(image: np.ndarray, c: Config = Config()) -> list[tuple[float, float, float, float, bytes]]:
    """(x, y, scale, angle, bits) of each corner of a grey image."""
    return [(*p, k.tobytes()) for places, bits in _found(image, c) for p, k in zip(places.tolist(), bits, strict=True)]


def _packed(image: np.ndarray, c: Config) -> bytes:
    """Corners of a grey image as `_Table` reads them."""
    found = _found(image, c)
    out = np.empty(sum(len(bits) for _, bits in found), _corner(c))
    at = 0
    for places, bits in found:
        part = out[at : at + len(bits)]
        part["x"], part["y"], part["s"], part["t"] = places.T
        part["h"] = bits
        at += len(bits)
    return out.tobytes()


def _found(image: np.ndarray, c: Config) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each scale: x, y, scale and angle of each corner, and the words of its bits."""
    out = []
    if image.ndim != 2:
        return out
    pattern = _pattern(c.seed, c.reach)
    r = int(np.ceil(c.reach * 1.5))
    yy, xx = _disc(c.reach)
    for scale in c.scales:
        a = _blur(_resized(image.astype(np.float64), scale) if scale != 1 else image.astype(np.float64))
        if min(a.shape) < 2 * r + 3:
            continue
        gy, gx = _gradient(a)
        sxx, syy, sxy = _blur(gx * gx), _blur(gy * gy), _blur(gx * gy)
        s = sxx * syy - sxy * sxy - 0.05 * (sxx + syy) ** 2
        h, w = s.shape
        own, s = s[r : h - r, r : w - r] > max(1.0, 0.01 * s.max()), s.reshape(-1)
        ys, xs = np.nonzero(own)
        peak = (ys + r) * w + xs + r
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                if dy or dx:
                    mine, other = s.take(peak), s.take(peak - (dy * w + dx))
                    peak = peak[mine > other if (dy, dx) < (0, 0) else mine >= other]
        peak = peak[np.argsort(-s.take(peak), kind="stable")[: c.corners]]  # of equal ones the first by rows
        if not len(peak):
            continue
        ys, xs = peak // w, peak % w
        flat = a.reshape(-1)
        patch = flat.take(peak[:, None] + (yy * w + xx))
        angle = np.arctan2(patch @ yy, patch @ xx)
        co, si = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
        # corners are so far from borders that no turn leads beyond them
        px = np.rint(xs[:, None, None] + pattern[:, 0::2] * co - pattern[:, 1::2] * si)
        py = np.rint(ys[:, None, None] + pattern[:, 0::2] * si + pattern[:, 1::2] * co)
        py *= w
        py += px
        v = flat.take(py.astype(np.intp))
        gap = (v[..., 1] - v[..., 0]) / np.maximum(patch.std(axis=1), 1e-9)[:, None]
        bits = _words(np.concatenate([gap > m for m in c.margins], axis=1), c.radius + 1)
        kept = _first_of_each(bits, c.same)  # corners come by strength
        xs, ys = (xs[kept] + 0.5) * scale - 0.5, (ys[kept] + 0.5) * scale - 0.5
        out.append((np.stack([xs, ys, np.full(len(kept), scale), angle[kept]], 1), bits[kept]))
    return out


def _first_of_each(bits: np.ndarray, n: int) -> np.ndarray:
    """Numbers, ascending, of the first n rows of each kind."""
    if len(bits) <= n:
        return np.arange(len(bits))
    order, _, first, count = _kinds(bits)
    if count.max() <= n:
        return np.arange(len(bits))
    nth = np.arange(len(order)) - np.repeat(first, count)
    return np.sort(order[nth < n])


def _kinds(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by kind (each kind's in their own order), kind of each row, and where each kind begins and how many it has."""
    order = np.lexsort(rows.T)
    ordered = rows[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(rows)), bool), (ordered[1:] != ordered[:-1]).any(1)]))
    count = np.diff(np.append(new, len(rows)))
    which = np.empty(len(rows), np.int64)
    which[order] = np.repeat(np.arange(len(new)), count)
    return order, which, new, count


def consensus(pairs: np.ndarray, c: Config = Config()) -> int:
    """Most matched corners that agree on one similarity transform, counted up to c.enough. pairs: x, y, scale, angle of one corner, then of the other.

    Each pair by itself gives a transform (scale, turn, shift); the pairs that it puts to within the tolerance are counted, and
    no corner of either image counts twice. Equal transforms are one, and those of most pairs come first.
    """
    if not len(pairs):
        return 0
    a, b = pairs[:, :4], pairs[:, 4:]
    ratio, turn = b[:, 2] / a[:, 2], b[:, 3] - a[:, 3]
    near = c.tolerance * np.maximum(1, b[:, 2])
    beyond = near * near * (1 + 1e-9)
    by_place = []
    for p in (a, b):
        place = np.rint(p[:, 0]) * 2.0**26 + np.rint(p[:, 1])
        order = np.argsort(place, kind="stable")
        place = place[order]
        by_place.append((order, np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])))
    most = min(c.enough, *(len(start) for _, start in by_place))
    co, si = ratio * np.cos(turn), ratio * np.sin(turn)
    shift_x, shift_y = b[:, 0] - co * a[:, 0] + si * a[:, 1], b[:, 1] - si * a[:, 0] - co * a[:, 1]
    order, _, first, count = _kinds(np.rint(np.stack([ratio * 1e4, co * 1e3, si * 1e3, shift_x * 100, shift_y * 100], 1)))
    lead = order[first]
    lead = lead[np.lexsort((lead, -count))]
    best, at, step = 0, 0, 64
    while at < len(lead):
        k = lead[at : at + step]
        at, step = at + step, max(1, min(4 * step, 1_000_000 // len(pairs)))
        dx, dy = a[:, 0] - a[k, :1], a[:, 1] - a[k, 1:2]
        ex = co[k, None] * dx - si[k, None] * dy + b[k, :1] - b[:, 0]
        ey = si[k, None] * dx + co[k, None] * dy + b[k, 1:2] - b[:, 1]
        fits = ex * ex + ey * ey <= beyond
        # the rest is asked of few
        u, v = np.nonzero(fits)
        w = k[u]
        fits[u, v] = (np.hypot(ex[u, v], ey[u, v]) <= near[v]) & (np.abs(np.log(ratio[v] / ratio[w])) < _RATIO) & (np.cos(turn[v] - turn[w]) > np.cos(c.turn))
        fits = fits[fits.sum(1) > best]
        if len(fits):
            best = max(best, int(np.minimum(*(np.logical_or.reduceat(fits[:, o], start, axis=1).sum(1) for o, start in by_place)).max()))
            if best >= most:
                return most
    return best


def _keep_freed() -> None:
    """After a block of this size was freed, glibc hands blocks up to it out again instead of asking the system for new pages each time. None of it is touched."""
    np.empty(30 << 20, np.uint8)


def _described(images: DataFrame, c: Config) -> DataFrame:
    """image_id, query, digest and corners of images (id, query, width, pixels). Pixels go no further than this."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_freed()
        for b in batches:
            got, digests = [], []
            for w, p in zip(b.column("width").to_pylist(), b.column("pixels").to_pylist(), strict=True):
                grey = np.frombuffer(p or b"", np.uint8)
                fine = w and w > 0 and len(grey) and len(grey) % w == 0
                digests.append(hashlib.sha256(f"{w}|".encode() + (p or b"")).digest())
                got.append(_packed(grey.reshape(-1, w), c) if fine else b"")
            yield pa.RecordBatch.from_arrays([b.column("image_id"), b.column("query"), pa.array(digests, pa.binary()), pa.array(got, pa.binary())], names=["image_id", "query", "digest", "corners"])

    return images.mapInArrow(run, "image_id bigint, query boolean, digest binary, corners binary")


def needed(a, b, c: Config = Config()):
    """Corners that must agree for images of a and b corners."""
    return np.maximum(c.votes, np.ceil(c.share * np.minimum(a, b) - 1e-9)).astype(np.int64)


class _Table:
    """The different descriptors of some images, and the corners of each."""

    def __init__(self, packed: list[bytes], c: Config):
        kind = _corner(c)
        corners = np.frombuffer(b"".join(packed), kind)
        self.packed = packed
        self.own = np.array([len(p) // kind.itemsize for p in packed], np.int64)
        self.image = np.repeat(np.arange(len(packed)), self.own)
        self.x, self.y, self.s, self.t = (np.ascontiguousarray(corners[k]) for k in "xyst")
        self.place, self.ray = self.x + 1j * self.y, self.s * np.exp(1j * self.t)
        self.back = 1 / self.ray
        self.scale = np.searchsorted(np.sort(np.array(c.scales, np.float32)), self.s)
        self.turn = np.floor(self.t * np.float32(_TURNS / (2 * np.pi))).astype(np.int64)
        bits = np.ascontiguousarray(corners["h"]).reshape(len(corners), -1)
        if not (bits >> np.uint64(32)).any():  # two words in one
            bits = np.stack([np.bitwise_or.reduce(bits[:, k : k + 2] << np.array([0, 32], np.uint64)[: bits.shape[1] - k], axis=1) for k in range(0, bits.shape[1], 2)], 1)
        self.order, self.which, self.first, self.count = _kinds(bits)
        lead = self.order[self.first]
        self.bits = np.ascontiguousarray(bits[lead].T)
        self.words = np.ascontiguousarray(corners["h"].reshape(len(corners), -1)[lead].T)

    def sort(self) -> _Table:
        self.by_word = [np.argsort(w, kind="stable") for w in self.words]
        self.sorted = [w[o] for w, o in zip(self.words, self.by_word, strict=True)]
        self.bits_by_word = [np.ascontiguousarray(self.bits[:, o]) for o in self.by_word]
        return self


#: Candidates whose bits are compared at once.
_LOOK = 1 << 17


def _near(q: _Table, r: _Table, c: Config) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Descriptors of q (sorted) and of r that are within the radius, each such pair once; by descriptors of r. None if they are too many of several images."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    found = 0
    for at, (known, word) in enumerate(zip(q.sorted, r.words, strict=True)):
        lo = np.searchsorted(known, word)
        n = np.searchsorted(known, word, "right") - lo
        some = np.flatnonzero(n)
        lo, n = lo[some], n[some]
        for a, b in _portions(n, _LOOK):
            i, j = _ranges(lo[a:b], n[a:b]), np.repeat(some[a:b], n[a:b])
            apart = np.zeros(len(i), np.uint8)
            for k in sorted(range(len(r.bits)), key=lambda k: k == at * len(r.bits) // len(r.words)):  # those without the equal word first
                differ = q.bits_by_word[at][k][i]
                differ ^= r.bits[k][j]
                apart += np.bitwise_count(differ)
                near = np.flatnonzero(apart <= c.radius)
                i, j, apart = i[near], j[near], apart[near]
            i = q.by_word[at][i]
            for k in range(at):  # a pair whose earlier words are equal was met there
                new = q.words[k][i] != r.words[k][j]
                i, j = i[new], j[new]
            left.append(i)
            right.append(j)
            found += len(i)
            if found > 4 * _PAIRS and len(r.own) > 1:
                return None, None
    i, j = np.concatenate(left), np.concatenate(right)
    by = np.argsort(j, kind="stable")
    return i[by], j[by]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Members first, first + 1, ... of ranges of count members each."""
    out = np.repeat(first - (np.cumsum(count) - count), count)
    out += np.arange(len(out))
    return out


def _portions(count: np.ndarray, size: int, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Cuts counts into stretches (of at most `most`) whose sums are at most size, unless a single one is more."""
    ends = np.cumsum(count)
    at = 0
    while at < len(count):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        to = max(at + 1, to if most is None else min(to, at + most))
        yield at, min(to, len(count))
        at = to


#: Pairs of corners that are held at once, unless one image has more.
_PAIRS = 2_000_000


#: Pairs of corners that are gathered before their places are compared, and that are compared at once.
_HELD, _SIDE = 1 << 18, 1 << 17


def _agreeing(q: _Table, packed: list[bytes], c: Config) -> Iterator[tuple[int, int, int]]:
    """Image of q (sorted), image of packed and votes, where these suffice. Images, then queries, that meet too much at once are taken by halves."""
    r = _Table(packed, c)
    i, j = _near(q, r, c)
    if i is None:
        del r
        half = len(packed) // 2
        yield from _agreeing(q, packed[:half], c)
        yield from ((a, half + b, votes) for a, b, votes in _agreeing(q, packed[half:], c))
        return
    # of each descriptor of r: descriptors of q that it meets, their corners, and where the former begin
    n, size = np.bincount(j, minlength=len(r.count)), np.bincount(j, q.count[i], minlength=len(r.count)).astype(np.int64)
    begin = np.cumsum(n) - n
    past = np.concatenate([[0], np.cumsum(r.own)])
    split = _parities(c)
    wide = len(q.own) * split
    steps = max(1, _CELLS // wide)
    cells = 1 << int(steps * wide - 1).bit_length()
    slack = min(int(np.ceil(2 * c.turn * _TURNS / (2 * np.pi) + 1e-3)) + 1, _TURNS // 2)
    for lo, hi, used in _stretches(r, size, past, 0, len(packed)):
        # the corners of q that a descriptor of r meets lie side by side
        each = i[_ranges(begin[used], n[used])]
        met = q.order[_ranges(q.first[each], q.count[each])]
        # A counter for each image pair, parity of the steps between two scales, and difference of turns. Corners that agree have
        # equal parities and near differences, so pairs of corners with too few others near them are left out, however they lie.
        codes = q.image[met] * split - q.turn[met] * cells
        if split == 2:  # once for corners of r on even scales, once for odd ones
            codes = np.concatenate([codes + (q.scale[met] & 1), codes + 1 - (q.scale[met] & 1)])
        start = np.zeros(len(size), np.int64)
        start[used] = np.cumsum(size[used]) - size[used]
        held, pairs = [], 0
        own_size = size[r.which[past[lo] : past[hi]]]
        sums = np.add.reduceat(np.append(own_size, 0), past[lo:hi] - past[lo]) * (r.own[lo:hi] > 0)
        for a, b in _portions(sums, _PAIRS, steps):
            if sums[a] > 4 * _PAIRS and len(q.own) > 1:
                at = 0
                for part in (q.packed[: len(q.own) // 2], q.packed[len(q.own) // 2 :]):
                    yield from ((at + k, lo + a, votes) for k, _, votes in _agreeing(_Table(part, c).sort(), packed[lo + a : lo + b], c))
                    at += len(part)
                continue
            a, b = a + lo, b + lo
            own = slice(past[a], past[b])
            kind = r.which[own]
            many, at = size[kind], start[kind]
            cell = codes.take(_ranges(at + (r.scale[own] & 1) * len(met) * (split - 1), many))
            cell += np.repeat((r.turn[own] + 2 * _TURNS) * cells + (r.image[own] - a) * wide, many)
            cell &= _TURNS * cells - 1
            need, most = needed(q.own, r.own[a:b, None], c).reshape(-1), int(q.own.max() * r.own[a:b].max())
            use = np.flatnonzero(_enough(cell, cells, np.repeat(need, split), slack, most).take(cell))
            if len(use):
                group = cell[use] & (cells - 1)
                by = np.argsort(group.astype(np.uint16) if cells <= 1 << 16 else group, kind="stable")
                use, group = use[by], group[by]
                y = np.repeat(np.arange(len(kind)), many).take(use)
                x = met.take(use - (np.cumsum(many) - many - at)[y])
                held.append((x, y + past[a], group + a * wide))
                pairs += len(use)
            if pairs > _HELD:
                yield from _consensus(q, r, held, split, c)
                held, pairs = [], 0
        if held:
            yield from _consensus(q, r, held, split, c)


def _stretches(r: _Table, size: np.ndarray, past: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Cuts images lo to hi of r where their descriptors meet too many corners (`size` of each) to be held, and lists the descriptors that meet any."""
    used = np.unique(r.which[past[lo] : past[hi]])
    used = used[size[used] > 0]
    if hi - lo > 1 and int(size[used].sum()) > _PAIRS:
        middle = (lo + hi) // 2
        yield from _stretches(r, size, past, lo, middle)
        yield from _stretches(r, size, past, middle, hi)
    elif len(used):
        yield lo, hi, used


def _parities(c: Config) -> int:
    """2 if any two scales whose ratios may agree are apart by steps of one parity, else 1."""
    at = np.log(np.sort(np.array(c.scales, np.float32)).astype(np.float64))
    n = np.arange(len(at))
    ratio, odd = (at[:, None] - at).reshape(-1), (n[:, None] - n).reshape(-1) % 2
    return 1 if (np.abs(ratio[:, None] - ratio)[odd[:, None] != odd] <= _RATIO + 2e-4).any() else 2


def _enough(cell: np.ndarray, cells: int, need: np.ndarray, slack: int, most: int) -> np.ndarray:
    """Of each counter whether it and those of the `slack` bins to each side, whose bins go round, come to what its image pair needs. None of these sums is over `most`."""
    n = np.zeros((_TURNS, cells), np.uint16 if most < 1 << 16 else np.uint32)
    np.add.at(n.reshape(-1), cell, n.dtype.type(1))
    least = np.full(cells, np.iinfo(n.dtype).max, n.dtype)
    least[: len(need)] = need
    width = 2 * slack + 1
    if width >= _TURNS:
        return np.broadcast_to(n.sum(0, dtype=n.dtype) >= least, n.shape).reshape(-1)
    sums = np.zeros((_TURNS + width, cells), n.dtype)  # of the bins before; they may run over, their differences don't
    for k in range(1, len(sums)):
        np.add(sums[k - 1], n[(k - 1 - slack) % _TURNS], out=sums[k])
    return (sums[width:] - sums[:-width] >= least).reshape(-1)


def _consensus(q: _Table, r: _Table, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], split: int, c: Config) -> Iterator[tuple[int, int, int]]:
    """Image of q, image of r and votes, where these suffice, of pairs of corners (of q, of r, and their group, ascending: `split` groups for an image pair)."""
    x, y, group = (np.concatenate(v) for v in zip(*held, strict=True))
    pair = group // split
    wide = len(q.own)
    new = np.flatnonzero(np.diff(group, prepend=-1))
    size = np.diff(np.append(new, len(group)))
    need = needed(q.own[pair[new] % wide], r.own[pair[new] // wide], c)
    wanted = pair[new[_supported(q, r, x, y, new, size, need, c)]]
    if not len(wanted):
        return
    wanted = wanted[np.diff(wanted, prepend=-1) > 0]
    for p, a, b in zip(wanted.tolist(), np.searchsorted(pair, wanted).tolist(), np.searchsorted(pair, wanted, "right").tolist(), strict=True):
        m = np.stack([t[k] for t, k in ((q.x, x[a:b]), (q.y, x[a:b]), (q.s, x[a:b]), (q.t, x[a:b]), (r.x, y[a:b]), (r.y, y[a:b]), (r.s, y[a:b]), (r.t, y[a:b]))], 1)
        if (votes := consensus(m.astype(np.float64), c)) >= needed(q.own[p % wide], r.own[p // wide], c):
            yield p % wide, p // wide, votes


#: Group sizes that are compared together; of larger groups the consensus is asked at once.
_SIZES = (6, 8, 10, 13, 16, 20, 25, 32, 48, 64, 96, 128, 256, 512)


def _supported(q: _Table, r: _Table, x: np.ndarray, y: np.ndarray, first: np.ndarray, size: np.ndarray, need: np.ndarray, c: Config) -> np.ndarray:
    """Which groups have a pair of corners that enough pairs of the group lie right for, before turns are compared and corners told apart. With some slack."""
    # corners of r come in order in a group
    new = np.diff(y, prepend=-1) != 0
    new[first] = True
    differ = np.add.reduceat(new, first, dtype=np.int64)
    out = size > _SIZES[-1]
    fine = (differ >= need) & ~out
    left, right, scale = q.place[x], r.place[y], r.s[y]
    turn = q.back[x] * r.ray[y]
    shift = right - turn * left
    far = (c.tolerance * np.maximum(1, scale) + np.float32(0.05)) ** 2
    least = 0
    for most in _SIZES:
        own = np.flatnonzero(fine & (size > least) & (size <= most))
        least = most
        step = max(1, _SIDE // (most * most))
        for at in range(0, len(own), step):
            part = own[at : at + step]
            k = np.arange(most)[:, None]
            at_ = first[part] + np.minimum(k, size[part] - 1)
            other = right[at_]
            other[k >= size[part]] = np.nan  # no member
            apart = left[at_][:, None] * turn[at_]
            apart += shift[at_]
            apart -= other[:, None]
            apart = apart.view(np.float32).reshape(*apart.shape, 2)
            apart *= apart
            near = apart[..., 0] + apart[..., 1] <= far[at_][:, None]
            out[part] = (near.sum(0, dtype=np.uint8 if most < 256 else np.uint16) >= need[part]).any(0)
    return out


def copies(images: DataFrame, is_query: Column, config: Config = Config(), id_: str = "image_id") -> DataFrame:
    """A row for each row of images (id, width, pixels): id, class_id (least id of equal pixels), copies.

    copies: the classes with a query row of which this class is a copy (other than itself), each with its agreeing corners.
    """
    c = config
    described = stored(_described(images.select(F.col(id_).cast("bigint").alias("image_id"), F.coalesce(is_query, F.lit(False)).alias("query"), "width", "pixels"), c), "described")
    classes = stored(described.groupBy("digest").agg(F.min("image_id").alias("class_id"), F.max("query").alias("query"), F.first("corners").alias("corners")), "classes")
    rows = classes.where("class_id is not null and length(corners) > 0")
    # every block of queries meets every chunk of images in one task, so that matching corners never are rows
    n_asked, n_held = rows.agg(F.count_if("query"), F.count("*")).first()
    blocks, chunks = max(1, -(-n_asked // _BLOCK)), max(1, -(-n_held // _CHUNK), min(-(-n_held // _LEAST), _GROUPS))
    block, chunk = (F.pmod(F.xxhash64("class_id"), F.lit(n)) for n in (blocks, chunks))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    asked = rows.where("query").select(block.alias("block"), every(chunks).alias("chunk"), "class_id", "corners")
    held = rows.select(every(blocks).alias("block"), chunk.alias("chunk"), "class_id", "corners")

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            _keep_freed()
            rc, held = right["class_id"].tolist(), right["corners"].tolist()
            for part in np.array_split(np.arange(len(left)), -(-len(left) // _TABLE)):
                q, qc = _Table(left["corners"].iloc[part].tolist(), c).sort(), left["class_id"].iloc[part].tolist()
                out += [(qc[i], rc[k], v) for i, k, v in _agreeing(q, held, c) if qc[i] != rc[k]]
        return pd.DataFrame(out, columns=["qc", "class_id", "votes"])

    agreed = asked.groupBy("block", "chunk").cogroup(held.groupBy("block", "chunk")).applyInPandas(match, "qc bigint, class_id bigint, votes int")
    found = agreed.groupBy("class_id").agg(F.sort_array(F.collect_list(F.struct(F.col("qc").alias("query_class"), "votes"))).alias("copies"))
    known = classes.select("digest", "class_id").join(found, "class_id", "left")
    return described.select("image_id", "digest").join(known, "digest").select("image_id", "class_id", F.coalesce("copies", F.expr("cast(array() as array<struct<query_class:bigint,votes:int>>)")).alias("copies"))
