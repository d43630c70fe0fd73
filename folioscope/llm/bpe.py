"""Byte-level BPE: encoding and decoding by a rank file.

Each match of the splitting pattern is merged by itself. A segment tree over byte positions holds at each live position the
rank of the pair that starts there; its root is the leftmost pair of least rank. A merge updates three leaves: the pair that
grew, the pair before it and the position that died, so a piece of n bytes takes O(n log n) whatever its form.

Null text is empty and has no ids. One pass over rows, no shuffle; the ranks (fixed size) are the only thing broadcast, and
each task keeps a table of pieces already merged, bounded in bytes and dropped when the task ends.
"""

from __future__ import annotations

import base64
import gc
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import tidy

_NONE = 1 << 62
#: Bytes, by estimate, of the latest pieces already merged that a task remembers, and as many of older ones.
REMEMBERED = 24 << 20
#: Bytes of a dict's entry, a string and a bytes object, beside their contents.
_ENTRY = 190


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> tuple[int, ...]:
    """Ids of one piece."""
    if (whole := ranks.get(piece)) is not None:
        return (whole,)
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    get = ranks.get
    level = [_NONE if (r := get(piece[i : i + 2])) is None else r << 32 | i for i in range(n - 1)]
    level += [_NONE] * (size - n + 1)
    tree = level
    while len(level) > 1:
        level = list(map(min, level[::2], level[1::2]))
        tree = level + tree
    tree = [_NONE, *tree]
    after, before = [*range(1, n + 1), n], [*range(-1, n)]  # live neighbours; n is the end
    while (top := tree[1]) != _NONE:
        i = top & 0xFFFFFFFF
        j = after[i]
        k = after[i] = after[j]
        before[k] = i
        h = before[i]
        for p, q in ((j, 0), (i, after[k] if k < n else 0), (h, k)):  # pairs that start at p and now end at q, if any
            if p < 0:
                continue
            value = _NONE
            if 0 < q - p <= longest and (r := get(piece[p:q])) is not None:
                value = r << 32 | p
            at = size + p
            if tree[at] == value:
                continue
            tree[at] = value
            while at > 1:
                other = tree[at ^ 1]
                if other < value:
                    value = other
                at >>= 1
                if tree[at] == value:
                    break
                tree[at] = value
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return tuple(out)


def packed(ids) -> bytes:
    """Ids as 32-bit numbers, which take a fifth of a tuple's room."""
    return np.asarray(ids, "<i4").tobytes()


class Pairs:
    """Ranks by the ids of a pair's two tokens, for many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]):
        def cuts() -> Iterator[int]:
            for t, r in ranks.items():
                for cut in range(1, len(t)):
                    if (left := ranks.get(t[:cut])) is not None and (right := ranks.get(t[cut:])) is not None:
                        yield left << 32 | right
                        yield r

        table = np.fromiter(cuts(), np.int64).reshape(-1, 2)
        table = table[np.argsort(table[:, 0])]
        self.keys, self.ranks = np.append(table[:, 0], np.iinfo(np.int64).max), np.append(table[:, 1], 0)
        self.bytes = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)

    def values(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Leaves of the segment tree for pairs that start at these places."""
        key = left << 32 | right
        k = np.searchsorted(self.keys, key)
        return np.where(there & (self.keys[k] == key), self.ranks[k] << 32 | at, _NONE)


def merge_many(pieces: list[bytes], pairs: Pairs) -> list[bytes]:
    """As merge, of pieces that no token is equal to, side by side: one segment tree a row. The longest piece sets the rows' size. Ids as packed."""
    rows = len(pieces)
    n = np.array([len(p) for p in pieces])
    size = 1 << int(n.max() - 1).bit_length()
    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(rows, size)
    ids = pairs.bytes[raw]
    place = np.arange(size)
    live = place < n[:, None]
    tree = np.full((rows, 2 * size), _NONE, np.int64)
    tree[:, size : 2 * size - 1] = pairs.values(ids[:, :-1], ids[:, 1:], place[:-1], live[:, 1:])
    width = size
    while width > 1:
        width >>= 1
        tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
    after = np.repeat(np.arange(1, size + 2)[None, :], rows, 0)
    before = np.repeat(np.arange(-1, size)[None, :], rows, 0)
    row = np.arange(rows)
    while True:
        row = row[tree[row, 1] != _NONE]
        if not len(row):
            break
        top = tree[row, 1]
        i = top & 0xFFFFFFFF
        j = after[row, i]
        k = after[row, j]
        after[row, i] = k
        before[row, k] = i
        live[row, j] = False
        ids[row, i] = top >> 32
        h = before[row, i]
        inside, some = np.minimum(k, size - 1), np.maximum(h, 0)
        new_i = pairs.values(ids[row, i], ids[row, inside], i, k < n[row])
        new_h = pairs.values(ids[row, some], ids[row, i], some, h >= 0)
        tree[row, size + j] = _NONE
        tree[row, size + i] = new_i
        tree[row, size + some] = np.where(h >= 0, new_h, tree[row, size + some])
        for p in (j, i, some):
            at = (size + p) >> 1
            while at[0]:
                tree[row, at] = np.minimum(tree[row, 2 * at], tree[row, 2 * at + 1])
                at = at >> 1
    flat, end = packed(ids[live]), (4 * np.cumsum(live.sum(1))).tolist()
    return [flat[s:e] for s, e in zip([0, *end], end, strict=False)]


class Codec(dict):
    """Encodes and decodes; as a dict, the packed ids of pieces already merged."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.size = 0
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.pairs, self.longest = Pairs(ranks), max(map(len, ranks), default=0)
        self.tokens = {i: t for t, i in ranks.items()}
        self.decimals = {i: str(i) for i in self.tokens}

    def __missing__(self, piece: str) -> bytes:
        self[piece] = ids = self.older[piece]
        return ids

    def forget(self) -> None:
        self.clear()
        self.older.clear()
        self.size = 0

    def _learn(self, pieces: set[str]) -> None:
        if self.size >= REMEMBERED:
            self.older = dict(self)
            self.clear()
            self.size = 0
        by: dict[int, list[tuple[str, bytes]]] = {}
        known, single = self.older.get, self.ranks.get
        for p in pieces:
            if (ids := known(p)) is not None:
                self[p] = ids
                continue
            b = p.encode()
            if (whole := single(b)) is not None:
                self[p] = whole.to_bytes(4, "little")
            elif len(b) > 64:
                self[p] = packed(merge(b, self.ranks, self.longest))
            else:
                by.setdefault((len(b) - 1).bit_length(), []).append((p, b))
        for own in by.values():
            for at in range(0, len(own), 8192):
                part = own[at : at + 8192]
                self.update(zip((p for p, _ in part), merge_many([b for _, b in part], self.pairs), strict=True))
        self.size += _ENTRY * len(pieces) + 5 * sum(map(len, pieces))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text. Long pieces aren't remembered beyond this call."""
        pieces = [self.split(t) for t in texts]
        new = set(chain.from_iterable(pieces)).difference(self)
        self._learn(new)
        out = [np.frombuffer(b"".join(map(self.__getitem__, p)), "<i4").tolist() for p in pieces]
        for p in new:
            if len(p) > 64:
                del self[p]
                self.size -= _ENTRY + 5 * len(p)
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


#: Of this worker, by the key of the query that made it; only the latest stays, and between tasks only its ranks (fixed size).
_CODECS: dict[str, Codec] = {}


def _mapped(df: DataFrame, ranks: dict[bytes, int], pattern: str, column: str, make, schema: str, keep: list[str] | None = None) -> DataFrame:
    """df (or its columns `keep`) with the columns of schema, which make(codec, values) gives for each of some values of the column."""
    names = [x.split()[0] for x in schema.split(", ")]
    base = df.drop(*(n for n in names if n != column))
    kept = [f for f in base.schema if f.name not in names and (keep is None or f.name in keep)]
    full = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), schema])
    kinds = {"array<int>": pa.list_(pa.int32()), "string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]
    shared, key, columns = df.sparkSession.sparkContext.broadcast(ranks), uuid.uuid4().hex, [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enabled = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and walking the remembered pieces again and again would take long
        try:
            if key not in _CODECS:
                _CODECS.clear()
                _CODECS[key] = Codec(shared.value, pattern)
            codec = _CODECS[key]
            for b in batches:
                for at in range(0, len(b), 256):
                    part = b.slice(at, 256)
                    got = list(make(codec, part.column(column).to_pylist()))
                    yield pa.RecordBatch.from_arrays([*(part.column(k) for k in columns), *(pa.array([g[k] for g in got], t) for k, t in enumerate(types))], names=[*columns, *names])
        finally:
            if key in _CODECS:
                _CODECS[key].forget()
            if enabled:  # the worker goes on to other operators' tasks
                gc.enable()

    return base.mapInArrow(tidy(run), full)


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df (or its columns `keep`, so that texts needn't come back) with `ids` (replacing a column of this name)."""
    return _mapped(df, ranks, pattern, text, lambda c, texts: ((x,) for x in c.encode_all([t or "" for t in texts])), "ids array<int>", keep)


def decode(df: DataFrame, ranks: dict[bytes, int], pattern: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """df (or its columns `keep`) with `decoded`, the bytes of ids (null: no bytes); an id without token raises."""
    return _mapped(df, ranks, pattern, ids, lambda c, many: ((c.decode(x or []),) for x in many), "decoded binary", keep)


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df (or its columns `keep`) with n_tokens, ids_text (decimal ids joined by one space) and decoded, made by encoding and then decoding in one pass."""

    def both(c: Codec, texts: list[str | None]):
        for ids in c.encode_all([t or "" for t in texts]):
            yield len(ids), " ".join(map(c.decimals.__getitem__, ids)), c.decode(ids)

    return _mapped(df, ranks, pattern, text, both, "n_tokens bigint, ids_text string, decoded binary", keep)
