"""Exact top-k search by inner product with a table of distances to pivots.

Vectors become integers, floor(scale * x). With squared lengths kept, an inner product is a distance: q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2,
and for every pivot p, d(q, x) >= |d(q, p) - d(x, p)|. The distances of every row to the pivots are computed once (the pivot
table); the greatest of the pivots' lower bounds of d is an upper bound of the score. Candidates are evaluated in the order of
their bounds until the next bound is below the k-th score found, so the result is exact whatever the pivots. Bounds are widened
by more than rounding can take from them.

Spark does it in blocks. Rows are put in order of their nearest pivot, then of their distance to it and id, by ranges (a pivot
near a third of all rows takes as many ranges as it needs), and packed into blocks of at most `block` rows, written with their
part of the pivot table, its least and greatest distance to each pivot and the greatest length. A query is first asked of its
own block alone; its k-th score there is a floor of its result. Queries, packed in the same order, then go to those blocks
whose bounds reach the least floor of a pack: pairs of packs and blocks are judged on their bounds alone, in groups of bounded
size, and only then do packs travel. A block returns for each query at most k rows, none below its floor; the best k of these
are the result. So nothing passes through the driver but the pivots and counts, no task holds more than a block and `together`
packs, and equal rows, however many, are split like any others.

Which rows are queries is a condition of the caller's, and every other row is a candidate; rows of one id are rows of their
own. Components that a vector lacks against a longer one count as 0. Vectors that are null, hold null or non-finite
components, or whose squared length exceeds 2^62 (so that scores would leave 64 bits) take no part; an empty vector has score 0
with all. Ties go to the smaller id, null ids last. A query without other rows has no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored, tidy


@dataclass(frozen=True)
class Config:
    k: int = 20
    scale: int = 64
    #: Pivots, taken from `sample` rows in the order of their hash, each as far as possible from the earlier ones. Only the time depends on them.
    pivots: int = 32
    sample: int = 1024
    #: Components of a row of that sample at most.
    wide: int = 4096
    #: Rows of a block, queries of a pack at most, and bytes of vectors of either.
    block: int = 4096
    asked: int = 1024
    bytes: int = 1 << 23
    #: Packs that meet a block in one task, about; blocks or packs whose bounds are judged in one task.
    together: int = 64
    judged: int = 1024


_MOST = 1 << 62
#: Relative widening of distances and squared lengths, above what single precision rounds away.
_SLACK = 1e-6


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(values.astype(np.float64) * scale)


def choose_pivots(rows: np.ndarray, n: int) -> np.ndarray:
    """Up to n different rows, each farthest from those before; the first is farthest from the mean. At least one (of zeros, if there are no rows)."""
    if not len(rows):
        return np.zeros((1, rows.shape[1] if rows.ndim == 2 else 0))
    far = ((rows - rows.mean(0)) ** 2).sum(1)
    out = [int(np.argmax(far))]
    far = ((rows - rows[out[0]]) ** 2).sum(1)
    while len(out) < n and far.max() > 0:
        out.append(int(np.argmax(far)))
        far = np.minimum(far, ((rows - rows[out[-1]]) ** 2).sum(1))
    return rows[out]


def _to_pivots(v: np.ndarray, lengths: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of the rows of v to each pivot."""
    wide = min(v.shape[1], pivots.shape[1])
    inner = v[:, :wide] @ pivots[:, :wide].T
    squared = lengths[:, None] + (pivots**2).sum(1)[None, :] - 2 * inner
    return np.sqrt(np.maximum(squared, 0))


class Block:
    """Rows packed as arrays: ids, squared lengths, vectors of one width, distances to pivots."""

    FIELDS = ("ids", "lengths", "vectors", "table")
    SCHEMA = "n int, width int, ids binary, lengths binary, vectors binary, table binary, low array<double>, high array<double>, longest bigint"

    def __init__(self, row: dict):
        n = row["n"]
        self.ids = np.frombuffer(row["ids"], np.int64).reshape(2, n)  # whether it is null, id
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(n, row["width"])
        self.table = np.frombuffer(row["table"], np.float64).reshape(n, -1)

    @staticmethod
    def pack(rows: list[tuple]) -> dict:
        """Of rows (id, length, vector, distances)."""
        width = max(len(r[2]) for r in rows)
        v = np.zeros((len(rows), width), np.int32)
        for i, r in enumerate(rows):
            v[i, : len(r[2])] = r[2]
        lengths, table = np.array([r[1] for r in rows], np.int64), np.stack([r[3] for r in rows])
        ids = np.array([[r[0] is None for r in rows], [r[0] or 0 for r in rows]], np.int64)
        return {"n": len(rows), "width": width, "ids": ids.tobytes(), "lengths": lengths.tobytes(), "vectors": v.tobytes(), "table": table.tobytes(), "low": table.min(0).tolist(), "high": table.max(0).tolist(), "longest": int(lengths.max())}


#: Queries whose bounds are computed at once.
_TOGETHER = 16


def _bounds(q: Block, c: Block) -> Iterator[np.ndarray]:
    """Of each query of q: an upper bound of its score with each row of c, from the greatest of the pivots' lower bounds of the distance."""
    table, lengths = np.ascontiguousarray(c.table.T, np.float32), c.lengths.astype(np.float32)
    slack = np.float32(_SLACK)
    for at in range(0, len(q.lengths), _TOGETHER):
        ask, own = q.table[at : at + _TOGETHER].astype(np.float32), q.lengths[at : at + _TOGETHER].astype(np.float32)
        apart, one = np.zeros((len(ask), len(lengths)), np.float32), np.empty((len(ask), len(lengths)), np.float32)
        for p in range(len(table)):
            np.subtract(table[p][None, :], ask[:, p][:, None], out=one)
            np.abs(one, out=one)
            np.maximum(apart, one, out=apart)
        apart -= slack * (table.max(initial=0) + ask.max(1, initial=0))[:, None]
        np.maximum(apart, 0, out=apart)
        size = lengths[None, :] + own[:, None]
        np.multiply(apart, apart, out=apart)
        np.subtract(size, apart, out=apart)
        apart *= np.float32(0.5)
        size *= slack
        apart += size
        apart += 1
        yield from apart


def best(q: Block, c: Block, floor: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Of each query of q: its number, places in c and scores of the k best rows of c that aren't below its floor, best first, and how many were evaluated; own: its place in c, or -1."""
    wide, most = min(q.vectors.shape[1], c.vectors.shape[1]), float(q.lengths.max()) * float(c.lengths.max())
    kind = np.float32 if most < 2.0**46 else np.float64 if most < 2.0**104 else np.int64  # every partial sum is at most the square root
    right, left = c.vectors[:, :wide].astype(kind), q.vectors[:, :wide].astype(kind)
    for i, most in enumerate(_bounds(q, c)):
        need = float(floor[i])
        at = np.flatnonzero(most >= need * (1 - _SLACK if need > 0 else 1 + _SLACK))
        at = at[at != own[i]]
        bound = most[at]
        top = bound.max(initial=0)
        step = max((top - bound.min(initial=top)) / 65_000, 1e-30)
        rank = ((top - bound) / step).astype(np.uint16)  # bounds in 65,000 steps, which sort in linear time; a bound is at most top - rank * step
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        place, score, done, size = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 8 * k
        while done < len(at):
            if len(score) == k and (float(top) - int(rank[done]) * float(step)) * (1 + _SLACK) + float(step) < need:
                break
            part = at[done : done + size]
            got = right[part] @ left[i]
            fine = np.flatnonzero(got >= need)
            place, score = np.concatenate([place, part[fine]]), np.concatenate([score, got[fine].astype(np.int64)])
            if len(score) > k:
                least = np.partition(score, len(score) - k)[len(score) - k]
                near = score >= least
                place, score = place[near], score[near]
            sort = np.lexsort((c.ids[1][place], c.ids[0][place], -score))[:k]
            place, score = place[sort], score[sort]
            if len(score) == k:
                need = max(need, float(score[-1]))
            done += size
            size *= 4
        yield i, place, score, min(done, len(at))


def neighbours(vectors: DataFrame, is_query: Column, config: Config = Config(), id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows of each query row."""
    c, spark = config, vectors.sparkSession
    given = vectors.select(F.col(id_).cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), F.col(vector).cast("array<double>").alias("v"))
    given = given.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    seen = given.where(F.size("v") <= c.wide).orderBy(F.xxhash64("id", "v"), "id", "v").limit(c.sample).select("v").collect()  # at most sample * wide numbers
    width = max((len(r[0]) for r in seen), default=0)
    sample = np.zeros((len(seen), width))
    for i, r in enumerate(seen):
        sample[i, : len(r[0])] = _integers(np.array(r[0], np.float64), c.scale)
    pivots = choose_pivots(sample[(sample**2).sum(1) < _MOST], c.pivots)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.slice(at, 512)
                lists = part.column("v")
                size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                x = _integers(lists.flatten().to_numpy(zero_copy_only=False), c.scale)
                v = np.zeros((len(part), int(size.max(initial=0))))
                v[np.arange(v.shape[1])[None, :] < size[:, None]] = x
                square = (v * v).sum(1)
                fits = square < _MOST
                exact = lambda r: sum(int(e) * int(e) for e in r)
                lengths = np.array([int(s) if s < 2.0**52 else exact(r) for s, r in zip(square[fits], v[fits], strict=True)], np.int64)
                v, size, part = v[fits], size[fits], part.filter(pa.array(fits))
                d = _to_pivots(v, lengths, pivots)
                near = d.argmin(1)
                packed_ = [r[:n].astype(np.int32).tobytes() for r, n in zip(v, size, strict=True)]
                cols = [part.column("id"), part.column("query"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), pa.array(lengths), pa.array(packed_, pa.binary()), pa.array([r.tobytes() for r in d], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "query", "near", "far", "length", "v", "d"])

    def packed(rows: Iterator[tuple], most: int) -> Iterator[list[tuple]]:
        """Rows (.., .., vector, ..) in lists of at most `most` rows and c.bytes bytes at one width."""
        out, wide = [], 0
        for r in rows:
            wide = max(wide, len(r[2]))
            if out and (len(out) == most or (len(out) + 1) * wide * 4 > c.bytes):
                yield out
                out, wide = [], len(r[2])
            out.append(r)
        if out:
            yield out

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for i, query, length, v, d in zip(*(b.column(k).to_pylist() for k in ("id", "query", "length", "v", "d")), strict=True):
                    yield i, length, np.frombuffer(v, np.int32), np.frombuffer(d, np.float64), query

        for n, part in enumerate(packed(rows(), c.block)):
            asks = np.flatnonzero([r[4] for r in part]).astype(np.int32)
            yield pa.RecordBatch.from_pylist([{"block": (TaskContext.get().partitionId() << 32) + n, "asks": asks.tobytes()} | Block.pack(part)], schema=block_type)

    packs = [("n", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("lengths", pa.binary()), ("vectors", pa.binary()), ("table", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("longest", pa.int64())]
    block_type = pa.schema([("block", pa.int64()), ("asks", pa.binary()), *packs])
    pack_type = pa.schema([("pack", pa.int64()), ("homes", pa.binary()), ("floors", pa.binary()), ("floor", pa.float64()), *packs])

    def asked_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for row in b.to_pylist():
                    home, asks = Block(row), np.frombuffer(row["asks"], np.int32)
                    q = Block(row)
                    q.ids, q.lengths, q.vectors, q.table = q.ids[:, asks], q.lengths[asks], q.vectors[asks], q.table[asks]
                    for i, _, score, _ in best(q, home, np.full(len(asks), -np.inf), asks, c.k):
                        yield None if q.ids[0][i] else int(q.ids[1][i]), int(q.lengths[i]), q.vectors[i], q.table[i], (row["block"], int(asks[i])), float(score[-1]) if len(score) == c.k else -np.inf

        for n, part in enumerate(packed(rows(), c.asked)):
            floors = np.array([r[5] for r in part])
            yield pa.RecordBatch.from_pylist([{"pack": (TaskContext.get().partitionId() << 32) + n, "homes": np.array([r[4] for r in part], np.int64).tobytes(), "floors": floors.tobytes(), "floor": float(floors.min())} | Block.pack(part)], schema=pack_type)

    ddl = lambda *more: ", ".join([*more, Block.SCHEMA])
    parts = max(1, -(-vectors.count() // c.block))
    rows = given.mapInArrow(tidy(table), "id bigint, query boolean, near int, far double, length bigint, v binary, d binary")
    ranged = rows.repartitionByRange(parts, "near", "far", "id").sortWithinPartitions("near", "far", "id").coalesce(parts)
    blocks = stored(ranged.mapInArrow(tidy(blocks_of), ddl("block bigint", "asks binary")), "blocks")
    asked = stored(blocks.where("length(asks) > 0").mapInArrow(tidy(asked_of), ddl("pack bigint", "homes binary", "floors binary", "floor double")), "asked")

    # which packs a block can serve, by bounds alone
    n_blocks, n_packs = blocks.count(), asked.count()
    b_groups, p_groups = (max(1, -(-n // c.judged)) for n in (n_blocks, n_packs))
    salts = max(1, -(-n_packs // c.together))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    group = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def judge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        got = []
        if len(left) and len(right):
            low, high, longest = np.stack(right["low"].tolist()), np.stack(right["high"].tolist()), right["longest"].to_numpy(np.float64)
            names = right["block"].to_numpy()
            for pack, a, b, long, floor in zip(left["pack"], left["low"], left["high"], left["longest"], left["floor"], strict=True):
                apart = np.maximum(np.maximum(low - b[None, :], a[None, :] - high) - 1e-9 * (high + b[None, :]), 0).max(1)
                # d(q, x) is also at most |q| + |x|; apart bounds it from below
                most = (long + longest - apart**2) / 2
                fits = most + 1e-6 * (long + longest) + 1 >= floor - abs(floor) * 1e-9 if np.isfinite(floor) else np.ones(len(most), bool)
                got.append(pd.DataFrame({"pack": pack, "block": names[fits]}))
        return pd.concat(got) if got else pd.DataFrame({"pack": pd.Series(dtype="int64"), "block": pd.Series(dtype="int64")})

    sides = ["low", "high", "longest"]
    body = [x.split()[0] for x in Block.SCHEMA.split(", ") if x.split()[0] not in sides]
    p_side = asked.select(group("pack", p_groups).alias("pg"), every(b_groups).alias("bg"), "pack", "floor", *sides)
    b_side = blocks.select(every(p_groups).alias("pg"), group("block", b_groups).alias("bg"), "block", *sides)
    pairs = p_side.groupBy("pg", "bg").cogroup(b_side.groupBy("pg", "bg")).applyInPandas(judge, "pack bigint, block bigint")
    pairs = stored(pairs.withColumn("salt", group("pack", salts)), "pairs")

    def evaluate(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 6), np.int64)]
        for row in right.to_dict("records"):
            held = Block(row)
            for pack in left.to_dict("records"):
                q, homes, floors = Block(pack), np.frombuffer(pack["homes"], np.int64).reshape(-1, 2), np.frombuffer(pack["floors"], np.float64)
                own = np.where(homes[:, 0] == row["served"], homes[:, 1], -1)
                for i, place, score, _ in best(q, held, floors, own, c.k):
                    rows = np.empty((len(place), 6), np.int64)
                    rows[:, :2], rows[:, 2], rows[:, 3], rows[:, 4], rows[:, 5] = homes[i], q.ids[1][i], held.ids[1][place], held.ids[0][place], score
                    out.append(rows)
        return pd.DataFrame(np.concatenate(out), columns=["home", "place", "query_id", "vec_id", "none", "score"])

    travelling = asked.select("pack", "homes", "floors", *body).join(pairs, "pack")
    serving = blocks.select("block", *body).join(pairs.select("block", F.col("salt").alias("part")).distinct(), "block")
    found = travelling.groupBy("block", "salt").cogroup(serving.select(F.col("block").alias("served"), "part", *body).groupBy("served", "part")).applyInPandas(evaluate, "home bigint, place bigint, query_id bigint, vec_id bigint, none bigint, score bigint")
    found = found.withColumn("vec_id", F.when(F.col("none") == 0, F.col("vec_id")))
    rank = F.row_number().over(Window.partitionBy("home", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= c.k).select("query_id", "rank", "vec_id", "score")
