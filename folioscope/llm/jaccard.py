"""N-gram Jaccard join by vertical partitioning.

The global n-gram order (by hash, n-grams of many texts last) is cut into fragments. Work is done by fragment, never on whole
sets side by side:

1. Equal sets become one; only different sets are joined. Each set is cut by hash range and its pieces travel to their fragments.
2. A fragment counts in how many sets each n-gram occurs and returns to each set its n-grams that others have. A set with less
   than 80 % of such n-grams (for the default threshold) links with nothing; most texts end here.
3. In the order of rising count, prefixes of the remaining sets meet: candidates share an n-gram of the longer one's probing
   prefix and the shorter one's index prefix, and pass the size and position bounds of exact prefix filtering.
4. Partial overlaps of a candidate pair are counted in each fragment and summed; the sum decides.

Only components are asked for, so copies are not expanded: first each set meets, for each n-gram of its prefix, the one set
with the least share of own n-grams; the components so found are then joined by the candidates that cross components. This
loses no component: two linked sets are either in one component already or are a candidate of the second turn.

N-grams that a bounded sample shows to be very frequent go straight from a chunk to their set, as known to be shared and
last in order, so one passage in a third of all rows fills no fragment. The list decides order and way only, not results.

Null, empty and word-free texts have no n-gram and link with nothing; fewer than n words are one n-gram. Rows that share an
id are rows of their own (and may differ in component); null ids are passed over for the least id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Words, byte_texts, chunks, discard, mix, ngram_hashes, release, stored, tidy
from .graph import components


@dataclass(frozen=True)
class Config:
    n: int = 5
    #: Pairs link when intersection / union >= num / den.
    num: int = 4
    den: int = 5
    #: One row in so many is looked at for frequent n-grams; listed are at most `hot`, or two for each fragment if these are more.
    look: int = 64
    hot: int = 4096
    #: Pieces into which a set is cut for counting a pair's overlap.
    pieces: int = 8


_DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("k1", "<i8"), ("k2", "<i8"), ("n", "<i4")])
_INFO = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("n", "<i4")])
#: Kinds of pieces: n-grams on the way to their fragment; rows, sets, frequent n-grams and shared n-grams on the way home.
_GRAMS, _ROWS, _SETS, _OFTEN, _SHARED = range(5)
_MANY = 65535


def sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct n-grams of each text, ascending, one text after the other; how many each has."""
    w = Words(texts, lower=True)
    h = w.hashes()
    grams = ngram_hashes(h, n)
    out, sizes = [], np.zeros(len(texts), np.int64)
    for i, (s, e) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
        if e - s >= n:
            g = np.unique(grams[s : e - n + 1])
        elif e > s:
            g = ngram_hashes(h[s:e], e - s)
        else:
            continue
        out.append(g)
        sizes[i] = len(g)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), sizes


def _digests(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 bits for each set, whatever its order."""
    out = np.zeros((len(sizes), 2), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        at = (np.cumsum(sizes) - sizes)[full]
        out[full, 0] = mix(np.add.reduceat(mix(h + np.uint64(1)), at))
        out[full, 1] = mix(np.add.reduceat(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at) + sizes[full].astype(np.uint64))
    return out.view(np.int64)


def _frequent(docs: DataFrame, c: Config, most: int) -> np.ndarray:
    """n-grams that stand out in a sample, `most` at most: any other has a smaller share of all than 1 / most, so it overloads no fragment."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for part in chunks(byte_texts(b.column("text"))):
                k, n = np.unique(sets(list(dict.fromkeys(part)), c.n)[0].view(np.int64), return_counts=True)
                seen.update(dict(zip(k[n > 1].tolist(), n[n > 1].tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], names=["key", "n"])

    part = docs.where(F.pmod(F.xxhash64("text"), F.lit(c.look)) == 0).select("text").mapInArrow(tidy(count), "key bigint, n bigint")
    rows = part.groupBy("key").agg(F.sum("n").alias("n")).where("n >= 16").orderBy(F.desc("n"), "key").limit(most).collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64))


def _pack(ids: np.ndarray, h: np.ndarray, owner: np.ndarray, df: np.ndarray | None = None) -> bytes:
    """Some n-grams of sets, as one string of columns: 96 bits and a length for each set, hashes, counts. owner: the set of each n-gram, ascending."""
    new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    own, length = owner[new], np.diff(np.append(new, len(owner)))
    width = next(k for k in (1, 2, 4) if int(length.max()) < 1 << 8 * k)
    columns = [np.array([len(own), len(h), width], "<i4"), ids[own, 0].astype("<i8"), (ids[own, 1] & 0xFFFFFFFF).astype("<u4"), length.astype(f"<u{width}"), h.astype("<u8")]
    return b"".join(c.tobytes() for c in [*columns, *([] if df is None else [df.astype("<u2")])])


def _unpack(data: bytes, counted: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """Ids (k1 and the low half of k2), lengths, hashes and counts."""
    sets_, total, width = np.frombuffer(data, "<i4", 3).tolist()
    at, out = 12, []
    for kind, n in (("<i8", sets_), ("<u4", sets_), (f"<u{width}", sets_), ("<u8", total), ("<u2", total if counted else 0)):
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    k1, k2, length, h, df = out
    return np.stack([k1, k2.astype(np.int64)], 1), length.astype(np.int64), h, df if counted else None


def _joined(pieces: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """Ids of the pieces' sets, and for each n-gram its set, hash and count."""
    ids, length, h = (np.concatenate([p[k] for p in pieces]) for k in range(3))
    return ids, np.repeat(np.arange(len(length)), length), h, np.concatenate([p[3] for p in pieces]) if pieces[0][3] is not None else None


def _by(home: np.ndarray, n: int, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Columns dealt by home, in the order they have."""
    order = np.argsort(home, kind="stable")
    cut = np.searchsorted(home[order], np.arange(n + 1))
    columns = [c[order] for c in columns]
    for b in np.flatnonzero(np.diff(cut)).tolist():
        yield b, [c[cut[b] : cut[b + 1]] for c in columns]


def _record_table(docs: DataFrame, id_: str, text: str, c: Config) -> DataFrame:
    """kind 1: a row of docs (id, k1, k2, n). kind 0: a set that may link (sid, k1, k2, n, own n-grams, shared n-grams in order)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4, (parts - 1).bit_length())
    frags = 1 << bits
    shift = np.uint64(64 - bits)
    base = docs.select(F.col(id_).cast("bigint").alias("id"), F.col(text).alias("text"))
    hot = _frequent(base, c, max(c.hot, 2 * frags))

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(b.column("id").to_pylist(), byte_texts(b.column("text")), strict=True))
            for part in chunks(rows, size=lambda r: len(r[1])):
                texts = list(dict.fromkeys(t for _, t in part))
                number = {t: i for i, t in enumerate(texts)}
                h, sizes = sets(texts, c.n)
                ids = _digests(h, sizes)
                docrows = np.array([(i or 0, i is None, *ids[k], sizes[k]) for i, k in ((i, number[t]) for i, t in part)], _DOC)
                out = [(int(docrows["k1"][0] % frags), _ROWS, docrows.tobytes())]
                _, once = np.unique(ids, axis=0, return_index=True)
                once = once[sizes[once] > 0]
                keep = np.zeros(len(sizes), bool)
                keep[once] = True
                info = np.empty(len(once), _INFO)
                info["k1"], info["k2"], info["n"] = ids[once, 0], ids[once, 1], sizes[once]
                out += [(f, _SETS, own.tobytes()) for f, (own,) in _by(info["k1"] % frags, frags, info)]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                use = keep[owner]
                h, owner = h[use], owner[use]
                often = np.isin(h, hot) if len(hot) else np.zeros(len(h), bool)
                if often.any():
                    known, whose = h[often], owner[often]
                    out += [(f, _OFTEN, _pack(ids, x, o, np.full(len(x), _MANY))) for f, (x, o) in _by(ids[whose, 0] % frags, frags, known, whose)]
                    h, owner = h[~often], owner[~often]
                out += [(f, _GRAMS, _pack(ids, x, o)) for f, (x, o) in _by((h >> shift).astype(np.int64), frags, h, owner)]
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.binary())], names=["frag", "kind", "data"])

    def fragment(pdf: pd.DataFrame) -> pd.DataFrame:
        """Counts the sets of each n-gram of one fragment; what others share goes home to its set, by bucket of sets."""
        release()
        f = int(pdf["frag"].iloc[0])
        out = [(f, k, d) for k, d in zip(pdf["kind"], pdf["data"], strict=True) if k != _GRAMS]
        pieces = [_unpack(d) for k, d in zip(pdf["kind"], pdf["data"], strict=True) if k == _GRAMS]
        if pieces:
            ids, owner, h, _ = _joined(pieces)
            order = np.lexsort((ids[:, 1], ids[:, 0]))
            same = np.concatenate([[False], (ids[order][1:] == ids[order][:-1]).all(1)])
            fresh = np.ones(len(ids), bool)
            fresh[order[same]] = False  # the same set from another chunk
            use = fresh[owner]
            h, owner = h[use], owner[use]
            _, back, count = np.unique(h, return_inverse=True, return_counts=True)
            df = np.minimum(count[back], _MANY)
            shared = df > 1
            h, owner, df = h[shared], owner[shared], df[shared]
            out += [(b, _SHARED, _pack(ids, x, o, d)) for b, (x, o, d) in _by(ids[owner, 0] % frags, frags, h, owner, df)]
        return pd.DataFrame({"bucket": np.array([o[0] for o in out], np.int64), "kind": np.array([o[1] for o in out], np.int32), "data": [o[2] for o in out]})

    def home(pdf: pd.DataFrame) -> pd.DataFrame:
        release()
        bucket = int(pdf["bucket"].iloc[0])
        by: list[list[bytes]] = [[] for _ in range(5)]
        for k, d in zip(pdf["kind"], pdf["data"], strict=True):
            by[k].append(d)
        d = np.frombuffer(b"".join(by[_ROWS]), _DOC)
        out = pd.DataFrame({"kind": np.ones(len(d), np.int32), "id": pd.array(d["id"], "Int64"), "sid": np.int64(0), "k1": d["k1"], "k2": d["k2"], "n": d["n"], "own": np.int32(0), "shared": None})
        out.loc[d["null"] == 1, "id"] = pd.NA
        got = [_unpack(x, True) for k in (_OFTEN, _SHARED) for x in by[k]]
        records = []
        if got:
            info = np.unique(np.frombuffer(b"".join(by[_SETS]), _INFO))
            ids, owner, h, df = _joined(got)
            both = np.concatenate([np.stack([info["k1"], info["k2"] & 0xFFFFFFFF], 1), ids])
            _, number = np.unique(both, axis=0, return_inverse=True)
            number = number.reshape(-1)
            known = np.empty(number.max() + 1, np.int64)
            known[number[: len(info)]] = np.arange(len(info))
            owner = known[number[len(info) :]][owner]
            order = np.lexsort((h, df, owner))
            h, df, owner = h[order], df[order], owner[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])  # frequent ones come from several chunks
            h, owner = h[new], owner[new]
            cut = np.searchsorted(owner, np.arange(len(info) + 1))
            have = np.diff(cut)
            for i in np.flatnonzero((have > 0) & (have * c.den >= info["n"].astype(np.int64) * c.num)).tolist():
                n, k = int(info["n"][i]), int(have[i])
                records.append((0, pd.NA, bucket << 40 | i, info["k1"][i], info["k2"][i], n, n - k, h[cut[i] : cut[i + 1]].view(np.int64)))
        if records:
            more = pd.DataFrame(records, columns=out.columns)
            more["id"] = more["id"].astype("Int64")
            out = pd.concat([out, more]) if len(out) else more
        return out

    first = base.mapInArrow(tidy(scatter), "frag bigint, kind int, data binary").groupBy("frag").applyInPandas(fragment, "bucket bigint, kind int, data binary")
    return first.groupBy("bucket").applyInPandas(home, "kind int, id bigint, sid bigint, k1 bigint, k2 bigint, n int, own int, shared array<bigint>")


def _ceil(x, den: int):
    return F.floor((x + den - 1) / F.lit(den)).cast("int")


def _links(pairs: DataFrame, sets_: DataFrame, c: Config) -> DataFrame:
    """Of pairs (x, y): those that link. Partial overlaps by fragment of the order, summed."""
    seg = sets_.select("sid", "n", F.explode(F.transform(F.sequence(F.lit(0), F.lit(c.pieces - 1)), lambda i: F.struct(i.alias("f"), F.filter("shared", lambda v: F.pmod(v, F.lit(c.pieces)) == i).alias("part")))).alias("s")).select("sid", "n", "s.f", "s.part").where(F.size("part") > 0)
    x = pairs.join(seg.select(F.col("sid").alias("x"), F.col("n").alias("nx"), "f", F.col("part").alias("px")), "x")
    both = x.join(seg.select(F.col("sid").alias("y"), F.col("n").alias("ny"), "f", F.col("part").alias("py")), ["y", "f"])
    partial = both.select("x", "y", "nx", "ny", F.size(F.array_intersect("px", "py")).alias("part"))
    return partial.groupBy("x", "y", "nx", "ny").agg(F.sum("part").alias("both")).where((c.num + c.den) * F.col("both") >= c.num * (F.col("nx") + F.col("ny"))).select(F.col("x").alias("a"), F.col("y").alias("b"))


def cluster(docs: DataFrame, config: Config = Config(), id_: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of docs: id, n (set size) and component, the least id reachable by links, itself included."""
    c = config
    table = stored(_record_table(docs, id_, text, c), "ngram-sets")
    rows = table.where("kind = 1").select("id", "k1", "k2", "n")
    sets_ = table.where("kind = 0").select("sid", "n", "own", "shared")
    total = c.num + c.den
    probe = F.col("n") - _ceil(F.col("n") * c.num, c.den) + 1
    index = F.col("n") - _ceil(F.col("n") * 2 * c.num, total) + 1
    posts = sets_.select("sid", "n", "own", F.size("shared").alias("have"), probe.alias("probe"), index.alias("index"), F.posexplode(F.slice("shared", F.lit(1), F.greatest(F.lit(0), probe - F.col("own")))).alias("j", "g")).withColumn("at", F.col("own") + F.col("j"))
    posts = stored(posts.select("sid", "n", "have", "own", "at", (F.col("at") < F.col("index")).alias("indexed"), "g"), "postings")
    need = lambda a, b: _ceil(c.num * (a + b), total)  # noqa: E731  overlap that links sets of these sizes

    # First turn: the set with the least share of own n-grams leads each list.
    lead = posts.groupBy("g").agg(F.count("*").alias("of"), F.min(F.struct((F.col("own") / F.col("n")).alias("r"), "sid", "n", "have")).alias("l")).where("of > 1").select(F.xxhash64("g").alias("_h"), F.col("g").alias("_g"), "l")
    p = posts.withColumn("_h", F.xxhash64("g"))
    pairs = p.join(lead, (p["_h"] == lead["_h"]) & (p["g"] == lead["_g"]) & (p["sid"] != lead["l.sid"]) & (need(p["n"], lead["l.n"]) <= F.least(p["have"], lead["l.have"]))).select(F.col("sid").alias("x"), F.col("l.sid").alias("y")).distinct()
    links = stored(_links(pairs, sets_, c), "links")
    # A label shared by linked sets is enough to pass over pairs; it needn't be a whole component. Joined by a form of the key, so that AQE can split a hub.
    one = links.groupBy("a").agg(F.min("b").alias("b"))
    up = one.select(F.xxhash64("a").alias("_h"), F.col("a").alias("_b"), F.col("b").alias("_c"))
    down = one.withColumn("_h", F.xxhash64("b"))
    two = down.join(up, (down["_h"] == up["_h"]) & (down["b"] == up["_b"]), "left").select(F.col("a").alias("sid"), F.coalesce("_c", "b").alias("component"))

    # Second turn: candidates whose ends have different labels.
    known = stored(posts.join(two, "sid", "left").withColumn("component", F.coalesce("component", "sid")), "postings")
    mixed = known.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select(F.col("g"), F.xxhash64("g").alias("_h"))
    x = known.withColumn("_h", F.xxhash64("g")).join(mixed, ["_h", "g"], "left_semi")
    y = x.where("indexed").select(*(F.col(k).alias(f"y_{k}") for k in ("sid", "n", "have", "at", "g", "component")))
    bound = need(F.col("n"), F.col("y_n"))
    on = (F.col("g") == F.col("y_g")) & (F.col("component") != F.col("y_component")) & ((F.col("y_n") < F.col("n")) | ((F.col("y_n") == F.col("n")) & (F.col("y_sid") < F.col("sid")))) & (F.col("y_n") * c.den >= F.col("n") * c.num)
    on = on & (bound <= F.least(F.col("have"), F.col("y_have"))) & (bound <= F.least(F.col("n") - F.col("at"), F.col("y_n") - F.col("y_at")))
    more = x.join(y, on).select(F.col("sid").alias("x"), F.col("y_sid").alias("y")).distinct()
    labels = stored(components(links.union(_links(more, sets_, c))), "labels")
    discard(posts, known, links)

    # Back to rows: equal sets are one; n = 0 stays alone.
    named = table.where("kind = 0").select("sid", "k1", "k2").join(labels.select(F.col("node").alias("sid"), "component"), "sid").select("k1", "k2", "component")
    least = rows.where("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("least"))
    ids = named.join(least, ["k1", "k2"])
    best = ids.groupBy("component").agg(F.min("least").alias("least")).select(F.xxhash64("component").alias("_h"), F.col("component").alias("_c"), F.col("least").alias("best"))
    own = ids.withColumn("_h", F.xxhash64("component"))
    own = own.join(best, (own["_h"] == best["_h"]) & (own["component"] == best["_c"])).select("k1", "k2", "best")
    final = least.join(own, ["k1", "k2"], "left").select(F.xxhash64("k1", "k2").alias("_h"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.coalesce("best", "least").alias("least"))
    keyed = rows.withColumn("_h", F.when(F.col("n") > 0, F.xxhash64("k1", "k2")).otherwise(F.xxhash64("id")))
    out = keyed.join(final, (keyed["_h"] == final["_h"]) & (keyed["k1"] == final["_k1"]) & (keyed["k2"] == final["_k2"]) & (keyed["n"] > 0), "left")
    return out.select("id", F.col("n").cast("bigint").alias("n"), F.coalesce("least", "id").alias("component"))
