"""Toxicity: a bidirectional GRU with attention pooling over character and word inputs, trained in numpy.

A token is a maximal run of letters, digits and non-ASCII bytes, lower-cased (A-Z). Its input is a learned vector of its
hash bucket (words) and the mean of learned vectors of its byte trigrams (characters); nothing else goes into a score. A text is cut into windows of `window` tokens that overlap by a quarter, the last one moved back to the end, so
that every token is scored; a text's score is its highest window's. Null, empty and token-free texts are one empty window.
Training takes the window that now scores highest of each text (multiple-instance learning).

Memory: model of fixed size; texts in chunks of about 2 MB (a longer text is a chunk of its own). No shuffle: scoring is one
pass, so skewed sources or copies do not matter and a lost executor only repeats its tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ROWS, Words, byte_texts, chunks, release, tidy

_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass(frozen=True)
class Config:
    #: Rows of labels that training may take at most; of more, those of least hash.
    sample: int = 4000
    #: Bytes that their texts may have together.
    sample_bytes: int = 64 << 20
    word_buckets: int = 1 << 14
    char_buckets: int = 1 << 12
    word_dim: int = 8
    char_dim: int = 8
    hidden: int = 8
    window: int = 48
    #: Passes over the sample, and steps at least, which make small samples pass more often.
    epochs: int = 6
    steps: int = 400
    rate: float = 0.01
    #: What a row of label 1 counts for in training; of 1, 1.5 and 2 the one with fewest errors on labelled rows that are neither in the sample nor held out.
    weight: float = 1.5
    threshold: float = 0.3
    seed: int = 7


@dataclass
class Model:
    config: Config
    p: dict[str, np.ndarray] = field(default_factory=dict)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


class Tokens:
    """Tokens of a chunk of texts, each as an index of its distinct words, cut into windows."""

    def __init__(self, texts: list[bytes], c: Config):
        w = Words(texts, _GAP, lower=True)
        self.hash, at, self.word = np.unique(w.hashes(), return_index=True, return_inverse=True)
        self.bucket = (self.hash % np.uint64(c.word_buckets)).astype(np.int64)
        mv = w.buf.tobytes()
        # each distinct word between one space and two, so that none of its trigrams reaches into the next
        spelt = np.frombuffer(b" " + b"".join(mv[s:e] + b"   " for s, e in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)) + b"  ", np.uint8).astype(np.uint32)
        self.length = (w.end - w.start)[at]
        first = np.cumsum(self.length + 3) - self.length - 3
        self.at = np.cumsum(self.length + 1) - self.length - 1  # of each distinct word's first trigram
        where = np.repeat(first - self.at, self.length + 1) + np.arange(int((self.length + 1).sum()))
        code = (spelt[where] * np.uint32(65599) ^ spelt[where + 1] * np.uint32(2654435761) ^ spelt[where + 2] * np.uint32(40503 * 257)) >> np.uint32(7)
        self.code = (code % np.uint32(c.char_buckets)).astype(np.int64)
        n, half = w.counts, c.window * 3 // 4
        count = 1 + np.maximum(0, -(-(n - c.window) // half))
        self.text = np.repeat(np.arange(len(texts)), count)
        k = np.arange(len(self.text)) - np.repeat(np.cumsum(count) - count, count)
        self.lead = np.cumsum(count) - count
        self.size = np.minimum(n, c.window)[self.text]
        self.begin = w.first[:-1][self.text] + np.minimum(k * half, np.maximum(0, n - c.window)[self.text])


def _inputs(m: Model, t: Tokens) -> np.ndarray:
    """Of each distinct word; the last row is padding."""
    p, n = m.p, len(t.hash)
    x = np.zeros((n + 1, m.config.word_dim + m.config.char_dim), np.float32)
    if n:
        x[:n, : m.config.word_dim] = p["words"][t.bucket]
        x[:n, m.config.word_dim :] = np.add.reduceat(p["chars"][t.code], t.at, axis=0)[: n] / (t.length + 1)[:, None]
    return x


def _grid(t: Tokens, which: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct-word index by step and window, and whether there is a token."""
    step = np.arange(window)[:, None]
    there = step < t.size[which][None, :]
    if not len(t.word):
        return np.zeros(there.shape, np.int64), there
    at = np.minimum(t.begin[which][None, :] + step, len(t.word) - 1)
    return np.where(there, t.word[at], len(t.hash)), there


def _forward(m: Model, x: np.ndarray, grid: np.ndarray, there: np.ndarray, keep: bool = False):
    """Scores of windows as logits; with keep, all that the gradient needs."""
    p, h = m.p, m.config.hidden
    steps, size = grid.shape
    states = np.zeros((steps, size, 2 * h), np.float32)
    saved = []
    for d, name in enumerate(("f", "b")):
        a = x @ p["in_" + name] + p["bias_" + name]
        u, state = p["rec_" + name], np.zeros((size, h), np.float32)
        trail = []
        for s in range(steps) if d == 0 else range(steps - 1, -1, -1):
            z, rec = a[grid[s]], state @ u
            gates = _sigmoid(z[:, : 2 * h] + rec[:, : 2 * h])
            cand = np.tanh(z[:, 2 * h :] + gates[:, :h] * rec[:, 2 * h :])
            now = cand + gates[:, h:] * (state - cand)
            now = np.where(there[s][:, None], now, state)
            if keep:
                trail.append((s, state, gates, cand, rec[:, 2 * h :]))
            states[s, :, d * h : d * h + h] = state = now
        saved.append(trail)
    e = np.tanh(states.reshape(-1, 2 * h) @ p["att_w"] + p["att_b"])
    weight = np.exp((e @ p["att_v"]).reshape(steps, size)) * there  # |e| <= 1, so this can't overflow
    weight /= np.maximum(weight.sum(0), 1e-9)
    pooled = (weight[:, :, None] * states).sum(0)
    e = e.reshape(steps, size, -1)
    logit = pooled @ p["out_w"] + p["out_b"]
    return (logit, (states, saved, e, weight, pooled)) if keep else logit


def _gradient(m: Model, t: Tokens, x: np.ndarray, grid, there, rest, dlogit) -> dict[str, np.ndarray]:
    p, h, c = m.p, m.config.hidden, m.config
    states, saved, e, weight, pooled = rest
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["out_w"], g["out_b"] = pooled.T @ dlogit, dlogit.sum(keepdims=True)
    dpool = dlogit[:, None] * p["out_w"]
    dstates = weight[:, :, None] * dpool
    dweight = np.einsum("sbh,bh->sb", states, dpool)
    dscore = weight * (dweight - (weight * dweight).sum(0))
    g["att_v"] = np.einsum("sb,sbk->k", dscore, e)
    de = dscore[:, :, None] * p["att_v"] * (1 - e * e)
    g["att_w"], g["att_b"] = np.einsum("sbh,sbk->hk", states, de), de.sum((0, 1))
    dstates += de @ p["att_w"].T
    dx = np.zeros_like(x)
    for d, name in enumerate(("f", "b")):
        u, back = p["rec_" + name], np.zeros((grid.shape[1], h), np.float32)
        da = np.zeros((len(x), 3 * h), np.float32)
        for s, state, gates, cand, rec in reversed(saved[d]):
            on = there[s][:, None]
            dnow = back + dstates[s, :, d * h : d * h + h]
            r, z = gates[:, :h], gates[:, h:]
            dcand = dnow * (1 - z) * (1 - cand * cand)
            dz = dnow * (state - cand) * z * (1 - z)
            dr = dcand * rec * r * (1 - r)
            dpre = np.concatenate([dr, dz, dcand], 1) * on
            drec = np.concatenate([dr, dz, dcand * r], 1) * on
            np.add.at(da, grid[s], dpre)
            g["rec_" + name] += state.T @ drec
            back = np.where(on, dnow * z + drec @ u.T, dnow)
        da[-1] = 0
        g["bias_" + name] = da.sum(0)
        g["in_" + name] = x.T @ da
        dx += da @ p["in_" + name].T
    n = len(t.hash)
    if n:
        np.add.at(g["words"], t.bucket, dx[:n, : c.word_dim])
        part = np.zeros((len(t.code), c.char_dim), np.float32)
        own = np.minimum(np.repeat(np.arange(n), t.length + 1), n - 1)
        part[: len(own)] = (dx[:n, c.word_dim :] / (t.length + 1)[:, None])[own][: len(part)]
        np.add.at(g["chars"], t.code, part)
    return g


def train(texts: list[bytes], toxic: list[int], config: Config = Config()) -> Model:
    """Fits a model; without both labels, one that scores everything by the share of label 1."""
    c, rng = config, np.random.default_rng(config.seed)
    y = np.asarray(toxic, np.float32)
    m = Model(c)
    size, h = c.word_dim + c.char_dim, c.hidden
    shapes = {"words": (c.word_buckets, c.word_dim), "chars": (c.char_buckets, c.char_dim), "att_w": (2 * h, h), "att_v": (h,), "out_w": (2 * h,)} | {k + d: s for d in "fb" for k, s in (("in_", (size, 3 * h)), ("rec_", (h, 3 * h)))}
    m.p = {k: rng.normal(0, 0.1 if k in ("words", "chars") else 0.3, s).astype(np.float32) for k, s in shapes.items()}
    m.p["words"][:] *= 0.1  # words never seen say little
    m.p |= {"bias_f": np.zeros(3 * h, np.float32), "bias_b": np.zeros(3 * h, np.float32), "att_b": np.zeros(h, np.float32), "out_b": np.zeros(1, np.float32)}
    prior = float(np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4))
    m.p["out_b"][:] = np.log(prior / (1 - prior))
    if not len(y) or y.min() == y.max():
        m.p["out_w"][:] = 0
        return m
    one, two = ({k: np.zeros_like(v) for k, v in m.p.items()} for _ in range(2))
    turn = 0
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    groups = [list(x) for x in chunks(order, size=lambda i: len(texts[i]) + CHUNK_TRAIN // 32, limit=CHUNK_TRAIN)]
    epochs = max(c.epochs, -(-c.steps // len(groups)))
    for epoch in range(epochs):
        for g in rng.permutation(len(groups)):
            own = groups[g]
            t = Tokens([texts[i] for i in own], c)
            x = _inputs(m, t)
            every = np.concatenate([_forward(m, x, *_grid(t, np.arange(s, min(s + 2048, len(t.text))), c.window)) for s in range(0, len(t.text), 2048)])
            best = np.lexsort((-every, t.text))[t.lead]
            grid, there = _grid(t, best, c.window)
            logit, rest = _forward(m, x, grid, there, keep=True)
            dlogit = ((_sigmoid(logit) - y[own]) * np.where(y[own] > 0, c.weight, 1) / len(own)).astype(np.float32)
            turn += 1
            rate = c.rate * (1 - epoch / epochs)
            for k, d in _gradient(m, t, x, grid, there, rest, dlogit).items():
                one[k] += 0.1 * (d - one[k])
                two[k] += 0.001 * (d * d - two[k])
                m.p[k] -= (rate * (one[k] / (1 - 0.9**turn)) / (np.sqrt(two[k] / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)
    return m


#: Bytes of texts in a training step, and of texts scored at once, at most, unless one text has more.
CHUNK_TRAIN, CHUNK_SCORE = 1 << 17, 1 << 19


def scores(m: Model, texts: list[bytes]) -> np.ndarray:
    """Of each text, from 0 to 1."""
    t = Tokens(texts, m.config)
    x = _inputs(m, t)
    every = np.concatenate([_forward(m, x, *_grid(t, np.arange(s, min(s + 2048, len(t.text))), m.config.window)) for s in range(0, len(t.text), 2048)])
    return _sigmoid(np.maximum.reduceat(every, t.lead).astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, config: Config = Config()) -> Model:
    """Learns from at most config.sample labelled rows that `usable` (over doc_id) admits; rows without text or label don't count.

    A doc_id of several rows gives as many examples. The driver holds the sample, of at most config.sample rows and
    config.sample_bytes bytes, whatever the size of the tables: of rows in the order of their hash (ties by doc_id, label and
    text's hash), those that fit; a longer text leaves its place to the next. The order doesn't depend on how rows are stored.
    """
    pick = F.xxhash64("doc_id", F.lit(config.seed))
    order = ["_pick", "doc_id", "toxic", "_text"]
    texts = docs.where(F.col("text").isNotNull() & usable).select("doc_id", "text")
    given = labels.where(F.col("toxic").isin(0, 1) & usable).select("doc_id", F.col("toxic").cast("int").alias("toxic"), pick.alias("_pick"))
    # labels without a text take no place in the sample; only ids are shuffled for this
    first = given.join(texts.select("doc_id"), "doc_id", "left_semi").orderBy("_pick", "doc_id", "toxic").limit(config.sample)
    found = texts.select("doc_id", F.sha2("text", 256).alias("_text"), F.octet_length("text").cast("bigint").alias("_bytes")).join(first, "doc_id").orderBy(*order).limit(config.sample)
    chosen, room = [], config.sample_bytes
    for r in found.collect():  # no texts yet, at most config.sample rows
        if r["_bytes"] <= room:
            chosen.append((r["doc_id"], r["toxic"], r["_pick"], r["_text"]))
            room -= r["_bytes"]
    if not chosen:
        return train([], [], config)
    ids = docs.sparkSession.createDataFrame({(i, x) for i, _, _, x in chosen}, texts.select("doc_id", F.lit("").alias("_text")).schema)
    by = {(r.doc_id, r["_text"]): r.text.encode() for r in texts.withColumn("_text", F.sha2("text", 256)).join(F.broadcast(ids), ["doc_id", "_text"]).dropDuplicates(["doc_id", "_text"]).collect()}
    model = train([by[i, x] for i, _, _, x in chosen], [y for _, y, _, _ in chosen], config)
    release()  # the driver goes on, too
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with `score` and `predicted` (replacing columns of these names): one pass, without a shuffle."""
    base = docs.drop("score", "predicted")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in base.schema)}, score double, predicted int"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
            got = np.concatenate([scores(m, part) for part in chunks(byte_texts(b.column(text)), limit=CHUNK_SCORE)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got), pa.array((got >= m.config.threshold).astype(np.int32))], names=[*b.schema.names, "score", "predicted"])

    return base.mapInArrow(tidy(run), schema)
