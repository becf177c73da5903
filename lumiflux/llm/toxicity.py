"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Inputs. A word's vector joins a word embedding (hashed) and the mean of the embeddings of its character 3- and 4-grams
(hashed, with word ends marked), so unseen forms of known stems score too. It goes nowhere but into the two recurrences;
attention weighs their states, word by word, and the output sees the pooled states alone. Nothing is set from labels but
by descent. Windows of WINDOW words at every STRIDE words cover a whole text and all are scored; a document's score is
that of its worst window.

Training takes at most SAMPLE labelled documents of each class, first by md5(doc_id), and the first SAMPLE_CHARS
characters of each: documented bounds, the only ones. It runs as one task of an executor, and its result, of a fixed size,
is broadcast. Labels hang on documents, not windows, so the loss is taken on softmax-pooled window scores. Rows with
crc32(doc_id) mod FOLDS = 0 are never learned from; labels, lang, source and doc_id are no inputs of a score.

Defined results: an empty or null text scores 0; without labels of both classes every text scores the share of
label 1 (0 without labels); of repeated labels the larger counts, null ones do not; repeated documents score alike;
an empty table gives an empty table; other columns are ignored (keep() carries them along).
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumiflux.llm.common import sliced

WINDOW, STRIDE, FOLDS = 32, 24, 5
SAMPLE, SAMPLE_CHARS = 2000, 8000
HIDDEN, ATT, DIM_W, DIM_C = 12, 12, 12, 12
CHAR_BITS = 13
WORD_BUCKETS, CHAR_BUCKETS = 1 << 14, 1 << CHAR_BITS
STEPS, DOCS, RATE, SEED = 400, 32, 0.01, 7
#: Share of a batch's distinct words left out in a step, and decay of the weights a step (in units of the rate). Words of
#: fewer than HELD sample documents are left out always: of them a small sample would only learn whose they are.
DROP, DECAY, HELD = 0.6, 0.01, 6
#: Both classes are shown alike; scores are then moved by this part of the way to the share of label 1 among all labels.
SHIFT = 1.0
#: Labels are wrong now and then: what is learned is this share of 1 for each class.
TARGETS = (0.01, 0.98)
CACHED = 80_000
#: For bytes.translate(): ASCII letters in lower case, digits, and all bytes from 0x80 make words; the rest separates.
FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
MIX = np.array([1, 257, 65_537, 16_777_259], np.uint32)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words; buckets of their character 3- and 4-grams, word after word; the number of these of each."""
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2  # marked < and > at the ends
    a = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint32)
    left = np.repeat(np.cumsum(lens), lens) - np.arange(len(a))  # bytes to the word's end, this one included
    h = np.zeros((len(a), 2), np.uint32)
    for k in range(4):
        h[: len(a) - k, 1] += a[k:] * MIX[k]
        if k == 2:
            h[:, 0] = h[:, 1]
    h = (h * np.uint32(2_654_435_761)) >> np.uint32(32 - CHAR_BITS)
    grams = h[np.stack([left >= 3, left >= 4], axis=1)].astype(np.int64)
    wb = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % WORD_BUCKETS
    return wb, grams, np.maximum(lens - 2, 0) + np.maximum(lens - 3, 0)


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of so many words, laid end to end: places (windows x WINDOW), which of them are real, the text of each window."""
    per = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    of = np.repeat(np.arange(len(counts)), per)
    first = np.cumsum(per) - per
    start = (np.arange(len(of)) - first[of]) * STRIDE
    inside = start[:, None] + np.arange(WINDOW)
    real = inside < counts[of][:, None]
    return np.where(real, inside + (np.cumsum(counts) - counts)[of][:, None], 0), real, of


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def fresh() -> dict[str, np.ndarray]:
    r = np.random.default_rng(SEED)
    d, h = DIM_W + DIM_C, HIDDEN
    shapes = {"Ew": (WORD_BUCKETS, DIM_W), "Ec": (CHAR_BUCKETS, DIM_C), "Wf": (d, 3 * h), "Wb": (d, 3 * h), "cf": (3 * h,), "cb": (3 * h,), "Uf": (h, 3 * h), "Ub": (h, 3 * h), "A": (2 * h, ATT), "a": (ATT,), "v": (ATT,), "o": (2 * h,), "b": (1,)}
    scale = {"Ew": 0.3, "Ec": 0.6, "cf": 0.0, "cb": 0.0, "a": 0.0, "b": 0.0}
    return {k: (r.standard_normal(s) * scale.get(k, 1 / np.sqrt(s[0]))).astype(np.float32) for k, s in shapes.items()}


def recur(x: np.ndarray, real: np.ndarray, u: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """One direction: x is steps x windows x 3H (projected inputs: update, reset, candidate). States after every step."""
    t, n, _ = x.shape
    h, h2 = HIDDEN, 2 * HIDDEN
    state, out, tape = np.zeros((n, h), np.float32), np.empty((t, n, h), np.float32), []
    for i in range(t):
        g = state @ u
        zr = sigmoid(x[i, :, :h2] + g[:, :h2])
        cand = np.tanh(x[i, :, h2:] + zr[:, h:] * g[:, h2:])
        after = (cand + zr[:, :h] * (state - cand)) * real[i]
        if keep:
            tape.append((state, zr, cand, g[:, h2:]))
        out[i] = state = after
    return out, tape


def unroll(d_out: np.ndarray, real: np.ndarray, u: np.ndarray, tape: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of u."""
    t, n, h = d_out.shape
    dx, du, back = np.empty((t, n, 3 * h), np.float32), np.zeros_like(u), np.zeros((n, h), np.float32)
    for i in range(t - 1, -1, -1):
        state, zr, cand, gc = tape[i]
        z, r = zr[:, :h], zr[:, h:]
        d = (d_out[i] + back) * real[i]
        dc = d * (1 - z) * (1 - cand * cand)
        dx[i, :, :h] = d * (state - cand) * z * (1 - z)
        dx[i, :, h : 2 * h] = dc * gc * r * (1 - r)
        dx[i, :, 2 * h :] = dc
        dg = dx[i].copy()
        dg[:, 2 * h :] = dc * r
        du += state.T @ dg
        back = d * z + dg @ u.T
    return dx, du


def forward(p: dict, x: np.ndarray, real: np.ndarray, keep: bool = False):
    """Word vectors (steps x windows x dimensions) to window logits: the states of both directions, pooled by attention."""
    m = real.T[:, :, None].astype(np.float32)
    hf, tf = recur(x @ p["Wf"] + p["cf"], m, p["Uf"], keep)
    hb, tb = recur((x @ p["Wb"] + p["cb"])[::-1], m[::-1], p["Ub"], keep)
    both = np.concatenate([hf, hb[::-1]], axis=2)
    att = np.tanh(both @ p["A"] + p["a"])
    e = np.where(real.T, att @ p["v"], np.float32(-1e9))
    w = np.exp(e - e.max(axis=0))
    w *= real.T
    w /= np.maximum(w.sum(axis=0), np.float32(1e-9))
    pooled = np.einsum("tn,tnh->nh", w, both)
    return pooled @ p["o"] + p["b"][0], (m, tf, tb, both, att, w, pooled)


def backward(p: dict, x: np.ndarray, dz: np.ndarray, held: tuple) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of all weights but the embeddings, and of the word vectors, from those of the window logits."""
    m, tf, tb, both, att, w, pooled = held
    g: dict[str, np.ndarray] = {"o": pooled.T @ dz, "b": np.array([dz.sum()], np.float32)}
    d_pool = dz[:, None] * p["o"]
    dw = np.einsum("nh,tnh->tn", d_pool, both)
    de = w * (dw - (w * dw).sum(axis=0))
    d_att = de[:, :, None] * p["v"] * (1 - att * att)
    g["v"] = np.einsum("tn,tna->a", de, att)
    g["A"], g["a"] = np.einsum("tnh,tna->ha", both, d_att, optimize=True), d_att.sum(axis=(0, 1))
    d_both = w[:, :, None] * d_pool + d_att @ p["A"].T
    dxf, g["Uf"] = unroll(d_both[:, :, :HIDDEN], m, p["Uf"], tf)
    dxb, g["Ub"] = unroll(d_both[::-1, :, HIDDEN:], m[::-1], p["Ub"], tb)
    dxb = dxb[::-1]
    for d, dx in (("f", dxf), ("b", dxb)):
        g[f"W{d}"], g[f"c{d}"] = np.einsum("tnd,tng->dg", x, dx, optimize=True), dx.sum(axis=(0, 1))
    return g, dxf @ p["Wf"].T + dxb @ p["Wb"].T


def summed(rows: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Rows added up by key, for keys below n."""
    order = np.argsort(keys, kind="stable")
    found, at = np.unique(keys[order], return_index=True)
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[found] = np.add.reduceat(rows[order], at, axis=0)
    return out


def pooled_loss(z: np.ndarray, of: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Gradients of window logits: softmax pooling of each document's windows, cross-entropy of documents. of is sorted."""
    at = np.flatnonzero(np.diff(of, prepend=-1))
    q = np.exp(2 * (z - np.maximum.reduceat(z, at)[of]))
    q /= np.add.reduceat(q, at)[of]
    s = np.add.reduceat(q * z, at)
    return ((sigmoid(s) - goal)[of] * q * (1 + 2 * (z - s[of])) / len(goal)).astype(np.float32)


def train(texts: Iterable[str], labels: list[int], steps: int = STEPS, share: float = 0.5) -> dict[str, np.ndarray]:
    """Fits the network to labelled texts, both classes alike; the same texts in the same order give the same network.
    Scores are then moved towards the share of label 1 among all labels."""
    p, rng = fresh(), np.random.default_rng(SEED)
    number: dict[bytes, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int32) for t in texts]
    wb, grams, n_grams = inputs(list(number))
    grams_at = np.cumsum(n_grams) - n_grams
    # In a sample of few documents fewer will do.
    common = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=len(number)) >= min(HELD, 1 + len(docs) // 64)
    y = np.array(labels)
    classes = [np.flatnonzero((y == c) & (np.array([len(d) for d in docs]) > 0)) for c in (0, 1)]
    first = {k: np.zeros_like(x) for k, x in p.items()}
    second = {k: np.zeros_like(x) for k, x in p.items()}
    queues = [np.empty(0, np.int64)] * 2
    for step in range(1, steps + 1):
        chosen = []
        for c in (0, 1):
            while len(queues[c]) < DOCS // 2:
                queues[c] = np.concatenate([queues[c], rng.permutation(classes[c])])
            chosen.append(queues[c][: DOCS // 2])
            queues[c] = queues[c][DOCS // 2 :]
        pick = np.concatenate(chosen)
        at, real, of = windows(np.array([len(docs[i]) for i in pick]))
        seen, local = np.unique(np.concatenate([docs[i] for i in pick]), return_inverse=True)
        lens = n_grams[seen]
        row = np.repeat(np.arange(len(seen)), lens)
        cols = grams[np.repeat(grams_at[seen] - (np.cumsum(lens) - lens), lens) + np.arange(len(row))]
        mean = np.add.reduceat(p["Ec"][cols], np.cumsum(lens) - lens, axis=0) / lens[:, None].astype(np.float32)
        used = ((rng.random(len(seen)) >= DROP) & common[seen]).astype(np.float32)[:, None]
        vec = np.concatenate([p["Ew"][wb[seen]], mean], axis=1) * used
        ids = local[at].T  # steps x windows
        x = vec[ids]
        z, held = forward(p, x, real, True)
        g, d_x = backward(p, x, pooled_loss(z, of, np.array(TARGETS)[y[pick]]), held)
        d_vec = summed(d_x.reshape(-1, DIM_W + DIM_C), ids.ravel(), len(seen)) * used
        g["Ew"] = summed(d_vec[:, :DIM_W], wb[seen], WORD_BUCKETS)
        g["Ec"] = summed((d_vec[:, DIM_W:] / lens[:, None])[row], cols, CHAR_BUCKETS)
        rate = RATE * (0.55 + 0.45 * np.cos(np.pi * step / steps))
        for k, d in g.items():  # Adam
            first[k] += 0.1 * (d - first[k])
            second[k] += 0.001 * (d * d - second[k])
            p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            if d.ndim == 2:
                p[k] *= np.float32(1 - rate * DECAY)
    p["b"] += np.float32(SHIFT * np.log(share / (1 - share)))
    return p


class Scorer:
    """Scores texts; the projected vectors of the words met last are kept, up to CACHED of them.

    Both directions run in one loop over arrays that keep windows in the last axis, so that every operation is on
    contiguous rows: direction x (update, reset, candidate) x windows."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        self.u = np.ascontiguousarray(np.stack([p["Uf"].T, p["Ub"].T]))
        self.u[:, : 2 * HIDDEN] *= 0.5  # sigmoid(x) = 0.5 + 0.5 tanh(x / 2)
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.tables = np.zeros((2, 1024, 3 * HIDDEN), np.float32)

    def _learn(self, new: list[bytes]) -> None:
        p, n = self.p, len(self.number)
        wb, grams, lens = inputs(new)
        sums = np.add.reduceat(p["Ec"][grams], np.cumsum(lens) - lens, axis=0)
        vec = np.concatenate([p["Ew"][wb], sums / lens[:, None].astype(np.float32)], axis=1)
        while n + len(new) > self.tables.shape[1]:
            self.tables = np.concatenate([self.tables, np.zeros_like(self.tables)], axis=1)
        for d, (w, c) in enumerate((("Wf", "cf"), ("Wb", "cb"))):
            x = vec @ p[w] + p[c]
            x[:, : 2 * HIDDEN] *= 0.5
            self.tables[d, n : n + len(new)] = x
        self.number.update(zip(new, range(n, n + len(new))))

    def _logits(self, ids: np.ndarray, real: np.ndarray) -> np.ndarray:
        """ids, real: steps x windows."""
        t, n = ids.shape
        h, h2 = HIDDEN, 2 * HIDDEN
        x = np.empty((t, 2, 3 * h, n), np.float32)
        x[:, 0] = self.tables[0][ids].transpose(0, 2, 1)
        x[:, 1] = self.tables[1][ids[::-1]].transpose(0, 2, 1)
        whole = real.all()
        mask = np.stack([real, real[::-1]], axis=1)[:, :, None].astype(np.float32) if not whole else None
        both, state, g = np.empty((t, h2, n), np.float32), np.zeros((2, h, n), np.float32), np.empty((2, 3 * h, n), np.float32)
        for i in range(t):
            np.matmul(self.u, state, out=g)
            zr = x[i, :, :h2]
            zr += g[:, :h2]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            c = g[:, h2:]
            c *= zr[:, h:]
            c += x[i, :, h2:]
            np.tanh(c, out=c)
            state = state - c
            state *= zr[:, :h]
            state += c
            if not whole:
                state *= mask[i]
            both[i, :h] = state[0]
            both[t - 1 - i, h:] = state[1]
        p = self.p
        att = np.matmul(p["A"].T, both)
        att += p["a"][:, None]
        np.tanh(att, out=att)
        e = np.where(real, np.matmul(p["v"], att), np.float32(-1e9))
        w = np.exp(e - e.max(axis=0)) * real
        w /= np.maximum(w.sum(axis=0), np.float32(1e-9))
        return (w * np.matmul(p["o"], both)).sum(axis=0) + p["b"][0]

    def _few(self, words: list[list[bytes]]) -> np.ndarray:
        if len(self.number) > CACHED:
            self._clear()
        number = self.number
        if new := list({w for ws in words for w in ws if w not in number}):
            self._learn(new)
        counts = np.array([len(ws) for ws in words])
        ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        at, real, of = windows(counts)
        z = np.empty(len(of), np.float64)
        for i in range(0, len(of), 1024):
            z[i : i + 1024] = self._logits(ids[at[i : i + 1024]].T, np.ascontiguousarray(real[i : i + 1024].T))
        return np.maximum.reduceat(z, np.flatnonzero(np.diff(of, prepend=-1)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out, held, n = np.zeros(len(texts)), [], 0
        for i, t in enumerate(texts):
            if ws := words_of(t):
                held.append((i, ws))
                n += len(ws)
            if held and (n >= 100_000 or i == len(texts) - 1):
                out[[k for k, _ in held]] = 1 / (1 + np.exp(-self._few([w for _, w in held])))
                held, n = [], 0
        return np.round(out, 6)


PARTS = ("recurrence", "memory", "attention", "words", "characters")


def without(p: dict[str, np.ndarray], part: str) -> dict[str, np.ndarray]:
    """The network with one of PARTS put out: no weights from state to state; no memory at all (a state is that of its
    word alone, so order cannot count); attention alike for all words; no word or no character embeddings."""
    q, h = dict(p), HIDDEN
    if part in ("recurrence", "memory"):
        q |= {k: np.zeros_like(p[k]) for k in ("Uf", "Ub")}
    if part == "memory":
        for w, c in (("Wf", "cf"), ("Wb", "cb")):
            q[w], q[c] = p[w].copy(), p[c].copy()
            q[w][:, :h], q[c][:h] = 0, -30
    for k in {"attention": ("v",), "words": ("Ew",), "characters": ("Ec",)}.get(part, ()):
        q[k] = np.zeros_like(p[k])
    return q


def measures(y: np.ndarray, s: np.ndarray) -> dict[str, float]:
    """Documents of label 1 and 0, those of each scored 0.5 or more, and the share of pairs in right order (ties half)."""
    order = np.unique(s, return_inverse=True)[1]
    n = np.bincount(order)
    rank = (np.cumsum(n) - (n - 1) / 2)[order]
    ones = int(y.sum())
    zeros = len(y) - ones
    auc = (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros) if ones and zeros else np.nan
    return {"toxic": ones, "found": int((s[y == 1] >= 0.5).sum()), "clean": zeros, "false_alarms": int((s[y == 0] >= 0.5).sum()), "auc": float(auc)}


_held: list[tuple[object, Scorer]] = []


def fold(column: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % FOLDS


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The labels that may be learned from (doc_id, y), and the rows that are (doc_id, y, text)."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y")).where(fold() != 0)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.substring("text", 1, SAMPLE_CHARS).alias("text")).where(F.regexp_like("text", F.lit("[0-9A-Za-z\\x{80}-\\x{10FFFF}]")))
    # At most 2 * SAMPLE ids: their size has a bound, so they may be broadcast and their texts meet in one task.
    first = F.md5(F.col("doc_id").cast("string"))
    ids = known.where("y = 1").orderBy(first).limit(SAMPLE).unionByName(known.where("y = 0").orderBy(first).limit(SAMPLE))
    return known, texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def cross_validate(docs: DataFrame, labels: DataFrame, steps: int = STEPS) -> DataFrame:
    """How well networks fitted to all but one fold of the sample find that fold, whole and without each of PARTS: fold,
    network, and measures(). Folds are crc32(doc_id) mod FOLDS, the one that is never learned from left out; each is a
    task that holds the sample, whose size has a bound. Labels of the fold are weighed as they stand in the sample. A fold
    without rows, or the others without both labels, gives no row."""
    rows = sample(docs, labels)[1].withColumn("fold", fold()).withColumn("validated", F.explode(F.sequence(F.lit(1), F.lit(FOLDS - 1))))

    def one(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values("doc_id")
        mine = held["fold"] == key[0]
        rest, got = held[~mine], []
        if mine.any() and rest["y"].nunique() == 2:
            p = train(rest["text"].tolist(), rest["y"].tolist(), steps, float(rest["y"].mean()))
            for name in ("whole", *PARTS):
                s = Scorer(p if name == "whole" else without(p, name)).scores(held.loc[mine, "text"].tolist())
                got.append({"fold": key[0], "network": name, **measures(held.loc[mine, "y"].to_numpy(), s)})
        return pd.DataFrame(got, columns=["fold", "network", "toxic", "found", "clean", "false_alarms", "auc"])

    # Hashes put several of four folds in one partition; ranges do not.
    return rows.repartitionByRange(FOLDS - 1, "validated").groupBy("validated").applyInPandas(one, "fold long, network string, toxic long, found long, clean long, false_alarms long, auc double")


def fit(docs: DataFrame, labels: DataFrame):
    """The network as a broadcast, or the share of label 1 if one class is missing."""
    spark = docs.sparkSession
    known, rows = sample(docs, labels)
    share = known.agg(F.avg("y")).first()[0]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((r["doc_id"], r["y"], r["text"]) for b in batches for r in b.to_pylist())
        y = [r[1] for r in held]
        if not y:
            return
        blob = io.BytesIO()
        if min(y) == max(y):
            np.savez(blob, constant=np.float64(np.mean(y)))
        else:
            np.savez(blob, **train((r[2] for r in held), y, share=share))
        yield pa.RecordBatch.from_arrays([pa.array([blob.getvalue()], pa.binary())], names=["weights"])

    # Of fixed size, whatever the corpus.
    trained = rows.repartition(1).mapInArrow(learn, "weights binary").collect()
    if not trained:
        return 0.0
    with np.load(io.BytesIO(trained[0].weights)) as f:
        p = dict(f)
    return float(p["constant"]) if "constant" in p else spark.sparkContext.broadcast(p)


def scores_of(model, texts: list[str | None]) -> np.ndarray:
    if isinstance(model, float):
        return np.array([model if words_of(t) else 0.0 for t in texts])
    p = model.value
    if not _held or _held[0][0] is not p:
        _held[:] = [(p, Scorer(p))]
    return _held[0][1].scores(texts)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = fit(docs, labels)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores_of(model, batch.column("text").to_pylist()))], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(put, "doc_id long, score double")
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None) -> DataFrame:
    """The rows of docs, all columns, that are not predicted toxic. The network is fitted on corpus (docs if not given)."""
    model = fit(docs if corpus is None else corpus, labels)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield batch.filter(pa.array(scores_of(model, batch.column("text").to_pylist()) < 0.5))

    return docs.mapInArrow(put, docs.schema)
