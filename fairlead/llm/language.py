"""Language identification by a bidirectional gated recurrent network over bytes.

Two recurrent layers read a segment of bytes, one from each end; at every position a softmax over both states labels the byte. A document's probabilities are the mean of those of all its positions. Training is numpy, by backpropagation through time with Adam, on the driver and on a bounded sample; the weights, some kilobytes, are broadcast. Whole texts are labelled in segments of ``SEGMENT`` bytes, many at a time; states start anew in each segment, so a text of any length takes bounded memory.

The sample: of labelled rows that may be learnt from, about ``per_language`` documents of each language, chosen by a hash of the text, two pieces of ``PIECE`` characters from hashed places in each; of more than ``most_pieces`` pieces the first by hash, and with very many languages fewer documents of each. Both bounds are parameters of ``train``; so are seed, width and steps, and the same rows give the same weights. Any number of languages: the more there are, the fewer segments are labelled at a time.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for all if nothing could be learnt. Rows with a null label are never learnt from. Repeated rows give repeated rows; extra columns are kept unless named like an output. With one learnt language all texts with a letter get it, score 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows, materialize, skew_join

SEGMENT = 128
LANES = 2048
#: Numbers in an array of probabilities (positions, languages, lanes); lanes go down to 16 to stay within it.
CELLS = 1 << 22
PIECE = 160
UNKNOWN = "und"
#: Languages whose shares travel in the plan; those of more are joined.
FEW_LANGUAGES = 1000

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Weights:
    """Per direction (0 from the left, 1 from the right): input tables (257 x 3H, byte 256 pads), gate and candidate matrices; then the labels' matrix and offsets."""

    langs: list[str]
    x: list[np.ndarray]
    u: list[np.ndarray]
    c: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, langs: list[str], hidden: int, rng: np.random.Generator) -> Weights:
        f = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(
            langs,
            [f(257, 3 * hidden, scale=0.5) for _ in range(2)],
            [f(hidden, 2 * hidden, scale=hidden**-0.5) for _ in range(2)],
            [f(hidden, hidden, scale=hidden**-0.5) for _ in range(2)],
            f(2 * hidden, len(langs), scale=0.3),
            np.zeros(len(langs), dtype=np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return [*self.x, *self.u, *self.c, self.out, self.bias]


def _forward(w: Weights, d: int, codes: np.ndarray) -> tuple:
    """States (T, B, H) of one direction for codes (T, B), and what the way back needs."""
    steps, lanes = codes.shape
    hid = w.c[d].shape[0]
    h = np.zeros((lanes, hid), dtype=np.float32)
    hs, gates, cands, before = (np.empty((steps, lanes, k), dtype=np.float32) for k in (hid, 2 * hid, hid, hid))
    for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
        x = w.x[d][codes[t]]
        g = _sigmoid(x[:, : 2 * hid] + h @ w.u[d])
        z, r = g[:, :hid], g[:, hid:]
        c = np.tanh(x[:, 2 * hid :] + (r * h) @ w.c[d])
        before[t], gates[t], cands[t] = h, g, c
        h = h + z * (c - h)
        hs[t] = h
    return hs, gates, cands, before


def _backward(w: Weights, d: int, codes: np.ndarray, kept: tuple, dhs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of input table, gate and candidate matrices of one direction, through time."""
    _, gates, cands, before = kept
    steps, lanes, hid = dhs.shape
    dx, du, dc = np.zeros_like(w.x[d]), np.zeros_like(w.u[d]), np.zeros_like(w.c[d])
    dh = np.zeros((lanes, hid), dtype=np.float32)
    dpre = np.empty((steps, lanes, 3 * hid), dtype=np.float32)
    for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
        dh = dh + dhs[t]
        h, c, z, r = before[t], cands[t], gates[t][:, :hid], gates[t][:, hid:]
        da = dh * z * (1 - c * c)
        drh = da @ w.c[d].T
        dz = dh * (c - h) * z * (1 - z)
        dr = drh * h * r * (1 - r)
        dg = np.concatenate([dz, dr], axis=1)
        du += h.T @ dg
        dc += (r * h).T @ da
        dpre[t] = np.concatenate([dg, da], axis=1)
        dh = dh * (1 - z) + drh * r + dg @ w.u[d].T
    flat = codes.ravel()
    order = np.argsort(flat, kind="stable")
    sums = dpre.reshape(-1, 3 * hid)[order]
    codes_in, first = np.unique(flat[order], return_index=True)
    dx[codes_in] = np.add.reduceat(sums, first, axis=0)
    return dx, du, dc


def loss_and_gradients(w: Weights, codes: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over the real positions of codes (T, B), each labelled as its lane, and the gradients in the order of ``arrays``."""
    kept = [_forward(w, d, codes) for d in range(2)]
    both = np.concatenate([kept[0][0], kept[1][0]], axis=2)
    logits = both @ w.out + w.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    real = (codes != 256).astype(np.float32)
    n = max(1.0, float(real.sum()))
    lanes = np.arange(codes.shape[1])
    loss = -float((np.log(p[:, lanes, labels] + 1e-9) * real).sum()) / n
    p[:, lanes, labels] -= 1
    dl = p * (real / n)[:, :, None]
    dout = both.reshape(-1, both.shape[2]).T @ dl.reshape(-1, dl.shape[2])
    db = dl.sum(axis=(0, 1))
    dboth = dl @ w.out.T
    hid = kept[0][0].shape[2]
    back = [_backward(w, d, codes, kept[d], dboth[:, :, d * hid : (d + 1) * hid]) for d in range(2)]
    return loss, [back[0][0], back[1][0], back[0][1], back[1][1], back[0][2], back[1][2], dout, db]


def fit(samples: list[tuple[bytes, str]], *, hidden: int = 8, steps: int = 300, lanes: int = 128, length: int = 64, seed: int = 7, rate: float = 0.02) -> Weights | None:
    """Trains on (bytes, language); languages are drawn evenly."""
    samples = sorted(set(samples))
    langs = sorted({y for _, y in samples})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    w = Weights.start(langs, hidden, rng)
    by_lang = [[np.frombuffer(x, dtype=np.uint8) for x, y in samples if y == lang and x] for lang in langs]
    m = [np.zeros_like(a) for a in w.arrays()]
    v = [np.zeros_like(a) for a in w.arrays()]
    for step in range(1, steps + 1 if len(langs) > 1 else 1):
        codes = np.full((length, lanes), 256, dtype=np.int64)
        labels = rng.integers(len(langs), size=lanes)
        for i, y in enumerate(labels):
            if not by_lang[y]:
                continue
            text = by_lang[y][rng.integers(len(by_lang[y]))]
            at = rng.integers(max(1, len(text) - length + 1))
            part = text[at : at + length]
            codes[: len(part), i] = part
        _, grads = loss_and_gradients(w, codes, labels)
        size = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        lr = rate * min(1.0, step / 20) * (1.0 if step < 0.7 * steps else 0.2)
        for a, g, mm, vv in zip(w.arrays(), grads, m, v, strict=True):
            g = g * min(1.0, 1.0 / (size + 1e-9))
            mm += 0.1 * (g - mm)
            vv += 0.001 * (g * g - vv)
            a -= lr * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    return w


class Tagger:
    """Labels every byte of whole texts. Arrays lie hidden unit by hidden unit, so that each operation runs along the lanes."""

    def __init__(self, w: Weights) -> None:
        self.w, self.hid = w, w.c[0].shape[0]
        self.lanes = min(LANES, max(16, CELLS // (SEGMENT * len(w.langs))))
        self.x = [a.copy() for a in w.x]
        for a in self.x:  # tanh(x / 2) serves for the gates
            a[:, : 2 * self.hid] *= 0.5
        self.u = [np.ascontiguousarray(0.5 * a.T) for a in w.u]
        self.c = [np.ascontiguousarray(a.T) for a in w.c]
        self.out = np.ascontiguousarray(w.out.T)

    def _states(self, d: int, codes: np.ndarray, into: np.ndarray) -> None:
        steps, lanes = codes.shape
        hid = self.hid
        h, g, c = np.zeros((hid, lanes), np.float32), np.empty((2 * hid, lanes), np.float32), np.empty((hid, lanes), np.float32)
        x, rh = np.empty((3 * hid, lanes), np.float32), np.empty((hid, lanes), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            np.copyto(x, self.x[d][codes[t]].T)
            np.matmul(self.u[d], h, out=g)
            g += x[: 2 * hid]
            np.tanh(g, out=g)
            g *= 0.5
            g += 0.5
            np.multiply(g[hid:], h, out=rh)
            np.matmul(self.c[d], rh, out=c)
            c += x[2 * hid :]
            np.tanh(c, out=c)
            c -= h
            c *= g[:hid]
            h += c
            into[t, d * hid : (d + 1) * hid] = h

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities (T, languages, B) of each position of codes (T, B)."""
        states = np.empty((codes.shape[0], 2 * self.hid, codes.shape[1]), dtype=np.float32)
        for d in range(2):
            self._states(d, codes, states)
        p = self.out @ states
        p += self.w.bias[:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities (documents, languages) over all positions of each text."""
        total = np.zeros((len(texts), len(self.w.langs)))
        codes, owner, used = np.full((self.lanes, SEGMENT), 256, dtype=np.int64), np.zeros(self.lanes, dtype=np.int64), 0

        def flush() -> None:
            nonlocal used
            if not used:
                return
            part = np.ascontiguousarray(codes[:used].T)
            p = self.positions(part)
            p *= (part != 256)[:, None, :]
            np.add.at(total, owner[:used], p.sum(axis=0, dtype=np.float64).T)
            codes[:used] = 256
            used = 0

        for i, text in enumerate(texts):
            a = np.frombuffer(text, dtype=np.uint8)
            at = 0
            while at < len(a):
                n = min(self.lanes - used, -(-(len(a) - at) // SEGMENT))
                part = a[at : at + n * SEGMENT]
                full = len(part) // SEGMENT
                codes[used : used + full] = part[: full * SEGMENT].reshape(full, SEGMENT)
                if full < n:
                    codes[used + full, : len(part) - full * SEGMENT] = part[full * SEGMENT :]
                owner[used : used + n] = i
                used += n
                at += n * SEGMENT
                if used == self.lanes:
                    flush()
        flush()
        lengths = np.array([max(1, len(t)) for t in texts], dtype=np.float64)
        return total / lengths[:, None]


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", per_language: int = 800, most_pieces: int = 400_000, **options) -> Weights | None:
    """Fits on about ``per_language`` documents a language of ``docs``, whose rows may all be learnt from, and on at most ``most_pieces`` pieces of them."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = materialize(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    n_langs = counts.count()
    if not n_langs:
        return None
    each = min(per_language, max(1, most_pieces // (2 * n_langs)))
    draw = F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(1_000_000)) / 1e6
    place = lambda k: F.substr("text", (F.pmod(F.xxhash64(F.lit(k), "text"), F.greatest(F.length("text") - PIECE, F.lit(1))) + 1).cast("int"), F.lit(PIECE))
    if n_langs <= FEW_LANGUAGES:
        share = F.create_map(*[F.lit(x) for r in counts.collect() for x in (r["lang"], min(1.0, each / r["n"]))])
        drawn = rows.filter(draw < F.element_at(share, F.col("lang")))
    else:
        drawn = skew_join(rows, counts.select("lang", F.lit(float(each)).alias("_each"), F.col("n").alias("_n"), F.col("n").alias("_w")), "lang", "_w", "inner").filter(draw * F.col("_n") < F.col("_each"))
    picked = drawn.select("lang", F.explode(F.array(place(2), place(3))).alias("piece")).distinct()
    found = picked.orderBy(F.xxhash64(F.lit(4), "piece"), "lang", "piece").limit(most_pieces).collect()
    return fit([(r["piece"].encode("utf-8", "surrogatepass"), r["lang"]) for r in found], **options)


def identify(docs: DataFrame, weights: Weights | None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    # Plain values: a broadcast carries no classes.
    shared = docs.sparkSession.sparkContext.broadcast(weights and (weights.langs, weights.x, weights.u, weights.c, weights.out, weights.bias))

    def make():
        w = Weights(*shared.value) if shared.value else None
        tagger = Tagger(w) if w else None

        def many(texts: list) -> dict:
            use = [i for i, t in enumerate(texts) if w and t and any(map(str.isalpha, t))]
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if use:
                p = tagger.documents([texts[i].encode("utf-8", "surrogatepass") for i in use])
                for i, best, score in zip(use, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                    langs[i], scores[i] = w.langs[best], min(1.0, score)
            return {"lang_pred": langs, "score": scores}

        return many

    return map_rows(docs, text_col, FIELDS, make, rows=512)
