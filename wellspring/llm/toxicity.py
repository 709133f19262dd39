"""Toxicity by a bidirectional gated recurrent network over words and characters.

A word enters as the sum of an embedding of its hash and the mean embedding of
its byte trigrams and 4-grams, so unseen forms of a word are known by their
parts. The network reads windows of ``WINDOW`` words in both directions, pools
its states by attention and gives a probability; windows start every ``STRIDE``
words and so overlap, and a text scores as its worst window.

Training is plain numpy on the driver, on a bounded sample: the first
``SAMPLE`` labelled texts of each class by a hash of the id, of at most
``TEXT_BYTES`` bytes each. A label holds for the text, not for a place in it, so
after a first pass over short texts only the worst window of a text is fitted.

Defined results: case of A-Z is ignored; null and blank texts score as the share
of label 1 in the sample, shrunk towards 0, and so does every text without a
sample of both classes; repeated labels of an id count as 1 if any is 1, null
labels not at all; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.languages import remainder
from wellspring.llm.words import mixed, slices, words

WINDOW, STRIDE = 24, 16
SAMPLE = 2_000
TEXT_BYTES = 6_000
WORD_ROWS, PART_ROWS = 1 << 13, 1 << 14
DIMS, HIDDEN = 12, 8
WARM_EPOCHS, EPOCHS, BATCH, RATE = 3, 5, 64, 0.01


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Inputs:
    """Distinct words of a slice as rows of the two embedding tables."""

    def __init__(self, part):
        found = words(part, lower=True)
        self.first = found.first
        keys, at, self.word = np.unique(found.hashes, return_index=True, return_inverse=True)
        self.row = (keys % np.uint64(WORD_ROWS)).astype(np.int64)
        start, size = found.starts[at], found.ends[at] - found.starts[at]
        # every word between two marks, one after the other
        total = size + 2
        begin = np.cumsum(total) - total
        flat = np.full(int(total.sum()), 1, dtype=np.uint64)
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        data = part.data[np.repeat(start, size) + inner]
        data = np.where((data >= 65) & (data <= 90), data + 32, data)
        flat[np.repeat(begin + 1, size) + inner] = data
        owner = np.repeat(np.arange(len(keys)), total)
        codes, owners = [], []
        for n in (3, 4):
            if len(flat) < n:
                continue
            code = np.zeros(len(flat) - n + 1, dtype=np.uint64)
            for k in range(n):
                code = code * np.uint64(257) + flat[k : len(flat) - n + 1 + k]
            inside = owner[: len(code)] == owner[n - 1 :]
            codes.append(code[inside])
            owners.append(owner[: len(code)][inside])
        code, owner = np.concatenate(codes), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        self.part = (mixed(code[order]) % np.uint64(PART_ROWS)).astype(np.int64)
        self.part_count = np.bincount(owner, minlength=len(keys))

    def windows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of each window, word positions, which of them are there)."""
        n = self.first[rows + 1] - self.first[rows]
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
        owner = np.repeat(rows, count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = (self.first[owner] + step * STRIDE)[:, None] + np.arange(WINDOW)[None, :]
        there = at < self.first[owner + 1][:, None]
        return owner, np.minimum(at, max(0, len(self.word) - 1)), there


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        near = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.p = {
            "word": near(WORD_ROWS, DIMS) * 0.3,
            "part": near(PART_ROWS, DIMS),
            "into": near(DIMS, 6 * HIDDEN),
            "into_bias": np.zeros(6 * HIDDEN, np.float32),
            "again": near(2, HIDDEN, 3 * HIDDEN),
            "focus": near(2 * HIDDEN),
            "out": near(2 * HIDDEN),
            "out_bias": np.full(1, -1.0, np.float32),
        }
        self.prior = 0.0

    def embedded(self, x: Inputs) -> np.ndarray:
        ends = np.cumsum(x.part_count)
        sums = np.add.reduceat(self.p["part"][x.part], ends - x.part_count, axis=0)
        return self.p["word"][x.row] + sums / x.part_count[:, None]

    def forward(self, drive: np.ndarray, there: np.ndarray, keep: bool = False):
        """Logits of windows; drive (windows, WINDOW, 6 * HIDDEN), in both directions."""
        b, t, _ = drive.shape
        both = np.stack((drive[:, :, : 3 * HIDDEN], drive[:, ::-1, 3 * HIDDEN :]))
        mask = np.stack((there, there[:, ::-1])).astype(np.float32)[..., None]
        h = np.zeros((2, b, HIDDEN), np.float32)
        states, trace = np.zeros((2, b, t, HIDDEN), np.float32), []
        for k in range(t):
            x = both[:, :, k]
            u = h @ self.p["again"]
            gate = sigmoid(x[..., : 2 * HIDDEN] + u[..., : 2 * HIDDEN])
            z, r = gate[..., :HIDDEN], gate[..., HIDDEN:]
            new = np.tanh(x[..., 2 * HIDDEN :] + r * u[..., 2 * HIDDEN :])
            m = mask[:, :, k]
            following = h + m * (1 - z) * (new - h)
            if keep:
                trace.append((h, z, r, new, u[..., 2 * HIDDEN :], m))
            h = following
            states[:, :, k] = h
        full = np.concatenate((states[0], states[1][:, ::-1]), axis=2)
        score = np.where(there, full @ self.p["focus"], -1e9)
        weight = np.exp(score - score.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pooled = (weight[..., None] * full).sum(axis=1)
        logit = pooled @ self.p["out"] + self.p["out_bias"]
        return (logit, (full, weight, pooled, trace)) if keep else logit

    def gradients(self, error: np.ndarray, kept, there: np.ndarray):
        """Gradients of the weights and of drive, for d loss / d logit = error."""
        full, weight, pooled, trace = kept
        g = {"out": pooled.T @ error, "out_bias": error.sum(keepdims=True)}
        d_pooled = error[:, None] * self.p["out"]
        d_full = weight[..., None] * d_pooled[:, None, :]
        d_weight = (full * d_pooled[:, None, :]).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        g["focus"] = (d_score[..., None] * full).sum(axis=(0, 1))
        d_full = d_full + d_score[..., None] * self.p["focus"]
        d_states = np.stack((d_full[..., :HIDDEN], d_full[:, ::-1, HIDDEN:]))
        d_h = np.zeros_like(d_states[:, :, 0])
        d_again = np.zeros_like(self.p["again"])
        d_both = np.zeros((*d_states.shape[:3], 3 * HIDDEN), np.float32)
        for k in range(len(trace) - 1, -1, -1):
            h, z, r, new, un, m = trace[k]
            d = d_h + d_states[:, :, k]
            d_new = d * m * (1 - z) * (1 - new * new)
            d_z = d * m * (h - new) * z * (1 - z)
            d_r = d_new * un * r * (1 - r)
            d_both[:, :, k] = np.concatenate((d_z, d_r, d_new), axis=2)
            d_u = np.concatenate((d_z, d_r, d_new * r), axis=2)
            d_again += h.transpose(0, 2, 1) @ d_u
            d_h = d * (1 - m * (1 - z)) + d_u @ self.p["again"].transpose(0, 2, 1)
        g["again"] = d_again
        return g, np.concatenate((d_both[0], d_both[1][:, ::-1]), axis=2)

    def drive(self, embedded: np.ndarray) -> np.ndarray:
        return embedded @ self.p["into"] + self.p["into_bias"]

    def window_logits(self, x: Inputs, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner, at, there = x.windows(rows)
        drive = self.drive(self.embedded(x))
        logits = np.zeros(len(owner), np.float32)
        for k in range(0, len(owner), 4096):
            part = slice(k, k + 4096)
            logits[part] = self.forward(drive[x.word[at[part]]], there[part])
        return owner, logits

    def scores(self, part) -> np.ndarray:
        """Probability of every row of a slice."""
        out = np.full(part.rows, -np.inf, np.float64)
        x = Inputs(part) if np.any(part.data > 32) else None
        if x is not None and len(x.word):
            owner, logits = self.window_logits(x, np.arange(part.rows))
            np.maximum.at(out, owner, logits)
        return np.where(np.isfinite(out), sigmoid(out), self.prior)


class Adam:
    def __init__(self, values: dict[str, np.ndarray]):
        self.values, self.step = values, 0
        self.m = {k: np.zeros_like(v) for k, v in values.items()}
        self.v = {k: np.zeros_like(v) for k, v in values.items()}

    def __call__(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            scale = np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
            self.values[k] -= RATE * scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


def trained(texts: list[str], labels: list[int]) -> Network:
    net, y = Network(), np.array(labels, dtype=np.float32)
    net.prior = float(min(0.49, y.mean() / 2)) if len(y) else 0.0
    if not len(y) or y.min() == y.max():
        net.trained = False
        return net
    net.trained = True
    part = next(slices(pa.array(texts), 1 << 40))
    x, rng, adam = Inputs(part), np.random.default_rng(1), Adam(net.p)
    length = np.diff(x.first)
    positive, negative = (np.flatnonzero((y == k) & (length > 0)) for k in (1, 0))
    for epoch in range(WARM_EPOCHS + EPOCHS):
        warm = epoch < WARM_EPOCHS
        limit = 160 if warm else np.inf
        own = [p[length[p] <= limit] for p in (positive, negative)]
        own = [o if len(o) >= 8 else p for o, p in zip(own, (positive, negative))]
        steps = max(10, min(40, max(map(len, own)) * 2 // BATCH))
        for _ in range(steps):
            rows = np.concatenate([rng.choice(o, BATCH // 2) for o in own])
            _fit(net, adam, x, np.unique(rows), y, warm)
    return net


def _fit(net: Network, adam: Adam, x: Inputs, rows: np.ndarray, y: np.ndarray, warm: bool) -> None:
    owner, at, there = x.windows(rows)
    used, local = np.unique(x.word[at], return_inverse=True)
    local = local.reshape(at.shape)
    ends = np.cumsum(x.part_count)
    n = x.part_count[used]
    parts = np.repeat(ends[used] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    grams = x.part[parts]
    sums = np.add.reduceat(net.p["part"][grams], np.cumsum(n) - n, axis=0)
    embedded = net.p["word"][x.row[used]] + sums / n[:, None]
    drive = net.drive(embedded)
    if not warm:
        logits = net.forward(drive[local], there)
        order = np.lexsort((-logits, owner))
        top = order[np.append(True, owner[order][1:] != owner[order][:-1])]
        owner, local, there = owner[top], local[top], there[top]
    logits, kept = net.forward(drive[local], there, keep=True)
    share = 1 / np.bincount(owner)[owner]
    target = y[owner]
    error = ((sigmoid(logits) - target) * share / len(rows)).astype(np.float32)
    g, d_drive = net.gradients(error, kept, there)
    flat = np.zeros_like(drive)
    np.add.at(flat, local.reshape(-1), d_drive.reshape(-1, d_drive.shape[2]))
    g["into"] = embedded.T @ flat
    g["into_bias"] = flat.sum(axis=0)
    d_embedded = flat @ net.p["into"].T
    g["word"] = np.zeros_like(net.p["word"])
    np.add.at(g["word"], x.row[used], d_embedded)
    g["part"] = np.zeros_like(net.p["part"])
    np.add.at(g["part"], grams, np.repeat(d_embedded / n[:, None], n, axis=0))
    adam(g)


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> list:
    """A bounded number of training texts with their label."""
    known = (
        labels.where(F.col(label).isNotNull() & (remainder(key, 5) != 0))
        .groupBy(key)
        .agg(F.max(F.col(label).cast("int")).alias("_label"))
    )
    order = [F.xxhash64(F.col(key)), F.col(key)]
    some = known.where("_label = 1").orderBy(*order).limit(SAMPLE).unionByName(
        known.where("_label = 0").orderBy(*order).limit(SAMPLE)
    )
    # at most 2 * SAMPLE ids and labels
    found = docs.join(F.broadcast(some), key).where(F.octet_length(text) <= TEXT_BYTES)
    return found.select(key, text, "_label").orderBy(key, text).collect()


def scored(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                values = net.scores(part) if net.trained else np.full(part.rows, net.prior)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.rows), pa.array(values, pa.float64())],
                    names=["id", "score"],
                )

    return docs.select(key, text).mapInArrow(score, f"{key} {kind}, score double")


def toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """key, held_out, score and predicted; rows with remainder 0 of 5 are held out."""
    rows = sample(docs, labels, key, text, label)
    net = trained([r[1] for r in rows], [r[2] for r in rows])
    return scored(docs, net, key, text).select(
        key,
        F.coalesce(remainder(key, 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
