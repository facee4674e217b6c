"""Toxicity of whole texts: a bidirectional gated recurrent network with attention pooling, written in numpy.

A word's input is a vector of its own, if training saw it in ``MIN_DOCS`` documents, plus the mean of vectors of its byte triples, so
unseen and disguised spellings have an input too. Two gated recurrent layers read a window of words in both directions, attention
pools their states, and a logistic unit scores the window. A text is cut into overlapping windows that cover all its
words; its score is that of its worst window. Nothing but the text enters a score.

Training uses a bounded sample of labelled rows (``TRAIN_TOXIC`` and ``TRAIN_CLEAN``, the smallest by hash of the id) and is
deterministic. Each epoch draws at most ``WINDOWS_A_DOC`` windows of each of their texts, so of a very long text the model learns from
``EPOCHS`` times as many; ``EMPTY_TEXTS`` empty texts are added as clean ones. Both bound training alone: every window of every text is
scored. It runs once on the driver; the weights, about a megabyte, go to the tasks.

A text's score does not depend on the texts scored with it. Where a library sums products, factors are whole numbers of 24 bits at most,
so that sums of up to 32 products are exact in double precision whatever the order; other sums run over the steps one by one.

Defined cases: null and empty texts and texts without words are one window with one unknown word; null ids are scored and
never trained on; null labels are left out; without labelled rows of both classes every score is the share of toxic ones
(zero without any); repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_TOXIC, TRAIN_CLEAN = 1000, 2000
MIN_DOCS = 8
WINDOW, STRIDE = 64, 48
EMBED, HIDDEN = 16, 16
TRIPLES = 4096
EPOCHS, BATCH_DOCS, WINDOWS_A_DOC, RATE = 5, 32, 8, 0.01
EMPTY_TEXTS = 30
SEED = 42
CACHE_WORDS = 50_000
AT_ONCE = 1024
SLICE = 64

_WORD = re.compile(r"[^\W_]+")
Weights = dict[str, np.ndarray]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower()) or [""]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the byte triples of all words, where each word's begin, and how many it has."""
    marked = [b"\x02%b\x03\x03" % w.encode() if w else b"\x02\x02\x03" for w in words]
    lengths = np.array([len(m) for m in marked])
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.int64)
    hashed = (data[:-2] * 961 + data[1:-1] * 31 + data[2:]) * 2654435761 % 4294967296 // (4294967296 // TRIPLES)
    ends = np.cumsum(lengths)
    inside = np.ones(len(data), bool)
    inside[ends - 1] = inside[ends - 2] = False
    counts = lengths - 2
    return hashed[inside[:-2]] if len(data) > 2 else hashed, np.cumsum(counts) - counts, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Exact:
    """``x @ m`` without rounding inside: both are rounded to whole numbers of 24 bits before. ``bound``: the largest size in x."""

    def __init__(self, m: np.ndarray, bound: float = 1.0):
        self.bound = 2.0 ** np.ceil(np.log2(max(bound, 1e-30)))
        unit = 2.0 ** (np.ceil(np.log2(max(float(np.abs(m).max(initial=0)), 1e-30))) - 24)
        self.whole, self.scale, self.shape = np.rint(m / np.float64(unit)), unit * self.bound / (1 << 24), m.shape

    def __rmatmul__(self, x: np.ndarray) -> np.ndarray:
        rounded = np.rint(np.clip(x, -self.bound, self.bound) * np.float64((1 << 24) / self.bound))
        return (rounded @ self.whole * self.scale).astype(np.float32)

    __array_ufunc__ = None


def _layer(x: np.ndarray, mask: np.ndarray, u: np.ndarray | Exact, steps: list[int], keep: list | None = None) -> np.ndarray:
    """States (T, B, H) of one direction over inputs (T, B, 3H); padded steps keep the state."""
    size = u.shape[0]
    h = np.zeros((x.shape[1], size), np.float32)
    out = np.empty((x.shape[0], x.shape[1], size), np.float32)
    for t in steps:
        hu = h @ u
        gates = _sigmoid(x[t, :, : 2 * size] + hu[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        n = np.tanh(x[t, :, 2 * size :] + r * hu[:, 2 * size :])
        new = h + mask[t][:, None] * (1 - z) * (n - h)
        if keep is not None:
            keep.append((t, h, z, r, n, hu[:, 2 * size :]))
        out[t] = h = new
    return out


def _layer_back(d_out: np.ndarray, mask: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs and of ``u``, steps taken in reverse."""
    size = u.shape[0]
    dx = np.zeros((*d_out.shape[:2], 3 * size), np.float32)
    du, dh = np.zeros_like(u), np.zeros_like(d_out[0])
    for t, h, z, r, n, hn in reversed(kept):
        dh = dh + d_out[t]
        m = mask[t][:, None]
        dn = dh * m * (1 - z) * (1 - n * n)
        dz = -dh * m * (n - h) * z * (1 - z)
        dr = dn * hn * r * (1 - r)
        dx[t] = np.concatenate([dz, dr, dn], axis=1)
        back = np.concatenate([dz, dr, dn * r], axis=1)
        du += h.T @ back
        dh = dh * (1 - m * (1 - z)) + back @ u.T
    return dx, du


def _states(x: np.ndarray, mask: np.ndarray, w: Weights, keep: tuple[list, list] | None = None) -> np.ndarray:
    size, last = 3 * HIDDEN, x.shape[0]
    ahead, back = keep or (None, None)
    return np.concatenate([
        _layer(x[:, :, :size], mask, w["u_ahead"], list(range(last)), ahead),
        _layer(x[:, :, size:], mask, w["u_back"], list(range(last - 1, -1, -1)), back),
    ], axis=2)


def _pooled(states: np.ndarray, mask: np.ndarray, w: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window logits, attention (T, B) and pooled states."""
    energy = np.where(mask > 0, states @ w["attend"], np.float32(-1e9))
    energy = np.exp(energy - energy.max(axis=0))
    attention = energy / energy.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", attention, states)
    return pooled @ w["out"] + w["bias"][0], attention, pooled


def _window_logits(states: np.ndarray, mask: np.ndarray, w: dict) -> np.ndarray:
    """The logits of :func:`_pooled`, summed step by step."""
    energy = np.where(mask > 0, states @ w["attend"], np.float32(-1e9))
    energy = np.exp(energy - energy.max(axis=0))
    total, pooled = np.zeros_like(energy[0]), np.zeros_like(states[0])
    for e, s in zip(energy, states, strict=True):
        total += e
        pooled += e[:, None] * s
    return (pooled / total[:, None]) @ w["out"] + w["bias"][0]


def _inputs(w: Weights, rows: np.ndarray, of: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Word inputs: own vectors plus the mean of their triples, which lie one word after the other in ``of``."""
    return w["words"][rows] + np.add.reduceat(w["triples"][of], np.cumsum(counts) - counts, axis=0) / counts[:, None].astype(np.float32)


def _summed(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``values`` summed by their place."""
    out = np.zeros((size, values.shape[1]), np.float32)
    order = np.argsort(at, kind="stable")
    found = at[order]
    begins = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    out[found[begins]] = np.add.reduceat(values[order], begins, axis=0)
    return out


class Words:
    """The distinct words of the training texts: their own vectors' rows and their triples."""

    def __init__(self, names: list[str], vocabulary: dict[str, int]):
        self.rows = np.array([vocabulary.get(x, 0) for x in names])
        self.of, self.at, self.counts = triples(names)

    def some(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = self.counts[which]
        ends = np.cumsum(counts)
        inner = np.arange(ends[-1]) - np.repeat(ends - counts, counts) + np.repeat(self.at[which], counts)
        return self.rows[which], self.of[inner], counts


def loss_and_gradients(w: Weights, words: Words, ids: np.ndarray, mask: np.ndarray, docs: np.ndarray, labels: np.ndarray) -> tuple[float, Weights]:
    """Log loss of documents whose logit is the largest of their windows, and its gradients.

    ``ids`` (T, B): the words of each window; ``docs``: each window's document.
    """
    distinct, at = np.unique(ids, return_inverse=True)
    x = _inputs(w, *words.some(distinct)) @ w["project"] + w["shift"]
    logits, _, _ = _pooled(_states(x[at.reshape(ids.shape)], mask, w), mask, w)
    order = np.lexsort((logits, docs))
    best = order[np.append(np.flatnonzero(np.diff(docs[order])), len(order) - 1)]
    # Only the largest window of each document has a gradient: it alone is run again with its steps kept.
    ids, mask, kept = ids[:, best], mask[:, best], ([], [])
    distinct, at = np.unique(ids, return_inverse=True)
    rows, of, counts = words.some(distinct)
    inputs = _inputs(w, rows, of, counts)
    x = inputs @ w["project"] + w["shift"]
    states = _states(x[at.reshape(ids.shape)], mask, w, kept)
    logit, attention, pooled = _pooled(states, mask, w)
    loss = float(np.mean(np.logaddexp(0, logit) - labels * logit))
    d_logit = ((_sigmoid(logit) - labels) / len(labels)).astype(np.float32)
    d_pooled = d_logit[:, None] * w["out"]
    d_attention = np.einsum("bh,tbh->tb", d_pooled, states)
    d_energy = attention * (d_attention - (attention * d_attention).sum(axis=0))
    d_states = attention[:, :, None] * d_pooled + d_energy[:, :, None] * w["attend"]
    ahead, d_u_ahead = _layer_back(d_states[:, :, :HIDDEN], mask, w["u_ahead"], kept[0])
    back, d_u_back = _layer_back(d_states[:, :, HIDDEN:], mask, w["u_back"], kept[1])
    dx = _summed(np.concatenate([ahead, back], axis=2).reshape(-1, x.shape[1]), at.ravel(), len(distinct))
    d_inputs = dx @ w["project"].T
    grads = {
        "words": _summed(d_inputs, rows, len(w["words"])), "triples": _summed(np.repeat(d_inputs / counts[:, None], counts, axis=0), of, TRIPLES),
        "project": inputs.T @ dx, "shift": dx.sum(axis=0), "u_ahead": d_u_ahead, "u_back": d_u_back,
        "attend": np.einsum("tb,tbh->h", d_energy, states), "out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32),
    }
    grads["words"][0] = 0
    return loss, grads


def initial_weights(vocabulary: int, seed: int = SEED) -> Weights:
    rng = np.random.default_rng(seed)
    make = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
    w = {
        "words": make(vocabulary + 1, EMBED, scale=0.1), "triples": make(TRIPLES, EMBED, scale=0.3), "project": make(EMBED, 6 * HIDDEN, scale=EMBED**-0.5),
        "shift": np.zeros(6 * HIDDEN, np.float32), "u_ahead": make(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), "u_back": make(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
        "attend": make(2 * HIDDEN, scale=0.3), "out": make(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32),
    }
    w["words"][0] = 0
    return w


def starts(n: int) -> range:
    """Where the windows of a text of n words begin; together they cover every word."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def _windows(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of some texts: word ids (B, T), lengths and which text each is of."""
    begins = [starts(len(words)) for words in ids]
    docs = np.repeat(np.arange(len(ids)), [len(b) for b in begins])
    out, lengths = np.zeros((len(docs), WINDOW), np.int64), np.empty(len(docs), np.int64)
    row = 0
    for words, some in zip(ids, begins, strict=True):
        for a in some:
            part = words[a : a + WINDOW]
            lengths[row] = len(part)
            out[row, : len(part)] = part
            row += 1
    return out, lengths, docs


class Model:
    """Weights with the vocabulary; scores texts. ``constant``: the score of all texts where there was nothing to learn."""

    def __init__(self, vocabulary: dict[str, int], weights: Weights, constant: float | None = None):
        self.vocabulary, self.weights, self.constant = vocabulary, weights, constant
        self.known: dict[str, int] = {}
        self.rows = np.empty((0, 6 * HIDDEN), np.float32)
        if weights:
            largest = sum(float(np.abs(weights[k]).max()) for k in ("words", "triples"))
            self.exact = {k: Exact(weights[k]) for k in ("u_ahead", "u_back", "attend", "out")} | {"project": Exact(weights["project"], largest), "bias": weights["bias"]}

    def __reduce__(self):
        return Model, (self.vocabulary, self.weights, self.constant)

    def _learn_inputs(self, words: set[str]) -> None:
        """Projected inputs of new words, kept for the next texts."""
        new, w = list(words), self.weights
        of, _, counts = triples(new)
        rows = np.array([self.vocabulary.get(x, 0) for x in new])
        made = _inputs(w, rows, of, counts) @ self.exact["project"] + w["shift"]
        first, used = len(self.known), len(self.known)
        need = used + len(new)
        if need > len(self.rows):
            self.rows = np.concatenate([self.rows[:used], np.empty((max(need, 2 * used) - used, self.rows.shape[1]), np.float32)])
        self.rows[first:need] = made
        self.known.update(zip(new, range(first, need), strict=True))

    def window_logits(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.empty(len(ids), np.float32)
        # Windows of like length run together; only as many steps as the longest has.
        order = np.argsort(lengths, kind="stable")
        for a in range(0, len(order), AT_ONCE):
            part = order[a : a + AT_ONCE]
            steps = lengths[part].max()
            mask = (np.arange(steps)[:, None] < lengths[part]).astype(np.float32)
            out[part] = _window_logits(_states(self.rows[ids[part, :steps].T], mask, self.exact), mask, self.exact)
        return out

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """The largest window logit of each text, a slice of texts at a time."""
        parts = [self._logits(texts[i : i + SLICE]) for i in range(0, len(texts), SLICE)]
        return np.concatenate(parts) if parts else np.empty(0)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-self.logits(texts)))

    def _logits(self, texts: list[str | None]) -> np.ndarray:
        words = [words_of(t) for t in texts]
        distinct = set().union(*words)
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known, new = {}, distinct
        if new:
            self._learn_inputs(new)
        find = self.known.__getitem__
        ids, lengths, docs = _windows([np.fromiter(map(find, w), np.int64, len(w)) for w in words])
        logits = np.full(len(texts), -np.inf)
        np.maximum.at(logits, docs, self.window_logits(ids, lengths).astype(np.float64))
        return logits


def _calibrated(logits: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make logits probabilities: logistic regression on them (Newton) with smoothed targets."""
    toxic, clean = truth.sum(), (1 - truth).sum()
    target = np.where(truth > 0, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
    x, params = np.stack([logits, np.ones_like(logits)], axis=1), np.array([1.0, 0.0])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((np.logaddexp(0, z) - target * z).sum() + 0.5 * ((at - [1, 0]) ** 2).sum())

    for _ in range(30):
        p = _sigmoid(x @ params)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (p - target) + params - [1, 0])
        while loss(params - step) > loss(params) and np.abs(step).max() > 1e-9:
            step = step / 2
        params = params - step
    return (float(params[0]), float(params[1])) if params[0] > 0 else (1.0, 0.0)


def train(texts: list[str | None], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Adam on batches of documents; each epoch draws ``WINDOWS_A_DOC`` windows of each document.

    An empty text is clean by definition: some are added. Scores are calibrated on all windows of the sample's texts.
    """
    if len(set(labels)) < 2:
        return Model({}, {}, float(labels[0]) if labels else 0.0)
    truth = np.array([*labels, *[0] * EMPTY_TEXTS], np.float32)
    texts = [*texts, *[""] * EMPTY_TEXTS]
    seen: Counter = Counter()
    for t in texts:
        seen.update(set(words_of(t)))
    names = {x: i for i, x in enumerate(sorted(seen))}
    vocabulary = {x: i for i, x in enumerate((x for x in names if seen[x] >= MIN_DOCS and x), 1)}
    words = Words(list(names), vocabulary)
    coded = (np.array([names[x] for x in words_of(t)], np.int32) for t in texts)
    windows = [[c[a : a + WINDOW] for a in starts(len(c))] for c in coded]
    del names, seen
    rng = np.random.default_rng(SEED)
    w = initial_weights(len(vocabulary))
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    steps = epochs * max(1, len(windows) // BATCH_DOCS)
    step = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // BATCH_DOCS)):
            picked = [(i, windows[d][k]) for i, d in enumerate(part) for k in rng.permutation(len(windows[d]))[:WINDOWS_A_DOC]]
            lengths = np.array([len(p) for _, p in picked])
            ids = np.zeros((WINDOW, len(picked)), np.int64)
            for b, (_, p) in enumerate(picked):
                ids[: len(p), b] = p
            mask = (np.arange(WINDOW)[:, None] < lengths).astype(np.float32)
            _, grads = loss_and_gradients(w, words, ids, mask, np.array([i for i, _ in picked]), truth[part])
            step += 1
            rate = RATE * (1 - (step - 1) / steps)
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                w[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-6)
    raw = Model(vocabulary, w).logits(texts[: len(labels)])
    slope, offset = _calibrated(raw, np.array(labels, float))
    w["out"] *= np.float32(slope)
    w["bias"] = w["bias"] * np.float32(slope) + np.float32(offset)
    return Model(vocabulary, w)


def labelled_sample(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``TRAIN_TOXIC`` toxic and ``TRAIN_CLEAN`` clean labelled rows, the smallest by hash of the id.

    ``may_learn`` is a condition on the labels' rows. An id with several texts gives the first of them in byte order.
    """
    known = labels.where(may_learn & F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.select(F.col(doc_id).cast("bigint").alias("_id"), (F.col(label) == 1).cast("int").alias("_label")).distinct()
    order = (F.xxhash64("_id"), F.col("_id"))
    chosen = known.where("_label = 1").orderBy(*order).limit(TRAIN_TOXIC).unionByName(known.where("_label = 0").orderBy(*order).limit(TRAIN_CLEAN))
    # At most TRAIN_TOXIC + TRAIN_CLEAN rows are broadcast, and as many come back.
    texts = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    found = sorted((r["_id"], r["_text"], r["_label"]) for r in rows.collect())
    return [t for _, t, _ in found], [y for _, _, y in found]


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                scores = model.scores(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array(scores, pa.float64())], names=["_row", "score"])

    return run


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(_row, score): each row of ``docs`` as a struct, and its score."""
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), F.col(text).alias("_text"))
    return whole.mapInArrow(_scored(model), f"_row {whole.schema['_row'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows scored below the threshold, with all their columns."""
    return score(docs, model, text).where(F.col("score") < threshold).select("_row.*")
