"""Toxicity: averaged subword embeddings and a linear softmax, trained together in numpy.

A window is some ``WINDOW`` consecutive words. Its vector is the weighted average of the
embeddings of the n-grams of ``SIZES`` bytes of its words, ends marked, where an n-gram's weight
falls with its frequency; a linear softmax on it gives the window's score and the highest window
gives the document's. Misspelt words share most n-grams with the words they come from. A toxic
passage is short, so each round of training keeps, of a toxic document, its highest windows.

The fit uses at most ``TRAINING_ROWS`` toxic and twice as many other labelled documents, in the
order of a hash of the id, as windows of bucket numbers (a bounded sample); a quarter of them is
kept for the calibration. Every document is scored whole.

Null and empty texts get the score of the bias alone. A null label trains nothing. Repeated rows
get equal scores. Without labels of both classes the score is the share of toxic labels, or 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LOWER, Texts, annotate, byte_class

BITS, DIMENSIONS, WINDOW, SIZES = 17, 8, 8, (4, 5, 6)
TRAINING_ROWS, EPOCHS, ROUNDS, RATE, SIF = 600, 2, 4, 0.3, 1e-3
LETTER = byte_class("az")
LETTER[128:] = True


def buckets(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and place of every n-gram, window edges in bytes and the windows per document.

    An n-gram may begin with the mark before a word or end with the one behind it.
    """
    low = LOWER[texts.data]
    letter = LETTER[low]
    folded = np.where(letter, low, 32).astype(np.uint64)
    starts, ends, counts = Texts(low, texts.offsets).spans(LETTER)
    run = np.cumsum(np.concatenate([[0], letter]))
    found, places = [], []
    begins = texts.offsets[1:-1]
    crosses = np.zeros(len(low) + 1, np.int64)
    crosses[begins[(begins > 0) & (begins < len(low))]] = 1
    crosses = np.cumsum(crosses)
    for n in SIZES:
        m = len(low) - n + 1
        if m <= 0:
            continue
        code = np.zeros(m, np.uint64)
        for j in range(n):
            code |= folded[j : m + j] << np.uint64(8 * j)
        whole = (run[n - 1 : m + n - 1] - run[1 : m + 1]) == n - 2  # all but the first and last are letters
        whole &= crosses[n - 1 : m + n - 1] == crosses[:m]
        at = np.flatnonzero(whole)
        with np.errstate(over="ignore"):
            found.append(((code[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32))
        places.append(at)
    found = np.concatenate(found) if found else np.zeros(0, np.int32)
    places = np.concatenate(places) if places else np.zeros(0, np.int64)
    # windows: each WINDOW words of a document, the rest with the last
    per_doc = np.maximum((counts + WINDOW - 1) // WINDOW, 0)
    first_word = np.cumsum(counts) - counts
    which = np.repeat(first_word, per_doc) + WINDOW * (np.arange(per_doc.sum()) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc))
    return found, places, starts[which] if len(which) else np.zeros(0, np.int64), per_doc


def window_of(places: np.ndarray, edges: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of the window of each n-gram; the mark before its first word belongs to it."""
    number = np.zeros(int(offsets[-1]) + 2, np.int32)
    number[edges] = 1
    number = np.cumsum(number, dtype=np.int32) - 1
    return np.maximum(number[places + 1], 0)


@dataclass
class Model:
    """``embedding`` (bucket, dimension), ``softmax`` (dimension, class), ``bias``; ``weight`` of each bucket."""

    embedding: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def contributions(self) -> np.ndarray:
        return (self.weight * (self.embedding @ (self.softmax[:, 1] - self.softmax[:, 0]))).astype(np.float64)

    def logits(self, bucket: np.ndarray, window: np.ndarray, n: int) -> np.ndarray:
        total = np.bincount(window, self.contributions()[bucket], n)
        mass = np.bincount(window, self.weight[bucket], n)
        return total / np.maximum(mass, 1e-12) + self.bias[1] - self.bias[0]


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], share: float, seed: int = 5) -> Model:
    """``rows``: buckets, windows (from 0) and label of each sampled document; ``share`` of toxic labels in all."""
    apart = rows[::4] if len({y for *_, y in rows[::4]}) == 2 and len(rows) >= 40 else []
    rest = [r for i, r in enumerate(rows) if i % 4 or not apart]
    model = _train(rest, seed)
    calibrate(model, apart or rest, share)
    return model


def _bag(b: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    """The buckets of each window."""
    order = np.argsort(w, kind="stable")
    b, w = b[order], w[order]
    return [x for x in np.split(b, np.flatnonzero(np.diff(w)) + 1) if len(x)]


def _train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int) -> Model:
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    counts = np.zeros(size)
    for b, _, _ in rows:
        counts += np.bincount(b, minlength=size)
    weight = SIF / (SIF + counts / max(1, counts.sum()))
    model = Model(rng.normal(0, 0.1, (size, DIMENSIONS)), rng.normal(0, 0.1, (DIMENSIONS, 2)), np.zeros(2), weight)
    bags = [_bag(b, w) for b, w, _ in rows]
    if not any(bags):
        return model
    grow_e, grow_s, grow_b = np.full((size, 1), 1e-8), 1e-8, 1e-8
    for turn in range(ROUNDS):
        instances = []
        for bag, (_, _, y) in zip(bags, rows):
            if y and turn and bag:  # of a toxic document its highest windows
                n = len(bag)
                z = model.logits(np.concatenate(bag), np.repeat(np.arange(n), [len(x) for x in bag]), n)
                keep = np.argsort(-z)[: max(1, n // 16)]
                instances += [(bag[i], 1) for i in keep]
            else:
                instances += [(x, y) for x in bag]
        for _ in range(EPOCHS):
            for batch in np.array_split(rng.permutation(len(instances)), max(1, len(instances) // 256)):
                ids = np.concatenate([instances[i][0] for i in batch])
                lengths = np.array([len(instances[i][0]) for i in batch])
                y = np.array([instances[i][1] for i in batch])
                row = np.repeat(np.arange(len(batch)), lengths)
                share_of = weight[ids] / np.bincount(row, weight[ids], len(batch))[row]
                edges = np.cumsum(lengths) - lengths
                vector = np.add.reduceat(model.embedding[ids] * share_of[:, None], edges, axis=0)
                z = vector @ model.softmax + model.bias
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(y)), y] -= 1
                g_soft, g_vec = vector.T @ p, p @ model.softmax.T
                grad = share_of[:, None] * g_vec[row]
                unique, inverse = np.unique(ids, return_inverse=True)
                total = np.column_stack([np.bincount(inverse, grad[:, d], len(unique)) for d in range(DIMENSIONS)])
                grow_e[unique, 0] += (total**2).mean(1)
                model.embedding[unique] -= RATE * total / np.sqrt(grow_e[unique])
                grow_s += (g_soft**2).mean()
                model.softmax -= RATE * 0.2 * g_soft / np.sqrt(grow_s)
                grow_b += (p.sum(0) ** 2).mean()
                model.bias -= RATE * 0.2 * p.sum(0) / np.sqrt(grow_b)
    return model


def calibrate(model: Model, rows: list, share: float) -> None:
    """Logistic scale and shift of the highest window, classes weighted to their share in all labels."""
    bags = [_bag(b, w) for b, w, _ in rows]
    top = np.array([model.logits(np.concatenate(b), np.repeat(np.arange(len(b)), [len(x) for x in b]), len(b)).max() if b else model.bias[1] - model.bias[0] for b in bags])
    y = np.array([r[2] for r in rows])
    weight = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum()))
    mean, spread = np.average(top, weights=weight), top.std() + 1e-9
    x = (top - mean) / spread
    a, b = 1.0, np.log(share / (1 - share))
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = weight * (p - y), weight * p * (1 - p) + 1e-6
        hess = np.array([[(h * x * x).sum() + 1e-4, (h * x).sum()], [(h * x).sum(), h.sum()]])
        step = np.linalg.solve(hess, [(g * x).sum() + 1e-4 * a, g.sum()])
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    model.scale, model.shift = a / spread, b - a * mean / spread


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[list, float]:
    """The sample as buckets by window, and the share of toxic labels among all usable ones.

    Only ids whose crc32 modulo 4 is not 2 are used. A document without label is left out, one
    with contradicting labels counts as toxic.
    """
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    one = usable.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    shares = one.agg(F.sum("_toxic").alias("p"), F.count("*").alias("n")).first()
    if not shares["n"]:
        return [], 0.0
    order = F.xxhash64("doc_id")
    chosen = [r["doc_id"] for y in (0, 1) for r in one.filter(F.col("_toxic") == y).orderBy(order, "doc_id").limit(rows if y else 2 * rows).select("doc_id").collect()]
    # at most 3 * rows ids: bounded
    picked = docs.filter(F.col("doc_id").isin(chosen)).select("doc_id", "text")

    def kernel():
        def run(texts: Texts) -> list:
            found, places, edges, per_doc = buckets(texts)
            window = window_of(places, edges, texts.offsets)
            first = np.cumsum(per_doc) - per_doc
            doc = np.searchsorted(texts.offsets, places, "right") - 1
            out_b, out_w = [], []
            for i in range(len(texts)):
                mine = np.flatnonzero(doc == i) if len(texts) > 1 else np.arange(len(places))
                local = window[mine] - first[i]
                out_b.append(found[mine].tolist())
                out_w.append(local.tolist())
            return [out_b, out_w]

        return run

    got = annotate(picked, "_b array<int>, _w array<int>", kernel, drop=True)
    got = got.join(F.broadcast(one.filter(F.col("doc_id").isin(chosen))), "doc_id").orderBy("doc_id").toArrow()
    buckets_of, windows_of = (got.column(c).combine_chunks() for c in ("_b", "_w"))
    sample = [(b.values.to_numpy(), w.values.to_numpy(), int(y)) for b, w, y in zip(buckets_of, windows_of, got.column("_toxic").to_pylist())]
    return sample, shares["p"] / shares["n"]


def held_out(id_column: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[Model | None, float]:
    sample, share = training_rows(docs, labels, rows)
    if not 0 < share < 1 or len({y for *_, y in sample}) < 2:
        return None, share
    return train(sample, share), share


def score_toxicity(docs: DataFrame, model: Model | None, share: float, column: str = "text", drop: bool = False) -> DataFrame:
    """Adds ``score``: the probability of the toxic class."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS embeddings at most

    def kernel():
        m = shared.value
        gain = m.contributions() if m else None

        def run(texts: Texts) -> list:
            if m is None:
                return [np.full(len(texts), share)]
            found, places, edges, per_doc = buckets(texts)
            n = int(per_doc.sum())
            base = m.bias[1] - m.bias[0]
            out = np.full(len(texts), base)
            if n:
                window = window_of(places, edges, texts.offsets)
                z = np.bincount(window, gain[found], n) / np.maximum(np.bincount(window, m.weight[found], n), 1e-12) + base
                full = per_doc > 0
                out[full] = np.maximum.reduceat(z, (np.cumsum(per_doc) - per_doc)[full])
            return [pa.array(1 / (1 + np.exp(-np.clip(m.scale * out + m.shift, -30, 30))))]

        return run

    return annotate(docs, "score double", kernel, column, drop)
