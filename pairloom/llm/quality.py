"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. A passage is encoded by how its bytes are made up: shares of
16 byte classes, shares of their pairs, shares of words that repeat one of the four before them, word
length. One layer embeds it; gated attention, ``softmax(w . (tanh(V e) * sigmoid(U e)))``, weighs the
passages; the weighted sum is scored by a logistic unit. Only document labels are used. It is trained by
Adam in numpy on a bounded sample of labelled documents and applied to whole texts on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.samples import held_out, labelled_sample, rows_of
from pairloom.llm.text import Powers, slices, string_bytes, words_of

PASSAGE_WORDS = 64
SAMPLE = {0: 1000, 1: 1500}
EMBED, GATE = 16, 8


def _classes() -> np.ndarray:
    t = np.full(256, 14, np.uint8)
    t[128:] = 0  # bytes of other letters count as lower case
    t[ord("a") : ord("z") + 1] = 0
    t[ord("A") : ord("Z") + 1] = 1
    t[ord("0") : ord("9") + 1] = 2
    t[ord(" ")] = 3
    t[[10, 13]] = 4
    for i, c in enumerate(".,|!*$%#&"):
        t[ord(c)] = 5 + i
    t[:9] = t[11:13] = 15
    return t


CLASS = _classes()
N_FEATURES = 16 + 256 + 6


def passage_features(data: np.ndarray, offs: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages of a slice, document number of each). A text without words is one passage
    of zeros, so every document has at least one."""
    n_docs = len(offs) - 1
    start, end, doc, h = words_of(data, offs, powers)
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    in_doc = np.arange(len(doc)) - first[doc]
    count = np.maximum(1, -(-np.diff(first) // PASSAGE_WORDS))
    base = np.concatenate(([0], np.cumsum(count)))
    passage = base[doc] + in_doc // PASSAGE_WORDS
    n = int(base[-1])
    x = np.zeros((n, N_FEATURES), np.float32)
    if len(doc):
        # a byte belongs to the passage of the last word that has begun in its document
        head = np.zeros(len(data), np.int64)
        head[start] = 1
        word_at = np.maximum(np.cumsum(head) - 1, 0)
        of_byte = passage[word_at]
        own = doc[word_at] == np.searchsorted(offs, np.arange(len(data)), side="right") - 1
        c = CLASS[data].astype(np.int64)
        total = np.bincount(of_byte[own], minlength=n).astype(np.float32)[:, None]
        x[:, :16] = np.bincount(of_byte[own] * 16 + c[own], minlength=n * 16).reshape(n, 16)
        pair = own[1:] & own[:-1] & (of_byte[1:] == of_byte[:-1])
        x[:, 16:272] = np.bincount(of_byte[1:][pair] * 256 + c[:-1][pair] * 16 + c[1:][pair], minlength=n * 256).reshape(n, 256)
        x[:, :272] /= np.maximum(total, 1)
        words = np.bincount(passage, minlength=n).astype(np.float32)
        for lag in range(1, 5):
            same = (h[lag:] == h[:-lag]) & (doc[lag:] == doc[:-lag])
            x[:, 271 + lag] = np.bincount(passage[lag:][same], minlength=n) / np.maximum(words, 1)
        x[:, 276] = np.bincount(passage, weights=end - start, minlength=n) / np.maximum(words, 1) / 10
        x[:, 277] = np.log1p(words)
    return x, np.repeat(np.arange(n_docs), count)


def _forward(p: dict, x: np.ndarray, first: np.ndarray) -> tuple:
    """Bags are runs of rows that begin at ``first``. Returns what the backward pass needs; the last is the logit."""
    e = np.tanh(x @ p["w"] + p["b"])
    t, s = np.tanh(e @ p["v"]), 1 / (1 + np.exp(-(e @ p["u"])))
    a = (t * s) @ p["q"]
    bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
    a = np.exp(a - np.maximum.reduceat(a, first)[bag])
    a /= np.add.reduceat(a, first)[bag]
    m = np.add.reduceat(a[:, None] * e, first, axis=0)
    return e, t, s, a, bag, m, m @ p["c"] + p["d"]


def train(x: np.ndarray, bag: np.ndarray, y: np.ndarray, shift: float, seed: int = 3, steps: int = 400, rate: float = 0.01) -> dict:
    """Weights for standardised features. ``bag`` is sorted and has every number below ``len(y)``; ``shift``
    moves the logit from the sample's class shares to those of all labelled rows."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = x - mean
    z /= scale
    np.clip(z, -8, 8, out=z)
    first = np.searchsorted(bag, np.arange(len(y)))
    p = {
        "w": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], EMBED)), "b": np.zeros(EMBED), "v": rng.normal(0, 0.3, (EMBED, GATE)),
        "u": rng.normal(0, 0.3, (EMBED, GATE)), "q": rng.normal(0, 0.3, GATE), "c": rng.normal(0, 0.3, EMBED), "d": np.zeros(1),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    for step in range(1, steps + 1):
        e, t, s, a, of, m, logit = _forward(p, z, first)
        g = (1 / (1 + np.exp(-logit)) - y) / len(y)
        grad = {"c": m.T @ g, "d": g.sum(keepdims=True)}
        gm = g[:, None] * p["c"]
        ga = (e * gm[of]).sum(1)
        ga = a * (ga - np.add.reduceat(a * ga, first)[of])  # softmax within the bag
        ts = t * s
        grad["q"] = ts.T @ ga
        gts = ga[:, None] * p["q"]
        gt, gs = gts * s * (1 - t * t), gts * t * s * (1 - s)
        grad["v"], grad["u"] = e.T @ gt, e.T @ gs
        ge = (a[:, None] * gm[of] + gt @ p["v"].T + gs @ p["u"].T) * (1 - e * e)
        grad["w"], grad["b"] = z.T @ ge + 1e-4 * p["w"], ge.sum(0)
        for k, v in p.items():
            m1, m2 = moments[k]
            m1 += 0.1 * (grad[k] - m1)
            m2 += 0.01 * (grad[k] ** 2 - m2)
            v -= (rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    p["d"] = p["d"] + np.float32(shift)
    return p | {"mean": mean.astype(np.float32), "scale": scale.astype(np.float32)}


def bag_scores(p: dict, x: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
    first = np.searchsorted(bag, np.arange(n))
    z = np.clip((x - p["mean"]) / p["scale"], -8, 8)
    return 1 / (1 + np.exp(-np.clip(_forward(p, z, first)[-1].astype(np.float64), -40, 40)))


def fit_quality(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", per_class: dict[int, int] | None = None) -> dict | None:
    """Weights fitted on at most ``per_class`` (1,000 and 1,500) labelled, not held-out documents of each class,
    whole texts; None if a class is missing. The passages of the sample reach the driver as features."""
    sample, counts = labelled_sample(labels, label, per_class or SAMPLE, id)
    if len({y for _, y in sample}) < 2:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch, data, offs in slices(batches, "_text"):
            x, of = passage_features(data, offs, powers)
            cut = np.searchsorted(of, np.arange(len(batch) + 1))
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_y"], pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["_id", "_y", "x"]
            )

    rows = rows_of(docs.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text")), sample, "_id")
    got = rows.select("_id", "_y", "_text").mapInArrow(run, "_id long, _y int, x binary").toArrow()
    if len(got["_y"].unique()) < 2:
        return None
    x, offs = string_bytes(got["x"])
    ids = got["_id"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], x[offs[i] : offs[i + 1]].tobytes()))
    bags = [x[offs[i] : offs[i + 1]].view(np.float32).reshape(-1, N_FEATURES) for i in order]
    y = got["_y"].to_numpy().astype(np.float32)[order]
    shift = np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return train(np.concatenate(bags), np.repeat(np.arange(len(bags)), [len(b) for b in bags]), y, shift)


def score_quality(docs: DataFrame, model: dict | None, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` double (likelihood of label 1) and ``predicted`` int; columns of these names are
    replaced. Null and empty texts are scored as one passage without words. Without a model the score is 0.5."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("_pl_text"))
    schema = rows.select(*[F.col(f"`{c}`") for c in keep], F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch, data, offs in slices(batches, "_pl_text"):
            if model is None:
                score = np.full(len(batch), 0.5)
            else:
                x, of = passage_features(data, offs, powers)
                score = bag_scores(model, x, of, len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=[*keep, "score"])

    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
