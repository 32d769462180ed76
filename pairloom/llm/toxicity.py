"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

Words are runs of letters, digits and non-ASCII bytes, A-Z lower-cased. A word's input is a hashed word
vector plus the mean of the hashed vectors of its first 3 to 6 and last 4 characters (bytes, word marks
included), so unseen words are read by their parts. Only words and grams of ``MIN_DOCS`` sampled documents or more have a vector. Both kinds of vectors start from how much more often they occur in documents of
label 1, and are trained on. Windows of 64 words, each sharing 16 with the next, cover the whole text;
two gated recurrent passes read a window, attention pools their states, and the document gets the score of
its worst window. Per slice every distinct word is projected once, so the recurrence costs what its states
cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.samples import labelled_sample, rows_of
from pairloom.llm.text import LOWER, U64, Powers, fold_latin, mix, slices, words_of

WINDOW, STRIDE = 64, 48
MIN_DOCS = 4
HEADS, TAIL = (3, 4, 5, 6), 4
N_GRAMS = len(HEADS) + 1
DIM, HIDDEN, ATTENTION = 8, 8, 8
SAMPLE = {0: 2000, 1: 1000}
#: bytes between words: everything ASCII that is no letter or digit
GAP = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def distinct_words(data: np.ndarray, offs: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, number of the distinct word) of every word, the distinct words' hashes, and their gram
    hashes, as many for each word."""
    data = fold_latin(data)
    start, end, doc, h = words_of(data, offs, powers, GAP)
    kinds, at, which = np.unique(h, return_index=True, return_inverse=True)
    return doc, which, kinds, word_grams(data, start[at], end[at])


def word_grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the characters that begin and end each word, word after word. A word shorter than a gram, its mark included, is that gram."""
    n = len(start)
    if not n:
        return np.zeros(0, U64)
    last = len(data) - 1
    head, tail, found = np.full(n, 1, U64), np.full(n, 2, U64), []
    for i in range(max(HEADS) - 1):
        c = LOWER[data[np.minimum(start + i, last)]].astype(U64) + U64(2)
        head = head * U64(0x100000001B3) + np.where(start + i < end, c, U64(0))
        if i + 2 in HEADS:
            found.append(mix(head ^ U64(i)))
    for i in range(TAIL - 1):
        c = LOWER[data[np.maximum(end - 1 - i, 0)]].astype(U64) + U64(2)
        tail = tail * U64(0x100000001B3) + np.where(end - 1 - i >= start, c, U64(0))
    found.append(mix(tail))
    return np.stack(found, axis=1).ravel()


def place_in(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Row of each hash in a sorted vocabulary; the row after the last for unknown ones."""
    if not len(vocabulary):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, len(vocabulary))


def word_inputs(p: dict, word_row: np.ndarray, gram_row: np.ndarray) -> np.ndarray:
    """Inputs of distinct words; ``gram_row`` has a row of gram numbers for each. The last row of either table is zeros."""
    return p["words"][word_row] + p["grams"][gram_row].mean(1)


def windows(doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, document) of all windows; a document without words has one of length 0."""
    bound = np.searchsorted(doc, np.arange(n_docs + 1))
    size = np.diff(bound)
    count = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    of = np.repeat(np.arange(n_docs), count)
    place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = bound[:-1][of] + place * STRIDE
    return at, np.minimum(WINDOW, bound[1:][of] - at), of


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _pass(px: np.ndarray, wh: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """One direction over windows. ``px``: projected inputs of distinct words; ``ids``, ``mask``: (steps,
    windows). State is held where the mask is 0. Returns all states, and per step what backward needs."""
    steps, n = ids.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((steps, n, HIDDEN), np.float32)
    saved = []
    for t in range(steps):
        x = px[ids[t]]
        zr = _sigmoid(x[:, : 2 * HIDDEN] + h @ wh[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN] * mask[t][:, None], zr[:, HIDDEN:]
        u = h @ wh[:, 2 * HIDDEN :]
        c = np.tanh(x[:, 2 * HIDDEN :] + r * u)
        new = h + z * (c - h)
        if keep:
            saved.append((h, z, r, u, c))
        h = out[t] = new
    return out, saved


def forward(p: dict, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple:
    """Logits of windows; ``x`` are inputs of distinct words with a row of zeros at the end for padding."""
    px = [x @ p[f"x{d}"] + p[f"b{d}"] for d in "fb"]
    hf, sf = _pass(px[0], p["hf"], ids, mask, keep)
    hb, sb = _pass(px[1], p["hb"], ids[::-1], mask[::-1], keep)
    s = np.concatenate((hf, hb[::-1]), axis=2)
    k = np.tanh(s @ p["a"])
    e = np.where(mask > 0, k @ p["q"], -1e9)
    a = np.exp(e - e.max(0))
    a /= a.sum(0)
    m = (a[:, :, None] * s).sum(0)
    return m @ p["o"] + p["d"], (s, k, a, m, sf, sb)


def _back(px_ids: np.ndarray, wh: np.ndarray, saved: list, dh_all: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients by projected inputs of distinct words and by the recurrent weights."""
    gx, gw = np.zeros((n_words, 3 * HIDDEN), np.float32), np.zeros_like(wh)
    dh = np.zeros_like(dh_all[0])
    for t in range(len(saved) - 1, -1, -1):
        h, z, r, u, c = saved[t]
        dh = dh + dh_all[t]
        dc = dh * z * (1 - c * c)
        dz = dh * (c - h)
        live = z > 0
        dz = np.where(live, dz * z * (1 - z), 0)
        dr = dc * u * r * (1 - r)
        du = dc * r
        g = np.concatenate((dz, dr, dc), axis=1)
        np.add.at(gx, px_ids[t], g)
        gw[:, : 2 * HIDDEN] += h.T @ g[:, : 2 * HIDDEN]
        gw[:, 2 * HIDDEN :] += h.T @ du
        dh = dh * (1 - z) + g[:, : 2 * HIDDEN] @ wh[:, : 2 * HIDDEN].T + du @ wh[:, 2 * HIDDEN :].T
    return gx, gw


def _layout(which: np.ndarray, at: np.ndarray, size: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and mask as (steps, windows); an empty window has one padding word that counts."""
    steps = int(max(1, size.max(initial=1)))
    t = np.arange(steps)[:, None]
    real = t < size[None, :]
    ids = np.where(real, which[np.minimum(at[None, :] + t, len(which) - 1)] if len(which) else pad, pad)
    return ids, (real | ((t == 0) & (size == 0)[None, :])).astype(np.float32)


def _vocabulary(hashes: np.ndarray, doc: np.ndarray, y: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``MIN_DOCS`` documents or more, sorted, and of each the log of its odds among documents of
    label 1 against label 0, over its standard error."""
    order = np.lexsort((doc, hashes))
    h, d = hashes[order], doc[order]
    first = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]))) if len(h) else np.zeros(0, bool)
    h, d = h[first], d[first]
    kinds, at, n = np.unique(h, return_index=True, return_counts=True)
    pos = np.add.reduceat(y[d], at) if len(at) else np.zeros(0)
    n1, n0 = max(1.0, float(y.sum())), max(1.0, n_docs - float(y.sum()))
    a, b = pos + 2 * n1 / (n1 + n0), n - pos + 2 * n0 / (n1 + n0)
    z = np.log(a / n1 / (b / n0)) / np.sqrt(1 / a + 1 / b)
    keep = n >= MIN_DOCS
    return kinds[keep], (np.clip(z[keep], -9, 9) / 3).astype(np.float32)


def train(texts: list[str], y: np.ndarray, shift: float, seed: int = 5, epochs: int = 10, rate: float = 0.01, batch: int = 128) -> dict:
    """Weights from whole texts with document labels. Each epoch finds every document's worst window by the
    weights so far and takes Adam steps on those; ``shift`` moves the logit to the class shares of all labels."""
    rng = np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    doc, which, kinds, grams = distinct_words(data, offs, Powers())
    at, size, of = windows(doc, len(texts))
    word_vocabulary, word_odds = _vocabulary(kinds[which], doc, y, len(texts))
    gram_vocabulary, gram_odds = _vocabulary(grams.reshape(-1, N_GRAMS)[which].ravel(), np.repeat(doc, N_GRAMS), y, len(texts))
    word_row, gram_row = place_in(word_vocabulary, kinds), place_in(gram_vocabulary, grams).reshape(-1, N_GRAMS)
    p = {"words": rng.normal(0, 0.05, (len(word_odds) + 1, DIM)), "grams": rng.normal(0, 0.05, (len(gram_odds) + 1, DIM))}
    p["words"][:-1, 0], p["grams"][:-1, 1] = word_odds, gram_odds
    p["words"][-1] = p["grams"][-1] = 0
    for d in "fb":
        p |= {f"x{d}": rng.normal(0, 0.5, (DIM, 3 * HIDDEN)), f"b{d}": np.zeros(3 * HIDDEN), f"h{d}": rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))}
        p[f"b{d}"][:HIDDEN] = -1.0
    p |= {"a": rng.normal(0, 0.3, (2 * HIDDEN, ATTENTION)), "q": rng.normal(0, 0.3, ATTENTION), "o": rng.normal(0, 0.3, 2 * HIDDEN), "d": np.array([-1.0])}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        x = np.vstack((word_inputs(p, word_row, gram_row), np.zeros((1, DIM), np.float32)))
        logit = np.concatenate([_logits(p, x, which, at[i : i + 4096], size[i : i + 4096]) for i in range(0, len(at), 4096)])
        worst = np.lexsort((logit, of))[np.cumsum(np.bincount(of, minlength=len(texts))) - 1]  # the last window of each document is its worst
        order = rng.permutation(len(texts))
        for i in range(0, len(order), batch):
            d = order[i : i + batch]
            used, ids_here = np.unique(np.concatenate([which[at[w] : at[w] + size[w]] for w in worst[d]] or [which[:0]]), return_inverse=True)
            lens = size[worst[d]]
            local_at = np.cumsum(lens) - lens
            xin = np.vstack((word_inputs(p, word_row[used], gram_row[used]), np.zeros((1, DIM), np.float32)))
            ids, mask = _layout(ids_here, local_at, lens, len(used))
            out, (s, k, a, m, sf, sb) = forward(p, xin, ids, mask, keep=True)
            g = ((_sigmoid(out) - y[d]) / len(d)).astype(np.float32)
            grad = {"o": m.T @ g, "d": g.sum(keepdims=True)}
            gm = g[:, None] * p["o"]
            gs = a[:, :, None] * gm
            ga = (s * gm).sum(2)
            ga = a * (ga - (a * ga).sum(0))
            grad["q"] = np.einsum("tnk,tn->k", k, ga)
            gk = ga[:, :, None] * p["q"] * (1 - k * k)
            grad["a"] = np.einsum("tns,tnk->sk", s, gk)
            gs = gs + gk @ p["a"].T
            gx = 0
            for d_, part, saved, its in (("f", gs[:, :, :HIDDEN], sf, ids), ("b", gs[::-1, :, HIDDEN:], sb, ids[::-1])):
                gpx, grad[f"h{d_}"] = _back(its, p[f"h{d_}"], saved, part, len(xin))
                grad[f"x{d_}"], grad[f"b{d_}"] = xin.T @ gpx, gpx.sum(0)
                gx = gx + gpx @ p[f"x{d_}"].T
            gx = gx[:-1]
            grad["words"], grad["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
            np.add.at(grad["words"], word_row[used], gx)
            np.add.at(grad["grams"], gram_row[used], gx[:, None, :] / N_GRAMS)
            grad["words"][-1] = grad["grams"][-1] = 0
            step += 1
            for name, v in p.items():
                m1, m2 = moments[name]
                slow = 0.3 if name in ("words", "grams") else 1.0
                m1 += 0.1 * (grad[name] - m1)
                m2 += 0.01 * (grad[name] ** 2 - m2)
                v -= (slow * rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    p["d"] = p["d"] + np.float32(shift)
    return p | {"word_vocabulary": word_vocabulary, "gram_vocabulary": gram_vocabulary}


def _logits(p: dict, x: np.ndarray, which: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    return forward(p, x, *_layout(which, at, size, len(x) - 1))[0]


def text_scores(p: dict, data: np.ndarray, offs: np.ndarray, powers: Powers) -> np.ndarray:
    """The score of the worst of all windows of each row of a slice."""
    n = len(offs) - 1
    doc, which, kinds, grams = distinct_words(data, offs, powers)
    rows = place_in(p["word_vocabulary"], kinds), place_in(p["gram_vocabulary"], grams).reshape(-1, N_GRAMS)
    x = np.vstack((word_inputs(p, *rows), np.zeros((1, DIM), np.float32))) if len(kinds) else np.zeros((1, DIM), np.float32)
    at, size, of = windows(doc, n)
    by_size = np.argsort(size, kind="stable")  # windows of a chunk have about the same length
    logit = np.empty(len(at), np.float32)
    for i in range(0, len(at), 4096):
        j = by_size[i : i + 4096]
        logit[j] = _logits(p, x, which, at[j], size[j])
    worst = np.maximum.reduceat(logit, np.searchsorted(of, np.arange(n)))
    return 1 / (1 + np.exp(-np.clip(worst.astype(np.float64), -40, 40)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", per_class: dict[int, int] | None = None) -> dict | None:
    """Weights fitted on at most ``per_class`` (2,000 and 1,000) labelled, not held-out documents of each class,
    whole texts, which reach the driver; None if a class is missing."""
    sample, counts = labelled_sample(labels, label, per_class or SAMPLE, id)
    if len({y for _, y in sample}) < 2:
        return None
    rows = rows_of(docs.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text")), sample, "_id")
    got = sorted(rows.select("_id", "_y", F.coalesce("_text", F.lit("")).alias("_text")).collect(), key=lambda r: (r._id, r._text))
    y = np.array([r._y for r in got], np.float32)
    if not 0 < y.sum() < len(y):
        return None
    shift = np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return train([r._text for r in got], y, shift)


def score_toxicity(docs: DataFrame, model: dict | None, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` double (likelihood of label 1) and ``predicted`` int; columns of these names are
    replaced. A null or empty text, and one without words, is a window of padding. Without a model the score
    is 0."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("_pl_text"))
    schema = rows.select(*[F.col(f"`{c}`") for c in keep], F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch, data, offs in slices(batches, "_pl_text"):
            score = np.zeros(len(batch)) if model is None else text_scores(model, data, offs, powers)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=[*keep, "score"])

    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
