"""Benchmark decontamination: an inverted BM25 index of the test items, every training passage a query.

Passages are windows of twice the longest item's words, each starting one item length after the last, so
an item copied into a document lies whole in some passage. An item is retrieved when a passage scores at least
``share`` of what the item scores against itself; impacts are divided by that mark, so the threshold is
1 everywhere. As in block-max WAND, a passage whose terms' largest impacts cannot sum to 1 is passed over,
then blocks of items whose block maxima cannot, and only the rest is scored from the postings. A
retrieved item counts when both its question and its answer overlap the passage.

The index goes to the executors: it holds at most ``ITEMS`` items, and a larger benchmark is cut into
several indexes that are asked one after the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.text import Powers, U64, fold_latin, mix, slices, words_of

ITEMS, BLOCK = 4096, 16
K1, B = 1.2, 0.75
SHARE, OVERLAP = 0.5, 0.6
QUESTION_GRAM, ANSWER_GRAM = 5, 3
GAP = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer, what stands before it the question; of a single sentence the last
    third of the words is the answer."""
    ends = [m.end() for m in re.finditer(r"[.?!](?=\s)|\n", text.strip())]
    body = text.strip()
    if ends and re.search(r"\w", body[: ends[-1]]) and re.search(r"\w", body[ends[-1] :]):
        return body[: ends[-1]], body[ends[-1] :]
    words = body.split()
    cut = len(words) - len(words) // 3
    return " ".join(words[:cut]), " ".join(words[cut:])


def _hashes(text: str, powers: Powers) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_of(fold_latin(raw), np.array([0, len(raw)]), powers, GAP)[3]


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of runs of ``n`` words."""
    if len(h) < n:
        return np.zeros(0, U64)
    out = np.zeros(len(h) - n + 1, U64)
    for i in range(n):
        out = out * U64(0x100000001B3) + mix(h[i : i + len(out)] + U64(i))
    return np.unique(mix(out))


@dataclass
class Index:
    items: np.ndarray  # ids
    terms: np.ndarray  # sorted word hashes
    first: np.ndarray  # where a term's postings begin; one more at the end
    posting: np.ndarray  # item numbers, by term
    impact: np.ndarray  # over the item's mark
    top: np.ndarray  # per term its largest impact
    block_top: np.ndarray  # (terms, blocks)
    question: list
    answer: list
    span: int  # words of the longest item


def build_index(items: list[tuple[int, str]], share: float = SHARE) -> Index | None:
    """BM25 postings of (id, text) items; items without words are left out. None without items."""
    powers = Powers()
    rows = sorted((i, t) for i, t in items if t and len(_hashes(t, powers)))
    if not rows:
        return None
    words = [_hashes(t, powers) for _, t in rows]
    size = np.array([len(w) for w in words], float)
    terms, which = np.unique(np.concatenate(words), return_inverse=True)
    of = np.repeat(np.arange(len(rows)), size.astype(int))
    pair, tf = np.unique(which * len(rows) + of, return_counts=True)
    term, item = pair // len(rows), pair % len(rows)
    df = np.bincount(term, minlength=len(terms))
    idf = np.log(1 + (len(rows) - df + 0.5) / (df + 0.5))
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / size.mean()))
    impact = (impact / (share * np.bincount(item, impact, len(rows)))[item]).astype(np.float32)
    first = np.searchsorted(term, np.arange(len(terms) + 1))
    block_top = np.zeros((len(terms), -(-len(rows) // BLOCK)), np.float32)
    np.maximum.at(block_top, (term, item // BLOCK), impact)
    parts = [question_and_answer(t) for _, t in rows]

    def side(text: str, n: int) -> np.ndarray:
        h = _hashes(text, powers)
        return grams(h, min(n, max(1, len(h))))

    return Index(
        np.array([i for i, _ in rows]), terms, first, item, impact, np.maximum.reduceat(impact, first[:-1]), block_top,
        [(side(q, QUESTION_GRAM), min(QUESTION_GRAM, max(1, len(_hashes(q, powers))))) for q, _ in parts],
        [(side(a, ANSWER_GRAM), min(ANSWER_GRAM, max(1, len(_hashes(a, powers))))) for _, a in parts], int(size.max()),
    )


def _share_of(want: tuple[np.ndarray, int], have: np.ndarray) -> float:
    """Share of the wanted grams that the words hold; an empty side overlaps wholly."""
    return float(np.isin(want[0], grams(have, want[1])).mean()) if len(want[0]) else 1.0


def leaks(ix: Index, data: np.ndarray, offs: np.ndarray, powers: Powers, overlap: float = OVERLAP) -> Iterator[tuple[int, int, float, float, float]]:
    """(row, item number, score, question overlap, answer overlap) of verified items, each once a row."""
    n = len(offs) - 1
    _, _, doc, h = words_of(fold_latin(data), offs, powers, GAP)
    if not len(h):
        return
    first = np.searchsorted(doc, np.arange(n + 1))
    step = ix.span  # a passage is two steps
    count = -(-np.diff(first) // step)
    base = np.concatenate(([0], np.cumsum(count)))
    at = np.minimum(np.searchsorted(ix.terms, h), len(ix.terms) - 1)
    known = np.flatnonzero(ix.terms[at] == h)
    segment = base[doc[known]] + (known - first[doc[known]]) // step
    pairs = np.unique(segment * len(ix.terms) + at[known])
    segment, term = pairs // len(ix.terms), pairs % len(ix.terms)
    bound = np.bincount(segment, ix.top[term], int(base[-1]) + 1)
    owner = np.repeat(np.arange(n), count)
    following = np.append(owner[1:] == owner[:-1], False)
    both = bound[:-1] + np.where(following, bound[1:], 0)
    begins = np.searchsorted(segment, np.arange(int(base[-1]) + 2))
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for s in np.flatnonzero(both >= 1):
        t = np.unique(term[begins[s] : begins[s + 1 + following[s]]])
        if ix.top[t].sum() < 1:
            continue
        live = ix.block_top[t].sum(0) >= 1
        if not live.any():
            continue
        reach = ix.first[t + 1] - ix.first[t]
        p = np.repeat(ix.first[t], reach) + np.arange(int(reach.sum())) - np.repeat(np.cumsum(reach) - reach, reach)
        p = p[live[ix.posting[p] // BLOCK]]
        score = np.bincount(ix.posting[p], ix.impact[p], len(ix.items))
        row = int(owner[s])
        a = first[row] + (s - base[row]) * step
        passage = h[a : min(a + 2 * step, first[row + 1])]
        for i in np.flatnonzero(score >= 1 - 1e-6):
            q, r = _share_of(ix.question[i], passage), _share_of(ix.answer[i], passage)
            if q >= overlap and r >= overlap:
                key = (row, int(i))
                best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (float(score[i]), q, r))
    for (row, i), found in sorted(best.items()):
        yield row, i, *found


def indexes(items: DataFrame, id: str = "item_id", text: str = "text") -> list[Index]:
    """Indexes of at most about ``ITEMS`` items each; null texts and ids are left out."""
    rows = items.select(F.col(id).cast("bigint").alias("i"), F.col(text).cast("string").alias("t")).where("i is not null and t is not null")
    parts = -(-rows.count() // ITEMS)
    built = [build_index([(r.i, r.t) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p).collect()]) for p in range(parts)]
    return [b for b in built if b is not None]


def find_leaks(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", overlap: float = OVERLAP) -> DataFrame:
    """One row per document row and test item found in it: ``id``, ``item_id``, ``score`` (1 is the mark),
    ``question_overlap``, ``answer_overlap``. Null and empty texts, and an empty benchmark, find nothing.
    Every row is looked at by itself, so repeated rows repeat their finds."""
    found = indexes(items)
    out = [f"{id} long", "item_id long", "score double", "question_overlap double", "answer_overlap double"]
    kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch, data, offs in slices(batches, "_text"):
            ids = batch["_id"].to_pylist()
            rows = [(ids[r], int(ix.items[i]), *x) for ix in found for r, i, *x in leaks(ix, data, offs, powers, overlap)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[o.split()[0] for o in out])

    return docs.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text")).mapInArrow(run, ", ".join(out))


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` in which no test item is found, all columns as they are."""
    found = indexes(items)
    column = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch, data, offs in slices(batches, batch_name):
            clean = np.ones(len(batch), bool)
            for ix in found:
                for r, *_ in leaks(ix, data, offs, powers, overlap):
                    clean[r] = False
            yield batch if clean.all() else batch.filter(pa.array(clean))

    batch_name = docs.columns[column]
    return docs.mapInArrow(run, docs.schema)
