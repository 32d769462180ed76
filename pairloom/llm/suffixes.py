"""Removal of byte runs that an earlier document holds, by sorting suffixes.

Which of the suffixes (one begins at every byte) agree in their first ``length`` bytes with a suffix of a document of
smaller id? Sorting all of them would move every byte ``length`` times, so suffixes travel in bundles and
only where a partner can exist:

* Each window of ``length`` bytes has an anchor, its ``GRAM``-byte gram of smallest hash. Equal windows have
  equal anchors at equal places, and successive windows mostly share one: they are one bundle, whose bytes
  are sent once.
* A window holds at least half of its other bytes on one side of its anchor. So a bundle has a left and a right half,
  each with one longer gram that all its windows hold. Documents are dealt to chunks by a hash of their key; a chunk
  sends the hashes of its halves' grams, in bits that grow with the corpus, and gets back one bit each: does
  another document have it? A half without a partner stays; hash collisions cost work, not results.
* Inside a chunk, windows that a smaller document of the chunk holds are settled at once. So of a passage that
  very many documents share, each chunk sends one bundle. Whole bundles of equal bytes are settled as one
  (found by a hash, then compared byte by byte), bundles that share an anchor but differ by sorting their suffixes.
* Sampled splitters range-partition the rest by the leading bytes of the anchor. A bucket sorts its
  suffixes by multikey quicksort, eight bytes at a time, only ties going on to the next eight; of equal ones all but
  those of the smallest document are marked. Splitters fall between distinct leading bytes, so equal
  suffixes never lie on both sides of a border; neighbours across one differ in their first eight bytes.
* Leading bytes that would fill a bucket of their own are hot: their windows are dealt one by one, by a hash of
  all their bytes, over as many buckets as they need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.text import U64, Powers, kgram_hashes, mix, slices, sliding_min, string_bytes
from pairloom.session import materialize

GRAM = 20
CHUNK_BYTES, FRAGMENT_BYTES = 8_000_000, 32_000_000
LEAST_BUCKETS, BUCKET_BYTES = 64, 24_000_000
SAMPLE_DOCS, SAMPLE_EVERY = 32, 16
PIECE_WINDOWS = 400_000
LOW = U64(0xFFFFFFFF)
ONE = U64(1)
NONE = np.zeros(0, np.int64)


def bundles(data: np.ndarray, offs: np.ndarray, length: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor place, hash of the left half's gram, of the right half's gram) of all
    bundles of a slice."""
    h = kgram_hashes(data, GRAM, powers)
    n = len(data) - length + 1
    if n <= 0:
        return NONE, NONE, NONE, NONE.astype(U64), NONE.astype(U64)
    best = sliding_min((h & ~LOW) | (LOW - np.arange(len(h), dtype=U64)), length - GRAM + 1)
    place = (LOW - (best & LOW)).astype(np.int64)
    edge = np.zeros(n + 1, np.int8)
    size = np.diff(offs)
    edge[offs[:-1][size >= length]] += 1
    edge[offs[1:][size >= length] - length + 1] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
    end = inside.copy()
    end[:-1] &= ~inside[1:] | (place[1:] != place[:-1])
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    place = place[first]
    up, down = powers.upto(len(data))
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum((data.astype(U64) + ONE) * up[: len(data)], out=total[1:])
    side = (length - GRAM) // 2
    begin, stop = np.maximum(place - side, 0), np.minimum(place + length - side + 1, len(data))
    left = mix((total[place + GRAM] - total[begin]) * down[begin] + ONE)
    right = mix((total[stop] - total[place]) * down[place])
    return first, last, place, left, right


def _halves(first: np.ndarray, last: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(last window of the left half, has a left half, has a right half)."""
    end = place - (length - GRAM) // 2
    return end, first <= end, last > end


def _rows_of(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, text hashes, bytes, offsets) of the rows of a chunk that can hold a match, by ascending id."""
    table = table.filter(pc.and_(pc.is_valid(table["_id"]), pc.greater_equal(pc.binary_length(table["_text"]), length)))
    table = table.sort_by([("_id", "ascending"), ("_th", "ascending")])
    data, offs = string_bytes(table["_text"])
    return table["_id"].to_numpy(), table["_th"].to_numpy(), data, offs


def _all_bundles(data: np.ndarray, offs: np.ndarray, length: int, powers: Powers, most: int = 2_000_000) -> list[np.ndarray]:
    out, at = [bundles(data[:0], offs[:1], length, powers)], 0
    while at < len(offs) - 1:
        to = min(len(offs) - 1, max(at + 1, int(np.searchsorted(offs, offs[at] + most, side="right")) - 1))
        a, b, p, *hashes = bundles(data[offs[at] : offs[to]], offs[at : to + 1] - offs[at], length, powers)
        out.append((a + offs[at], b + offs[at], p + offs[at], *hashes))
        at = to
    return [np.concatenate(c) for c in zip(*out)]


def _half_keys(found: list[np.ndarray], length: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, bundle, place in order of distinct keys) of all halves, left ones first; see ``_halves``."""
    first, last, place, left, right = found
    _, has_left, has_right = _halves(first, last, place, length)
    of = np.concatenate((np.flatnonzero(has_left), np.flatnonzero(has_right)))
    keys, number = np.unique(np.concatenate((left[has_left], right[has_right])) >> U64(64 - bits), return_inverse=True)
    return keys, of, number


def _pack(ascending: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte planes apart, so that only their low bytes take room."""
    return zstandard.compress(np.ascontiguousarray(np.diff(ascending, prepend=U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=U64)


def _ask(length: int, bits: int, frag_bits: int):
    """Per fragment of the keys, a chunk's distinct keys, each with a last bit: have two documents of the chunk got it?"""

    def run(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        ids, _, data, offs = _rows_of(table, length)
        found = _all_bundles(data, offs, length, Powers())
        keys, of, number = _half_keys(found, length, bits)
        out = pa.table({"chunk": pa.array([], pa.int32()), "frag": pa.array([], pa.int32()), "packed": pa.array([], pa.binary())})
        if not len(keys):
            return out
        doc = ids[np.searchsorted(offs, found[0][of], side="right") - 1]
        order = np.argsort(number, kind="stable")
        head = np.flatnonzero(np.diff(number[order], prepend=-1))
        twice = np.minimum.reduceat(doc[order], head) != np.maximum.reduceat(doc[order], head)
        cut = np.searchsorted(keys, np.arange((1 << frag_bits) + 1, dtype=U64) << U64(bits - frag_bits))
        both = keys << ONE | twice.astype(U64)
        frags = np.flatnonzero(np.diff(cut))
        packed = [_pack(both[cut[f] : cut[f + 1]]) for f in frags]
        return pa.table({"chunk": pa.array([chunk] * len(frags), pa.int32()), "frag": pa.array(frags, pa.int32()), "packed": pa.array(packed, pa.binary())})

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Per chunk of a fragment one bit for each of its keys: a second document has it."""
    parts = [_unpack(p) for p in table["packed"].to_pylist()]
    both = np.concatenate(parts)
    order = np.argsort(both >> ONE, kind="stable")
    keys = both[order] >> ONE
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(head, len(keys)))
    shared = np.empty(len(keys), bool)
    shared[order] = np.repeat((size > 1) | np.logical_or.reduceat((both[order] & ONE).astype(bool), head), size)
    at = np.cumsum([0] + [len(p) for p in parts])
    bits = [np.packbits(shared[a:b]).tobytes() for a, b in zip(at, at[1:])]
    return pa.table({"chunk": table["chunk"], "frag": table["frag"], "bits": pa.array(bits, pa.binary())})


def _leads(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts like them."""
    out = np.zeros(len(at), U64)
    for i in range(8):
        out = (out << U64(8)) | data[at + i].astype(U64)
    return out


def _lead_rows(length: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for _, data, offs in slices(batches, "_text"):
            place = bundles(data, offs, length, powers)[2]
            if len(place):
                yield pa.RecordBatch.from_arrays([pa.array(_leads(data, place[::every]).view(np.int64))], names=["lead"])

    return run


def _merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one document that overlap or touch as one; sorted by document and start."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    reach = end.copy()
    base = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1]))) * (int(end.max()) + 1)  # a running maximum per document
    reach = np.maximum.accumulate(end + base) - base
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])))
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.append(first[1:], len(doc)) - 1]


SPAN = "doc long, th long, start long, end long"


def _flat(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of all bytes of runs, one run after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _range_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray, powers: Powers, most: int = 2_000_000) -> np.ndarray:
    """Hashes of byte runs by ascending start."""
    out = np.empty(len(start), U64)
    for a in range(0, len(data), most):
        lo, hi = np.searchsorted(start, (a, a + most))
        if hi > lo:
            part = data[a : int((start[lo:hi] + size[lo:hi]).max())]
            up, down = powers.upto(len(part))
            total = np.zeros(len(part) + 1, U64)
            np.cumsum((part.astype(U64) + ONE) * up[: len(part)], out=total[1:])
            s = start[lo:hi] - a
            out[lo:hi] = mix((total[s + size[lo:hi]] - total[s]) * down[s] + size[lo:hi].astype(U64) * U64(0x9E3779B97F4A7C15))
    return out


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, most: int = 100_000) -> np.ndarray:
    """Whether runs of bytes are equal in pairs."""
    same = size_a == size_b
    for i in range(0, len(a), most):
        j = i + np.flatnonzero(same[i : i + most])
        if len(j):
            equal = data[_flat(a[j], size_a[j])] == data[_flat(b[j], size_a[j])]
            same[j] = np.logical_and.reduceat(equal, np.cumsum(size_a[j]) - size_a[j])
    return same


def _equal_bundles(content: np.ndarray, doc: np.ndarray, anchor: np.ndarray, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bundles whose bytes a document of smaller id holds as a bundle, and, of the others, those whose anchor
    comes with different bytes, too: these must be compared window by window. ``content`` finds candidates, bytes decide."""
    order = np.lexsort((doc, content))
    c = content[order]
    new = np.concatenate(([True], c[1:] != c[:-1])) if len(c) else np.zeros(0, bool)
    head = np.empty(len(content), np.int64)
    head[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    same = _same_bytes(data, at, at[head], size, size[head])
    covered = same & (doc > doc[head])
    kind = np.where(same, head, np.arange(len(content)))  # different bytes of one hash are kinds of their own
    rest = np.flatnonzero(~covered)
    order = rest[np.lexsort((kind[rest], anchor[rest]))]
    a, k = anchor[order], kind[order]
    if not len(order):
        return np.flatnonzero(covered), order
    head = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    n = np.diff(np.append(head, len(a)))
    mixed = k[head] != k[head + n - 1]
    return np.flatnonzero(covered), np.sort(order[np.repeat(mixed, n)])


def multikey_groups(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a matrix of numbers in sorted order, and the number of the group of equal rows of each.

    Multikey quicksort with one column as a letter: a column sorts the rows that tie so far, and only
    those still tied go on to the next one.
    """
    n, columns = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    key = words[order, 0]
    new = np.concatenate(([True], key[1:] != key[:-1])) if n else np.zeros(0, bool)
    for c in range(1, columns):
        group = np.cumsum(new) - 1
        tied = np.bincount(group, minlength=1)[group] > 1 if n else new
        t = np.flatnonzero(tied)
        if not len(t):
            break
        j = np.lexsort((words[order[t], c], group[t]))
        order[t] = order[t][j]
        key, g = words[order[t], c], group[t]
        new[t] |= np.concatenate(([True], (key[1:] != key[:-1]) | (g[1:] != g[:-1])))
    return order, np.cumsum(new) - 1


def _later(doc: np.ndarray, size: np.ndarray, at: np.ndarray, raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(bundle, place in it) of every suffix that a document of smaller id holds too."""
    n = size - length + 1
    of = np.repeat(np.arange(len(n)), n)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    begin = at[of] + inside
    words = np.empty((len(of), -(-length // 8)), U64)
    for c in range(words.shape[1]):
        words[:, c] = _leads(raw, begin + min(8 * c, length - 8))
    order, group = multikey_groups(words)
    d = doc[of[order]]
    head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    least = np.minimum.reduceat(d, head)
    gone = order[d > least[group]]
    return of[gone], inside[gone]


def _pieces(differ: np.ndarray, lead: np.ndarray, size: np.ndarray, length: int, most: int) -> Iterator[np.ndarray]:
    """Bundles to be sorted together: equal windows have equal anchors, so pieces end between leads."""
    order = differ[np.argsort(lead[differ], kind="stable")]
    windows = np.cumsum((size - length + 1)[order])
    border = np.flatnonzero(np.concatenate((lead[order][1:] != lead[order][:-1], [True]))) + 1 if len(order) else order
    i = 0
    while i < len(order):
        done = windows[i - 1] if i else 0
        j = border[max(np.searchsorted(windows[border - 1], done + most, side="right") - 1, np.searchsorted(border, i, side="right"))]
        yield order[i:j]
        i = j


def _settle(length: int, bits: int, frag_bits: int, splitters: np.ndarray, hot: np.ndarray, deal: np.ndarray, piece_windows: int):
    """What a chunk settles itself (``settled``), and the bundles that other chunks must be asked about. ``deal``:
    how many buckets each of the hot leads has."""
    ranges = len(splitters) + 1
    buckets = ranges + int(deal.sum())
    hot_base = ranges + np.cumsum(deal) - deal

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        out_b, out_s, out_p = [], [], []
        if len(table) and len(answers):
            chunk(table, answers, out_b, out_s, out_p)
        return pa.table({"bucket": pa.array(out_b, pa.int32()), "settled": pa.array(out_s, pa.bool_()), "packed": pa.array(out_p, pa.binary())})

    def chunk(table, answers, out_b, out_s, out_p):
        powers = Powers()
        ids, ths, data, offs = _rows_of(table, length)
        found = _all_bundles(data, offs, length, powers)
        keys, of, number = _half_keys(found, length, bits)
        first, last, place = found[:3]
        cut = np.searchsorted(keys, np.arange((1 << frag_bits) + 1, dtype=U64) << U64(bits - frag_bits))
        answers = answers.sort_by("frag")
        shared = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=cut[f + 1] - cut[f]) for f, b in zip(answers["frag"].to_pylist(), answers["bits"].to_pylist())]).astype(bool)
        end, has_left, has_right = _halves(first, last, place, length)
        flags = shared[number]
        ask_left, ask_right = np.zeros(len(first), bool), np.zeros(len(first), bool)
        ask_left[of[: has_left.sum()]] = flags[: has_left.sum()]
        ask_right[of[has_left.sum() :]] = flags[has_left.sum() :]
        first, last = np.where(ask_left, first, np.maximum(first, end + 1)), np.where(ask_right, last, np.minimum(last, end))
        ok = np.flatnonzero((ask_left | ask_right) & (first <= last))
        if not len(ok):
            return
        first, last, place = first[ok], last[ok], place[ok]
        row = np.searchsorted(offs, first, side="right") - 1  # rows are in the order of ids
        size, lead, doc = last - first + length, _leads(data, place), ids[row]
        whole, differ = _equal_bundles(_range_hashes(data, first, size, powers), doc, lead, data, first, size)
        spans = [(row[whole], first[whole], last[whole] + length)]
        lo, hi, back = first.copy(), last + length, np.ones(len(first), bool)
        back[whole] = False
        for piece in _pieces(differ, lead, size, length, piece_windows):
            b, inside = _later(doc[piece], size[piece], first[piece], data, length)
            b = piece[b]
            spans.append(_merge(row[b], first[b] + inside, first[b] + inside + length))
            # windows that are left run from the first to the last one that no smaller document of the chunk holds
            n = (size - length + 1)[piece]
            base = np.cumsum(n) - n
            gone = np.zeros(int(n.sum()), bool)
            pos = np.empty(len(first), np.int64)
            pos[piece] = base
            gone[pos[b] + inside] = True
            left = np.flatnonzero(~gone)
            of_left = np.repeat(np.arange(len(piece)), n)[left]
            back[piece] = False
            if len(left):
                head = np.flatnonzero(np.concatenate(([True], of_left[1:] != of_left[:-1])))
                tail = np.append(head[1:], len(left)) - 1
                q = of_left[head]
                lo[piece[q]], hi[piece[q]] = first[piece[q]] + left[head] - base[q], first[piece[q]] + left[tail] - base[q] + length
                back[piece[q]] = True
        sd, ss, se = _merge(*(np.concatenate(c) for c in zip(*spans)))
        for j in range(0, len(sd), 20_000):
            k = slice(j, j + 20_000)
            out_b.append((j // 20_000 + int(offs[-1])) % buckets)
            out_s.append(True)
            out_p.append(np.stack((ids[sd[k]], ths[sd[k]], ss[k] - offs[sd[k]], se[k] - offs[sd[k]])).astype(np.int64).tobytes())
        b = np.flatnonzero(back)
        lo, hi, row, place, lead = lo[b], hi[b], row[b], place[b], lead[b]
        bucket = np.searchsorted(splitters, lead, side="right")
        if len(hot):
            at = np.minimum(np.searchsorted(hot, lead), len(hot) - 1)
            n = np.where(hot[at] == lead, hi - lo - length + 1, 1)
            each = np.repeat(np.arange(len(lo)), n)
            single = (hot[at] == lead)[each]
            win = lo[each] + np.where(single, np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n), 0)
            lo, hi, row, place, lead, bucket, at = win, np.where(single, win + length, hi[each]), row[each], place[each], lead[each], bucket[each], at[each]
            w = np.flatnonzero(single)
            h = _range_hashes(data, lo[w], hi[w] - lo[w], powers)
            bucket[w] = hot_base[at[w]] + (h % deal[at[w]].astype(U64)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for x in np.flatnonzero(np.diff(bounds)):
            j = by[bounds[x] : bounds[x + 1]]
            j = j[np.argsort(lead[j], kind="stable")]  # equal beginnings side by side: they pack well
            n = hi[j] - lo[j]
            out_b.append(int(x))
            out_s.append(False)
            raw = b"".join((
                np.array([len(j)], np.int64).tobytes(), ids[row[j]].astype(np.int64).tobytes(), ths[row[j]].astype(np.int64).tobytes(),
                (lo[j] - offs[row[j]]).astype(np.int64).tobytes(), n.astype(np.int64).tobytes(), (place[j] - lo[j]).astype(np.int8).tobytes(), data[_flat(lo[j], n)].tobytes(),
            ))
            out_p.append(zstandard.compress(raw, 1))

    return run


def _bucket(length: int, piece_windows: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        spans = [np.frombuffer(p, np.int64).reshape(4, -1) for p in frame.packed[frame.settled]]
        cols: list[list[np.ndarray]] = [[] for _ in range(6)]
        for p in frame.packed[~frame.settled]:
            p = zstandard.decompress(p)
            k = int(np.frombuffer(p, np.int64, 1)[0])
            for i in range(4):
                cols[i].append(np.frombuffer(p, np.int64, k, 8 + 8 * k * i))
            cols[4].append(np.frombuffer(p, np.int8, k, 8 + 32 * k))
            cols[5].append(np.frombuffer(p, np.uint8, offset=8 + 33 * k))
        if cols[0]:
            doc, th, start, size, anchor, raw = (np.concatenate(c) for c in cols)
            at = np.cumsum(size) - size
            lead = _leads(raw, at + anchor)
            whole, differ = _equal_bundles(_range_hashes(raw, at, size, Powers()), doc, lead, raw, at, size)
            spans.append(np.stack((doc[whole], th[whole], start[whole], start[whole] + size[whole])))
            for piece in _pieces(differ, lead, size, length, piece_windows):
                b, inside = _later(doc[piece], size[piece], at[piece], raw, length)
                j = piece[b]
                # a document is (id, text hash); number them to merge their runs
                kinds, number = np.unique(np.stack((doc[j], th[j])), axis=1, return_inverse=True)
                m, s, e = _merge(number.ravel(), start[j] + inside, start[j] + inside + length)
                spans.append(np.stack((kinds[0][m], kinds[1][m], s, e)) if len(m) else np.zeros((4, 0), np.int64))
        out = np.concatenate(spans, axis=1) if spans else np.zeros((4, 0), np.int64)
        return pd.DataFrame({"doc": out[0], "th": out[1], "start": out[2], "end": out[3]})

    return run


def _in_chunks(df: DataFrame, id: str, text: str, length: int) -> tuple[DataFrame, int, int]:
    """(``chunk``, ``_id``, ``_text``, ``_th``) of all rows, how many chunks there are, and the bytes that can match."""
    docs = df.select(F.col(id).cast("bigint").alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    size = F.octet_length("_text")
    all_bytes, total = docs.agg(F.sum(size), F.sum(F.when((size >= length) & F.col("_id").isNotNull(), size))).first()
    chunks = (all_bytes or 0) // CHUNK_BYTES + 1
    return docs.withColumn("_th", F.xxhash64("_text")).select(_chunk("_id", "_th", chunks), "_id", "_text", "_th"), chunks, total or 0


def _chunk(id: str, th: str, chunks: int):
    return F.pmod(F.xxhash64(id, th), F.lit(chunks)).cast("int").alias("chunk")


def _spans(docs: DataFrame, total: int, length: int) -> DataFrame:
    frag_bits = max(6, (total // FRAGMENT_BYTES).bit_length())
    bits = min(62, total.bit_length() + 8)
    bits = max(bits, frag_bits + 1)
    asked = docs.groupBy("chunk").applyInArrow(_ask(length, bits, frag_bits), "chunk int, frag int, packed binary")
    answers = asked.groupBy("frag").applyInArrow(_answer, "chunk int, frag int, bits binary")
    buckets = max(LEAST_BUCKETS, total // BUCKET_BYTES)
    sample = docs.where(F.pmod("_th", F.lit(SAMPLE_DOCS)) == 0).where(F.octet_length("_text") >= length).select("_text")
    sample = materialize(sample.mapInArrow(_lead_rows(length, SAMPLE_EVERY), "lead long"))
    # balance only: any borders and any hot leads give the same result; both are at most as many as there are buckets
    weight = SAMPLE_DOCS * SAMPLE_EVERY * (3 * length // 2)
    often = {int(r.lead): int(r["count"]) for r in sample.groupBy("lead").count().where(F.col("count") * weight > BUCKET_BYTES).collect()}
    order = F.shiftrightunsigned("lead", 11).cast("double")
    cuts = sample.agg(F.percentile_approx(order, [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0] or []
    splitters = np.unique(np.array(cuts, np.float64).astype(U64) << U64(11))
    hot = np.array(sorted(k % (1 << 64) for k in often), U64)
    deal = np.array([often[int(k) - (1 << 64) if int(k) >> 63 else int(k)] * weight * 8 // BUCKET_BYTES + 1 for k in hot], np.int64)
    sent = docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _settle(length, bits, frag_bits, splitters, hot, deal, PIECE_WINDOWS), "bucket int, settled boolean, packed binary"
    )
    return sent.groupBy("bucket").applyInPandas(_bucket(length, PIECE_WINDOWS), SPAN)


def repeated_spans(df: DataFrame, id: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """(``doc``, ``th``, ``start``, ``end``): byte runs of the UTF-8 text that are covered by ``length``-byte
    strings which also begin in a document of smaller id. Runs of one document may overlap here.

    ``th`` is xxhash64 of the text. Matches never cross rows. Texts shorter than ``length`` have none; a null
    id neither removes nor loses anything; rows of one id do not remove each other's bytes. Other columns
    are ignored.
    """
    docs, _, total = _in_chunks(df, id, text, length)
    return _spans(docs, total, length)


def union_of(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def keep_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join(out) + raw[at:]


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(texts: pa.Table, spans: pa.Table) -> pa.Table:
    """The rows of a chunk without their spans."""
    runs: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
    for doc, th, start, end in zip(*(spans[c].to_pylist() for c in ("doc", "th", "start", "end"))):
        at = runs.setdefault((doc, th), ([], []))
        at[0].append(start)
        at[1].append(end)
    out = []
    for i, th, text in zip(texts["_id"].to_pylist(), texts["_th"].to_pylist(), texts["_text"]):
        raw = text.as_buffer().to_pybytes()
        gone = union_of(*runs.get((i, th), ((), ())))
        kept = keep_bytes(raw, gone)
        out.append(([{"start": a, "end": b} for a, b in gone], len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
    kinds = [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    cols = zip(*out) if out else [[]] * 5
    return pa.table([texts["_id"], *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["_id", "spans", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """Every row's ``id``, ``spans`` (maximal removed runs as an array of start and end), ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``kept_sha256`` of the remaining bytes; see ``repeated_spans``. A null text is empty.

    Texts are shuffled once: keys, bundles and the cut read the same exchange by chunk.
    """
    docs, chunks, total = _in_chunks(df, id, text, length)
    gone = _spans(docs, total, length).select(_chunk("doc", "th", chunks), "doc", "th", "start", "end")
    cut = docs.groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(_cut, "_id long, spans array<struct<start:long,end:long>>, " + RESULT)
    return cut.withColumnRenamed("_id", id)
