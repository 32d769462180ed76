"""Texts of Arrow batches as byte arrays, and the array passes the text operators share.

All passes work on slices of half a megabyte, so a task's memory does not depend on its input; a text
longer than a slice is a slice of its own and is still taken whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 500_000
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = (0x20, *range(0x09, 0x0E))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def as_signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    if column.null_count:
        column = pc.fill_null(column, b"" if kind == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut into runs of rows with at most ``most`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        data, offs = string_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + most, side="right")) - 1)
            to = min(to, len(batch))
            yield batch.slice(at, to - at), data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
            at = to


def fold_latin(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with the accented capitals of Latin-1 lower-cased as well."""
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return data + capital.astype(np.uint8) * np.uint8(0x20) if capital.any() else data


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, extended on demand."""

    def __init__(self, base: int = _BASE):
        self.base, self.inverse, self.size = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.size < n:
            n = max(n, 1 << 16)
            out = []
            for b in (self.base, self.inverse):
                a = np.full(n, b, U64)
                a[0] = 1
                out.append(np.multiply.accumulate(a))
            self.up, self.down, self.size = out[0], out[1], n
        return self.up, self.down


def _byte_table(keep_space: bool = False) -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    if not keep_space:
        t[list(_SPACE)] = 0
    return t


#: A-Z lower-cased; the six white-space bytes (and NUL, kept apart below) become 0
LOWER = _byte_table(True)
IS_SPACE = np.isin(np.arange(256), _SPACE)


def words_of(data: np.ndarray, offs: np.ndarray, powers: Powers, gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of lower-cased texts: (start, end, document number, hash).

    ``data`` and ``offs`` are a slice's bytes and row offsets; words never cross rows. ``gap`` marks the
    bytes between words.
    """
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e, np.zeros(0, U64)
    solid = ~gap[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = offs[1:-1][offs[1:-1] < n]
    begins[inner] = solid[inner]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = inner[inner > 0] - 1
    ends[last] = solid[last]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    up, down = powers.upto(n)
    total = np.empty(n + 1, U64)
    total[0] = 0
    np.cumsum((LOWER[data].astype(U64) + U64(1)) * up[:n], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    doc = np.searchsorted(offs, start, side="right") - 1
    return start, end, doc, mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def kgram_hashes(data: np.ndarray, k: int, powers: Powers) -> np.ndarray:
    """Hashes of every run of ``k`` bytes of one buffer (``len - k + 1`` of them, maybe none)."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers.upto(len(data))
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[:n])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of ``w`` values, by doubling."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    have, m = 1, x
    while have * 2 <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = w - have
    return np.minimum(m[:n], m[rest : rest + n]) if rest else m[:n]


def shingle_sets(word_hash: np.ndarray, doc: np.ndarray, n_docs: int, k: int = 5) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its ``k``-word shingles; of a shorter, non-empty
    document the hash of its whole sequence; of one without words an empty array."""
    bound = np.searchsorted(doc, np.arange(n_docs + 1))
    weights = [U64((0xA0761D6478BD642F * (2 * i + 1)) % (1 << 64) | 1) for i in range(k)]
    n = len(word_hash) - k + 1
    if n > 0:
        run = word_hash[:n] * weights[0]
        for i in range(1, k):
            run += mix(word_hash[i : i + n] + U64(i)) * weights[i]
        run = mix(run)
    out = []
    for d in range(n_docs):
        a, b = bound[d], bound[d + 1]
        if b - a >= k:
            s = np.sort(run[a : b - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            h = np.zeros(1, U64)
            for i in range(b - a):
                h += mix(word_hash[a + i : a + i + 1] + U64(i)) * weights[i]
            out.append(mix(h + U64(b - a)))
        else:
            out.append(word_hash[:0])
    return out
