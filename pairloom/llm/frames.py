"""Texts as independent zstandard frames, and fill-in-the-middle documents cut from them.

A text is stored as a list of frames of at most ``frame_bytes`` bytes that end between code points. Each frame is
compressed by itself and kept with how many line ends and code points come before it. So a cut after ``u`` lines is
found from the counts, and only the frame that holds it is decompressed; all frames between two cuts go into the
output as they are, still compressed. Digests stream over ordered frames. A task never holds more than a text's
compressed frames and one frame's bytes, and no row is shuffled.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.text import slices

FRAME_BYTES = 1 << 16
# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

FRAME = "struct<lines: bigint, chars: bigint, data: binary>"
_FRAME = pa.struct([("lines", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])


def _lead(raw: bytes | np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    a = np.frombuffer(raw, np.uint8) if isinstance(raw, bytes) else raw
    return len(a) - int(np.count_nonzero((a & 0xC0) == 0x80))


def _pieces(raw: bytes, most: int) -> Iterator[bytes]:
    at = 0
    while at < len(raw):
        to = min(at + most, len(raw))
        while to < len(raw) and raw[to] & 0xC0 == 0x80:
            to -= 1
        if to <= at:  # a frame holds one code point at least
            to = at + 1
            while to < len(raw) and raw[to] & 0xC0 == 0x80:
                to += 1
        yield raw[at:to]
        at = to


def text_frames(df: DataFrame, id: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES, level: int = 3) -> DataFrame:
    """``id``, ``n_lines`` (units ``[^\\n]*\\n|[^\\n]+``), ``n_chars`` (code points), ``marked`` (holds one of the
    three marks) and ``frames`` of every row: per frame the line ends and code points before it, and its data.

    Null and empty texts have no frames; repeated rows and null ids are rows like others; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level).compress
        for batch, data, offs in slices(batches, "_text"):
            ends, lines, chars, blobs, counts, total, marked = [0], [], [], [], [], [], []
            for a, b in zip(offs[:-1], offs[1:]):
                raw = data[a:b].tobytes()
                n, c = 0, 0
                for piece in _pieces(raw, frame_bytes):
                    lines.append(n)
                    chars.append(c)
                    blobs.append(pack(piece))
                    n, c = n + piece.count(b"\n"), c + _lead(piece)
                counts.append(n + bool(raw and not raw.endswith(b"\n")))
                total.append(c)
                marked.append(any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)))
                ends.append(len(blobs))
            frames = pa.StructArray.from_arrays([pa.array(lines, pa.int64()), pa.array(chars, pa.int64()), pa.array(blobs, pa.binary())], fields=list(_FRAME))
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], pa.array(counts, pa.int64()), pa.array(total, pa.int64()), pa.array(marked, pa.bool_()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), frames)],
                names=["_id", "n_lines", "n_chars", "marked", "frames"],
            )

    rows = df.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"_id long, n_lines long, n_chars long, marked boolean, frames array<{FRAME}>").withColumnRenamed("_id", id)


class Frames:
    """The frames of one text: ``(lines before, code points before, data)`` each."""

    def __init__(self, frames: Sequence[dict], n_lines: int, n_chars: int):
        self.lines = [f["lines"] for f in frames]
        self.chars = [f["chars"] for f in frames]
        self.data = [f["data"] for f in frames]
        self.n_lines, self.n_chars = n_lines, n_chars
        self.opened = 0

    def read(self, i: int) -> bytes:
        self.opened += 1
        return zstandard.ZstdDecompressor().decompress(self.data[i])

    def cut(self, u: int) -> tuple[int, int, int]:
        """Where ``u`` lines have ended: (frame, byte in it, code points before). One frame is decompressed at most."""
        if u <= 0:
            return 0, 0, 0
        if u >= self.n_lines:
            return len(self.data), 0, self.n_chars
        i = bisect_left(self.lines, u) - 1  # the last frame with fewer line ends before it
        raw, at = self.read(i), -1
        for _ in range(u - self.lines[i]):
            at = raw.index(b"\n", at + 1)
        return i, at + 1, self.chars[i] + _lead(raw[: at + 1])

    def span(self, a: tuple[int, int, int], b: tuple[int, int, int]) -> Iterator[bytes]:
        """Frames of the text between two cuts; whole ones as they are."""
        pack = zstandard.ZstdCompressor(level=3).compress
        (i, x, _), (j, y, _) = a, b
        if (i, x) >= (j, y):
            return
        if i == j:
            yield pack(self.read(i)[x:y])
            return
        yield pack(self.read(i)[x:]) if x else self.data[i]
        yield from self.data[i + 1 : j]
        if y:
            yield pack(self.read(j)[:y])


def stream(frames: Iterable[bytes]) -> Iterator[bytes]:
    """The bytes of ordered frames, one frame at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    for f in frames:
        yield unpack(f)


def restore(frames: Sequence[bytes], form: str) -> Iterator[bytes]:
    """The text of an output, in parts: the marks are looked for in the streamed output in the order of its form;
    then prefix, middle and suffix are read from their frames."""
    if form == "plain":
        yield from stream(frames)
        return
    marks, at, found = ORDER[form], 0, []
    starts, carry = [0], b""
    for raw in stream(frames):
        window, base = carry + raw, at - len(carry)
        while len(found) < len(marks):
            hit = window.find(marks[len(found)], max(0, found[-1] + 3 - base) if found else 0)
            if hit < 0:
                break
            found.append(base + hit)
        carry = window[-2:]  # a mark may cross the border of frames
        at += len(raw)
        starts.append(at)
    if len(found) < 3 or found[0]:
        raise ValueError("an output without its marks")
    part = {m: (p + 3, q) for m, p, q in zip(marks, found, [*found[1:], at])}
    unpack = zstandard.ZstdDecompressor().decompress
    for m in (PREFIX, MIDDLE, SUFFIX):
        a, b = part[m]
        for i in range(bisect_left(starts, a + 1) - 1, len(frames)):
            if starts[i] >= b or a >= b:
                break
            yield unpack(frames[i])[max(0, a - starts[i]) : b - starts[i]]


def fill_in_middle(frames: DataFrame, id: str = "doc_id", seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """``id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` (frames) of stored texts.

    Four numbers come from the sha256 of ``seed:id`` (a null id is written as nothing): the smaller and larger of two
    places among the lines, whether to transform (``rate`` of 100) and which form (``spm`` of 100). Empty texts and those
    that hold a mark stay plain, with null counts. Rows are independent, so ties and repeated rows need no rule.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    a, b = (x % (F.col("n_lines") + 1) for x in h[:2])
    plain = (F.col("n_lines") == 0) | F.col("marked") | (h[2] % 100 >= rate)
    form: Column = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    rows = frames.select(F.col(id).alias("_id"), "n_lines", "n_chars", form.alias("form"), F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "frames")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for at in range(0, len(batch), 200):
                some = batch.slice(at, 200)
                before, middle, ends, out = [], [], [0], []
                for r in some.drop_columns(["_id"]).to_pylist():
                    text = Frames(r["frames"], r["n_lines"], r["n_chars"])
                    if r["form"] == "plain":
                        before.append(None)
                        middle.append(None)
                        out += text.data
                    else:
                        start, end = (0, 0, 0), (len(text.data), 0, text.n_chars)
                        x, y = text.cut(r["a"]), text.cut(r["b"])
                        before.append(x[2])
                        middle.append(y[2] - x[2])
                        spans = {PREFIX: (start, x), MIDDLE: (x, y), SUFFIX: (y, end)}
                        for m in ORDER[r["form"]]:
                            out.append(pack(m))
                            out += text.span(*spans[m])
                    ends.append(len(out))
                yield pa.RecordBatch.from_arrays(
                    [some["_id"], some["n_lines"], some["form"], pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out, pa.binary()))],
                    names=["_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    schema = "_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id)


def _digest(parts: Iterable[bytes]) -> str:
    sha = hashlib.sha256()
    for p in parts:
        sha.update(p)
    return sha.hexdigest()


def output_digests(outputs: DataFrame, id: str = "doc_id") -> DataFrame:
    """The rows of ``fill_in_middle`` with ``output_sha256``, and ``restored_sha256`` of the text rebuilt from the
    output and its form, instead of the output."""
    rows = outputs.withColumnRenamed(id, "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, again = [], []
            for form, frames in zip(batch["form"], batch["output"]):
                data = frames.as_py()
                made.append(_digest(stream(data)))
                again.append(_digest(restore(data, form.as_py())))
            kept = batch.drop_columns(["output"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(made), pa.array(again)], names=[*kept.schema.names, "output_sha256", "restored_sha256"])

    schema = "_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id)
