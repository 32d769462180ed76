"""Line dedup over the whole table, returned as keep bitmaps.

Every document gives one row per distinct key of its lines. The rows are written down once, range-partitioned by
(key hash, document descending, positions) and sorted; a task streams its keys, so a key is seen from its
largest document down: that one keeps its lines, the later ones drop theirs once the key turns out to be
in ``min_docs`` documents. A key of any frequency is cut over as many range partitions as its rows need:
the runs at a partition's two ends leave at most ``min_docs`` undecided rows each, which are settled
together afterwards. Positions that are dropped are gathered per document into a bitmap; no text moves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.text import slices
from pairloom.session import store

STRIP = " \t\n\x0b\x0c\r"
FOLD = {i: i + 32 for i in range(65, 91)}
STREAMED = ["open", "k1", "k2", "doc", "th", "lines", "extra"]
ROW = "k1 long, k2 long, doc long, th long, lines binary"


def text_key() -> F.Column:
    """Tells documents of one id but different texts apart; with the id it is a row's key."""
    return F.xxhash64(F.coalesce(F.col("_text"), F.lit("")))


def line_key(line: str) -> str:
    return line.strip(STRIP).translate(FOLD)


def _key_rows(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in slices(batches, "_text"):
            out: list[tuple] = []
            for doc, th, text in zip(batch["_id"].to_pylist(), batch["_th"].to_pylist(), batch["_text"].to_pylist()):
                if doc is None or not text or len(text) < min_chars:
                    continue
                found: dict[str, list[int]] = {}
                for i, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
                        found.setdefault(key, []).append(i)
                for key, at in found.items():
                    h = xxhash.xxh3_128_digest(key.encode())
                    out.append((int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), doc, th, np.array(at, np.uint32).tobytes()))
            if out:
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.int64()), pa.array(c[4], pa.binary())],
                    names=["k1", "k2", "doc", "th", "lines"],
                )

    return run


def _stream(min_docs: int):
    """Over a partition sorted by (key, document descending): rows to drop (``open`` false), and of the
    runs at the partition's ends, which may go on elsewhere, what is not yet certain: the first document,
    and the others while they are fewer than ``min_docs``. ``extra`` counts the run's dropped documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        key, edge, held, docs, gone = None, True, [], 0, 0
        keeper = last = None

        def close(at_end: bool) -> None:
            if key is not None and (edge or at_end):
                for i, (doc, th, lines) in enumerate(held):
                    out.append((True, *key, doc, th, lines, gone if i == 0 else 0))

        for f in frames:
            for k1, k2, doc, th, lines in zip(f.k1.to_numpy(), f.k2.to_numpy(), f.doc.to_numpy(), f.th.to_numpy(), f.lines):
                if (k1, k2) != key:
                    if key is not None:
                        close(False)
                        edge = False
                    key, held, docs, gone, keeper, last = (k1, k2), [], 0, 0, doc, None
                if doc != last:
                    docs, last = docs + 1, doc
                    gone += docs > min_docs
                if doc == keeper or docs < min_docs:
                    held.append((doc, th, lines))
                    continue
                if docs == min_docs and gone == 0:  # now the key is frequent: all but the keeper go
                    out.extend((False, *key, *h, 0) for h in held if h[0] != keeper)
                    held, gone = [h for h in held if h[0] == keeper], min_docs - 1
                out.append((False, *key, doc, th, lines, 0))
            if len(out) >= 5000:
                yield pd.DataFrame(out, columns=STREAMED)
                out.clear()
        close(True)
        if out:
            yield pd.DataFrame(out, columns=STREAMED)

    return run


def _bitmap(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        bitmaps, counts = [], []
        for n, parts in zip(f.n_lines, f.lines):
            keep = np.ones(n, np.uint8)
            if parts is not None:
                for p in parts:
                    keep[np.frombuffer(p, np.uint32)] = 0
            bitmaps.append(zlib.compress(np.packbits(keep).tobytes()))
            counts.append(int(n - keep.sum()))
        yield pd.DataFrame({"_id": f["_id"], "_th": f["_th"], "n_lines": f.n_lines, "n_dropped": counts, "keep": bitmaps})


def line_keep_bitmaps(df: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per (id, text) with ``n_lines`` long, ``n_dropped`` long and ``keep`` binary: a
    zlib-compressed bitmap, one bit per line, most significant bit first, 1 to keep.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased. Keys of
    ``min_chars`` code points or more that are in ``min_docs`` documents or more lose all lines except
    those in the largest document. Rows of one id are one document. A null id joins no group and keeps all
    its lines; a null or empty text is one empty line. Further columns are ignored. Keys are compared by
    their 128-bit hash.
    """
    docs = df.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text")).withColumn("_th", text_key())
    dropped = _dropped(docs, min_chars, min_docs)
    rows = docs.select("_id", "_th", (F.regexp_count(F.coalesce("_text", F.lit("")), F.lit("\n")) + 1).cast("bigint").alias("n_lines"))
    rows = rows.join(dropped, (F.col("_id") == F.col("doc")) & (F.col("_th") == F.col("th")), "left").select("_id", "_th", "n_lines", "lines")
    out = rows.mapInPandas(_bitmap, "_id long, _th long, n_lines long, n_dropped long, keep binary")
    return out.select(F.col("_id").alias(id), F.col("_th").alias("text_hash"), "n_lines", "n_dropped", "keep")


def _dropped(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """Per (doc, th) the positions of its dropped lines, as the pieces they came in."""
    keys = store(docs.mapInArrow(_key_rows(min_chars), ROW))  # read twice: for the borders and for the rows
    # range borders are set on (key, document), so all rows of one document and key stay together
    ranged = keys.repartitionByRange("k1", "k2", F.desc("doc")).sortWithinPartitions("k1", "k2", F.desc("doc"), "th")
    streamed = store(ranged.mapInPandas(_stream(min_docs), "open boolean, k1 long, k2 long, doc long, th long, lines binary, extra long"))
    ends = streamed.where("open")  # a few rows per partition
    total = ends.groupBy("k1", "k2").agg((F.count_distinct("doc") + F.sum("extra")).alias("n"), F.max("doc").alias("keeper"))
    late = ends.join(total.where(F.col("n") >= min_docs), ["k1", "k2"]).where(F.col("doc") != F.col("keeper"))
    gone = streamed.where("not open").select("doc", "th", "lines").unionByName(late.select("doc", "th", "lines"))
    return gone.groupBy("doc", "th").agg(F.collect_list("lines").alias("lines"))  # within one document


def apply_bitmap(text: str | None, keep: bytes, n_lines: int) -> str:
    """The kept lines of a text, joined by newlines."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines)
    return "\n".join(line for line, k in zip((text or "").split("\n"), bits) if k)
