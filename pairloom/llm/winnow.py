"""Document fingerprints by winnowing, and the comparison of each document with its successor.

All k-byte grams get a rolling hash; of every window of ``w`` successive hashes the smallest is chosen,
the rightmost one on ties, and each chosen place is kept once, with its position. Two texts that share a
run of ``w + k - 1`` bytes therefore share a fingerprint, and nothing shorter than ``k`` bytes matches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.text import U64, Powers, kgram_hashes, slices, sliding_min

K, W = 16, 48
LEAST_BUCKETS, MOST_BUCKETS, BUCKET_ROWS = 64, 50_000, 2_000


def fingerprints(data: np.ndarray, offs: np.ndarray, powers: Powers, k: int = K, w: int = W) -> list[tuple[np.ndarray, np.ndarray]]:
    """(32-bit hashes, byte positions) of every row of a slice, in the order of positions.

    A text shorter than ``k`` bytes is hashed whole; an empty one has no fingerprint. A text with fewer
    than ``w`` grams is one window.
    """
    h = kgram_hashes(data, k, powers) >> U64(32)
    n = len(h)
    # hash above, distance from the end below: the minimum is the smallest hash and of equal ones the rightmost
    key = (h << U64(32)) | (U64(0xFFFFFFFF) - np.arange(n, dtype=U64))
    best = sliding_min(key, w)
    out = []
    for a, b in zip(offs[:-1], offs[1:]):
        grams = b - a - k + 1
        if b == a:
            chosen = key[:0]
        elif grams <= 0:
            piece = np.concatenate((data[a:b], np.full(k - (b - a), 0, np.uint8)))
            out.append((((kgram_hashes(piece, k, powers) >> U64(32)) ^ U64(b - a)).astype(np.uint32), np.zeros(1, np.int64)))
            continue
        elif grams < w:
            chosen = key[a : a + grams].min(keepdims=True)
        else:
            m = best[a : b - k - w + 2]
            chosen = m[np.concatenate(([True], m[1:] != m[:-1]))]
        out.append(((chosen >> U64(32)).astype(np.uint32), (U64(0xFFFFFFFF) - (chosen & U64(0xFFFFFFFF))).astype(np.int64) - a))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two hash sets; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def as_hex(a: np.ndarray) -> str:
    return a.astype(">u4").tobytes().hex()


def winnow(df: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """``id``, ``hashes`` array of long and ``positions`` array of int (byte offsets) of every row.

    Null and empty texts have empty arrays; equal texts have equal arrays, whatever their rows and batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch, data, offs in slices(batches, "_text"):
            found = fingerprints(data, offs, powers, k, w)
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], pa.array([f[0].astype(np.int64) for f in found], pa.list_(pa.int64())), pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32()))],
                names=["_id", "hashes", "positions"],
            )

    rows = df.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id long, hashes array<long>, positions array<int>").withColumnRenamed("_id", id)


NEIGHBOURS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def _walk(k: int, w: int, most_chars: int = 1_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        held: list[tuple] = []  # bucket, copy, id, text

        def flush() -> pa.RecordBatch:
            found = fingerprints(*_joined([r[3] for r in held]), powers, k, w)
            own = [i for i in range(len(held) - 1) if not held[i][1] and held[i][0] == held[i + 1][0]]
            edited = []
            for i in own:
                t = held[i][3]
                half = len(t) // 2
                edited.append(t[: len(t) - half] + held[i + 1][3][:half])
            changed = fingerprints(*_joined(edited), powers, k, w)
            cols = [
                [held[i][2] for i in own],
                [len(held[i][3]) for i in own],
                [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                [as_hex(found[i][0]) for i in own],
                [as_hex(c[0]) for c in changed],
                [likeness(found[i][0], c[0]) for i, c in zip(own, changed)],
                [likeness(found[i][0], found[i + 1][0]) for i in own],
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[f.split()[0] for f in NEIGHBOURS.split(", ")])

        size = 0
        for batch in batches:
            for row in zip(batch["_bucket"].to_pylist(), batch["_copy"].to_pylist(), batch["_id"].to_pylist(), batch["_text"].to_pylist()):
                held.append(row)
                size += len(row[3])
                if size >= most_chars and len(held) > 1:
                    yield flush()
                    held, size = held[-1:], len(held[-1][3])
        if len(held) > 1:
            yield flush()

    return run


def compare_with_next(df: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Every document against an edited copy of itself and against the next document by descending id.

    Rows are put in buckets of neighbouring ids (quantiles, between 64 and 50,000 of them), sorted there and
    streamed; each bucket gets a copy of the document that follows its last one, so text is shuffled once.
    Null texts are empty; a null id comes last; rows of one id follow each other by text. One row is its
    own successor. Columns of other names are ignored.
    """
    rows = df.select(
        F.col(id).cast("bigint").alias("_id"),
        F.coalesce(F.col(id).cast("bigint"), F.lit(-(1 << 63))).alias("_ord"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"),
    )
    n, = rows.agg(F.count("*")).first()
    spark = df.sparkSession
    if not n:
        return spark.createDataFrame([], NEIGHBOURS)
    count = max(LEAST_BUCKETS, min(MOST_BUCKETS, n // BUCKET_ROWS))
    keyed = rows.withColumn("_key", F.col("_ord").cast("double"))
    cuts = sorted(set(keyed.agg(F.percentile_approx("_key", [i / count for i in range(1, count)], 20 * count)).first()[0]))
    put = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_key", outputCol="_bucket")
    placed = put.transform(keyed).withColumn("_bucket", F.col("_bucket").cast("int")).drop("_key")
    heads = sorted((r._bucket, r.head) for r in placed.groupBy("_bucket").agg(F.max("_ord").alias("head")).collect())  # a row per bucket
    follows = [(b, heads[i - 1][1]) for i, (b, _) in enumerate(heads)]  # the bucket below; below the lowest, the highest
    table = F.broadcast(spark.createDataFrame(follows, "_to int, _head long"))
    copies = placed.join(table, F.col("_ord") == F.col("_head")).select("_id", "_ord", "_text", F.col("_to").alias("_bucket"), F.lit(True).alias("_copy"))
    spread = placed.withColumn("_copy", F.lit(False)).unionByName(copies).repartition(len(heads), "_bucket")
    ordered = spread.sortWithinPartitions("_bucket", "_copy", F.desc("_ord"), "_text")
    return ordered.mapInArrow(_walk(k, w), NEIGHBOURS)
