"""Near copies by many universal hash minima, banding, checked signatures and stars.

A document's set is that of its distinct two-word shingles. Documents of equal sets are one class, named by a hash of
the set. A class is signed by the minima of ``BANDS * ROWS`` hash functions ``(a x + b) mod 2^64 div 2^32`` over 32-bit
shingle keys, a universal family. ``ROWS`` minima make a band; classes that share a band are candidates. With 48 bands
of six, two sets of similarity 0.8 share none once in two million pairs, and sets of similarity 0.2 share one in 325.

* A band that many classes share is not expanded into pairs. Each class is first tied to the band's smallest class;
  these pairs are checked, and what links becomes one component. Then only pairs of different components that
  share a band are candidates, by blocks of classes that meet in tasks of their own. A pair is looked at in its first
  common band, and counted there; only links that join components leave a task.
* Signatures are checked before sets: of the minima, kept to eight bits each, so many must agree that a pair of
  similarity 0.8 fails with a probability of about 1e-9 (six standard deviations), and the sizes must allow the overlap.
* What is left is counted on whole sets. The text of a band's smallest class is sent once to every ``FAN_OUT`` of its
  partners, and partners stream past it; texts travel compressed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.components import components
from pairloom.llm.text import U64, Powers, mix, shingle_sets, slices, words_of
from pairloom.session import broadcast_if_small, store

BANDS, ROWS, WORDS = 48, 6, 2
FAN_OUT, BLOCK = 2_000, 512
SCAN = "id long, th long, n long, ent long, bands array<bigint>, sig binary"


def hash_family(k: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """``k`` pairs (a, b) of the multiply-shift family, a odd."""
    x = mix(np.arange(1, 2 * k + 1, dtype=U64) + U64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    return x[:k] | U64(1), x[k:]


def minima(sets: list[np.ndarray], family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """(sets x functions) 32-bit minima; sets are not empty."""
    keys = np.concatenate(sets) >> U64(32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(family[0])), np.uint32)
    for j, (a, b) in enumerate(zip(*family)):
        out[:, j] = np.minimum.reduceat(((keys * a + b) >> U64(32)).astype(np.uint32), starts)
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(sets x bands) 64-bit keys, each from its band's minima and number."""
    key = np.tile(np.arange(1, bands + 1, dtype=U64) * U64(0x9E3779B97F4A7C15), (len(sig), 1))
    parts = sig.reshape(len(sig), bands, rows).astype(U64)
    for r in range(rows):
        key = mix(key ^ (parts[:, :, r] + U64((r + 1) * 0xD6E8FEB86659FD93 % (1 << 64))))
    return key


def _name(s: np.ndarray) -> int:
    """Name of a set: a hash of its members, whatever their order; 0 only for the empty set."""
    if not len(s):
        return 0
    return int(mix(np.array([(int(mix(s).sum()) + len(s) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF], U64)).view(np.int64)[0]) or 1


def _scan(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, family, known = Powers(), hash_family(bands * rows), set()
        for batch, data, offs in slices(batches, "_text"):
            _, _, doc, h = words_of(data, offs, powers)
            sets = shingle_sets(h, doc, len(batch), words)
            names = [_name(s) for s in sets]
            keys, sigs = [None] * len(sets), [None] * len(sets)
            fresh = []
            for i, e in enumerate(names):
                if e and e not in known:
                    fresh.append(i)
                    if len(known) < 1_000_000:  # a class is signed once per task; past that number again, and told apart later
                        known.add(e)
            if fresh:
                m = minima([sets[i] for i in fresh], family)
                low = (m & 0xFF).astype(np.uint8)
                for i, k, s in zip(fresh, band_keys(m, bands, rows).view(np.int64), low):
                    keys[i], sigs[i] = k, s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_th"], pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                names=["id", "th", "n", "ent", "bands", "sig"],
            )

    return run


def least_agreement(share: tuple[int, int], k: int) -> int:
    """How many of ``k`` minima must agree: six standard deviations below what the similarity gives."""
    j = share[0] / share[1]
    return math.floor(k * (j - 6 * math.sqrt(j * (1 - j) / k)))


def _agree(share: tuple[int, int]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x, y = (np.frombuffer(b"".join(f[c]), np.uint8).reshape(len(f), -1) for c in ("sig", "sig_b"))
                yield f.loc[(x == y).sum(axis=1) >= least_agreement(share, x.shape[1]), ["a", "b"]]

    return run


def _fits(na, nb, share: tuple[int, int]):
    """Sizes that allow the similarity: the smaller set may lie in the larger."""
    return (na * share[1] >= nb * share[0]) & (nb * share[1] >= na * share[0])


def _signed(pairs: DataFrame, classes: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b) pairs of classes whose sizes and signatures allow the similarity."""
    a = classes.select(F.col("ent").alias("a"), F.col("n").alias("na"), "sig")
    b = classes.select(F.col("ent").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sig_b"))
    met = pairs.join(a, "a").join(b, "b").where(_fits(F.col("na"), F.col("nb"), share))
    return met.select("a", "b", "sig", "sig_b").mapInPandas(_agree(share), "a long, b long")


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch, data, offs in slices(batches, "_text"):
        texts = [pack(data[a:b].tobytes()) for a, b in zip(offs[:-1], offs[1:])]
        yield pa.RecordBatch.from_arrays([batch["ent"], pa.array(texts, pa.binary())], names=["ent", "text"])


def _count(share: tuple[int, int], words: int, most: int = 500_000):
    """Streams hubs, each followed by its partners, and gives the linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, unpack = Powers(), zstandard.ZstdDecompressor().decompress
        hub, salt, own = None, None, None
        for batch in batches:
            heads, salts, ents, texts = (batch[c] for c in ("hub", "salt", "ent", "text"))
            at = 0
            while at < len(batch):
                raws, size = [], 0
                while at + len(raws) < len(batch) and (not raws or size < most):
                    raws.append(unpack(texts[at + len(raws)].as_py()))
                    size += len(raws[-1])
                offs = np.cumsum([0, *map(len, raws)])
                _, _, doc, h = words_of(np.frombuffer(b"".join(raws), np.uint8), offs, powers)
                out: list[tuple[int, int]] = []
                for i, s in enumerate(shingle_sets(h, doc, len(raws), words), at):
                    key, part, ent = heads[i].as_py(), salts[i].as_py(), ents[i].as_py()
                    if ent is None:
                        hub, salt, own = key, part, s
                        continue
                    if (key, part) != (hub, salt):
                        raise ValueError("partners without their hub")
                    common = len(np.intersect1d(own, s, assume_unique=True))
                    if common * share[1] >= (len(own) + len(s) - common) * share[0]:
                        out.append((key, ent))
                at += len(raws)
                if out:
                    c = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64())], names=["a", "b"])

    return run


def _texts(wanted: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(ent, text): the compressed text of one row of each class."""
    chosen = broadcast_if_small(reps.join(wanted, "ent", "left_semi"))
    return store(docs.join(chosen, F.xxhash64("_id", "_th") == F.col("rep")).select("ent", "_text").mapInArrow(_zip, "ent long, text binary").dropDuplicates(["ent"]))


def _linked(pairs: DataFrame, docs: DataFrame, reps: DataFrame, share: tuple[int, int], words: int) -> DataFrame:
    """The (a, b) pairs that are similar by their whole sets. ``a`` is the hub: its text goes once to each group of
    about ``FAN_OUT`` of its partners."""
    pairs = store(pairs.dropDuplicates(["a", "b"]))
    texts = _texts(pairs.select(F.col("a").alias("ent")).unionByName(pairs.select(F.col("b").alias("ent"))).distinct(), docs, reps)
    salts = broadcast_if_small(pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN_OUT).alias("of")))
    dealt = store(pairs.join(salts, "a").select(F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), "of").alias("salt"), F.col("b").alias("ent")))
    partners = dealt.join(texts, "ent").select("hub", "salt", "ent", "text")
    hubs = dealt.select("hub", "salt").distinct().join(texts, F.col("hub") == F.col("ent")).select("hub", "salt", F.lit(None).cast("bigint").alias("ent"), "text")
    ordered = hubs.unionByName(partners).repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("ent").asc_nulls_first())
    return ordered.mapInArrow(_count(share, words), "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows of equal keys from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        new = np.zeros(len(batch), bool)
        for c in keys:
            x = batch[c].to_numpy(zero_copy_only=False)
            new[1:] |= x[1:] != x[:-1]
        new[0] = bool(held) and any(held[-1][c][0].as_py() != batch[c][0].as_py() for c in keys)
        cuts = [0, *[i for i in np.flatnonzero(new).tolist() if i], len(batch)]
        if new[0]:
            yield pa.Table.from_batches(held)
            held = []
        for i, j in zip(cuts[:-1], cuts[1:]):
            if i:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


class _Sets:
    """Whole sets of a group's texts, made when asked for and kept up to ``most`` bytes."""

    def __init__(self, texts: pa.ChunkedArray, words: int, powers: Powers, most: int = 64 << 20):
        self.texts, self.words, self.powers, self.most = texts, words, powers, most
        self.kept: dict[int, np.ndarray] = {}
        self.size = 0

    def __getitem__(self, i: int) -> np.ndarray:
        if i not in self.kept:
            raw = zstandard.ZstdDecompressor().decompress(self.texts[i].as_py())
            _, _, doc, h = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), self.powers)
            found = shingle_sets(h, doc, 1, self.words)[0]
            if self.size > self.most:
                self.kept, self.size = {}, 0
            self.kept[i] = found
            self.size += found.nbytes
        return self.kept[i]


GROUP = ("key", "lb", "rb")


def _within(share: tuple[int, int], words: int, confirm: bool):
    """Pairs of a group of blocks that lie in different components, whose sizes and signatures allow the similarity and that
    meet in no earlier band. Gives the classes that have such a partner or, with ``confirm``, links counted on whole
    sets; a pair whose components an earlier link of the group has joined needs no count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for g in _groups(batches, GROUP):
            key, lb, rb = (g[c][0].as_py() for c in GROUP)
            ent, n, comp, part = (g[c].to_numpy() for c in ("ent", "n", "comp", "part"))
            sig = np.frombuffer(b"".join(g["sig"].to_pylist()), np.uint8).reshape(len(g), -1)
            bands = g["bands"].combine_chunks().flatten().to_numpy().reshape(len(g), -1)
            least, joined = least_agreement(share, sig.shape[1]), {}
            sets = _Sets(g["text"], words, powers) if confirm else None

            def root(c: int) -> int:
                while c in joined:
                    c = joined[c]
                return c

            hits, links = np.zeros(len(g), bool), []
            first, second = np.flatnonzero(part == lb), np.flatnonzero(part == rb)
            for at, i in enumerate(first.tolist()):
                j = first[at + 1 :] if lb == rb else second
                j = j[(comp[j] != comp[i]) & _fits(n[i], n[j], share)]
                j = j[(sig[j] == sig[i]).sum(axis=1) >= least] if len(j) else j
                if not len(j):
                    continue
                j = j[bands[i][(bands[j] == bands[i]).argmax(axis=1)] == key]
                if not confirm:
                    hits[i] |= bool(len(j))
                    hits[j] = True
                    continue
                for k in j.tolist():
                    a, b = root(int(comp[i])), root(int(comp[k]))
                    if a == b:
                        continue
                    x, y = sets[i], sets[k]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if common * share[1] >= (len(x) + len(y) - common) * share[0]:
                        joined[a] = b
                        links.append((int(ent[i]), int(ent[k])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])
            elif hits.any():
                yield g.select([*GROUP, "part", "ent"]).filter(pa.array(hits)).combine_chunks().to_batches()[0]

    return run


def _crossing(shared: DataFrame, classes: DataFrame, roots: DataFrame, docs: DataFrame, reps: DataFrame, share: tuple[int, int], words: int) -> DataFrame:
    """(a, b) links between components, found in the bands they share. A band of many classes is cut into blocks; each two
    blocks that hold different components meet in a task. Signatures are compared first; only classes that pass bring their texts. What comes out are
    links that join components, so it does not grow with the pairs compared."""
    comps = roots.select(F.col("a").alias("ent"), F.col("b").alias("comp"))
    members = shared.join(comps, "ent", "left").withColumn("comp", F.coalesce("comp", "ent"))
    counts = members.groupBy("key", "comp").agg(F.count("*").alias("c"))
    of_key = counts.groupBy("key").agg(F.count("*").alias("comps"), F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("t")).where("comps > 1")
    whole = F.col("m") <= BLOCK
    minors = F.when(whole, 1).otherwise(F.ceil((F.col("m") - F.col("t.c")) / BLOCK))
    mixed = of_key.select("key", F.col("t.comp").alias("top"), minors.cast("bigint").alias("p"), F.when(whole, 0).otherwise(F.ceil(F.col("t.c") / BLOCK)).cast("bigint").alias("t"))
    # the largest component of a large band has parts of its own, which meet the others' but not each other
    of_top, hashed = (F.col("t") > 0) & (F.col("comp") == F.col("top")), F.xxhash64("ent")
    part = F.when(of_top, F.col("p") + F.pmod(hashed, "t")).otherwise(F.pmod(hashed, "p"))
    others = F.sequence(F.lit(0).cast("bigint"), F.when(of_top, F.col("p") - 1).otherwise(F.col("p") + F.col("t") - 1))
    copies = members.join(mixed, "key").withColumn("part", part).withColumn("other", F.explode(others))
    copies = store(copies.select("key", F.least("part", "other").alias("lb"), F.greatest("part", "other").alias("rb"), "part", "ent", "comp"))
    signed = copies.join(classes.select("ent", "n", "bands", "sig"), "ent")
    by_group = lambda rows: rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "ent")
    near = store(by_group(signed).mapInArrow(_within(share, words, False), "key long, lb long, rb long, part long, ent long"))
    texts = _texts(near.select("ent").distinct(), docs, reps)
    whole = near.join(comps, "ent", "left").withColumn("comp", F.coalesce("comp", "ent")).join(classes.select("ent", "n", "bands", "sig"), "ent").join(texts, "ent")
    return by_group(whole).mapInArrow(_within(share, words, True), "a long, b long")


def near_copies(
    df: DataFrame, id: str = "doc_id", text: str = "text", share: tuple[int, int] = (4, 5), words: int = WORDS, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; the set is that of distinct runs of ``words``
    words, of a shorter text its whole sequence. Rows are linked when ``intersection / union >= share[0] / share[1]``;
    the component's id is its smallest id, and the row with that id is kept. Null, empty and blank texts have no shingles
    and stand alone. A null id is linked like any other but never names a component (null only where no row of it has
    an id, and only then kept). Repeated rows are linked with, and kept like, each other. Other columns are ignored.
    """
    docs = df.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text")).withColumn("_th", F.xxhash64(F.coalesce("_text", F.lit(""))))
    scanned = store(docs.select("_id", "_th", "_text").mapInArrow(_scan(words, bands, rows), SCAN))
    sets = scanned.select("id", "th", "n", "ent")
    classes = store(scanned.where("sig is not null").select("ent", "n", "bands", "sig").dropDuplicates(["ent"]))
    shared = classes.select("ent", F.explode("bands").alias("key"))
    pivots = shared.groupBy("key").agg(F.min("ent").alias("hub"), F.max("ent").alias("last")).where("hub < last").select("key", "hub")
    shared = store(shared.join(pivots, "key"))
    stars = store(shared.where("ent <> hub").select(F.col("hub").alias("a"), F.col("ent").alias("b")).distinct())
    reps = store(sets.where("n > 0").groupBy("ent").agg(F.min(F.xxhash64("id", "th")).alias("rep")))  # a row for each class
    roots = components(store(_linked(_signed(stars, classes, share), docs, reps, share, words)))
    second = store(_crossing(shared.drop("hub"), classes, roots, docs, reps, share, words))
    links = components(roots.unionByName(second))
    own = sets.where("n > 0").join(links.select(F.col("a").alias("ent"), F.col("b").alias("root")), "ent", "left").withColumn("root", F.coalesce("root", "ent"))
    least = broadcast_if_small(own.groupBy("root").agg(F.min("id").alias("component_id")))
    found = own.join(least, "root").select("id", F.col("n").alias("n_shingles"), "component_id")
    alone = sets.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id)
