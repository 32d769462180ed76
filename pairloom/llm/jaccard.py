"""Exact n-gram Jaccard join by vertical partitioning, and the components of its links.

A document's set is that of its distinct five-word shingles, as 64-bit hashes. Documents of equal sets are
one class, named by a hash of the set. All shingles have one global order: by how often their bucket of a
count sketch of the whole corpus is hit, then by hash. The order is cut into fragments (frequency class and
hash range); a fragment meets in one task.

* Two sets with a similarity of 0.8 or more share a shingle among the first fifth of either in the order. So
  only these prefixes are sent to the fragments, packed, equal sets once per task. Of the sets that share a
  shingle, those that pass the length and positional bounds at it are candidates: a linked pair always
  passes at the first shingle it shares.
* A list of many sets is not expanded into pairs. Each is first tied to the list's pivot, the one with the
  fewest rarer shingles; these pairs are counted, and what links becomes one component. Then only pairs of
  different components are candidates. No link between components is lost, and within a component none is needed.
* A list longer than a block is cut into blocks that meet in tasks of their own. Of a pair that passes the bounds,
  the smaller set stands so early in the order that it reaches past its own size; only such sets are compared, and
  only with sizes they reach, so a list of sets that share a late shingle needs no comparison at all.
* Candidates are counted exactly: both sets are cut at fragment borders, each fragment counts its common
  shingles by itself, and the partial counts are summed per pair.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm.components import components
from pairloom.llm.text import U64, Powers, mix, shingle_sets, slices, words_of
from pairloom.session import broadcast_if_small, store

SKETCH_BITS, STRIPES = 22, 64
LEAST_FRAGMENTS, FRAGMENT_SHINGLES = 64, 4_000_000
COUNTING_FRAGMENTS = 4
LIST_BLOCK = 1024
FAN_OUT = 2_000
PASS_A = "kind int, id long, th long, n long, ent long, stripe int, counts binary"


def _sets(batches: Iterator[pa.RecordBatch], powers: Powers) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch, data, offs in slices(batches, "_text"):
        _, _, doc, h = words_of(data, offs, powers)
        yield batch, shingle_sets(h, doc, len(batch))


def _ent(s: np.ndarray) -> int:
    """Name of a set: a hash of its members, whatever their order; 0 only for the empty set."""
    if not len(s):
        return 0
    return int(mix(np.array([(int(mix(s).sum()) + len(s) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF], U64)).view(np.int64)[0]) or 1


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (kind 0: id, set size, set name) and, last, the task's shingle counts (kind 1) by stripes."""
    powers, sketch = Powers(), np.zeros(1 << SKETCH_BITS, np.uint32)

    def rows(kind, id, th, n, ent, stripe, counts):
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((kind, id, th, n, ent, stripe, counts), kinds)], names=[c.split()[0] for c in PASS_A.split(", ")])

    seen, held, size = False, [], 0

    def count() -> None:
        where, n = np.unique(np.concatenate(held) >> U64(64 - SKETCH_BITS), return_counts=True)
        sketch[where.astype(np.int64)] += n.astype(np.uint32)

    for batch, sets in _sets(batches, powers):
        m = len(sets)
        held += sets
        size += sum(map(len, sets))
        if size > 300_000:
            count()
            seen, held, size = True, [], 0
        yield rows([0] * m, batch["_id"].to_pylist(), batch["_th"].to_pylist(), [len(s) for s in sets], [_ent(s) for s in sets], [None] * m, [None] * m)
    if size:
        count()
    if seen or size:
        parts = [(i, zlib.compress(p.astype(np.uint8).tobytes() if p.max() < 256 else b"L" + p.tobytes(), 1)) for i, p in enumerate(np.split(sketch, STRIPES))]
        k = len(parts)
        yield rows([1] * k, [None] * k, [None] * k, [None] * k, [None] * k, [i for i, _ in parts], [c for _, c in parts])


def _add_stripes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    size, total = (1 << SKETCH_BITS) // STRIPES, {}
    for f in frames:
        for i, packed in zip(f.stripe, f.counts):
            raw = zlib.decompress(packed)
            part = np.frombuffer(raw, np.uint8) if len(raw) == size else np.frombuffer(raw[1:], np.uint32)
            total[i] = total.get(i, 0) + part.astype(np.int64)
    if total:
        yield pd.DataFrame({"stripe": list(total), "counts": [np.minimum(t, 2**32 - 1).astype(np.uint32).tobytes() for t in total.values()]})


def _prefix_rows(sketch, heavy: int, fragments: int, share: tuple[int, int]):
    """Packed prefixes by fragment: of each set its name, size and prefix shingles with their places."""
    light = fragments - fragments // 4  # most prefix shingles are light

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, counts, known = Powers(), sketch.value, set()
        held: list[tuple] = []
        size = 0

        def pack() -> pa.RecordBatch:
            ents = np.array([e for e, *_ in held], np.int64)
            n = np.array([k for _, k, *_ in held], np.int64)
            token = np.concatenate([t for _, _, t, _, _ in held])
            count = np.concatenate([c for _, _, _, c, _ in held])
            place = np.concatenate([p for *_, p in held])
            of = np.repeat(np.arange(len(held)), [len(t) for _, _, t, _, _ in held])
            low = (token >> U64(32)).astype(np.int64)
            frag = np.where(count <= heavy, (low * light) >> 32, light + ((low * (fragments - light)) >> 32))
            order = np.argsort(frag, kind="stable")
            cut = np.searchsorted(frag[order], np.arange(fragments + 1))
            out_f, out_b = [], []
            for f in np.flatnonzero(np.diff(cut)):
                j = order[cut[f] : cut[f + 1]]
                sets, which = np.unique(of[j], return_inverse=True)
                head = np.array([len(sets), len(j)], np.int64).tobytes()
                out_f.append(int(f))
                out_b.append(b"".join((head, ents[sets].tobytes(), n[sets].astype(np.uint32).tobytes(), which.astype(np.uint32 if len(sets) > 65535 else np.uint16).tobytes(), place[j].astype(np.uint32).tobytes(), count[j].astype(np.uint32).tobytes(), token[j].tobytes())))
            return pa.RecordBatch.from_arrays([pa.array(out_f, pa.int32()), pa.array(out_b, pa.binary())], names=["frag", "packed"])

        for _, sets in _sets(batches, powers):
            for s in sets:
                if not len(s):
                    continue
                e = _ent(s)
                if e in known:
                    continue
                if len(known) < 1_000_000:  # equal sets once; past that number they are told apart later
                    known.add(e)
                c = counts[(s >> U64(64 - SKETCH_BITS)).astype(np.int64)]
                keep = len(s) - -(-share[0] * len(s) // share[1]) + 1
                first = np.lexsort((s, c))[:keep] if keep < len(s) else np.lexsort((s, c))
                held.append((e, len(s), s[first], c[first], np.arange(len(first))))
                size += len(first)
            if size > 400_000:
                yield pack()
                held.clear()
                size = 0
        if held:
            yield pack()

    return run


def _unpack(raw: bytes) -> tuple[np.ndarray, ...]:
    m, k = np.frombuffer(raw, np.int64, 2)
    at = 16
    out = []
    for kind, n in ((np.int64, m), (np.uint32, m), (np.uint32 if m > 65535 else np.uint16, k), (np.uint32, k), (np.uint32, k), (np.uint64, k)):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    ents, sizes, which, place, count, token = out
    return token, count, place.astype(np.int64), ents[which], sizes[which].astype(np.int64)


def can_link(na, pa_, nb, pb, share: tuple[int, int]):
    """Bounds at a shared shingle that stands at places ``pa_`` and ``pb`` of sets of ``na`` and ``nb``: what is
    left from there on must reach the overlap that the similarity asks for."""
    rest = np.minimum(na - pa_, nb - pb)
    return rest * (share[0] + share[1]) >= share[0] * (na + nb)


LISTS = "key long, ord1 long, ord2 long, ents binary, sizes binary, places binary"


def _lists(frame: pd.DataFrame) -> pd.DataFrame:
    """Sets that share a prefix shingle, one list per distinct group of sets of this fragment (at its first shingle)."""
    parts = [_unpack(r) for r in frame.packed]
    token, count, place, ent, n = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((ent, token))
    token, count, place, ent, n = token[order], count[order], place[order], ent[order], n[order]
    new = np.concatenate(([True], (token[1:] != token[:-1]) | (ent[1:] != ent[:-1])))
    token, count, place, ent, n = token[new], count[new], place[new], ent[new], n[new]
    start = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    end = np.append(start[1:], len(token))
    many = end - start > 1
    start, end = start[many], end[many]
    if not len(start):
        return pd.DataFrame({c.split()[0]: [] for c in LISTS.split(", ")})
    hashed = np.concatenate(([U64(0)], np.cumsum(mix(ent.view(U64)))))
    key = mix(hashed[end] - hashed[start] + (end - start).astype(U64))
    by = np.lexsort((token[start], count[start], key))
    first = np.concatenate(([True], key[by][1:] != key[by][:-1]))
    keep = by[first]
    spans = list(zip(start[keep], end[keep]))
    return pd.DataFrame(
        {
            "key": key[keep].view(np.int64), "ord1": count[start[keep]].astype(np.int64), "ord2": (token[start[keep]] >> U64(1)).astype(np.int64),
            "ents": [ent[a:b].tobytes() for a, b in spans], "sizes": [n[a:b].astype(np.uint32).tobytes() for a, b in spans],
            "places": [place[a:b].astype(np.uint32).tobytes() for a, b in spans],
        }
    )


def _read_list(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(r[0], np.int64), np.frombuffer(r[1], np.uint32).astype(np.int64), np.frombuffer(r[2], np.uint32).astype(np.int64)


def _ordered(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> pd.DataFrame:
    low = a < b
    return pd.DataFrame({"a": np.where(low, a, b), "na": np.where(low, na, nb), "b": np.where(low, b, a), "nb": np.where(low, nb, na)}).drop_duplicates(["a", "b"])


PAIR = "a long, na long, b long, nb long"


def _stars(share: tuple[int, int]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in zip(f.ents, f.sizes, f.places):
                ent, n, at = _read_list(r)
                hub = np.lexsort((ent, n, at))[0]
                ok = can_link(n, at, n[hub], at[hub], share)
                ok[hub] = False
                out.append((ent[ok], n[ok], np.full(ok.sum(), ent[hub]), np.full(ok.sum(), n[hub])))
            if out:
                yield _ordered(*(np.concatenate(c) for c in zip(*out)))

    return run


def _cross(share: tuple[int, int], block: int = 512):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        ent, n, at, comp = (frame[c].to_numpy(np.int64) for c in ("ent", "n", "place", "comp"))
        order = np.argsort(comp, kind="stable")
        ent, n, at, comp = ent[order], n[order], at[order], comp[order]
        out = []
        for i in range(0, len(ent), block):
            s = slice(i, i + block)
            later = np.searchsorted(comp, comp[s], side="right")  # components after one's own
            j0 = int(later.min())
            if j0 == len(ent):
                continue
            ok = can_link(n[s, None], at[s, None], n[None, j0:], at[None, j0:], share) & (np.arange(j0, len(ent))[None, :] >= later[:, None])
            x, y = np.nonzero(ok)
            out.append((ent[s][x], n[s][x], ent[j0:][y], n[j0:][y]))
        if not out:
            return pd.DataFrame({"a": [], "na": [], "b": [], "nb": []}, dtype="int64")
        return _ordered(*(np.concatenate(c) for c in zip(*out)))

    return run


def _deal(rows: DataFrame) -> DataFrame:
    """Rows of a list's cell in blocks of about ``LIST_BLOCK``: (own, part), ``own`` being the component where it fills
    blocks by itself and 0 (no set's name) for the small components together."""
    counts = store(rows.groupBy("key", "cell", "comp").agg(F.count("*").alias("c")))
    own = F.when(F.col("c") > LIST_BLOCK, F.col("comp")).otherwise(F.lit(0))
    total = counts.groupBy("key", "cell", own.alias("own")).agg(F.sum("c").alias("of"))
    placed = counts.withColumn("own", own).join(total, ["key", "cell", "own"]).select("key", "cell", "comp", "own", F.ceil(F.col("of") / LIST_BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64(F.when(F.col("own") == 0, F.col("comp")).otherwise(F.col("ent"))), "parts")
    return store(rows.join(broadcast_if_small(placed), ["key", "cell", "comp"]).withColumn("part", part).drop("parts"))


BLOCK = ("key", "cell", "own", "part", "own_b", "part_b")


def _meeting(members: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Members of long lists by block pair (``BLOCK``): ``head`` those of the first block, which reach from their size up
    to ``reach``, and the rest of the second, whose size is in the cell. Blocks of one component do not meet."""
    reach = F.expr(f"({share[0] + share[1]} * (n - place) - {share[0]} * n) div {share[0]}")  # the largest partner, see can_link
    cell = lambda n: F.floor(F.log(n.cast("double")) / math.log(share[1] / share[0])) if share[0] < share[1] else n
    rows = members.withColumn("reach", reach)
    ahead = rows.where("reach >= n").withColumn("cell", F.explode(F.sequence(cell(F.col("n")), cell(F.col("reach")))))
    heads = _deal(ahead)
    homes = _deal(rows.withColumn("cell", cell(F.col("n"))))
    second = homes.select("key", "cell", F.col("own").alias("own_b"), F.col("part").alias("part_b")).distinct()
    meets = heads.select("key", "cell", "own", "part").distinct().join(second, ["key", "cell"]).where("own = 0 or own <> own_b")
    meets = broadcast_if_small(meets)
    cols = [*BLOCK, "ent", "n", "place", "comp"]
    first = heads.join(meets, ["key", "cell", "own", "part"]).select(*cols, F.lit(True).alias("head"))
    other = homes.withColumnsRenamed({"own": "own_b", "part": "part_b"}).join(meets, ["key", "cell", "own_b", "part_b"])
    return first.unionByName(other.select(*cols, F.lit(False).alias("head")))


def _met(share: tuple[int, int], step: int = 512):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        head = frame["head"].to_numpy(bool)
        a, b = (frame[m][["ent", "n", "place", "comp"]].to_numpy(np.int64).T for m in (head, ~head))
        out = []
        for i in range(0, a.shape[1], step):
            e, n, at, comp = (c[i : i + step, None] for c in a)
            x, y = np.nonzero((n <= b[1]) & (comp != b[3]) & can_link(n, at, b[1], b[2], share))
            out.append((e[x, 0], n[x, 0], b[0][y], b[1][y]))
        if not out:
            return pd.DataFrame({"a": [], "na": [], "b": [], "nb": []}, dtype="int64")
        return _ordered(*(np.concatenate(c) for c in zip(*out)))

    return run


def _explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        parts = [(np.full(len(x := np.frombuffer(r[0], np.int64)), k), x, *_read_list(r)[1:]) for k, *r in zip(f.key, f.ents, f.sizes, f.places)]
        if parts:
            yield pd.DataFrame(dict(zip(("key", "ent", "n", "place"), (np.concatenate(c) for c in zip(*parts)))))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every set cut by hash ranges: (ent, frag, sorted shingles)."""
    powers = Powers()
    borders = np.array([(i << 64) // COUNTING_FRAGMENTS for i in range(1, COUNTING_FRAGMENTS)], U64)
    for _, sets in _sets(batches, powers):
        rows = []
        for s in sets:
            if len(s):
                e, cut = _ent(s), [0, *np.searchsorted(s, borders), len(s)]
                rows += [(e, f, s[a:b].tobytes()) for f, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
        if rows:
            c = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), pa.array(c[2], pa.binary())], names=["ent", "frag", "part"])


COUNTED = "a long, na long, b long, nb long, frag int, common long"


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Common shingles of one fragment: streams a hub's part (``ent`` null), then those of its partners."""
    key, own = None, np.zeros(0, U64)
    for batch in batches:
        cols = {c: batch[c].to_pylist() for c in ("hub", "na", "salt", "frag", "ent", "nb", "part")}
        out = []
        for hub, na, salt, frag, ent, nb, part in zip(*cols.values()):
            shingles = np.frombuffer(part, U64)
            if ent is None:
                key, own = (hub, salt, frag), shingles
            elif key == (hub, salt, frag):  # else the hub has nothing in this fragment
                out.append((hub, na, ent, nb, frag, len(np.intersect1d(own, shingles, assume_unique=True))))
        if out:
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[c.split()[0] for c in COUNTED.split(", ")])


def _linked(pairs: DataFrame, docs: DataFrame, reps: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The candidate pairs that are similar, by partial counts per fragment. Texts are read again for one
    row of each set in question. A pair's hub is the set with more partners: its parts go once to
    every ``FAN_OUT`` of them, which stream past."""
    pairs = store(pairs.dropDuplicates(["a", "b"]))
    partners_of = store(pairs.select(F.explode(F.array("a", "b")).alias("ent")).groupBy("ent").agg(F.count("*").alias("c")))
    chosen = broadcast_if_small(reps.join(partners_of, "ent", "left_semi").select("rep"))  # by the bytes written; else text is shuffled
    texts = docs.join(chosen, F.xxhash64("_id", "_th") == F.col("rep"), "left_semi").select("_text")
    parts = store(texts.mapInArrow(_segments, "ent long, frag int, part binary"))
    known = broadcast_if_small(partners_of)
    sized = pairs.join(known.select(F.col("ent").alias("a"), F.col("c").alias("ca")), "a").join(known.select(F.col("ent").alias("b"), F.col("c").alias("cb")), "b")
    a_first = F.col("ca") >= F.col("cb")
    side = lambda x, y: F.when(a_first, F.col(x)).otherwise(F.col(y))
    salt = F.pmod(F.xxhash64(side("b", "a")), F.ceil(F.greatest("ca", "cb") / FAN_OUT))
    dealt = broadcast_if_small(sized.select(side("a", "b").alias("hub"), side("na", "nb").alias("na"), salt.alias("salt"), side("b", "a").alias("ent"), side("nb", "na").alias("nb")))
    partners = dealt.join(parts, "ent").select("hub", "na", "salt", "frag", "ent", "nb", "part")
    none = F.lit(None).cast("bigint")
    own = parts.withColumnRenamed("ent", "hub")
    hubs = dealt.select("hub", "na", "salt").distinct().join(own, "hub").select("hub", "na", "salt", "frag", none.alias("ent"), none.alias("nb"), "part")
    order = ["hub", "salt", "frag"]
    ordered = hubs.unionByName(partners).repartition(*order).sortWithinPartitions(*order, F.col("ent").asc_nulls_first())
    # equal rows of the table are read alike and give a part twice
    each = ordered.mapInArrow(_overlaps, COUNTED).groupBy("a", "na", "b", "nb", "frag").agg(F.max("common").alias("common"))
    counts = each.groupBy("a", "na", "b", "nb").agg(F.sum("common").alias("common"))
    return counts.where(F.col("common") * share[1] >= (F.col("na") + F.col("nb") - F.col("common")) * share[0]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def similar_components(df: DataFrame, id: str = "doc_id", text: str = "text", share: tuple[int, int] = (4, 5)) -> DataFrame:
    """``id``, ``text_hash`` long, ``n_shingles`` long, ``component_id`` long of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; the set is that of distinct runs of
    five words, of a shorter text its whole sequence. Rows are linked when ``intersection / union >=
    share[0] / share[1]``; the component's id is its smallest id. Null, empty and blank texts have no
    shingles and stand alone; a null id is linked like any other but never names a component (null only
    where no row of it has an id). Repeated rows are linked with each other. Other columns are ignored.
    Shingles are compared by 64-bit hashes.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text")).withColumn("_th", F.xxhash64(F.coalesce("_text", F.lit(""))))
    plain = docs.select("_id", "_th", "_text")
    scanned = store(plain.mapInArrow(_scan, PASS_A))
    sets = scanned.where("kind = 0").select("id", "th", "n", "ent")
    total = sets.agg(F.sum("n")).first()[0] or 0
    links = _links(spark, docs, plain, scanned, sets, total, share) if total else None
    named = sets.where("n > 0")
    if links is not None:
        own = named.join(links.select(F.col("a").alias("ent"), F.col("b").alias("root")), "ent", "left").withColumn("root", F.coalesce("root", "ent"))
    else:
        own = named.withColumn("root", F.col("ent"))
    least = broadcast_if_small(own.groupBy("root").agg(F.min("id").alias("component_id")))
    found = own.join(least, "root").select("id", F.col("th").alias("text_hash"), F.col("n").alias("n_shingles"), "component_id")
    alone = sets.where("n = 0").select("id", F.col("th").alias("text_hash"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return found.unionByName(alone).withColumnRenamed("id", id)


def _links(spark: SparkSession, docs: DataFrame, plain: DataFrame, scanned: DataFrame, sets: DataFrame, total: int, share: tuple[int, int]) -> DataFrame:
    stripes = scanned.where("kind = 1").select("stripe", "counts").repartition(STRIPES, "stripe").mapInPandas(_add_stripes, "stripe int, counts binary").collect()
    counts = np.concatenate([np.frombuffer(r.counts, np.uint32) for r in sorted(stripes, key=lambda r: r.stripe)])  # 2**SKETCH_BITS counters
    del stripes
    kinds, of = np.unique(counts, return_counts=True)
    mass = np.cumsum(kinds.astype(float) * of)
    heavy = int(kinds[np.searchsorted(mass, 0.25 * mass[-1])])  # a quarter of all shingles lies in buckets up to this count
    fragments = max(LEAST_FRAGMENTS, total // FRAGMENT_SHINGLES)
    packed = plain.mapInArrow(_prefix_rows(spark.sparkContext.broadcast(counts), heavy, fragments, share), "frag int, packed binary")
    lists = store(packed.groupBy("frag").applyInPandas(_lists, LISTS).groupBy("key").agg(F.min(F.struct("ord1", "ord2", "ents", "sizes", "places")).alias("l")).select("key", "l.ents", "l.sizes", "l.places"))
    reps = store(sets.where("n > 0").groupBy("ent").agg(F.min(F.xxhash64("id", "th")).alias("rep")))  # a row for each set
    stars = store(lists.mapInPandas(_stars(share), PAIR).dropDuplicates(["a", "b"]))
    first = store(_linked(stars, docs, reps, share))
    roots = components(first)
    crossing = _crossing(lists, roots, share)
    late = store(crossing.join(stars.select("a", "b"), ["a", "b"], "left_anti"))
    second = store(_linked(late, docs, reps, share))
    return roots if second.isEmpty() else components(roots.unionByName(second))


def _crossing(lists: DataFrame, roots: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs of different components of a list that pass the bounds."""

    def mixed(some: DataFrame) -> DataFrame:
        members = some.mapInPandas(_explode, "key long, ent long, n long, place long")
        members = members.join(roots.select(F.col("a").alias("ent"), F.col("b").alias("root")), "ent", "left").withColumn("comp", F.coalesce("root", "ent")).drop("root")
        keys = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
        return members.join(keys, "key", "left_semi")

    long = F.length("ents") > 8 * LIST_BLOCK
    found = mixed(lists.where((F.length("ents") > 16) & ~long)).groupBy("key").applyInPandas(_cross(share), PAIR)
    if not lists.where(long).isEmpty():
        found = found.unionByName(_meeting(store(mixed(lists.where(long))), share).groupBy(*BLOCK).applyInPandas(_met(share), PAIR))
    return found.dropDuplicates(["a", "b"])
