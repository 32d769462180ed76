"""A Merkle manifest of a table, as a log of tree nodes in the order of their completion.

Every tree (one per source, then one over the sources' roots) joins three consecutive nodes into one, the last run
of a level fewer. A tree's leaves are cut into aligned runs of ``3 ** HEIGHT``; a builder reads one run in order and
appends a node to its log as soon as it is complete, children before parents. The last entry is the run's own root;
these are the leaves of the next tier, so a tree of any size is built by tasks of a fixed size in a few tiers.

A node's place in a log needs no index. When node ``i`` of level ``l`` is complete, so are all nodes of its level and
of those below that do not reach past its end, and all nodes above that end before its start. With ``c`` leaves in the
log and ``e = min((i + 1) * 3 ** l, c)``, its place is

    sum over j <= l of ceil(e / 3 ** j)  +  sum over j > l of floor(i / 3 ** (j - l))  -  1

A proof reads the siblings of every level at their places. Paths of the upper tiers are read first, one per run, and
are handed down, so that each document meets its own run's log and one path only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.ordering import running_totals
from pairloom.session import broadcast_if_small, store

FAN, HEIGHT = 3, 6
LOG = "tree string, run long, size long, log binary, top binary"
PATH = "array<struct<before: string, after: string>>"


def joined(parts: Sequence[str]) -> str:
    """The node over hex digests."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_above(n: int) -> int:
    """Levels that a tree of ``n`` leaves has above them."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def run_shape(size: int, run: int, height: int = HEIGHT) -> tuple[int, int]:
    """(leaves, levels above them) of a run of a tree of ``size`` leaves; a tree of several runs raises each to full height."""
    width = FAN**height
    return min(width, size - run * width), height if size > width else levels_above(size)


def append_log(leaves: Sequence[bytes], height: int) -> list[bytes]:
    """Nodes over the leaves of one run, in the order of their completion; leaves come one by one."""
    log: list[bytes] = []
    open_: list[list[bytes]] = [[] for _ in range(height + 1)]

    def complete(level: int, node: bytes) -> None:
        log.append(node)
        if level < height:
            open_[level].append(node)
            if len(open_[level]) == FAN:
                close(level)

    def close(level: int) -> None:
        parts, open_[level] = open_[level], []
        complete(level + 1, bytes.fromhex(joined([p.hex() for p in parts])))

    for leaf in leaves:
        complete(0, leaf)
    for level in range(height):
        if open_[level]:
            close(level)
    return log


def place(level: int, i: np.ndarray, leaves: int, height: int) -> np.ndarray:
    """Places in the log of nodes ``i`` of a level."""
    end = np.minimum((i + 1) * FAN**level, leaves)
    below = sum(-(-end // FAN**j) for j in range(level + 1))
    above = sum(i // FAN ** (j - level) for j in range(level + 1, height + 1))
    return below + above - 1


def siblings(log: bytes, leaves: int, height: int) -> list[list[tuple[str, str]]]:
    """For every leaf of a run its path in the run: per level the digests before and after it, each joined."""
    node = lambda p: log[32 * p : 32 * p + 32].hex()
    levels: list[list[tuple[str, str]]] = []
    for level in range(height):
        n = -(-leaves // FAN**level)
        at = place(level, np.arange(n), leaves, height)
        hexes = [node(int(p)) for p in at]
        levels.append([("".join(hexes[i - i % FAN : i]), "".join(hexes[i + 1 : i - i % FAN + FAN])) for i in range(n)])
    return [[levels[level][p // FAN**level] for level in range(height)] for p in range(leaves)]


def fold(leaf: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        leaf = joined((before, leaf, after))
    return leaf


def proof_digest(path: Sequence[tuple[str, str]]) -> str:
    return joined([part for step in path for part in step])


def _path(value) -> list[tuple[str, str]]:
    return [] if value is None else [(s["before"], s["after"]) for s in value]


def build_tier(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``LOG`` rows of ``(tree, pos, size, digest)``: one per run. ``top`` is the run's own root."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        size, run = int(frame["size"].iat[0]), int(frame["run"].iat[0])
        log = append_log(frame["digest"].tolist(), run_shape(size, run, height)[1])
        return pd.DataFrame({"tree": [frame["tree"].iat[0]], "run": [run], "size": [size], "log": [b"".join(log)], "top": [log[-1]]})

    placed = nodes.withColumn("run", F.floor(F.col("pos") / F.lit(FAN**height)).cast("bigint"))
    return placed.groupBy("tree", "run").applyInPandas(build, LOG)


def build_logs(leaves: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The logs of all tiers, first that over the leaves ``(tree, pos, size, digest)``. Each is written down."""
    tiers = [store(build_tier(leaves, height))]
    width = FAN**height
    while True:
        most = tiers[-1].agg(F.max("size")).first()[0] or 0
        if most <= width:
            return tiers
        upper = tiers[-1].where(F.col("size") > width)
        size = F.ceil(F.col("size") / F.lit(width)).cast("bigint")
        tiers.append(store(build_tier(upper.select("tree", F.col("run").alias("pos"), size.alias("size"), F.col("top").alias("digest")), height)))


def _tops(tiers: Sequence[DataFrame], height: int) -> DataFrame:
    """``(tree, top)``: the root of every tree."""
    done = [t.where(F.col("size") <= FAN**height).select("tree", "top") for t in tiers]
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def paths_of(logs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``(tree, run, above)`` for every leaf of ``(tree, run, size, log, above)``, ``run`` now being the leaf's number: its
    path in the log, then the log's own."""

    def down(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for tree, run, size, log, rest in zip(f["tree"], f["run"], f["size"], f["log"], f["above"]):
                leaves, levels = run_shape(int(size), int(run), height)
                tail = _path(rest)
                paths = [[{"before": b, "after": a} for b, a in [*p, *tail]] for p in siblings(bytes(log), leaves, levels)]
                first = int(run) * FAN**height
                yield pd.DataFrame({"tree": [tree] * leaves, "run": np.arange(first, first + leaves), "above": paths})

    return logs.select("tree", "run", "size", "log", "above").mapInPandas(down, f"tree string, run long, above {PATH}")


def hand_down(tiers: Sequence[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``(tree, run, above)`` for every run of the first tier: its path up to the root, ``above`` being the trees' own
    ``(tree, above)``."""
    paths = None
    for k in range(len(tiers) - 1, -1, -1):
        ends = tiers[k].where(F.col("size") <= FAN**height).select("tree", "run").join(above, "tree")
        ends = ends if paths is None else ends.unionByName(paths)
        if k:
            paths = store(paths_of(tiers[k].join(ends, ["tree", "run"]), height))
    return ends


def leaf_of(columns: Sequence[Column]) -> Column:
    """sha256 over fields, each its UTF-8 length, a colon and itself, or a dash where it is null."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]), 256)


def manifest(df: DataFrame, id: str, source: str, leaf: Column, tampered: Column, height: int = HEIGHT) -> DataFrame:
    """``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified`` of every row.

    Leaves ascend by id within a source (null ids first; repeated ids by digest, so equal rows are interchangeable);
    sources ascend bytewise, null first. ``tampered`` is the leaf as somebody might present it, null where nothing was
    touched. A lone leaf is its source's root, a lone source's root is that of the table; then the proof is that of no
    siblings. An empty table gives no rows.
    """
    tree = F.when(F.col(source).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(source).cast("string")))
    rows = df.select(F.col(id).alias("_id"), tree.alias("tree"), F.unhex(leaf).alias("digest"), F.unhex(tampered).alias("tampered"))
    rows = running_totals(store(rows), ["tree"], ["_id", "digest"])
    placed = store(rows)
    sizes = placed.groupBy("tree").agg(F.count("*").alias("size"))
    leaves = store(placed.join(broadcast_if_small(sizes), "tree"))
    tiers = build_logs(leaves.select("tree", "pos", "size", "digest"), height)

    tops = store(running_totals(store(_tops(tiers, height)), [], ["tree"]))
    n = tops.count()
    over = build_logs(tops.select(F.lit("").alias("tree"), "pos", F.lit(n).cast("bigint").alias("size"), F.col("top").alias("digest")), height)
    top = _tops(over, height).first()
    root = bytes(top["top"]).hex() if top else ""

    # the tree over the sources is read like any other
    itself = tops.sparkSession.createDataFrame([("", [])], f"tree string, above {PATH}")
    of_source = paths_of(over[0].join(hand_down(over, itself, height), ["tree", "run"]), height)
    source_paths = store(of_source.select(F.col("run").alias("pos"), "above").join(tops, "pos").select("tree", "above", F.hex("top").alias("subroot")))
    above = hand_down(tiers, source_paths.select("tree", "above"), height)
    logs = store(tiers[0].select("tree", "run", "size", "log").join(above, ["tree", "run"]).join(source_paths.select("tree", "subroot"), "tree"))

    out = ["_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def prove(members: pd.DataFrame, log: pd.DataFrame) -> pd.DataFrame:
        if members.empty or log.empty:
            return pd.DataFrame({c: [] for c in out})
        r = log.iloc[0]
        n_leaves, levels = run_shape(int(r["size"]), int(r["run"]), height)
        own, tail, first = siblings(bytes(r["log"]), n_leaves, levels), _path(r["above"]), int(r["run"]) * FAN**height
        digests, proofs, folded = [], [], []
        for pos, digest, other in zip(members["pos"], members["digest"], members["tampered"]):
            path = [*own[int(pos) - first], *tail]
            digests.append(bytes(digest).hex())
            proofs.append(proof_digest(path))
            folded.append(fold(bytes(digest if other is None else other).hex(), path))
        return pd.DataFrame(
            {
                "_id": members["_id"].astype("Int64"), "leaf": digests, "subroot": r["subroot"].lower(), "root": root,
                "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded],
            }
        )

    members = leaves.withColumn("run", F.floor(F.col("pos") / F.lit(FAN**height)).cast("bigint")).select("tree", "run", "pos", F.col("_id").cast("bigint").alias("_id"), "digest", "tampered")
    found = members.groupBy("tree", "run").cogroup(logs.groupBy("tree", "run")).applyInPandas(
        prove, "_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    return found.withColumnRenamed("_id", id)
