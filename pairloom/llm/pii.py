"""Personal data: generous candidate generators, boosted trees over format and context, calibrated thresholds.

Strict patterns with their checks (Luhn, parts of an address, numbers of digits) give the base spans. Looser
patterns propose further, overlapping candidates: spelled-out or odd addresses, numbers with other
separators, numbers without a plus sign. For each kind, boosted regression trees (logistic loss) learn from all
documents: equal rows of binned features are counted, every level of every tree is one sum of gradients by feature and
bin over these counts, and only the sums reach the driver. Positives are strict matches rewritten into loose formats where they stand
(plus or country dropped, @ spelled out, other separators), negatives are candidates that fail the check of their
kind, cross a match of another kind or stand inside a word or number, as they are and rewritten alike. So the format
does not tell the classes apart, and a loose candidate that could be a match has no label. The threshold of a kind is
the lowest score at which the rewritten matches and failed candidates above it, of documents left out of training,
reach the wanted precision; a failed card number or address without a domain
counts a ninth, as one in ten such numbers passes Luhn by chance. Candidates
above it that pass the check once their format is undone are added unless they overlap a base span or a better
candidate of the kind. Where nothing fails, all that pass are added.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.text import slices, string_bytes
from pairloom.operators.ordering import running_totals
from pairloom.session import store

KINDS = ("email", "ip", "card", "phone")
# possessive, and starting only where a run of digits starts: a run that fails is not tried again from within
STRICT = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LOOSE = {
    "email": re.compile(r"[^\s@<>\"',;()\[\]]{1,64}[ ]?(?:@|\(at\)|\[at\])[ ]?[^\s@<>\"',;]{1,64}(?<![.:!?])(?:[ ][\[(]dot[\])][ ][A-Za-z0-9-]{1,64})*", re.I),
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:(?:\.|[ ]?[\[(](?:\.|dot)[\])][ ]?|[ ]dot[ ])[0-9]++){3,}", re.I),
    "card": re.compile(r"[0-9](?:[ ]?[._/-]?[ ]?[0-9]){9,22}"),
    "phone": re.compile(r"[(+]{0,2}[0-9][\x20()./0-9-]{5,22}[0-9]"),
}
NEAR = 1000  # characters of a line around an example that is rewritten
PRECISION, LEAST_SCORE = 0.95, 0.5
TREES, DEPTH, BINS, RATE = 40, 3, 16, 0.2
N_FEATURES = 24
UNIT = 1 << 24  # gradients are summed as whole numbers of this part, so sums do not depend on the order of rows
_DIGITS = re.compile(r"[0-9]+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_MARK = re.compile(r"[0-9@]|[\[(]at[\])]", re.I)
_AT = re.compile(r"[ ]?(?:@|\(at\)|\[at\])[ ]?", re.I)
_DOT = re.compile(r"[ ]?[\[(](?:\.|dot)[\])][ ]?|[ ]dot[ ]", re.I)
_DATE = re.compile(r"(?:19|20)[0-9]{2}([-./])[01]?[0-9]\1[0-3]?[0-9](?![0-9])|[0-3]?[0-9]([-./])[01]?[0-9]\2(?:19|20)[0-9]{2}(?![0-9])")
CHANCE = {"card": 1 / 9, "email": 1 / 9}  # weight of a failed candidate: how often its like passes the check all the same


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def passes(kind: str, s: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))
    digits = "".join(_DIGITS.findall(s)) if kind != "email" else ""
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def could_be(kind: str, s: str) -> bool:
    """Whether a loose match passes the check of its kind once its format is undone."""
    if kind == "email":
        return bool(STRICT["email"].fullmatch(_DOT.sub(".", _AT.sub("@", s))))
    if kind == "ip":
        s = _DOT.sub(".", s)
        return s.count(".") == 3 and passes(kind, s)
    return passes(kind, s) and not (kind == "phone" and _DATE.match(s))


def _groups(s: str) -> list[str]:
    groups = _DIGITS.findall(s)
    if len(groups) > 1 or len(groups[0]) < 8:
        return groups
    head, rest = groups[0][:-10], groups[0][-10:]
    return [g for g in (head, rest[:-7], rest[-7:-4], rest[-4:]) if g]


def disguised(kind: str, s: str, pick: int) -> str:
    """One of the loose formats of a match."""
    if kind == "email":
        s = _AT.sub(lambda _: ("(at)", " (at) ", "[at]", " [at] ", " @ ")[pick % 5], s)
        return s if pick // 5 % 2 else ("(dot)", "[dot]", " (dot) ")[pick // 10 % 3].join(s.rsplit(".", 1))
    if kind == "ip":
        return ("[.]", "(.)", "[dot]", " dot ")[pick % 4].join(_DOT.sub(".", s).split("."))
    if kind == "card":
        digits = "".join(_DIGITS.findall(s))
        return (".", " . ", "_", "/", " - ")[pick % 5].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    groups = _groups(s)
    if pick // 7 % 2 and len(groups) > 2 and sum(map(len, groups[1:])) >= 9:  # no country
        groups = groups[1:]
    by = pick % 7
    if by == 5 and len(groups) > 1:
        return f"({groups[0]}) " + "-".join(groups[1:])
    if by == 6:
        return s.lstrip("+")
    return ("-", ".", " ", "/", "")[by % 5].join(groups)


def strict_matches(kind: str, line: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the leftmost non-overlapping matches of a strict pattern, in time linear in the line: addresses
    are read outwards from each @, as the characters before it are none."""
    if kind != "email":
        yield from (m.span() for m in STRICT[kind].finditer(line))
        return
    low, at = 0, line.find("@")
    while at >= 0:
        start = low + len(line[low:at].rstrip(_LOCAL))
        m = _DOMAIN.match(line, at + 1) if start < at else None
        if m:
            yield start, m.end()
        low = m.end() if m else at + 1
        at = line.find("@", low)


def _marked_lines(text: str) -> Iterator[tuple[int, str]]:
    """Start and text of the lines that can hold a match; none of the patterns crosses a line."""
    if not _MARK.search(text):
        return
    at = 0
    for line in text.split("\n"):
        if _MARK.search(line):
            yield at, line
        at += len(line) + 1


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of strict matches, by start and kind."""
    out = []
    for at, line in _marked_lines(text):
        for kind in STRICT:
            out += [(at + a, kind, at + b) for a, b in strict_matches(kind, line) if passes(kind, line[a:b])]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def _features(line: str, a: int, b: int) -> list[float]:
    s = line[a:b]
    groups = [len(g) for g in _DIGITS.findall(s)] or [0]
    before, after = line[max(0, a - 24) : a], line[b : b + 24]
    word = re.findall(r"\w+", before.lower())[-1:] or [""]
    kind_of = lambda c: 0 if not c else 1 if c == " " else 2 if c.isalpha() else 3 if c.isdigit() else 4
    tail = re.split(r"[.\s]", s)[-1]
    around = before + after
    first = re.search("[0-9]", s)
    return [
        int(first[0]) if first else -1, len(s), sum(groups), len(groups), max(groups), min(groups), s.count(" "), s.count("-"), s.count("."), s.count("(") + s.count(")"),
        s.count("/"), s.startswith("+"), sum(c.isalpha() for c in s), "@" in s, len(tail), tail.isalpha(), kind_of(before[-1:]), kind_of(after[:1]),
        before[-1:] in "+.-/", after[:1] in "-./@", sum(c.isdigit() for c in around), zlib.crc32(word[0].encode()) % 16, len(word[0]), before.rstrip()[-1:] in ":=",
    ]


class Cover:
    """What spans cover, as disjoint runs in order, so that a long text's many spans are met by bisection."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        i = bisect.bisect_left(self.starts, b) - 1
        return i >= 0 and self.ends[i] > a

    def add(self, a: int, b: int) -> None:
        """A span that meets none."""
        i = bisect.bisect_left(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[str, int, int, bool, list[float]]]:
    """(kind, start, end, whether a base span, features). Loose matches that cross a base span of the kind are dropped."""
    out = []
    strict = {k: [(a, b) for a, kind, b in base if kind == k] for k in KINDS}
    starts = {k: [a for a, _ in own] for k, own in strict.items()}
    covers = {k: Cover(own) for k, own in strict.items()}
    for at, line in _marked_lines(text):
        for kind in KINDS:
            i, j = bisect.bisect_left(starts[kind], at), bisect.bisect_right(starts[kind], at + len(line))
            out += [(kind, a, b, True, _features(line, a - at, b - at)) for a, b in strict[kind][i:j]]
            for m in LOOSE[kind].finditer(line):
                if not covers[kind].meets(at + m.start(), at + m.end()):
                    out.append((kind, at + m.start(), at + m.end(), False, _features(line, m.start(), m.end())))
    return out


def examples(text: str, base: list[tuple[int, str, int]], seed: int = 0) -> list[tuple[str, int, bool, list[float]]]:
    """(kind, start, whether a match, features) to learn from, each match and each failed candidate twice over."""
    out = []
    inside = {k: Cover([(a, b) for a, kind, b in base if kind != k]) for k in KINDS}
    starts = [(at, line) for at, line in _marked_lines(text)]
    where = [at for at, _ in starts]
    for kind, a, b, strict, x in candidates(text, base):
        at, line = starts[bisect.bisect_right(where, a) - 1]
        i, j = a - at, b - at
        s = line[i:j]

        def learn(form: str, y: bool) -> None:
            before = line[max(0, i - NEAR) : i]
            changed, at = before + form + line[j : j + NEAR], len(before)
            found = next((m for m in LOOSE[kind].finditer(changed) if m.start() < at + len(form) and m.end() > at), None)
            if found and (could_be(kind, found[0]) or not y):
                out.append((kind, a, y, _features(changed, found.start(), found.end())))

        pick = zlib.crc32(f"{seed} {a} {kind}".encode())
        if strict:
            learn(disguised(kind, s, pick), True)
            learn(disguised(kind, s, pick >> 8), True)
            continue
        glued = kind in ("card", "phone") and (line[i - 1 : i].isalnum() or line[j : j + 1].isalnum())
        if glued or not could_be(kind, s) or inside[kind].meets(a, b):
            out.append((kind, a, False, x))
            learn(disguised(kind, s, pick % 5), False)  # digits stay as many
    return out


def _best_split(hist_g: np.ndarray, hist_h: np.ndarray) -> tuple[int, int] | None:
    """(feature, bin) of the greatest gain, from sums per feature and bin."""
    total_g, total_h = hist_g[0].sum(), hist_h[0].sum()
    left_g, left_h = np.cumsum(hist_g, axis=1)[:, :-1], np.cumsum(hist_h, axis=1)[:, :-1]
    gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
    f, i = divmod(int(gain.argmax()), BINS - 1)
    return (f, i) if gain[f, i] > 1e-6 else None


def _leaf(total_g: float, total_h: float) -> float:
    return float(-RATE * total_g / (total_h + 1))


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> tuple:
    """A regression tree over binned features: (value,) or (feature, bin, left, right), left at bins up to ``bin``."""
    leaf = (_leaf(g[rows].sum(), h[rows].sum()),)
    if depth == 0 or len(rows) < 8:
        return leaf
    best = _best_split(*(np.stack([np.bincount(x[rows, f], v[rows], BINS) for f in range(x.shape[1])]) for v in (g, h)))
    if best is None:
        return leaf
    f, i = best
    left = x[rows, f] <= i
    return f, i, _grow(x, g, h, rows[left], depth - 1), _grow(x, g, h, rows[~left], depth - 1)


def _value(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    f, i, left, right = tree
    return np.where(x[:, f] <= i, _value(left, x), _value(right, x))


def _binned(cuts: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1).astype(np.uint8)


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> dict:
    """The plain version of ``boost_kinds``, over rows at hand."""
    w = np.ones(len(y)) if w is None else w
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = _binned(cuts, x)
    start = float(np.log(((w * y).sum() + 1) / ((w * (1 - y)).sum() + 1)))
    score, trees = np.full(len(y), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        trees.append(_grow(binned, w * (p - y), w * p * (1 - p), np.arange(len(y)), DEPTH))
        score += _value(trees[-1], binned)
    return {"cuts": cuts, "start": start, "trees": trees}


def boosted_score(model: dict, x: np.ndarray) -> np.ndarray:
    return _score(model, _binned(model["cuts"], x))


def _score(model: dict, binned: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(model["start"] + sum((_value(t, binned) for t in model["trees"]), np.zeros(len(binned))))))


def threshold_for(score: np.ndarray, y: np.ndarray, precision: float = PRECISION, w: np.ndarray | None = None) -> float:
    """The lowest score from which on the (weighted) share of matches is ``precision`` or more, midway to
    the next one below; 2 (none) if there is none. The plain version of ``thresholds``."""
    w = np.ones(len(y)) if w is None else w
    order = np.argsort(-score, kind="stable")
    share = np.cumsum((w * y)[order]) / np.cumsum(w[order])
    last_of_tie = np.append(score[order][1:] != score[order][:-1], True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero((share >= precision) & last_of_tie)
    if not len(good):
        return 2.0
    return float((score[order][good[-1]] + np.append(score[order], 0.0)[good[-1] + 1]) / 2)


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, _, _ in slices(batches, "_text"):
        found = [(i, *e) for i, t in zip(batch["_id"].to_pylist(), batch["_text"].to_pylist()) if t for e in examples(t, base_spans(t), i)]
        if found:
            x = np.array([f[4] for f in found], np.float32)
            held = [zlib.crc32(str(f[0]).encode()) % 4 == 0 for f in found]
            cols = [pa.array([f[1] for f in found]), pa.array([f[3] for f in found]), pa.array(held), *map(pa.array, np.ascontiguousarray(x.T))]
            yield pa.RecordBatch.from_arrays(cols, names=["k", "y", "held", *[f"f{i}" for i in range(N_FEATURES)]])


def _counted_bins(found: DataFrame, cuts: dict[str, list[np.ndarray]]) -> DataFrame:
    """(k, held, bins, pos, neg): matches and failed candidates of each row of binned features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = np.array(batch["k"].to_pylist())
            x = np.stack([batch[f"f{i}"].to_numpy() for i in range(N_FEATURES)], axis=1)
            bins = np.zeros(x.shape, np.uint8)
            for kind in np.unique(kinds):
                bins[kinds == kind] = _binned(cuts[kind], x[kinds == kind])
            yield pa.RecordBatch.from_arrays([batch["k"], batch["y"], batch["held"], pa.array([r.tobytes() for r in bins], pa.binary())], names=["k", "y", "held", "bins"])

    rows = found.where(F.col("k").isin(list(cuts))).mapInArrow(run, "k string, y boolean, held boolean, bins binary")
    return rows.groupBy("k", "held", "bins").agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))


def _by_kind(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, bins, matches, failed candidates) of a batch of counted rows."""
    kinds = np.array(batch["k"].to_pylist())
    x = string_bytes(batch["bins"])[0].reshape(-1, N_FEATURES)
    pos, neg = (batch[c].to_numpy().astype(float) for c in ("pos", "neg"))
    for kind in np.unique(kinds):
        own = kinds == kind
        yield str(kind), x[own], pos[own], neg[own]


def _histograms(counted: DataFrame, models: dict[str, dict], shapes: dict[str, tuple]) -> dict[str, np.ndarray]:
    """Per kind the sums of gradients, second derivatives and rows by node, feature and bin. The leaves of ``shapes`` are
    numbers of the nodes to sum for, or -1."""
    width = N_FEATURES * BINS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {kind: np.zeros((3, (1 << DEPTH) * width), np.int64) for kind in shapes}
        for batch in batches:
            for kind, x, pos, neg in _by_kind(batch):
                if kind not in shapes:
                    continue
                node = _value(shapes[kind], x).astype(np.int64)
                x, pos, neg, node = (v[node >= 0] for v in (x, pos, neg, node))
                p, failed = _score(models[kind], x), neg * CHANCE.get(kind, 1.0)
                g, h = np.rint((pos * (p - 1) + failed * p) * UNIT), np.rint((pos + failed) * p * (1 - p) * UNIT)
                cell = (node[:, None] * width + np.arange(N_FEATURES) * BINS + x).ravel()
                for i, v in enumerate((g, h, pos + neg)):
                    sums[kind][i] += np.bincount(cell, np.repeat(v, N_FEATURES), sums[kind].shape[1]).astype(np.int64)
        for kind, (g, h, n) in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(at), pa.string()), *(pa.array(v) for v in (at, g[at], h[at], n[at]))], names=["k", "cell", "g", "h", "n"])

    parts = counted.mapInArrow(run, "k string, cell long, g long, h long, n long")
    out = {kind: np.zeros((3, (1 << DEPTH) * width)) for kind in shapes}
    for r in parts.groupBy("k", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).collect():
        out[r.k][:, r.cell] = r.g / UNIT, r.h / UNIT, r.n
    return {kind: v.reshape(3, -1, N_FEATURES, BINS) for kind, v in out.items()}


def _tree(node: dict, leaf: Callable[[dict], float]) -> tuple:
    if "split" not in node:
        return (leaf(node),)
    f, i, left, right = node["split"]
    return f, i, _tree(left, leaf), _tree(right, leaf)


def boost_kinds(counted: DataFrame, models: dict[str, dict]) -> None:
    """Adds trees to the models of all kinds together, a Spark job per level. ``counted`` has one row per kind and row of
    bins (k, bins, pos, neg) and may have any size; the driver gets one number per node, feature and bin."""
    for _ in range(TREES):
        roots: dict[str, dict] = {kind: {"value": 0.0} for kind in models}
        open_nodes = {kind: [root] for kind, root in roots.items()}
        for _ in range(DEPTH):
            open_nodes = {kind: nodes for kind, nodes in open_nodes.items() if nodes}
            if not open_nodes:
                break
            number = {id(node): i for nodes in open_nodes.values() for i, node in enumerate(nodes)}
            shapes = {kind: _tree(roots[kind], lambda node: float(number.get(id(node), -1))) for kind in open_nodes}
            sums = _histograms(counted, models, shapes)
            for kind, nodes in open_nodes.items():
                below = []
                for (g, h, n), node in zip(np.moveaxis(sums[kind], 0, 1), nodes):
                    node["value"] = _leaf(g[0].sum(), h[0].sum())
                    best = _best_split(g, h) if n[0].sum() >= 8 else None
                    if best is None:
                        continue
                    f, i = best
                    sides = [{"value": _leaf(g[f, s].sum(), h[f, s].sum()), "n": n[f, s].sum()} for s in (slice(i + 1), slice(i + 1, None))]
                    node["split"] = (f, i, *sides)
                    below += [side for side in sides if side["n"] >= 8]
                open_nodes[kind] = below
        for kind, root in roots.items():
            models[kind]["trees"].append(_tree(root, lambda node: node["value"]))


def thresholds(counted: DataFrame, models: dict[str, dict]) -> dict[str, float]:
    """``threshold_for`` of every kind over counted rows of any number: running totals by score over range partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, x, pos, neg in _by_kind(batch):
                cols = [pa.array([kind] * len(x), pa.string()), *(pa.array(v) for v in (-_score(models[kind], x), pos.astype(np.int64), neg.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays(cols, names=["k", "below", "yes", "no"])

    per_score = counted.mapInArrow(run, "k string, below double, yes long, no long").groupBy("k", "below").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    placed = store(running_totals(per_score, ["k"], ["below"], {"yes_before": "yes", "no_before": "no"}))
    chance = F.lit(1.0)
    for kind, share in CHANCE.items():
        chance = F.when(F.col("k") == kind, F.lit(share)).otherwise(chance)
    matches, failed = F.col("yes_before") + F.col("yes"), F.col("no_before") + F.col("no")
    last = {r.k: r.at for r in placed.where(matches >= PRECISION * (matches + failed * chance)).groupBy("k").agg(F.max("below").alias("at")).collect()}
    after = F.lit(False)
    for kind, at in last.items():
        after |= (F.col("k") == kind) & (F.col("below") > at)
    following = {r.k: r.at for r in placed.where(after).groupBy("k").agg(F.min("below").alias("at")).collect()}
    return {kind: -(last[kind] + following.get(kind, 0.0)) / 2 if kind in last else 2.0 for kind in models}


def fit_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> dict[str, dict]:
    """Per kind trees and a threshold, from the ``examples`` of all documents; a quarter of the documents is used for the
    threshold only. Kinds without matches have no model."""
    rows = docs.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    marked = rows.where(F.col("_text").rlike("[0-9@]|(?i)[(\\[]at"))
    columns = [f"f{i}" for i in range(N_FEATURES)]
    found = store(marked.mapInArrow(_example_rows, "k string, y boolean, held boolean, " + ", ".join(f"{c} float" for c in columns)))
    steps = [i / BINS for i in range(1, BINS)]
    values = [F.percentile(c, F.array(*map(F.lit, steps))).alias(c) for c in columns]
    seen = found.where(~F.col("held")).groupBy("k").agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"), *values).where("pos > 0").collect()
    models = {}
    for r in sorted(seen, key=lambda r: KINDS.index(r.k)):
        start = float(np.log((r.pos + 1) / (r.neg * CHANCE.get(r.k, 1.0) + 1)))
        models[r.k] = {"cuts": [np.unique(r[c]) for c in columns], "start": start, "trees": []}
    if not models:
        return {}
    counted = store(_counted_bins(found, {kind: m["cuts"] for kind, m in models.items()}))
    boost_kinds(counted.where(~F.col("held")), models)
    least = thresholds(counted.where("held"), models)
    return {kind: m | {"threshold": max(LEAST_SCORE, least[kind])} for kind, m in models.items()}


def spans_of(text: str, models: dict[str, dict]) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """(base spans, all spans) of one text, each by start and kind."""
    base = base_spans(text)
    if not models:
        return base, base
    extra: list[tuple[int, str, int]] = []
    found = [c for c in candidates(text, base) if not c[3] and could_be(c[0], text[c[1] : c[2]])]
    for kind, model in models.items():
        own = [c for c in found if c[0] == kind]
        if not own or model["threshold"] > 1:
            continue
        score = boosted_score(model, np.array([c[4] for c in own], np.float32))
        taken = Cover([(a, b) for a, _, b in base])
        for i in np.argsort(-score, kind="stable"):
            _, a, b, _, _ = own[i]
            if score[i] >= model["threshold"] and not taken.meets(a, b):
                taken.add(a, b)
                extra.append((a, kind, b))
    return base, sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[1])))


def find_spans(docs: DataFrame, models: dict[str, dict], id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``base`` and ``spans`` of every row: arrays of (kind, start, end) in code points, end exclusive, by
    start and kind. Null and empty texts have none; every row is looked at by itself."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [spans_of(t, models) if t else ([], []) for t in batch["_text"].to_pylist()]
            cols = [pa.array([[{"kind": k, "start": a, "end": b} for a, k, b in s[i]] for s in both], span) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch["_id"], *cols], names=["_id", "base", "spans"])

    kind = "array<struct<kind:string,start:int,end:int>>"
    rows = docs.select(F.col(id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"_id long, base {kind}, spans {kind}").withColumnRenamed("_id", id)


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with every span, overlapping ones as one, replaced by its first kind in angle brackets."""
    out, at, end = [], 0, -1
    for a, kind, b in spans:
        if a >= end:
            out += [text[at:a], f"<{kind}>"]
        at = end = max(end, b)
    return "".join(out) + text[at:]
