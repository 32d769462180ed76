"""Manifest, frames and hash minima against plain versions, with nulls, empty, long and repeated rows and clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import frames, merkle, minhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, form string, kept string, root string, n long, size long"
BODY = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, None, "en", "src1", None), (2, "", "en", None, 0), (None, BODY, None, "src2", 1), (3, BODY, "en", "src1", 1), (3, BODY, "en", "src1", 1),
    (4, BODY + " more", "de", "src3", 1), (5, " \t\n", "de", "", 3), (6, "two", "fr", "src1", 9), (7, "TWO\n", "fr", "src1", 9),
    (8, "long\n" * 60_000, "en", "src1", 300_000), (9, "é" * 100, "es", "src2", 100), (10, "a\n<S>b", "en", "src1", 1), (11, "\n\n", "en", "src1", 2),
    *[(20 + i, f"{i}\nline\nü{i}\r\nlast" + "\n" * (i % 2), "en", "src1", 1) for i in range(30)],
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "mine", "mine", "mine", "mine", 7, 7) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


# -- manifest ------------------------------------------------------------------------------------------


def climb(leaves: list[str], at: int) -> tuple[str, list[tuple[str, str]]]:
    path = []
    while len(leaves) > 1:
        run = at // 3 * 3
        path.append(("".join(leaves[run:at]), "".join(leaves[at + 1 : run + 3])))
        leaves, at = [sha("".join(leaves[i : i + 3])) for i in range(0, len(leaves), 3)], at // 3
    return leaves[0], path


def plain_manifest(rows, of, shown):
    by: dict = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, of(r), shown(r)))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops = [climb([m[2] for m in sorted(by[s])], 0)[0] for s in order]
    out = []
    for k, s in enumerate(order):
        members = sorted(by[s])
        root, above = climb(tops, k)
        for i, (has, id, leaf, other) in enumerate(members):
            path = climb([m[2] for m in members], i)[1] + above
            h = leaf if other is None else other
            for before, after in path:
                h = sha(before + h + after)
            out.append((id if has else None, leaf, tops[k], root, sha("".join(b + a for b, a in path)), h, h == root))
    return sorted(out, key=repr)


def fields(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def columns():
    of = lambda t: merkle.leaf_of([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), t])
    return of(F.col("text")), F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, of(F.replace("text", F.lit("\n"), F.lit(""))))


def shown_leaf(row):
    if row[0] is None or zlib.crc32(str(row[0]).encode()) % 2:
        return None
    return fields(row, None if row[1] is None else row[1].replace("\n", ""))


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_of_odd_rows(odd, height):
    """Heights of one and two levels make tiers over tiers."""
    got = sorted((tuple(r) for r in merkle.manifest(odd, "doc_id", "source", *columns(), height=height).collect()), key=repr)
    assert got == plain_manifest(ROWS, lambda r: fields(r, r[1]), shown_leaf)
    assert {g[6] for g in got} == {True, False}


def test_manifest_of_one_row_and_of_none(spark, odd, none):
    one = merkle.manifest(odd.where("doc_id = 9"), "doc_id", "source", *columns()).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root and one[0].proof_sha256 == sha("")
    assert merkle.manifest(none, "doc_id", "source", *columns()).count() == 0
    many = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("s"), "id").alias("source"), F.lit(1).alias("n_chars"))
    got = sorted((tuple(r) for r in merkle.manifest(many, "doc_id", "source", *columns(), height=2).collect()), key=repr)
    assert got == plain_manifest([(i, "t", "en", f"s{i}", 1) for i in range(200)], lambda r: fields(r, r[1]), shown_leaf)


def test_places_are_those_of_the_log():
    for leaves in range(1, 90):
        for height in {merkle.levels_above(leaves), 5}:
            names = [hashlib.sha256(bytes([i])).digest() for i in range(leaves)]
            log, level = merkle.append_log(names, height), names
            assert len(set(log)) == len(log)
            for k in range(height + 1):
                at = merkle.place(k, np.arange(len(level)), leaves, height)
                assert [log[p] for p in at] == level
                level = [hashlib.sha256("".join(x.hex() for x in level[i : i + 3]).encode()).digest() for i in range(0, len(level), 3)]
            assert log[-1] == log[merkle.place(height, np.arange(1), leaves, height)[0]]


# -- fill in the middle --------------------------------------------------------------------------------


def plain_middle(id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    d = sha(f"{seed}:{'' if id is None else id}")
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (id, len(units), "plain", None, None, sha(text), sha(text))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (id, len(units), form, len(p), len(m), sha(out), sha(text))


@pytest.mark.parametrize("size", [5, 64, frames.FRAME_BYTES])
def test_fill_in_middle_of_odd_rows(odd, none, size):
    rows = odd if size > 5 else odd.where("doc_id <> 8 or doc_id is null")  # 60,000 frames of five bytes show nothing new
    stored = frames.text_frames(rows, frame_bytes=size)
    got = sorted((tuple(r) for r in frames.output_digests(frames.fill_in_middle(stored)).collect()), key=repr)
    assert got == sorted((plain_middle(r[0], r[1]) for r in ROWS if size > 5 or r[0] != 8), key=repr)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    assert frames.output_digests(frames.fill_in_middle(frames.text_frames(none))).count() == 0


def test_rates_and_seed(odd):
    stored = frames.text_frames(odd)
    got = sorted((tuple(r) for r in frames.output_digests(frames.fill_in_middle(stored, seed=3, rate=40, spm=100)).collect()), key=repr)
    assert got == sorted((plain_middle(r[0], r[1], 3, 40, 100) for r in ROWS), key=repr)


def test_a_cut_opens_one_frame(odd):
    row = frames.text_frames(odd.where("doc_id = 8"), frame_bytes=1000).first()
    assert len(row.frames) == 300 and row.n_lines == 60_000 and row.n_chars == 300_000
    text = frames.Frames([f.asDict() for f in row.frames], row.n_lines, row.n_chars)
    for u in (0, 1, 199, 200, 201, 31_234, 60_000):
        text.opened = 0
        i, at, chars = text.cut(u)
        assert text.opened <= 1 and chars == 5 * u
        assert b"".join(frames.stream(text.span((0, 0, 0), (i, at, chars)))) == b"long\n" * u


def test_marks_across_frames():
    data = ["<", "P", ">pre\n<", "S>", "suf<M", ">", "mid\n"]
    pack = frames.zstandard.ZstdCompressor().compress
    assert b"".join(frames.restore([pack(d.encode()) for d in data], "psm")) == b"pre\nmid\nsuf"


# -- hash minima ----------------------------------------------------------------------------------------


def plain_components(rows, words=2):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least: dict = {}
    for i, (id, _) in enumerate(rows):
        if id is not None:
            least[find(i)] = min(id, least.get(find(i), id))
    return sorted(((id, len(sets[i]), (c := least.get(find(i)) if sets[i] else id), id == c) for i, (id, _) in enumerate(rows)), key=repr)


def test_near_copies_of_odd_rows(odd, none):
    got = sorted((tuple(r) for r in minhash.near_copies(odd).collect()), key=repr)
    assert got == plain_components([(r[0], r[1]) for r in ROWS])
    assert minhash.near_copies(none).count() == 0
    assert minhash.near_copies(none).columns == ["doc_id", "n_shingles", "component_id", "kept"]


@pytest.mark.parametrize("small", [False, True])
def test_near_copies_in_bands_that_many_share(spark, monkeypatch, small):
    """A template held by all, own words added: most share bands without being similar, and links lie across the bands'
    smallest classes. Small bounds send the same rows through blocks and several hubs."""
    if small:
        monkeypatch.setattr(minhash, "FAN_OUT", 3)
        monkeypatch.setattr(minhash, "BLOCK", 10)
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(300):
        w = list(base) + [f"g{i // 6}_{k}" for k in range(int(rng.integers(12, 40)))]
        for j in rng.integers(0, len(w), i % 6):
            w[j] = f"e{i}_{j}"
        rows.append((i, " ".join(w)))
    rows += [(900 + i, f"w{i} w{i + 1} w{i + 2}") for i in range(20)] + [(1000 + i, " ".join(f"s{k}" for k in range(i, i + 11))) for i in range(12)]
    got = sorted((tuple(r) for r in minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()), key=repr)
    want = plain_components(rows)
    assert got == want
    assert 1 < len({g[2] for g in got}) < len(rows)


def test_families_and_signatures():
    a, b = minhash.hash_family(64)
    assert len(set(a)) == 64 and (a & minhash.U64(1)).all()
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 900).astype(minhash.U64)
    m = minhash.minima([x[:800], x[100:900], x[:800][::-1]], minhash.hash_family(2000))
    assert abs((m[0] == m[1]).mean() - 700 / 900) < 0.04 and (m[0] == m[2]).all()
    assert minhash.least_agreement((4, 5), 288) == 189 and minhash.least_agreement((1, 1), 288) == 288
