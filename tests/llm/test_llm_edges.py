"""Nulls, empty and long texts, ties and repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pairloom.llm import components, decontaminate, jaccard, lines, mixing, pii, quality, sharding, suffixes, toxicity, winnow

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string, copies string, keep int"
LINE = "this line is long enough to be counted as a key, " + "yes it is"
BODY = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, None, "en", "src1", None), (2, "", "en", None, 0), (None, BODY, None, "src2", 1), (3, BODY, "en", "src1", 1), (3, BODY, "en", "src1", 1),
    (4, BODY + " more", "de", "src3", 1), (5, " \t\n", "de", "", 3), (6, "two words", "fr", "src1", 9), (7, "Two\nWORDS", "fr", "src1", 9),
    (8, "long " * 60_000, "en", "src1", 300_000), (9, "é" * 100, "es", "src2", 100), (10, "\n".join([LINE] * 2 + ["x"]), "en", "src1", 1),
    *[(20 + i, f"{i}\n{LINE}", "en", "src1", 1) for i in range(5)], (30, "mail me@x.org now", "en", "src1", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "mine", "mine", "mine", 7) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components(spark, odd, none):
    assert jaccard.similar_components(none).count() == 0
    got = {}
    for r in jaccard.similar_components(odd).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert got[None] == [(56, 3)] and got[3] == [(56, 3)] * 2 and got[4] == [(57, 3)]
    assert got[1] == [(0, 1)] and got[2] == [(0, 2)] and got[5] == [(0, 5)]
    assert got[6] == [(1, 6)] and got[7] == [(1, 6)] and got[8] == [(1, 8)]
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (7, 7)], "a long, b long")
    assert {tuple(r) for r in components.components(links).collect()} == {(5, 2), (4, 2), (3, 2), (9, 8)}
    assert components.components(links.limit(0)).count() == 0


def test_near_copies_in_lists_link_across_components(spark):
    """Chains and a large group: links that no pivot has are found in the second round."""
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(60):
        w = list(base)
        for j in rng.integers(0, 120, 1 + i % 5):
            w[j] = f"e{i}_{j}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.component_id for r in jaccard.similar_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets = [{tuple(t.split()[k : k + 5]) for k in range(116)} for t in texts]
    root = list(range(60))
    for _ in range(60):
        for a in range(60):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == dict(enumerate(root))


def test_shards(odd, none):
    dims = [sharding.digit("lang"), sharding.digit("source"), sharding.magnitude("n_chars")]
    assert sharding.hilbert_shards(none, "doc_id", dims).count() == 0
    got = sharding.hilbert_shards(odd, "doc_id", dims).toPandas()
    assert len(got) == len(ROWS) and list(got.columns).count("shard") == 1 and set(got.score) == {"mine"}
    sizes = got.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and set(got["shard"]) <= set(range(16))


def test_byte_runs(odd, none):
    assert suffixes.remove_repeats(none).count() == 0
    got = {}
    for r in suffixes.remove_repeats(odd).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans))
    whole = len(BODY)
    assert got[1] == [(0, 0, 0)] and got[2] == [(0, 0, 0)] and got[None] == [(whole, 0, 0)]
    assert got[3] == [(whole, 0, 0)] * 2 and got[4] == [(whole + 5, whole, 1)]
    assert got[8] == [(300_000, 0, 0)] and got[9] == [(200, 0, 0)]
    assert got[10][0][1] == 0 and got[21][0][2] == 1


def test_fingerprints(odd, none):
    assert winnow.winnow(none).count() == 0 and winnow.compare_with_next(none).count() == 0
    got = winnow.compare_with_next(odd).collect()
    assert len(got) == len(ROWS)
    of = {r.doc_id: r for r in got}
    assert of[1].n_chars == 0 and of[1].fingerprint == "" and of[1].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert len({r.fingerprint for r in got if r.doc_id in (3, None)}) == 1
    one = winnow.compare_with_next(odd.where("doc_id = 4")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    hashes = {r.doc_id: set(r.hashes) for r in winnow.winnow(odd).collect()}
    assert hashes[3] & hashes[4] and len(hashes[6]) == 1


def test_winnowing_guarantee():
    from pairloom.llm.text import Powers

    rng = np.random.default_rng(2)
    for _ in range(50):
        shared = bytes(rng.integers(97, 105, winnow.K + winnow.W - 1).astype(np.uint8))
        a, b = (bytes(rng.integers(97, 105, n).astype(np.uint8)) + shared + bytes(rng.integers(97, 105, 90).astype(np.uint8)) for n in rng.integers(0, 200, 2))
        x, y = (winnow.fingerprints(np.frombuffer(t, np.uint8), np.array([0, len(t)]), Powers())[0] for t in (a, b))
        assert set(x[0].tolist()) & set(y[0].tolist()) and (np.diff(x[1]) > 0).all()


@pytest.mark.parametrize("parts", [1, 4])
def test_lines(spark, odd, none, parts):
    assert lines.line_keep_bitmaps(none).count() == 0
    got = {}
    for r in lines.line_keep_bitmaps(odd.repartition(parts)).collect():
        got[r.doc_id] = (r.n_lines, r.n_dropped)
    assert got[1] == (1, 0) and got[2] == (1, 0) and got[10] == (3, 2)
    assert [got[20 + i] for i in range(5)] == [(2, 1)] * 4 + [(2, 0)]
    assert lines.apply_bitmap("a\nb\nc", zlib.compress(np.packbits(np.array([1, 0, 1], np.uint8)).tobytes()), 3) == "a\nc"


def test_line_runs_over_many_partitions(spark):
    """A key that fills several range partitions: only the largest document keeps it."""
    rows = spark.createDataFrame([(i, f"{LINE}\nown {i}") for i in range(300)] + [(1000 + i, LINE + str(i % 80)) for i in range(320)], "doc_id long, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r.n_dropped for r in lines.line_keep_bitmaps(rows).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])
    assert got == {**{i: int(i < 299) for i in range(300)}, **{1000 + i: 0 for i in range(320)}}


@pytest.mark.parametrize("fit, score", [(quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)])
def test_classifiers(spark, odd, none, fit, score):
    labels = spark.createDataFrame([(i, int(i < 20), int(i < 20)) for i in (3, 4, 6, 7, 8, 9, 10, 20, 21, 22, 23, 24, 30)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    assert fit(none, labels) is None and fit(odd, labels.limit(0)) is None
    model = fit(odd, labels)
    got = score(odd, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got) and got[0]["shard"] == "mine"
    assert score(none, model).count() == 0 and score(odd, None).count() == len(ROWS)
    by_text = {}
    for r in got:
        by_text.setdefault(r.text or "", []).append(r.score)
    assert all(max(v) - min(v) < 1e-4 for v in by_text.values())


def test_mixing(odd, none):
    args = ("doc_id", "text", sharding.F.lit("d"), {"lang": {"en": 3}}, (1, 1))
    assert mixing.mix_to_weights(none, *args).count() == 0
    whole = mixing.mix_to_weights(odd, *args).toPandas()
    assert len(whole) == len(ROWS) and set(whole.copies) == {1} and whole.lang.isna().sum() == 1
    twice = mixing.mix_to_weights(odd, "doc_id", "text", sharding.F.lit(None).cast("string"), {}, (2, 1), max_epochs=3).toPandas()
    assert twice.copies.max() <= 3 and (twice.n_tokens * twice.copies).sum() <= 2 * whole.n_tokens.sum() and set(twice.domain) == {"unknown"}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10), ("a", "y", "1", 1000), ("b", "x", "1", 1000)], "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang): r.quota for r in mixing.leaf_quotas(leaves, {}, (1, 2), 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 492, ("b", "x"): 502}


def test_leaks(spark, odd, none):
    items = spark.createDataFrame([(1, "Two words here and there. Then"), (2, None), (None, "x"), (3, ""), (4, BODY)], "item_id long, text string")
    assert decontaminate.find_leaks(none, items).count() == 0 and decontaminate.find_leaks(odd, items.limit(0)).count() == 0
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(odd, items).collect()} == {(None, 4), (3, 4), (4, 4)}
    kept = decontaminate.without_leaks(odd, items)
    assert kept.count() == len(ROWS) - 4 and kept.columns == odd.columns


def test_spans(odd, none):
    assert pii.fit_spans(none) == {} and pii.find_spans(none, {}).count() == 0
    got = {r.doc_id: r for r in pii.find_spans(odd, pii.fit_spans(odd)).collect()}
    assert [tuple(s) for s in got[30].base] == [("email", 5, 13)] and got[1].spans == [] and got[2].spans == []


def test_stages(spark, odd, none, tmp_path):
    spark.createDataFrame([(i, int(i < 20), 0) for i in (3, 4, 6, 8, 9, 10, 20, 21, 22, 30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(4, BODY)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0
        got = stage(spark, odd, str(tmp_path))
        assert set(odd.columns) <= set(got.columns) and len(set(got.columns)) == len(got.columns)
        rows = got.collect()
        ids = [r.doc_id for r in rows]
        if name == "near_copies":
            assert ids.count(3) == 1 and 4 not in ids and None not in ids and {1, 2, 5, 6} <= set(ids) and 7 not in ids
        if name == "benchmark":
            assert not {None, 3, 4} & set(ids) and len(ids) == len(ROWS) - 4
