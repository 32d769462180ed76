"""The text queries against their SQL, and against plain versions where SQL cannot state them."""

import glob
import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pytest

import corpus_pipeline
from pairloom.llm import decontaminate, pii, queries, sharding, suffixes, toxicity
from pairloom.llm.queries import LLM_ORACLE, LLM_QUERIES
from pairloom.llm.text import Powers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


def plain(df):
    return df[sorted(df.columns)].astype(str).replace({"nan": "<NA>", "None": "<NA>"}).sort_values(sorted(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_its_sql(spark, duck, name):
    got, want = LLM_QUERIES[name](spark, SF).toPandas(), duck.execute(LLM_ORACLE[name]).df()
    pd.testing.assert_frame_equal(plain(got), plain(want))


def test_hilbert_places_are_neighbours():
    for bits, n in ((3, 2), (2, 3)):
        at = {}
        for c in range(1 << bits * n):
            axes = [c >> bits * i & (1 << bits) - 1 for i in range(n)]
            at[sharding.hilbert_place(axes, bits)] = axes
        assert sorted(at) == list(range(1 << bits * n))
        for i in range(1, len(at)):
            assert sum(abs(a - b) for a, b in zip(at[i - 1], at[i])) == 1


def test_shards_differ_by_one_row_at_most(spark):
    got = LLM_QUERIES["op2_hilbert_shards"](spark, SF).toPandas()
    n = got.groupby("shard").size()
    assert len(n) == 16 and n.max() - n.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def removed(texts: list[tuple[int, str]], length: int = 50) -> dict:
    first: dict[bytes, int] = {}
    out = {}
    for d, t in sorted(texts):
        b = (t or "").encode()
        mark = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first.setdefault(b[i : i + length], d) < d:
                mark[i : i + length] = True
        out[d] = (len(b), int(mark.sum()), int((np.diff(np.concatenate(([0], mark.astype(int)))) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~mark].tobytes()).hexdigest())
    return out


def split_finely(monkeypatch, chunk, bucket):
    """Many chunks, fragments and buckets; leads of more than ``bucket`` bytes are dealt window by window."""
    for name, value in {"CHUNK_BYTES": chunk, "FRAGMENT_BYTES": chunk, "BUCKET_BYTES": bucket, "PIECE_WINDOWS": 1000, "SAMPLE_DOCS": 1, "SAMPLE_EVERY": 1}.items():
        monkeypatch.setattr(suffixes, name, value)


@pytest.mark.parametrize("chunk, bucket", [(16_000_000, 16_000_000), (30_000, 2_000)])
def test_suffix_dedup_matches_every_window(spark, docs, monkeypatch, chunk, bucket):
    split_finely(monkeypatch, chunk, bucket)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in LLM_QUERIES["op3_suffix_dedup"](spark, SF).collect()}
    assert got == removed(list(zip(docs.doc_id, docs.text)))
    assert sum(v[1] for v in got.values()) > 0


def test_suffix_dedup_with_a_passage_in_a_third_of_the_documents(spark, monkeypatch):
    split_finely(monkeypatch, 20_000, 3_000)
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(3, 9)))
    passage = " ".join(word() for _ in range(30))
    rows = []
    for i in range(300):
        text = " ".join(word() for _ in range(60))
        at = int(rng.integers(0, len(text)))
        rows.append((i * 7, text[:at] + passage + text[at:] if i % 3 == 0 else text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    parts = suffixes.repeated_spans(df)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df).collect()}
    assert got == removed(rows) and sum(v[1] >= len(passage) for v in got.values()) == 99
    assert parts.count() > 0


def test_hot_suffixes_are_dealt_by_their_bytes():
    texts = ["x" * i + "common beginning of a passage that is long, " + f"then{i}" * 20 for i in range(40)]
    raw = [t.encode() for t in texts]
    table = pa.table({"chunk": pa.array([0] * 40, pa.int32()), "_id": list(range(40)), "_text": texts, "_th": list(range(40))})
    bits, length = 40, 50
    asked = suffixes._ask(length, bits, 6)(table)
    answers = pa.concat_tables([suffixes._answer(asked.filter(pc.equal(asked["frag"], f))) for f in asked["frag"].unique()])
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    leads = np.unique(suffixes._leads(data, suffixes._all_bundles(data, offs, length, Powers())[2]))
    none = np.zeros(0, np.uint64)
    found = {}
    for name, (hot, deal) in {"plain": (none, none.astype(np.int64)), "hot": (leads, np.full(len(leads), 3))}.items():
        sent = suffixes._settle(length, bits, 6, none, hot, deal, 1000)(table, answers).to_pandas()
        if name == "hot":
            assert sent[~sent.settled].bucket.nunique() > 3
        spans = pd.concat([suffixes._bucket(length, 1000)(f) for _, f in sent.groupby("bucket")])
        found[name] = {d: suffixes.union_of(list(f.start), list(f.end)) for d, f in spans.groupby("doc")}
    assert found["plain"] == found["hot"] and found["hot"]


def test_multikey_groups_sorts_and_groups():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    order, group = suffixes.multikey_groups(words)
    rows = [tuple(r) for r in words[order]]
    assert rows == sorted(rows)
    assert [g for g in group] == [sorted(set(rows)).index(r) for r in rows]


def test_winnowing(spark, docs):
    got = LLM_QUERIES["op4_winnowing"](spark, SF).toPandas().set_index("doc_id")
    order = sorted(docs.doc_id, reverse=True)
    text = dict(zip(docs.doc_id, docs.text))
    by_text: dict[str, set] = {}
    for i, d in enumerate(order):
        t, following = text[d], text[order[(i + 1) % len(order)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        assert got.edited_sha256[d] == hashlib.sha256(edited.encode()).hexdigest() and got.n_chars[d] == len(t)
        by_text.setdefault(t, set()).add(got.fingerprint[d])
    assert all(len(v) == 1 for v in by_text.values())
    assert got[["near_edited", "near_next"]].stack().between(0, 1).all() and got.near_edited.mean() > 5 * got.near_next.mean()


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = LLM_QUERIES["op6_quality_mil"](spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    out = got[got.held_out]
    assert (out.predicted == out.quality).mean() > 0.95 and (out.predicted == (out.score >= 0.7)).all()


def test_toxicity_on_held_out_labels():
    sf = "/root/testdata/sf0.1"
    d = pd.read_parquet(f"{sf}/documents.parquet").merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    out = d.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    learn, test = d[~out], d[out]
    learn = pd.concat([learn[learn.toxic == 1], learn[learn.toxic == 0][:1200]])
    p = toxicity.train(list(learn.text), learn.toxic.to_numpy(np.float32), 0.0, epochs=4)
    raw = [t.encode() for t in test.text]
    score = pd.Series(toxicity.text_scores(p, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), Powers()))
    rank, y = score.rank().to_numpy(), test.toxic.to_numpy()
    assert (rank[y == 1].mean() - (y.sum() + 1) / 2) / (len(y) - y.sum()) > 0.9


def test_toxicity_scores_do_not_depend_on_the_batch():
    p = toxicity.train(["you fool " * 3, "good day " * 30, "a fool here " * 40, "nice words only"] * 4, np.array([1, 0, 1, 0] * 4, np.float32), 0.0, epochs=2)
    texts = ["", "...", "fool", "good day " * 200 + "fool", "x " * 64, "x " * 65]
    together = toxicity.text_scores(p, *_slice(texts), Powers())
    alone = [toxicity.text_scores(p, *_slice([t]), Powers())[0] for t in texts]
    np.testing.assert_allclose(together, alone, rtol=1e-4)


def _slice(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def words(t):
    return " " + " ".join(re.findall(r"\w+", t.lower())) + " "


def test_leaks_are_the_documents_that_hold_an_item(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = pd.read_parquet(f"{sf}/documents.parquet"), pd.read_parquet(f"{sf}/benchmark.parquet")
    want = {(d, i) for d, t in zip(docs.doc_id, map(words, docs.text)) for i, q in zip(items.item_id, map(words, items.text)) if q in t}
    got = LLM_QUERIES["op8_benchmark_leaks"](spark, sf).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and want


def test_index_scores_as_plain_bm25():
    items = [(i, t) for i, t in enumerate(["alpha beta gamma delta. epsilon zeta", "beta beta eta theta. iota", "one two three four five. six seven"])]
    ix = decontaminate.build_index(items)
    term, item = ix.posting, ix.impact
    assert len(term) == len(item) and ix.span == 7
    for i in range(3):
        assert abs(item[term == i].sum() - 1 / decontaminate.SHARE) < 1e-4
    found = list(decontaminate.leaks(ix, *_slice(["xx " * 40 + "Alpha, beta gamma delta! Epsilon zeta" + " yy" * 50, "alpha beta only", ""]), Powers()))
    assert [(r, i) for r, i, *_ in found] == [(0, 0)]


def test_personal_data_base_spans(spark, docs):
    got = {r.doc_id: r for r in LLM_QUERIES["op10_pii_boosting"](spark, SF).collect()}
    for d, t in zip(docs.doc_id, docs.text):
        want = []
        for kind, pattern in pii.STRICT.items():
            want += [(m.start(), pii.KINDS.index(kind), f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern.pattern, t) if pii.passes(kind, m[0])]
        names = [s for *_, s in sorted(want)]
        assert got[d].base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(got[d].spans.split(",")) | {""}
        assert got[d].n_email == sum(n.startswith("email") for n in names) and got[d].n_card == sum(n.startswith("card") for n in names)


def test_personal_data_checks():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    text = "write to a.b@c.org or call +1 (415) 555-0100, from 10.0.0.1 not 10.0.0.999"
    spans = pii.base_spans(text)
    assert [(k, text[a:b]) for a, k, b in spans] == [("email", "a.b@c.org"), ("phone", "+1 (415) 555-0100"), ("ip", "10.0.0.1")]
    assert pii.redact(text, spans) == "write to <email> or call <phone>, from <ip> not 10.0.0.999"


def test_boosted_trees_learn_a_rule_and_threshold():
    rng = np.random.default_rng(1)
    x = rng.random((600, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.7)).astype(float)
    score = pii.boosted_score(pii.boost(x, y), x)
    at = pii.threshold_for(score, y, 0.95)
    assert y[score >= at].mean() >= 0.95 and (score >= at).sum() > 0.8 * y.sum()
    assert pii.threshold_for(np.array([0.4, 0.3]), np.array([0.0, 0.0])) == 2.0


def test_pipeline_stages_against_plain_versions(spark, duck, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, table, SF).toPandas()
    assert list(kept.columns) == list(docs.columns)
    truth = labels.set_index("doc_id").quality
    known = [d for d in docs.doc_id if d in truth.index]
    assert np.mean([(d in set(kept.doc_id)) == bool(truth[d]) for d in known]) > 0.9

    want = duck.execute(queries.JACCARD_SQL).df()
    one = stages["near_copies"](spark, table, SF).toPandas()
    assert set(one.doc_id) == set(want[want.doc_id == want.component_id].doc_id)

    items = [words(t) for t in pd.read_parquet(f"{SF}/benchmark.parquet").text]
    clean = stages["benchmark"](spark, table, SF).toPandas()
    assert set(clean.doc_id) == {d for d, t in zip(docs.doc_id, map(words, docs.text)) if not any(q in t for q in items)}

    mixed = stages["mixing"](spark, table, SF).toPandas()
    assert set(mixed.doc_id) == set(duck.execute(queries.mix_sql(corpus_pipeline.MIX_SHARE, 1, queries.MIX_SEED)).df().doc_id)

    last = stages["sharding"](spark, table, SF).toPandas().set_index("doc_id")
    same = duck.execute(LLM_ORACLE["op2_hilbert_shards"]).df().set_index("doc_id")
    assert (last.shard.sort_index() == same.shard.sort_index()).all() and set(docs.columns) - {"doc_id"} <= set(last.columns)


def test_pipeline_runs_to_the_end(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert got.doc_id.is_unique and len(got) and got.groupby("shard").size().max() - got.groupby("shard").size().min() <= 1
