"""What the driver holds at once: small plans in the rounds of components, no round for nothing."""

import random

from pairloom.llm import components as stars, jaccard


def roots_of(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {(x, root(x)) for x in up if root(x) != x}


def test_plans_of_a_round_have_one_join(spark, monkeypatch):
    rng = random.Random(2)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 520)] + [(600, 600)]
    joins, plain_store = [], stars.store

    def counting(df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return plain_store(df)

    monkeypatch.setattr(stars, "store", counting)
    got = stars.components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == roots_of(links)
    assert len(joins) > 3 and max(joins) == 1


def test_no_rounds_without_later_links(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(jaccard, "components", lambda edges: calls.append(1) or stars.components(edges))
    texts = ["one two three four five six seven eight nine ten"] * 2 + [f"{i} a{i} b{i} c{i} d{i} e{i}" for i in range(5)]
    got = jaccard.similar_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {0: 0, 1: 0} | {i: i for i in range(2, 7)}
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(0, near), (1, near + " x"), (2, "other words that stand alone here")]
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {0: 0, 1: 0, 2: 2}
    assert len(calls) <= 2  # one for each of both tables
