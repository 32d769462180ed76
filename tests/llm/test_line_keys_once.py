"""Keys of lines are made once, not again to set the borders of the range partition."""

from pairloom.llm import lines


def test_range_partition_reads_written_keys(spark, monkeypatch):
    plans, plain_store = [], lines.store

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain_store(df)

    monkeypatch.setattr(lines, "store", seen)
    common = "a line that is long enough to be a key of its own, here"
    rows = [(i, f"{common}\nshort {i}") for i in range(7)]
    got = lines.line_keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_dropped for r in got} == {i: int(i < 6) for i in range(7)}
    ranged = [p for p in plans if "RepartitionByExpression" in p]
    assert len(ranged) == 1 and "MapInArrow" not in ranged[0] and any("MapInArrow" in p for p in plans)
