"""Every query with SQL gives the result of that SQL, however its input is partitioned."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from pairloom.catalog import inputs
from pairloom.catalog.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        try:
            df[c] = df[c].astype(float).round(5)
        except (TypeError, ValueError):
            df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, duck, name):
    got, want = plain(QUERIES[name](spark, SF).toPandas()), plain(duck.execute(ORACLE[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, atol=1e-5)


@pytest.mark.parametrize(
    "name", ["action_table", "match_matrix_rules", "class_distribution", "dataset_descriptor", "split_step", "auc", "distance_bands"]
)
def test_partitioning_does_not_matter(spark, monkeypatch, name):
    whole = plain(QUERIES[name](spark, SF).toPandas())
    read = inputs.table
    monkeypatch.setattr(inputs, "table", lambda s, sf, t: read(s, sf, t).repartition(7))
    pd.testing.assert_frame_equal(plain(QUERIES[name](spark, SF).toPandas()), whole, check_dtype=False)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[-1] == "label"
    assert set(entry.oracle_sql()) <= set(entry.queries())
