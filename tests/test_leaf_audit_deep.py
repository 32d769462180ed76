"""The leaf audit of trees that are grown on many rows: their rules are too long for one expression."""

import random

from conftest import rows
from pyspark.sql import functions as F

from pairloom.operators import models


def test_audit_of_a_tree_of_thousands_of_leaves(spark):
    r = random.Random(5)
    data = [(r.randint(0, 1), r.random(), r.random(), r.choice("abcdef")) for _ in range(8000)]
    df = spark.createDataFrame(data, "y int, x double, z double, c string")
    model = models.train_forest(df, "y", ["x", "z", "c"], ["c"], trees=1, bootstrap=False)
    branches, leaves = models.tree_branches(model)
    assert len(leaves) == len(branches) + 1 > 1000 and any(b.categories for b in branches)
    audit = models.leaf_audit(model, df, "y").agg(F.sum("rows"), F.sum("differing"), F.countDistinct("leaf")).first()
    assert tuple(audit) == (8000, 0, len(leaves))


def test_rows_reach_the_leaf_whose_rule_holds(spark):
    r = random.Random(6)
    data = [(i, r.randint(0, 1), r.randint(0, 9), r.choice("abcdef")) for i in range(300)]
    df = spark.createDataFrame(data, "i int, y int, x int, c string")
    model = models.train_forest(df, "y", ["x", "c"], ["c"], trees=1, bootstrap=False)
    ready = model.stages[0].transform(df)
    names = list(model.stages[-2].getInputCols())
    want = [(row.i, n.leaf) for n in models.tree_nodes(model).collect() for row in ready.where(n.rule).select("i").collect()]
    assert len(want) == 300 and rows(models.tree_leaves(model, ready, names).select("i", "leaf")) == sorted(want, key=repr)


def test_a_tree_of_one_leaf(spark):
    df = spark.range(20).selectExpr("id as x", "1 as y")
    model = models.train_forest(df, "y", ["x"], [], trees=1, bootstrap=False)
    found = models.leaf_audit(model, df, "y").collect()
    assert [(r.leaf, r.rows, r.differing) for r in found] == [(0, 20, 0)]
