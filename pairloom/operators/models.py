"""Random forest and logistic models on ``pyspark.ml``: training, scoring, coefficients."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.scalars import log_likelihood
from pairloom.operators.features import feature_hasher, filled_slots
from pairloom.session import store

# Defaults of the two model families.
TREES = 10
MIN_SPLIT = 2
MIN_VARIANCE_SHARE = 0.001
LAMBDA = 1e-4
HASHED_FEATURES = 1000
PASSES = 10
#: as deep as Spark grows trees
MAX_DEPTH = 30


def _texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns}) if columns else df


def train_forest(
    train: DataFrame,
    label: str,
    features: Sequence[str],
    categorical: Sequence[str],
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = 42,
    regression: bool = False,
    min_variance_share: float | None = None,
    bootstrap: bool = True,
) -> PipelineModel:
    """Random forest over mixed features, in the given feature order.

    Categoricals are indexed in value order; values unseen in training get their own index. The label
    is 0/1, or a number with ``regression``. Spark grows every tree over all partitions. A split must lower a node's
    impurity by ``min_variance_share`` of the root's, so a node below that share of the root's variance stays whole. By
    default that holds for numbers only (``MIN_VARIANCE_SHARE``); trees of classes grow as long as a split gains anything.
    """
    listed = [f for f in features if f in categorical]
    base = _texts(train, listed).withColumn(label, F.col(label).cast("double"))
    share = min_variance_share if min_variance_share is not None else MIN_VARIANCE_SHARE if regression else 0.0
    variance = base.agg(F.var_pop(label)).first()[0] or 0.0 if share else 0.0
    root_impurity = variance if regression else 2 * variance  # Gini of a 0/1 label is twice its variance
    stages, widest = [], 2
    if listed:
        indexer = StringIndexer(
            inputCols=listed, outputCols=[f"{f}__ix" for f in listed], handleInvalid="keep", stringOrderType="alphabetAsc"
        ).fit(base)
        widest = max(len(v) for v in indexer.labelsArray) + 1
        stages.append(indexer)
    stages.append(
        VectorAssembler(inputCols=[f"{f}__ix" if f in listed else f for f in features], outputCol="features")
    )
    learner = RandomForestRegressor if regression else RandomForestClassifier
    stages.append(
        learner(
            labelCol=label, featuresCol="features", numTrees=trees, maxDepth=max_depth, minInstancesPerNode=MIN_SPLIT,
            minInfoGain=share * root_impurity, maxBins=max(32, widest), seed=seed, bootstrap=bootstrap,
        )
    )
    # fitted stages pass through Pipeline.fit unchanged
    return Pipeline(stages=stages).fit(base)


def categorical_inputs(model: PipelineModel) -> list[str]:
    first = model.stages[0]
    return list(first.getInputCols()) if first.hasParam("stringOrderType") else []


def index_inputs(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with those categorical inputs of the model that they hold replaced by their places (``<name>__ix``), and its
    other inputs as they are. Where rows are paired, each side is indexed once instead of once a pair."""
    listed = [c for c in categorical_inputs(model) if c in df.columns]
    return model.stages[0].transform(_texts(df, listed)).drop(*listed) if listed else df


def score_forest(model: PipelineModel, df: DataFrame, score: str = "score") -> DataFrame:
    """Adds ``score``, the probability of label 1 (the predicted number for a regression forest). Categorical inputs are
    values, or places that ``index_inputs`` put in their stead."""
    given = [c for c in categorical_inputs(model) if not (c not in df.columns and f"{c}__ix" in df.columns)]
    raw = model.transform(_texts(df, given))  # the indexer passes over inputs that are not there
    classifier = isinstance(model.stages[-1], RandomForestClassificationModel)
    value = vector_to_array("probability")[1] if classifier else F.col("prediction")
    return raw.select(*[F.col(c) for c in df.columns], value.alias(score), "prediction")


@dataclass
class Branch:
    """An inner node of a tree: rows whose ``feature`` is at most ``threshold`` (or one of ``categories``) go to ``left``.
    Children are numbers: leaves count from 0 in the order of the description, inner nodes from -1 downwards."""

    level: int
    feature: int
    condition: str
    threshold: float | None
    categories: list[float] | None
    left: int | None = None
    right: int | None = None


def tree_branches(model: PipelineModel, tree: int = 0) -> tuple[list[Branch], list[float]]:
    """The inner nodes (-1, -2, ...; the root is -1 unless it is a leaf) and the predictions of the leaves (0, 1, ...) of one
    tree, from the model's own description."""
    branches: list[Branch] = []
    leaves: list[float] = []
    path: list[tuple[int, Branch, bool]] = []  # indent, inner node, whether its right side comes next

    def attach(child: int) -> None:
        if path:
            _, parent, right = path[-1]
            if right:
                parent.right = child
            else:
                parent.left = child

    for line in model.stages[-1].trees[tree].toDebugString.splitlines()[1:]:
        depth, text = len(line) - len(line.lstrip()), line.strip()
        if text.startswith("Else"):
            while path[-1][0] > depth:
                path.pop()
            path[-1] = (depth, path[-1][1], True)
            continue
        while path and path[-1][0] >= depth:
            path.pop()
        if text.startswith("Predict:"):
            attach(len(leaves))
            leaves.append(float(text.split(":")[1]))
            continue
        _, number, condition = text[text.index("(") + 1 : text.rindex(")")].split(" ", 2)  # feature, number, condition
        listed = [float(v) for v in condition[condition.index("{") + 1 : -1].split(",")] if condition.startswith("in") else None
        found = Branch(len(path), int(number), condition, None if listed else float(condition.split(" ")[1]), listed)
        branches.append(found)
        attach(-len(branches))
        path.append((depth, found, False))
    return branches, leaves


def tree_nodes(model: PipelineModel, tree: int = 0) -> DataFrame:
    """``(leaf, rule, prediction)`` of one tree: the conjunction of splits that leads to each leaf, as SQL over the
    model's input columns (categoricals as ``<name>__ix``), from the model's own description."""
    names = model.stages[-2].getInputCols()
    branches, leaves = tree_branches(model, tree)
    rows: list[tuple[int, str, float]] = []
    todo = [(-1 if branches else 0, "")]
    while todo:
        node, rule = todo.pop()
        if node >= 0:
            rows.append((node, rule or "true", leaves[node]))
            continue
        b = branches[-node - 1]
        name, held = f"`{names[b.feature]}`", b.condition.replace("{", "(").replace("}", ")")
        other = f"not {held}" if b.categories else held.replace("<=", ">")
        todo += [(child, f"{rule} and {name} {c}" if rule else f"{name} {c}") for child, c in ((b.right, other), (b.left, held))]
    return SparkSession.active().createDataFrame(rows, "leaf int, rule string, prediction double")


#: levels a plan sends rows down before they are written down: it grows by a join a level
LEVELS_PER_PASS = 10
#: inner nodes of a level that are sent along with the tasks
SENT_NODES = 200_000


def tree_leaves(model: PipelineModel, rows: DataFrame, inputs: Sequence[str], tree: int = 0) -> DataFrame:
    """Rows with ``leaf``, the leaf of one tree that its splits send them to: the nodes are a table, and a row meets the one
    it is at in every level. ``inputs`` are the columns the splits number."""
    branches, _ = tree_branches(model, tree)
    at = rows.withColumn("_x", F.array(*[F.col(f"`{c}`").cast("double") for c in inputs])).withColumn("leaf", F.lit(-1 if branches else 0))
    if not branches:
        return at.drop("_x")
    table = [(-i, b.level, b.feature, b.threshold, b.categories, b.left, b.right) for i, b in enumerate(branches, 1)]
    schema = "_node int, _level int, _feature int, _threshold double, _categories array<double>, _left int, _right int"
    nodes = store(rows.sparkSession.createDataFrame(table, schema))
    widths = Counter(b.level for b in branches)
    x = F.get("_x", F.col("_feature"))
    goes_left = F.when(F.col("_categories").isNull(), x <= F.col("_threshold")).otherwise(F.array_contains("_categories", x))
    step = F.when(F.col("_node").isNull(), F.col("leaf")).when(goes_left, F.col("_left")).otherwise(F.col("_right"))
    for level in range(len(widths)):
        if level and level % LEVELS_PER_PASS == 0:
            at = store(at)
        met = nodes.where(F.col("_level") == level).drop("_level")
        if widths[level] <= SENT_NODES:
            met = F.broadcast(met)
        at = at.join(met, F.col("leaf") == F.col("_node"), "left").select(*rows.columns, "_x", step.alias("leaf"))
    return at.drop("_x")


def leaf_audit(model: PipelineModel, train: DataFrame, label: str, tree: int = 0) -> DataFrame:
    """``(leaf, rows, votes, differing)`` of one tree: training rows are sent down by the tree's rules as column
    expressions; ``differing`` counts rows whose leaf's class counts are not those the tree itself votes with. 0 for a
    tree that has seen every row once (``bootstrap=False``)."""
    listed = categorical_inputs(model)
    ready = PipelineModel(model.stages[:-1]).transform(_texts(train, listed).withColumn(label, F.col(label).cast("double")))
    names = list(model.stages[-2].getInputCols())
    own = model.stages[-1].trees[tree]
    voted = own.transform(ready).select(*dict.fromkeys(names), F.col(label).alias("_y"), vector_to_array("rawPrediction").alias("_votes"))
    routed = tree_leaves(model, voted, names, tree).select("leaf", "_y", "_votes")
    n_classes = own.numClasses
    counts = routed.groupBy("leaf", "_votes").agg(*[F.count_if(F.col("_y") == k).alias(f"_c{k}") for k in range(n_classes)], F.count("*").alias("rows"))
    counts = store(counts)
    per_leaf = counts.groupBy(F.col("leaf").alias("_leaf")).agg(F.array(*[F.sum(f"_c{k}").cast("double") for k in range(n_classes)]).alias("_seen"))
    told = counts.join(per_leaf, F.col("leaf").eqNullSafe(F.col("_leaf")))
    alike = F.col("leaf").isNotNull() & (F.col("_votes") == F.col("_seen"))
    return told.select("leaf", "rows", F.col("_votes").alias("votes"), F.when(alike, F.lit(0).cast("bigint")).otherwise(F.col("rows")).alias("differing"))


@dataclass(frozen=True)
class LogisticSpec:
    """What a logistic model reads."""

    label: str
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    features: int = HASHED_FEATURES


def train_logistic(
    train: DataFrame,
    spec: LogisticSpec,
    passes: int = PASSES,
    lam: float = LAMBDA,
    tol: float = 1e-6,
) -> PipelineModel:
    """L1-regularised logistic regression with an intercept over hashed features."""
    base = _null_free(train, spec).withColumn(spec.label, F.col(spec.label).cast("double"))
    return Pipeline(
        stages=[
            feature_hasher(spec.categorical, spec.numeric, spec.features),
            LogisticRegression(
                labelCol=spec.label, featuresCol="features", elasticNetParam=1.0, regParam=lam, maxIter=passes, tol=tol,
                fitIntercept=True,
            ),
        ]
    ).fit(base)


def _null_free(df: DataFrame, spec: LogisticSpec) -> DataFrame:
    """Payment policy: NULL features count as 0."""
    ready = {c: F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in spec.categorical}
    ready |= {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in spec.numeric}
    return df.withColumns(ready)


def score_logistic(model: PipelineModel, df: DataFrame, spec: LogisticSpec, score: str = "score") -> DataFrame:
    """Adds ``score``, the probability of label 1."""
    own = [c for c in df.columns if c not in (*spec.categorical, *spec.numeric)]
    kept = F.struct(*df.columns).alias("_row")
    raw = model.transform(_null_free(df.select("*", kept), spec).drop(*own))
    return raw.select("_row.*", vector_to_array("probability")[1].alias(score))


def train_classes(
    train: DataFrame, spec: LogisticSpec, passes: int = PASSES, lam: float = LAMBDA, tol: float = 1e-6
) -> PipelineModel:
    """The same for a label of any number of values: one weight row per class, and the list of classes (in text order)
    kept in the model. Rows without a label are left out."""
    base = _null_free(train, spec).withColumn(spec.label, F.col(spec.label).cast("string")).where(F.col(spec.label).isNotNull())
    indexer = StringIndexer(inputCol=spec.label, outputCol="_class", stringOrderType="alphabetAsc").fit(base)
    learner = LogisticRegression(
        labelCol="_class", featuresCol="features", family="multinomial", elasticNetParam=1.0, regParam=lam, maxIter=passes, tol=tol, fitIntercept=True
    )
    return Pipeline(stages=[indexer, feature_hasher(spec.categorical, spec.numeric, spec.features), learner]).fit(base)


def class_list(model: PipelineModel) -> list[str]:
    """The classes of a logistic model that have a weight row: all of them, or label 1 alone of a binary one."""
    first = model.stages[0]
    return list(first.labels) if isinstance(first, StringIndexerModel) else ["1"]


def score_classes(model: PipelineModel, df: DataFrame, spec: LogisticSpec) -> DataFrame:
    """Adds ``scores`` (class -> probability) and ``predicted``, the likeliest class (ties: the first in text order)."""
    own = [c for c in df.columns if c not in (*spec.categorical, *spec.numeric)]
    rows = _null_free(df.select("*", F.struct(*df.columns).alias("_row")), spec).drop(*own)
    raw = PipelineModel(model.stages[1:]).transform(rows)
    classes = F.array(*[F.lit(c) for c in class_list(model)])
    p = vector_to_array("probability")
    return raw.select("_row.*", F.map_from_arrays(classes, p).alias("scores"), F.element_at(classes, F.array_position(p, F.array_max(p)).cast("int")).alias("predicted"))


def _weight_rows(model: PipelineModel) -> tuple[list[list[float]], list[float]]:
    """Weights and intercept per class of ``class_list``."""
    logistic: LogisticRegressionModel = model.stages[-1]
    return [list(map(float, r)) for r in logistic.coefficientMatrix.toArray()], list(map(float, logistic.interceptVector))


def coefficient_table(model: PipelineModel, train: DataFrame, spec: LogisticSpec) -> DataFrame:
    """``(class, predictor, slot, weight)``: the non-zero weight behind every number and every category value, for
    each class of the model.

    Slots of category values are found by hashing the distinct values of the training rows, so the work
    is one distinct over narrow columns; the weights are at most ``spec.features`` numbers a class.
    """
    spark = train.sparkSession
    classes, (rows, intercepts) = class_list(model), _weight_rows(model)
    weights = [(c, i, w) for c, row in zip(classes, rows) for i, w in enumerate(row) if w != 0.0]
    table = spark.createDataFrame(weights, "class string, slot int, weight double")

    names = _null_free(train, spec).select(*spec.categorical)
    if spec.categorical:
        cells = names.unpivot([], list(spec.categorical), "attr", "value").distinct()
    else:
        cells = spark.createDataFrame([], "attr string, value string")
    numbers = spark.createDataFrame([(c, None) for c in spec.numeric], "attr string, value string")
    listed = cells.unionByName(numbers)
    # one column per predictor, only its own set: the hasher skips NULLs, so one slot stays non-zero
    probe = listed.select(
        "attr",
        "value",
        *[F.when(F.col("attr") == c, F.col("value")).alias(c) for c in spec.categorical],
        *[F.when(F.col("attr") == c, F.lit(1.0)).alias(c) for c in spec.numeric],
    )
    hashed = model.stages[-2].transform(probe)
    predictor = F.concat_ws("=", "attr", "value")
    found = hashed.select(predictor.alias("predictor"), filled_slots()[0]["slot"].alias("slot"))
    bias = spark.createDataFrame([(c, "(intercept)", -1, b) for c, b in zip(classes, intercepts)], "class string, predictor string, slot int, weight double")
    return found.join(table, "slot").select("class", "predictor", "slot", "weight").unionByName(bias)


def optimality(model: PipelineModel, train: DataFrame, spec: LogisticSpec, lam: float = LAMBDA) -> DataFrame:
    """``(class, slot, weight, gradient, bound, excess)``: the first-order condition of the L1 fit for every filled slot
    and (slot -1, bound 0) the intercept, recomputed from the hashed training rows.

    The gradient is that of the mean log loss by the weight of the standardised slot, which costs ``lam`` for each unit. At an
    optimum it is ``-lam * sign(weight)`` where a weight is set and within ``lam`` where it is 0; ``excess`` is how far it is
    from that. Slots of one value carry no weight and no cost.
    """
    classes, (rows, _) = class_list(model), _weight_rows(model)
    several = isinstance(model.stages[0], StringIndexerModel)
    base = _null_free(train, spec).where(F.col(spec.label).isNotNull())
    base = base.withColumn(spec.label, F.col(spec.label).cast("string" if several else "double"))
    scored = model.transform(base)
    p = vector_to_array("probability")
    truth = F.col("_class") if several else F.col(spec.label)
    error = [p[k] - (truth == k).cast("double") for k in (range(len(classes)) if several else [1])]
    kept = scored.select(filled_slots().alias("_filled"), F.array(*error).alias("_error"))
    slots = F.concat(F.array(F.struct(F.lit(-1).alias("slot"), F.lit(1.0).alias("value"))), F.col("_filled"))
    cells = kept.select("_error", F.explode(slots).alias("_s")).select("_error", "_s.slot", F.col("_s.value").alias("value"))
    sums = cells.groupBy("slot").agg(
        F.sum("value").alias("_x"), F.sum(F.col("value") * F.col("value")).alias("_xx"),
        *[F.sum(F.col("_error")[k] * F.col("value")).alias(f"_g{k}") for k in range(len(classes))],
    )
    n = scored.agg(F.count("*").cast("double")).scalar()
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("_xx") - F.col("_x") * F.col("_x") / n) / (n - 1))
    per_class = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"_g{k}").alias("g")) for k, c in enumerate(classes)]))
    weights = train.sparkSession.createDataFrame([(c, i, w) for c, row in zip(classes, rows) for i, w in enumerate(row) if w != 0.0], "class string, slot int, weight double")
    scale = F.when(F.col("slot") < 0, 1.0).when(spread > 1e-9, spread)
    found = sums.select("slot", scale.alias("_scale"), per_class.alias("c")).select("c.class", "slot", "_scale", (F.col("c.g") / n / F.col("_scale")).alias("gradient"))
    joined = found.join(weights, ["class", "slot"], "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    bound = F.when(F.col("slot") < 0, 0.0).otherwise(F.lit(float(lam)))
    off = F.when((F.col("weight") != 0) | (F.col("slot") < 0), F.abs(F.col("gradient") + bound * F.signum("weight"))).otherwise(F.greatest(F.lit(0.0), F.abs("gradient") - bound))
    return joined.select("class", "slot", "weight", "gradient", bound.alias("bound"), F.when(F.col("_scale").isNull(), 0.0).otherwise(off).alias("excess"))


def score_propensity(
    model: PipelineModel,
    df: DataFrame,
    spec: LogisticSpec,
    keep: Sequence[str],
    threshold: float = 0.5,
) -> DataFrame:
    """``(keep..., score, likelihood, predicted)``: likelihood is that of the known label."""
    scored = score_logistic(model, df, spec)
    return scored.select(
        *keep,
        "score",
        log_likelihood(spec.label, "score").alias("likelihood"),
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
