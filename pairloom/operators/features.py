"""Feature encodings driven by an attribute distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.scalars import log_scaled, max_scaled, mean_centred
from pairloom.operators.clean import NULL_CODE
from pairloom.operators.distribution import log_moments
from pairloom.operators.ordering import running_totals
from pairloom.session import broadcast_if_small, store

# Below this a standard deviation is rounding noise of a constant column.
MIN_SIGMA = 1e-12


def value_places(dist: DataFrame, attrs: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """``(attr, value, pos)``: the 0-based place of every value in ascending order, ranked by ranges and written down;
    and the number of values of each attribute the distribution holds."""
    ranked = store(running_totals(dist.where(F.col("attr").isin(list(attrs))).select("attr", "value"), ["attr"], ["value"]))
    return ranked, {r["attr"]: r["n"] for r in ranked.groupBy("attr").agg(F.count("*").alias("n")).collect()}  # a row per attribute


def _with_places(df: DataFrame, places: DataFrame, dist: DataFrame, attrs: Sequence[str], how: str = "left") -> DataFrame:
    """``df`` with ``_at_<attr>``, the place of its value; null (or, ``how="inner"``, no row) where the distribution does not
    hold it."""
    for f in attrs:
        own = places.where(F.col("attr") == f).select(F.col("value").alias("_value"), F.col("pos").alias(f"_at_{f}"))
        df = df.withColumn("_value", _as_value(dist, f)).join(own, "_value", how).drop("_value")
    return df


def moments_of(moments: DataFrame, attrs: Sequence[str]) -> Column:
    """``attr -> (mu, sigma)`` as a scalar subquery, one entry per configured attribute."""
    entry = F.struct("attr", F.struct("mu", "sigma"))
    listed = moments.where(F.col("attr").isin(list(attrs)))
    return listed.agg(F.map_from_entries(F.collect_list(entry))).scalar()


def z_of(value: Column, moment: Column) -> Column:
    """``(log10 v - mu) / sigma``; 0 for v <= 0 and for constant columns."""
    return F.when(
        (value > 0) & (moment["sigma"] > MIN_SIGMA),
        (F.log10(value.cast("double")) - moment["mu"]) / moment["sigma"],
    ).otherwise(F.lit(0.0))


def _code(attr: str) -> Column:
    return F.coalesce(F.col(attr), F.lit(NULL_CODE))


def one_hot(df: DataFrame, attr: str, dist: DataFrame, name: str) -> DataFrame:
    """0/1 per observed value of ``attr`` in ascending order, as an array: a row is as wide as the domain. A value's place
    comes by a join, so no task holds the domain; ``feature_vectors`` has the same as sparse vectors."""
    places, sizes = value_places(dist, [attr])
    return _with_places(df, places, dist, [attr]).withColumn(name, _indicator(attr, sizes)).drop(f"_at_{attr}")


def _indicator(attr: str, sizes: dict[str, int]) -> Column:
    """The 0/1 array of one attribute from its place; an attribute the distribution does not hold passes through as its
    number."""
    if attr not in sizes:
        return F.array(F.col(attr).try_cast("double"))
    return F.transform(F.sequence(F.lit(0), F.lit(sizes[attr] - 1)), lambda i: F.coalesce(i == F.col(f"_at_{attr}"), F.lit(False)).cast("double"))


def _as_value(dist: DataFrame, attr: str) -> Column:
    """The attribute as the distribution holds it: its type, NULL as -1."""
    value_type = dict(dist.dtypes)["value"]
    return F.coalesce(F.col(attr).cast(value_type), F.lit(NULL_CODE).cast(value_type))


def one_hot_range(df: DataFrame, attr: str, low: int, high: int, name: str) -> DataFrame:
    """0/1 per integer of ``low..high``, as an array."""
    steps = F.sequence(F.lit(low), F.lit(high))
    return df.withColumn(name, F.transform(steps, lambda v: (v == F.col(attr)).cast("int")))


def log_zscore(df: DataFrame, attr: str, moments: DataFrame, name: str) -> DataFrame:
    """Standardised log10 of one column."""
    return df.withColumn(name, z_of(_code(attr), moments_of(moments, [attr])[attr]))


def lookup(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left", max_bytes: int = 16 << 20) -> DataFrame:
    """Join a lookup table on, shipping it to every task only when its bytes are few."""
    return df.join(broadcast_if_small(small, max_bytes), list(on), how)


def freq_encode(df: DataFrame, attr: str, dist: DataFrame, name: str) -> DataFrame:
    """Share of rows that hold this row's value of ``attr``."""
    own = dist.where(F.col("attr") == attr)
    total = own.agg(F.sum("cnt")).scalar()
    shares = own.select(F.col("value").alias("_v"), (F.col("cnt") / total).alias(name))
    keyed = df.withColumn("_v", _as_value(dist, attr))
    return keyed.join(shares, "_v", "left").drop("_v")


def scale_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<c>_max``, ``<c>_mean`` and ``<c>_log`` beside every column, from one pass of global totals."""
    stats = df.agg(
        F.struct(
            *[F.max(c).alias(f"{c}_top") for c in columns],
            *[F.avg(c).alias(f"{c}_mid") for c in columns],
        )
    ).scalar()
    scaled = []
    for c in columns:
        scaled += [
            max_scaled(c, stats[f"{c}_top"]).alias(f"{c}_max"),
            mean_centred(c, stats[f"{c}_mid"]).alias(f"{c}_mean"),
            log_scaled(c).alias(f"{c}_log"),
        ]
    return df.select("*", *scaled)


def profile_key(df: DataFrame, fields: Sequence[str], name: str = "profile_key") -> DataFrame:
    """A 64-bit hash of the feature tuple. The tuple itself stays the identity of a profile."""
    return df.withColumn(name, F.xxhash64(*[_code(f) for f in fields]))


def distinct_profiles(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Distinct feature tuples with how many rows share each; a weighted, much smaller input."""
    return df.groupBy(*keep, *[F.coalesce(F.col(f), F.lit(NULL_CODE).cast(df.schema[f].dataType)).alias(f) for f in fields]).agg(
        F.count("*").alias("n")
    )


def hash_features(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], n: int = 1000, name: str = "features"
) -> DataFrame:
    """Words and numbers hashed into ``n`` slots."""
    return feature_hasher(categorical, numeric, n, name).transform(df)


def feature_hasher(categorical: Sequence[str], numeric: Sequence[str], n: int, name: str = "features") -> FeatureHasher:
    return FeatureHasher(
        inputCols=[*categorical, *numeric], outputCol=name, numFeatures=n, categoricalCols=list(categorical)
    )


def filled_slots(vector: str = "features") -> Column:
    """The filled places of a vector column as ``(slot, value)`` structs, in the JVM."""
    v = F.unwrap_udt(vector)
    slots = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    return F.filter(F.arrays_zip(slots.alias("slot"), v["values"].alias("value")), lambda c: c["value"] != 0)


def feature_matrix(
    df: DataFrame,
    id: str,
    fields: Sequence[str],
    categorical: Sequence[str],
    dist: DataFrame,
    keep: Sequence[str] = (),
    name: str = "features",
) -> DataFrame:
    """``(id, keep..., features)``: one-hot categoricals and log z-scores in configured field order, as dense arrays.

    Places of values come by joins with the distribution, the moments as a scalar subquery.
    """
    listed = [f for f in fields if f in categorical]
    numeric = [f for f in fields if f not in categorical]
    places, sizes = value_places(dist, listed) if listed else (None, {})
    wide = _with_places(df, places, dist, listed)
    if numeric:
        wide = wide.withColumn("_moments", moments_of(log_moments(dist, numeric), numeric))
    parts = [_indicator(f, sizes) if f in categorical else F.array(z_of(_code(f), F.col("_moments")[f])) for f in fields]
    return wide.select(id, *keep, F.concat(*parts).alias(name))


def feature_vectors(
    df: DataFrame, id: str, fields: Sequence[str], categorical: Sequence[str], dist: DataFrame, keep: Sequence[str] = (), name: str = "features"
) -> DataFrame:
    """``feature_matrix`` as sparse vectors, for domains of any size: a row holds one entry per categorical attribute
    however many values it has. Rows with a value that ``dist`` does not hold are left out."""
    listed = [f for f in fields if f in categorical]
    places, sizes = value_places(dist, listed) if listed else (None, {})
    hot = [f for f in listed if f in sizes]
    numeric = [f for f in fields if f not in categorical]
    wide = _with_places(df, places, dist, hot, "inner")
    if numeric:
        wide = wide.withColumn("_moments", moments_of(log_moments(dist, numeric), numeric))
    plain = {f"_z_{f}": z_of(_code(f), F.col("_moments")[f]) for f in numeric}
    plain |= {f"_z_{f}": F.coalesce(F.col(f).try_cast("double"), F.lit(0.0)) for f in listed if f not in sizes}
    wide = wide.withColumns({**plain, **{f"_at_{f}": F.col(f"_at_{f}").cast("double") for f in hot}})
    stages: list = []
    if hot:
        # the sizes are known, so the encoder is fitted on one row that shows them
        shown = df.sparkSession.createDataFrame([tuple(float(sizes[f] - 1) for f in hot)], ", ".join(f"`_at_{f}` double" for f in hot))
        stages.append(OneHotEncoder(inputCols=[f"_at_{f}" for f in hot], outputCols=[f"_hot_{f}" for f in hot], dropLast=False).fit(shown))
    stages.append(VectorAssembler(inputCols=[f"_hot_{f}" if f in hot else f"_z_{f}" for f in fields], outputCol=name))
    return Pipeline(stages=stages).fit(wide).transform(wide).select(id, *keep, name)
