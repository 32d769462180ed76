"""One query per operator, over whole tables. A query with SQL is checked against it; queries around a
trained model have none."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairloom.catalog import inputs as I
from pairloom.functions.distance import Metric, gower_distance, gower_similarity, hamming_fields
from pairloom.functions.scalars import age_years, log_likelihood, per, response_label, share
from pairloom.operators import clean, cluster, distribution, evaluate, features, nearest, ordering, pairs, splits
from pairloom.operators import matching, models
from pairloom.operators.blocks import pair_blocks
from pairloom.plans import match, payment, roi, segments
from pairloom.session import broadcast_if_small, materialize, scratch_path, store
from pairloom.sources import tables
from pairloom.spec import DatasetSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that states the same result."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def with_(*ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes) + "\n"


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def cells_sql(source: str, attrs, keep: str = "", value: str = "coalesce({a}, -1)") -> str:
    keep = f"{keep}, " if keep else ""
    return " union all ".join(f"select {keep}'{a}' as attr, {value.format(a=a)} as value from {source}" for a in attrs)


# -- sources and totals -----------------------------------------------------------------------------


@query(
    with_(I.PROFILES)
    + "select userid, workcity, sex, marriage, height, age, salary, body, balance, praise from profiles"
)
def text_table(spark, sf):
    """Profiles written as tab text with ``null`` tokens and read back by their declared schema."""
    columns = ("userid", "workcity", "sex", "marriage", "height", "age", "salary", "body", "balance", "praise")
    spec = DatasetSpec(fields=columns, types={c: "long" for c in columns})
    path = scratch_path(spark, "text_table")
    tables.write_text(I.profiles(spark, sf).select(*columns), path)
    return tables.read_table(spark, path, spec)


@query(with_(I.PROFILES, I.VALID) + "select case sex when 0 then 'male' else 'female' end as side, count(*) as cnt from valid group by 1")
def split_files(spark, sf):
    """Valid profiles written as one directory per gender, read back and counted."""
    path = scratch_path(spark, "split_files")
    rows = clean.valid_profile(I.profiles(spark, sf)).withColumnRenamed("sex", "side")
    tables.write_split(rows, "side", path, {0: "male", 1: "female"})
    return spark.read.parquet(path).groupBy("side").agg(F.count("*").alias("cnt"))


@query(
    with_(I.PROFILES)
    + "select 'user_' || userid % 3 as source_file, count(*) as cnt, sum(praise)::bigint as praise from profiles group by 1"
)
def many_files(spark, sf):
    """Rows per entry of a directory of ``user_*`` entries, all in one read."""
    path = scratch_path(spark, "many_files")
    spec = DatasetSpec(fields=("userid", "praise"), types={"userid": "long", "praise": "long"})
    rows = I.profiles(spark, sf).select("userid", "praise")
    for part in range(3):
        tables.write_text(rows.where(F.col("userid") % 3 == part), f"{path}/user_{part}")
    read = tables.read_many(spark, path, spec)
    return read.groupBy("source_file").agg(F.count("*").alias("cnt"), F.sum("praise").alias("praise"))


_LINE_LABELS = """labelled as (
  select aid, bid, case when resp = 'A' then 1 else 0 end as label from line_actions
  where aid <> bid and resp in ('A', 'R'))"""
_RESOLVED = """resolved as (
  select aid, bid, min(label) as label from labelled group by 1, 2 having min(label) = max(label))"""


@query(with_(I.LINE_ACTIONS, _LINE_LABELS, _RESOLVED) + "select aid, bid, label from resolved")
def action_table(spark, sf):
    return match.build_action_table(I.line_actions(spark, sf), I.LINE_CODES)


@query(
    with_(I.LINE_ACTIONS, _LINE_LABELS, _RESOLVED)
    + """select 'total' as name, count(*) as value from resolved
         union all select 'right', count(*) filter (label = 1) from resolved
         union all select 'wrong', count(*) filter (label = 0) from resolved"""
)
def action_summary(spark, sf):
    return match.label_totals(match.build_action_table(I.line_actions(spark, sf), I.LINE_CODES))


# -- filters and projections ------------------------------------------------------------------------


@query(with_(I.PROFILES, I.IN_RANGE) + "select userid, age, height, sex, marriage, body from in_range")
def range_filter(spark, sf):
    return clean.in_ranges(I.profiles(spark, sf), I.PROFILE_RANGES).select(
        "userid", "age", "height", "sex", "marriage", "body"
    )


@query(
    with_(I.PROFILES)
    + """select userid, cnt from profiles join (select salary, count(*) as cnt from profiles group by 1) using (salary)"""
)
def attribute_lookup(spark, sf):
    """Every profile with the count of its salary band, looked up in the distribution."""
    rows = I.profiles(spark, sf).select("userid", F.col("salary").alias("value"))
    dist = materialize(distribution.attribute_distribution(I.profiles(spark, sf), ["salary"]))
    return features.lookup(rows, dist, ["value"]).select("userid", "cnt")


@query(with_(I.PROFILES, I.VALID) + "select userid, sex, age, height, marriage from valid")
def valid_profiles(spark, sf):
    return clean.valid_profile(I.profiles(spark, sf)).select("userid", "sex", "age", "height", "marriage")


@query(with_(I.ORDER_ACTIONS) + "select aid, bid, resp from order_actions where aid <> bid")
def no_self_pairs(spark, sf):
    return clean.drop_self_pairs(I.order_actions(spark, sf))


@query(with_(I.PAYMENTS, I.AGED, I.VALID_PAYMENTS) + "select memberid, iszat, birthday, marriage from valid_payments")
def valid_payments(spark, sf):
    return clean.valid_payment(I.payments(spark, sf), I.ASOF).select("memberid", "iszat", "birthday", "marriage")


@query(with_(I.PAYMENTS) + "select memberid, iszat, logincount from payments where iszat <> 1")
def unconverted(spark, sf):
    return clean.unconverted_only(I.payments(spark, sf), "iszat").select("memberid", "iszat", "logincount")


@query(with_(I.PAYMENTS) + "select * exclude (workcity) from payments")
def drop_ignored(spark, sf):
    return clean.drop_ignored(I.payments(spark, sf), I.PAYMENT_SPEC)


@query(
    with_(I.PROFILES)
    + """select userid, sex, coalesce(salary, -1) as m_salary, coalesce(body, -1) as m_body, age as m_age
         from profiles where sex = 0"""
)
def male_role(spark, sf):
    rows = I.profiles(spark, sf).where("sex = 0")
    return clean.project_role(rows, ["salary", "body", "age"], "m_", keep=["userid", "sex"])


@query(with_(I.PAYMENTS) + "select memberid, coalesce(marriage, 0) as marriage, birthday from payments")
def null_to_zero(spark, sf):
    return clean.null_to(I.payments(spark, sf).select("memberid", "marriage", "birthday"), 0, ["marriage"])


@query(with_(I.PAYMENTS, I.AGED) + "select memberid, birthday as age from aged")
def age_years_of_birthday(spark, sf):
    return I.payments(spark, sf).select("memberid", age_years("birthday", I.ASOF).alias("age"))


@query(
    with_(I.ORDER_ACTIONS)
    + "select aid, bid, case when resp = 'F' then 1 else 0 end as label from order_actions"
)
def response_label_default(spark, sf):
    return clean.label_response(I.order_actions(spark, sf), "resp", ["F"], [], default=0).select("aid", "bid", "label")


@query(
    """select event_id, case when event_type in ('click', 'purchase') then 1 else 0 end as label from events
       where event_type in ('click', 'purchase', 'error')"""
)
def response_label_both_lists(spark, sf):
    """A code listed on both sides is positive; codes on neither side are dropped."""
    events = I.table(spark, sf, "events").select("event_id", "event_type")
    return clean.label_response(events, "event_type", ["click", "purchase"], ["error", "click"]).select(
        "event_id", "label"
    )


@query(
    with_(I.PAYMENTS)
    + """select memberid,
           round(case when viewcount + sendleercount > 0 then viewcount / (viewcount + sendleercount)::double else 0 end, 6) as view_share,
           round(case when logincount > 0 then micropayamount / logincount::double else 0 end, 6) as pay_per_login
         from payments"""
)
def behaviour_ratios(spark, sf):
    return I.payments(spark, sf).select(
        "memberid",
        r6(share("viewcount", "sendleercount")).alias("view_share"),
        r6(per("micropayamount", "logincount")).alias("pay_per_login"),
    )


@query(
    with_(I.PROFILES)
    + """select 'male' as side, userid, workcity, coalesce(body, -1) as body, praise from profiles where sex = 0
         union all
         select 'female', userid, workcity, coalesce(body, -1), praise from profiles where sex = 1"""
)
def gender_split(spark, sf):
    sides = clean.split_by_gender(I.profiles(spark, sf).select("userid", "workcity", "sex", "body", "praise"))
    tagged = [df.select(F.lit(side).alias("side"), "*") for side, df in sides.items()]
    return tagged[0].unionByName(tagged[1])


@query(
    with_(I.PROFILES)
    + """select sex, workcity, userid, coalesce(body, -1) as body, salary, age from profiles"""
)
def gender_city_keys(spark, sf):
    rows = I.profiles(spark, sf).select("userid", "workcity", "sex", "body", "salary", "age")
    return clean.key_by_gender_city(rows).select(
        "sex", "workcity", "userid", "features.body", "features.salary", "features.age"
    )


# -- distributions ----------------------------------------------------------------------------------


@query(
    with_(I.PROFILES)
    + f"select attr, value, count(*) as cnt from ({cells_sql('profiles', I.PROFILE_ATTRS)}) group by 1, 2"
)
def attribute_distribution(spark, sf):
    return distribution.attribute_distribution(I.profiles(spark, sf), I.PROFILE_ATTRS)


@query(
    with_(I.PROFILES, I.IN_RANGE)
    + f"select attr, value, count(*) as cnt from ({cells_sql('in_range', I.PROFILE_ATTRS)}) group by 1, 2 order by 1, 2"
)
def attribute_distribution_valid(spark, sf):
    """Only range-checked rows, sorted for display."""
    return distribution.attribute_distribution(I.profiles(spark, sf), I.PROFILE_ATTRS, I.PROFILE_RANGES).orderBy(
        "attr", "value"
    )


_PAY_ATTRS = [c for c in I.PAYMENT_SPEC.fields[2:] if c not in I.PAYMENT_SPEC.ignored]


@query(
    with_(I.PAYMENTS, I.AGED)
    + f"""select iszat, attr, value, count(*) as cnt
          from ({cells_sql('aged', _PAY_ATTRS, keep='iszat, birthday as age', value='{a}')})
          where value is not null and age <> 0 group by 1, 2, 3"""
)
def class_distribution(spark, sf):
    spec = I.PAYMENT_SPEC
    return distribution.class_distribution(
        I.payments(spark, sf), "iszat", spec.fields[2:], spec.ignored, birthday="birthday", asof=I.ASOF
    )


@query(
    with_(I.POINTS)
    + f"""select p_type, attr, value, count(*) as cnt
          from ({cells_sql('(select p_type, p_size, p_retailprice from part)', ('p_size', 'p_retailprice'), keep='p_type', value='trunc({a})::bigint')})
          group by 1, 2, 3"""
)
def cluster_distribution(spark, sf):
    return distribution.cluster_distribution(I.table(spark, sf, "part"), "p_type", ["p_size", "p_retailprice"])


_NUMERIC = ("age", "height", "praise", "balance")
_DIST = f"dist as (select attr, value, count(*) as cnt from ({cells_sql('profiles', (*_NUMERIC, *I.PROFILE_CATEGORICAL))}) group by 1, 2)"
_MOMENTS = f"""means as (
  select attr, sum(cnt) as n, coalesce(sum(cnt * case when value > 0 then log10(value) end), 0) / sum(cnt) as mu
  from dist where attr in {_NUMERIC} group by 1),
moments as (
  select attr, any_value(n)::bigint as n, any_value(mu) as mu,
         case when any_value(n) > 1 then sqrt(coalesce(sum(cnt * case when value > 0 then (log10(value) - mu) ** 2 end), 0) / (any_value(n) - 1)) else 0 end as sigma
  from dist join means using (attr) group by 1)"""


def _profile_dist(spark, sf):
    return distribution.attribute_distribution(I.profiles(spark, sf), [*_NUMERIC, *I.PROFILE_CATEGORICAL])


@query(with_(I.PROFILES, _DIST, _MOMENTS) + "select attr, n, round(mu, 6) as mu, round(sigma, 6) as sigma from moments")
def log_moments(spark, sf):
    return distribution.log_moments(_profile_dist(spark, sf), _NUMERIC).select(
        "attr", "n", r6("mu").alias("mu"), r6("sigma").alias("sigma")
    )


@query(
    with_(I.PROFILES, _DIST)
    + f"select attr, min(value) as lo, max(value) as hi, max(value) - min(value) as span from dist where attr in {_NUMERIC} group by 1"
)
def attribute_range(spark, sf):
    return distribution.attribute_range(_profile_dist(spark, sf), _NUMERIC)


# -- features ---------------------------------------------------------------------------------------


@query(
    with_(I.PROFILES, _DIST, _MOMENTS)
    + """select userid, praise,
           round(case when praise > 0 and sigma > 1e-12 then (log10(praise) - mu) / sigma else 0 end, 6) as z
         from profiles, moments where attr = 'praise'"""
)
def log_zscore(spark, sf):
    moments = distribution.log_moments(_profile_dist(spark, sf), ["praise"])
    rows = I.profiles(spark, sf).select("userid", "praise")
    return features.log_zscore(rows, "praise", moments, "z").withColumn("z", r6("z"))


@query(
    with_(I.PROFILES)
    + """select userid, string_agg(case when d.value = coalesce(p.body, -1) then '1' else '0' end, ',' order by d.value) as hot
         from profiles p, (select distinct coalesce(body, -1) as value from profiles) d group by 1"""
)
def one_hot_matrix(spark, sf):
    dist = materialize(distribution.attribute_distribution(I.profiles(spark, sf), ["body"]))
    hot = features.one_hot(I.profiles(spark, sf).select("userid", "body"), "body", dist, "hot")
    return hot.select("userid", F.array_join(F.transform("hot", lambda v: v.cast("int").cast("string")), ",").alias("hot"))


@query(
    with_(I.PROFILES)
    + """select userid, array_to_string([case when v = marriage then 1 else 0 end for v in range(1, 10)], ',') as hot
         from profiles"""
)
def one_hot_range(spark, sf):
    hot = features.one_hot_range(I.profiles(spark, sf).select("userid", "marriage"), "marriage", 1, 9, "hot")
    return hot.select("userid", F.array_join(F.transform("hot", lambda v: v.cast("string")), ",").alias("hot"))


@query(
    with_(I.PROFILES)
    + """select userid, round(count(*) over (partition by coalesce(body, -1)) / (count(*) over ())::double, 6) as body_freq
         from profiles"""
)
def freq_encode(spark, sf):
    dist = materialize(distribution.attribute_distribution(I.profiles(spark, sf), ["body"]))
    return features.freq_encode(I.profiles(spark, sf).select("userid", "body"), "body", dist, "freq").select(
        "userid", r6("freq").alias("body_freq")
    )


@query(
    with_(I.PAYMENTS, "totals as (select max(viewcount) as hi, avg(viewcount) as mid from payments)")
    + """select memberid,
           round(case when viewcount = 0 or hi = 0 then 0 else viewcount / hi::double end, 6) as viewcount_max,
           round(case when viewcount = 0 or mid = 0 then 0 else viewcount - mid end, 6) as viewcount_mean,
           round(case when viewcount > 0 then ln(viewcount) end, 6) as viewcount_log
         from payments, totals"""
)
def scaled_columns(spark, sf):
    rows = I.payments(spark, sf).select("memberid", "viewcount")
    scaled = features.scale_columns(rows, ["viewcount"])
    return scaled.select("memberid", *[r6(c).alias(c) for c in ("viewcount_max", "viewcount_mean", "viewcount_log")])


@query(
    with_(I.PROFILES)
    + "select salary, coalesce(body, -1) as body, marriage, count(*) as n from profiles group by 1, 2, 3"
)
def distinct_profiles(spark, sf):
    return features.distinct_profiles(I.profiles(spark, sf), ["salary", "body", "marriage"])


@query(
    with_(I.PROFILES)
    + """select count(distinct (salary, coalesce(body, -1), marriage)) as tuples, count(*) as total from profiles"""
)
def profile_keys(spark, sf):
    """As many distinct keys as distinct feature tuples."""
    keyed = features.profile_key(I.profiles(spark, sf), ["salary", "body", "marriage"])
    return keyed.agg(F.countDistinct("profile_key").alias("tuples"), F.count("*").alias("total"))


_VECTOR_PARTS = f"""doms as (
  select attr, value, row_number() over (partition by attr order by value) - 1 as pos from dist),
encoded as (
  select userid, case attr when 'age' then 0 when 'height' then 1 else 2 end as pos,
         case when v > 0 and sigma > 1e-12 then (log10(v) - mu) / sigma else 0 end as value
  from (select userid, 'age' as attr, age as v from profiles
        union all select userid, 'height', height from profiles
        union all select userid, 'praise', praise from profiles) join moments using (attr)
  union all
  select userid, 3 + pos, case when salary = value then 1 else 0 end from profiles, doms where attr = 'salary'
  union all
  select userid, 3 + (select count(*) from doms where attr = 'salary') + pos,
         case when coalesce(body, -1) = value then 1 else 0 end
  from profiles, doms where attr = 'body')"""


@query(
    with_(I.PROFILES, _DIST, _MOMENTS, _VECTOR_PARTS)
    + "select userid, pos::bigint as pos, round(value, 6) as value from encoded where value <> 0"
)
def profile_vectors_sparse(spark, sf):
    """The same as sparse vectors, one row per filled component."""
    from pyspark.ml.functions import vector_to_array

    dist = materialize(_profile_dist(spark, sf))
    encoded = features.feature_vectors(I.profiles(spark, sf), "userid", I.PROFILE_FIELDS, I.PROFILE_CATEGORICAL, dist)
    cells = encoded.select("userid", F.posexplode(vector_to_array("features")).alias("pos", "value")).where("value <> 0")
    return cells.select("userid", F.col("pos").cast("bigint").alias("pos"), r6("value").alias("value"))


@query(with_(I.PROFILES) + "select count(*) as vectors, count(distinct userid) as places, count(distinct userid) as width, 1 as filled from profiles")
def wide_domain_vectors(spark, sf):
    """One-hot vectors over as many values as there are users: each user fills a place of their own."""
    users = I.profiles(spark, sf).select(F.col("userid").alias("row"), "userid")
    vectors = features.feature_vectors(users, "row", ["userid"], ["userid"], distribution.attribute_distribution(users, ["userid"]))
    filled = features.filled_slots()
    found = vectors.select(F.unwrap_udt("features")["size"].alias("width"), filled[0]["slot"].alias("place"), F.size(filled).alias("filled"))
    return found.agg(
        F.count("*").alias("vectors"), F.count_distinct("place").alias("places"), F.max("width").cast("bigint").alias("width"), F.max("filled").alias("filled")
    )


@query(
    with_(I.PROFILES, _DIST, _MOMENTS, _VECTOR_PARTS)
    + "select userid, pos::bigint as pos, round(value, 6) as value from encoded"
)
def profile_vectors(spark, sf):
    """The encoded feature vector of every profile, one row per component."""
    dist = materialize(_profile_dist(spark, sf))
    encoded = features.feature_matrix(
        I.profiles(spark, sf), "userid", I.PROFILE_FIELDS, I.PROFILE_CATEGORICAL, dist
    )
    return encoded.select("userid", F.posexplode("features").alias("pos", "value")).select(
        "userid", F.col("pos").cast("bigint").alias("pos"), r6("value").alias("value")
    )


# the 32-bit murmur3 of a UTF-8 string as a fold: whole words of four bytes, the rest, the final mixing
_MURMUR = """
bytes as (select *, list_transform(range(1, octet_length(encode(term)) * 2, 2), lambda i: ('0x' || substr(hex(encode(term)), i, 2))::bigint) as b from terms),
words as (
  select *, len(b) as n, list_transform(range(0, len(b) // 4), lambda i: b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216) as ws,
    list_reduce(list_prepend(0::bigint, list_transform(range(0, len(b) % 4), lambda i: b[len(b) // 4 * 4 + i + 1] << (8 * i))), lambda a, x: a + x) as tail from bytes
),
body as (
  select *, list_reduce(list_prepend(42::hugeint, list_transform(ws, lambda w: w::hugeint)), lambda h, w:
    ((rotl13(xor(h, scramble(w)))) * 5 + 3864292196) & 4294967295) as h from words
),
ended as (select *, xor(xor(h, case when n % 4 > 0 then scramble(tail::hugeint) else 0 end), n::hugeint) as h0 from body),
mixed1 as (select *, (xor(h0, h0 >> 16) * 2246822507) & 4294967295 as h1 from ended),
mixed2 as (select *, (xor(h1, h1 >> 13) * 3266489909) & 4294967295 as h2 from mixed1),
hashed as (select *, xor(h2, h2 >> 16) as h3 from mixed2)"""


def _rotl(x: str, k: int) -> str:
    return f"((({x} << {k}) & 4294967295) + ({x} >> {32 - k}))"


def _murmur_sql() -> str:
    """``_MURMUR`` with its two helpers written out."""
    product = "(({w} * 3432918353) & 4294967295)"
    scramble = lambda w: f"(({_rotl(product.format(w=w), 15)} * 461845907) & 4294967295)"
    mixed = f"xor(h, {scramble('w')})"
    return _MURMUR.replace("rotl13(xor(h, scramble(w)))", _rotl(mixed, 13)).replace("scramble(tail::hugeint)", scramble("tail::hugeint"))


@query(
    with_(I.PAYMENTS, "terms as (select memberid, 'salary=' || salary::varchar as term, 1::double as value from payments where salary is not null union all select memberid, 'logincount', logincount::double from payments)", _murmur_sql().strip())
    + """select memberid, slot::int as slot, sum(value)::double as value from (
           select memberid, value, (((case when h3 >= 2147483648 then h3 - 4294967296 else h3 end) % 1000) + 1000) % 1000 as slot from hashed)
         group by 1, 2 having sum(value) <> 0"""
)
def hashed_features(spark, sf):
    """Every filled slot of the hashed vectors."""
    rows = I.payments(spark, sf).select("memberid", F.col("salary").cast("string").alias("salary"), "logincount")
    hashed = features.hash_features(rows, ["salary"], ["logincount"], 1000)
    return hashed.select("memberid", F.explode(features.filled_slots()).alias("s")).select("memberid", "s.slot", "s.value")


# -- pairs and rules --------------------------------------------------------------------------------

_ORDER_LABELS = """labelled as (
  select aid, bid, case when resp = 'F' then 1 else 0 end as label from order_actions
  where aid <> bid and resp in ('F', 'O'))"""
_JOINED = """joined as (
  select aid, bid, label, a.sex as a_gender,
         case when a.sex = 1 then b.salary else a.salary end as m_salary,
         case when a.sex = 1 then b.region else a.region end as m_region,
         case when a.sex = 1 then a.salary else b.salary end as f_salary,
         case when a.sex = 1 then a.region else b.region end as f_region
  from resolved join valid a on a.userid = aid join valid b on b.userid = bid where a.sex <> b.sex)"""
_RULES = """rules as (
  select m_salary, m_region, f_salary, f_region, case when sum(label) >= 1 then 1 else 0 end as label
  from joined group by 1, 2, 3, 4 having not (sum(label) > 1 and sum(1 - label) > 1))"""
_MATRIX = (I.ORDER_ACTIONS, I.PROFILES, I.VALID, _ORDER_LABELS, _RESOLVED, _JOINED, _RULES)


def _order_pairs(spark, sf):
    return match.build_action_table(I.order_actions(spark, sf), I.ORDER_CODES)


@query(
    with_(*_MATRIX)
    + """select kind, count(*) as cnt from (
           select 'initiator_without_profile' as kind, aid as user_id from resolved where aid not in (select userid from valid)
           union
           select 'target_without_profile', bid from resolved where bid not in (select userid from valid)
           union
           select 'profile_without_action', userid from valid
           where userid not in (select aid from resolved) and userid not in (select bid from resolved)) group by kind
         union all
         select 'same_gender', count(*) from resolved join valid a on a.userid = aid join valid b on b.userid = bid where a.sex = b.sex"""
)
def unmatched_totals(spark, sf):
    """Keys without a partner, and the pairs left out because both sides have one gender."""
    return match.unmatched_totals(_order_pairs(spark, sf), I.profiles(spark, sf), I.ROLES)


@query(
    with_(I.ORDER_ACTIONS, I.PROFILES, I.VALID, _ORDER_LABELS, _RESOLVED, _JOINED)
    + "select aid, bid, label, a_gender, m_salary, m_region, f_salary, f_region from joined"
)
def match_pairs_of_repeated_profiles(spark, sf):
    """Every profile twice: pairs stay single."""
    valid = clean.valid_profile(I.profiles(spark, sf))
    return pairs.match_pairs(_order_pairs(spark, sf), valid.unionByName(valid), I.ROLES.male_fields, I.ROLES.female_fields)


@query(with_(*_MATRIX) + "select aid, bid, label, a_gender, m_salary, m_region, f_salary, f_region from joined")
def match_pairs(spark, sf):
    valid = clean.valid_profile(I.profiles(spark, sf))
    return pairs.match_pairs(_order_pairs(spark, sf), valid, I.ROLES.male_fields, I.ROLES.female_fields)


@query(with_(*_MATRIX) + "select m_salary, m_region, f_salary, f_region, label from rules")
def match_matrix_rules(spark, sf):
    return match.build_match_matrix(_order_pairs(spark, sf), I.profiles(spark, sf), I.ROLES)


@query(
    with_(*_MATRIX)
    + """select kind, user_id from (
           select 'initiator_without_profile' as kind, aid as user_id from resolved where aid not in (select userid from valid)
           union
           select 'target_without_profile', bid from resolved where bid not in (select userid from valid)
           union
           select 'profile_without_action', userid from valid
           where userid not in (select aid from resolved) and userid not in (select bid from resolved))"""
)
def unmatched_actions(spark, sf):
    return pairs.unmatched(_order_pairs(spark, sf), clean.valid_profile(I.profiles(spark, sf)))


@query(
    with_(*_MATRIX)
    + """select distinct pos, attr, 1 as type, is_label,
             case attr when 'm_salary' then m_salary when 'm_region' then m_region when 'f_salary' then f_salary
                       when 'f_region' then f_region else label end::varchar as value
         from rules, (values (0, 'm_salary', 0), (1, 'm_region', 0), (2, 'f_salary', 0), (3, 'f_region', 0), (4, 'label', 1)) t(pos, attr, is_label)"""
)
def dataset_descriptor(spark, sf):
    matrix = match.build_match_matrix(_order_pairs(spark, sf), I.profiles(spark, sf), I.ROLES)
    return match.matrix_descriptor(matrix, I.ROLES)


_USER_PAIRS = """user_pairs as (
  select aid, bid, a.salary as a_salary, b.salary as b_salary, coalesce(a.body, -1) as a_body, coalesce(b.body, -1) as b_body,
         a.age as a_age, b.age as b_age, a.height as a_height, b.height as b_height
  from (select distinct aid, bid from order_actions) join profiles a on a.userid = aid join profiles b on b.userid = bid)"""


def _user_pairs(spark, sf):
    """Every acting pair with both users' attributes."""
    rows = clean.null_to(I.profiles(spark, sf).select("userid", "salary", "body", "age", "height"), -1)
    a, b = (
        rows.select(F.col("userid").alias(f"{s}id"), *[F.col(c).alias(f"{s}_{c}") for c in rows.columns[1:]]) for s in "ab"
    )
    acting = I.order_actions(spark, sf).select("aid", "bid").distinct()
    return acting.join(a, "aid").join(b, "bid")


@query(
    with_(I.ORDER_ACTIONS, I.PROFILES, _USER_PAIRS)
    + """, spans as (select (max(age) - min(age))::double as age, (max(height) - min(height))::double as height from profiles),
         sims as (
           select aid, bid, ((a_salary = b_salary)::int + (a_body = b_body)::int + (1 - abs(a_age - b_age) / age)
                             + (1 - abs(a_height - b_height) / height)) / 4.0::double as similarity
           from user_pairs, spans)
         select aid, bid, round(similarity, 6) as similarity, round(1 / (1 + similarity), 6) as distance from sims""".replace("\n         sims", "\n sims")
)
def gower_pairs(spark, sf):
    """Gower similarity and distance of the two users of every acting pair."""
    ranges = I.profiles(spark, sf).agg(
        F.struct((F.max("age") - F.min("age")).alias("age"), (F.max("height") - F.min("height")).alias("height"))
    ).scalar()
    sides = (lambda f: F.col(f"a_{f}"), lambda f: F.col(f"b_{f}"))
    args = (*sides, ["salary", "body"], ["age", "height"], lambda f: ranges[f])
    return _user_pairs(spark, sf).select(
        "aid", "bid", r6(gower_similarity(*args)).alias("similarity"), r6(gower_distance(*args)).alias("distance")
    )


#: named groups of profile fields, compared by themselves
FIELD_GROUPS = {"figure": ("age", "height", "body"), "highlight": ("salary",)}


@query(
    with_(I.ORDER_ACTIONS, I.PROFILES, _USER_PAIRS)
    + """, spans as (select (max(age) - min(age))::double as age, (max(height) - min(height))::double as height from profiles)
         select 'figure' as field_group, aid, bid, round(((a_body = b_body)::int + (1 - abs(a_age - b_age) / age) + (1 - abs(a_height - b_height) / height)) / 3.0::double, 6) as similarity
         from user_pairs, spans
         union all select 'highlight', aid, bid, (a_salary = b_salary)::int::double from user_pairs"""
)
def gower_pairs_by_group(spark, sf):
    """Gower similarity of acting pairs for each named group of fields."""
    rows = _user_pairs(spark, sf)
    sides = (lambda f: F.col(f"a_{f}"), lambda f: F.col(f"b_{f}"))
    parts = []
    for name, fields in FIELD_GROUPS.items():
        categorical = [f for f in fields if f in I.PROFILE_CATEGORICAL]
        metric = segments.profile_metric(I.profiles(spark, sf), fields, categorical)
        value = gower_similarity(*sides, categorical, metric.numeric, lambda f, m=metric: F.lit(m.ranges[f]))
        parts.append(rows.select(F.lit(name).alias("field_group"), "aid", "bid", r6(value).alias("similarity")))
    return parts[0].unionByName(parts[1])


@query(
    with_(I.PROFILES, I.IN_RANGE)
    + """select g.field_group, case sex when 0 then 'male' else 'female' end as side, count(*) as users, 0 as misplaced
         from in_range, (values ('figure'), ('highlight')) g(field_group) where sex in (0, 1) group by 1, 2"""
)
def split_cluster_groups(spark, sf):
    """Split clustering per named group and gender: every user in range has a centre, and of all centres (compared by
    the distance as a column expression) none is nearer than theirs, and no tied one is missing."""
    found = segments.split_cluster_groups(I.profiles(spark, sf), FIELD_GROUPS, I.PROFILE_CATEGORICAL, I.PROFILE_RANGES, k=5)
    valid = clean.in_ranges(I.profiles(spark, sf), I.PROFILE_RANGES)
    out = []
    for group, sides in found.items():
        fields = list(FIELD_GROUPS[group])
        metric = segments.profile_metric(valid, fields, [f for f in fields if f in I.PROFILE_CATEGORICAL])
        for side, (centres, near) in sides.items():
            near = store(near)
            one = near.dropDuplicates(fields)  # tied centres repeat a profile
            other = centres.select(F.to_json(F.struct(*fields)).alias("_id"), *[F.col(f).alias(f"_c_{f}") for f in fields])
            d = metric(F.col, lambda f: F.col(f"_c_{f}"))
            best = one.select(*fields).join(broadcast_if_small(other), F.lit(True)).groupBy(*fields).agg(F.min(F.struct(d.alias("d"))).alias("b"), F.collect_list(F.struct(d.alias("d"), "_id")).alias("all"))
            want = best.select(*fields, F.explode(F.filter("all", lambda x: x["d"] == F.col("b.d"))).alias("w")).select(*fields, F.col("w._id").alias("centre_id"), F.col("w.d").alias("distance"))
            got = near.select(*want.columns)
            wrong = got.exceptAll(want).unionByName(want.exceptAll(got)).agg(F.count("*").cast("int").alias("misplaced"))
            users = one.agg(F.sum("n").alias("users"))
            out.append(users.join(wrong, F.lit(True)).select(F.lit(group).alias("field_group"), F.lit(side).alias("side"), "users", "misplaced"))
    return reduce(DataFrame.unionByName, out)


@query(with_(I.POINTS) + "select count(*) as points, 0 as nearer_elsewhere, 10 as centres from points")
def lloyd_gower(spark, sf):
    """Clusters by Gower distance: when they stand still, no point has a nearer centre than its own."""
    metric = _point_metric(spark, sf)
    centres, assigned, _ = cluster.lloyd(I.points(spark, sf), metric, 10)
    near = cluster.assign_nearest(assigned.withColumnRenamed("centre_id", "own").drop("distance"), centres, metric, "all")
    best = near.groupBy("p_partkey").agg(F.max((F.col("own") == F.col("centre_id")).cast("int")).alias("ok"))
    return best.agg(
        F.count("*").alias("points"), F.count_if(F.col("ok") == 0).cast("int").alias("nearer_elsewhere")
    ).withColumn("centres", F.lit(centres.count()))


@query(
    with_(I.ORDER_ACTIONS, I.PROFILES, _USER_PAIRS)
    + """select aid, bid, (a_salary <> b_salary)::int + (a_body <> b_body)::int + (a_age <> b_age)::int
                + (a_height <> b_height)::int as differing from user_pairs"""
)
def hamming_pairs(spark, sf):
    sides = (lambda f: F.col(f"a_{f}"), lambda f: F.col(f"b_{f}"))
    return _user_pairs(spark, sf).select(
        "aid", "bid", hamming_fields(*sides, ["salary", "body", "age", "height"]).alias("differing")
    )


@query(
    with_(I.PROFILES, I.VALID)
    + """select workcity, count(*) filter (sex = 0) as males, count(*) filter (sex = 1) as females,
                (count(*) filter (sex = 0))::double * count(*) filter (sex = 1) as pairs
         from valid group by 1"""
)
def candidate_pairs_blocked(spark, sf):
    """How many opposite-gender candidates each city holds, from counts alone."""
    valid = clean.valid_profile(I.profiles(spark, sf))
    sides = valid.groupBy("workcity").agg(
        F.count_if(F.col("sex") == 0).alias("males"), F.count_if(F.col("sex") == 1).alias("females")
    )
    return sides.withColumn("pairs", F.col("males").cast("double") * F.col("females"))


@query(
    """select o_custkey as user_id, o_orderkey as other_id, round(o_totalprice, 2) as score, rank from (
         select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank from orders)
       where rank <= 30"""
)
def top_matches(spark, sf):
    rows = I.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("other_id"), F.col("o_totalprice").alias("score")
    )
    return ordering.top_matches(rows, "user_id", "other_id", "score", 30).withColumn("score", F.round("score", 2))


# Two fixed trees over the male (age, salary, praise) and then the female (age, salary, height) fields.
_RULE_FIELDS = (("age", "salary", "praise"), ("age", "salary", "height"))
_RULE_TREES = (
    matching.Split(
        0, 45.0, (),
        matching.Split(4, None, (1.0, 2.0), 0.35, 0.1),
        matching.Split(3, 60.0, (), 0.25, 0.05),
    ),
    matching.Split(
        5, 160.0, (),
        matching.Split(1, None, (3.0, 4.0, 5.0), 0.45, 0.2),
        matching.Split(2, 8.0, (), 0.3, 0.15),
    ),
)
_RULE_PAIRS = """rule_pairs as (
  select m.userid as male_id, f.userid as female_id,
         case when m.age <= 45 then case when f.salary in (1, 2) then 0.35 else 0.1 end
              else case when f.age <= 60 then 0.25 else 0.05 end end
         + case when f.height <= 160 then case when m.salary in (3, 4, 5) then 0.45 else 0.2 end
                else case when m.praise <= 8 then 0.3 else 0.15 end end as score
  from valid m join valid f on m.sex = 0 and f.sex = 1)"""


def _rule_index(spark, sf):
    valid = clean.valid_profile(I.profiles(spark, sf))
    return matching.index_users(valid, _RULE_TREES, *_RULE_FIELDS)


@query(
    with_(I.PROFILES, I.VALID, _RULE_PAIRS)
    + """select user_id, sex, other_id, round(score, 6)::double as score, rank from (
           select *, row_number() over (partition by user_id order by score desc, other_id) as rank from (
             select male_id as user_id, 0 as sex, female_id as other_id, score from rule_pairs where score >= 0.5
             union all select female_id, 1, male_id, score from rule_pairs where score >= 0.5))
         where rank <= 30"""
)
def rule_top_matches(spark, sf):
    """The 30 best counterparts of every user among all of the other gender, by two fixed trees."""
    return matching.best_matches(_rule_index(spark, sf), 30, 0.5).withColumn("score", r6("score"))


@query(
    with_(I.PROFILES, I.VALID, _RULE_PAIRS)
    + """select count(*)::double as pairs, (count(*) filter (score >= 0.5))::double as matching,
                (count(*) filter (score < 0.5))::double as other from rule_pairs"""
)
def rule_match_totals(spark, sf):
    """How many opposite-gender pairs there are and how many match, by two fixed trees."""
    index = _rule_index(spark, sf)
    return matching.match_totals(index, 0.5)


# -- splits -----------------------------------------------------------------------------------------


@query(
    with_(I.PAYMENTS, I.AGED, I.VALID_PAYMENTS, I.SPLIT_PAYMENTS)
    + "select memberid, iszat, birthday, salary, logincount, split from split_payments"
)
def payment_split(spark, sf):
    return payment.payment_split(I.payments(spark, sf), I.ASOF).select(
        "memberid", "iszat", "birthday", "salary", "logincount", "split"
    )


@query(
    with_(I.PAYMENTS, I.AGED, I.VALID_PAYMENTS, I.SPLIT_PAYMENTS)
    + "select split, iszat, count(*) as cnt from split_payments group by 1, 2"
)
def split_counts(spark, sf):
    return splits.split_counts(payment.payment_split(I.payments(spark, sf), I.ASOF), "iszat")


@query(
    """select o_orderkey, case when o_orderkey % 10 in (0, 2, 4) then 'test' else 'train' end as split from orders"""
)
def holdout_split(spark, sf):
    return splits.holdout_split(I.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


_ROI_SUMS = ", ".join(f"round(sum({m}), 2) as {m}" for m in (*I.INCOMES, "total"))


@query(
    with_(I.ROI_ROWS)
    + f"""select case when o_orderkey % 10 in (0, 2, 4) then 'test' else 'train' end as split, channel, year, month, {_ROI_SUMS}
          from roi_rows group by 1, 2, 3, 4"""
)
def roi_grouped_sum(spark, sf):
    sums = roi.roi_groups(I.roi_rows(spark, sf), "o_orderkey", ["channel", "year", "month"], [*I.INCOMES, "total"])
    return sums.select("split", "channel", "year", "month", *[F.round(m, 2).alias(m) for m in (*I.INCOMES, "total")])


@query("select c_custkey from customer order by md5(concat_ws(':', c_custkey, '42')), c_custkey limit 100")
def sample_rows(spark, sf):
    """A repeatable random sample; picking 100 rows is what the operator is for."""
    return ordering.sample_k(I.table(spark, sf, "customer").select("c_custkey"), "c_custkey", 100, 42)


# -- clustering -------------------------------------------------------------------------------------

_NEAREST = f"""dists as (
  select p.*, c.centre_id, {I.gower_sql('p', 'c')} as distance from points p, point_centres c),
nearest as (
  select * from (select *, min(distance) over (partition by p_partkey) as best from dists) where distance = best)"""


def _point_metric(spark, sf):
    return segments.profile_metric(I.points(spark, sf), I.POINT_FIELDS, I.POINT_CATEGORICAL)


def _nearest(spark, sf, ties="all"):
    return cluster.assign_nearest(
        I.points(spark, sf), I.point_centres(spark, sf), _point_metric(spark, sf), ties
    )


@query(with_(I.POINTS, I.POINT_CENTRES, _NEAREST) + "select p_partkey, centre_id, round(distance, 6) as distance from nearest")
def nearest_centre(spark, sf):
    """Every part with its nearest centres by Gower distance, ties included."""
    return _nearest(spark, sf).select("p_partkey", "centre_id", r6("distance").alias("distance"))


_BAND_SQL = """steps as (
  select centre_id, min(distance) as start from nearest group by 1
  union all
  select n.centre_id, min(n.distance) from steps s join nearest n
    on n.centre_id = s.centre_id and n.distance > round(s.start + 0.01::double, 9) group by n.centre_id),
starts as (select centre_id, start, row_number() over (partition by centre_id order by start) - 1 as band from steps)"""


@query(
    with_(I.POINTS, I.POINT_CENTRES, _NEAREST, _BAND_SQL)
    + """select n.p_partkey, n.centre_id, max(s.band)::int as band, round(max(s.start), 6) as band_start
         from nearest n join starts s on s.centre_id = n.centre_id and s.start <= n.distance group by 1, 2"""
)
def distance_bands(spark, sf):
    return cluster.distance_bands(_nearest(spark, sf), ["centre_id"]).select(
        "p_partkey", "centre_id", "band", r6("band_start").alias("band_start")
    )


@query(
    with_(I.POINTS, I.POINT_CENTRES, _NEAREST)
    + """, ranked as (
           select *, row_number() over (partition by centre_id order by distance, p_partkey) - 1 as pos,
                  count(*) over (partition by centre_id) as n from nearest),
         mids as (select centre_id, pos as mid, distance as mid_d from ranked where pos = n // 2)
         select centre_id, p_partkey, pos - mid as x, round(distance * 1000 - mid_d * 1000, 6) as y from ranked join mids using (centre_id)"""
)
def distance_profile(spark, sf):
    return cluster.distance_profile(_nearest(spark, sf), "centre_id", "p_partkey").select(
        "centre_id", "p_partkey", "x", r6("y").alias("y")
    )


@query(
    with_(I.POINTS, I.POINT_CENTRES, _NEAREST)
    + """, modes as (
           select centre_id, p_brand, row_number() over (partition by centre_id order by count(*) desc, p_brand) as r
           from nearest group by 1, 2),
         types as (
           select centre_id, p_type, row_number() over (partition by centre_id order by count(*) desc, p_type) as r
           from nearest group by 1, 2)
         select n.centre_id, m.p_brand, t.p_type, round(avg(n.p_size), 6) as p_size, round(avg(n.price), 6) as price, count(*) as members
         from nearest n join modes m on m.centre_id = n.centre_id and m.r = 1 join types t on t.centre_id = n.centre_id and t.r = 1
         group by 1, 2, 3"""
)
def centre_of_group(spark, sf):
    found = cluster.centre_of(_nearest(spark, sf), ["centre_id"], ["p_brand", "p_type"], ["p_size", "price"])
    return found.select("centre_id", "p_brand", "p_type", r6("p_size").alias("p_size"), r6("price").alias("price"), "members")


@query(
    with_(I.VECTORS, I.VECTOR_CENTRES)
    + """select v.centre_id, vec_id,
           round(list_sum(list_transform(list_zip(v.features, c.features), lambda p: (p[1] - p[2]) ** 2)), 6) as distance
         from vectors v join vector_centres c on c.centre_id = v.centre_id"""
)
def item_distance(spark, sf):
    return cluster.item_distance(I.vectors(spark, sf), I.vector_centres(spark, sf), "vec_id").select(
        "centre_id", "vec_id", r6("distance").alias("distance")
    )


@query(
    with_(I.VECTORS, I.VECTOR_CENTRES)
    + """select vec_id, round(list_cosine_distance(v.features, c.features), 6) as cosine,
           len(list_filter(list_zip(v.features, c.features), lambda p: p[1] <> p[2]))::double as hamming
         from vectors v join vector_centres c on c.centre_id = v.centre_id"""
)
def named_distances(spark, sf):
    """Distances chosen by name, between every vector and the first one of its label."""
    centres = I.vector_centres(spark, sf).select("centre_id", F.col("features").alias("centre"))
    rows = I.vectors(spark, sf).join(centres, "centre_id")
    sides = (lambda f: F.col(f), lambda f: F.col("centre"))
    return rows.select(
        "vec_id",
        r6(Metric("cosine", ("features",))(*sides)).alias("cosine"),
        Metric("hamming", ("features",))(*sides).alias("hamming"),
    )


_STEP = """moves as (
  select vec_id, arg_min(cid, (d, cid)) as centre_id from (
    select v.vec_id, c.centre_id as cid,
           round(list_sum(list_transform(list_zip(v.features, c.features), lambda p: (p[1] - p[2]) ** 2)), 9) as d
    from vectors v, vector_centres c) group by 1)"""


@query(
    with_(I.VECTORS, I.VECTOR_CENTRES, _STEP)
    + """select m.centre_id, pos::bigint as pos, round(avg(features[pos + 1]), 6) as value, count(*) as members
         from moves m join vectors v on v.vec_id = m.vec_id, range(64) t(pos) group by 1, 2"""
)
def kmeans_step(spark, sf):
    """One Lloyd iteration from the first vector of every label, one row per centre component."""
    moved = cluster.kmeans_step(
        I.vectors(spark, sf).drop("centre_id"), I.vector_centres(spark, sf)
    )
    return moved.select("centre_id", "members", F.posexplode("features").alias("pos", "value")).select(
        "centre_id", F.col("pos").cast("bigint").alias("pos"), r6("value").alias("value"), "members"
    )


@query(with_(I.VECTORS) + "select centre_id, count(*) as members from vectors group by 1")
def cluster_sizes(spark, sf):
    return cluster.cluster_sizes(I.vectors(spark, sf))


_COHESION_FIELDS = ("p_brand", "p_size", "price")
_PART_PAIRS = """part_pairs as (
  select a.p_type, (a.p_brand <> b.p_brand)::int + (a.p_size <> b.p_size)::int + (a.price <> b.price)::int as distance
  from points a join points b on a.p_type = b.p_type and a.p_partkey < b.p_partkey)"""


@query(
    with_(I.POINTS, _PART_PAIRS)
    + """select p_type, (select count(*) from points p where p.p_type = t.p_type) as members, count(*)::double as pairs,
                (count(*) filter (distance = 0))::double as equal_pairs, (count(*) filter (distance <= 1))::double as close_pairs,
                round(100.0::double * count(*) filter (distance <= 1) / count(*), 6) as close_pct
         from part_pairs t group by 1"""
)
def cluster_cohesion(spark, sf):
    found = cluster.cluster_cohesion(I.points(spark, sf), "p_type", _COHESION_FIELDS)
    counts = ("pairs", "equal_pairs", "close_pairs")
    return found.select("p_type", "members", *[F.col(c).cast("double").alias(c) for c in counts], r6("close_pct").alias("close_pct"))


@query(
    with_(I.POINTS, _PART_PAIRS)
    + """select round(avg(pct), 6) as mean_close_pct, count(*) as clusters from (
           select 100.0::double * count(*) filter (distance <= 1) / count(*) as pct from part_pairs group by p_type)"""
)
def mean_cohesion(spark, sf):
    found = cluster.mean_cohesion(cluster.cluster_cohesion(I.points(spark, sf), "p_type", _COHESION_FIELDS))
    return found.withColumn("mean_close_pct", r6("mean_close_pct"))


@query(with_(I.POINTS, _PART_PAIRS) + "select p_type, distance, count(*)::double as pairs from part_pairs group by 1, 2")
def distance_histogram(spark, sf):
    found = cluster.distance_histogram(I.points(spark, sf), "p_type", _COHESION_FIELDS)
    return found.withColumn("pairs", F.col("pairs").cast("double"))


_WIDE_FIELDS = [c for c in I.PAYMENT_SPEC.fields if c not in ("memberid", "marriage")]


@query(
    with_(I.PAYMENTS)
    + f"""select a.marriage, ({" + ".join(f"(a.{f} is distinct from b.{f})::int" for f in _WIDE_FIELDS)}) as distance, count(*)::double as pairs
          from payments a join payments b on a.marriage is not distinct from b.marriage and a.memberid < b.memberid group by 1, 2"""
)
def distance_histogram_wide(spark, sf):
    """Pairs by the number of fields in which they differ, over twelve fields and with a cluster that is NULL."""
    found = cluster.distance_histogram(I.payments(spark, sf), "marriage", _WIDE_FIELDS)
    return found.select("marriage", "distance", F.col("pairs").cast("double").alias("pairs"))


_SPLIT_FIELDS, _SPLIT_CATEGORICAL = ("p_brand", "p_type", "p_size"), ("p_brand", "p_type")
_PROFS = "profs as (select p_brand, p_type, p_size, count(*) as n from points group by 1, 2, 3)"


def _split_round_sql(cents: str, r: str = "") -> str:
    """One round from the centres ``cents``: its next ones as ``merged<r>``, not yet distinct."""
    d = I.gower_sql("p", "c", _SPLIT_FIELDS, _SPLIT_CATEGORICAL)
    return f"""cents{r} as (select *, row_number() over (order by p_brand, p_type, p_size) as cid from (select distinct p_brand, p_type, p_size from {cents})),
near{r} as (
  select * from (
    select p.*, c.cid, {d} as d, min({d}) over (partition by p.p_brand, p.p_type, p.p_size) as best
    from profs p, cents{r} c) where d = best),
spread{r} as (select cid, min(d) as lo, max(d) as hi from near{r} group by 1),
far{r} as (select n.* from near{r} n join spread{r} using (cid) where d > round(lo + 0.01::double, 9)),
steps{r} as (
  select cid, min(d) as start from far{r} group by 1
  union all
  select f.cid, min(f.d) from steps{r} s join far{r} f on f.cid = s.cid and f.d > round(s.start + 0.01::double, 9) group by f.cid),
banded{r} as (select f.p_brand, f.p_type, f.p_size, f.n, f.cid, max(s.start) as band from far{r} f join steps{r} s on s.cid = f.cid and s.start <= f.d group by all),
brands{r} as (select cid, band, p_brand, row_number() over (partition by cid, band order by sum(n) desc, p_brand) as r from banded{r} group by 1, 2, 3),
kinds{r} as (select cid, band, p_type, row_number() over (partition by cid, band order by sum(n) desc, p_type) as r from banded{r} group by 1, 2, 3),
sizes{r} as (select cid, band, round(sum(p_size * n) / sum(n)::double, 9) as p_size from banded{r} group by 1, 2),
merged{r} as (
  select p_brand, p_type, p_size::double as p_size, hi <= round(lo + 0.01::double, 9) as converged from cents{r} join spread{r} using (cid)
  union all
  select b.p_brand, k.p_type, s.p_size, false from sizes{r} s join brands{r} b on b.cid = s.cid and b.band = s.band and b.r = 1
  join kinds{r} k on k.cid = s.cid and k.band = s.band and k.r = 1)"""


_SPLIT_SQL = f"{_PROFS}, {_split_round_sql('point_centres')}"
_SEEDS = """seeds as (
  select p_brand, p_type, p_size::double as p_size from (
    select *, '{"p_brand":"' || p_brand || '","p_type":"' || p_type || '","p_size":' || p_size || '}' as key from profs)
  order by md5(key || ':42'), key limit 10)"""


def _split_inputs(spark, sf):
    rows = I.points(spark, sf)
    metric = segments.profile_metric(rows, _SPLIT_FIELDS, _SPLIT_CATEGORICAL)
    return store(features.distinct_profiles(rows, _SPLIT_FIELDS)), metric


@query(
    with_(I.POINTS, I.POINT_CENTRES, _SPLIT_SQL)
    + "select p_brand, p_type, round(p_size, 6) as p_size, bool_or(converged)::int as converged from merged group by 1, 2, merged.p_size"
)
def split_step(spark, sf):
    """One round of split clustering from the first part of every brand."""
    profiles, metric = _split_inputs(spark, sf)
    centres = I.point_centres(spark, sf).select(
        "p_brand", "p_type", F.col("p_size").cast("double").alias("p_size")
    ).distinct()
    after = cluster.split_step(profiles, centres, metric)
    return after.select("p_brand", "p_type", r6("p_size").alias("p_size"), F.col("converged").cast("int").alias("converged"))


@query(
    with_(I.POINTS, _PROFS, _SEEDS, _split_round_sql("seeds", "_a"), _split_round_sql("merged_a", "_b"), _split_round_sql("merged_b", "_c"))
    + "select p_brand, p_type, round(p_size, 6) as p_size, bool_or(converged)::int as converged from merged_c group by 1, 2, merged_c.p_size"
)
def split_three_rounds(spark, sf):
    """The loop of split clustering from its own seeds, stopped after three rounds."""
    profiles, metric = _split_inputs(spark, sf)
    after, _ = cluster.split_clustering(profiles, metric, k=10, max_iter=3)
    return after.select("p_brand", "p_type", r6("p_size").alias("p_size"), F.col("converged").cast("int").alias("converged"))


# -- reports ----------------------------------------------------------------------------------------


@query(with_(I.SCORED) + "select label, (score >= 0.5)::int as predicted, count(*) as cnt from scored group by 1, 2")
def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(I.scored(spark, sf), "label", "score")


@query(
    with_(I.SCORED)
    + """select count(*) as total, (count(*) filter (label = (score >= 0.5)::int)) as "right",
                round((count(*) filter (label = (score >= 0.5)::int)) / count(*)::double, 6) as accuracy from scored"""
)
def accuracy(spark, sf):
    found = evaluate.accuracy(evaluate.confusion_matrix(I.scored(spark, sf), "label", "score"), "label")
    return found.withColumn("accuracy", r6("accuracy"))


@query(
    with_(I.SCORED)
    + """, ranked as (
           select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as r from scored)
         select round(((sum(r) filter (label = 1)) - p * (p + 1) / 2.0) / (p * q), 6) as auc, p as positives, q as negatives
         from ranked, (select count(*) filter (label = 1) as p, count(*) filter (label = 0) as q from scored) group by p, q"""
)
def auc(spark, sf):
    return evaluate.auc(I.scored(spark, sf), "label", "score").withColumn("auc", r6("auc"))


_LL = "greatest(-100, case when label = 1 then ln(score) else ln(1 - score) end)"


@query(with_(I.SCORED) + f"select doc_id, round({_LL}, 6) as likelihood from scored")
def log_likelihood_rows(spark, sf):
    return I.scored(spark, sf).select("doc_id", r6(log_likelihood("label", "score")).alias("likelihood"))


@query(
    with_(I.SCORED)
    + f"select label, (score >= 0.5)::int as predicted, round(avg({_LL}), 6) as entropy from scored group by 1, 2"
)
def entropy_matrix(spark, sf):
    found = evaluate.entropy_matrix(I.scored(spark, sf), "label", "score")
    return found.withColumn("entropy", r6("entropy"))


@query(
    """select count(*) as n, round(avg(abs(l_quantity * 2000 - l_extendedprice)), 4) as mae,
              round(sqrt(avg((l_quantity * 2000 - l_extendedprice) ** 2)), 4) as rmse,
              round(avg(l_quantity * 2000 - l_extendedprice), 4) as bias,
              round(corr(l_quantity * 2000, l_extendedprice), 6) as corr from lineitem"""
)
def regression_report(spark, sf):
    rows = I.table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 2000).alias("prediction")
    )
    found = evaluate.regression_report(rows, "label", "prediction")
    return found.select("n", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "bias")], r6("corr").alias("corr"))


# -- trained models: no SQL states these ------------------------------------------------------------


def _match_model(spark, sf):
    return match.train_match_model(I.order_actions(spark, sf), I.profiles(spark, sf), I.ORDER_CODES, I.WIDE_ROLES)


@query()
def forest_match_scores(spark, sf):
    """The 30 best counterparts of every valid user among all of the other gender, by a trained forest."""
    found = match.predict_matches(I.profiles(spark, sf), _match_model(spark, sf), I.WIDE_ROLES, 30)
    return found.withColumn("score", r6("score"))


@query()
def forest_match_scores_by_city(spark, sf):
    """The same with candidates of the same city only."""
    model = _match_model(spark, sf)
    found = match.predict_matches(I.profiles(spark, sf), model, I.WIDE_ROLES, 30, block_on="workcity")
    return found.withColumn("score", r6("score"))


@query()
def forest_match_totals(spark, sf):
    """Candidate pairs in all and how many of them match."""
    valid = clean.valid_profile(I.profiles(spark, sf))
    roles = I.WIDE_ROLES
    index = matching.index_users(valid, _match_model(spark, sf), roles.male_fields, roles.female_fields)
    return matching.match_totals(index, 0.5)


@query()
def match_model_evaluation(spark, sf):
    """Confusion of the match forest on the action log with every other response as 0."""
    model = _match_model(spark, sf)
    confusion, _ = match.evaluate_match_model(
        model, I.order_actions(spark, sf), I.profiles(spark, sf), I.ORDER_CODES.positives, I.WIDE_ROLES
    )
    return confusion


def _payment_logistic(spark, sf):
    spec = payment.logistic_spec(I.PAYMENT_SPEC)
    split = payment.payment_split(I.payments(spark, sf), I.ASOF)
    return spec, split, payment.payment_logistic(split, spec)


@query()
def payment_logistic_report(spark, sf):
    spec, _, (_, scored) = _payment_logistic(spark, sf)
    return payment.evaluate_scores(scored, spec.label).auc.withColumn("auc", r6("auc"))


@query()
def logistic_propensity(spark, sf):
    """Everyone who has not paid, scored by the payment model."""
    spec, _, (model, _) = _payment_logistic(spark, sf)
    return payment.payment_predict(model, I.payments(spark, sf), spec, I.ASOF)


@query()
def coefficient_table(spark, sf):
    spec, split, (model, _) = _payment_logistic(spark, sf)
    return models.coefficient_table(model, split.where("split = 'train'"), spec)


@query(with_(I.PAYMENTS, I.AGED, I.VALID_PAYMENTS) + "select count(*) as users, 0 as misplaced from valid_payments where iszat = 0")
def prediction_files(spark, sf):
    """Predictions written as a directory of payers and one of the others, read back: all who have not paid, each in the
    directory their score says."""
    spec, _, (model, _) = _payment_logistic(spark, sf)
    path = scratch_path(spark, "predictions")
    payment.write_predictions(payment.payment_predict(model, I.payments(spark, sf), spec, I.ASOF), path)
    read = spark.read.parquet(path)
    wrong = (F.col("predicted") == "pay") != (F.col("score") >= 0.5)
    return read.agg(F.count("*").alias("users"), F.count_if(wrong | F.col("predicted").isNull()).cast("int").alias("misplaced"))


@query(
    with_(I.PROFILES, I.VALID)
    + """select sum(m * f)::bigint as pairs, 0 as differing from (
           select userid % 3 as file, count(*) filter (sex = 0) as m, count(*) filter (sex = 1) as f from valid group by 1)"""
)
def matches_of_files(spark, sf):
    """Best counterparts within each of three profile files: the same as from the forest's own scores of all pairs of
    opposite gender of a file."""
    fields = tuple(dict.fromkeys(["userid", "sex", "workcity", *I.WIDE_ROLES.male_fields]))
    spec = DatasetSpec(fields=fields, types={c: "long" for c in fields})
    path = scratch_path(spark, "user_files")
    rows = I.profiles(spark, sf).select(*fields)
    for part in range(3):
        tables.write_text(rows.where(F.col("userid") % 3 == part), f"{path}/user_{part}")
    model = _match_model(spark, sf)
    found = store(match.predict_matches_of_files(spark, path, spec, model, I.WIDE_ROLES, 30))
    valid = clean.valid_profile(tables.read_many(spark, path, spec))
    male, female = (clean.project_role(valid.where(f"sex = {code}"), own, prefix, keep=["userid", "source_file"]) for code, own, prefix in ((0, I.WIDE_ROLES.male_fields, "m_"), (1, I.WIDE_ROLES.female_fields, "f_")))
    male, female = (store(models.index_inputs(model, side)) for side in (male.withColumnRenamed("userid", "_m"), female.withColumnRenamed("userid", "_f")))
    pairs_ = pair_blocks(male, female, ["source_file"], "_m", "_f")
    scored = models.score_forest(model, pairs_).select("_m", "_f", F.round("score", 9).alias("score"))
    both = store(ordering.best_of_tasks(scored, "_m", "_f", "score", 30, 0.5))
    want = ordering.top_matches(both.where("pairs is null").drop("pairs"), "user_id", "other_id", "score", 30).select("user_id", "other_id", "rank")
    got = found.select("user_id", "other_id", "rank")
    wrong = got.exceptAll(want).unionByName(want.exceptAll(got)).agg(F.count("*").cast("int").alias("differing"))
    return both.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs")).join(wrong, F.lit(True))


@query(with_(I.PAYMENTS, I.AGED, I.VALID_PAYMENTS, I.SPLIT_PAYMENTS) + "select count(*) as rows, 0 as violated from split_payments where split = 'train'")
def logistic_is_optimal(spark, sf):
    """The payment model, fitted to the end with a stronger penalty: no weight breaks the first-order condition of the L1 loss."""
    spec = payment.logistic_spec(I.PAYMENT_SPEC)
    split = store(payment.payment_split(I.payments(spark, sf), I.ASOF))
    model, _ = payment.payment_logistic(split, spec, 300, 0.01, 1e-10)
    return _violations(models.optimality(model, split.where("split = 'train'"), spec, 0.01), split.where("split = 'train'"))


def _violations(conditions: DataFrame, rows: DataFrame) -> DataFrame:
    n = rows.agg(F.count("*")).scalar()
    return conditions.agg(F.count_if(F.col("excess") > 1e-5).cast("int").alias("violated")).select(n.alias("rows"), "violated")


@query(
    with_(I.ROI_ROWS)
    + "select count(*) as rows, 0 as violated from (select distinct channel, year, month from roi_rows where o_orderkey % 10 not in (0, 2, 4))"
)
def roi_logistic_is_optimal(spark, sf):
    """The same for the model of groups that bring in more than the average."""
    group = ["channel", "year", "month"]
    groups = store(roi.roi_groups(I.roi_rows(spark, sf), "o_orderkey", group, [*I.INCOMES, "total"]))
    train = groups.where("split = 'train'")
    cut = train.agg(F.avg("total")).first()[0]
    report = roi.roi_model(groups, group, I.INCOMES, cut=cut, passes=500, lam=0.05, tol=1e-12)
    spec = models.LogisticSpec("label", tuple(group), tuple(I.INCOMES))
    labelled = train.withColumn("label", F.when(F.col("total") > cut, 1).otherwise(0))
    return _violations(models.optimality(report.model, labelled, spec, 0.05), train)


_STATUS_SPEC = models.LogisticSpec("o_orderstatus", ("o_orderpriority", "year"), ("month", "price"))


@query("select o_orderstatus as class, count(*) as rows, 0 as violated, 0 as misnamed from orders group by 1")
def class_logistic(spark, sf):
    """A model of three classes: per class its rows, weights that break the first-order condition, and rows whose
    probability does not follow from the named weights of the coefficient table."""
    day = F.col("o_orderdate")
    rows = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.year(day).cast("string").alias("year"), F.month(day).alias("month"), (F.col("o_totalprice") / 1000).alias("price"))
    rows, spec = store(rows), _STATUS_SPEC
    model = models.train_classes(rows, spec, 500, 0.01, 1e-10)
    violated = models.optimality(model, rows, spec, 0.01).groupBy("class").agg(F.count_if(F.col("excess") > 1e-5).cast("int").alias("violated"))
    named = models.coefficient_table(model, rows, spec).groupBy("class", "predictor").agg(F.first("weight").alias("weight"))
    terms = [F.struct(F.concat(F.lit(f"{c}="), F.col(c)).alias("predictor"), F.lit(1.0).alias("x")) for c in spec.categorical]
    terms += [F.struct(F.lit(c).alias("predictor"), F.col(c).cast("double").alias("x")) for c in spec.numeric]
    terms.append(F.struct(F.lit("(intercept)").alias("predictor"), F.lit(1.0).alias("x")))
    cells = rows.select("o_orderkey", F.explode(F.array(*terms)).alias("t")).select("o_orderkey", "t.*")
    z = cells.join(named, "predictor").groupBy("o_orderkey", "class").agg(F.exp(F.sum(F.col("x") * F.col("weight"))).alias("e"))
    total = z.groupBy("o_orderkey").agg(F.sum("e").alias("all"))
    told = models.score_classes(model, rows, spec).select("o_orderkey", F.col("o_orderstatus"), F.explode("scores").alias("class", "p"))
    both = told.join(z.join(total, "o_orderkey"), ["o_orderkey", "class"], "left")
    off = F.coalesce(F.abs(F.col("e") / F.col("all") - F.col("p")) > 1e-9, F.lit(True))
    found = both.groupBy("class").agg(F.count_if(F.col("o_orderstatus") == F.col("class")).alias("rows"), F.count_if(off).cast("int").alias("misnamed"))
    return found.join(violated, "class").select("class", "rows", "violated", "misnamed")


@query(with_(I.PAYMENTS, I.AGED, I.VALID_PAYMENTS, I.SPLIT_PAYMENTS) + "select count(*) as rows, 0 as differing from split_payments where split = 'train'")
def forest_leaf_counts(spark, sf):
    """One tree grown to full depth on all rows: sent down by its rules as column expressions, the rows in every leaf are
    those the leaf votes with."""
    fields = [c for c in I.PAYMENT_SPEC.model_columns() if c != "iszat"]
    categorical, _ = I.PAYMENT_SPEC.split_roles(fields)
    train = store(payment.payment_split(I.payments(spark, sf), I.ASOF).where("split = 'train'").na.fill(0, fields))
    model = models.train_forest(train, "iszat", fields, categorical, trees=1, bootstrap=False)
    audit = models.leaf_audit(model, train, "iszat")
    return audit.agg(F.sum("rows").alias("rows"), F.sum("differing").cast("int").alias("differing"))


_ORDER_POINTS = """order_points as (
  select o_orderkey, c_mktsegment as segment, c_nationkey as nation, floor(c_acctbal)::bigint as balance, floor(o_totalprice / 50)::bigint as price
  from orders join customer on c_custkey = o_custkey),
buyers as (select c_custkey, c_mktsegment as segment, c_nationkey as nation, floor(c_acctbal)::bigint as balance, (c_custkey * 31) % 10000 as price from customer)"""
_ORDER_FIELDS = ("segment", "nation", "balance", "price")


def _order_points(spark, sf):
    customer = I.table(spark, sf, "customer")
    kept = [F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.floor("c_acctbal").alias("balance")]
    orders = I.table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    points = orders.select("o_orderkey", *kept, F.floor(F.col("o_totalprice") / 50).alias("price"))
    buyers = customer.select("c_custkey", *kept, ((F.col("c_custkey") * 31) % 10000).alias("price"))
    return buyers, points


@query(
    with_(_ORDER_POINTS)
    + f"""select c_custkey, o_orderkey, round(d, 6) as distance from (
           select c_custkey, o_orderkey, d, min(d) over (partition by c_custkey) as best from (
             select c_custkey, o_orderkey, {I.gower_sql('b', 'p', _ORDER_FIELDS, ('segment', 'nation'), 'order_points')} as d from buyers b, order_points p))
         where d = best"""
)
def nearest_of_many(spark, sf):
    """Every customer with the orders nearest to them by Gower distance: as many centres as orders, in blocks that are
    met only where they could hold a nearer one."""
    buyers, points = _order_points(spark, sf)
    metric = segments.profile_metric(points, _ORDER_FIELDS, ("segment", "nation"))
    found = cluster.assign_nearest(buyers, points, metric, "all", "o_orderkey", sent_bytes=0, per_task=1024)
    return found.select("c_custkey", "o_orderkey", r6("distance").alias("distance"))


@query(with_(_ORDER_POINTS) + "select (select count(*) from buyers) as points, (select count(*) from order_points) as centres, 1 as half_skipped")
def nearest_pairs_skipped(spark, sf):
    """More than half of the pairs of the query above are never compared."""
    buyers, points = _order_points(spark, sf)
    metric = segments.profile_metric(points, _ORDER_FIELDS, ("segment", "nation"))
    counted = nearest.pairs_compared(buyers, points, metric, "o_orderkey", sent_bytes=0, per_task=1024)
    return counted.select("points", "centres", (F.col("skipped_share") > 0.5).cast("int").alias("half_skipped"))


@query()
def payment_forest_eval(spark, sf):
    split = payment.payment_split(I.payments(spark, sf), I.ASOF)
    _, confusion, _ = payment.payment_forest(split, I.PAYMENT_SPEC)
    return confusion


@query(with_(I.PAYMENTS, I.AGED, I.VALID_PAYMENTS, I.SPLIT_PAYMENTS) + "select iszat as label, count(*)::bigint as rows from split_payments where split = 'test' group by 1")
def payment_forest_rows(spark, sf):
    """The payment forest's confusion holds every test row under its own label."""
    split = payment.payment_split(I.payments(spark, sf), I.ASOF)
    _, confusion, _ = payment.payment_forest(split, I.PAYMENT_SPEC)
    return confusion.groupBy(F.col("iszat").cast("int").alias("label")).agg(F.sum("cnt").alias("rows"))


@query(
    with_(I.ORDER_ACTIONS, I.PROFILES, I.VALID)
    + """select case when resp = 'F' then 1 else 0 end as label, count(*)::bigint as rows from order_actions
         join valid a on a.userid = aid join valid b on b.userid = bid where aid <> bid and a.sex <> b.sex group by 1"""
)
def match_evaluation_rows(spark, sf):
    """The match forest's confusion on the log holds every pair of opposite gender under its own label."""
    confusion, _ = match.evaluate_match_model(
        _match_model(spark, sf), I.order_actions(spark, sf), I.profiles(spark, sf), I.ORDER_CODES.positives, I.WIDE_ROLES
    )
    return confusion.groupBy(F.col("label").cast("int").alias("label")).agg(F.sum("cnt").alias("rows"))


@query(
    with_(I.PROFILES, I.IN_RANGE)
    + "select case sex when 0 then 'male' else 'female' end as side, count(*) as users, 0 as misplaced, 0 as differing from in_range where sex in (0, 1) group by 1"
)
def cluster_users_nearest(spark, sf):
    """K-means per gender over sparse vectors: no user has a nearer centre than their own, and their distance is that of
    the dense vectors."""
    args = (I.PROFILE_FIELDS, I.PROFILE_CATEGORICAL)
    valid = clean.in_ranges(I.profiles(spark, sf), I.PROFILE_RANGES)
    dist = materialize(distribution.attribute_distribution(valid, I.PROFILE_FIELDS))
    dense = store(features.feature_matrix(valid, "userid", *args, dist))
    found = segments.cluster_users(I.profiles(spark, sf), *args, I.PROFILE_RANGES, k=5)
    out = []
    for side, one in found.items():
        own = one.items.select("userid", F.col("centre_id").alias("own"), "distance")
        rows = dense.join(own, "userid")
        near = cluster.assign_nearest(rows.drop("distance"), one.centres, Metric("sq_euclidean", ("features",)), "all")
        best = near.groupBy("userid").agg(F.max((F.col("own") == F.col("centre_id")).cast("int")).alias("ok"), F.min("distance").alias("d"))
        both = own.join(best, "userid")
        out.append(
            both.agg(
                F.count("*").alias("users"), F.count_if(F.col("ok") == 0).cast("int").alias("misplaced"),
                F.count_if(F.abs(F.col("d") - F.col("distance")) > 1e-6).cast("int").alias("differing"),
            ).select(F.lit(side).alias("side"), "users", "misplaced", "differing")
        )
    return out[0].unionByName(out[1])


@query()
def kmeans_assignments(spark, sf):
    _, assigned = cluster.kmeans(I.vectors(spark, sf).drop("centre_id"), 10)
    return assigned.select("vec_id", "centre_id")


@query(with_(I.VECTORS) + "select count(*) as vectors, 0 as nearer_elsewhere, 10 as centres from vectors")
def kmeans_is_optimal(spark, sf):
    """Every vector is with a centre than which no other is nearer."""
    model, assigned = cluster.kmeans(I.vectors(spark, sf).drop("centre_id"), 10)
    own = assigned.select("vec_id", "features", F.col("centre_id").alias("own"))
    near = cluster.assign_nearest(own, cluster.cluster_centres(spark, model), Metric("sq_euclidean", ("features",)), "all")
    best = near.groupBy("vec_id").agg(F.max((F.col("own") == F.col("centre_id")).cast("int")).alias("ok"))
    return best.agg(
        F.count("*").alias("vectors"), F.count_if(F.col("ok") == 0).cast("int").alias("nearer_elsewhere")
    ).withColumn("centres", F.lit(len(model.clusterCenters())))


@query(with_(I.PROFILES, I.PAYMENTS, I.AGED, I.VALID_PAYMENTS) + "select count(*) as scored, 0 as differing, 0 as outside from valid_payments where iszat = 0")
def saved_model_scores(spark, sf):
    """A saved and reloaded propensity model gives every non-payer the same score, between 0 and 1."""
    spec, _, (model, _) = _payment_logistic(spark, sf)
    path = scratch_path(spark, "model")
    tables.save_model(model, path, I.PAYMENT_SPEC)
    again, _ = tables.load_model(spark, path)
    old, new = (payment.payment_predict(m, I.payments(spark, sf), spec, I.ASOF).select("memberid", "score") for m in (model, again))
    both = old.join(new.withColumnRenamed("score", "again"), "memberid", "full_outer")
    return both.agg(
        F.count("*").alias("scored"),
        F.count_if(~F.col("score").eqNullSafe(F.col("again"))).cast("int").alias("differing"),
        F.count_if((F.col("score") < 0) | (F.col("score") > 1)).cast("int").alias("outside"),
    )


@query()
def kmeans_centres(spark, sf):
    """The centres of the fitted model, one row per component."""
    model, _ = cluster.kmeans(I.vectors(spark, sf).drop("centre_id"), 10)
    centres = cluster.cluster_centres(spark, model)
    return centres.select("centre_id", F.posexplode("features").alias("pos", "value"))


@query()
def split_cluster_users(spark, sf):
    """Split clustering per gender: how many users each centre holds."""
    found = segments.split_cluster_users(
        I.profiles(spark, sf), ("praise", "salary", "body"), I.PROFILE_CATEGORICAL, I.PROFILE_RANGES, k=5
    )
    sides = [near.select(F.lit(side).alias("side"), "*") for side, (_, near) in found.items()]
    return sides[0].unionByName(sides[1]).groupBy("side", "centre_id").agg(F.sum("n").alias("members"))


@query()
def cluster_users(spark, sf):
    """K-means per gender over encoded profiles: item distances to their centres."""
    found = segments.cluster_users(
        I.profiles(spark, sf), I.PROFILE_FIELDS, I.PROFILE_CATEGORICAL, I.PROFILE_RANGES, k=5
    )
    male, female = (found[s].items.select(F.lit(s).alias("side"), "*") for s in ("male", "female"))
    return male.unionByName(female)


@query()
def cluster_items(spark, sf):
    """K-means over encoded parts: values per cluster."""
    rows = I.points(spark, sf).select("p_partkey", "p_size", "price")
    return segments.cluster_items(rows, "p_partkey", ["p_size", "price"], ["p_size"], k=5).profile


@query()
def split_clustering(spark, sf):
    """Split clustering of the distinct parts."""
    profiles, metric = _split_inputs(spark, sf)
    centres, _ = cluster.split_clustering(profiles, metric, k=10)
    return centres


@query()
def roi_model(spark, sf):
    groups = roi.roi_groups(I.roi_rows(spark, sf), "o_orderkey", ["channel", "year", "month"], [*I.INCOMES, "total"])
    report = roi.roi_model(groups, ["channel", "year", "month"], I.INCOMES)
    return report.reports["regression"]


@query()
def roi_logistic(spark, sf):
    """Which groups bring in more than a fixed amount: AUC of the logistic model."""
    groups = roi.roi_groups(I.roi_rows(spark, sf), "o_orderkey", ["channel", "year", "month"], [*I.INCOMES, "total"])
    cut = groups.where("split = 'train'").agg(F.avg("total")).first()[0]
    return roi.roi_model(groups, ["channel", "year", "month"], I.INCOMES, cut=cut).reports["auc"]
