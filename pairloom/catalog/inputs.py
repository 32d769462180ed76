"""Stand-ins for the four input tables on the benchmark tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.plans.match import MatchRoles
from pairloom.spec import DatasetSpec, Range, ResponseCodes

# Code of each market segment, and the reference day for ages.
SEGMENTS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
ASOF = "2001-08-01"

PROFILE_RANGES = tuple(
    Range.parse(r) for r in ("age, 10, 100", "height, 100, 200", "sex, 0, 1", "marriage, 1, 10", "body, *, 4")
)
PROFILE_FIELDS = ("age", "height", "praise", "salary", "body")
PROFILE_CATEGORICAL = ("salary", "body")
PROFILE_ATTRS = ("workcity", "sex", "marriage", "height", "age", "salary", "body", "praise")

ROLES = MatchRoles(
    male_fields=("salary", "region"), female_fields=("salary", "region"), categorical=("salary", "region")
)
WIDE_ROLES = MatchRoles(
    male_fields=("marriage", "age", "height", "salary", "body", "praise"),
    female_fields=("marriage", "age", "height", "salary", "body"),
    categorical=("marriage", "salary", "body"),
)
LINE_CODES = ResponseCodes(positives=("A",), negatives=("R",), pending=("N",))
ORDER_CODES = ResponseCodes(positives=("F",), negatives=("O",), pending=("P",))

PAYMENT_SPEC = DatasetSpec(
    fields=(
        "memberid", "iszat", "salary", "sex", "birthday", "workcity", "marriage", "logincount", "viewcount",
        "sendleercount", "receiveleercount", "praisecount", "micropaycount", "micropayamount",
    ),
    categorical=("iszat", "salary", "sex", "workcity", "marriage"),
    ignored=("workcity",),
    predictors=(
        "sex", "birthday", "salary", "marriage", "logincount", "viewcount", "sendleercount", "receiveleercount",
        "praisecount", "micropaycount",
    ),
    target="iszat",
    types={"birthday": "string"},
)
POINT_FIELDS = ("p_brand", "p_type", "p_size", "price")
POINT_CATEGORICAL = ("p_brand", "p_type")
INCOMES = ("income0", "income1", "income2", "income3")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def line_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Action log without roles: part -> supplier, response = return flag."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("aid"), F.col("l_suppkey").alias("bid"), F.col("l_returnflag").alias("resp")
    )


LINE_ACTIONS = "line_actions as (select l_partkey as aid, l_suppkey as bid, l_returnflag as resp from lineitem)"


def order_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Action log between customers: a quarter of the targets' ids have no profile, some equal the initiator."""
    reach = table(spark, sf, "customer").agg(F.expr("count(*) * 4 div 3")).scalar()
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("aid"), ((F.col("o_orderkey") * 31) % reach).alias("bid"),
        F.col("o_orderstatus").alias("resp"),
    )


ORDER_ACTIONS = (
    "order_actions as (select o_custkey as aid, (o_orderkey * 31) % (select count(*) * 4 // 3 from customer) as bid, o_orderstatus as resp from orders)"
)


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles: one row per customer, some attributes out of range or NULL."""
    key = F.col("c_custkey")
    segment = F.coalesce(*[F.when(F.col("c_mktsegment") == s, code) for s, code in SEGMENTS.items()])
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return (
        table(spark, sf, "customer")
        .join(orders, "c_custkey", "left")
        .join(nation, "c_nationkey")
        .select(
            key.alias("userid"),
            F.col("c_nationkey").cast("bigint").alias("workcity"),
            F.col("n_regionkey").cast("bigint").alias("region"),
            (key % 2).alias("sex"),
            (key % 9 + 1).alias("marriage"),
            (key % 120 + 100).alias("height"),
            ((key * 7) % 100 + 10).alias("age"),
            segment.cast("bigint").alias("salary"),
            F.when(key % 7 != 6, key % 7).alias("body"),
            F.floor("c_acctbal").alias("balance"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("praise"),
        )
    )


_SEGMENT_CASE = "case c_mktsegment " + " ".join(f"when '{s}' then {c}" for s, c in SEGMENTS.items()) + " end"
PROFILES = f"""profiles as (
  select c_custkey as userid, c_nationkey::bigint as workcity, n_regionkey::bigint as region,
         c_custkey % 2 as sex, c_custkey % 9 + 1 as marriage, c_custkey % 120 + 100 as height,
         (c_custkey * 7) % 100 + 10 as age, ({_SEGMENT_CASE})::bigint as salary,
         case when c_custkey % 7 <> 6 then c_custkey % 7 end as body,
         floor(c_acctbal)::bigint as balance, coalesce(n, 0)::bigint as praise
  from customer
  left join (select o_custkey, count(*) as n from orders group by 1) on o_custkey = c_custkey
  join nation on n_nationkey = c_nationkey)"""
VALID = """valid as (
  select * from profiles
  where height > 0 and age > 0 and age < 100 and sex in (0, 1) and marriage > 0 and marriage < 10)"""
IN_RANGE = """in_range as (
  select * from profiles
  where age between 10 and 100 and height between 100 and 200 and sex between 0 and 1
    and marriage between 1 and 10 and coalesce(body, -1) <= 4)"""


def payments(spark: SparkSession, sf: str) -> DataFrame:
    """Payment table: conversion flag and behaviour counts per customer; birthdays come as dates, as
    ages and as unreadable text, some marriage codes are NULL or out of range."""
    key = F.col("c_custkey")
    segment = F.coalesce(*[F.when(F.col("c_mktsegment") == s, code) for s, code in SEGMENTS.items()])
    born = F.date_format(F.add_months(F.to_date("first_day"), -360), "yyyy-MM-dd")
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max((F.col("o_totalprice") > 490000).cast("int")).alias("iszat"),
        F.min("o_orderdate").alias("first_day"),
        F.count("*").alias("logincount"),
        F.count_if(F.col("o_orderstatus") == "O").alias("viewcount"),
        F.count_if(F.col("o_orderstatus") == "F").alias("sendleercount"),
        F.count_if(F.col("o_orderstatus") == "P").alias("receiveleercount"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("praisecount"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("micropaycount"),
        F.floor(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).cast("bigint").alias("micropayamount"),
    )
    counts = ("logincount", "viewcount", "sendleercount", "receiveleercount", "praisecount", "micropaycount", "micropayamount")
    return (
        table(spark, sf, "customer")
        .join(orders, "c_custkey", "left")
        .select(
            key.alias("memberid"),
            F.coalesce("iszat", F.lit(0)).alias("iszat"),
            segment.alias("salary"),
            (key % 2).alias("sex"),
            F.when(key % 50 == 0, "unknown").when(key % 50 == 1, "25").otherwise(born).alias("birthday"),
            F.col("c_nationkey").alias("workcity"),
            F.when(key % 13 != 0, key % 12).alias("marriage"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        )
    )


PAYMENTS = f"""payments as (
  select c_custkey as memberid, coalesce(iszat, 0) as iszat, {_SEGMENT_CASE} as salary, c_custkey % 2 as sex,
         case when c_custkey % 50 = 0 then 'unknown' when c_custkey % 50 = 1 then '25'
              else strftime(first_day::date - interval 30 year, '%Y-%m-%d') end as birthday,
         c_nationkey as workcity, case when c_custkey % 13 <> 0 then c_custkey % 12 end as marriage,
         coalesce(logincount, 0) as logincount, coalesce(viewcount, 0) as viewcount,
         coalesce(sendleercount, 0) as sendleercount, coalesce(receiveleercount, 0) as receiveleercount,
         coalesce(praisecount, 0) as praisecount, coalesce(micropaycount, 0) as micropaycount,
         coalesce(micropayamount, 0) as micropayamount
  from customer left join (
    select o_custkey, max((o_totalprice > 490000)::int) as iszat, min(o_orderdate) as first_day,
           count(*) as logincount, count(*) filter (o_orderstatus = 'O') as viewcount,
           count(*) filter (o_orderstatus = 'F') as sendleercount,
           count(*) filter (o_orderstatus = 'P') as receiveleercount,
           count(*) filter (o_orderpriority = '1-URGENT') as praisecount,
           count(*) filter (o_orderpriority = '5-LOW') as micropaycount,
           floor(sum(o_totalprice::decimal(18,2)))::bigint as micropayamount
    from orders group by 1) on o_custkey = c_custkey)"""
AGED = f"""aged as (
  select * exclude (birthday),
         coalesce(case when strpos(birthday, '-') = 0 then try_cast(birthday as int)
                       else year(date '{ASOF}') - year(try_strptime(birthday, '%Y-%m-%d')) end, 0) as birthday
  from payments)"""
VALID_PAYMENTS = "valid_payments as (select * from aged where marriage between 0 and 10 and birthday between 1 and 99)"
SPLIT_PAYMENTS = """split_payments as (
  select * from (
    select *, case when iszat = 1 then case when memberid % 10 in (0, 2, 3, 4, 6, 8, 9) then 'train' else 'test' end
                   when memberid % 10 = 7 then 'train' when memberid % 10 = 5 then 'test' end as split
    from valid_payments) where split is not null)"""


def roi_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Income rows per order: four income kinds by line status and tax band, and their total."""
    status, low = F.col("l_linestatus"), F.col("l_tax") <= 0.04
    price = F.col("l_extendedprice")
    kinds = ((status == "F") & low, (status == "F") & ~low, (status == "O") & low, (status == "O") & ~low)
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[F.sum(F.when(k, price).otherwise(0.0)).alias(n) for k, n in zip(kinds, INCOMES)], F.sum(price).alias("total")
    )
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").join(lines, "o_orderkey").select(
        "o_orderkey", F.col("o_orderpriority").alias("channel"), F.year(day).alias("year"), F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"), *INCOMES, "total",
    )


ROI_ROWS = """roi_rows as (
  select o_orderkey, o_orderpriority as channel, year(o_orderdate) as year, month(o_orderdate) as month,
         day(o_orderdate) as day, income0, income1, income2, income3, total
  from orders join (
    select l_orderkey,
           sum(case when l_linestatus = 'F' and l_tax <= 0.04 then l_extendedprice else 0 end) as income0,
           sum(case when l_linestatus = 'F' and l_tax > 0.04 then l_extendedprice else 0 end) as income1,
           sum(case when l_linestatus = 'O' and l_tax <= 0.04 then l_extendedprice else 0 end) as income2,
           sum(case when l_linestatus = 'O' and l_tax > 0.04 then l_extendedprice else 0 end) as income3,
           sum(l_extendedprice) as total
    from lineitem group by 1) on l_orderkey = o_orderkey)"""


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Mixed-type points: two categories and two numbers per part."""
    return table(spark, sf, "part").select(
        "p_partkey", "p_brand", "p_type", F.col("p_size").cast("bigint").alias("p_size"),
        F.floor("p_retailprice").alias("price"),
    )


POINTS = """points as (
  select p_partkey, p_brand, p_type, p_size::bigint as p_size, floor(p_retailprice)::bigint as price from part)"""


def point_centres(spark: SparkSession, sf: str) -> DataFrame:
    """The first part of every brand as a centre."""
    rows = points(spark, sf)
    first = rows.groupBy("p_brand").agg(F.min("p_partkey").alias("centre_id"))
    return rows.join(first.select("centre_id"), F.col("p_partkey") == F.col("centre_id")).select(
        "centre_id", *POINT_FIELDS
    )


POINT_CENTRES = """point_centres as (
  select p_partkey as centre_id, p_brand, p_type, p_size, price from points
  where p_partkey in (select min(p_partkey) from points group by p_brand))"""


def gower_sql(a: str, b: str, fields=POINT_FIELDS, categorical=POINT_CATEGORICAL, source: str = "points") -> str:
    """The Gower distance of two aliased rows, as SQL."""
    terms = []
    for f in fields:
        if f in categorical:
            terms.append(f"case when {a}.{f} = {b}.{f} then 1.0::double else 0.0::double end")
        else:
            span = f"(select max({f}) - min({f}) from {source})"
            terms.append(
                f"case when {span} = 0 then 1.0::double else 1.0::double - abs({a}.{f} - {b}.{f})::double / {span} end"
            )
    return f"round(1.0::double / (1.0::double + ({' + '.join(terms)}) / {len(terms)}), 9)"


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), F.col("label").alias("centre_id")
    )


def vector_centres(spark: SparkSession, sf: str) -> DataFrame:
    """The first vector of every label as a centre."""
    rows = vectors(spark, sf)
    first = rows.groupBy("centre_id").agg(F.min("vec_id").alias("vec_id"))
    return rows.join(first.select("vec_id"), "vec_id").select("centre_id", "features")


VECTORS = "vectors as (select vec_id, embedding::double[] as features, label as centre_id from embeddings)"
VECTOR_CENTRES = """vector_centres as (
  select centre_id, features from vectors where vec_id in (select min(vec_id) from vectors group by centre_id))"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows: the quality label of a document and a fixed logistic of its length."""
    score = 1.0 / (1.0 + F.exp(-(F.col("n_chars") - 2447.0) / 3159.0))
    documents = table(spark, sf, "documents").select("doc_id", score.alias("score"))
    return table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")).join(documents, "doc_id")


SCORED = """scored as (
  select l.doc_id, l.quality as label,
         1.0::double / (1.0::double + exp(-(n_chars - 2447.0::double) / 3159.0::double)) as score
  from labels l join documents d on d.doc_id = l.doc_id)"""
