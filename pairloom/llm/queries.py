"""The queries of the text operators over the driver's tables, and their SQL where SQL can state them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import decontaminate, frames, jaccard, lines, merkle, minhash, mixing, pii, quality, sharding, suffixes, toxicity, winnow
from pairloom.llm.samples import held_out
from pairloom.session import store

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        LLM_QUERIES[fn.__name__] = fn
        if sql:
            LLM_ORACLE[fn.__name__] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# -- 1: near copies ----------------------------------------------------------------------------------

JACCARD_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
),
s as (
  select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as sh from w
),
n as (select doc_id, len(sh) as n from s),
t as (select doc_id, unnest(sh) as g from s),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from t a join t b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)
),
both_ways as (select a, b from links union select b, a from links),
reach as (select a, b from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a)
select n.doc_id, n.n::bigint as n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) as component_id
from n left join reach r on r.a = n.doc_id group by n.doc_id, n.n"""


@query(JACCARD_SQL.strip())
def op1_ngram_jaccard(spark, sf_dir):
    return jaccard.similar_components(documents(spark, sf_dir)).drop("text_hash")


# -- 2: shards ---------------------------------------------------------------------------------------

def shard_dims() -> list:
    return [sharding.digit("lang"), sharding.digit("source"), sharding.magnitude(F.octet_length("text"))]


#: CRC-32 of UTF-8 bytes as a fold over a table made from its polynomial
CRC_TABLE = """
crc_table as materialized (
  select list(v order by i) as t from (
    select i, list_reduce(list_prepend(i::bigint, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
      lambda c, z: case when (c & 1) = 1 then xor(3988292384, c >> 1) else c >> 1 end) as v
    from range(256) r(i))
)"""
CRC_SQL = CRC_TABLE + """,
rows_in as (
  select doc_id, coalesce(octet_length(encode(text)), 0) + 1 as size, lang, source,
    case when text is null or text = '' then 0 else xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, list_transform(range(1, octet_length(encode(text)) * 2, 2),
        lambda i: ('0x' || substr(hex(encode(text)), i, 2))::bigint)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) end as text_crc32
  from documents, crc_table
)"""


def _op2_sql() -> str:
    digit = "coalesce(('0x' || substr(md5({}), 1, 1))::int, 0)".format
    size = "case when size = 1 then 0 else least(15, greatest(0, length(bin(size - 1)) - 4)) end"
    body = sharding.hilbert_sql("rows_in", [digit("lang"), digit("source"), size], "doc_id", ["size", "text_crc32"])
    return (
        f"with {CRC_SQL.strip()}, placed as ({body}) select doc_id, size::bigint as size, text_crc32, 'rows' as law, shard, slot, "
        "null::int as grown_shard, curve from placed"
    )


@query(_op2_sql())
def op2_hilbert_shards(spark, sf_dir):
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), "text", "lang", "source"
    )
    out = sharding.hilbert_shards(rows.select("doc_id", "size", "text_crc32", *[d.alias(f"d{i}") for i, d in enumerate(shard_dims())]), "doc_id",
                                  [F.col("d0"), F.col("d1"), F.col("d2")], [F.col("size"), F.col("text_crc32")])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


# -- 3: repeated passages -----------------------------------------------------------------------------


@query()
def op3_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(documents(spark, sf_dir)).drop("spans")


# -- 4: fingerprints ---------------------------------------------------------------------------------


@query()
def op4_winnowing(spark, sf_dir):
    return winnow.compare_with_next(documents(spark, sf_dir))


# -- 5: lines ----------------------------------------------------------------------------------------

LINE_SQL = r"""
with lines as (
  select doc_id, pos, line, lower(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) as any_case, line as raw
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents)
),
keyed as (
  select doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
),
frequent as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40 and doc_id is not null group by key having count(distinct doc_id) >= 5
),
marked as (select k.*, f.key is not null and k.doc_id <> f.keeper as dropped from keyed k left join frequent f using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (where dropped)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id"""


def _kept_hash(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        sha = [
            hashlib.sha256((lines.apply_bitmap(t, k, n) if d else t or "").encode()).hexdigest()
            for t, k, n, d in zip(f["text"], f["keep"], f["n_lines"], f["n_dropped"])
        ]
        yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "n_lines": f["n_lines"], "n_dropped": f["n_dropped"], "kept_sha256": sha})


@query(LINE_SQL.strip())
def op5_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    keep = lines.line_keep_bitmaps(docs).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), "n_lines", "n_dropped", "keep").distinct()
    both = docs.join(keep, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")))
    return both.select("doc_id", "text", "n_lines", "n_dropped", "keep").mapInPandas(
        _kept_hash, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


# -- 6: quality --------------------------------------------------------------------------------------


@query()
def op6_quality_mil(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = quality.score_quality(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


# -- 7: mixing ---------------------------------------------------------------------------------------

#: domains by the number of the source
DOMAIN = "case when regexp_extract(source, '([0-9]+)$', 1) = '' then 'other' when cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 3 = 0 then 'web' when cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 3 = 1 then 'reference' else 'forum' end"
WEIGHTS = {"domain": {"web": 4, "reference": 3, "forum": 2, "other": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (4, 5), 3, 7


def mix_sql(share: tuple[int, int], epochs: int, seed: int, docs: str = "documents") -> str:
    def weight(level: str) -> str:
        whens = " ".join(f"when '{k}' then {v}" for k, v in WEIGHTS.get(level, {}).items())
        return f"case {level} {whens} else 1 end" if whens else "1"

    levels = mixing.LEVELS
    ctes = [
        f"r as (select doc_id, {DOMAIN} as domain0, coalesce(lang, 'unknown') as lang, coalesce(source, 'unknown') as source, lang as lang0, source as source0, "
        r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n_tokens, md5(coalesce(text, '')) as tie, "
        f"coalesce(doc_id::varchar, 'null') as id from {docs})",
        "rows_in as (select * exclude (domain0), coalesce(domain0, 'unknown') as domain from r)",
        f"leaves as (select domain, lang, source, sum(n_tokens)::hugeint as tokens, sum(n_tokens)::hugeint * {epochs} as cap from rows_in group by all)",
    ]
    for depth, level in enumerate(levels):
        path, above = ", ".join(levels[: depth + 1]), ", ".join(levels[:depth])
        part = f"partition by {above}" if above else ""
        budget = "budget" if above else f"((sum(tokens) over ()) * {share[0]} // {share[1]})::hugeint as budget"
        source = f"(select {path}, sum(cap)::hugeint as cap, sum(tokens)::hugeint as tokens, ({weight(level)})::hugeint as w from leaves group by {path})"
        ctes.append(f"n{depth} as (select *, {budget} from {source}" + (f" join q{depth - 1} using ({above}))" if above else ")"))
        win = f"over ({part} order by cap::double / w::double, {level} rows between unbounded preceding and 1 preceding)"
        ctes.append(f"a{depth} as (select *, budget - coalesce(sum(cap) {win}, 0)::hugeint as left_, (sum(w) over ({part}))::hugeint - coalesce(sum(w) {win}, 0)::hugeint as rest from n{depth})")
        ctes.append(f"b{depth} as (select *, cap * rest <= left_ * w as full_ from a{depth})")
        ctes.append(
            f"q{depth} as (select {path}, case when full_ then cap else ((budget - coalesce(sum(case when full_ then cap end) over ({part}), 0)::hugeint) * w) // (sum(case when not full_ then w end) over ({part}))::hugeint end as budget from b{depth})"
        )
    ctes += [
        "quotas as (select domain, lang, source, case when tokens = 0 then 0 else budget // tokens end as e, case when tokens = 0 then 0 else budget % tokens end as rest from leaves join q2 using (domain, lang, source))",
        f"keyed as (select *, md5('{seed}:' || (e + 1)::varchar || ':' || id) as key from rows_in join quotas using (domain, lang, source))",
        "run as (select *, sum(n_tokens) over (partition by domain, lang, source order by key, id, tie rows unbounded preceding) as upto from keyed)",
    ]
    return "with " + ",\n".join(ctes) + (
        "\nselect doc_id, lang0 as lang, source0 as source, domain, n_tokens, copies from (select *, (e + case when upto <= rest and (rest > 0 or e = 0) then 1 else 0 end)::int as copies from run) where copies > 0"
    )


@query(mix_sql(MIX_SHARE, MIX_EPOCHS, MIX_SEED))
def op7_mix_sources(spark, sf_dir):
    """Four fifths of the table's tokens, sources up to three times."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return mixing.mix_to_weights(docs, "doc_id", "text", F.expr(DOMAIN), WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED).drop("text")


# -- 8: decontamination ------------------------------------------------------------------------------


@query()
def op8_benchmark_leaks(spark, sf_dir):
    return decontaminate.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# -- 9: toxicity -------------------------------------------------------------------------------------


@query()
def op9_toxicity_bigru(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


# -- 10: personal data -------------------------------------------------------------------------------


@query()
def op10_pii_boosting(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = pii.find_spans(docs, pii.fit_spans(docs))
    n_of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id",
        *[n_of(k) for k in pii.KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


# -- 11: manifest --------------------------------------------------------------------------------------


def _field(x: str) -> str:
    return f"case when {x} is null then '-' else octet_length(encode({x}::varchar))::varchar || ':' || {x}::varchar end"


def _op11_sql() -> str:
    leaf = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    shown = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")) + ")"
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, octet_length(encode(doc_id::varchar)) * 2, 2),
      lambda i: ('0x' || substr(hex(encode(doc_id::varchar)), i, 2))::bigint)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))"""
    around = """coalesce(lag(h, 2) over w, '') || coalesce(lag(h) over w, '') as before, coalesce(lead(h) over w, '') || coalesce(lead(h, 2) over w, '') as after"""
    return f"""
with recursive {CRC_TABLE.strip()},
leaves as (
  select doc_id, source, leaf, case when crc % 2 = 0 then shown else leaf end as shown, count(*) over (partition by source) as n,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos
  from (select doc_id, source, {leaf} as leaf, {shown} as shown, {crc} as crc from documents, crc_table)
),
level as (
  select source, 0 as l, pos as i, leaf as h, n from leaves
  union all
  select source, l + 1, i // 3, sha256(string_agg(h, '' order by i)), any_value((n + 2) // 3) from level where n > 1 group by source, l, i // 3
),
tops as (select source, h, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n from level where n = 1),
over_ as (
  select 0 as l, i, h, n from tops
  union all
  select l + 1, i // 3, sha256(string_agg(h, '' order by i)), any_value((n + 2) // 3) from over_ where n > 1 group by l, i // 3
),
beside as (select source, l, i, {around} from level where n > 1 window w as (partition by source, l, i // 3 order by i)),
beside_top as (select l, i, {around} from over_ where n > 1 window w as (partition by l, i // 3 order by i)),
steps as (
  select d.source, d.pos, l, before, after from leaves d join beside b on b.source is not distinct from d.source and b.i = d.pos // (3 ** b.l)::bigint
  union all
  select d.source, d.pos, 1000 + l, before, after from leaves d join tops t on t.source is not distinct from d.source join beside_top b on b.i = t.i // (3 ** b.l)::bigint
),
numbered as (select *, row_number() over (partition by source, pos order by l) as k from steps),
proofs as (select source, pos, sha256(string_agg(before || after, '' order by k)) as proof from numbered group by source, pos),
folds as (
  select source, pos, 0 as k, shown as h from leaves
  union all
  select f.source, f.pos, f.k + 1, sha256(before || h || after) from folds f join numbered s on s.source is not distinct from f.source and s.pos = f.pos and s.k = f.k + 1
),
folded as (select source, pos, arg_max(h, k) as h from folds group by source, pos)
select d.doc_id, d.leaf, t.h as subroot, r.h as root, coalesce(p.proof, sha256('')) as proof_sha256, f.h as folded_root, f.h = r.h as verified
from leaves d join tops t on t.source is not distinct from d.source join folded f on f.source is not distinct from d.source and f.pos = d.pos
left join proofs p on p.source is not distinct from d.source and p.pos = d.pos, (select h from over_ where n = 1) r"""


@query(_op11_sql().strip())
def op11_merkle_manifest(spark, sf_dir):
    """Every document's proof, and whether it still holds where line ends are taken out of every other text."""
    fields = lambda text: merkle.leaf_of([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])
    touched = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    shown = F.when(touched, fields(F.replace("text", F.lit("\n"), F.lit(""))))
    return merkle.manifest(documents(spark, sf_dir), "doc_id", "source", fields(F.col("text")), shown)


# -- 12: fill in the middle ----------------------------------------------------------------------------

FIM_SQL = r"""
with u as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as us,
    sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents
),
k as (
  select *, len(us) as n, ('0x' || h[1:8])::bigint % (len(us) + 1) as c1, ('0x' || h[9:16])::bigint % (len(us) + 1) as c2,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or ('0x' || h[17:24])::bigint % 100 >= 100 then 'plain'
      when ('0x' || h[25:32])::bigint % 100 < 50 then 'spm' else 'psm' end as form from u
),
p as (
  select doc_id, text, n, form, array_to_string(us[1:least(c1, c2)], '') as pre, array_to_string(us[least(c1, c2) + 1:greatest(c1, c2)], '') as mid,
    array_to_string(us[greatest(c1, c2) + 1:], '') as suf from k
),
o as (
  select *, case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
    else '<S>' || suf || '<P>' || pre || '<M>' || mid end as output from p
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(output) as output_sha256, sha256(case when form = 'plain' then output else
    (case form when 'psm' then regexp_extract(output, '(?s)^<P>(.*)<S>', 1) else regexp_extract(output, '(?s)<P>(.*)<M>', 1) end)
    || regexp_extract(output, '(?s)<M>(.*)$', 1)
    || (case form when 'psm' then regexp_extract(output, '(?s)<S>(.*)<M>', 1) else regexp_extract(output, '(?s)^<S>(.*)<P>', 1) end) end) as restored_sha256
from o"""


@query(FIM_SQL.strip())
def op12_fim_frames(spark, sf_dir):
    """Texts are written once as frames; cutting and digests run over them."""
    stored = store(frames.text_frames(documents(spark, sf_dir)))
    return frames.output_digests(frames.fill_in_middle(stored))


# -- 13: near copies by minima ---------------------------------------------------------------------------

MINHASH_SQL = (
    JACCARD_SQL.strip()
    .replace("len(ws) < 5", "len(ws) < 2").replace("range(1, len(ws) - 3)", "range(1, len(ws))").replace("ws[i:i + 4]", "ws[i:i + 1]")
    .replace("select n.doc_id, n.n::bigint as n_shingles", "select *, doc_id = component_id as kept from (select n.doc_id, n.n::bigint as n_shingles")
    + ")"
)


@query(MINHASH_SQL)
def op13_minhash_dedup(spark, sf_dir):
    return minhash.near_copies(documents(spark, sf_dir))
