"""Shards along a Hilbert curve over metadata, with DataFrame operations only.

Several metadata dimensions are quantised to ``2**bits`` steps each; the cell they give has a place on a
Hilbert curve. Rows are ordered by (curve place, run, id) and the order is cut into shards whose row
counts are at most one apart, so a shard covers few, neighbouring cells and files can be pruned on any of
the dimensions.

Places are counted, not sorted: a cell is split into ``runs`` runs by ``id mod runs``, the rows before
each (cell, run) are prefix sums of grouped counts (at most ``cells x runs`` rows, whatever the table
holds), and only inside a run are rows numbered. A hot cell is thus spread over ``runs`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

BITS = 4
RUNS = 256


def digit(c: Column | str) -> Column:
    """A category as one of 16 steps: the first hex digit of its MD5; null is step 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.conv(F.substring(F.md5(c.cast("string")), 1, 1), 16, 10).cast("int"), F.lit(0))


def magnitude(c: Column | str) -> Column:
    """A non-negative number as one of 16 steps, by its binary length less four; null is step 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.least(F.lit(15), F.greatest(F.lit(0), F.length(F.bin(c.cast("bigint"))) - 4)), F.lit(0))


def hilbert_place(axes: Sequence[int], bits: int) -> int:
    """Place on the curve of one cell (Skilling's transform): undo the rotations from the highest bit
    down, Gray-code, interleave."""
    x, n = list(axes), len(axes)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            if x[i] >> b & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = 0
    for b in range(bits - 1, 0, -1):
        if x[-1] >> b & 1:
            flips ^= (1 << b) - 1
    place = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            place = place << 1 | ((v ^ flips) >> b & 1)
    return place


def curve_table(spark: SparkSession, n: int, bits: int) -> DataFrame:
    """``_c`` (a cell's coordinates, packed) and ``_curve`` for all ``2**(bits * n)`` cells, 65,536 at most."""
    if bits * n > 16:
        raise ValueError("bits times dimensions must not exceed 16")
    low = (1 << bits) - 1
    cells = [(c, hilbert_place([c >> bits * (n - 1 - i) & low for i in range(n)], bits)) for c in range(1 << bits * n)]
    return spark.createDataFrame(cells, "_c int, _curve int")


def hilbert_shards(
    df: DataFrame, id: str, dims: Sequence[Column], tie: Sequence[Column] = (), n_shards: int = 16, bits: int = BITS, runs: int = RUNS
) -> DataFrame:
    """All rows with ``curve`` int, ``shard`` int (0 to ``n_shards - 1``) and ``slot`` long (0-based place
    in the shard). ``dims`` give integers in ``[0, 2**bits)``.

    Shard ``s`` holds places ``ceil(s*N/n)`` up to ``ceil((s+1)*N/n)`` of the order (curve, id mod runs,
    id, ``tie``): sizes differ by one at most. A null id counts as run 0 and comes first. Rows equal in id
    and ``tie`` take neighbouring places in either order. An empty table gives an empty table. Input
    columns named like an output column are replaced by it.
    """
    added = ("curve", "shard", "slot")
    inside = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        sum(d * (1 << bits * (len(dims) - 1 - i)) for i, d in enumerate(dims)).cast("int").alias("_cell"),
        F.pmod(F.coalesce(F.col(id).cast("bigint"), F.lit(0)), F.lit(runs)).cast("int").alias("_run"),
        F.struct(F.col(id).cast("bigint").alias("id"), *[c.alias(f"t{i}") for i, c in enumerate(tie)]).alias("_order"),
    )
    counts = inside.groupBy("_cell", "_run").agg(F.count("*").alias("_n"))
    along = Window.orderBy("_curve").rowsBetween(Window.unboundedPreceding, -1)  # a row per cell in use
    cells = (
        counts.groupBy("_cell").agg(F.sum("_n").alias("_in_cell"))
        .join(F.broadcast(curve_table(df.sparkSession, len(dims), bits)), F.col("_cell") == F.col("_c"))
        .select("_c", "_curve", F.coalesce(F.sum("_in_cell").over(along), F.lit(0)).alias("_cell_start"), F.sum("_in_cell").over(Window.partitionBy()).alias("_total"))
    )
    in_cell = Window.partitionBy("_cell").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(in_cell), F.lit(0)))
        .join(cells, F.col("_cell") == F.col("_c"))
        .select("_c", F.col("_run").alias("_r"), "_curve", (F.col("_cell_start") + F.col("_before")).alias("_start"), "_total")
    )
    here = Window.partitionBy("_cell", "_run").orderBy("_order")
    placed = (
        inside.withColumn("_at", F.row_number().over(here) - 1)
        .join(starts, (F.col("_cell") == F.col("_c")) & (F.col("_run") == F.col("_r")))
        .withColumn("_rank", F.col("_start") + F.col("_at"))
    )
    shard = F.expr(f"(_rank * {n_shards}) div _total")
    return placed.withColumn("_shard", shard).select(
        *[F.col("_row").getField(c).alias(c) for c in df.columns if c not in added],
        F.col("_curve").cast("int").alias("curve"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_rank") - F.expr(f"(_shard * _total + {n_shards - 1}) div {n_shards}")).cast("bigint").alias("slot"),
    )


def hilbert_sql(rows: str, axes: Sequence[str], id: str, tie: Sequence[str], n_shards: int = 16, bits: int = BITS, runs: int = RUNS) -> str:
    """The same as DuckDB SQL over the table expression ``rows``: its columns with curve, shard, slot."""
    n = len(axes)
    ctes = [f"_k0 as (select *, {', '.join(f'({a})::int as _x{i}' for i, a in enumerate(axes))} from {rows})"]
    k = 0
    for b in range(bits - 1, 0, -1):
        for i in range(n):
            q, low = 1 << b, (1 << b) - 1
            new = [f"case when (_x{i} & {q}) <> 0 then xor(_x0, {low}) else " + ("_x0" if i == 0 else f"xor(_x0, xor(_x0, _x{i}) & {low})") + " end as _x0"]
            if i:
                new.append(f"case when (_x{i} & {q}) <> 0 then _x{i} else xor(_x{i}, xor(_x0, _x{i}) & {low}) end as _x{i}")
            ctes.append(f"_k{k + 1} as (select * replace ({', '.join(new)}) from _k{k})")
            k += 1
    for i in range(1, n):
        ctes.append(f"_k{k + 1} as (select * replace (xor(_x{i}, _x{i - 1}) as _x{i}) from _k{k})")
        k += 1
    flips = "0"
    for b in range(bits - 1, 0, -1):
        flips = f"xor({flips}, case when (_x{n - 1} & {1 << b}) <> 0 then {(1 << b) - 1} else 0 end)"
    ctes.append(f"_f as (select *, {flips} as _t from _k{k})")
    place = " + ".join(f"((xor(_x{i}, _t) >> {b}) & 1) * {1 << (b * n + n - 1 - i)}" for b in range(bits - 1, -1, -1) for i in range(n))
    order = f"curve, coalesce({id}, 0) % {runs}, {id} nulls first, {', '.join(tie)}"
    ctes.append(f"_c as (select * exclude (_t, {', '.join(f'_x{i}' for i in range(n))}), ({place})::int as curve from _f)")
    ctes.append(f"_o as (select *, (row_number() over (order by {order}) - 1)::bigint as _rank, count(*) over () as _total from _c)")
    ctes.append(f"_s as (select *, ((_rank * {n_shards}) // _total)::int as shard from _o)")
    return f"with {', '.join(ctes)} select * exclude (_rank, _total), (_rank - (shard * _total + {n_shards - 1}) // {n_shards})::bigint as slot from _s"
