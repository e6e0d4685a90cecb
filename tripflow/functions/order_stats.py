"""Exact order statistics that never gather an unbounded group in one task.

Both helpers work in two levels. Level one counts rows per (group, band), where a band is a coarse range
of the ordering value, and accumulates those counts: the accumulated table has at most one row per band.
Level two looks only at the band that holds the wanted position. Equal values are counted before any
shuffle, so a value repeated a billion times is one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.session import settled

# DECIMAL(12,2) amounts are below 10^12 cents, so both levels hold at most 10^6 rows per group.
VALUE_BAND = 1_000_000
# The top 16 bits of a 64-bit hash: at most 65,536 bands, in hash order.
HASH_BAND_SHIFT = 48


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    pairs = (F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names)
    return reduce(and_, pairs, F.lit(True))


def exact_median(df: DataFrame, value: str, keys: Sequence[str] = (), out: str = "median") -> DataFrame:
    """Median of an integer column per key, interpolated between the two middle values (a double)."""
    keys = list(keys)
    hist = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("bigint").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    band = F.floor(F.col("_v") / VALUE_BAND).alias("_band")
    groups = keys or [F.lit(0)]
    by_band = Window.partitionBy(*groups).orderBy("_band")
    bands = (
        hist.groupBy(*keys, band)
        .agg(F.sum("_n").alias("_n"))
        .select(
            *keys,
            "_band",
            (F.sum("_n").over(by_band) - F.col("_n")).alias("_before"),
            F.sum("_n").over(by_band).alias("_upto"),
            F.sum("_n").over(Window.partitionBy(*groups)).alias("_total"),
        )
        .withColumn("_lo", F.expr("(_total - 1) div 2"))
        .withColumn("_hi", F.expr("_total div 2"))
        .where((F.col("_before") <= F.col("_hi")) & (F.col("_upto") > F.col("_lo")))
    )
    joined = (
        hist.select("*", band)
        .alias("h")
        .join(bands.alias("b"), _same("h", "b", [*keys, "_band"]))
        .select(*(f"h.{k}" for k in keys), "h._band", "_v", "_n", "_before", "_lo", "_hi")
    )
    in_band = Window.partitionBy(*keys, "_band").orderBy("_v")
    end = F.col("_before") + F.sum("_n").over(in_band)
    placed = joined.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_n"))
    holds = lambda pos: (F.col("_start") <= F.col(pos)) & (F.col(pos) < F.col("_end"))
    return placed.groupBy(*keys).agg(
        (
            (F.max(F.when(holds("_lo"), F.col("_v"))) + F.max(F.when(holds("_hi"), F.col("_v")))) / 2
        ).alias(out)
    )


def smallest_per_group(
    df: DataFrame, groups: Sequence[str], rank_hash: Column, wanted: int | Callable[[int], int]
) -> DataFrame:
    """The `wanted` rows of each group with the smallest hash: an exact, repeatable stratified sample.

    `wanted` is a number, or a function of the number of groups. The source is read twice: for a sketch (rows per group
    and band of the hash, which adds up from any parts), and for the rows up to the band that decides. From there on
    only these rows are touched, from the shared folder: whole bands below pass as they are, and inside the
    deciding band identical rows are counted first and re-expanded, so copies of one row cannot crowd one task.
    """
    groups, columns = list(groups), df.columns
    hashed = df.withColumn("_hash", rank_hash.cast("bigint")).withColumn(
        "_band", F.shiftright("_hash", HASH_BAND_SHIFT)
    )
    sketch = settled(hashed.groupBy(*groups, "_band").agg(F.count(F.lit(1)).alias("_n")), "hash-sketch")
    if callable(wanted):
        wanted = wanted(sketch.select(*groups).distinct().count())
    by_band = Window.partitionBy(*groups).orderBy("_band")
    edges = (
        sketch.withColumn("_upto", F.sum("_n").over(by_band))
        .where(F.col("_upto") - F.col("_n") < wanted)
        .groupBy(*groups)
        .agg(
            F.max("_band").alias("_edge"),
            F.max_by(F.lit(wanted) - (F.col("_upto") - F.col("_n")), "_band").alias("_left"),
        )
    )
    placed = settled(
        hashed.alias("r")
        .join(edges.alias("e"), _same("r", "e", groups))
        .where(F.col("_band") <= F.col("_edge"))
        .select(*(f"r.{c}" for c in columns), "_hash", "_band", "_edge", "_left"),
        "sampled",
    )
    below = placed.where(F.col("_band") < F.col("_edge")).select(*columns)
    order = Window.partitionBy(*groups).orderBy("_hash", *(c for c in columns if c not in groups))
    critical = (
        placed.where(F.col("_band") == F.col("_edge"))
        .groupBy(*columns, "_hash", "_left")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_take", F.least("_n", F.col("_left") - (F.col("_upto") - F.col("_n"))))
        .where(F.col("_take") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_take"))))
        .select(*columns)
    )
    return below.unionByName(critical)


def running_max_before(
    df: DataFrame, value: str, arrival: str, tie: str, out: str, chunk: int = 1 << 18
) -> DataFrame:
    """Largest `value` among all rows that arrived earlier, over one global arrival order (missing arrivals first).

    Two-pass prefix maximum. A range sort puts the rows in order, and chunks are cut by their measured number of rows
    within the sorted parts: however sparse or repeated the arrival numbers are, a chunk has at most `chunk` rows (a
    power of two). Each chunk is scanned on its own, and only the chunks' maxima are scanned globally.
    """
    # The row number spreads rows that agree in arrival and tie over several parts.
    order = [F.col(arrival).asc_nulls_first(), F.col(tie).asc_nulls_first(), "_spread"]
    spread = df.withColumn("_spread", F.monotonically_increasing_id()).repartitionByRange(*order)
    placed = spread.sortWithinPartitions(*order).drop("_spread").withColumn("_row", F.monotonically_increasing_id())
    chunked = settled(placed.withColumn("_chunk", F.floor(F.col("_row") / chunk)), "arrivals")
    ahead = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        chunked.groupBy("_chunk")
        .agg(F.max(value).alias("_max"))
        .select("_chunk", F.max("_max").over(ahead).alias("_carried"))
    )
    inside = Window.partitionBy("_chunk").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunked.join(carried, "_chunk")
        .withColumn(out, F.greatest(F.max(value).over(inside), F.col("_carried")))
        .drop("_row", "_chunk", "_carried")
    )


def leave_group_out_median(
    df: DataFrame, value: str, group: str, within: Sequence[str] = (), out: str = "others_median"
) -> DataFrame:
    """Per (within, group): the median of `value` over all rows of `within` outside that group.

    Rows are ranked once; the wanted positions among the remaining rows are translated into ranks of the
    full order by stepping over the group's own ranks, and looked up by equality. No pairs are formed.
    """
    within = list(within)
    pool = within or [F.lit(0)]
    order = Window.partitionBy(*pool).orderBy(value, group)
    ranked = df.where(F.col(value).isNotNull()).select(
        *within,
        group,
        F.col(value).alias("_v"),
        (F.row_number().over(order) - 1).alias("_rank"),
        F.count(F.lit(1)).over(Window.partitionBy(*pool)).alias("_all"),
    )

    def rank_of(position: str) -> str:
        return f"{position} + aggregate(_own, 0, (t, r) -> if(r <= {position} + t, t + 1, t))"

    wanted = (
        ranked.groupBy(*within, group)
        .agg(F.sort_array(F.collect_list("_rank")).alias("_own"), F.max("_all").alias("_all"))
        .withColumn("_rest", (F.col("_all") - F.size("_own")).cast("int"))
        .where(F.col("_rest") > 0)
        .withColumn("_lo", F.expr("cast((_rest - 1) div 2 as int)"))
        .withColumn("_hi", F.expr("cast(_rest div 2 as int)"))
        .withColumn(
            "_rank", F.explode(F.array(F.expr(rank_of("_lo")), F.expr(rank_of("_hi"))))
        )
        .select(*within, group, "_rank")
    )
    values = ranked.select(*within, "_rank", "_v")
    return wanted.join(values, [*within, "_rank"]).groupBy(*within, group).agg(
        (F.sum(F.col("_v").cast("double")) / 2).alias(out)
    )
