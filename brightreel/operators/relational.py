"""Operators on tables: dedupe, ranked merge, matching joins, as-of joins, ranking.

Each works on any table; ties are always broken by the sequence column given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightreel.session import cut


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; null keys are keys as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def ranked_merge(df: DataFrame, key: str, rank: str, seq: str, best: list[str], first_known: list[str], any_true: list[str], joined: list[str]) -> DataFrame:
    """A10: one row per ``key``. ``best`` columns come from the highest rank, then the latest row;
    ``first_known`` from the first row that has a value; ``any_true`` is an OR with null as false;
    ``joined`` is the distinct union, in order of arrival, of parts separated by semicolons.
    Only aggregates that combine on the map side are used, so a hot key is merged before the shuffle.
    """
    aggs = [F.max_by(c, F.struct(rank, seq)).alias(c) for c in best]
    aggs += [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in first_known]
    aggs += [F.bool_or(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in any_true]
    out = df.groupBy(key).agg(*aggs, F.count(F.lit(1)).alias("n_rows"))
    for c in joined:
        # First each part by its first place, so that a key carries its different parts, not its rows.
        each = df.where(F.col(c).isNotNull()).select(key, F.col(seq).alias("_s"), F.posexplode(F.split(c, ";")).alias("_i", "_p"))
        parts = each.groupBy(key, F.trim("_p").alias("_p")).agg(F.min(F.struct("_s", "_i")).alias("_at"))
        union = parts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_p"))), lambda x: x["_p"]), "; ").alias(c))
        out = out.join(union, key, "left").withColumn(c, F.coalesce(c, F.lit("")))
    return out


def first_known(value: str, seq: str) -> Column:
    """A3: the first known value in order of ``seq``."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(seq)))


def probe_variants(variants: DataFrame, catalogue: DataFrame, variant: str, names: list[str]) -> DataFrame:
    """Catalogue rows that match on any of ``names``: equi-joins united, never an OR join."""
    out = None
    for n in names:
        hit = variants.join(catalogue, F.col(variant) == F.col(n))
        out = hit if out is None else out.unionByName(hit)
    return out.distinct()


def unambiguous(candidates: DataFrame, key: str, tier: str, member: str) -> DataFrame:
    """The only candidate of the best tier that has any; none where that tier has several."""
    per = candidates.groupBy(key, tier).agg(F.countDistinct(member).alias("n"), F.min(member).alias(member))
    return per.groupBy(key).agg(F.min_by(F.struct("n", member, tier), tier).alias("b")).where("b.n = 1").select(key, f"b.{member}", f"b.{tier}")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, right_at: str, value: str, within: Column | None = None) -> DataFrame:
    """For each left row the last right row of the key at or before it: one sort of both sides, no range join."""
    a = left.select("*", F.col(at).alias("_at"), F.lit(1).alias("_side"))
    b = right.select(key, F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.struct(F.col(right_at).alias("at"), F.col(value).alias("v")).alias("_hit"))
    w = Window.partitionBy(key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_hit", F.last("_hit", ignorenulls=True).over(w)).where("_side = 1")
    if within is not None:
        both = both.withColumn("_hit", F.when(within, F.col("_hit")))
    return both.withColumn("prev_at", F.col("_hit.at")).withColumn("prev_value", F.col("_hit.v")).drop("_at", "_side", "_hit")


def global_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Consecutive numbers over all rows in ``order``, without one task for all.

    Rows are split by ranges, numbered within their part, and offset by the
    counts of the parts before, of which there are as many as shuffle partitions.
    """
    parts = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    local = parts.withColumn("_rn", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return local.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.col("_rn")).cast("bigint")).drop("_part", "_before", "_rn")
