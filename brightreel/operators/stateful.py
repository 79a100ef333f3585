"""Operators over logs: streaks, waits, budgets, provenance, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def streaks(log: DataFrame, key: str, order: list[str], failed: Column) -> DataFrame:
    """Adds ``streak``, the number of failures since the last success of the key."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    island = log.withColumn("_f", F.coalesce(failed, F.lit(False))).withColumn("_island", F.count_if(~F.col("_f")).over(w))
    inner = Window.partitionBy(key, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return island.withColumn("streak", F.count_if(F.col("_f")).over(inner)).drop("_f", "_island")


def waits(log: DataFrame, key: str, order: list[str], at_us: str, blocked: Column, spacing_us: int, cooldown_us: int) -> DataFrame:
    """Adds ``wait_us``, what was left of spacing and cooldown when a request began."""
    w = Window.partitionBy(key).orderBy(*order)
    last = F.lag(at_us).over(w)
    block = F.last(F.when(blocked, F.col(at_us)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    left = lambda since, most: F.coalesce(F.lit(most) - (F.col(at_us) - since), F.lit(0))
    return log.withColumn("wait_us", F.greatest(F.lit(0).cast("bigint"), left(last, spacing_us), left(block, cooldown_us)))


def within_budget(log: DataFrame, key: str, order: list[str], cost: str, budget: int) -> DataFrame:
    """Rows begun while the key's total so far was below the budget."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return log.withColumn("_spent", F.coalesce(F.sum(cost).over(w), F.lit(0))).where(F.col("_spent") < budget).drop("_spent")


def stable_from(log: DataFrame, key: str, order: list[str], value: str, at_us: str, samples: int, least_us: int) -> DataFrame:
    """Per key the first row where ``samples`` equal values in a row and ``least_us`` since the first have come."""
    w = Window.partitionBy(key).orderBy(*order)
    same = F.lit(True)
    for k in range(1, samples):
        same = same & F.coalesce(F.lag(value, k).over(w) == F.col(value), F.lit(False))
    age = F.col(at_us) - F.min(at_us).over(Window.partitionBy(key))
    hit = log.withColumn("_ok", same & (age >= least_us)).where("_ok").drop("_ok")
    return hit.groupBy(key).agg(F.min_by(F.struct(*hit.columns), F.struct(*order)).alias("r")).select("r.*")


def provenance(wanted: DataFrame, keys: list[str], live: DataFrame, third: DataFrame, cached: DataFrame) -> DataFrame:
    """Live over third-party over cached; keys nobody wants are dropped; each side is (keys, fetched_on)."""
    out = wanted
    for name, side in (("live", live), ("third", third), ("cached", cached)):
        out = out.join(side.groupBy(*keys).agg(F.max("fetched_on").alias(name)), keys, "left")
    source = F.when(F.col("live").isNotNull(), "live").when(F.col("third").isNotNull(), "third").when(F.col("cached").isNotNull(), "cached").otherwise("unknown")
    return out.select(*keys, F.coalesce("live", "third", "cached").alias("fetched_on"), source.alias("source"))


def circuit_opens(tries: DataFrame, key: str, order: list[str], grid: int, most: int = 8) -> DataFrame:
    """The failures of ``tries`` (failed, explicit, place, day) with ``opens``, for keys whose ``grid`` of combinations was tried whole.

    A success ends a streak; of a streak the last ``most`` failures count. The
    circuit opens if the last three are explicit, of three combinations, over
    two places and two days at least, or if four or more are over as many; not
    before every combination has been tried.
    """
    w = Window.partitionBy(key).orderBy(*order)
    s = tries.withColumn("seen", F.row_number().over(w)).withColumn("island", F.sum(F.when(F.col("failed"), 0).otherwise(1)).over(w))
    first = s.groupBy(key, "place", "day").agg(F.min("seen").alias("at"))
    probed = first.groupBy(key).agg(F.max("at").alias("full_at"), F.count(F.lit(1)).alias("n")).where(F.col("n") == grid).select(key, "full_at")
    last = F.collect_list(F.struct("place", "day", "explicit")).over(Window.partitionBy(key, "island").orderBy(*order).rowsBetween(1 - most, 0))
    f = s.where("failed").withColumn("w", last).withColumn("r", F.slice("w", F.greatest(F.lit(1), F.size("w") - 2), F.lit(3)))
    kinds = lambda a, x: F.size(F.array_distinct(F.transform(a, x)))
    wide = lambda a: (kinds(a, lambda x: x["place"]) >= 2) & (kinds(a, lambda x: x["day"]) >= 2)
    three = (F.size("r") == 3) & F.forall("r", lambda x: x["explicit"]) & (kinds("r", lambda x: F.struct(x["place"], x["day"])) == 3) & wide("r")
    return f.join(probed, key).withColumn("opens", (F.col("seen") >= F.col("full_at")) & (three | ((F.size("w") >= 4) & wide("w"))))
