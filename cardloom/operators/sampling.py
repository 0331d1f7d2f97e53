"""Stratified draws with quotas, deterministic by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stratified(population: DataFrame, key: str, strata: list[str], size: int, seed: str) -> DataFrame:
    """About size rows: each stratum gets max(1, round(size * its share)), those with the smallest hash of seed and key; (key, strata..., draw).

    Counts are aggregated first and joined back, so no window spans the population; each stratum's draw is a limited rank.
    """
    counts = population.groupBy(*strata).agg(F.count("*").alias("n"))
    total = population.agg(F.count("*").alias("total"))
    quota = counts.join(F.broadcast(total)).withColumn("quota", F.greatest(F.lit(1), F.bround(size * F.col("n") / F.col("total")).cast("int")))
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")).cast("binary"))
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy("h", key))
    rows = population.select(key, *strata, h.alias("h")).withColumn("draw", rank).where(F.col("draw") <= size)
    return rows.join(quota.select(*strata, "quota"), strata).where("draw <= quota").select(key, *strata, "draw")


def pairs_first(population: DataFrame, key: str, stem: str, size: int, seed: str) -> DataFrame:
    """size rows, members of stems with two or more before single ones, by hash of the stem and then of the key."""
    stems = population.groupBy(stem).agg(F.count("*").alias("members"))
    h = lambda c: F.md5(F.concat(F.lit(f"{seed}|"), F.col(c).cast("string")).cast("binary"))
    rows = population.join(stems, stem).select(key, stem, "members", (F.col("members") < 2).alias("single"), h(stem).alias("hs"), h(key).alias("hk"))
    return rows.orderBy("single", "hs", "hk", key).limit(size).select(key, stem, "members")


def apportioned(cells: DataFrame, strata: list[str], size: int) -> DataFrame:
    """(strata..., n, quota) of cells(strata..., n): quotas that sum to size exactly, or to all there is if that is less.

    A cell asks for its rounded share of size, one at least, and gets what it has of that. Larger cells come first, ties by strata: where all ask for more than size, the last ones go without. What
    is still open is dealt one by one in that order to cells that have more, round after round: that is the same as raising all cells to a common level, which is found from their
    sorted room, so rounds need no loop. It works on one row for each stratum; those, not the population, pass through one task.
    """
    every = Window.partitionBy()
    order = Window.orderBy(F.desc("n"), *strata)
    share = F.greatest(F.lit(1), F.bround(F.lit(float(size)) * F.col("n") / F.sum("n").over(every)).cast("long"))
    rows = cells.where("n > 0").withColumn("_asked", F.least(share, "n")).withColumn("_before", F.sum("_asked").over(order) - F.col("_asked"))
    rows = rows.withColumn("_base", F.greatest(F.lit(0), F.least("_asked", F.lit(size) - F.col("_before")))).withColumn("_room", F.col("n") - F.col("_base"))
    rows = rows.withColumn("_open", F.least(F.lit(size), F.sum("n").over(every)) - F.sum("_base").over(every))
    # cells by room: with the k smallest full, the rest share what is left
    by_room = Window.orderBy("_room", F.desc("n"), *strata)
    full = F.coalesce(F.sum("_room").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = F.floor((F.col("_open") - full) / (F.count("*").over(every) - F.row_number().over(by_room) + 1))
    rows = rows.withColumn("_level", level).withColumn("_k", F.row_number().over(by_room))
    first = F.min(F.when(F.col("_level") < F.col("_room"), F.struct("_k", "_level"))).over(every)  # the first that doesn't fill up sets the level of all later ones
    rows = rows.withColumn("_common", first["_level"])
    raised = F.least("_room", F.coalesce("_common", "_room"))
    rows = rows.withColumn("_raised", raised).withColumn("_left", F.col("_open") - F.sum("_raised").over(every))
    more = F.col("_room") > F.col("_raised")
    turn = F.sum(more.cast("int")).over(order)
    return rows.select(*strata, "n", (F.col("_base") + F.col("_raised") + (more & (turn <= F.col("_left"))).cast("long")).alias("quota"))


def drawn(population: DataFrame, key: str, strata: list[str], size: int, seed: str) -> DataFrame:
    """size rows exactly, if there are as many: (key, strata..., draw), by the quotas of apportioned, in each stratum those with the smallest hash of seed and key.

    A stratum that is smaller than its share gives all it has, and others take over what it can't give. Null strata are strata; of repeated keys each row counts.
    """
    quota = apportioned(population.groupBy(*strata).agg(F.count("*").alias("n")), strata, size)
    quota = quota.select(*[F.col(c).alias(f"_{c}") for c in strata], "quota")
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")).cast("binary"))
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy("h", key))
    rows = population.select(key, *strata, h.alias("h")).withColumn("draw", rank).where(F.col("draw") <= size)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in strata]
    return rows.join(quota, same).where("draw <= quota").select(key, *strata, "draw")
