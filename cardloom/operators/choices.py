"""Choices among candidates: first of a key, by authority, by hits, within a cap or a budget; and lookups with a default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_authority(candidates: DataFrame, key: list[str], authority: Column, order: Column) -> DataFrame:
    """One candidate for each key: that of the highest authority (smallest number), the first by order among these."""
    w = Window.partitionBy(*key).orderBy(authority, order)
    return candidates.withColumn("place_", F.row_number().over(w)).where("place_ = 1").drop("place_")


def by_hits(candidates: DataFrame, group: str, name: str, tokens: list[str]) -> DataFrame:
    """candidates(group, name) without repeats in another case, ranked by how many tokens their name holds, then by its length and itself: (group, name, hits, rank)."""
    first = candidates.groupBy(group, F.lower(name).alias("low")).agg(F.min(name).alias(name))
    hits = F.size(F.filter(F.array(*[F.lit(t) for t in tokens]), lambda t: F.col("low").contains(t)))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("hits"), F.length(name), name))
    return first.withColumn("hits", hits).withColumn("rank", rank).select(group, name, "hits", "rank")


def lookup(rows: DataFrame, index: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """rows with the value that index(key, value) has for their key, else the default."""
    one = index.groupBy(key).agg(F.min(value).alias("value_"))
    return rows.join(one, key, "left").withColumn(value, F.coalesce("value_", F.lit(default))).drop("value_")


def pointers(lists: DataFrame, key: str, items: str, prefix: str) -> DataFrame:
    """(key, id, pointer) of each item of an array of ids: where it stands, as a JSON pointer."""
    rows = lists.select(key, F.posexplode(items).alias("at", "id"))
    return rows.select(key, "id", F.concat(F.lit(prefix), F.col("at").cast("string")).alias("pointer"))


def selected(chosen: DataFrame, candidates: DataFrame, key: str, item: str, order: str, most: int) -> DataFrame:
    """(key, kept, invalid): the first `most` distinct items of chosen(key, item, order) that candidates(key, item) has, and how many named none or one that was there before."""
    known = candidates.select(key, item).distinct().withColumn("known", F.lit(True))
    rows = chosen.join(known, [key, item], "left")
    first = F.row_number().over(Window.partitionBy(key, item).orderBy(order)) == 1
    rows = rows.withColumn("good", F.col("known").isNotNull() & first)
    before = F.sum(F.col("good").cast("int")).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    read = rows.withColumn("read", F.coalesce(before, F.lit(0)) < most).where("read")  # what follows a full list isn't read
    return read.groupBy(key).agg(F.count_if("good").alias("kept"), F.count_if(~F.col("good")).alias("invalid"))


def excerpts(sections: DataFrame, key: str, text: str, at: str, tokens: Column, each: int, room: int) -> DataFrame:
    """(key, at, hits, taken): sections by how many query tokens they hold, then in order; each gives at most `each` characters until `room` is full, those without a token none."""
    hits = F.size(F.filter(tokens, lambda t: F.lower(F.col(text)).contains(t)))
    rows = sections.withColumn("hits", hits).where("hits > 0").withColumn("n", F.least(F.char_length(text), F.lit(each)))
    w = Window.partitionBy(key).orderBy(F.desc("hits"), at).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.greatest(F.lit(0), F.least(F.col("n"), room - F.coalesce(F.sum("n").over(w), F.lit(0))))
    return rows.select(key, at, "hits", taken.cast("long").alias("taken")).where("taken > 0")


def not_done(targets: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """The targets without a result by the same instrument: what a resumed run still has to do."""
    return targets.join(results.select(*keys).distinct(), keys, "left_anti")


def occurrence(text: Column, part: Column, n: int) -> Column:
    """Where the n-th occurrence of a part begins, from 0; null if there are fewer."""
    at = F.lit(0)
    for _ in range(n):
        at = F.when(at.isNotNull(), F.nullif(F.call_function("locate", part, text, at + 1), F.lit(0)))
    return at - 1
