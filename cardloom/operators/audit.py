"""Audit sweeps: independent predicates over a table, counted by class with a few examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sweep(rows: DataFrame, key: Column, checks: dict[str, Column], examples: int = 5) -> DataFrame:
    """(kind, n, examples): how many rows break each check, and the smallest keys of those, joined by commas. One scan for all checks."""
    kinds = F.array_compact(F.array(*[F.when(bad, F.lit(k)) for k, bad in checks.items()]))
    found = rows.select(key.cast("string").alias("key"), key.alias("_order"), F.explode(kinds).alias("kind"))
    counts = found.groupBy("kind").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("_order"))
    first = found.withColumn("r", rank).where(F.col("r") <= examples).groupBy("kind").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "key"))), lambda x: x["key"]), ",").alias("examples"))
    return counts.join(first, "kind")
