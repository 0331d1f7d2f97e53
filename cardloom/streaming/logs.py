"""The append-only logs as streams: running spend with a stop, and the latest event of each key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spend_by_window(usage: DataFrame, at: str = "ts", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Calls and cost of each run and time window; rows later than the watermark are left out, so state stays bounded."""
    out = usage.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), "run").agg(F.count("*").alias("calls"), F.sum("cost").alias("cost"))
    return out.select(F.col("w.start").alias("start"), "run", "calls", F.round("cost", 6).alias("cost"))


def latest_events(events: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """The last event of each key so far; one struct a key is all the state."""
    return events.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(at, *columns)).alias("e")).select(key, "e.*")


def stop_above(cap: float, stop: Callable[[str, float], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function over complete totals(run, cost) that calls stop once for each run whose cost is above the cap."""
    stopped: set[str] = set()

    def batch(totals: DataFrame, _: int) -> None:
        for r in totals.where(F.col("cost") > cap).select("run", "cost").collect():  # a row for each run over the cap
            if r.run not in stopped:
                stopped.add(r.run)
                stop(r.run, r.cost)

    return batch
