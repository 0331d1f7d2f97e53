"""Channels asked in order: each for all it may carry, then once more for what no channel has given yet."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Channel(NamedTuple):
    """A source of statements: its name, the fields it may carry, and what answers: (target, field, again) to items (target, field, ...)."""

    name: str
    fields: tuple[str, ...]
    ask: Callable[[DataFrame], DataFrame]


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the session's checkpoint folder, which all executors share; a local session without one gets a temporary folder, a cluster an error. It goes when the driver's JVM ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cardloom-")
        spark.sparkContext.setCheckpointDir(root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def _finished(spark: SparkSession, path: str) -> bool:
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def stage(spark: SparkSession, make: Callable[[], DataFrame], path: str) -> DataFrame:
    """The table at path; what `make` gives is written there first, unless a whole table stands there already. An unfinished one is written anew."""
    if not _finished(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fill_gaps(asked: DataFrame, channels: Iterable[Channel], covers: Column, folder: str) -> DataFrame:
    """All items of the channels for asked(target, field), with `channel` and `again`.

    In order, each channel is asked for all its fields, and then, where it gave a target anything, once more for those of its fields that no item so far covers.
    `covers` says of an item whether it covers its field; null is no. Every answer is written under `folder` before it is read,
    so a later channel sees what was answered, no answer is asked for twice, and a run that stopped goes on with the same folder. Repeated and null questions are dropped; channels must have different names and give the same columns.
    """
    spark = asked.sparkSession
    questions = stage(spark, lambda: asked.select("target", "field").where("target is not null and field is not null").distinct(), f"{folder}/asked")
    items: list[DataFrame] = []
    covered: list[DataFrame] = []

    def answers(channel: Channel, open_: DataFrame, again: bool) -> DataFrame:
        ask = lambda: channel.ask(open_.withColumn("again", F.lit(again))).withColumns({"channel": F.lit(channel.name), "again": F.lit(again)})
        given = stage(spark, ask, f"{folder}/{channel.name}-{'again' if again else 'first'}")
        items.append(given)
        covered.append(given.where(F.coalesce(covers, F.lit(False))).select("target", "field"))
        return given

    for channel in channels:
        mine = questions.where(F.col("field").isin(*channel.fields))
        productive = answers(channel, mine, False).select("target").distinct()
        known = reduce(DataFrame.unionByName, covered).distinct()
        answers(channel, mine.join(productive, "target", "left_semi").join(known, ["target", "field"], "left_anti"), True)
    return reduce(DataFrame.unionByName, items)
