"""The ledger of bindings: ids, review folds, projection, reconciliation and constraints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions import text as T


def latest(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last event of each key."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return events.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def history(events: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """The values of each key's events, in append order."""
    rows = F.sort_array(F.collect_list(F.struct(*order, value)))
    return events.groupBy(key).agg(F.array_join(F.transform(rows, lambda x: x[value].cast("string")), ">").alias("history"))


def effective(events: DataFrame, key: str, order: list[str], action: str, value: str, is_set: Column) -> DataFrame:
    """Each key's state after all its events: the last action, and the value of the last event that set one, an explicit null included."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    setter = F.last(F.when(is_set, F.struct(F.col(value).alias("v"))), ignorenulls=True).over(w)
    n = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in order]))
    rows = events.select(key, F.col(action).alias("action"), setter.alias("s"), n.alias("n"))
    return rows.where("n = 1").select(key, "action", F.col("s").isNotNull().alias("corrected"), F.col("s.v").alias("value"))


def chain_faults(events: DataFrame, key: str, event_id: str, supersedes: str, at: str, seq: str) -> DataFrame:
    """Events whose time runs back, whose supersedes is not the event before of that key, or whose id is used twice: (event_id, fault)."""
    order = Window.partitionBy(key).orderBy(seq)
    rows = events.select(
        F.col(event_id).alias("event_id"),
        (F.col(at) < F.lag(at).over(order)).alias("back"),
        (~F.col(supersedes).eqNullSafe(F.lag(event_id).over(order))).alias("broken"),
        (F.count("*").over(Window.partitionBy(event_id)) > 1).alias("twice"),
    )
    faults = F.array_compact(F.array(F.when(F.col("back"), F.lit("time_runs_back")), F.when(F.col("broken"), F.lit("supersedes_mismatch")), F.when(F.col("twice"), F.lit("event_id_repeated"))))
    return rows.select("event_id", F.explode(faults).alias("fault"))


def project(bindings: DataFrame) -> DataFrame:
    """Cards from bindings(target, field, idx, value, accepted): accepted values of each field by index, indexes closed up from 0."""
    kept = bindings.where("accepted")
    dense = F.row_number().over(Window.partitionBy("target", "field").orderBy("idx")) - 1
    rows = kept.withColumn("at", dense)
    values = F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"])
    return rows.groupBy("target", "field").agg(F.count("*").alias("n"), F.array_join(values, "|").alias("values"))


def conflicts(bindings: DataFrame, key: list[str], value: str) -> DataFrame:
    """Slots with more than one distinct value: the key, how many, and the smallest and largest."""
    return bindings.groupBy(*key).agg(F.countDistinct(value).alias("n_values"), F.min(value).alias("low"), F.max(value).alias("high")).where("n_values > 1")


def first_of(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, by order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def reconcile(scores: DataFrame) -> DataFrame:
    """For each scope of scores(scope, source, score as text): a single source keeps its distinct scores; several that agree in number keep one; else all are withheld."""
    value = T.score_value(F.col("score"))
    # one shuffle on the scope: distinct sources and scores of a scope are sets of its own size
    seen = scores.groupBy("scope", "source", "score").agg(F.count("*").alias("n")).withColumn("v", value)
    # numbers agree if all are numbers and the smallest is the largest; a score that is no number agrees with the same text only
    per = seen.groupBy("scope").agg((F.min("source") == F.max("source")).alias("single"), F.size(F.collect_set("source")).cast("long").alias("sources"), F.size(F.collect_set("score")).cast("long").alias("scores"), ((F.min("score") == F.max("score")) | ((F.count("v") == F.count("*")) & (F.min("v") == F.max("v")))).alias("agree"), F.min("score").alias("low"), F.max("score").alias("high"))
    status = F.when(F.col("single"), "single_source").when(F.col("agree"), "agreed").otherwise("score_conflict_between_sources")
    return per.select("scope", "sources", "scores", status.alias("status"), F.when(status != "score_conflict_between_sources", F.col("low")).alias("kept"), F.concat_ws("|", "low", "high").alias("span"))


def declaration_status(rows: DataFrame, key: str, value: str) -> DataFrame:
    """conflict, consistent or declared for each key's declared values, compared without case and blanks."""
    plain = F.lower(F.trim(value))
    out = rows.where(F.col(value).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"), F.countDistinct(plain).alias("values"))
    return out.withColumn("status", F.when(F.col("values") > 1, "conflict").when(F.col("rows") > 1, "consistent").otherwise("declared"))


def tiered_join(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """left(key) with right(key, value): exact matches first, without case only where there is none, else tier none. Never fuzzy."""
    r = right.select(F.col(key).alias("_k"), F.col(value))
    exact = left.join(r, F.col(key) == F.col("_k")).select(key, value, F.lit("exact").alias("tier"))
    rest = left.join(r, F.col(key) == F.col("_k"), "left_anti")
    lower = rest.join(r, F.lower(key) == F.lower("_k")).select(key, value, F.lit("case_insensitive").alias("tier"))
    none = rest.join(r, F.lower(key) == F.lower("_k"), "left_anti").select(key, F.lit(None).cast(dict(right.dtypes)[value]).alias(value), F.lit("none").alias("tier"))
    return exact.unionByName(lower).unionByName(none)


def replay(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """manifest(path, sha256, size) against files(path, content): ok, missing, unexpected, or a size or hash that differs."""
    seen = files.select("path", F.sha2(F.col("content").cast("binary"), 256).alias("got"), F.octet_length("content").cast("long").alias("bytes"))
    both = manifest.join(seen, "path", "full_outer")
    status = F.when(F.col("got").isNull(), "missing").when(F.col("sha256").isNull(), "unexpected").when(F.col("bytes") != F.col("size"), "size_differs").when(F.col("got") != F.col("sha256"), "hash_differs").otherwise("ok")
    return both.select("path", status.alias("status"))


def bundles(items: DataFrame, key: str, item_id: str, text: str) -> DataFrame:
    """(key, bundle_id, files): a digest over the lines `id:md5` of a key's texts in order of id; null texts and ids have no line.

    Rows come sorted and go into a running SHA-256, so no key's lines are gathered; one digest of all lines is one task's work.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, now, sha, files, lines = None, None, None, 0, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([f"bundle_{sha.hexdigest()[:32]}" if lines else None], pa.string()), pa.array([files], pa.int64())], [key, "bundle_id", "files"])

        for batch in batches:
            kind = batch.column("k").type
            for k, line in zip(batch.column("k").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if sha is None or k != now:
                    if sha is not None:
                        yield row()
                    now, sha, files, lines = k, hashlib.sha256(), 0, 0
                files += 1
                if line is not None:
                    sha.update((f"\n{line}" if lines else line).encode())
                    lines += 1
        if sha is not None:
            yield row()

    rows = items.select(F.col(key).alias("k"), F.col(item_id).alias("i"), F.md5(text).alias("h"))
    rows = rows.repartition("k").sortWithinPartitions("k", "i", "h").select("k", F.concat(F.col("i").cast("string"), F.lit(":"), "h").alias("line"))
    return rows.mapInArrow(digest, f"`{key}` {items.schema[key].dataType.simpleString()}, bundle_id string, files long")


def greedy_pack(items: DataFrame, key: str, order: list[str], size: str, cap: int, item_cap: int) -> DataFrame:
    """Which items fit a budget, in order: an item over item_cap or over what is left is skipped, and later smaller ones may still fit.

    Greedy skipping is no running sum, so it is a fold over each key's sizes: they come sorted, and only the running state is held.
    """
    fields = items.schema[key].dataType.simpleString()
    out = pa.schema([("used", pa.int64()), ("kept", pa.int64()), ("skipped", pa.int64())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, now, state = None, None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], kind), *(pa.array([x], f.type) for x, f in zip(state, out, strict=True))], [key, *out.names])

        for batch in batches:
            kind = batch.column("k").type
            for k, n in zip(batch.column("k").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if state is None or k != now:
                    if state is not None:
                        yield row()
                    now, state = k, [0, 0, 0]
                if n is None:
                    continue
                if n <= min(cap, item_cap) and state[0] + n <= cap:
                    state[0] += n
                    state[1] += 1
                else:
                    state[2] += 1
        if state is not None:
            yield row()

    rows = items.select(F.col(key).alias("k"), F.col(size).cast("long").alias("n"), F.struct(*order).alias("o"))
    return rows.repartition("k").sortWithinPartitions("k", "o", "n").select("k", "n").mapInArrow(fold, f"`{key}` {fields}, used long, kept long, skipped long")


def prefix_pack(items: DataFrame, key: str, order: list[str], text: str, room: int) -> DataFrame:
    """Texts of a key one after the other until the room is full: (key, order..., taken characters); the last is cut, the rest get 0."""
    before = F.coalesce(F.sum(F.char_length(text)).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = F.greatest(F.lit(0), F.least(F.char_length(text).cast("long"), room - before))
    return items.select(key, *order, taken.cast("long").alias("taken"))
