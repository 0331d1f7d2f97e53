"""What several operators share: shared-storage cuts, links to components, and byte arithmetic on Arrow text columns."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are the runs of anything but space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model learns from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder. Only a local session, whose executors are the driver, gets one of its own where it names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cardloom-checkpoint-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder in shared_dir, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    with contextlib.suppress(Exception):
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Has Spark remove the shuffle files of a written table as soon as it is written.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Writes df to shared storage and reads it back: lineage ends here, and a lost executor costs no recomputation.

    Both sides of a join that are read back are plain exchanges, so Spark deals a key with very many rows to several tasks.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def done_with(*tables: DataFrame) -> None:
    """Gives back the storage of tables that cut() wrote, once all that reads them has been written too."""
    for df in tables:
        remove(df.sparkSession, df._folder)


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """All columns of df as one struct `row`, and beside it those in `more`: whatever df's columns are called, they clash with none of these."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])


def unpacked(df: DataFrame, names: list[str], **instead: Column) -> DataFrame:
    """The columns of packed rows in order, some of them replaced; those of `instead` that the row lacks follow."""
    kept = [instead.get(n, F.col("row").getField(n)).alias(n) for n in names]
    return df.select(*kept, *[c.alias(n) for n, c in instead.items() if n not in names])


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as stars around the smallest id of each piece that they connect."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    stars = [(x, find(x)) for x in parent]
    stars = [s for s in stars if s[0] != s[1]]
    yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in stars], pa.int64()) for i in (0, 1)], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """Connected components of links(a, b), as a written table (id, component) with component the smallest id reachable.

    Each task first joins the links of its own partition by union-find. Then large-star and small-star steps alternate until no link
    changes; each round moves every link towards its component's smallest id, so long chains shrink by a constant factor a round. Ids that
    have no link are not in the result. A step is a minimum per id, written, and a join of the links with it; of an id with very many links
    the minimum is combined before the shuffle, and the join is dealt to several tasks, as both its sides are read from storage.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        n = e.select("a", "b")
        if large:
            n = n.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(n.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "lowest")
        met = n.join(low, "a")
        if large:
            out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        else:
            out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b")
        out = cut(out.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        done_with(e, low)
        return out

    e = links.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).where("a <> b")
    e = cut(e.mapInArrow(contracted, "a long, b long").distinct(), "links")
    before = None
    while True:
        after = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if after == before or not after[0]:
            break
        before = after
        e = star(star(e, True), False)
    rows = e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    out = cut(rows.unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()), "components")
    done_with(e)
    return out


def lowest(df: DataFrame, by: list[str], order: list[Column], n: int, salts: int = 64) -> DataFrame:
    """The first n rows of each group, in two levels: each of a group's `salts` shares is limited by itself first, so the task that ends a group reads at most n rows of each share."""
    share = F.pmod(F.xxhash64(*order), F.lit(salts))
    first = F.row_number().over(Window.partitionBy(*by, share).orderBy(*order))
    rows = df.withColumn("_rank", first).where(F.col("_rank") <= n).drop("_rank")
    last = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_rank", last).where(F.col("_rank") <= n).drop("_rank")


# ---- bytes of Arrow text columns ----

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        for k, x in (("p", base), ("q", pow(base, -1, 1 << 64))):
            out = np.full(max(n, 1 << 20), x, np.uint64)
            out[0] = 1
            _POWERS[k] = np.cumprod(out, dtype=np.uint64)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the finalizer of SplitMix64)."""
    x = x + np.uint64((salt * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each pair, from one prefix sum modulo 2**64."""
    n = len(values)
    p, _ = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * p[:n], out=total[1:])
    # scaled up to the last position instead of down to the first: no inverse powers needed
    return (total[ends] - total[starts]) * _shift(starts)


def _shift(starts: np.ndarray) -> np.ndarray:
    _, q = powers(int(starts.max(initial=0)) + 1)
    return q[starts]


def text_slices(column: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row count, bytes, offsets) of runs of rows of about limit bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end - row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row boundary the number of words before it."""
    solid = ~_BLANK[data]
    inner = offsets[1:-1]
    cut_at = inner[(inner > 0) & (inner < len(data))]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    before[cut_at] = False
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    after[cut_at - 1] = False
    starts = np.flatnonzero(solid & ~before)
    return starts, np.flatnonzero(solid & ~after) + 1, np.searchsorted(starts, offsets)


_WORD_TABLE = 1024


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece: int = 1 << 16) -> np.ndarray:
    """A 64-bit hash of each word; works through the bytes a piece at a time, so memory stays bounded.

    Each byte at each place of a word adds a random number of its own, so no arithmetic pattern of bytes cancels out.
    """
    if "words" not in _POWERS:
        _POWERS["words"] = np.random.default_rng(20).integers(0, 1 << 64, _WORD_TABLE * 256, np.uint64, endpoint=False)
    numbers = _POWERS["words"]
    length = ends - starts
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + piece, "right")))
        n = length[i:j]
        before = np.cumsum(n) - n
        at = np.arange(int(n.sum())) - np.repeat(before, n)
        found = numbers[(at & (_WORD_TABLE - 1)) << 8 | data[at + np.repeat(starts[i:j], n)]]
        if n.max() > _WORD_TABLE:
            found *= mix((at // _WORD_TABLE).astype(np.uint64), 5) | np.uint64(1)
        out[i:j] = np.add.reduceat(found, before)
        i = j
    return mix(out ^ length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def run_hashes(h: np.ndarray, width: int, salt: int) -> np.ndarray:
    """A hash of each `width` consecutive values: two runs side by side are mixed into one of twice the width, which overlap in the last step where width is no power of two."""
    g, have = mix(h, salt), 1
    while have < width:
        step = min(have, width - have)
        g = mix(g[:-step] * np.uint64(0xD6E8FEB86659FD93) + g[step:], have)
        have += step
    return g
