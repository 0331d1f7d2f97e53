"""Quotes, copied runs, leaks and links: joins between short values and the sources they must come from."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions import text as T


#: Quotes that are looked for beside one copy of a source's text, about.
QUOTES_AT_ONCE = 64


def verify_quotes(quotes: DataFrame, sources: DataFrame) -> DataFrame:
    """Exact containment of quotes(quote_id, quote) in sources(source_id, text) after normalizing: (quote_id, source_id, start, end, s).

    Offsets are those of the first hit in the normalized source, from 0, end exclusive. Not every quote is tried against every source: a hit
    holds each inner word of the quote as a word of its own, so the two meet on that inner word that the fewest sources hold, and a quote with an inner word of no source meets none; a quote of two words or fewer meets sources on its first
    three characters (or all, if fewer). Only ids and words go through that join; a source's text follows once for each QUOTES_AT_ONCE quotes that it met.
    """
    q = quotes.select("quote_id", T.normalized(F.col("quote")).alias("q")).where("q <> ''")
    inner = F.array_distinct(F.slice(F.split("q", " "), 2, F.greatest(F.size(F.split("q", " ")) - 2, F.lit(0))))
    s = sources.select("source_id", T.normalized(F.col("text")).alias("s"))
    asked = q.select("quote_id", F.size(inner).alias("n"), F.explode(inner).alias("seed"))
    held = s.select("source_id", F.explode(F.array_distinct(F.split("s", " "))).alias("seed"))
    df = held.groupBy("seed").agg(F.count("*").alias("df"))
    rarest = asked.join(df, "seed").groupBy("quote_id", "n").agg(F.min(F.struct("df", "seed")).alias("m"), F.count("*").alias("known"))
    seeds = rarest.where("known = n").select(F.col("m.seed").alias("seed"), "quote_id")
    met = [held.join(seeds, "seed").select("source_id", "quote_id")]
    short = q.where(F.size(inner) == 0).select("quote_id", F.left("q", F.lit(3)).alias("seed"))
    for n in sorted(r.n for r in short.select(F.length("seed").alias("n")).distinct().collect()):  # 1, 2 or 3, and mostly none
        rows = s.where(F.length("s") >= n).select("source_id", F.explode(F.array_distinct(_grams(F.col("s"), n))).alias("seed"))
        met.append(rows.join(short.where(F.length("seed") == n), "seed").select("source_id", "quote_id"))
    near = reduce(DataFrame.unionByName, met)
    chunks = near.groupBy("source_id").agg(F.ceil(F.count("*") / QUOTES_AT_ONCE).alias("chunks"))
    near = near.join(chunks, "source_id").join(q, "quote_id").withColumn("chunk", F.pmod(F.xxhash64("quote_id"), "chunks"))
    near = near.groupBy("source_id", "chunk").agg(F.collect_list(F.struct("quote_id", "q")).alias("qs")).join(s, "source_id")
    found = F.transform("qs", lambda x: F.struct(x["quote_id"].alias("quote_id"), (F.call_function("locate", x["q"], F.col("s")) - 1).cast("long").alias("start"), F.length(x["q"]).alias("n")))
    hit = near.select("source_id", "s", F.inline(F.filter(found, lambda x: x["start"] >= 0)))
    return hit.select("quote_id", "source_id", "start", (F.col("start") + F.col("n")).cast("long").alias("end"), "s")


def _grams(text: Column, n: int) -> Column:
    """All stretches of n characters of a text of n or more."""
    return F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))


def unverified(quotes: DataFrame, hits: DataFrame, limit: int = 12, head: int = 160) -> DataFrame:
    """The first quotes by id without any hit, with the head of their text; a report, so limited by design."""
    missed = quotes.join(hits, "quote_id", "left_anti")
    return missed.orderBy("quote_id").limit(limit).select("quote_id", F.substring("quote", 1, head).alias("head"))


def copied_runs(values: DataFrame, sources: DataFrame, n: int = 12, plain: bool = False) -> DataFrame:
    """The first run of n words that values(value_id, text) share with sources(source_id, text): (value_id, source_id, offset).

    The first by place in the value, then by source. Both sides meet on 128 bits of the run, taken from hashes of 128 bits of its words, so equal keys stand for equal runs and no text is read twice. Of all sources that hold a run only the
    least id goes on, map-side first, so a run of every source is one row. A value without such a run is tried by windows of 24 letters and digits, at least 12 of scripts that are written without spaces; its offset counts these signs.
    With `plain` words are the runs of a-z and 0-9 in lower case, any other sign parts them, and there are no compact windows.
    A null or short text holds no run; a null source_id is named by none.
    """
    run = ["kind", "h", "g"]
    least = _places(sources, "source_id", n, plain).groupBy(*run).agg(F.min("source_id").alias("source_id"))
    same = _places(values, "value_id", n, plain).join(least, run)
    first = same.groupBy("value_id").agg(F.min(F.struct("kind", "offset", "source_id")).alias("m"))
    return first.select("value_id", F.col("m.source_id").alias("source_id"), F.col("m.offset").cast("long").alias("offset"))


class _Digests(dict):
    """128 bits of each word met, kept for one batch."""

    def __missing__(self, word: str) -> bytes:
        self[word] = found = xxhash.xxh3_128_digest(word)
        return found


def _places(df: DataFrame, key: str, n: int, plain: bool) -> DataFrame:
    """(key, kind, offset, h, g): both halves of a hash of each run of n words (kind 0) and of each compact window (kind 1); Spark has no function for NFKC and case folding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                known, kinds, offsets, halves, ends = _Digests(), [], [], [], [0]
                for text in part.column("text").to_pylist():
                    w, c, at = (T.plain_words(text or ""), "", []) if plain else T.streams(text or "")
                    words = np.frombuffer(b"".join(map(known.__getitem__, w)), np.uint64).reshape(-1, 2)
                    windows = np.frombuffer(b"".join(xxhash.xxh3_128_digest(c[i : i + T.COMPACT_WINDOW]) for i in at), np.uint64).reshape(-1, 2)
                    runs = _run_hashes(words, n)
                    kinds += [np.zeros(len(runs), np.int32), np.ones(len(at), np.int32)]
                    offsets += [np.arange(len(runs), dtype=np.int32), np.array(at, np.int32)]
                    halves += [runs, windows]
                    ends.append(ends[-1] + len(runs) + len(at))
                both = np.concatenate(halves).view(np.int64)
                fields = [np.concatenate(kinds), np.concatenate(offsets), both[:, 0], both[:, 1]]
                places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(x) for x in fields], ["kind", "offset", "h", "g"]))
                yield pa.RecordBatch.from_arrays([part.column(key), places], [key, "places"])

    rows = df.select(key, "text").mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, places array<struct<kind:int,offset:int,h:long,g:long>>")
    return rows.select(key, F.inline("places"))


def _run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Both halves of a hash of each run of n words, put together from those of its words."""
    out = np.zeros((max(0, len(words) - n + 1), 2), np.uint64)
    for k in range(n if len(out) else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(out)]
    return out


def sensitive(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, kind) for each kind of sensitive text that a row holds."""
    kinds = F.array_compact(F.array(*[F.when(F.col(text_col).rlike(f"(?i){p}"), F.lit(k)) for k, p in T.SENSITIVE.items()]))
    return df.select(F.col(id_col).alias("id"), F.explode(kinds).alias("kind"))


def links(pages: DataFrame, skip_hosts: tuple[str, ...] = (), most: int = 3) -> DataFrame:
    """At most `most` distinct links of each page(page_id, html), in order: absolute or rooted, not of a skipped host, not to a binary file."""
    found = F.regexp_extract_all("html", F.lit(r'href="([^"]+)"'), 1)
    rows = pages.select("page_id", F.posexplode(found).alias("at", "href"))
    rows = rows.where(F.col("href").rlike("^(https?://|/)") & ~F.col("href").rlike(r"(?i)\.(png|jpe?g|gif|zip|exe|bin|css|js)$"))
    for host in skip_hosts:
        rows = rows.where(~F.col("href").contains(f"//{host}"))
    rows = rows.groupBy("page_id", "href").agg(F.min("at").alias("at"))
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy("at"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= most).select("page_id", "rank", "href")
