"""SimHash near-dedup: 64-bit fingerprints linked by a byte-position inverted index with count filtering.

Two fingerprints at most two bits apart differ in at most two of their eight bytes, so they share at least six positional bytes. A posting list of one
positional byte would hold a 256th of all fingerprints, and its pairs would grow with the square of the table. So the index has its lists for four positional
bytes at a time: the 14 quadruples of positions whose numbers have an exclusive or of zero. Any three positions stand together in exactly one of these, from which follows how many
lists a pair meets in: 14 with no byte different, 7 with one, 3 with two, 1 with three, 1 or none with more. The lists in which a pair meets are tallied, and 3 is the guaranteed
minimum: a pair has it exactly if it shares six positional bytes. Pairs below go, the rest are verified bit by bit.

Equal fingerprints are one entry of the index. A list longer than `longest_list` forms no pairs: each of its fingerprints is posted
under itself and its 64 one-bit neighbours instead. Two fingerprints meet there exactly if they are at most two bits apart, at most
65 can meet in one place, and all that meet are linked to the smallest, which gives the same components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import components, cut, done_with, packed, table, unpacked

SHINGLE = 3
LONGEST_LIST = 64
#: The positions of each posting list's bytes, and the lists that fingerprints with six bytes in common share at least.
QUADRUPLES = [q for q in combinations(range(8), 4) if q[0] ^ q[1] ^ q[2] ^ q[3] == 0]
LEAST_LISTS = 3
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text: a bit is set if it is set in over half of the shingles' hashes."""
    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.r_[0, ends[: n - 1] + 1].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(text[a:b], 42) for a, b in zip(starts, ends[-n:].tolist(), strict=True)], "<u8")
    counts = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little", signed=True)


def with_fingerprint(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, version, fp) of each row; version is a hash of the text, fp the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").cast(pa.binary())
            found = [fingerprint(x.as_py() or b"", shingle) for x in text]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), pa.array(found, pa.int64())], ["doc_id", "version", "fp"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.xxhash64("text"), F.lit(0).cast("long")).alias("version"), "text")
    return docs.mapInArrow(run, "doc_id long, version long, fp long")


def postings(fps: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint in its 14 lists; a key is the list's number and the four bytes at its positions."""
    byte = [F.shiftrightunsigned("fp", 8 * k).bitwiseAND(0xFF) for k in range(8)]
    keys = [sum((byte[p] * (1 << 8 * k) for k, p in enumerate(q)), F.lit(n << 32).cast("long")) for n, q in enumerate(QUADRUPLES)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def tallied_pairs(short: DataFrame) -> DataFrame:
    """(a, b, lists): the pairs of fingerprints that meet in some of short(key, fp), and in how many lists they do."""
    met = short.toDF("key", "a").join(short.toDF("key", "b"), "key").where("a < b")
    return met.groupBy("a", "b").agg(F.count("*").alias("lists"))


def fingerprint_links(fps: DataFrame, longest_list: int = LONGEST_LIST) -> DataFrame:
    """links(a, b) between distinct fingerprints at most two bits apart, enough of them to connect all that are linked."""
    posted = postings(fps)
    sizes = cut(posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    posted = cut(posted.join(sizes, "key"), "postings")
    done_with(sizes)
    pairs = tallied_pairs(posted.where(F.col("n") <= longest_list).select("key", "fp")).where(F.col("lists") >= LEAST_LISTS)
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).select("a", "b")
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << k) - (1 << 64 if k == 63 else 0))) for k in range(64)])
    long = posted.where(F.col("n") > longest_list).select("fp").distinct()
    met = long.select("fp", F.explode(flips).alias("near")).groupBy("near").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    stars = met.select(F.explode("all").alias("a"), F.array_min("all").alias("b")).where("a <> b")
    links = cut(pairs.unionByName(stars).distinct(), "links")
    done_with(posted)
    return links


def simhash_components(documents: DataFrame, shingle: int = SHINGLE, longest_list: int = LONGEST_LIST) -> DataFrame:
    """(doc_id, version, fp, component_id, stays) of each row of documents.

    component_id is the smallest doc_id a row is linked with, and stays marks that document. Null, empty and blank texts have fingerprint zero and are
    linked like any other; texts with fewer words than a shingle hash the whole sequence, long ones are hashed whole. Repeated rows share all of this. Null ids come
    last: they name no component and stay in none that has another id. A table without rows gives none. Columns beside doc_id and text aren't read.
    """
    docs = cut(with_fingerprint(documents, shingle), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")
    fps = cut(docs.groupBy("fp").agg(F.min(first).alias("low")), "distinct")
    links = fingerprint_links(fps, longest_list)
    found = components(links)
    done_with(links)
    linked = cut(fps.join(found, fps.fp == found.id).select("fp", "low", "component"), "linked")
    low = cut(linked.groupBy("component").agg(F.min("low").alias("lowest")), "lowest")
    named = linked.join(low, "component").select("fp", "lowest")
    # written, so that the documents of one fingerprint can be dealt to several tasks
    named = cut(fps.join(named, "fp", "left").select("fp", F.coalesce("lowest", "low").alias("low")), "named")
    done_with(fps, found, linked, low)
    stays = F.col("doc_id").eqNullSafe(F.col("low.doc_id")) & (F.col("version") == F.col("low.version"))
    return docs.join(named, "fp").select("doc_id", "version", "fp", F.col("low.doc_id").alias("component_id"), stays.alias("stays"))


def near_dedup(documents: DataFrame, shingle: int = SHINGLE, longest_list: int = LONGEST_LIST) -> DataFrame:
    """documents with one document of each component, the one with the smallest doc_id; of rows that repeat doc_id and text one stays. Columns keep their names, whatever these are."""
    stay = simhash_components(documents, shingle, longest_list).where("stays").select(F.col("doc_id").alias("of_doc"), F.col("version").alias("of")).distinct()
    docs = packed(documents, doc_id=F.col("doc_id").cast("long"), version=F.coalesce(F.xxhash64("text"), F.lit(0).cast("long")))
    kept = docs.join(stay, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("version") == F.col("of")), "left_semi")
    return unpacked(kept.dropDuplicates(["doc_id", "version"]), documents.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and component of every document; edge cases as in simhash_components."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
