"""Substring dedup by a Relative Lempel-Ziv parse against an index of all documents' blocks.

Every document's word stream is cut into blocks at content-defined places: consecutive windows of `window` words that have the same smallest `seed`-word hash (their anchor) make one block. Equal
passages cut alike, whichever documents they stand in, so each distinct (anchor, content) with the first place that holds it, by doc_id, is a reference block, and
the index holds them all. A document is parsed against it:

* a block whose content an earlier document holds is copied from there as a whole;
* a block whose anchor is known with other content lies at a factor's boundary; there the single windows are looked up among the windows of all known contents of that anchor;
* a block with an anchor of its own can be part of no factor of `window` words and stays literal.

No window can be missed: equal windows have equal anchors. Each distinct content is looked into once, in the first document that holds it, so copies cost one row each,
and no pairs of documents arise. From left to right a document's matches are then joined greedily: a match that continues the factor before it, in the same
source at the same distance, extends it; so factors (place, length, source, place there) run on over blocks and boundaries as far as the source goes along. The words of each factor
are compared with its source's by a cryptographic digest of both, and only factors that stand this test become duplicate spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import cut, done_with, mix, run_hashes, runs_hash, table, text_slices, word_bounds, word_hashes

WINDOW = 50
SEED = 8


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive values."""
    m, have = x, 1
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def _blocks(h: np.ndarray, word_from: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """(row, anchor, content, first window, number of windows) of each block of a slice's rows."""
    if len(h) < window:
        return (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    anchors = _sliding_min(run_hashes(h, seed, 1), window - seed + 1)
    row = np.repeat(np.arange(len(word_from) - 1), np.diff(word_from))[: len(anchors)]
    at = np.flatnonzero(np.arange(len(anchors)) + window <= word_from[row + 1])
    if not len(at):
        return _blocks(h[:0], word_from, window, seed)
    row, anchors = row[at], anchors[at]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (anchors[1:] != anchors[:-1])])
    n = np.diff(np.r_[first, len(at)])
    content = mix(runs_hash(run_hashes(h, window, 3), at[first], at[first] + n), 2) ^ n.astype(np.uint64)
    return row[first], anchors[first], content, at[first] - word_from[row[first]], n


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def reference_blocks(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """All blocks of every document: (doc_id, version, anchor, content, first, n), windows counted from 0."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column("doc_id"), batch.column("version")
            for start, _, data, offsets in text_slices(batch.column("text")):
                s, e, word_from = word_bounds(data, offsets)
                row, anchor, content, first, n = _blocks(word_hashes(data, s, e), word_from, window, seed)
                take = pa.array(row + start)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), versions.take(take), _signed(anchor), _signed(content), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["doc_id", "version", "anchor", "content", "first", "n"],
                )

    return docs.mapInArrow(parse, "doc_id long, version long, anchor long, content long, first int, n int")


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of lists one after the other, and where each list begins and ends; a null list is empty."""
    return lists.flatten(), np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]


def _boundary_windows(docs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """(anchor, hash, doc_id, version, at) of every single window of the given blocks."""
    grouped = places.groupBy("doc_id", "version").agg(F.collect_list(F.struct("anchor", "first", "n")).alias("blocks"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, list_from = _flat(batch.column("blocks"))
            anchor, first, n = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            ids, versions = batch.column("doc_id"), batch.column("version")
            for start, rows, data, offsets in text_slices(batch.column("text")):
                s, e, word_from = word_bounds(data, offsets)
                h = run_hashes(word_hashes(data, s, e), window, 3)
                mine = slice(list_from[start], list_from[start + rows])
                a, f, m = anchor[mine], first[mine].astype(np.int64), n[mine].astype(np.int64)
                row = np.repeat(np.arange(rows), np.diff(list_from[start : start + rows + 1]))
                each = np.repeat(np.arange(len(a)), m)
                at = f[each] + np.arange(len(each)) - np.repeat(np.cumsum(m) - m, m)
                take = pa.array(row[each] + start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[each]), _signed(h[at + word_from[row[each]]]), ids.take(take), versions.take(take), pa.array(at.astype(np.int32))],
                    ["anchor", "hash", "doc_id", "version", "at"],
                )

    return docs.join(grouped, ["doc_id", "version"]).mapInArrow(windows, "anchor long, hash long, doc_id long, version long, at int")


_FACTOR = "doc_id long, version long, at int, length int, of_doc long, of_version long, of_at int"


def _joined(matches: DataFrame) -> DataFrame:
    """Matches as factors: those that continue each other in one source are one. Rows come sorted, and only the open factor is held."""

    names = [x.split()[0] for x in _FACTOR.split(", ")]

    def rows(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * len(names)
        for batch in batches:
            doc, version, at, length, of_doc, of_version, of_at = now = [np.r_[h, batch.column(c).to_numpy()] for h, c in zip(held, names, strict=True)]
            if not len(doc):
                continue
            goes_on = at[1:] <= at[:-1] + length[:-1]
            for x in (doc, version, of_doc, of_version, of_at - at):
                goes_on &= x[1:] == x[:-1]
            begins = np.flatnonzero(np.r_[True, ~goes_on])
            now = [x[begins] for x in now]
            now[3] = np.maximum.reduceat(at + length, begins) - now[2]
            held = [x[-1:] for x in now]
            yield rows([x[:-1] for x in now])
        yield rows(held)

    return matches.repartition("doc_id", "version").sortWithinPartitions("doc_id", "version", "at").mapInArrow(parse, _FACTOR)


_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]


def _words_at(raw: bytes) -> tuple[bytes, np.ndarray]:
    """The words of a text joined by single spaces, and where each begins there; the last place is one past the end."""
    words = raw.split()
    return b" ".join(words), np.r_[0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]


def _digest(joined: bytes, begins: np.ndarray, at: int, length: int) -> bytes:
    return hashlib.blake2b(joined[begins[at] : begins[at + length] - 1], digest_size=16).digest()


def _source_digests(docs: DataFrame, factors: DataFrame) -> DataFrame:
    """(of_doc, of_version, of_at, length, digest) of the words that factors copy; each distinct stretch of a source once."""
    asked = factors.select("of_doc", "of_version", "of_at", "length").distinct()
    asked = asked.groupBy("of_doc", "of_version").agg(F.collect_list(F.struct("of_at", "length")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, version, text, asked in zip(*(batch.column(c) for c in ("doc_id", "version", "text", "asked")), strict=True):
                joined, begins = _words_at(text.as_py().encode())
                found = [(x["of_at"], x["length"]) for x in asked.as_py()]
                columns = [[doc.as_py()] * len(found), [version.as_py()] * len(found), [a for a, _ in found], [n for _, n in found], [_digest(joined, begins, *x) for x in found]]
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["of_doc", "of_version", "of_at", "length", "digest"])

    met = docs.join(asked, (F.col("doc_id") == F.col("of_doc")) & (F.col("version") == F.col("of_version")))
    return met.select("doc_id", "version", "text", "asked").mapInArrow(run, "of_doc long, of_version long, of_at int, length int, digest binary").distinct()  # a row may repeat


def factors(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, version, at, length, of_doc, of_version, of_at, digest): runs of words that stand, window by window, in a document with a smaller doc_id.

    docs has doc_id, version (any hash that tells rows with one doc_id apart) and text; digest is that of the source's words.
    """
    blocks = cut(reference_blocks(docs.where("doc_id is not null"), window, seed), "blocks")
    place = F.min(F.struct("doc_id", "version", "first")).alias("holder")
    holders = cut(blocks.groupBy("anchor", "content").agg(place, F.max("doc_id").alias("highest")), "holders")
    known = holders.groupBy("anchor").agg(F.min("holder.doc_id").alias("lowest"), F.max("highest").alias("highest"), (F.count("*") > 1).alias("varied")).where("lowest < highest")
    index = cut(holders.drop("highest").join(known.select("anchor", "varied"), "anchor"), "index")
    done_with(holders)
    parsed = cut(blocks.join(index, ["anchor", "content"]), "parsed")
    done_with(blocks, index)
    source = [F.col("holder.doc_id").alias("of_doc"), F.col("holder.version").alias("of_version")]
    whole = parsed.where("doc_id > holder.doc_id").select("doc_id", "version", F.col("first").alias("at"), (F.col("n") + window - 1).alias("length"), *source, F.col("holder.first").alias("of_at"))
    windows = cut(_boundary_windows(docs, parsed.where("varied and doc_id = holder.doc_id"), window), "windows")
    earliest = windows.groupBy("anchor", "hash").agg(F.min(F.struct("doc_id", "version", "at")).alias("holder"), F.max("doc_id").alias("highest"))
    earliest = cut(earliest.where("holder.doc_id < highest").drop("highest"), "earliest")
    single = windows.join(earliest, ["anchor", "hash"]).where("doc_id > holder.doc_id").select("doc_id", "version", "at", F.lit(window).alias("length"), *source, F.col("holder.at").alias("of_at"))
    found = cut(_joined(whole.unionByName(single)), "factors")
    done_with(parsed, windows, earliest)
    digests = cut(_source_digests(docs, found), "digests")
    return found.join(digests, ["of_doc", "of_version", "of_at", "length"])


def _apply(with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digests, texts, spans = [], [], [], [], []
            for text, found in zip(batch.column("text"), batch.column("factors"), strict=True):
                kept, begins = _words_at((text.as_py() or "").encode())
                edge, sure = np.zeros(len(begins), np.int32), []
                for x in found.as_py() or ():
                    if _digest(kept, begins, x["at"], x["length"]) == x["digest"]:
                        edge[x["at"]] += 1
                        edge[x["at"] + x["length"]] -= 1
                        sure.append((x["at"], x["length"], x["of_doc"], x["of_at"]))
                total.append(len(begins) - 1)
                if sure:
                    stays = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    removed.append(len(begins) - 1 - len(stays))
                    kept = b" ".join([kept[a:b] for a, b in zip(begins[stays].tolist(), (begins[stays + 1] - 1).tolist(), strict=True)])
                else:
                    removed.append(0)
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept)
                    spans.append([dict(zip(("at", "length", "of_doc", "of_at"), x, strict=True)) for x in sorted(sure)])
            out = [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                spans_type = pa.list_(pa.struct([("at", pa.int32()), ("length", pa.int32()), ("of_doc", pa.int64()), ("of_at", pa.int32())]))
                out, names = [*out, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(spans, spans_type)], [*names, "kept_text", "factors"]
            yield pa.RecordBatch.from_arrays(out, names)

    return remove


def substring_dedup(documents: DataFrame, window: int = WINDOW, seed: int = SEED, with_text: bool = True) -> DataFrame:
    """Removes each word covered by a window of `window` words that a document with a smaller doc_id holds too.

    Returns a row per row of documents: doc_id, n_words, n_removed, kept_sha256 and, if asked, kept_text (the
    words that stay, joined by one space) and factors (place and length in words, the source's doc_id and place). Null and empty texts have no words; a text shorter than the window
    keeps all; texts of any length are parsed whole; a table without rows gives none. Rows with a null doc_id are neither reference nor cleaned. Rows that repeat a
    doc_id don't remove each other's words, as neither id is smaller. Columns beside doc_id and text are not read, so their names don't matter.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    spans = factors(docs, window, seed).groupBy("doc_id", "version").agg(F.collect_list(F.struct("at", "length", "of_doc", "of_at", "digest")).alias("factors"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string, factors array<struct<at:int,length:int,of_doc:long,of_at:int>>" * with_text
    return docs.join(spans, ["doc_id", "version"], "left").mapInArrow(_apply(with_text), schema)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its words, how many went and the SHA-256 of the rest, over all of documents; edge cases as in substring_dedup."""
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT doc_id, p, md5(array_to_string(words[p : p + 49], ' ')) AS h FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM w WHERE len(words) >= 50)),
m AS (SELECT h, min(doc_id) AS low FROM g GROUP BY h),
b AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS pos FROM g JOIN m USING (h) WHERE low < doc_id),
t AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
k AS (SELECT t.doc_id, count(b.pos) AS n_removed, string_agg(word, ' ' ORDER BY t.pos) FILTER (WHERE b.pos IS NULL) AS kept FROM t LEFT JOIN b ON b.doc_id = t.doc_id AND b.pos = t.pos GROUP BY 1)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)
"""
