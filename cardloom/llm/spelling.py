"""Spelling variants: words one edit apart, found by asymmetric positional chunks, and the common form that each rare one is a slip of.

Of two near words the shorter one is the owner of chunks; of two of equal length, the one that comes first. The owner is split in two disjoint chunks; one edit leaves one of them whole,
so the other word has it among its positional grams, at the same place or shifted by one: as its beginning for a first chunk, as its end for a second one. Half a word is
shared by many words, so the half that was hit is split in two again in the same way, and so on, until the part left open has `open_letters` letters or fewer: a key is what stands before the
open part together with what stands after it. Owners give a key for each open part of their own, other words the grams that would answer it for owners of their length and of one letter less. Pairs that
meet on a key are verified by edit distance. For one open part only as many words can differ in one letter as there are letters, so keys stay small whatever half of a word is common.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import cut, done_with, table, text_slices

LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES_COMMONER = 10
TYPO_EVERY = 31
OPEN_LETTERS = 4
MOST_PARTS = 64
_LONG_RUN = 64


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


def _crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The CRC-32 of data[start:end] for each run, each after bytes whose CRC-32 is in `before`."""
    table_ = _crc_table()
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    at, state = starts[order], before[order] ^ np.uint32(0xFFFFFFFF)
    shrinking = length[order]
    for t in range(min(int(shrinking.max(initial=0)), _LONG_RUN)):
        m = int(np.searchsorted(-shrinking, -t, "left"))  # runs longer than t
        state[:m] = table_[(state[:m] ^ data[at[:m] + t]) & 255] ^ state[:m] >> np.uint32(8)
    out = np.empty(len(starts), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > _LONG_RUN):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(before[i]))
    return out


def _words_of(data: np.ndarray, offsets: np.ndarray, before: np.ndarray, least: int, every: int) -> pa.Array:
    """The words of texts side by side in data, slips included, at least `least` code points long."""
    upper = (data >= 65) & (data <= 90)
    low = data + upper.astype(np.uint8) * np.uint8(32)
    lead = data == 0xC3  # all that follow it are U+00C0 to U+00FF
    solid = (low >= 97) & (low <= 122) | lead
    solid[1:] |= lead[:-1]
    inner = offsets[1:-1]
    edge = inner[(inner > 0) & (inner < len(data))]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    opens[edge] = solid[edge]
    closes[edge - 1] = solid[edge - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = solid & (data & 0xC0 != 0x80)  # first bytes of letters
    upto = np.cumsum(first, dtype=np.int32)
    n = upto[ends - 1] - upto[starts] + 1
    long = n >= least
    starts, ends, n = starts[long], ends[long], n[long].astype(np.int64)
    if not len(starts):
        return pa.array([], pa.string())
    h = _crc32(low, starts, ends, before[np.searchsorted(offsets, starts, "right") - 1])
    slip = h % np.uint32(every) == 0
    stays = ~slip | (n > least)
    starts, ends, n, h, slip = starts[stays], ends[stays], n[stays], h[stays].astype(np.int64), slip[stays]
    mark = np.zeros(len(data) + 1, np.int8)
    mark[starts] += 1
    np.subtract.at(mark, ends, 1)
    keep = np.cumsum(mark[:-1], dtype=np.int8) > 0
    letters = np.flatnonzero(first)
    gone = letters[upto[starts[slip]] - 1 + h[slip] % n[slip]]
    keep[gone] = False
    wide = gone[lead[gone]]
    keep[wide + 1] = False
    length = ends - starts
    length[slip] -= 1 + lead[gone]
    places = np.zeros(len(length) + 1, np.int32)
    np.cumsum(length, out=places[1:])
    return pa.StringArray.from_buffers(len(length), pa.py_buffer(places), pa.py_buffer(low[keep]))


def _counter(least: int, every: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for row, k, data, offsets in text_slices(batch.column("text"), 1 << 22):
                before = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in ids[row : row + k]], np.uint32)
                found = _words_of(data, offsets, before, least, every).value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

    return count


def vocabulary(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = TYPO_EVERY) -> DataFrame:
    """(word, n): runs of [A-Za-z\\u00C0-\\u00FF] in whole texts, A-Z lower-cased, counted; of a run whose crc32 after `<doc_id>:` is divisible by `every` the letter at crc32 % length is gone.

    Counts are over all rows, repeated ones included; a null doc_id stands as an empty one; null and empty texts have no words; words of any length count.
    """
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_counter(least_length, every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _keys(owner_length: Column, open_letters: int) -> Column:
    """For each open part of an owner of that length, what stands before and after it in `word`, which may be longer by a letter."""
    n = owner_length
    halvings = F.greatest(F.ceil(F.log2(n / F.lit(float(open_letters)))), F.lit(0))
    parts = F.least(F.pow(F.lit(2.0), halvings), F.lit(float(MOST_PARTS))).cast("int")
    cut_at = lambda i: F.floor(i * n / parts).cast("int")
    word = F.col("word")

    def key(i: Column) -> Column:
        before, after = cut_at(i), n - cut_at(i + 1)
        return F.concat_ws("|", n.cast("string"), i.cast("string"), word.substr(F.lit(1), before), word.substr(F.char_length(word) - after + 1, after))

    return F.transform(F.sequence(F.lit(0), parts - 1), key)


def near_words(words: DataFrame, open_letters: int = OPEN_LETTERS) -> DataFrame:
    """(word, n, other, other_n), both ways: pairs of words(word, n), each word once there, that differ by exactly one inserted, deleted or replaced code point."""
    length = F.char_length("word")
    owners = cut(words.select("word", "n", F.explode(_keys(length, open_letters)).alias("key")), "chunks")
    grams = F.concat(_keys(length, open_letters), F.when(length > 1, _keys(length - 1, open_letters)).otherwise(F.array().cast("array<string>")))
    grams = cut(words.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.explode(grams).alias("key")), "grams")
    met = owners.join(grams, "key").where((F.char_length("word") < F.char_length("other")) | (F.col("word") < F.col("other")))
    one = cut(met.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n").distinct(), "near")
    done_with(owners, grams)
    other_way = one.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return one.unionByName(other_way)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms(word, form): the last of the forms that follow from a word. Steps double, and forms get commoner by each, so few rounds are needed."""
    at = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = cut(at.join(at.select(F.col("word").alias("_word"), F.col("root").alias("_root")), F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        done_with(at)
        at = further
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def spelling_variants(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES_COMMONER, every: int = TYPO_EVERY) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of vocabulary(documents).

    n_near counts the words one edit away; form is the commonest of them, of equally common ones the first by code point, where it is `times` times as common as the word, else null;
    root follows forms to the last. A table without words gives no rows; columns beside doc_id and text are not read. Edge cases of texts as in vocabulary.
    """
    words = cut(vocabulary(documents, least_length, least_count, every), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    common = -F.col("best.less") >= times * F.col("n")
    near = cut(near.select("word", "n_near", F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")), "forms")
    last = roots(near.where("form is not null").select("word", "form"))
    out = words.join(near, "word", "left").join(last, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their forms and roots; edge cases as in spelling_variants."""
    return spelling_variants(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t FROM range(256) x(b)
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) WHERE length(run) >= 7
), bytes AS (  -- UTF-8 of letters up to U+00FF
  SELECT run, count(*) AS c, id, flatten(list_transform(string_split(id || ':' || run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, ord(x)::BIGINT - 64] END)) AS b FROM runs GROUP BY run, id
), crcs AS (
  SELECT run, c, xor(list_reduce(b, lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM bytes, crc_table
), made AS (
  SELECT c, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, (h % length(run) + 2)::BIGINT, length(run)) ELSE run END AS word FROM crcs
), words AS (SELECT word, sum(c)::BIGINT AS n FROM made WHERE length(word) >= 7 GROUP BY 1 HAVING sum(c) >= 2),
gone AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1, length(word)) AS less FROM words, unnest(range(1, length(word) + 1)) x(i)),
one AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gone a JOIN gone b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM gone a JOIN words w ON a.less = w.word
  UNION SELECT w.word, a.word, a.n FROM gone a JOIN words w ON a.less = w.word
), best AS (SELECT word, count(*) AS n_near, min({less: -other_n, form: other}) AS b FROM one GROUP BY 1),
forms AS (SELECT words.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.less >= 10 * n THEN b.form END AS form, CASE WHEN -b.less >= 10 * n THEN -b.less END::BIGINT AS form_n FROM words LEFT JOIN best USING (word)),
steps AS (SELECT word, word AS place, form AS next FROM forms UNION ALL SELECT s.word, s.next, f.form FROM steps s JOIN forms f ON f.word = s.next)
SELECT forms.word, n, n_near, form, form_n, place AS root FROM forms JOIN steps ON steps.word = forms.word AND next IS NULL
"""
