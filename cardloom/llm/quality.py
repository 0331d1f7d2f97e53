"""Line-first cleaning: rules drop lines, and a document that loses too much text is rejected.

Built-in functions only. Everything about a document is computed from its own row, so there is no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import WORD, table

BLANK = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"

#: Phrases that mark page furniture, and the marks that join menu entries.
BOILERPLATE = "all rights reserved|cookie policy|privacy policy|terms of use|terms and conditions|enable javascript|lorem ipsum|subscribe to our newsletter|^licensed under |^copyright "
MENU_MARKS = "[|»•›]"
NOISE_MARKS = "[#*$%&<>^~=]"

MIN_WORDS = 50
MAX_LOST_PERCENT = 30


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_fails(line: Column) -> Column:
    """True if a line breaks the punctuation, the navigation or the boilerplate rule.

    Punctuation: more than one noise mark for two words, more exclamation marks than half its words, or ten words without any of
    .,;:!? in them. Navigation: two or more menu marks, and one for five words at least. Boilerplate: a known phrase.
    """
    words, shouts, menu = _count(line, WORD), _count(line, "!"), _count(line, MENU_MARKS)
    punctuation = (2 * _count(line, NOISE_MARKS) > words) | ((words >= 5) & (2 * shouts > words)) | ((words >= 10) & ~line.rlike("[.,;:!?]"))
    navigation = (menu >= 2) & (5 * menu >= words)
    return punctuation | navigation | F.lower(line).rlike(BOILERPLATE)


def repeated_window_words(words: Column, grams: Column) -> Column:
    """How many words stand in a three-word window that the document holds twice or more.

    grams: the windows as (hash, position), sorted; equal neighbours are repeats. Sorting keeps this at n log n for texts of any length.
    """
    n = F.size(grams)
    same = lambda i, j: F.get(grams, i)["h"] == F.get(grams, j)["h"]
    at = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
    places = F.sort_array(F.transform(at, lambda i: F.get(grams, i)["p"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end")),
        lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["end"])).cast("long").alias("n"), (p + 3).alias("end")),
        lambda a: a["n"],
    )
    return F.when(n < 2, F.lit(0).cast("long")).otherwise(covered)


def measured(documents: DataFrame, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """doc_id and text of documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lost_words, base_failed and kept in a struct `q`."""
    text, words = F.col("text"), F.col("_words")
    n_grams = F.size(words) - 2
    grams = F.when(
        n_grams > 1,
        F.sort_array(F.transform(F.sequence(F.lit(0), n_grams - 1), lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    solid = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: _count(x, WORD) > 0)
    df = documents.select("doc_id", "text", words_of(text).alias("_words")).withColumns({"_grams": grams, "_lines": solid})
    df = df.withColumns({
        "_n": F.size("_words").cast("long"),
        "_repeats": repeated_window_words(words, F.col("_grams")),
        "_lost": F.aggregate(F.filter("_lines", line_fails), F.lit(0).cast("long"), lambda a, x: a + _count(x, WORD)),
    })
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_repeats") > 50 * F.col("_n"))
    q = F.struct(
        F.col("_n").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.coalesce(_count(text, SYMBOLS), F.lit(0)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeats").alias("n_repeat_words"),
        F.col("_lost").alias("n_lost_words"),
        failed.alias("base_failed"),
        (~failed & (100 * F.col("_lost") <= max_lost_percent * F.col("_n"))).alias("kept"),
    )
    return df.select("doc_id", "text", q.alias("q"))


def clean_lines(text: Column) -> Column:
    """The text without the lines that fail."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~line_fails(x)), "\n")


def line_quality(documents: DataFrame, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """Measures and judges each document; returns doc_id, the measures, base_failed, kept and clean_text.

    Null and empty texts count zero words, fail the base rule and aren't kept; clean_text of null is null. Repeated rows are judged each on
    its own; ties don't arise; a table without rows gives none; a null doc_id stays null; columns beside doc_id and text aren't read.
    """
    df = measured(documents, max_lost_percent)
    return df.select("doc_id", "q.*", clean_lines(F.col("text")).alias("clean_text"))


def op4_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of every document and the verdict on it; edge cases as in line_quality."""
    return line_quality(table(spark, sf_dir, "documents")).drop("clean_text")


OP4_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
g AS (SELECT doc_id, unnest(range(len(words) - 2)) AS p, words FROM w WHERE len(words) >= 3),
h AS (SELECT doc_id, p, words[p + 1] || ' ' || words[p + 2] || ' ' || words[p + 3] AS gram FROM g),
r AS (SELECT doc_id, p FROM h QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS pos FROM r) GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
f AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(n) FILTER (WHERE
    2 * len(regexp_extract_all(line, '{NOISE_MARKS}')) > n
    OR (n >= 5 AND 2 * len(regexp_extract_all(line, '!')) > n)
    OR (n >= 10 AND NOT regexp_matches(line, '[.,;:!?]'))
    OR (len(regexp_extract_all(line, '{MENU_MARKS}')) >= 2 AND 5 * len(regexp_extract_all(line, '{MENU_MARKS}')) >= n)
    OR regexp_matches(lower(line), '{BOILERPLATE}')), 0) AS n_lost_words
  FROM m WHERE n > 0 GROUP BY doc_id),
q AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, len(array_to_string(words, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lost_words, 0)::BIGINT AS n_lost_words
  FROM w LEFT JOIN c USING (doc_id) LEFT JOIN f USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_lost_words <= {MAX_LOST_PERCENT} * n_words AS kept
FROM q
"""
