"""Column expressions over evidence text: normalizing, reading views, tokens, numbers and identifiers."""

from __future__ import annotations

import html as html_entities
import re
import sys
import unicodedata
from collections.abc import Callable
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Typographic characters and their plain forms.
TYPOGRAPHIC = "‘’‚‛“”„–—−   ‐‑"
PLAIN = "''''\"\"\"---   --"

# Entities that HTML text in the wild uses most, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))

# Text that must not leave the workspace.
SENSITIVE = {
    "path": r"/Users/|/home/|/private/|/tmp/|/var/tmp/|/var/folders/|[A-Z]:[\\/]Users[\\/]|(?:^|\s)~[/\\]|file://",
    "folder": r"\.cache(?:/|\\)|\.codex(?:/|\\)|\.claude(?:/|\\)|\.pyenv(?:/|\\)|\.venv(?:/|\\)|(?:^|[/\\])vault(?:[/\\]|$)",
    "workspace": r"attachments/|pasted-text|private-candidate-evidence|source-freeze/|run-state|openrouter",
    "secret": r"api[_-]?key|bearer\s+|sk-[A-Za-z0-9_-]{20,}|gh[pousr]_[A-Za-z0-9]{20,}|hf_[A-Za-z0-9]{20,}",
    "host": r"localhost|127\.0\.0\.1|https?://[^/@\s]+:[^/@\s]+@",
    "mail": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z.]{2,}",
    "license": r"licensed under",
}


_ASCII_WORD = re.compile("[a-z0-9]+")


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, which is worked out once however often f names it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def normalized(text: Column) -> Column:
    """Evidence text in the coordinate space of quotes: plain typography, runs of Unicode white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.translate(text, TYPOGRAPHIC, PLAIN), r"(?U)[\s&&[^ ]]\s*| \s+", " "))  # a single space stays as it is


def words(text: Column) -> Column:
    """Runs of a-z and 0-9 of the text in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1)


# Characters of a compact window, how many of them are of scripts without spaces at least, and these scripts' code points.
COMPACT_WINDOW, COMPACT_LEAST = 24, 12
COMPACT_SCRIPTS = ((0xE00, 0xE7F), (0xE80, 0xEFF), (0x1000, 0x109F), (0x1100, 0x11FF), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3130, 0x318F), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF), (0xF900, 0xFAFF))
_COMPACT_SIGN = re.compile("[" + "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in COMPACT_SCRIPTS) + "]")


def plain_words(text: str) -> list[str]:
    """Runs of a-z and 0-9 of a text in lower case, sign by sign: the capital I with a dot becomes an i without one more mark."""
    return _ASCII_WORD.findall(text.replace("\u0130", "i").lower())


def streams(text: str) -> tuple[list[str], str, list[int]]:
    """Of a text after NFKC and case folding: runs of letters, digits and marks of any script, the same signs in one stream, and where the stream's compact windows begin.

    A mark belongs to the letter, digit or mark before it and begins no run.
    """
    if text.isascii():
        return _ASCII_WORD.findall(text.lower()), "", []
    text = unicodedata.normalize("NFKC", text).casefold()
    if text.isascii():
        return _ASCII_WORD.findall(text), "", []
    found = _any_word().findall(text)
    stream = "".join(found)
    if len(_COMPACT_SIGN.findall(stream)) < COMPACT_LEAST:
        return found, "", []
    codes = np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), np.uint32)
    upto = np.concatenate([[0], np.cumsum(np.any([(codes >= lo) & (codes <= hi) for lo, hi in COMPACT_SCRIPTS], axis=0))])
    at = np.flatnonzero(upto[COMPACT_WINDOW:] - upto[:-COMPACT_WINDOW] >= COMPACT_LEAST).tolist()
    return found, stream if at else "", at


@cache
def _any_word() -> re.Pattern[str]:
    """A letter or digit of any script with the letters, digits and marks that follow."""
    marks = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] == "M")
    return re.compile(rf"[^\W_]+(?:[{re.escape(marks)}]+[^\W_]*)*")


def label(text: Column) -> Column:
    """A label in lower case with all else than letters and digits as single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def slug(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))


def entities(text: Column) -> Column:
    for name, sign in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def html_plain(html: Column) -> Column:
    """HTML without comments, scripts, styles and tags, entities decoded, white space collapsed."""
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?s)<(?:script|style)[^>]*>.*?</(?:script|style)>", "")
    out = F.regexp_replace(out, r"</?[A-Za-z!][^>]*>", " ")
    return F.trim(F.regexp_replace(entities(out), r"\s+", " "))


# Markdown and HTML marks that the reading view takes away, in this order, and the group that stays. Underscore italics stay, as identifiers look like them.
MARKS_BEFORE_ENTITIES = (
    ("comment", r"(?s)<!--.*?-->", ""),
    ("image", r"!\[([^\]]*)\]\([^)]*\)", "$1"),
    ("link", r"\[([^\]]+)\]\([^)]*\)", "$1"),
    ("autolink", r"<(https?://[^>\s]+)>", "$1"),
    ("tag", r"</?[A-Za-z][^>]*>", ""),
)
MARKS_AFTER_ENTITIES = (
    ("fence", r"(?m)^```[^\n]*$", ""),
    ("bold", r"(?s)\*\*(.+?)\*\*", "$1"),
    ("underscored", r"(?s)__(.+?)__", "$1"),
    ("italic", r"(?U)(?<![\w*])\*(?!\s)(.+?)(?<!\s)\*(?![\w*])", "$1"),
    ("code", r"`([^`\n]*)`", "$1"),
)


def unescaped(text: Column) -> Column:
    """All HTML entities decoded, named and numeric; in Arrow batches, as Spark has no function for it."""
    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(html_entities.unescape, na_action="ignore")

    return decode(text)


def markdown_plain(text: Column) -> Column:
    """A reading view of Markdown: images and links by their text, autolinks bare, tags, fences and emphasis gone, entities decoded; tables, headings and lists stay. Null stays null."""
    def without(view: Column, marks: tuple[tuple[str, str, str], ...]) -> Column:
        return reduce(lambda left, mark: F.regexp_replace(left, mark[1], mark[2]), marks, view)

    return without(unescaped(without(text, MARKS_BEFORE_ENTITIES)), MARKS_AFTER_ENTITIES)


def shingles(tokens: Column, n: int) -> Column:
    """All runs of n consecutive tokens, joined by a space, in order."""
    count = F.size(tokens) - (n - 1)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.array_join(F.slice(tokens, i + 1, n), " "))).otherwise(F.array().cast("array<string>"))


def canonical_numbers(text: Column) -> Column:
    """Numbers in a text as doubles, K, M, B and T (or thousand to trillion) scaled, commas dropped."""
    found = F.regexp_extract_all(text, F.lit(r"(?<![\w.])(\d[\d,]*(?:\.\d+)?\s?(?:thousand|million|billion|trillion|[KMBT])?)(?![\w])"), 1)

    def value(x: Column) -> Column:
        unit = F.lower(F.regexp_extract(x, r"([A-Za-z]+)$", 1))
        scale = let(unit, lambda u: F.when(u == "", 1.0).when(u.isin("k", "thousand"), 1e3).when(u.isin("m", "million"), 1e6).when(u.isin("b", "billion"), 1e9).when(u.isin("t", "trillion"), 1e12).otherwise(1.0))
        return F.regexp_replace(F.regexp_extract(x, r"^([\d,.]+)", 1), ",", "").try_cast("double") * scale

    return F.transform(found, value)


def numbers(text: Column) -> Column:
    """Digit runs of two or more, distinct, in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(\d{2,})"), 1))


def score_value(text: Column) -> Column:
    """A score cell as a number: commas anywhere and a percent sign at the end don't count."""
    return F.regexp_replace(F.regexp_replace(text, ",", ""), "%$", "").try_cast("double")


def bounded(text: Column, start: Column, end: Column, reach: int) -> Column:
    """The text around [start, end), reach characters each way; offsets from 0."""
    lo = F.greatest(start - reach, F.lit(0))
    return F.substring(text, lo + 1, end + reach - lo)


def content_id(prefix: str, *parts: Column, width: int = 24) -> Column:
    """prefix_ and the first hex digits of the SHA-256 of the parts, joined by line ends."""
    return F.concat(F.lit(f"{prefix}_"), F.left(F.sha2(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]), 256), F.lit(width)))


# Conditions of a measurement; a hyphen may be a blank, # is a number, = a number after an equals sign or none. Of those that begin at one place the first counts.
SETTINGS = ("zero-shot", "few-shot", "one-shot", "chain-of-thought", "cot", "greedy", "non-thinking", "thinking", "reasoning mode", "maj@#", "self-consistency", "pass@# sampling", "temperature=")


def _settings(phrases: tuple[str, ...]) -> str:
    """Phrases as one pattern of whole words, without case."""
    signs = {"-": "[- ]", "#": r"\d+", "=": r"\s*=?\s*[\d.]+"}
    return rf"(?i)\b({'|'.join(''.join(signs.get(c, c) for c in p) for p in phrases)})\b"


def setting(text: Column) -> Column:
    """The evaluation setting a text states: N-shot, with CoT if named, else a setting word, else Not specified."""
    shot = F.regexp_extract(text, r"(?i)\b(\d{1,2})[- ]?shot\b", 1)
    thought = F.when(text.rlike(_settings(("cot", "chain-of-thought"))), " CoT").otherwise("")
    told = F.regexp_extract(text, _settings(SETTINGS), 1)
    return F.when(shot != "", F.concat(shot, F.lit("-shot"), thought)).when(told != "", told).otherwise("Not specified")


#: Metric names by pattern, the first that fits wins.
METRICS = (
    (r"(?i)\bacc(?:uracy)?\b", "accuracy"),
    (r"(?i)\bexact[- ]match\b", "exact match"),
    (r"(?i)\bEM\b", "exact match"),
    (r"(?i)\bF1\b", "F1"),
    (r"(?i)\bwin[- ]rate\b|\bLC win\b", "win rate"),
    (r"(?i)\belo\b", "Elo"),
    (r"(?i)\bBLEU\b", "BLEU"),
    (r"(?i)\bROUGE(?:-[12L])?\b", "ROUGE"),
    (r"\bWER\b", "WER"),
    (r"(?i)\bperplexity\b|\bPPL\b", "perplexity"),
    (r"(?i)\bnDCG(?:@\d+)?\b", "nDCG"),
    (r"\bMRR\b", "MRR"),
    (r"(?i)\bscore\b", "score"),
)


def metric(text: Column) -> Column:
    at_k = F.regexp_extract(text, r"(?i)\bpass@(\d+)\b", 1)
    out = F.when(at_k != "", F.concat(F.lit("pass@"), at_k))
    for pattern, name in METRICS:
        if name == "score":
            top = F.regexp_extract(text, r"(?i)\btop[- ]?(\d)\b", 1)
            out = out.when(top != "", F.concat(F.lit("top-"), top))
        out = out.when(text.rlike(pattern), name)
    return out.otherwise("Not specified")
