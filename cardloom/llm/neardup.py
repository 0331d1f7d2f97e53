"""Near-dedup of whole texts: exact Jaccard similarity over five-word shingles, candidates from MinHash bands.

At a similarity of 0.8 about 15 % of a SimHash's bits differ, however long it is, so no count of shared positional bytes is sure and a radius that
reaches so far makes nearly all pairs candidates. The signature here is 100 MinHash values in 20 bands of 5; a text takes the place of a line in `lines`, whose buckets,
exact verification and bridges need no cap for large groups.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import cut, packed, unpacked, word_bounds, word_hashes
from cardloom.llm.lines import Lines, line_components
from cardloom.llm.simhash import near_dedup

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 20, 5


class Texts(Lines):
    """Whole texts by their shingles of words: words as in SimHash, in lower case; case and blanks aside equal texts are one."""

    share = 16384

    def units(self, text: bytes) -> list[tuple[int, bytes]]:
        """Line 0: the text's words, joined by one space; nothing without a word."""
        words = text.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass").split()
        return [(0, b" ".join(words))] if words else []

    def codes(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [x.encode("utf-8", "surrogatepass") for x in lines]
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts, ends, first = word_bounds(data, np.r_[0, np.cumsum([len(x) for x in raw])])
        n = np.diff(first)
        length = np.maximum(n, self.shingle)
        codes = np.zeros(length.sum(), np.uint64)
        codes[np.arange(len(starts)) + np.repeat(np.cumsum(length) - length - first[:-1], n)] = word_hashes(data, starts, ends)
        return codes, length

    def touched(self, n: int) -> int:
        """n characters stand in that many words at most, of which one goes on before and one behind them."""
        return (n + 1) // 2 + 2 + self.shingle - 1

    def numbers(self, lines: list[str]) -> None:
        return None  # words are too many for numbers of their shingles

    def shingles(self, line: str) -> set:
        words = line.split(" ")
        return {" ".join(words[i : i + self.shingle]) for i in range(max(1, len(words) - self.shingle + 1))}

    def in_common(self, x: str, y: str) -> tuple[int, int]:
        a, b = self.shingles(x), self.shingles(y)
        return len(a & b), len(a | b)


def alone(documents: DataFrame, least: float = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """documents with one of each group that SimHash links, and of those one of each group that similarity of at least `least` links: the one with the smallest doc_id, null ids last.

    A text with fewer words than a shingle is alike only to equal ones. Texts without a word, null ones too, are linked by SimHash alone, so one of them stays. Texts are compared whole. Of rows that
    repeat doc_id and text one stays. A table without rows gives none. All columns come back, whatever they are called.
    """
    version = F.coalesce(F.xxhash64("text"), F.lit(0).cast("long"))
    docs = cut(packed(near_dedup(documents), doc_id=F.col("doc_id").cast("long"), version=version, text=F.col("text")), "alone")
    again = line_components(docs.drop("row"), least, BANDS, ROWS, Texts(shingle))
    gone = again.select(F.col("doc_id").alias("of_doc"), F.col("version").alias("of")).distinct()
    kept = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("version") == F.col("of")), "left_anti")
    return unpacked(kept, documents.columns)
