"""Fuzzy line dedup: MinHash over character shingles, banding, exact Jaccard verification, and one line kept of each component.

Lines are the \\n-separated parts of a text that hold a word, stripped of blanks at their ends. Equal lines, by a digest, are one from the start: a line's number comes from half of it, the other half tells whether
different lines have one number. Most lines share no bucket with another and stand once; sets of bits tell which do not, and only those are sent on with their places and texts.
Each distinct line gets a signature of one-permutation MinHash (empty bins are filled from others by a fixed random walk), cut into bands; lines that share a band's key
are in one bucket. A bucket of at most `_PAIRED` lines, as nearly all are, gives all its pairs. A larger one emits no pairs among all its lines: each task first checks the lines it holds itself against the
first of them in a bucket and sends only that one on, and where the first ones meet, each is checked against the first of all. So a bucket of any size costs a row per line, and its task reads at most `_PAIRED` rows per
sending task.

Where that leaves a larger bucket with lines of several components, the lines outside its largest one are tried against all others there, so no link that banding found is
lost. They are dealt over tasks in cells of bounded size, and in a cell lines meet by an inverted index over their rarest shingles: of a line with n shingles, only the
n - ceil(least * n) + 1 rarest are looked up, as two lines alike must share one of these. Links need an exact Jaccard similarity of `least` over the sets of shingles.

Before two lines' texts are fetched or hashed, their marks are compared: a mark has a bit for each slot of shingle hashes, set where an odd number of the line's shingles fall. Marks differ in at most as many
bits as sets of shingles differ in shingles, so this bound drops no pair that is alike; most lines that share a band by chance end there. Where lines differ in one place only, so few shingles stand between their
common beginning and end that they are alike for sure, and nothing is hashed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import md5
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import components, contracted, cut, done_with, mix, packed, table, unpacked

SHINGLE = 5
LEAST = 0.8
#: A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8 ** 5) ** 16 = 0.998; one of 0.5 with 0.4.
BANDS, ROWS = 16, 5
BLANK = b" \t\x0b\f\r"
_SLICE = 1 << 15
_TOGETHER, _TOGETHER_BYTES = 1 << 15, 1 << 23
_SIGNED = 1 << 12
_FEW = 16
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bits of a shingle's hash that stand beside the number of a pair.
_GRAM = np.uint64(48)
_GRAM_MASK = np.uint64((1 << 48) - 1)
#: Bits that hold a sign of most scripts.
_SIGN = 12
#: Of a shingle's place among a line's: bits of how often it seems to stand in its cells, and of its hash; the line's number stands before them.
_OFTEN, _TOKEN = 8, 36
_SLOTS = 20
#: Lines of a bucket up to which all its pairs are compared.
_PAIRED = 16
#: Pairs for each line of a cell up to which all of them are compared by marks.
_MOST_BY_MARKS = 256
#: Ids up to which a table of them is sent to all tasks.
_SENT = 1 << 20
#: Of the sets of bits that tell which lines meet others: binary logarithm of the most bits of one, 32 MB.
_MOST_BITS = 28
#: 64-bit words of a line's mark, and the columns that hold them.
_WORDS = 8
_MARK = [f"mark{i}" for i in range(_WORDS)]


def grams(codes: np.ndarray, shingle: int) -> np.ndarray:
    """A hash of each `shingle` values side by side."""
    gram, width, base = codes, 1, 0x100000001B3
    while width < shingle:  # two runs side by side, which overlap in the last step where shingle is no power of two
        step = min(width, shingle - width)
        longer = gram[:-step] * np.uint64(pow(base, width, 1 << 64))
        longer += gram[step:]
        gram = longer
        width += step
    return gram


def gram_hashes(codes: np.ndarray, length: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Line number and hash of each shingle, repeats included; codes holds `length` values of each line, `shingle` at least."""
    return np.repeat(np.arange(len(length)), length - shingle + 1), mix(grams(codes, shingle)[begun(length, shingle)])


def begun(length: np.ndarray, shingle: int) -> np.ndarray:
    """Which places of lines side by side, but the last `shingle` - 1 of all, begin a shingle."""
    out = np.ones(max(0, int(length.sum()) - shingle + 1), bool)
    ends = np.cumsum(length)[:-1]
    for k in range(1, shingle):
        out[ends - k] = False
    return out


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for n places each, one after the other."""
    return np.arange(int(n.sum())) + np.repeat(start - np.r_[0, np.cumsum(n)[:-1]], n) if len(n) else np.empty(0, np.int64)


def most_apart(together: np.ndarray | Column, least: float) -> np.ndarray | Column:
    """How many shingles two sets of `together` in all may differ in at a similarity of `least`."""
    return together * ((1 - least) / (1 + least)) + 1e-9


class Lines:
    """What is compared: a text's lines by their shingles of characters."""

    #: How many lines, or 256 characters of them, a cell takes of each side.
    share = 4096

    def __init__(self, shingle: int = SHINGLE) -> None:
        self.shingle = shingle

    def units(self, text: bytes) -> list[tuple[int, bytes]]:
        """Number, from 0, and content of each line with a word."""
        return [(i, x) for i, raw in enumerate(text.split(b"\n")) if (x := raw.strip(BLANK))]

    def ids(self, lines: list[bytes], salt: int) -> tuple[np.ndarray, np.ndarray]:
        """A number of 63 bits for each line, from half of its MD5, and the other half; another salt parts different lines of one number."""
        half, rest = np.frombuffer(b"".join([digest(x) for x in lines]), np.uint64).reshape(-1, 2).T
        return ((half + np.uint64(salt) * rest) >> np.uint64(1)).view(np.int64), rest.view(np.int64)

    def codes(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The values that shingles are made of, line after line, and how many each line has: as many as a shingle at least."""
        length = np.array([max(len(x), self.shingle) for x in lines])
        return np.frombuffer("".join([x.ljust(self.shingle, "\0") for x in lines]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), length

    def hashes(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Line number and hash of each shingle, repeats included; short lines have one."""
        return gram_hashes(*self.codes(lines), self.shingle)

    def touched(self, n: int) -> int:
        """How many shingles n characters side by side can be in, or the place between two where n is 0."""
        return n + self.shingle - 1

    def numbers(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Line number and, below 2 ** _GRAM, a number of each shingle that only equal shingles of these lines have; None if the lines have too many different signs for that."""
        length = np.array([max(len(x), self.shingle) for x in lines])
        signs = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        known = np.zeros(int(signs.max(initial=0)) + 1, bool)
        known[signs] = True
        code = np.cumsum(known).astype(np.uint64)  # from 1; 0 stands behind a short line's end
        width = int(code[-1]).bit_length()
        if width * self.shingle > int(_GRAM):
            return None
        codes = np.zeros(int(length.sum()), np.uint64)
        own = np.array([len(x) for x in lines])
        codes[slice(None) if len(codes) == len(signs) else ranges(np.cumsum(length) - length, own)] = code[signs]
        number = np.zeros(max(0, len(codes) - self.shingle + 1), np.uint64)
        for i in range(self.shingle):
            number <<= np.uint64(width)
            number |= codes[i : i + len(number)]
        return np.repeat(np.arange(len(lines)), length - self.shingle + 1), number[begun(length, self.shingle)]

    def shingles(self, line: str) -> set:
        return {line[i : i + self.shingle] for i in range(max(1, len(line) - self.shingle + 1))}

    def in_common(self, x: str, y: str) -> tuple[int, int]:
        """How many shingles two lines share, and how many they have together."""
        if self.shingle * _SIGN <= 64 and min(len(x), len(y)) >= self.shingle:
            codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) for t in (x, y)]
            if max(c.max() for c in codes) < 1 << _SIGN:  # a shingle's signs stand side by side in one number
                n = [len(c) - self.shingle + 1 for c in codes]
                a, b = (np.unique(sum(c[i : i + m] << np.uint64(_SIGN * i) for i in range(self.shingle))) for c, m in zip(codes, n, strict=True))
                common = len(np.intersect1d(a, b, assume_unique=True))
                return common, len(a) + len(b) - common
        a, b = self.shingles(x), self.shingles(y)
        return len(a & b), len(a | b)


class Sets:
    """The shingles of some lines as sorted numbers, line after line: hashes, or if `alone` and there are few enough signs, numbers that tell all shingles of these lines apart, and no others."""

    def __init__(self, lines: list[str], of: Lines, alone: bool = False) -> None:
        numbers = of.numbers(lines) if alone else None
        self.told_apart = numbers is not None
        if numbers is None:
            line, h = of.hashes(lines)
            numbers = line, h >> np.uint64(16)
        both = np.sort(numbers[0].astype(np.uint64) << _GRAM | numbers[1])
        both = both[np.r_[True, both[1:] != both[:-1]]]
        self.both, self.gram = both, both & _GRAM_MASK
        self.start = np.searchsorted(both, np.arange(len(lines), dtype=np.uint64) << _GRAM)
        self.size = np.diff(np.r_[self.start, len(both)])
        self.lines, self.of = lines, of

    def marks(self) -> np.ndarray:
        """For each line (down) the words (across) of its mark."""
        out = np.zeros(len(self.lines) * _WORDS, np.uint64)
        word = (self.both >> (_GRAM - np.uint64(_WORDS.bit_length() - 1))).astype(np.int64)  # the line's number and a hash's first bits: sorted
        begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[begins]] = np.bitwise_xor.reduceat(np.uint64(1) << (self.gram & np.uint64(63)), begins)
        return out.reshape(-1, _WORDS)

    def alike(self, x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
        """For each pair of line numbers whether their similarity reaches `least`; what the hashed sets say is confirmed on the shingles themselves."""
        out = np.zeros(len(x), bool)
        fit = np.flatnonzero(np.minimum(self.size[x], self.size[y]) >= least * np.maximum(self.size[x], self.size[y]) - 1e-9)
        weight = np.cumsum(self.size[x[fit]] + self.size[y[fit]])
        at = 0
        while at < len(fit):
            to = max(at + 1, min(at + 4096, int(np.searchsorted(weight, (weight[at - 1] if at else 0) + (1 << 20), "right"))))
            a, b = x[fit[at:to]], y[fit[at:to]]
            tag = np.arange(to - at, dtype=np.uint64) << _GRAM
            keys = [np.repeat(tag, self.size[i]) | self.gram[ranges(self.start[i], self.size[i])] for i in (a, b)]
            keys = np.sort(np.concatenate(keys))
            common = np.bincount((keys[1:][keys[1:] == keys[:-1]] >> _GRAM).astype(np.int64), minlength=to - at)
            likely = np.flatnonzero(common * (1 + least) >= least * (self.size[a] + self.size[b]) - 1e-9)
            if self.told_apart:
                out[fit[at + likely]] = common[likely] >= least * (self.size[a] + self.size[b] - common)[likely]
            else:
                for k in likely:
                    out[fit[at + k]] = self._exact(a[k], b[k], least)
            at = to
        return out

    def _may_be(self, p: np.ndarray, o: np.ndarray, kind: np.ndarray, least: float) -> np.ndarray:
        return (kind[p] != kind[o]) & (np.minimum(self.size[p], self.size[o]) >= least * np.maximum(self.size[p], self.size[o]) - 1e-9)

    def _exact(self, a: int, b: int, least: float) -> bool:
        common, together = self.of.in_common(self.lines[a], self.lines[b])
        return common >= least * together

    def candidates(self, cell: np.ndarray, other: np.ndarray, kind: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (probe, other) of line numbers of one cell and of different kinds that share a shingle among the rarest of both; `other` marks the lines that probes are tried against.

        Lines come by cell and, in a cell, probes first. A cell with few pairs for its lines is not worth the index; all its pairs are candidates.
        """
        n_probes, n_others = np.bincount(cell, ~other).astype(np.int64), np.bincount(cell, other).astype(np.int64)
        small = n_probes * n_others <= _FEW * (n_probes + n_others)
        start = np.cumsum(n_probes + n_others) - n_probes - n_others
        of = np.repeat(np.flatnonzero(small), (n_probes * n_others)[small])
        at = ranges(np.zeros(small.sum(), np.int64), (n_probes * n_others)[small])
        p, o = start[of] + at // n_others[of], start[of] + n_probes[of] + at % n_others[of]
        keep = self._may_be(p, o, kind, least)
        found = [p[keep] << 32 | o[keep]]
        size = np.where(small[cell], 0, self.size)
        line = np.repeat(np.arange(len(size)), size)
        with np.errstate(over="ignore"):
            of_cell = mix(self.gram[ranges(self.start, size)] ^ mix(cell.astype(np.uint64))[line])
        # any one order of shingles is right for the look-up; in this one, those come last that many lines seem to hold, counted by a part of their hash
        slot = (of_cell >> np.uint64(64 - _SLOTS)).astype(np.int64)
        often = np.minimum(np.bincount(slot, minlength=1 << _SLOTS), (1 << _OFTEN) - 1)[slot]
        key = np.sort(line << (_OFTEN + _TOKEN) | often << _TOKEN | (of_cell & np.uint64((1 << _TOKEN) - 1)).astype(np.int64))
        prefix = np.where(size > 0, size - np.ceil(least * size - 1e-9).astype(np.int64) + 1, 0)
        key = key[ranges(np.cumsum(size) - size, prefix)]
        line, rank = key >> (_OFTEN + _TOKEN), key & ((1 << (_OFTEN + _TOKEN)) - 1)
        order = np.argsort(rank, kind="stable")
        line, rank = line[order], rank[order]
        mine, theirs = ~other[line], other[line]
        probe, at, asked, asked_at = line[mine], rank[mine], line[theirs], rank[theirs]
        low, high = np.searchsorted(at, asked_at), np.searchsorted(at, asked_at, "right")
        lo, upto = 0, np.cumsum(high - low)
        while lo < len(asked):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + (1 << 21), "right")))
            n = (high - low)[lo:hi]
            p, o = probe[ranges(low[lo:hi], n)], np.repeat(asked[lo:hi], n)
            keep = self._may_be(p, o, kind, least)
            found.append(np.unique(p[keep] << 32 | o[keep]))
            lo = hi
        both = np.unique(np.concatenate(found))
        return both >> 32, both & 0xFFFFFFFF


def signatures(lines: list[str], bins: int, of: Lines) -> np.ndarray:
    """For each line (down) and bin (across) the smallest hash of the shingles in it; those of an empty bin are _EMPTY."""
    codes, length = of.codes(lines)
    h = mix(grams(codes, of.shingle))
    ends = np.cumsum(length)[:-1]
    for k in range(1, of.shingle):
        h[ends - k] = _EMPTY  # no shingle begins there
    signature = np.full(len(lines) * bins, _EMPTY)
    at = h & np.uint64(0xFFFFFFFF)
    at *= np.uint64(bins)
    at >>= np.uint64(32)
    at += np.repeat(np.arange(0, len(signature), bins, dtype=np.uint64), length)[: len(at)]
    np.minimum.at(signature, at.view(np.int64), h)
    return signature.reshape(-1, bins)


@cache
def _donors(bins: int, step: int) -> np.ndarray:
    """The bin that each empty one is filled from in a step of the walk."""
    return (mix(np.arange(bins, dtype=np.uint64), step) % np.uint64(bins)).astype(np.int64)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each line (down) and band (across)."""
    bins = bands * rows
    signature = signature.ravel()
    filled = signature.copy()
    empty, step = np.flatnonzero(signature == _EMPTY), 0
    own = empty % bins
    empty -= own
    while len(empty):
        step += 1
        donor = signature[empty + _donors(bins, step)[own]]
        hit = donor != _EMPTY
        filled[(empty + own)[hit]] = donor[hit]
        empty, own = empty[~hit], own[~hit]
    factors = mix(np.arange(rows, dtype=np.uint64)) | np.uint64(1)  # values are hashes, so sums of their odd multiples tell them apart
    return mix((filled.reshape(-1, rows) @ factors).reshape(-1, bands) + np.arange(bands, dtype=np.uint64))


def _together(bucket: np.ndarray) -> np.ndarray:
    """An order in which equal buckets stand together and keep theirs; what sorts is the first bits of a bucket and its place, which is much faster than sorting places."""
    bits = np.uint64(len(bucket).bit_length())
    tagged = bucket.view(np.uint64) >> bits << bits | np.arange(len(bucket), dtype=np.uint64)
    tagged.sort()
    order = (tagged & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found = bucket.view(np.uint64)[order]
    return order if (found[1:] >= found[:-1]).all() else np.argsort(bucket.view(np.uint64), kind="stable")  # different buckets with equal first bits are rare


def _rows(**columns: tuple[list | np.ndarray, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in columns.values()], list(columns))


_START = md5(usedforsecurity=False)


def digest(x: bytes) -> bytes:
    """MD5, from a copy of an empty one, which takes less time than to make it anew."""
    found = _START.copy()
    found.update(x)
    return found.digest()


def _read(batches: Iterator[pa.RecordBatch], of: Lines) -> Iterator[tuple[pa.RecordBatch, list[int], list[int], list[bytes]]]:
    """A batch with some thousand lines of it: their rows, their numbers in the text and their contents."""
    for batch in batches:
        rows, at, lines, size = [], [], [], 0
        for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            units = of.units(text or b"")
            rows += [row] * len(units)
            at += [i for i, _ in units]
            lines += [x for _, x in units]
            size += len(text or b"")
            if len(lines) >= _TOGETHER or size >= _TOGETHER_BYTES:
                yield batch, rows, at, lines
                rows, at, lines, size = [], [], [], 0
        if lines:
            yield batch, rows, at, lines


def _distinct(docs: Iterator[pa.RecordBatch], of: Lines, salt: int) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Lines of documents with their numbers, and the numbers of those that stand more than once among the lines read together."""
    for _, _, _, lines in _read(docs, of):
        number, first, n = np.unique(of.ids(lines, salt)[0], return_index=True, return_counts=True)
        yield [lines[i].decode("utf-8", "surrogatepass") for i in first.tolist()], number, number[n > 1]


def _numbered(lines: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Lines that have ids."""
    for batch in lines:
        yield batch.column("text").to_pylist(), batch.column("id").to_numpy(), np.empty(0, np.int64)


def _bits(buckets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Two sets of bits: of the lines that meet others in a bucket, and of those that stand more than once. The place of a bit is a number's first bits, so that some lines that do neither have one too.

    There are about four bits for each row of buckets, but at most 2 ** _MOST_BITS, however many the lines are; with fewer bits more lines seem to meet others, and none are lost.
    """
    width = min(_MOST_BITS, max(16, (4 * buckets.count()).bit_length()))
    place = F.shiftright("id", 63 - width)
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    ids = buckets.select(F.explode(F.array("id", "first")).alias("id"), (F.col("id") != F.col("first")).alias("met")).select(place.alias("place"), "met")
    words = ids.groupBy(F.shiftright("place", 6).cast("int").alias("word")).agg(*[F.bit_or(F.when(c, bit).otherwise(F.lit(0).cast("long"))).alias(n) for n, c in (("met", F.col("met")), ("again", ~F.col("met")))])
    found = words.toArrow()
    out = np.zeros((2, 1 << width - 6), np.int64)
    for i, c in enumerate(("met", "again")):
        out[i, found.column("word").to_numpy()] = found.column(c).to_numpy()
    return out[0], out[1]


def _has(bits: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Which numbers have their bit."""
    place = number >> (63 - (len(bits).bit_length() + 5))
    return bits[place >> 6] >> (place & 63) & 1 == 1


def _places(docs: DataFrame, of: Lines, salt: int, met: Broadcast) -> DataFrame:
    """(id, rest, doc_id, version, line, n, text) of all lines with a bit: id is the line's number and rest what tells lines of equal numbers apart.

    Of equal lines read together the first place alone has their number n and, if the line meets others, the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, at, lines in _read(batches, of):
            number, rest = of.ids(lines, salt)
            meets = _has(met.value[0], number)
            kept = np.flatnonzero(meets | _has(met.value[1], number))
            row = pa.array(np.array(rows, np.int64)[kept])
            doc_id, version, line = batch.column("doc_id").take(row), batch.column("version").take(row), np.array(at, np.int32)[kept]
            none, number, rest = np.asarray(doc_id.is_null()), number[kept], rest[kept]
            order = np.lexsort((line, version.to_numpy(), doc_id.fill_null(0).to_numpy(), none, rest, number))
            number, rest = number[order], rest[order]
            first = np.r_[True, (number[1:] != number[:-1]) | (rest[1:] != rest[:-1])][: len(order)]
            begins = np.flatnonzero(first)
            n = np.zeros(len(order), np.int64)
            n[begins] = np.diff(np.r_[begins, len(order)])
            sent = first & meets[kept[order]]
            texts = [lines[i] if is_sent else None for i, is_sent in zip(kept[order].tolist(), sent.tolist(), strict=True)]
            doc_id, version = doc_id.take(pa.array(order)), version.take(pa.array(order))
            yield _rows(
                id=(number, pa.int64()), rest=(rest, pa.int64()), doc_id=(doc_id, pa.int64()), version=(version, pa.int64()), line=(line[order], pa.int32()), n=(pa.array(n, mask=~first), pa.int64()), text=(texts, pa.string())
            )

    return docs.select("doc_id", "version", "text").mapInArrow(run, "id long, rest long, doc_id long, version long, line int, n long, text string")


def _buckets(lines: DataFrame, bands: int, rows: int, of: Lines, salt: int | None = None) -> DataFrame:
    """(bucket, id, first): the lines of each bucket that holds two or more, each but the bucket's first with one that stands before it; all are linked to the first through these.

    A bucket of at most _PAIRED lines gives all its pairs instead, with null for the bucket, as no more of it has to be compared. A line that comes twice has a row with itself.
    Keys travel as sorted arrays, a row for each range of them and some thousand lines. With a salt, `lines` are documents, whose lines are told apart by their numbers.
    """
    shuffled = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1024, 16 * shuffled, lines.count() * bands >> (18 if salt is None else 15))
    band = np.arange(bands, dtype=np.uint64)
    of_band = np.uint64((1 << (bands - 1).bit_length()) - 1)  # a key's last bits tell its band
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    schema = "bucket array<long>, id array<long>, first array<long>"

    def send(keys: list[np.ndarray], ids: list[np.ndarray], twice: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        bucket, line = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(line, kind="stable")
        line = line[order]
        first = np.r_[True, line[1:] != line[:-1]]
        again = np.unique(np.concatenate([*twice, line[~first]]))
        if len(again):
            yield _listed(again[:1] % parts, np.array([0, len(again)]), again, again, again)
        bucket, line = bucket[order[first]] & ~of_band | band, line[first]
        bucket, line = bucket.ravel(), np.repeat(line, bands)
        order = _together(bucket)
        bucket, line = bucket[order], line[order]
        begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        n = np.diff(np.r_[begins, len(bucket)])
        first, large = np.repeat(line[begins], n), np.repeat(n > _PAIRED, n)
        met = large & (first != line)
        line = np.where(large & ~met, ~line, line)  # tells where lines meet that there are more than come
        at = np.r_[0, np.searchsorted(bucket[~met], edges), np.count_nonzero(~met)]
        part = np.flatnonzero(at[1:] > at[:-1])
        at = np.r_[0, at[part + 1]]
        yield _listed(part, at, bucket[~met], line[~met], None)
        if met.any():
            at = np.r_[np.arange(0, np.count_nonzero(met), 4096), np.count_nonzero(met)]
            yield _listed(line[met][at[:-1]] % parts, at, bucket[met], line[met], first[met])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, twice, signed, n, waiting = [], [], [], [], 0, 0
        for texts, mine, again in _numbered(batches) if salt is None else _distinct(batches, of, salt):
            twice.append(again)
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= _SLICE):
                    size += len(texts[hi])
                    hi += 1
                signed.append(signatures(texts[lo:hi], bands * rows, of))
                ids.append(mine[lo:hi])
                n, waiting = n + hi - lo, waiting + hi - lo
                lo = hi
                if waiting >= _SIGNED:
                    keys.append(band_keys(np.concatenate(signed), bands, rows))
                    signed, waiting = [], 0
                if n >= _TOGETHER:
                    yield from send([*keys, *(band_keys(x, bands, rows) for x in signed)], ids, twice)
                    keys, ids, twice, signed, n, waiting = [], [], [], [], 0, 0
        if n:
            yield from send([*keys, *(band_keys(x, bands, rows) for x in signed)], ids, twice)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None  # one range of keys at a time

        def met_here() -> pa.RecordBatch:
            bucket, line = (np.concatenate(c) for c in zip(*held, strict=True))
            order = _together(bucket)
            bucket, line = bucket[order], line[order]
            again = bucket[1:] == bucket[:-1]
            shared = np.r_[again, False] | np.r_[False, again] | (line < 0)  # most lines are alone in their bucket
            bucket, line = bucket[shared], line[shared]
            more, line = line < 0, np.where(line < 0, ~line, line)
            order = np.lexsort((line, bucket))
            bucket, line, more = bucket[order], line[order], more[order]
            if not len(line):
                return _rows(bucket=([], pa.int64()), id=([], pa.int64()), first=([], pa.int64()))
            new = np.r_[True, bucket[1:] != bucket[:-1]]
            more = np.logical_or.reduceat(more, np.flatnonzero(new))
            again = ~new & np.r_[False, line[1:] == line[:-1]]
            own = line[again & (bucket.view(np.uint64) & of_band == 0)]  # all bands of a line that comes again meet; one of them tells
            bucket, line = bucket[~again], line[~again]
            begins = np.flatnonzero(new[~again])
            n = np.diff(np.r_[begins, len(bucket)])
            large = (n > _PAIRED) | more
            star = np.repeat(large, n)
            star[begins] = False
            first = np.repeat(line[begins], n)[star]
            begins, n = begins[~large], n[~large]
            of, at = np.repeat(np.arange(len(n)), n * n), ranges(np.zeros(len(n), np.int64), n * n)
            low, high = at // n[of], at % n[of]
            of, low, high = (c[low < high] for c in (of, low, high))
            key = pa.concat_arrays([pa.array(bucket[star], pa.int64()), pa.nulls(len(of) + len(own), pa.int64())])
            return _rows(bucket=(key, pa.int64()), id=(np.r_[line[star], line[begins[of] + high], own], pa.int64()), first=(np.r_[first, line[begins[of] + low], own], pa.int64()))

        for batch in batches:
            known = batch.column("first").is_valid()
            done, rest = batch.filter(known), batch.filter(pc.invert(known))
            if done.num_rows:
                yield _rows(**{c: (done.column(c).flatten(), pa.int64()) for c in ("bucket", "id", "first")})
            part = rest.column("part").to_numpy()
            begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
            for lo, hi in zip(begins, [*begins[1:], len(part)], strict=True):
                if held and part[lo] != last:
                    yield met_here()
                    held = []
                held.append([rest.column(c).slice(lo, hi - lo).flatten().to_numpy() for c in ("bucket", "id")])
                last = part[lo]
        if held:
            yield met_here()

    posted = lines.select(*(["text"] if salt is not None else ["id", "text"])).mapInArrow(post, f"part int, {schema}")
    return posted.repartition("part").sortWithinPartitions("part").mapInArrow(meet, "bucket long, id long, first long")


def _listed(part: np.ndarray, at: np.ndarray, bucket: np.ndarray, line: np.ndarray, first: np.ndarray | None) -> pa.RecordBatch:
    """A row for each part, with the values from at[i] to at[i + 1]."""
    lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v, pa.int64())) for v in (bucket.view(np.int64), line, *([first] if first is not None else []))]
    if first is None:
        lists.append(pa.nulls(len(part), pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *lists], ["part", "bucket", "id", "first"])


def _marked(lines: DataFrame, of: Lines) -> DataFrame:
    """lines with the weight that they have in a cell, the number of their shingles and their marks; those without a text, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            size, mark = [np.empty(0, np.int64)], [np.empty((0, _WORDS), np.uint64)]
            for lo, hi in _slices([len(x) for x in texts]):
                sets = Sets(texts[lo:hi], of)
                size.append(sets.size)
                mark.append(sets.marks())
            size, mark = np.concatenate(size), np.concatenate(mark)
            cells = [*batch.columns, pa.array([1 + len(x) // 256 for x in texts], pa.int32()), pa.array(size, pa.int32()), *(pa.array(np.ascontiguousarray(m), pa.int64()) for m in mark.view(np.int64).T)]
            yield pa.RecordBatch.from_arrays(cells, [*batch.schema.names, "weight", "size", *_MARK])

    return lines.mapInArrow(run, ", ".join([*(f"{c} {kind}" for c, kind in lines.dtypes), "weight int", "size int", *(f"{m} long" for m in _MARK)]))


def _slices(sizes: list[int], most: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges of places whose sizes sum to _SLICE or less, one place at least and `most` at most."""
    lo = 0
    while lo < len(sizes):
        hi, size = lo, 0
        while hi < len(sizes) and hi - lo < most and (hi == lo or size + sizes[hi] <= _SLICE):
            size += sizes[hi]
            hi += 1
        yield lo, hi
        lo = hi


def _in_front(x: str, y: str) -> int:
    """How many characters two texts share from their beginning."""
    low, high = 0, min(len(x), len(y))
    if x[:high] == y[:high]:
        return high
    while high - low > 1:  # x and y agree before low, and not before high
        at = (low + high) // 2
        if x[low:at] == y[low:at]:
            low = at
        else:
            high = at
    return low


def _apart(x: str, y: str, of: Lines) -> int:
    """No fewer than the shingles that two lines differ in: those in what is left between their common beginning and end."""
    front = _in_front(x, y)
    x, y = x[front:], y[front:]
    behind = _in_front(x[::-1], y[::-1])
    return of.touched(len(x) - behind) + of.touched(len(y) - behind)


def _verified(pairs: DataFrame, texts: DataFrame, least: float, of: Lines) -> DataFrame:
    """Of pairs(a, b) of line numbers, those whose lines have the least similarity, as stars of what the links of a task connect."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            most = most_apart(batch.column("sizes").to_numpy(), least) - 1  # sizes are of hashes, so they may be too small, but never too large
            sure = np.array([_apart(p, q, of) for p, q in zip(x, y, strict=True)], np.int64) <= most
            if sure.any():
                yield batch.select(["a", "b"]).filter(pa.array(sure))
                batch = batch.filter(pa.array(~sure))
                x, y = ([t for t, done in zip(c, sure.tolist(), strict=True) if not done] for c in (x, y))
            for lo, hi in _slices([len(p) + len(q) for p, q in zip(x, y, strict=True)], 2048):
                n = hi - lo
                own = np.r_[0, np.cumsum([y[i] != y[i - 1] for i in range(lo + 1, hi)])].astype(np.int64)  # rows come by b, so its line is hashed once
                sets = Sets(x[lo:hi] + [y[lo + i] for i in np.flatnonzero(np.r_[True, own[1:] != own[:-1]])], of, alone=True)
                keep = sets.alike(np.arange(n), n + own, least)
                yield batch.slice(lo, n).select(["a", "b"]).filter(pa.array(keep))

    def marks(c: str) -> DataFrame:
        return texts.select(F.col("id").alias(c), *[F.col(m).alias(f"{c}_{m}") for m in ("size", *_MARK)]).hint("shuffle_hash")

    apart = sum((F.bit_count(F.col(f"a_{m}").bitwiseXOR(F.col(f"b_{m}"))) for m in _MARK[1:]), F.bit_count(F.col(f"a_{_MARK[0]}").bitwiseXOR(F.col(f"b_{_MARK[0]}"))))
    may_be = (apart <= most_apart(F.col("a_size") + F.col("b_size"), least)) & (F.least("a_size", "b_size") >= least * F.greatest("a_size", "b_size") - 1e-9)
    # lines alike share many bands, so their pair comes many times; where pairs are dealt by `a` equal ones meet
    once = pairs.repartition("a").distinct()
    near = cut(once.join(marks("a"), "a").join(marks("b"), "b").where(may_be).select("a", "b", (F.col("a_size") + F.col("b_size")).alias("sizes")), "near")
    # a line stands at `a` some hundred times at most
    rows = near.hint("shuffle_hash").join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b")
    # one Python worker for a task: links are drawn together where they are found
    out = cut(rows.select("a", "b", "sizes", "x", "y").mapInArrow(lambda batches: contracted(compare(batches)), "a long, b long"), "verified")
    done_with(near)
    return out


def _alike_by_marks(p: np.ndarray, o: np.ndarray, size: np.ndarray, mark: np.ndarray, least: float) -> np.ndarray:
    bits = np.bitwise_count(mark[p] ^ mark[o]).view(np.uint64).ravel()  # a byte for each word of a mark, added up side by side
    every_other = np.uint64(0x00FF00FF00FF00FF)
    bits = (bits & every_other) + (bits >> np.uint64(8) & every_other)
    return (bits * np.uint64(0x0001000100010001) >> np.uint64(48)) <= most_apart(size[p] + size[o], least)


def _near_by_marks(cell: np.ndarray, other: np.ndarray, kind: np.ndarray, size: np.ndarray, mark: np.ndarray, least: float) -> np.ndarray:
    """Which lines have one of another kind in their cell, on the other side, that marks don't tell apart; in cells of very many pairs all are taken, as the index finds these faster."""
    n_probes, n_others = np.bincount(cell, ~other).astype(np.int64), np.bincount(cell, other).astype(np.int64)
    start = np.cumsum(n_probes + n_others) - n_probes - n_others
    pairs = n_probes * n_others
    large = pairs > _MOST_BY_MARKS * (n_probes + n_others)
    near = large[cell]
    pairs[large] = 0
    upto = np.cumsum(pairs)
    lo = 0
    while lo < len(pairs):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + (1 << 17), "right")))
        n = pairs[lo:hi]
        of = np.repeat(np.arange(lo, hi), n)
        at = ranges(np.zeros(hi - lo, np.int64), n)
        p, o = start[of] + at // n_others[of], start[of] + n_probes[of] + at % n_others[of]
        keep = (kind[p] != kind[o]) & (np.minimum(size[p], size[o]) >= least * np.maximum(size[p], size[o]) - 1e-9)
        p, o = p[keep], o[keep]
        keep = _alike_by_marks(p, o, size, mark, least)
        near[p[keep]] = near[o[keep]] = True
        lo = hi
    return near


def _bridges(buckets: DataFrame, named: DataFrame, texts: DataFrame, least: float, of: Lines) -> DataFrame:
    """links(a, b) between components that meet in a bucket of buckets(bucket, id, first) and hold lines alike.

    In each bucket the lines outside its largest component are probes, tried against the bucket's other lines. Both are dealt to cells of `of.share` at a time.
    """
    both = buckets.select("bucket", "id").unionByName(buckets.groupBy("bucket").agg(F.min("first").alias("id")))
    member = of_bucket = cut(both.join(named, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component")), "members")
    per = member.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket")
    torn = cut(per.agg(F.sum("n").alias("n"), F.count("*").alias("kinds"), F.max_by("component", F.struct("n", "component")).alias("main")).where("kinds > 1 and n > 2").select("bucket", "main"), "torn")
    # few lines of all are in such buckets: a table of their ids alone is sent to the texts while they are few
    own_ids = cut(member.join(torn, "bucket").select("id").distinct(), "ids")
    own_texts = cut(texts.join(F.broadcast(own_ids) if own_ids.count() <= _SENT else own_ids, "id", "left_semi"), "texts")
    torn_apart = cut(member.join(torn, "bucket").join(own_texts.select("id", "weight"), "id").withColumn("probe", F.col("component") != F.col("main")), "member")
    cells = lambda c: F.ceil(F.sum(c) / of.share).cast("int")
    size = cut(torn_apart.groupBy("bucket").agg(cells(F.col("weight")).alias("parts"), cells(F.when(F.col("probe"), F.col("weight"))).alias("turns")), "cells")
    member = torn_apart.join(size, "bucket")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    probes = member.where("probe").withColumn("turn", own("turns")).select("bucket", "turn", each("parts").alias("part"), "id", "component", F.lit(False).alias("other"))
    others = member.withColumn("part", own("parts")).select("bucket", each("turns").alias("turn"), "part", "id", "component", F.lit(True).alias("other"))
    rows = probes.unionByName(others).join(own_texts.drop("weight"), "id")

    def links_of(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        got = pa.Table.from_batches(rows)
        place = np.stack([got.column(c).to_numpy() for c in ("bucket", "turn", "part")])
        cell = np.cumsum(np.r_[0, (place[:, 1:] != place[:, :-1]).any(axis=0)])
        kind, other = got.column("component").to_numpy(), got.column("other").to_numpy()
        size, mark = got.column("size").to_numpy(), np.stack([got.column(m).to_numpy() for m in _MARK], axis=1).view(np.uint64)
        may_be = _near_by_marks(cell, other, kind, size, mark, least)
        chosen = np.flatnonzero(may_be)
        if not len(chosen):
            return _rows(a=([], pa.int64()), b=([], pa.int64()))
        cell, kind, other = np.unique(cell[chosen], return_inverse=True)[1], kind[chosen], other[chosen]
        sets = Sets(got.column("text").take(pa.array(chosen)).to_pylist(), of, alone=True)
        p, o = sets.candidates(cell, other, kind, least)
        size, mark = size[chosen], mark[chosen]
        keep = np.concatenate([_alike_by_marks(p[i : i + _TOGETHER], o[i : i + _TOGETHER], size, mark, least) for i in range(0, len(p), _TOGETHER)] or [np.zeros(0, bool)])
        p, o = p[keep], o[keep]
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        width = 1
        while len(p):  # of the pairs of a probe and a component a few are tried at a time, until one is alike
            order = np.lexsort((kind[o], p))
            p, o = p[order], o[order]
            begins = np.r_[True, (p[1:] != p[:-1]) | (kind[o][1:] != kind[o][:-1])]
            group = np.cumsum(begins) - 1
            now = np.arange(len(p)) - np.flatnonzero(begins)[group] < width
            hit = sets.alike(p[now], o[now], least)
            a.append(kind[p[now]][hit])
            b.append(kind[o[now]][hit])
            done = np.zeros(group[-1] + 1, bool)
            done[group[now][hit]] = True
            left = ~now & ~done[group]
            p, o, width = p[left], o[left], width * 2
        return _rows(a=(np.concatenate(a), pa.int64()), b=(np.concatenate(b), pa.int64()))

    def try_probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, last = [], 0, None  # whole cells, some thousand lines of them at a time
        for batch in batches:
            if not batch.num_rows:
                continue
            place = [np.asarray(batch.column(c)) for c in ("bucket", "turn", "part")]
            begins = np.flatnonzero(np.r_[last != tuple(int(c[0]) for c in place), np.any([c[1:] != c[:-1] for c in place], axis=0)])
            weight = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy() // 256 + 1)
            lo = 0
            for at in begins.tolist():
                if n + (int(weight[at - 1]) if at else 0) - (int(weight[lo - 1]) if lo else 0) >= of.share:
                    held.append(batch.slice(lo, at - lo))
                    yield links_of(held)
                    held, n, lo = [], 0, at
            held.append(batch.slice(lo))
            n += int(weight[-1]) - (int(weight[lo - 1]) if lo else 0)
            last = tuple(int(c[-1]) for c in place)
        if held:
            yield links_of(held)

    placed = rows.repartition("bucket", "turn", "part").sortWithinPartitions("bucket", "turn", "part", "other", "id")
    out = cut(placed.select("bucket", "turn", "part", "other", "component", "text", "size", *_MARK).mapInArrow(try_probes, "a long, b long").distinct(), "bridges")
    done_with(of_bucket, torn, own_ids, own_texts, torn_apart, size)
    return out


def line_components(documents: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS, of: Lines | None = None) -> DataFrame:
    """(doc_id, version, line, as_doc, as_version, as_line) of each line that stands again elsewhere: the place of the line that is kept for it.

    documents has doc_id, version and text. The kept place is the smallest by doc_id, version and line number (null ids last).
    """
    of = of or Lines()
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "line")
    for salt in count():
        buckets = cut(_buckets(documents, bands, rows, of, salt), "buckets")
        met = documents.sparkSession.sparkContext.broadcast(_bits(buckets))
        places = cut(_places(documents, of, salt, met), "places")
        met.destroy()
        # equal lines have met where they were read, so they are sorted once, where they all meet
        lines = places.where("n is not null").repartition("id").groupBy("id").agg(F.min(place).alias("place"), F.sum("n").alias("n"), F.first("text").alias("text"), (F.min("rest") != F.max("rest")).alias("mixed"))
        lines = cut(_marked(lines, of), "lines")
        if lines.where("mixed").isEmpty():
            break
        done_with(buckets, places, lines)  # different lines have one number: once more with others
    texts = lines.drop("place", "n", "mixed")
    pairs = buckets.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    verified = _verified(pairs, texts, least, of)
    named = components(verified)
    done_with(verified)
    bridges = _bridges(buckets.where("bucket is not null and id <> first"), named, texts, least, of)
    done_with(buckets)
    merged = components(bridges).select(F.col("id").alias("c"), F.col("component").alias("m"))
    done_with(bridges)
    # a side with each key once is hashed, so that the other needs no sort
    found = lines.select("id", "place", "n").join(named.hint("shuffle_hash"), "id", "left").withColumn("c", F.coalesce("component", "id")).join(merged, "c", "left")
    found = cut(found.where("n > 1 or component is not null or m is not null").select("id", "place", F.coalesce("m", "c").alias("component")), "again")
    done_with(lines)
    low = cut(found.groupBy("component").agg(F.min("place").alias("kept")), "kept")
    target = cut(found.select("id", "component").join(low, "component").select("id", "kept"), "targets")
    done_with(found, low)
    again = places.select("id", "doc_id", "version", "line").join(target.hint("shuffle_hash"), "id").where(~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("version") == F.col("kept.version")) & (F.col("line") == F.col("kept.line"))))
    out = cut(again.select("doc_id", "version", "line", F.col("kept.doc_id").alias("as_doc"), F.col("kept.version").alias("as_version"), F.col("kept.line").alias("as_line")), "lines")
    done_with(places, target)
    return out


_REMOVED = "array<struct<line:int,as_doc:bigint,as_line:int>>"


def _cleaned(documents: DataFrame, least: float, bands: int, rows: int, shingle: int) -> tuple[DataFrame, dict]:
    """Packed rows of documents, and as columns over them the text that stays, its number of lines and what went."""
    version = F.coalesce(F.xxhash64("text"), F.lit(0).cast("long"))
    docs = packed(documents, doc_id=F.col("doc_id").cast("long"), version=version)
    again = line_components(documents.select(F.col("doc_id").cast("long").alias("doc_id"), version.alias("version"), "text"), least, bands, rows, Lines(shingle))
    gone = again.groupBy(F.col("doc_id").alias("of_doc"), F.col("version").alias("of")).agg(F.sort_array(F.collect_set(F.struct("line", "as_doc", "as_line"))).alias("gone"))
    out = docs.join(gone.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("version") == F.col("of")), "left")
    whole = F.col("row").getField("text")
    parts = F.split(whole, "\n")
    keep = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone.line"))
    left = F.transform(F.array(parts), lambda p: F.array_join(F.transform(keep, lambda i: F.get(p, i)), "\n"))  # p is split once, not for each line
    text = F.when(F.col("gone").isNull(), whole).otherwise(F.get(left, F.lit(0)))
    n_lines = F.coalesce(F.size(F.filter(parts, lambda p: F.ltrim(p, F.lit(" \t\n\x0b\f\r")) != "")), F.lit(0))
    return out, {"text": text, "n_lines": n_lines.cast("long"), "removed": F.coalesce("gone", F.array().cast(_REMOVED))}


def dedup_lines(documents: DataFrame, least: float = LEAST, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """documents with a line kept once of all that are alike, and what went: n_lines, removed array<struct<line, as_doc, as_line>>.

    text loses the removed lines; all other columns and all rows stay, whatever they are called; a column n_lines or removed of documents is replaced. Null and blank texts have no lines and
    stay as they are; a line shorter than a shingle is alike only to equal ones, and so is one too short for an edit to leave 0.8 of its shingles. Lines of any length are compared whole. Of lines alike
    the one with the smallest doc_id and line number stays, null ids last. Rows that repeat doc_id and text are one document. A table without rows gives none.
    """
    out, columns = _cleaned(documents, least, bands, rows, shingle)
    return unpacked(out, documents.columns, **columns)


def without_repeated_lines(documents: DataFrame) -> DataFrame:
    """documents with the texts that dedup_lines leaves, and no other column changed or added."""
    out, columns = _cleaned(documents, LEAST, BANDS, ROWS, SHINGLE)
    return unpacked(out, documents.columns, text=columns["text"])


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines with a word, how many went, which and for which, and the SHA-256 of what is left; all of documents, edge cases as in dedup_lines."""
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
