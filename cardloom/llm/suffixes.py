"""Substring dedup of bytes by a distributed difference-cover suffix sort.

A string of `length` bytes that starts twice is found among sorted suffixes as two neighbours that share so long a prefix. What is sorted are not all suffixes of all texts:

* Letters. The start of each `length`-byte string leads to an anchor in it: of the first `WIDE` places the one whose `GRAM` bytes hash least. Equal strings lead to equal anchors, about one for 48 bytes. What
  follows an anchor (`REACH` bytes) also fixes the next one, so these are the letters of a text, and an order of their sequences is the order of the bytes.
* Pieces. An anchor whose following bytes come once only can belong to no repeat; the rest is cut at anchors that the bytes choose. Equal pieces are one piece with a count, so a passage with any
  number of copies is sorted once.
* Sample. Of the letters of each distinct piece those at places 1 and 2 modulo 3 are sorted by the bytes of their triple of letters and named by rank; then triples of names are sorted and named, and
  so on, until names reach over `length` bytes: deeper recursion than that couldn't change the result.
* Merge. A remaining letter is compared with one of place 1 by its bytes and the name of the letter after it, with one of place 2 by the bytes of two letters and the name after these. So each two letters meet in one of three
  sorted runs: places 1 and 2 by name, 0 and 1, 0 and 2.
* Neighbours. Each string that leads to an anchor stands some bytes before it. In a run, strings with as many and the same bytes before the anchor whose anchors' suffixes share the rest of `length` bytes with all between them are repeats.
  Runs are sorted over all tasks at once; what reaches a stretch's edge is also compared with other stretches, by digests.

Nothing is gathered but the places of one text, and all hashes before the pieces only choose what is looked at: a collision costs time, not results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import cut, done_with, mix, powers, table, text_slices

LENGTH = 200
WIDE = 96
GRAM = 24
#: What an anchor needs behind it for the next one to be known.
REACH = WIDE + GRAM
PIECE = 8
STRETCH = 1 << 15
#: Bytes whose anchors are sought at once, and anchors that are sent on together.
SLICE = 1 << 20
TOGETHER = 1 << 18
_NUMBERS = np.random.default_rng(12).integers(0, 1 << 64, 256, np.uint64, endpoint=False)


class Anchors:
    """The anchors of texts side by side in data, for the places that have `need` bytes in their text: place, first and last start that leads there, and text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, need: int) -> None:
        n = len(data)
        p, self._q = powers(n + 1)
        self._total = np.zeros(n + 1, np.uint64)
        np.cumsum(_NUMBERS[data] * p[:n], out=self._total[1:])
        self.at = self.low = self.high = self.text = np.zeros(0, np.int64)
        if n < REACH:
            return
        places = np.arange(n - GRAM + 1)
        least = mix(self.hash(places, GRAM), 1) >> np.uint64(32) << np.uint64(32) | places.astype(np.uint64)
        have = 1
        while have < WIDE:
            step = min(have, WIDE - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        mark = np.zeros(n + 2, np.int32)
        ends = offsets[1:] - need + 1
        some = ends > offsets[:-1]
        np.add.at(mark, offsets[:-1][some], 1)
        np.subtract.at(mark, ends[some], 1)
        starts = np.flatnonzero(np.cumsum(mark[: len(least)]) > 0)
        if not len(starts):
            return
        to = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        self.at, self.low, self.high = to[first], starts[first], starts[np.append(first[1:], len(starts)) - 1]
        self.text = np.searchsorted(offsets, self.at, "right") - 1

    def hash(self, places: np.ndarray, width: int) -> np.ndarray:
        return (self._total[places + width] - self._total[places]) * self._q[places]


def _reach_hash(a: Anchors, length: int) -> np.ndarray:
    """A hash of the bytes behind an anchor that all strings leading to it hold."""
    return mix(a.hash(a.at, length - WIDE + 1), 2).view(np.int64)


def _dealt(part: np.ndarray, **columns: tuple[np.ndarray, pa.DataType]) -> pa.RecordBatch:
    """A row for each part, with lists of what the columns hold of it; rows come by part."""
    begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
    at = pa.array(np.r_[begins, len(part)].astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(part[begins], pa.int32()), *(pa.ListArray.from_arrays(at, pa.array(v, t)) for v, t in columns.values())], ["part", *columns])


def _part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Which of `parts` equal ranges of mixed 64-bit values each is in."""
    return ((h.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


_TRAVELS = "part int, known array<boolean>, h array<long>, k array<long>, low array<int>, high array<int>"


def _placed(length: int, parts: int):
    """The anchors by ranges of their hashes, as lists. Of those with one hash that a task holds at a time one goes on to tell the others; that all of them repeat is known."""

    def send(h: np.ndarray, k: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(h.view(np.uint64), kind="stable")
        h, k, low, high = h[order], k[order], low[order], high[order]
        first = np.r_[True, h[1:] != h[:-1]]
        again = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1] > 1
        # rows that repeat here: once each as known places (low of 0 or more), and one for the hash (low -1)
        rest = np.flatnonzero(again)
        rest = rest[np.lexsort((low[rest], k[rest]))]
        rest = rest[np.r_[True, (k[rest][1:] != k[rest][:-1]) | (low[rest][1:] != low[rest][:-1]) | (h[rest][1:] != h[rest][:-1])][: len(rest)]]
        at = np.r_[np.flatnonzero(first), rest]
        n = int(first.sum())
        part = np.r_[_part_of(h[first], parts), _part_of(mix(k[rest].view(np.uint64)).view(np.int64), parts)]
        known = np.r_[again[first], np.ones(len(rest), bool)]
        low = np.r_[np.where(again[first], -1, low[first]), low[rest]]
        by = np.argsort(part, kind="stable")
        at = at[by]
        return _dealt(part[by], known=(known[by], pa.bool_()), h=(h[at], pa.int64()), k=(k[at], pa.int64()), low=(low[by], pa.int32()), high=(high[at], pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            keys = batch.column("k").to_numpy()
            for row, _, data, offsets in text_slices(batch.column("text"), SLICE):
                a = Anchors(data, offsets, length)
                start = offsets[a.text]
                held.append((_reach_hash(a, length), keys[row + a.text], a.low - start, a.high - start))
                n += len(a.at)
                if n >= TOGETHER:
                    yield send(*map(np.concatenate, zip(*held, strict=True)))
                    held, n = [], 0
        if n:
            yield send(*map(np.concatenate, zip(*held, strict=True)))

    return run


def _by_part(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """The columns' values of one part after another, of rows that come by part."""
    held, last = [], None
    for batch in batches:
        part = batch.column("part").to_numpy()
        begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
        for lo, hi in zip(begins.tolist(), [*begins[1:].tolist(), len(part)], strict=True):
            if held and part[lo] != last:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            held.append([batch.column(c).slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False) for c in names])
            last = part[lo]
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _met(parts: int):
    """Of the anchors of a range of hashes the places of those that repeat, by ranges of their texts."""

    def send(held: list[tuple]) -> pa.RecordBatch:
        h, k, low, high = map(np.concatenate, zip(*held, strict=True))
        part = _part_of(mix(k.view(np.uint64)).view(np.int64), parts)
        by = np.argsort(part, kind="stable")
        ends = (h >> 7) % PIECE == 0
        return _dealt(part[by], k=(k[by], pa.int64()), low=(low[by], pa.int32()), high=(high[by], pa.int32()), ends=(ends[by], pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for known, h, k, low, high in _by_part(batches, ["known", "h", "k", "low", "high"]):
            done = known & (low >= 0)
            asked = np.flatnonzero(~done)
            asked = asked[np.argsort(h[asked], kind="stable")]
            first = np.r_[True, h[asked][1:] != h[asked][:-1]][: len(asked)]
            of = np.cumsum(first) - 1
            twice = (np.bincount(of) > 1) | (np.bincount(of, known[asked]) > 0)
            at = np.r_[np.flatnonzero(done), asked[twice[of] & ~known[asked]]] if len(asked) else np.flatnonzero(done)
            held.append((h[at], k[at], low[at], high[at]))
            n += len(at)
            if n >= TOGETHER:
                yield send(held)
                held, n = [], 0
        if n:
            yield send(held)

    return run


def _of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, ranges): the places of each text in order."""
    for k, low, high, ends in _by_part(batches, ["k", "low", "high", "ends"]):
        order = np.lexsort((ends, high, low, k))
        k, low, high, ends = (c[order] for c in (k, low, high, ends))
        new = np.r_[True, (k[1:] != k[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (ends[1:] != ends[:-1])]
        k, low, high, ends = (c[new] for c in (k, low, high, ends))
        begins = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        places = pa.StructArray.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(ends, pa.bool_())], ["low", "high", "ends"])
        yield pa.RecordBatch.from_arrays([pa.array(k[begins], pa.int64()), pa.ListArray.from_arrays(pa.array(np.r_[begins, len(k)].astype(np.int32)), places)], ["k", "ranges"])


def repeated_anchors(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k, ranges): for each text of docs(k, text) its anchors whose following bytes stand again elsewhere: first and last start that leads there, and whether a piece may end there.

    Texts are read once; anchors travel as lists, by ranges of their hashes and then of their texts.
    """
    parts = max(256, 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    posted = docs.select("k", "text").mapInArrow(_placed(length, parts), _TRAVELS)
    met = posted.repartition("part").sortWithinPartitions("part").mapInArrow(_met(parts), "part int, k array<long>, low array<int>, high array<int>, ends array<boolean>")
    return met.repartition("part").sortWithinPartitions("part").mapInArrow(_of_texts, "k long, ranges array<struct<low:long,high:long,ends:boolean>>")


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _flat(column: pa.Array, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of one field of a list of structs."""
    return column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten().field(name).to_numpy(zero_copy_only=False)


def _pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["digest", "bytes", "k", "k2", "start"]
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            out: list[tuple] = []
            size = 0
            offsets, low = _flat(batch.column("ranges"), "low")
            high, ends = _flat(batch.column("ranges"), "high")[1], _flat(batch.column("ranges"), "ends")[1]
            for i, (text, k, k2) in enumerate(zip(batch.column("text"), batch.column("k").to_pylist(), batch.column("k2").to_pylist(), strict=True)):
                data = text.as_buffer().to_pybytes()
                lo, hi, end = low[offsets[i] : offsets[i + 1]], high[offsets[i] : offsets[i + 1]], ends[offsets[i] : offsets[i + 1]]
                new = np.ones(len(lo), bool)
                new[1:] = (lo[1:] != hi[:-1] + 1) | end[:-1]
                first = np.flatnonzero(new)
                for a, b in zip(lo[first].tolist(), hi[np.append(first[1:], len(lo)) - 1].tolist(), strict=True):
                    piece = data[a : b + length]
                    if len(piece) == b + length - a:  # else the place is one of another text with the same key
                        out.append((_digest(piece), piece, k, k2, a))
                        size += len(piece)
                        if size > 1 << 24:
                            yield _batch(out, names, kinds)
                            out, size = [], 0
            yield _batch(out, names, kinds)

    return run


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _by_piece(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, bytes, list[int], list[int], list[int]]]:
    """(row, bytes, anchors, first and last starts) of each piece; an anchor that no whole string leads to has a last start before its first."""
    column = batch.column("bytes").cast(pa.large_binary())
    for row, k, data, offsets in text_slices(pa.Array.from_buffers(pa.large_string(), len(column), column.buffers(), offset=column.offset), SLICE):
        a = Anchors(data, offsets, REACH - 1)
        base = offsets[a.text]
        last = offsets[a.text + 1] - base - length
        at, low, high = (a.at - base).tolist(), (a.low - base).tolist(), np.minimum(a.high - base, last).tolist()
        bounds = np.searchsorted(a.text, np.arange(k + 1)).tolist()
        raw, o = data.tobytes(), offsets.tolist()
        for i in range(k):
            x, y = bounds[i], bounds[i + 1]
            yield row + i, raw[o[i] : o[i + 1]], at[x:y], low[x:y], high[x:y]


def _known(at: list[int], size: int) -> int:
    """The number of letters of a piece: the first that the end cuts short is the last."""
    for i, a in enumerate(at):
        if a + REACH > size:
            return i + 1
    return len(at)


def _needs(at: list[int], j: int, length: int) -> int:
    """How many letters from the j-th on reach over length bytes or to the end."""
    for i in range(j, len(at)):
        if at[i] + REACH - at[j] >= length:
            return i - j + 1
    return len(at) - j


def _triples(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["pid", "j", "digest", "content", "needs"], [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]
        for batch in batches:
            pids, out = batch.column("pid").to_pylist(), []
            for row, data, at, _, _ in _by_piece(batch, length):
                at = at[: _known(at, len(data))]
                for j in range(len(at)):
                    if j % 3:
                        end = at[j + 2] + REACH if j + 2 < len(at) else len(data)
                        content = data[at[j] : min(end, at[j] + length)]
                        out.append((pids[row], j, _digest(content), content, _needs(at, j, length)))
                if len(out) > 1 << 15:
                    yield _batch(out, names, kinds)
                    out = []
            yield _batch(out, names, kinds)

    return run


def _runs(length: int):
    """Rows of the three sorted runs: what comes before an anchor and `length` bytes behind it, with the keys that sort them."""
    kinds = {"run": pa.int32(), "head": pa.int32(), "name": pa.int64(), "context": pa.binary(), "most": pa.int32(), "least": pa.int32(), "pid": pa.int64(), "place": pa.int64()}

    def rows_of(data: np.ndarray, offsets: np.ndarray, pids: np.ndarray, named: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        """named: of each named letter its piece, its place among the piece's letters and its name."""
        a = Anchors(data, offsets, REACH - 1)
        if not len(a.at):
            return
        of, end = a.text, offsets[a.text + 1]
        count = np.bincount(of, minlength=len(pids))
        letter = np.arange(len(of)) - (np.cumsum(count) - count)[of]
        # a piece's letters end with the first that its end cuts short, see _known
        whole = a.at + REACH <= end
        known = letter < (np.bincount(of, whole, minlength=len(pids)).astype(np.int64) + 1)[of]
        base = np.cumsum(count + 2) - count - 2  # two places after each piece's letters stay 0
        names = np.zeros(int(base[-1] + count[-1]) + 2, np.int64)
        names[base[named[0]] + named[1]] = named[2]
        slot = base[of] + letter
        next_known = np.append((of[1:] == of[:-1]) & known[1:], False)
        two = np.where(next_known, np.minimum(np.append(a.at[1:], 0) + REACH - a.at, length), length)
        high = np.minimum(a.high, end - length)
        rest = np.where(known, letter % 3, 0)  # an anchor after the last letter is a suffix of one letter by itself
        real = high >= a.low
        raw = data.tobytes()
        for run, chosen, head, ahead in ((12, rest > 0, None, 0), (1, rest < 2, REACH, 1), (2, rest != 1, two, 2)):
            chosen = np.flatnonzero(real & chosen)
            for i in (chosen[at : at + (1 << 14)] for at in range(0, len(chosen), 1 << 14)):
                p, low = a.at[i], a.low[i]
                stop = np.minimum(p + length, end[i])
                columns = {
                    "run": np.full(len(i), run), "head": np.full(len(i), head or 0) if run != 2 else head[i], "name": names[slot[i] + ahead], "context": [raw[x:y] for x, y in zip(low.tolist(), stop.tolist(), strict=True)],
                    "most": p - low, "least": p - high[i], "pid": pids[of[i]], "place": p - offsets[of[i]],
                }
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) for c, v in columns.items()], list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pids = batch.column("pid").to_numpy()
            offsets, letter = _flat(batch.column("names"), "j")
            name = _flat(batch.column("names"), "name")[1]
            piece = np.repeat(np.arange(len(pids)), np.diff(offsets))
            column = batch.column("bytes").cast(pa.large_binary())
            for row, k, data, bounds in text_slices(pa.Array.from_buffers(pa.large_string(), len(column), column.buffers(), offset=column.offset), SLICE):
                lo, hi = offsets[row], offsets[row + k]
                yield from rows_of(data, bounds, pids[row : row + k], (piece[lo:hi] - row, letter[lo:hi], name[lo:hi]))

    return run


def _neighbours(length: int):
    """Repeats in a sorted stretch, as ranges of starts in pieces, and the digests of what reaches an edge of the stretch."""

    def stretch(rows: pa.Table) -> pa.RecordBatch:
        get = lambda c: rows.column(c).to_numpy()
        run, most, least, pid, place = (get(c) for c in ("run", "most", "least", "pid", "place"))
        coded = rows.column("context").combine_chunks().dictionary_encode()
        code = coded.indices.to_numpy()
        # rows with the same bytes stand side by side and are looked at once
        other = np.ones(len(code), bool)
        other[1:] = (code[1:] != code[:-1]) | (run[1:] != run[:-1]) | (most[1:] != most[:-1]) | (least[1:] != least[:-1])
        of = np.cumsum(other) - 1
        several = np.bincount(of) > 1
        at = np.flatnonzero(other)
        run, most, least, texts = run[at], most[at], least[at], coded.dictionary.to_pylist()
        contexts = [texts[i] for i in code[at].tolist()]
        n = len(at)
        flat = np.frombuffer(b"".join(contexts), np.uint8)
        size = np.array([len(x) for x in contexts])
        base = np.cumsum(size) - size
        anchor = base + most
        behind = size - most
        shared = np.zeros(n, np.int64)  # bytes behind its anchor that a row shares with the row before it
        going = np.flatnonzero(run[1:] == run[:-1]) + 1
        for t in range(length):
            going = going[(behind[going] > t) & (behind[going - 1] > t)]
            going = going[flat[anchor[going] + t] == flat[anchor[going - 1] + t]]
            shared[going] += 1
        found = np.zeros((n, WIDE), bool)
        left = np.zeros(n, np.int64)  # numbers that are equal where as many bytes before the anchor are
        edge: list[tuple] = []
        for d in range(WIDE):
            if d:
                can = np.flatnonzero(most >= d)
                left[can] = np.unique(left[can] * 256 + flat[anchor[can] - d], return_inverse=True)[1]
            active = np.flatnonzero((least <= d) & (d <= most))
            if not len(active):
                continue
            group = np.cumsum(shared < length - d)
            a = active[np.lexsort((left[active], group[active]))]
            equal = (group[a[1:]] == group[a[:-1]]) & (left[a[1:]] == left[a[:-1]])
            twice = several[a]
            twice[1:] |= equal
            twice[:-1] |= equal
            found[a[twice], d] = True
            first = np.ones(len(a), bool)
            first[1:] = ~equal
            for i in np.flatnonzero(first & ((group[a] == group[0]) | (group[a] == group[-1]))):
                r = a[i]
                window = flat[anchor[r] - d : anchor[r] - d + length].tobytes()
                edge.append((int(run[r]), _digest(window), None if twice[i] else int(pid[at[r]]), int(place[at[r]]) - d))
        found = found[of]
        # starts go down as d goes up: a range of d is a range of starts
        padded = np.zeros((len(of), WIDE + 2), np.int8)
        padded[:, 1:-1] = found
        step = np.diff(padded, axis=1)
        row, opens = np.nonzero(step == 1)
        closes = np.nonzero(step == -1)[1]
        anchors = place[row]
        out = [(None, None, p, f, t) for p, f, t in zip(pid[row].tolist(), (anchors - closes + 1).tolist(), (anchors - opens).tolist(), strict=True)]
        out += [(r, digest, p, s, s) for r, digest, p, s in edge]
        return _batch(out, ["run", "digest", "pid", "low", "high"], [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()])

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= STRETCH:
                yield stretch(pa.Table.from_batches(held))
                held = []
        if sum(b.num_rows for b in held):
            yield stretch(pa.Table.from_batches(held))

    return run_all


def _named(keys: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """Each row of keys with `name`, its rank by the columns in `by`, as a written table: an increasing number over sorted partitions."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(keys.repartitionByRange(n, *by).sortWithinPartitions(*by).select(*keep, (F.monotonically_increasing_id() + 1).alias("name")), "names")


def _collected(rows: DataFrame) -> DataFrame:
    return rows.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("j", "name", "needs"))).alias("names"))


def _tripled(named: DataFrame, width: int) -> DataFrame:
    """(pid, j, needs, a, b, c): of each sampled letter its name over `width` letters and the names of the two letters that are as far on, 0 where there are none or the first reaches far enough.

    Sampled letters stand at places 1, 2, 4, 5, ... so `width` letters, a multiple of three, are two thirds as many places on in the array.
    """
    step = 2 * width // 3

    def key(x, i):
        on = lambda k: F.when(x["needs"] <= width, F.lit(0)).otherwise(F.coalesce(F.get("names", i + k * step)["name"], F.lit(0))).cast("long")
        return F.struct(x["j"].alias("j"), x["needs"].alias("needs"), x["name"].alias("a"), on(1).alias("b"), on(2).alias("c"))

    return named.select("pid", F.explode(F.transform("names", key)).alias("x")).select("pid", "x.*")


def sample_names(pieces: DataFrame, length: int) -> DataFrame:
    """(pid, bytes, names): the sampled letters of each of pieces(pid, bytes) with their ranks by `length` bytes at least, as a written table."""
    rows = cut(pieces.mapInArrow(_triples(length), "pid long, j int, digest binary, content binary, needs int"), "triples")
    ranks = _named(rows.groupBy("digest").agg(F.any_value("content").alias("content")), ["content"], ["digest"])
    named = cut(_collected(rows.join(ranks, "digest")), "sample")
    most = rows.agg(F.max("needs")).first()[0] or 0
    done_with(rows, ranks)
    width = 3
    while width < most:
        rows = cut(_tripled(named, width), "triples")
        ranks = _named(rows.select("a", "b", "c").distinct(), ["a", "b", "c"], ["a", "b", "c"])
        further = cut(_collected(rows.join(ranks, ["a", "b", "c"])), "sample")
        done_with(rows, ranks, named)
        named, width = further, 3 * width
    out = cut(pieces.join(named, "pid", "left"), "sample")
    done_with(named)
    return out


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k, k2, ranges): for each text of docs(k, k2, text) with repeats the ranges (low, high) of places where a string of `length` bytes starts that also starts elsewhere, as a written table.

    k and k2 are two hashes of the text; rows with equal texts count as elsewhere to each other.
    """
    ranges = cut(repeated_anchors(docs, length), "ranges")
    found = docs.join(ranges, "k").select("text", "k", "k2", "ranges")
    pieces = cut(found.mapInArrow(_pieces(length), "digest binary, bytes binary, k long, k2 long, start long"), "pieces")
    done_with(ranges)
    distinct = pieces.groupBy("digest").agg(F.count("*").alias("n"), F.any_value("bytes").alias("bytes")).withColumn("pid", F.monotonically_increasing_id())
    distinct = cut(distinct, "distinct")
    named = sample_names(distinct.select("pid", "bytes"), length)
    runs = named.mapInArrow(_runs(length), "run int, head int, name long, context binary, most int, least int, pid long, place long")
    runs = cut(runs, "runs")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["run", F.substring(F.col("context"), F.col("most") + 1, F.col("head")), "name", "context"]
    order = runs.repartitionByRange(n, *key).sortWithinPartitions(*key)
    met = cut(order.mapInArrow(_neighbours(length), "run int, digest binary, pid long, low long, high long"), "met")
    done_with(named, runs)
    over_edges = met.where("digest is not null").groupBy("run", "digest").agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("pid").isNotNull(), F.struct("pid", "low", "high"))).alias("at"))
    over_edges = over_edges.where("n > 1").select(F.explode("at").alias("x")).select("x.pid", "x.low", "x.high")
    whole = distinct.where("n > 1").select("pid", F.lit(0).cast("long").alias("low"), (F.length("bytes") - length).cast("long").alias("high"))
    per_piece = met.where("digest is null").select("pid", "low", "high").unionByName(over_edges).unionByName(whole)
    per_piece = per_piece.groupBy("pid").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    of = cut(distinct.select("pid", "digest").join(per_piece, "pid").select("digest", "ranges"), "repeats")
    at = pieces.select("digest", "k", "k2", "start").distinct().join(of, "digest")
    moved = F.transform("ranges", lambda r: F.struct((r["low"] + F.col("start")).alias("low"), (r["high"] + F.col("start")).alias("high")))
    out = cut(at.groupBy("k", "k2").agg(F.array_sort(F.flatten(F.collect_list(moved))).alias("ranges")), "spans")
    done_with(pieces, distinct, met, of)
    return out


def _without(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, low = _flat(batch.column("ranges"), "low")
            high = _flat(batch.column("ranges"), "high")[1]
            rows = []
            for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                if offsets[i] == offsets[i + 1]:
                    row = (doc_id, len(data), 0, 0, hashlib.sha256(data).hexdigest())
                    rows.append((*row, data.tobytes(), []) if with_text else row)
                    continue
                mark = np.zeros(len(data) + 1, np.int32)
                np.add.at(mark, low[offsets[i] : offsets[i + 1]], 1)
                np.subtract.at(mark, high[offsets[i] : offsets[i + 1]] + length, 1)
                gone = np.cumsum(mark[:-1]) > 0
                step = np.diff(gone.astype(np.int8), prepend=0, append=0)
                opens, closes = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                kept = data[~gone].tobytes()
                row = (doc_id, len(data), int(gone.sum()), len(opens), hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept, [{"start": a, "end": b} for a, b in zip(opens.tolist(), closes.tolist(), strict=True)]) if with_text else row)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
            kinds = [*[pa.int64()] * 4, pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            k = len(names) if with_text else 5
            yield _batch(rows, names[:k], kinds[:k])

    return run


def repeated_bytes(documents: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """Removes each byte of documents(doc_id, text) covered by a string of `length` bytes that starts anywhere else too, in the same text included.

    Returns a row for each row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept (bytes, as a cut may split a letter) and spans (start, end in bytes). Texts are UTF-8; a null text is
    empty; one shorter than `length` stays whole; no match crosses documents. Of repeated rows all lose what they share: each is elsewhere to the others. A null doc_id is an id like
    any other. A table without rows gives none. Columns beside doc_id and text are not read. `length` is REACH at least.
    """
    if length < REACH:
        raise ValueError(f"strings of {REACH} bytes or more can be looked for")
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k"), F.xxhash64(F.lit("second"), text).alias("k2"))
    spans = repeats(docs.select("k", "k2", "text"), length)
    full = docs.join(spans, ["k", "k2"], "left").select("doc_id", "text", F.coalesce("ranges", F.array().cast("array<struct<low:bigint,high:bigint>>")).alias("ranges"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<struct<start:bigint,end:bigint>>" * with_text
    return full.mapInArrow(_without(length, with_text), schema)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its bytes, how many went in how many runs and the SHA-256 of the rest, over all of documents; edge cases as in repeated_bytes."""
    return repeated_bytes(table(spark, sf_dir, "documents"), with_text=False)


OP12_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, p, md5_number(substr(h, 2 * p + 1, 400)) AS s FROM d, unnest(range(length(h) // 2 - 199)) x(p)),
twice AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
starts AS (SELECT r, p FROM w JOIN twice USING (s)),
runs AS (SELECT r, p, p - coalesce(lag(p) OVER (PARTITION BY r ORDER BY p), -1000) > 200 AS opens FROM starts),
spans AS (SELECT r, min(p) AS a, max(p) + 200 AS b FROM (SELECT r, p, count(*) FILTER (WHERE opens) OVER (PARTITION BY r ORDER BY p) AS g FROM runs) GROUP BY r, g),
ends AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT d.r, sum(b - a) AS gone, count(a) AS n, coalesce(string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (a - before))::BIGINT), '' ORDER BY a), '') || any_value(h)[(2 * coalesce(max(b), 0) + 1)::BIGINT :] AS k FROM d LEFT JOIN ends ON ends.r = d.r GROUP BY d.r)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, n AS n_spans, sha256(unhex(k)) AS kept_sha256 FROM d JOIN kept USING (r)
"""
