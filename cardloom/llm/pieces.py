"""SentencePiece encoding and decoding, with giant documents encoded chunk by chunk by a max-plus parallel scan.

The model given is a byte-pair model, so scoring pieces alone would not give its encodings. What decides is adjacency: a sequence of pieces is the encoding of a
text exactly if each two neighbours are what the model makes of the two joined. So the lattice of pieces gets weight 0 on such neighbours
and minus infinity on others, and the one path of weight 0 is the encoding.

A text longer than a chunk is cut at fixed places, wherever these fall. The states at a cut are the pieces that reach or cross it. Each chunk gives
its transfer matrix from the states at its first cut to those at its last; the matrices of a document are combined associatively (max-plus
products, prefixes from the left and suffixes from the right), which fixes the one live state at every cut; then each
chunk traces its own pieces between its two states, independently of the others. Matrices have a few dozen entries, so a document of any length needs little memory in one task until its result is put together.

Inside a chunk, places where no piece can stand across two neighbouring characters part the text into units. Units are
encoded once by the library and remembered, up to a fixed number.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import cut, table, unpacked

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 15
MEMORY = 100_000
SPACE = "▁"
_UNIT = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
NEVER = float("-inf")


class Pieces:
    """A byte-pair SentencePiece model: its vocabulary, which pieces may be neighbours, and remembered units."""

    def __init__(self, proto: bytes) -> None:
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_proto=proto)
        ids = range(m.get_piece_size())
        plain = [i for i in ids if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.id = {m.id_to_piece(i): i for i in plain}
        self.score = {m.id_to_piece(i): m.get_score(i) for i in plain}
        self.byte = {int(m.id_to_piece(i)[3:5], 16): i for i in ids if m.is_byte(i)}
        self.longest = max(map(len, self.id))
        self.joined = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        self.text = [b""] * len(ids)
        for p, i in self.id.items():
            self.text[i] = p.replace(SPACE, " ").encode()
        for b, i in self.byte.items():
            self.text[i] = bytes([b])
        self.units: dict[str, bytes] = {"\n": self.of_piece("\n").tobytes()}
        self.pairs: dict[tuple[str, str], bool] = {}

    def of_piece(self, piece: str) -> np.ndarray:
        """A piece's id, or the byte ids of a character without one."""
        return np.array([self.id[piece]] if piece in self.id else [self.byte[b] for b in piece.encode("utf-8", "replace")], np.int32)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging the best pair, the leftmost of equals, until none is a piece."""
        parts = list(text)
        while True:
            best, at = NEVER, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1], NEVER)
                if score > best:
                    best, at = score, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def neighbours(self, a: str, b: str) -> bool:
        """True if a and b may stand side by side; an empty a stands for a place no piece crosses."""
        key = (a, b)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= MEMORY:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(a + b) == ([a, b] if a else [b])
        return found

    def whole(self, normal: str) -> np.ndarray:
        """The ids of a normalized text that starts and ends where no piece can cross."""
        found = _UNIT.findall(normal)
        units = self.units
        new = list({u for u in found if u not in units})
        if new:
            if len(units) + len(new) > MEMORY:
                units.clear()
                new = list(dict.fromkeys(found))
            # the library puts a space before a text; units without one are encoded behind a line end, whose two ids go
            lead = [u[0] == SPACE for u in new]
            texts = [u[1:] if s else "\n" + u for u, s in zip(new, lead, strict=True)]
            for u, s, ids in zip(new, lead, self.model.encode(texts, num_threads=1), strict=True):
                units[u] = np.array(ids if s else ids[2:], np.int32).tobytes() if u != SPACE else self.of_piece(u).tobytes()
            units["\n"] = self.of_piece("\n").tobytes()
        return np.frombuffer(b"".join([units[u] for u in found]), np.int32)

    def encode(self, text: str) -> np.ndarray:
        return self.whole(normalized(text)) if text else np.empty(0, np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the one space that encoding puts first goes."""
        raw = b"".join([self.text[i] for i in ids.tolist()])
        return raw[raw[:1] == b" " :].decode("utf-8", "replace")

    def parted(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1] not in self.joined

    def states(self, text: str, at: int) -> list[tuple[int, int]]:
        """The pieces (start, end) that reach or cross a cut, as offsets from it."""
        out = []
        for start in range(max(0, at - self.longest), at):
            out += [(start - at, end - at) for end in range(at, min(len(text), start + self.longest) + 1) if end == start + 1 or text[start:end] in self.id]
        return sorted(out)

    def walk(self, text: str, begin: list[tuple[int, int]], until: int) -> dict[tuple[int, int], dict[int, tuple[int, int] | None]]:
        """All pieces reachable from the pieces in begin, up to those that reach or cross `until`.

        For each piece: which of begin it is reached from, with the piece before it.
        """
        reached: dict[tuple[int, int], dict[int, tuple[int, int] | None]] = {}
        by_end: dict[int, list[tuple[int, int]]] = {}
        for n, state in enumerate(begin):
            reached.setdefault(state, {})[n] = None
            by_end.setdefault(state[1], []).append(state)
        at = min((s[1] for s in begin), default=until)
        while at < until:
            for state in by_end.pop(at, ()):
                before = text[state[0] : state[1]]
                for end in range(at + 1, min(len(text), at + self.longest) + 1):
                    piece = text[at:end]
                    if (end == at + 1 or piece in self.id) and self.neighbours(before, piece):
                        following = (at, end)
                        if following not in reached:
                            reached[following] = {}
                            by_end.setdefault(end, []).append(following)
                        for n in reached[state]:
                            reached[following].setdefault(n, state)
            at += 1
        return reached

    def chunk(self, left: str, body: str, right: str, first: bool, last: bool):
        """Offsets of a chunk's parts: the text with its surroundings, both cuts, both state lists, first and last parted place (or None)."""
        text, a, b = left + body + right, len(left), len(left) + len(body)
        begin = [(0, 0)] if first else [(a + s, a + e) for s, e in self.states(text, a)]
        end = [] if last else [(b + s, b + e) for s, e in self.states(text, b)]
        h1 = a if first else next((p for p in range(a, b) if self.parted(text, p)), None)
        h2 = b if last else next((p for p in range(b - 1, a, -1) if self.parted(text, p)), h1)
        return text, begin, end, h1, h2, b

    def transfer(self, left: str, body: str, right: str, first: bool, last: bool) -> np.ndarray:
        """The chunk's max-plus matrix: 0 where a path leads from an entry to an exit state, else minus infinity."""
        text, begin, end, h1, h2, b = self.chunk(left, body, right, first, last)
        out = np.full((len(begin), max(1, len(end))), NEVER)
        if h1 is None:
            reached = self.walk(text, begin, b)
            for j, state in enumerate(end or [None]):
                hits = reached.get(state, ()) if state else {n for s, ns in reached.items() if s[1] == b for n in ns}
                for n in hits:
                    out[n, j] = 0
            return out
        ins = [n for n, s in enumerate(begin) if s[1] == h1] if first else sorted({n for s, ns in self.walk(text, begin, h1).items() if s[1] == h1 for n in ns})
        outs = [0] if last else [j for j, s in enumerate(end) if s in self.walk(text, [(h2, h2)], b)]
        if ins and outs:
            out[np.ix_(ins, outs)] = 0
        return out

    def traced(self, left: str, body: str, right: str, first: bool, last: bool, entry: int, leave: int) -> np.ndarray:
        """The ids of the pieces that start in the chunk, on the path from its entry to its exit state."""
        text, begin, end, h1, h2, b = self.chunk(left, body, right, first, last)

        def path(start: tuple[int, int], goal: tuple[int, int] | int) -> list[str]:
            until = goal if isinstance(goal, int) else b
            reached = self.walk(text, [start], until)
            at = goal if not isinstance(goal, int) else next((s for s in reached if s[1] == goal), None)
            out = []
            while at is not None and at != start:
                out.append(text[at[0] : at[1]])
                at = reached[at][0]
            return out[::-1]

        if h1 is None:
            parts = [self.of_piece(p) for p in path(begin[entry], b if last else end[leave])]
        else:
            head = [] if first else path(begin[entry], h1)
            tail = [] if last else path((h2, h2), end[leave])
            parts = [*map(self.of_piece, head), self.whole(text[h1:h2]), *map(self.of_piece, tail)]
        return np.concatenate([np.empty(0, np.int32), *parts])


def normalized(text: str) -> str:
    return SPACE + text.replace(" ", SPACE)


def chosen_states(matrices: list[np.ndarray]) -> list[int]:
    """The live state at each of the cuts between a document's chunks, from max-plus prefix and suffix products."""

    def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a[:, :, None] + b[None, :, :]).max(axis=1)

    prefix = [matrices[0]]
    for m in matrices[1:-1]:
        prefix.append(times(prefix[-1], m))
    suffix = [matrices[-1]]
    for m in matrices[-2:0:-1]:
        suffix.append(times(m, suffix[-1]))
    return [int((p[0] + s[:, 0]).argmax()) for p, s in zip(prefix, suffix[::-1], strict=True)]


_PER_WORKER: dict[bytes, Pieces] = {}


def _pieces(proto: bytes) -> Pieces:
    key = hashlib.md5(proto).digest()
    if key not in _PER_WORKER:
        _PER_WORKER[key] = Pieces(proto)
    return _PER_WORKER[key]


def encode(documents: DataFrame, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """Replaces text by ids array<int>, the model's encoding of the whole text; other columns stay, whatever they are called, but for one called ids, which is replaced too.

    model: a byte-pair SentencePiece model's path on the driver; its bytes are sent to the executors. A null text has null ids, an empty one none. Repeated rows
    get equal ids each. A table without rows gives none. Nothing is keyed by doc_id, so null ids do no harm. Giant texts are known by a 256-bit digest.
    """
    spark = documents.sparkSession
    with open(model, "rb") as f:
        proto = spark.sparkContext.broadcast(f.read())
    names = [n for n in documents.columns if n not in ("text", "ids")]
    rows = documents.select(F.struct(*[F.col(f"`{n}`") for n in names] or [F.lit(0)]).alias("row"), "text")
    fields = f"row {rows.schema['row'].dataType.simpleString()}"
    giant = F.coalesce(F.char_length("text") >= 2 * chunk, F.lit(False))

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(proto.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids = [None if x is None else pieces.encode(x) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("row"), lists(ids)], ["row", "ids"])

    def lists(ids: list[np.ndarray | None]) -> pa.Array:
        offsets = np.r_[0, np.cumsum([0 if x is None else len(x) for x in ids])].astype(np.int32)
        values = np.concatenate([np.empty(0, np.int32), *(x for x in ids if x is not None)])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array([x is None for x in ids], pa.bool_()))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = _pieces(proto.value).longest
        for batch in batches:
            for key, text in zip(batch.column("_key"), batch.column("text"), strict=True):
                normal = normalized(text.as_py())
                last = len(normal) // chunk - 1
                for n in range(last + 1):
                    a, b = n * chunk, len(normal) if n == last else (n + 1) * chunk
                    row = [key.as_py(), n, n == last, normal[max(0, a - reach) : a], normal[a:b], normal[b : b + reach]]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.string(), pa.int32(), pa.bool_(), *[pa.string()] * 3), strict=True)], ["_key", "n", "last", "left", "body", "right"])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(proto.value)
        for batch in batches:
            rows = batch.to_pylist()
            found = [pieces.transfer(r["left"], r["body"], r["right"], r["n"] == 0, r["last"]) for r in rows]
            cells = [batch.column("_key"), batch.column("n"), pa.array([m.shape[1] for m in found], pa.int32()), pa.array([np.packbits(m == 0).tobytes() for m in found], pa.binary()), pa.array([m.shape[0] for m in found], pa.int32())]
            yield pa.RecordBatch.from_arrays(cells, ["_key", "n", "width", "live", "height"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, rows in zip(batch.column("_key").to_pylist(), batch.column("m").to_pylist(), strict=True):
                ms = [np.where(np.unpackbits(np.frombuffer(r["live"], np.uint8), count=r["width"] * r["height"]).reshape(r["height"], r["width"]), 0.0, NEVER) for r in rows]
                at = chosen_states(ms)
                n = len(ms)
                yield pa.RecordBatch.from_arrays([pa.array([key] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array([0, *at], pa.int32()), pa.array([*at, 0], pa.int32())], ["_key", "n", "entry", "leave"])

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(proto.value)
        for batch in batches:
            found = [pieces.traced(r["left"], r["body"], r["right"], r["n"] == 0, r["last"], r["entry"], r["leave"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("n"), lists(found)], ["_key", "n", "ids"])

    plain = rows.where(~giant).mapInArrow(small, fields + ", ids array<int>")
    large = rows.where(giant).withColumn("_key", F.sha2(F.col("text").cast("binary"), 256))
    parts = cut(large.select("_key", "text").dropDuplicates(["_key"]).mapInArrow(chunks, "_key string, n int, last boolean, left string, body string, right string").repartition("_key", "n"), "chunks")
    live = parts.mapInArrow(matrices, "_key string, n int, width int, live binary, height int")
    live = live.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("n", "width", "live", "height"))).alias("m"))
    ends = live.mapInArrow(choose, "_key string, n int, entry int, leave int")
    traced = parts.join(ends, ["_key", "n"]).mapInArrow(trace, "_key string, n int, ids array<int>")
    joined = traced.groupBy("_key").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("n", "ids"))), lambda x: x["ids"])).alias("ids"))
    return unpacked(plain.unionByName(large.join(joined, "_key").select("row", "ids")), names, ids=F.col("ids"))


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """Replaces ids by text. What encode() made comes back whole, but for the sign U+2581, which the model holds for a space. Null stays null."""
    spark = encoded.sparkSession
    with open(model, "rb") as f:
        proto = spark.sparkContext.broadcast(f.read())
    kept = [f for f in encoded.schema if f.name != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(proto.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [pieces.decode(x.values.to_numpy()) if x.is_valid else None for x in part.column("ids")]
                names = [f.name for f in kept]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(texts, pa.string())], [*names, "text"])

    return encoded.mapInArrow(run, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept) + "text string")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document, edge cases as in encode: n_tokens, ids_hash (XXH64 over the ids) and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.translate("text", SPACE, " ").cast("binary")).alias("text_md5"), "text")
    encoded = encode(docs).withColumns({"n_tokens": F.size("ids").cast("long"), "ids_hash": F.xxhash64("ids")})
    back = decode(encoded)
    same = F.md5(F.col("text").cast("binary")).eqNullSafe(F.col("text_md5"))
    return back.select("doc_id", "n_tokens", "ids_hash", same.alias("round_trip"))
