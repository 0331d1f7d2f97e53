"""Repair of conversation structure: the cheapest edits after which the roles read `(s?(ua)+)?`, by Hirschberg's divide and conquer.

Four states say what stands before a row: nothing (0), a system turn (1), a user's turn (2), an assistant's turn (3); a conversation may end in 0 and 3. A vector of four
costs, forward from a beginning or backward from an end, is all that is kept of any number of rows. A stretch of rows is split in the middle, where a forward
and a backward vector meet; the crossing states of least sum are optimal, of these the one on the audit-least path is chosen, and both halves are solved alike. A state and an
audit letter fix the next state, so an audit is one path, and the least letter first is the least audit.

Rows are sorted once, over all conversations together, and cut into chunks of at most `chunk` rows of one conversation, so a conversation of any length is many tasks' work. The
same meeting of vectors goes on above the chunks: a chunk is a matrix of four by four costs, `fan` matrices of a conversation make one, and so on up; then the backward vectors go
down to each chunk, the state that each chunk is entered with follows by tables of four states, again up and down, and each chunk is solved by itself. Only the digest of a repaired
conversation reads its texts in order, as SHA-256 must; it holds one row at a time.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import cut, done_with, table

CHUNK = 1 << 11
FAN = 1 << 9
BLANK_CHARS = r"[\x20\x09-\x0D]"
NEVER = 1 << 60
#: What an initial leads to from each state when it is kept, -1 where it may not stand.
_AFTER = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
#: What a turn that the repair chooses itself leads to: a user's turn, or an assistant's after a user's.
_CHOSEN = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_LEGAL = ("su", "ua", "au")


class Costs(NamedTuple):
    """What edits cost. With the standing costs an insert never pays: dropping the row it is to complete costs less."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Row(NamedTuple):
    initial: str
    must_go: bool
    truncated: bool


Vector = tuple[int, int, int, int]


def _least(v: list[int], costs: Costs) -> Vector:
    """Costs to go when any number of inserts may come first: three from one state reach every state there is a use for."""
    out = list(v)
    for _ in range(3):
        out = [min(out[s], costs.insert + out[_CHOSEN[s]]) for s in range(4)]
    return tuple(min(x, NEVER) for x in out)


def end_vector(costs: Costs) -> Vector:
    return _least([0, NEVER, NEVER, 0], costs)


@functools.cache
def _moves(row: Row, s: int, costs: Costs) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row, least letter first."""
    out = [("D", costs.delete, s)]
    if not row.must_go:
        more = costs.truncated if row.truncated else 0
        if row.initial in _AFTER and _AFTER[row.initial][s] >= 0:
            out.append(("K", more, _AFTER[row.initial][s]))
        out.append(("R", costs.rerole + more, _CHOSEN[s]))
    return out


def backward(rows: list[Row], v: Vector, costs: Costs) -> Vector:
    """Costs to go before rows, of the costs to go after them."""
    for row in reversed(rows):
        v = _least([min(c + v[t] for _, c, t in _moves(row, s, costs)) for s in range(4)], costs)
    return v


def forward(rows: list[Row], v: Vector, costs: Costs) -> Vector:
    """Costs so far after rows, of the costs so far before them."""
    for row in rows:
        out, start = [NEVER] * 4, list(v)
        for _ in range(3):
            for s in range(4):
                start[_CHOSEN[s]] = min(start[_CHOSEN[s]], start[s] + costs.insert)
        for s in range(4):
            for _, c, t in _moves(row, s, costs):
                out[t] = min(out[t], start[s] + c)
        v = tuple(min(x, NEVER) for x in out)
    return v


def matrix(rows: list[Row], costs: Costs) -> list[Vector]:
    """For each state after rows, the costs from each state before them."""
    return [backward(rows, tuple(0 if s == t else NEVER for s in range(4)), costs) for t in range(4)]


def times(m: list[Vector], v: Vector) -> Vector:
    return tuple(min(NEVER, min(m[t][s] + v[t] for t in range(4))) for s in range(4))


def _one(row: Row, s: int, v: Vector, costs: Costs) -> tuple[str, int]:
    """The least letters of a row, inserts before it included, and the state after it."""
    letters, went = "", _least([min(c + v[t] for _, c, t in _moves(row, x, costs)) for x in range(4)], costs)
    while True:
        found = [(letter, t) for letter, c, t in _moves(row, s, costs) if c + v[t] == went[s]]
        if costs.insert + went[_CHOSEN[s]] == went[s] and (not found or found[0][0] > "I"):
            letters, s = letters + "I", _CHOSEN[s]
            continue
        return letters + found[0][0], found[0][1]


def solve(rows: list[Row], s: int, v: Vector, costs: Costs) -> tuple[list[str], int]:
    """The letters of each row on the audit-least of the cheapest paths from state s to the costs v after the last row, and the state there."""
    if len(rows) == 1:
        letters, t = _one(rows[0], s, v, costs)
        return [letters], t
    mid = len(rows) // 2
    to_come = backward(rows[mid:], v, costs)
    so_far = forward(rows[:mid], tuple(0 if x == s else NEVER for x in range(4)), costs)
    best = min(a + b for a, b in zip(so_far, to_come, strict=True))
    crossings = tuple(b if a + b == best else NEVER for a, b in zip(so_far, to_come, strict=True))
    left, s = solve(rows[:mid], s, crossings, costs)
    right, s = solve(rows[mid:], s, v, costs)
    return left + right, s


def tail(s: int, costs: Costs) -> tuple[str, int]:
    """Inserts after the last row."""
    letters, v = "", end_vector(costs)
    while s not in (0, 3) or v[s]:
        letters, s = letters + "I", _CHOSEN[s]
    return letters, s


# ---- on Spark ----


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows after the damage that crc32 of `conv_id:turn` asks for; nulls count as one space there, in roles and in texts."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(as_text("text"), "[.!?]", "")).otherwise(as_text("text"))
    role = F.when(kind == 4, "user").otherwise(as_text("role"))
    rows = conversations.where(kind != 0)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def ordered(rows: DataFrame) -> DataFrame:
    """A written table of rows(conv_id, turn, role, text, copies) with equal rows as one, in order: by turn, nulls first, then role and text. `o` counts on in that order.

    fault is the first of blank, duplicate, truncated that the row has. Of `copies` equal rows all but the first are duplicates, or blank like it.
    """
    spark = rows.sparkSession
    by_turn = lambda: F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    rows = cut(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("digest", F.sha2(F.concat_ws("\x00", "role", "text"), 256)), "turns")
    first = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest")).agg(F.min(by_turn()).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = cut(first.select("_conv", "_digest", "first"), "first")
    found = rows.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    blank = F.regexp_replace("text", BLANK_CHARS, "") == ""
    again = F.coalesce(F.col("first") != by_turn(), F.lit(False))
    short = ~F.regexp_replace("text", BLANK_CHARS + r"+\z", "").rlike(r"[.!?]\z")
    fault = F.when(blank, "b").when(again, "d").when(short, "t").otherwise("")
    initial = F.substring("role", 1, 1)
    found = found.select("conv_id", "turn", "role", "text", "copies", initial.alias("initial"), fault.alias("fault"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    found = cut(found, "faults")
    out = cut(found.repartitionByRange(n, *key).sortWithinPartitions(*key).withColumn("o", F.monotonically_increasing_id()), "ordered")
    done_with(rows, first, found)
    return out


_LEAF = "array<struct<o:bigint,initial:string,fault:string,copies:bigint>>"


def _rows(chunk: list[dict]) -> list[Row]:
    return [Row(r["initial"] if r["initial"] in _AFTER else "", r["fault"] in ("b", "d"), r["fault"] == "t") for r in chunk]


def _per_row(df: DataFrame, keep: list[str], f: Callable[[dict], dict], schema: str) -> DataFrame:
    """f's values of each row beside the columns in keep, in Arrow batches."""
    names = [x.strip().split(":")[0].split(" ")[0] for x in schema.split(";")]
    full = ", ".join([f"{c} {t}" for c, t in df.dtypes if c in keep] + [x.strip() for x in schema.split(";")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(types[n].dataType) for n in names]
        for batch in batches:
            found = [f(r) for r in batch.to_pylist()]
            at = [batch.schema.get_field_index(c) for c, _ in order]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in at], *[pa.array([x[n] for x in found], k) for n, k in zip(names, kinds, strict=True)]], [*[c for c, _ in order], *names])

    from pyspark.sql.types import _parse_datatype_string

    types = {x.name: x for x in _parse_datatype_string(full).fields}
    order = [(c, t) for c, t in df.dtypes if c in keep]
    return df.mapInArrow(run, full)


def _groups(df: DataFrame, value: str, fan: int) -> DataFrame:
    """(conv_id, up, parts): what stands under each key of the level above, in order; at most fan parts in one."""
    up = F.floor(F.col("chunk") / fan).cast("long")
    return df.groupBy("conv_id", up.alias("up")).agg(F.array_sort(F.collect_list(F.struct("chunk", value))).alias("parts"))


def _several(df: DataFrame) -> bool:
    """Whether a conversation has more than one row."""
    return not df.groupBy("conv_id").count().where("count > 1").isEmpty()


def _same_place(a: DataFrame, b: DataFrame) -> DataFrame:
    b = b.withColumnRenamed("conv_id", "_conv").withColumnRenamed("chunk", "_chunk")
    return a.join(b, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("up") == F.col("_chunk")), "left").drop("_conv", "_chunk")


def costs_to_go(chunks: DataFrame, costs: Costs, fan: int) -> DataFrame:
    """(conv_id, chunk, to_go) of chunks(conv_id, chunk, m): the backward vector after each chunk. Matrices of `fan` chunks make the next level's, whose vectors come down again."""
    groups = cut(_groups(chunks, "m", fan), "up")
    used = [groups]
    last = list(end_vector(costs))
    if _several(groups):
        def product(r: dict) -> dict:
            columns = [tuple(0 if s == t else NEVER for s in range(4)) for t in range(4)]
            for p in reversed(r["parts"]):
                columns = [times(p["m"], v) for v in columns]
            return {"m": columns}

        above = costs_to_go(_per_row(groups, ["conv_id", "up"], product, "m array<array<bigint>>").withColumnRenamed("up", "chunk"), costs, fan)
        groups = _same_place(groups, above)
        used.append(above)
    else:
        groups = groups.withColumn("to_go", F.lit(None).cast("array<bigint>"))

    def down(r: dict) -> dict:
        v, out = tuple(r["to_go"] or last), []
        for p in reversed(r["parts"]):
            out.append({"chunk": p["chunk"], "to_go": list(v)})
            v = times(p["m"], v)
        return {"found": out}

    found = _per_row(groups, ["conv_id"], down, "found array<struct<chunk:bigint,to_go:array<bigint>>>")
    found = cut(found.select("conv_id", F.explode("found").alias("f")).select("conv_id", "f.chunk", "f.to_go"), "to_go")
    done_with(*used)
    return found


def entries(chunks: DataFrame, fan: int) -> DataFrame:
    """(conv_id, chunk, entry) of chunks(conv_id, chunk, leads): the state that each chunk is entered with, given the state that it leads to from each."""
    groups = cut(_groups(chunks, "leads", fan), "up")
    used = [groups]
    if _several(groups):
        def product(r: dict) -> dict:
            at = [0, 1, 2, 3]
            for p in r["parts"]:
                at = [p["leads"][s] for s in at]
            return {"leads": at}

        above = entries(_per_row(groups, ["conv_id", "up"], product, "leads array<int>").withColumnRenamed("up", "chunk"), fan)
        groups = _same_place(groups, above)
        used.append(above)
    else:
        groups = groups.withColumn("entry", F.lit(0))

    def down(r: dict) -> dict:
        s, out = r["entry"], []
        for p in r["parts"]:
            out.append({"chunk": p["chunk"], "entry": s})
            s = p["leads"][s]
        return {"found": out}

    found = _per_row(groups, ["conv_id"], down, "found array<struct<chunk:bigint,entry:int>>")
    found = cut(found.select("conv_id", F.explode("found").alias("f")).select("conv_id", "f.chunk", "f.entry"), "entries")
    done_with(*used)
    return found


def _beside(chunks: DataFrame, more: DataFrame) -> DataFrame:
    more = more.withColumnRenamed("conv_id", "_conv").withColumnRenamed("chunk", "_chunk")
    return chunks.join(more, (F.col("chunk") == F.col("_chunk")) & F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv", "_chunk")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the `role:text` lines of each conversation of a partition sorted by it."""
    at, state, out = object(), None, []
    for batch in batches:
        for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")], strict=True):
            if state is None or conv != at:
                if state is not None:
                    out.append((at, state.hexdigest()))
                at, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        yield _pairs(out)
        out = []
    if state is not None:
        yield _pairs([(at, state.hexdigest())])


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["conv_id", "repaired_sha256"])


def repair(rows: DataFrame, costs: Costs = Costs(), chunk: int = CHUNK, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Repairs rows(conv_id, turn, role, text, copies), roles and texts not null: (a row per conversation, the repaired turns).

    The first has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; the second conv_id, o, at, role, text, in order of conv_id, o, at, inserted turns with empty texts.
    Rows of one conversation stand by turn, nulls first, ties by role and text; of repeated rows the first counts. A null conv_id is a conversation of its own. A role that starts
    neither with s, u nor a can only be rerolled or deleted. Texts may be of any length. A table without rows gives none.
    """
    table_ = ordered(rows)
    part, place = F.shiftright("o", 33), F.col("o").bitwiseAND((1 << 33) - 1)
    in_part = (table_.agg(F.max(place)).first()[0] or 0) // chunk + 1  # chunks that a partition of the order may have
    leaf = F.array_sort(F.collect_list(F.struct("o", "initial", "fault", "copies")))
    leaves = cut(table_.groupBy("conv_id", (part * in_part + F.floor(place / chunk)).cast("long").alias("chunk")).agg(leaf.alias("rows")), "chunks")
    ends = leaves.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("chunk").alias("_first"), F.max("chunk").alias("_last"))
    counted = leaves.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")))
    leaves, unnumbered = cut(counted.select("conv_id", (F.col("chunk") - F.col("_first")).alias("chunk"), "rows", (F.col("chunk") == F.col("_last")).alias("is_last")), "leaves"), leaves

    def tally(r: dict) -> dict:
        rows_, bad, before = r["rows"], 0, None
        for x in rows_:
            bad += (before is not None and before + x["initial"] not in _LEGAL) + x["copies"] - 1  # a role never follows itself
            before = x["initial"]
        n = {f: sum(x["copies"] if f == "b" else 1 for x in rows_ if x["fault"] == f) for f in "bdt"}
        n["d"] += sum(x["copies"] - 1 for x in rows_ if x["fault"] != "b")
        again = costs.delete * sum(x["copies"] - 1 for x in rows_)
        return {"m": matrix(_rows(rows_), costs), "again": again, "blank": n["b"], "duplicate": n["d"], "truncated": n["t"], "bad": bad, "first": rows_[0]["initial"], "last": before}

    made = cut(_per_row(leaves, ["conv_id", "chunk"], tally, "m array<array<bigint>>; again bigint; blank bigint; duplicate bigint; truncated bigint; bad bigint; first string; last string"), "matrices")
    to_go = costs_to_go(made.select("conv_id", "chunk", "m"), costs, fan)

    def leads(r: dict) -> dict:
        if r["is_last"]:  # nothing is entered from it
            return {"leads": [0, 1, 2, 3]}
        rows_, v = _rows(r["rows"]), tuple(r["to_go"])
        before = backward(rows_, v, costs)
        return {"leads": [solve(rows_, s, v, costs)[1] if before[s] < NEVER else s for s in range(4)]}

    known = cut(_beside(leaves, to_go), "known")
    entry = entries(_per_row(known, ["conv_id", "chunk"], leads, "leads array<int>"), fan)

    def letters(r: dict) -> dict:
        rows_, v, s = _rows(r["rows"]), tuple(r["to_go"]), r["entry"]
        steps, out, audit = solve(rows_, s, v, costs)[0], [], []
        for x, row, step in zip(r["rows"], rows_, steps, strict=True):
            for i, letter in enumerate(step):
                if letter == "K":
                    s = _AFTER[row.initial][s]
                elif letter != "D":
                    s = _CHOSEN[s]
                if letter != "D":
                    out.append({"o": x["o"], "at": i, "letter": letter, "role": _ROLE.get(s) if letter != "K" else None})
            audit.append(step + "D" * (x["copies"] - 1))
        ends, t = tail(s, costs) if r["is_last"] else ("", s)
        for i, _ in enumerate(ends):
            s = _CHOSEN[s]
            out.append({"o": r["rows"][-1]["o"], "at": len(steps[-1]) + i, "letter": "I", "role": _ROLE[s]})
        return {"audit": "".join(audit) + ends, "turns": out}

    solved = cut(_per_row(_beside(known, entry), ["conv_id", "chunk"], letters, "audit string; turns array<struct<o:bigint,at:int,letter:string,role:string>>"), "solved")

    turns = solved.select("conv_id", F.explode("turns").alias("t")).select(F.col("conv_id"), F.col("t.o").alias("_o"), "t.at", "t.letter", F.col("t.role").alias("new_role"))
    texts = table_.select("o", "role", "text")
    repaired = turns.join(texts, F.col("_o") == F.col("o")).select(
        "conv_id", "o", "at", F.coalesce("new_role", "role").alias("role"), F.when(F.col("letter") == "I", "").otherwise(F.col("text")).alias("text")
    )
    # the seams between chunks: the last initial of one and the first of the next
    sums = _beside(made, solved.select("conv_id", "chunk", "audit"))
    parts = F.array_sort(F.collect_list(F.struct("chunk", "first", "last", "audit")))
    per = sums.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("again", "blank", "duplicate", "truncated", "bad")], parts.alias("parts"))
    seams = F.when(F.size("parts") > 1, F.size(F.filter(F.zip_with(F.slice("parts", 2, F.size("parts")), F.slice("parts", 1, F.size("parts") - 1), lambda b, a: F.concat(a["last"], b["first"])), lambda p: ~p.isin(*_LEGAL)))).otherwise(0)
    per = per.withColumn("audit", F.concat_ws("", F.transform("parts", lambda p: p["audit"]))).withColumn("illegal", F.col("bad") + seams)
    whole = F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda t: F.get(F.get("m", t), F.lit(0)) + F.get("to_go", t)))
    first = _beside(made, to_go).where("chunk = 0").select(F.col("conv_id").alias("_conv"), whole.alias("least"))
    gaps = table_.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")).withColumnRenamed("conv_id", "_conv2")
    per = per.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).join(gaps, F.col("conv_id").eqNullSafe(F.col("_conv2")))
    report = per.select(
        "conv_id", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", F.col("illegal").cast("long").alias("illegal"), (F.col("least") + F.col("again")).alias("cost"), "audit"
    )
    report, repaired = cut(report, "report"), cut(repaired, "repaired")
    done_with(table_, unnumbered, leaves, made, to_go, known, entry, solved)
    return report, repaired


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired turns, each conversation's texts read in order by one task that holds a row at a time."""
    rows = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "o", "at").select("conv_id", "role", "text")
    return rows.mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def conversation_repair(conversations: DataFrame, costs: Costs = Costs(), chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """Damages conversations(conv_id, turn, role, text) as `damaged` says, repairs them and reports on each conv_id: its gaps, faults, illegal neighbours, cost, audit and the digest of what is left.

    Every conv_id of the input has a row, null included; one without rows after the damage has zeros, an empty audit and the digest of the empty string. Edge cases as in repair;
    columns beside the four are not read, so their names don't matter.
    """
    report, repaired = repair(damaged(conversations), costs, chunk, fan)
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    report = report.withColumnRenamed("conv_id", "_conv")
    found = digests(repaired).select(F.col("conv_id").alias("_of"), "repaired_sha256")
    out = every.join(report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").join(found, F.col("conv_id").eqNullSafe(F.col("_of")), "left")
    counts: list[Column] = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repair of all conversations; edge cases as in conversation_repair."""
    return conversation_repair(table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t FROM range(256) x(b)
), raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), kinds AS (
  SELECT raw.*, xor(list_reduce(list_transform(string_split(key, ''), lambda x: ord(x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind FROM raw, crc_table
), dam AS (
  SELECT row_number() OVER () AS u, conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) copies WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, u) AS p,
    count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, u) AS seen, left(role, 1) AS i FROM dam
), r AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
    lag(i) OVER (PARTITION BY conv_id ORDER BY p) AS prev FROM placed
), states(s) AS (SELECT unnest(range(4))),
moves AS (  -- inserts never pay, so each row has one letter
  SELECT conv_id, p, s, 'D' AS letter, 2 AS c, s AS t FROM r, states
  UNION ALL SELECT conv_id, p, s, 'K', CASE fault WHEN 't' THEN 5 ELSE 0 END, CASE i WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END FROM r, states
    WHERE fault NOT IN ('b', 'd') AND ((i = 's' AND s = 0) OR (i = 'u' AND s <> 2) OR (i = 'a' AND s = 2))
  UNION ALL SELECT conv_id, p, s, 'R', CASE fault WHEN 't' THEN 6 ELSE 1 END, CASE s WHEN 2 THEN 3 ELSE 2 END FROM r, states WHERE fault NOT IN ('b', 'd')
), dp AS (
  SELECT conv_id, n AS p, s, CASE s WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END AS c, CASE s WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit FROM (SELECT DISTINCT conv_id, n FROM r), states
  UNION ALL
  SELECT conv_id, p, s, best.c, best.audit FROM (
    SELECT d.conv_id, d.p - 1 AS p, m.s, min({c: m.c + d.c, audit: m.letter || d.audit}) AS best FROM dp d JOIN moves m ON m.conv_id IS NOT DISTINCT FROM d.conv_id AND m.p = d.p AND m.t = d.s GROUP BY ALL)
), best AS (SELECT conv_id, c, audit FROM dp WHERE p = 0 AND s = 0),
kept AS (
  SELECT r.conv_id, r.p, r.role, r.text, substr(audit, r.p, 1) AS letter, row_number() OVER (PARTITION BY r.conv_id ORDER BY r.p) AS k,
    max(CASE WHEN substr(audit, r.p, 1) = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY r.conv_id) AS has_s
  FROM r JOIN best ON best.conv_id IS NOT DISTINCT FROM r.conv_id WHERE substr(audit, r.p, 1) <> 'D'
), out AS (
  SELECT conv_id, string_agg(CASE letter WHEN 'K' THEN role ELSE CASE WHEN (k - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || text, chr(10) ORDER BY p) AS repaired FROM kept GROUP BY 1
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
    count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE prev IS NOT NULL AND prev || i NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY 1
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN out ON out.conv_id IS NOT DISTINCT FROM c.conv_id
"""
