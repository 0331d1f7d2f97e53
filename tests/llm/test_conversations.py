"""Conversation repair against all edits tried one by one, in one chunk and in many."""

import hashlib
import random
import re
import zlib

import pytest

from cardloom.llm.conversations import Costs, Row, backward, conversation_repair, end_vector, solve, tail

SCHEMA = "conv_id long, turn long, role string, text string, o long, chunk long, m int"
ROLES = ["user", "assistant", "system", "tool", "", None]
TEXTS = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Yes. \t", "ends oddly ", None, "a.b", "é." * 3]


def brute(rows, costs):
    """(cost, audit) of the least edits, by all paths: every state after every row, with all audits of least cost."""
    best = {("",): (0, "")}
    best = {"": [(0, "")]}  # role initials so far, reduced to what may follow
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def inserts(found):
        out = {k: list(v) for k, v in found.items()}
        for _ in range(3):
            for k in list(out):
                for c, a in list(out[k]):
                    for x, t in after[k].items():
                        if x != "s" and len(a) < len(rows) + 3:
                            out.setdefault(t, []).append((c + costs.insert, a + "I"))
            out = {k: [x for x in sorted(set(v)) if x[0] <= min(v)[0] + 12][:60] for k, v in out.items()}
        return out

    for initial, must_go, truncated in rows:
        out = {}
        for k, found in inserts(best).items():
            for c, a in found:
                out.setdefault(k, []).append((c + costs.delete, a + "D"))
                if not must_go:
                    more = costs.truncated if truncated else 0
                    if initial in after[k]:
                        out.setdefault(after[k][initial], []).append((c + more, a + "K"))
                    for x, t in after[k].items():
                        if x != "s":
                            out.setdefault(t, []).append((c + more + costs.rerole, a + "R"))
        best = out
    ends = inserts(best)
    return min(x for k in ("", "a") for x in ends.get(k, []))


@pytest.mark.parametrize("costs", [Costs(), Costs(insert=1, delete=2), Costs(rerole=2, delete=1, insert=2, truncated=1)])
def test_hirschberg_finds_the_audit_least_of_the_cheapest(costs):
    rng = random.Random(5)
    for _ in range(60):
        rows = [Row(rng.choice(["s", "u", "a", ""]), rng.random() < 0.15, rng.random() < 0.3) for _ in range(rng.randint(1, 6))]
        v = end_vector(costs)
        letters, s = solve(rows, 0, v, costs)
        assert (backward(rows, v, costs)[0], "".join(letters) + tail(s, costs)[0]) == brute(rows, costs)


def plain(conv):
    """The contract's row of one conversation, from its rows as they were."""
    rows = []
    for conv_id, turn, role, text in conv:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [r[0] for r in rows if r[0] is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = brute([(r[1][:1] if r[1][:1] in "sua" else "", f in ("b", "d"), f == "t") for r, f in zip(rows, faults, strict=True)], Costs()) if rows else (0, "")
    kept, n = [], 0
    for (_, role, text), letter in zip(rows, audit, strict=True):
        if letter != "D":
            system = letter == "K" and role[:1] == "s"
            kept.append(f"{role if letter == 'K' else ['user', 'assistant'][n % 2]}:{text}")
            n += not system
    initials = [r[1][:1] for r in rows]
    return {
        "conv_id": conv[0][0],
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{k: faults.count(k[0]) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest(),
    }


@pytest.mark.parametrize("chunk,fan", [(2048, 512), (3, 8)])
def test_whole_conversations_in_any_chunks(spark, chunk, fan):
    rng = random.Random(11)
    rows = []
    for conv in [*range(14), None]:
        for _ in range(rng.randint(1, 16)):
            rows.append((conv, rng.choice([None, *range(12)]), rng.choice(ROLES), rng.choice(TEXTS), 1, 2, 3))
    rows += [(20, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.", 1, 2, 3) for t in range(12)]
    rows += [(21, 4, "user", "Same.", 1, 2, 3)] * 9  # repeated rows
    rows += [(22, t, "user", "x" * 200_000 + ".", 1, 2, 3) for t in (1, 2)]
    lost = next(i for i in range(1000, 5000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "Gone.", 1, 2, 3))
    got = conversation_repair(spark.createDataFrame(rows, SCHEMA), chunk=chunk, fan=fan).toArrow().to_pylist()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r[:4])
    key = lambda r: (r["conv_id"] is None, r["conv_id"] or 0)
    assert sorted(got, key=key) == sorted(map(plain, by.values()), key=key)


def test_no_rows(spark):
    assert conversation_repair(spark.createDataFrame([], SCHEMA)).collect() == []
