import hashlib
import itertools
import random
from zlib import crc32

import numpy as np
import pytest

from millrace.llm import conversation_repair as g
from millrace.llm import queries
from millrace.operators import series

FOLDER = "/root/testdata/sf0.01"
STATES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        rest = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain(rows):
    """The cheapest edits by carrying (cost, letters, turns) forward for each state; rows: (turn, role, text) in order."""
    found = faults([r[1:] for r in rows])
    due = lambda s: "assistant" if s == "u" else "user"
    ways = {"": (0, "", ())}

    def better(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def insert(ways):
        for _ in range(3):
            for s, (c, e, t) in list(ways.items()):
                better(ways, due(s)[0], (c + 2, e + "I", (*t, due(s) + ":")))

    for (_, role, text), fault in zip(rows, found):
        insert(ways)
        after = {}
        for s, (c, e, t) in ways.items():
            better(after, s, (c + 3, e + "D", t))
            if fault in ("blank", "duplicate"):
                continue
            more = c + (fault == "truncated")
            if (s, role[:1]) in STATES:
                better(after, role[0], (more, e + "K", (*t, f"{role}:{text}")))
            better(after, due(s)[0], (more + 2, e + "R", (*t, f"{due(s)}:{text}")))
        ways = after
    insert(ways)
    cost, audit, turns = min(ways[s][:2] + (ways[s][2],) for s in ("", "a") if s in ways)
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [found.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest())


def order(row):
    return (row[0] is not None, row[0] or 0, row[1], row[2])


def conversations(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(t, key=order) for c, t in out.items()}


def shown(df, name="conv"):
    return {r[name]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def some_rows(seed, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        n = rng.randint(1, longest) if conv % 10 else longest
        for turn in range(n):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]) if rng.random() < 0.5 else ("user", "assistant")[turn % 2]
            text = rng.choice(["", " ", "yes.", "no.", "cut", "a. b ", "x!"]) if rng.random() < 0.5 else f"turn {conv} {turn}."
            rows.append((conv, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 2]), role, text))
    return rows


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = shown(queries.op11_conversation_repair(spark, FOLDER), "conv_id")
    left = conversations(damaged(rows))
    assert got == {c: plain(left.get(c, [])) for c in {r[0] for r in rows}}
    assert sum(v[5] for v in got.values()) > 0


@pytest.mark.parametrize("longest,bits,cut", [(9, 6, False), (150, 2, False), (150, 3, True)])
def test_blocks_equal_plain_version(spark, monkeypatch, longest, bits, cut):
    monkeypatch.setattr(g, "LEAST_BITS", bits)
    monkeypatch.setattr(g, "isqrt", lambda n: 1)
    if cut:
        monkeypatch.setattr(series, "ROWS_PER_TASK", 40)
    rows = some_rows(longest + bits, longest)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert shown(g.repair(frame)) == {c: plain(t) for c, t in conversations(rows).items()}


def test_repaired_turns_are_sound(spark):
    rows = some_rows(3, 40)
    got = {}
    for r in g.repaired_turns(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.conv, []).append((r.place, r.edit, r.role, r.text))
    for conv, turns in conversations(rows).items():
        mine = sorted(got.get(conv, []))
        assert [m[0] for m in mine] == list(range(len(mine)))
        kinds = "".join(m[2][0] for m in mine)
        assert kinds.removeprefix("s") == "ua" * (len(kinds) // 2) and kinds != "s"
        want = plain(turns)
        assert hashlib.sha256("\n".join(f"{m[2]}:{m[3]}" for m in mine).encode()).hexdigest() == want[-1]
        assert "".join(m[1] for m in mine) == want[-2].replace("D", "")


def test_cheapest_edits_by_trying_all():
    """Every sequence of edits of up to three turns with up to three insertions."""
    due = {0: "u", 1: "u", 2: "a", 3: "u"}
    for kinds in itertools.chain.from_iterable(itertools.product("suax", repeat=n) for n in range(4)):
        for bad in itertools.product((g.SOUND, g.BLANK, g.TRUNCATED), repeat=len(kinds)):
            best = None
            for edits in itertools.chain.from_iterable(itertools.product("DIKR", repeat=n) for n in range(len(kinds) + 4)):
                if sum(e != "I" for e in edits) != len(kinds) or edits.count("I") > 3:
                    continue
                at = state = cost = 0
                for e in edits:
                    fault = bad[at] if e != "I" else 0
                    if e == "D":
                        cost += 3
                    elif e == "I":
                        cost, state = cost + 2, g.NEXT[state]
                    elif fault == g.BLANK or (e == "K" and not (kinds[at] == due[state] or kinds[at] == "s" and state == 0)):
                        break
                    else:
                        cost += (2 if e == "R" else 0) + (fault == g.TRUNCATED)
                        state = 1 if e == "K" and kinds[at] == "s" else g.NEXT[state]
                    at += e != "I"
                else:
                    if state in (0, 3) and (best is None or (cost, "".join(edits)) < best):
                        best = cost, "".join(edits)
            codes = bytes("suax".index(k) + 4 * f for k, f in zip(kinds, bad))
            state, edits = g.walk(codes, list(g.FINISH), [0])[0]
            edits += "I" * g.closing(state)
            cost = int((g.matrices([codes])[0] + np.array(g.FINISH)).min(1)[0]) if codes else g.FINISH[0]
            assert (cost, edits) == best


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "hello."), (1, None, "user", "a."), (1, None, "user", "a."), (1, 2, None, "b"),
        (2, 5, "assistant", "word " * 40_000), (2, 5, "assistant", "word " * 40_000), (3, 1, "", ""), (3, 1, "user", None), (4, 9, "sage", "漢字!"),
    ]
    frame = spark.createDataFrame([(*r, "c", 1, b"x") for r in rows], SCHEMA + ", conv string, block int, edits binary")
    assert shown(g.repair(frame)) == {c: plain(t) for c, t in conversations(rows).items()}
    assert g.repair(frame.limit(0)).count() == 0 and g.repaired_turns(frame.limit(0)).count() == 0
