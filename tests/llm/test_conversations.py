"""Operators on conversations against brute force that shares nothing with them."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from membervane.llm import prefixtrie, repair
from membervane.llm.queries import llm_queries

SF = "/root/testdata/sf0.001"
KINDS = "conv_id long, turn long, role string, text string"


def order(row):
    _, turn, role, text = row
    return turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest()


# 11


@cache
def cheapest(rows):
    """(cost, edits) of the rows ((initial or None if it must go, extra cost), ...), by trying every edit."""
    where = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def go(at, last, inserted):
        found = []
        if at == len(rows):
            if last in ("", "a"):
                found.append((0, ""))
        else:
            initial, extra = rows[at]
            options = [(3, "D", last)]
            if initial is not None:
                options += [(extra, "K", initial)] if initial in where[last] and initial else []
                options += [(2 + extra, "R", to) for to in "ua" if to in where[last]]
            for cost, letter, to in options:
                rest = go(at + 1, to, 0)
                found += [(cost + rest[0], letter + rest[1])] if rest else []
        for to in "ua":
            if to in where[last] and inserted < 4:
                rest = go(at, to, inserted + 1)
                found += [(2 + rest[0], "I" + rest[1])] if rest else []
        return min(found, default=None)

    return go(0, "", 0)


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        yield from [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)


def brute_audit(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, edits, hash) of a conversation."""
    rows = sorted(rows, key=order)
    counts, seen, shown = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        shown.append((None if fault in ("blank", "duplicate") else role[:1], int(fault == "truncated")))
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, edits = cheapest(tuple(shown))
    out, at = [], 0
    for letter in edits:
        if letter != "I":
            row = rows[at]
            at += 1
        if letter == "K":
            out.append((row[2], row[3]))
        elif letter != "D":
            out.append(("assistant" if out and out[-1][0][:1] == "u" else "user", row[3] if letter == "R" else ""))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    told = "\n".join(f"{r}:{t}" for r, t in out)
    return gaps, *counts.values(), illegal, cost, edits, hashlib.sha256(told.encode()).hexdigest(), out


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(5)
    texts = ["", " \n", "Yes.", "Why", "Why? ", "no!", "né.", "😀", None, "x " * 30_000]
    rows = []
    for conv in [None, *range(300)]:
        for turn in range(rng.randrange(1, 13)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "USER"])
            rows.append((conv, rng.choice([turn] * 6 + [None, 3, -2]), role, rng.choice(texts) if rng.random() < 0.6 else f"{rng.random()}."))
    return rows + rows[:7]


def test_repair(spark, conversations):
    df = spark.createDataFrame(conversations, KINDS).repartition(5)
    found = {r.conv_id: tuple(r)[1:] for r in repair.audit(repair.damage(df), df.select("conv_id")).collect()}
    want = {c: brute_audit([r for r in damaged(conversations) if r[0] == c]) for c in {r[0] for r in conversations}}
    assert found == {c: w[:-1] for c, w in want.items()}
    turns = repair.repaired_turns(repair.damage(df)).orderBy("conv_id", "place").collect()
    assert [(r.role, r.text) for r in turns if r.conv_id == 17] == want[17][-1]
    assert {c: [(r.role, r.text) for r in turns if r.conv_id == c] for c in want} == {c: w[-1] for c, w in want.items()}


def test_repair_of_a_long_conversation(spark):
    rng = random.Random(2)
    rows = [(1, k, rng.choice(["user", "assistant", "system"]), f"text {rng.randrange(900)}" + rng.choice(". ")) for k in range(3000)]
    found = repair.audit(spark.createDataFrame(rows, KINDS).repartition(4)).first()
    symbols = repair.tables()
    left = repair.LAST
    seen, shown = set(), []
    for _, _, role, text in rows:
        gone = (role, text) in seen
        seen.add((role, text))
        shown.append(repair.GONE if gone else 1 + "sua".index(role[0]) + 4 * (not text.endswith(".")))
    for symbol in reversed(shown):
        left = repair._before(symbol, left)
    assert found.cost == left[0] and len(found.audit) >= 3000 and len(symbols.vectors) < 256


def test_repair_tables_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        symbols = bytes(rng.randrange(9) for _ in range(rng.randrange(0, 13)))
        shown = tuple((None, 0) if s == 0 else (repair.ROWS[s - 1][0], repair.ROWS[s - 1][1]) for s in symbols)
        assert repair.tables().solve(symbols) == cheapest(shown)


@pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables are not there")
def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(*[c.split(" ")[0] for c in KINDS.split(", ")]).collect()]
    found = {r.conv_id: tuple(r)[1:] for r in llm_queries()["op11_structure_repair"](spark, SF).collect()}
    assert found == {c: brute_audit([r for r in damaged(rows) if r[0] == c])[:-1] for c in {r[0] for r in rows}}


def test_repair_of_nothing_and_clashing_columns(spark, conversations):
    df = spark.createDataFrame(conversations[:60], KINDS)
    assert repair.audit(df.where("false")).count() == repair.repaired_turns(df.where("false")).count() == 0
    more = df.withColumns({c: F.lit("own") for c in ("digest", "phase", "kind", "n", "is_blank", "is_open", "place", "cost", "_copy")})
    assert sorted(map(str, repair.audit(repair.damage(more)).collect())) == sorted(map(str, repair.audit(repair.damage(df)).collect()))
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    lost = spark.createDataFrame([(gone, 0, "user", "Hello.")], KINDS)
    assert tuple(repair.audit(repair.damage(lost), lost.select("conv_id")).first()) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# 13


def brute_trie(convs):
    """Nodes of conversations {id: [(role, text), ...]}, each subtree walked by itself."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out, parents = [], {v[:-1] for v in members if v}
    for node, ids in members.items():
        below = [u for u in members if u[: len(node)] == node]
        leaves = [u for u in below if u not in parents]
        saved = sum((len(members[u]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", u[-1][1])) for u in below if u)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        children = sum(bool(v) and v[:-1] == node for v in members)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), children, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def turns_in_order(rows):
    convs = {}
    for conv, turn, role, text in sorted(((c, t, r or "", x or "") for c, t, r, x in rows if c is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest())):
        convs.setdefault(conv, []).append((role, text))
    return convs


@pytest.fixture(scope="module")
def branching():
    rng = random.Random(9)
    rows = []
    for conv in [None, *range(-25, 90)]:
        stem = rng.choice([0, 1, 2])
        for turn in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 13])):
            text = f"stem {stem} {turn}" if rng.random() < 0.9 else rng.choice(["", None, "a b  c", "\t", "other words"])
            rows.append((conv, rng.choice([turn] * 9 + [None]), rng.choice(["user"] * 9 + [None, "assistant"]), text))
    rows += [(c, 0, "user", "alone") for c in range(101, 112)]  # nobody gives them a turn
    return rows + [(7, 0, "user", "long words " * 20_000), (7, 0, "user", "long words " * 20_000)]


def test_trie(spark, branching):
    df = spark.createDataFrame(branching, KINDS).repartition(4)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = prefixtrie.prefix_trie(df.withColumns({c: F.lit("own") for c in ("words", "digest", "place", "node", "before", "own", "total")}))
    convs = turns_in_order(branching)
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=str) == brute_trie(convs)
    shared = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        giver = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        shared[c] = convs.get(giver, [])[:h] + turns[h:]
    assert any(not turns for turns in shared.values())
    found = prefixtrie.trie(*prefixtrie.share_heads(prefixtrie.turns_of(df)))
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=str) == brute_trie(shared)


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], KINDS)
    assert prefixtrie.prefix_trie(empty).count() == prefixtrie.trie(*prefixtrie.share_heads(prefixtrie.turns_of(empty))).count() == 0
    none = prefixtrie.turns_of(empty)
    only = prefixtrie.trie(spark.createDataFrame([(5,), (3,)], "conv_id long"), none).collect()
    assert [tuple(r) for r in only] == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,5").hexdigest())]
