from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from finledger.llm import queries, repair

ROLES = {"s": 0, "u": 1, "a": 2}
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        said = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(said.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def plain(original, rows):
    """Every conversation by itself, least (cost, audit) from the end for each row and state; audits are compared whole."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    out = []
    for conv in {r[0] for r in original}:
        own = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in own:
            bare = re.sub("[\x20\x09-\x0d]+$", "", text)
            faults.append(2 if not bare else 3 if (role, text) in seen else 0 if bare[-1] in ".!?" else 1)
            seen.add((role, text))
        n = len(own)
        nothing = (10**9, "", ())
        best = [[nothing] * 4 for _ in range(n + 1)]
        for i in range(n, -1, -1):
            for s in range(4):
                found = [(0, "", ())] if i == n and s in (0, 3) else []
                if i < n:
                    c, a, p = best[i + 1][s]
                    found.append((c + 3, "D" + a, p))
                    if faults[i] < 2:
                        extra = faults[i] == 1
                        role, text = own[i][2:]
                        kind = role[:1]
                        into = 1 if kind == "s" and s == 0 else 2 if kind == "u" and s != 2 else 3 if kind == "a" and s == 2 else 0
                        if into:
                            c, a, p = best[i + 1][into]
                            found.append((c + extra, "K" + a, (f"{role}:{text}", *p)))
                        to = 3 if s == 2 else 2
                        c, a, p = best[i + 1][to]
                        found.append((c + 2 + extra, "R" + a, (f"{('user', 'assistant')[to - 2]}:{text}", *p)))
                best[i][s] = min(found, default=nothing, key=lambda x: x[:2])
            for _ in range(3):
                for s in range(4):
                    to = 3 if s == 2 else 2
                    c, a, p = best[i][to]
                    best[i][s] = min(best[i][s], (c + 2, "I" + a, (f"{('user', 'assistant')[to - 2]}:", *p)), key=lambda x: x[:2])
        cost, audit, lines = best[0][0]
        initials = [r[2][:1] for r in own]
        turns = [r[1] for r in own if r[1] is not None]
        gap = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gap, faults.count(2), faults.count(3), faults.count(1), illegal, cost, audit, sha))
    return sorted(out, key=repr)


def reported(spark, original, rows, **options):
    rows = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", edits string")
    found = repair.report(spark.createDataFrame(original, SCHEMA), rows, repair.edited(rows, **options))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def noise(count, longest, seed):
    rng = random.Random(seed)
    texts = ["", " \t", "Yes.", "No", "Why?\n", "ok!", "so", "x."]
    roles = ["system", "user", "assistant", "tool", "", "user", "assistant"]
    rows = []
    for conv in range(count):
        for turn in range(rng.randrange(1, longest)):
            text = rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}{rng.choice(['.', '', '!'])}"
            rows.append((conv, turn * rng.choice([1, 1, 2]), rng.choice(roles), text))
    return rows


def test_query_against_brute_force(spark, data_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.QUERIES["op13_turn_repair"](spark, data_dir)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found.columns == names
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows, damage(rows))


@pytest.mark.parametrize("block_rows", [1, 3, 512])
def test_blocks_of_any_size(spark, block_rows):
    rows = noise(60, 14, block_rows)
    assert reported(spark, rows, rows, block_rows=block_rows) == plain(rows, rows)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(5)
    rows = noise(5, 9, 1) + [(77, i, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"{i}.", f"{i}!"])) for i in range(3000)]
    assert reported(spark, rows, rows, block_rows=64) == plain(rows, rows)


def test_odd_rows(spark):
    original = [
        (1, None, "user", "a."), (1, None, None, None), (1, 3, "assistant", "b"), (None, 0, "system", "s."), (None, 1, "user", "q?"),
        (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 5, "assistant", "same."), (3, 0, "system", "only."),
        (4, 0, "user", "x" * 300000 + "."), (4, 9, "assistant", "é\x0b"), (5, None, "tool", "t."), (6, 0, "user", ""),
    ]
    rows = [(a, b, c if c is not None else " ", d if d is not None else " ") for a, b, c, d in original if a != 6]
    assert reported(spark, original, rows, block_rows=2) == plain(original, rows)
    assert reported(spark, [], []) == []
    far = [(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")]
    assert reported(spark, far, far)[0][1] == 0  # beyond longs: nothing is counted


def test_damage_and_repaired_turns(spark):
    rows = [(i % 7, i, "assistant", f"{i}. a!?") for i in range(200)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in repair.damaged(df).collect()), key=repr)
    assert got == sorted(damage(rows), key=repr)
    edits = repair.edited(repair.damaged(df))
    turns = repair.repaired(edits).orderBy("conv_id", "part", "block", "place").collect()
    by = defaultdict(str)
    for r in turns:
        by[r.conv_id] += r.role[:1]
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in by.values()) and len(by) >= 7


def test_ranks_of_arcs():
    """Deleting and re-inserting cost more than keeping; of equal costs the audit that comes first in ASCII order."""
    codes = np.array([1, 1, 2], dtype=np.uint8)  # u u a
    exits, audits = repair.least_paths([codes], np.zeros((1, 4)), np.array([True]))
    assert audits[0][0] == b"KIKK" and exits[0, 0] == -1
    whole = repair.matrices([codes])[0]
    parts = repair.matrices([codes[:1], codes[1:]])
    assert np.array_equal(whole, (parts[0][:, :, None] + parts[1][None]).min(axis=1))
