"""Conversation structure repair: cheapest edits by a cost DP, the least audit by prefix-doubling path ranking.

The turns of a conversation should be an optional system turn and then pairs of a user's and an assistant's turn. Turns
are kept (K), deleted (D) or given another role (R), and empty turns are inserted (I); the edits of least total cost
count, and among these the sequence whose letters, the audit, come first in ASCII order.

All turns are sorted by conversation and turn across tasks and cut into blocks of bounded size, so one conversation may
be as long as all others together. A block is summed up by the costs between its entry and exit states; these small
matrices are chained per conversation, which gives each block the costs that follow it. In a block the arcs on cheapest
paths are then ranked by their audits' first 1, 2, 4, ... letters: the rank of twice the length is the rank of the pair
(own rank, rank of the arc that the pointer reaches), and the pointers double with it. The ranks choose each node's arc,
and the doubled pointers unroll the least path. Chained exits tell where each block's path begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from finledger.session import materialise

BLANKS = " \t\n\x0b\x0c\r"
BLOCK_BYTES = 1 << 22
# Turns whose paths are unrolled side by side.
CELLS = 1 << 16

# States: nothing yet, after the system turn, after a user's turn, after an assistant's turn. A conversation may end in
# the first and the last. A new or renamed turn has the one role that may follow: the user's, or after it the assistant's.
FOLLOWS = np.array([2, 2, 3, 2])
KEEP_FROM = {0: (0,), 1: (0, 1, 3), 2: (2,)}  # system, user, assistant
KEEP_TO = {0: 1, 1: 2, 2: 3}
DELETE, INSERT, RENAME, TRUNCATED = 3, 2, 2, 1
LETTERS = b"\0DIKR"
FAULTS = [None, "truncated", "blank", "duplicate"]
END = 255
ENDED = np.array([0.0, np.inf, np.inf, 0.0])

EDITS = "array<struct<edit: string, fault: string, turn: long, was: string, role: string, text: string>>"


def cut_blocks(block_rows: int):
    """Sorted rows (conv, turn, role, text) to blocks of consecutive rows of a conversation: at most ``block_rows`` of
    them, and about ``BLOCK_BYTES`` of text. A code has the role's initial and the row's first fault as far as the block
    shows it; ``firsts`` has the places and digests of the rows that may repeat a row of an earlier block."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, size, names = pyspark.TaskContext.get().partitionId(), 0, 0, None
        current, rows, done = None, [], []

        def packed() -> pa.RecordBatch:
            convs, numbers, found = zip(*done, strict=True)
            coded = [_codes(r) for r in found]
            columns = [
                pa.array(convs, names),
                pa.array([part] * len(done), pa.int32()),
                pa.array(numbers, pa.int32()),
                pa.array([c for c, _ in coded], pa.binary()),
                pa.array([f for _, f in coded], pa.list_(pa.struct([("place", pa.int32()), ("digest", pa.binary())]))),
                pa.array([[r[0] for r in rows] for rows in found], pa.list_(pa.int64())),
                pa.array([[r[1] for r in rows] for rows in found], pa.list_(pa.string())),
                pa.array([[r[2] for r in rows] for rows in found], pa.list_(pa.string())),
            ]
            return pa.record_batch(columns, names=["conv", "part", "block", "codes", "firsts", "turns", "roles", "texts"])

        held = 0
        for batch in batches:
            names = batch.schema.field(0).type
            for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (conv != current or len(rows) >= block_rows or size > BLOCK_BYTES):
                    done.append((current, made, rows))
                    made, held, rows, size = made + 1, held + size + 64 * len(rows), [], 0
                    if held > BLOCK_BYTES:
                        yield packed()
                        done, held = [], 0
                current = conv
                rows.append((turn, role, text))
                size += len(text)
        if rows:
            done.append((current, made, rows))
        if done:
            yield packed()

    return of


def _codes(rows: list[tuple]) -> tuple[bytes, list[dict]]:
    codes, firsts, seen = bytearray(), [], set()
    for place, (_, role, text) in enumerate(rows):
        initial = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
        bare = text.rstrip(BLANKS)
        fault = 2
        if bare:
            digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            fault = 3 if digest in seen else 0 if bare[-1] in ".!?" else 1
            if digest not in seen:
                firsts.append({"place": place, "digest": digest})
                seen.add(digest)
        codes.append(initial + 4 * fault)
    return bytes(codes), firsts


def _with_repeats(codes: pa.Array, repeats: pa.Array) -> list[np.ndarray]:
    """Codes with what earlier blocks tell: the rows at the places ``repeats`` are duplicates."""
    out = []
    for own, places in zip(codes.to_pylist(), repeats.to_pylist(), strict=True):
        own = np.frombuffer(own, dtype=np.uint8).copy()
        if places:
            own[places] = own[places] % 4 + 12
        out.append(own)
    return out


def _inserted(base: np.ndarray) -> np.ndarray:
    """Costs to go where turns may be inserted first; the states are the second axis."""
    out = base.copy()
    out[:, 2] = np.minimum(base[:, 2], INSERT + base[:, 3])
    out[:, 3] = np.minimum(base[:, 3], INSERT + base[:, 2])
    out[:, 0] = np.minimum(base[:, 0], INSERT + out[:, 2])
    out[:, 1] = np.minimum(base[:, 1], INSERT + out[:, 2])
    return out


def _row_arcs(codes: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs to go by deleting, keeping and renaming each row, from each state."""
    wide = (slice(None),) + (None,) * (after.ndim - 2)
    end, fault, initial = codes == END, codes // 4, codes % 4
    delete = np.where(end[:, *(None,) * (after.ndim - 1)], np.inf, DELETE + after)
    extra = np.where(end | (fault >= 2), np.inf, np.where(fault == 1, TRUNCATED, 0.0))
    rename = (RENAME + extra)[:, *(None,) * (after.ndim - 1)] + after[:, FOLLOWS]
    keep = np.full_like(after, np.inf)
    for kind, states in KEEP_FROM.items():
        mine = initial == kind
        for state in states:
            keep[mine, state] = extra[mine][wide] + after[mine, KEEP_TO[kind]]
    return delete, keep, rename


def costs_to_go(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The cost from before each row to the end, for each state (and each further axis of ``ends``)."""
    found = np.empty((len(codes), *ends.shape[1:]))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, ends = starts[order], sizes[order], ends[order]
    for t in range(int(sizes.max(initial=0)) - 1, -1, -1):
        m = int(np.searchsorted(-sizes, -t, "left"))
        rows = starts[:m] + t
        last = sizes[:m] == t + 1
        after = np.where(last[:, *(None,) * (ends.ndim - 1)], ends[:m], found[np.minimum(rows + 1, len(codes) - 1)])
        base = np.minimum.reduce(_row_arcs(codes[rows], after))
        base[codes[rows] == END] = ENDED if ends.ndim == 2 else ENDED[:, None]
        found[rows] = _inserted(base)
    return found


def matrices(blocks: list[np.ndarray]) -> np.ndarray:
    """For each block the cost from each entry state to each exit state."""
    sizes = np.array([len(b) for b in blocks])
    starts = np.cumsum(sizes) - sizes
    unit = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    return costs_to_go(np.concatenate(blocks), starts, sizes, np.broadcast_to(unit, (len(blocks), 4, 4)))[starts]


class Paths:
    """The arcs on cheapest paths of some blocks, ranked by their audits."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ends: np.ndarray):
        n = len(codes)
        go = costs_to_go(codes, starts, sizes, ends)
        last = np.zeros(n, dtype=bool)
        last[starts + sizes - 1] = True
        after = np.empty_like(go)
        after[:-1] = go[1:]
        after[last] = ends[np.argsort(starts)]
        state, row = np.broadcast_to(np.arange(4), (n, 4)), np.broadcast_to(np.arange(n)[:, None], (n, 4))
        delete, keep, rename = _row_arcs(codes, after)
        kept = np.full((n, 4), 0)
        for kind, states in KEEP_FROM.items():
            kept[np.ix_(codes % 4 == kind, states)] = KEEP_TO[kind]
        following = np.broadcast_to(FOLLOWS, (n, 4))
        source, target, letter, leaves = [], [], [], []
        kinds = ((delete, state, 1, 1), (INSERT + go[:, FOLLOWS], following, 2, 0), (keep, kept, 3, 1), (rename, following, 4, 1))
        for cost, into, code, step in kinds:
            best = (cost == go) & np.isfinite(cost)
            out = np.where(last[:, None] & (step == 1), into, -1)[best]
            source.append(4 * row[best] + state[best])
            target.append(np.where(out >= 0, -1, 4 * (row[best] + step) + into[best]))
            letter.append(np.full(best.sum(), code))
            leaves.append(out)
        self.source, self.target = np.concatenate(source), np.concatenate(target)
        count = len(self.source)
        # One more arc stands for the end of a path; it comes before all letters and points to itself.
        self.letter = np.append(np.concatenate(letter), 0)
        self.leaves = np.append(np.concatenate(leaves), -1)
        rank = self.letter.copy()
        first = self._first(4 * n, rank)
        pointer = np.append(np.where(self.target >= 0, first[self.target], count), count)
        self.pointers = [pointer]
        while (pointer != count).any():
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
            pointer = pointer[pointer]
            self.pointers.append(pointer)
        self.first = self._first(4 * n, rank)

    def _first(self, nodes: int, rank: np.ndarray) -> np.ndarray:
        """The least arc of each node; of a node without arcs, where a path may end, the end."""
        first = np.full(nodes, len(self.source))
        order = np.lexsort((rank[:-1], self.source))[::-1]
        first[self.source[order]] = order
        return first

    def unrolled(self, nodes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The least audit from each node and the state in which its path leaves the block (-1: it ends there)."""
        path = self.first[nodes][:, None]
        for pointer in self.pointers:
            path = np.concatenate([path, pointer[path]], axis=1)
        letters = np.frombuffer(LETTERS, dtype=np.uint8)[self.letter[path]]
        lengths = (letters > 0).sum(axis=1)
        final = path[np.arange(len(path)), np.maximum(lengths - 1, 0)]
        return [r[:k].tobytes() for r, k in zip(letters, lengths, strict=True)], self.leaves[final]


def least_paths(blocks: list[np.ndarray], ends: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """For each block and each entry state the exit state and the audit of the least cheapest path.

    ``ends`` are the costs that follow a block, ``last`` marks the blocks that end a conversation. Blocks of like length
    are unrolled together, some at a time.
    """
    blocks = [np.append(b, np.uint8(END)) if e else b for b, e in zip(blocks, last, strict=True)]
    sizes = np.array([len(b) for b in blocks])
    exits, audits = np.zeros((len(blocks), 4), dtype=np.int64), [[]] * len(blocks)
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        fits = np.searchsorted(sizes[order[at:]] * np.arange(1, len(order) - at + 1), CELLS, "right")
        own = order[at : at + max(1, int(fits))]
        starts = np.cumsum(sizes[own]) - sizes[own]
        paths = Paths(np.concatenate([blocks[i] for i in own]), starts, sizes[own], ends[own])
        found, leaves = paths.unrolled((4 * starts[:, None] + np.arange(4)).ravel())
        exits[own] = leaves.reshape(-1, 4)
        for k, i in enumerate(own):
            audits[i] = found[4 * k : 4 * k + 4]
        at += len(own)
    return exits, audits


def _chained(column: str, of, kind: str) -> Column:
    """``of`` over the blocks of many conversations, given as arrays of (part, block, packed) in order."""

    @F.arrow_udf(f"array<struct<part: int, block: int, {kind}>>")
    def chained(lists: pa.Array) -> pa.Array:
        offsets = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
        flat = lists.flatten()
        made = of(flat.field(2).to_pylist(), offsets[:-1], np.diff(offsets))
        columns = {"part": flat.field(0), "block": flat.field(1), **made}
        rows = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return chained(F.col(column))


def _ends(packed: list[bytes], starts: np.ndarray, sizes: np.ndarray) -> dict[str, pa.Array]:
    """From the matrices of conversations: the costs that follow each block, and each conversation's whole cost."""
    costs = np.frombuffer(b"".join(packed), dtype="<f8").reshape(-1, 4, 4)
    follow = np.empty((len(costs), 4))
    now = np.broadcast_to(_inserted(ENDED[None, :]), (len(sizes), 4)).copy()
    for t in range(int(sizes.max(initial=0))):
        own = np.flatnonzero(sizes > t)
        block = starts[own] + sizes[own] - 1 - t
        follow[block] = now[own]
        now[own] = (costs[block] + now[own][:, None, :]).min(axis=2)
    last = np.zeros(len(costs), dtype=bool)
    last[starts + sizes - 1] = True
    whole = np.repeat(now[:, 0].astype(np.int64), sizes)
    return {"ends": pa.array([r.tobytes() for r in follow], pa.binary()), "last": pa.array(last), "cost": pa.array(whole)}


def _entries(packed: list[bytes], starts: np.ndarray, sizes: np.ndarray) -> dict[str, pa.Array]:
    """From the exits of conversations' blocks: the state in which each block is entered."""
    exits = np.frombuffer(b"".join(packed), dtype=np.int8).reshape(-1, 4)
    entry = np.zeros(len(exits), dtype=np.int32)
    now = np.zeros(len(sizes), dtype=np.int64)
    for t in range(int(sizes.max(initial=0))):
        own = np.flatnonzero(sizes > t)
        block = starts[own] + t
        entry[block] = now[own]
        now[own] = exits[block, now[own]]
    return {"entry": pa.array(entry)}


def _edits(audit: str, entry: int, codes: np.ndarray, turns: list, roles: list, texts: list) -> list[dict]:
    """The edits of a block's audit, applied."""
    out, state, at = [], entry, 0
    for edit in audit:
        if edit == "I":
            state = int(FOLLOWS[state])
            out.append({"edit": edit, "role": ("user", "assistant")[state - 2], "text": ""})
            continue
        row = {"edit": edit, "fault": FAULTS[codes[at] // 4], "turn": turns[at], "was": roles[at]}
        if edit == "K":
            state = KEEP_TO[int(codes[at] % 4)]
            row |= {"role": roles[at], "text": texts[at]}
        elif edit == "R":
            state = int(FOLLOWS[state])
            row |= {"role": ("user", "assistant")[state - 2], "text": texts[at]}
        out.append(row)
        at += 1
    return out


def edited(conversations: DataFrame, key: str = "conv_id", block_rows: int = 512) -> DataFrame:
    """(key, part, block, cost, edits): the edits of each conversation, in the order of part and block, and its cost.

    An edit has its letter, the row's first fault, turn and role (``was``), and role and text of what stays. Faults are,
    in this order: blank (spaces and tabs and line ends alone), duplicate (role and text of an earlier row), truncated
    (no ``.!?`` at the end). Keeping costs 0, another role 2, deleting 3, inserting an empty turn 2; blank rows and
    duplicates must go, truncated rows that stay cost 1 more. Rows are ordered by turn (missing turns first), role and
    text; equal rows are duplicates of the first. A missing key is a conversation of its own; missing roles and texts
    count as one space. A role is known by its first letter: s, u or a. Other columns are left behind.

    Blocks have at most ``block_rows`` rows. What is chained per conversation is 130 bytes for a block.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = conversations.select(F.col(key).alias("conv"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    # The row's place in its file lets even equal rows part.
    routed = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order, "_at")
    kind = f"conv {rows.schema['conv'].dataType.simpleString()}, part int, block int, codes binary, "
    kind += "firsts array<struct<place: int, digest: binary>>, turns array<long>, roles array<string>, texts array<string>"
    ordered = routed.sortWithinPartitions(*order).drop("_at")
    blocks = materialise(ordered.mapInArrow(cut_blocks(block_rows), kind), "blocks")

    long = blocks.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv").alias("long_conv"))
    several = blocks.join(long, F.col("conv").eqNullSafe(F.col("long_conv")), "left_semi")
    firsts = several.select("conv", "part", "block", F.inline("firsts"))
    first = firsts.groupBy("conv", "digest").agg(F.min(F.struct("part", "block")).alias("first"))
    first = materialise(first.select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first"), "first")
    met = firsts.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    later = met.filter(F.struct("part", "block") > F.col("first"))
    repeats = later.groupBy("part", "block").agg(F.collect_list("place").alias("repeats"))
    coded = blocks.select("conv", "part", "block", "codes").join(repeats, ["part", "block"], "left")
    coded = coded.select("conv", "part", "block", "codes", F.coalesce("repeats", F.array().cast("array<int>")).alias("repeats"))

    @F.arrow_udf("struct<codes: binary, matrix: binary>")
    def summed(codes: pa.Array, repeats: pa.Array) -> pa.Array:
        own = _with_repeats(codes, repeats)
        found = matrices(own) if own else []
        columns = [pa.array([o.tobytes() for o in own], pa.binary()), pa.array([m.tobytes() for m in found], pa.binary())]
        return pa.StructArray.from_arrays(columns, names=["codes", "matrix"])

    coded = materialise(coded.select("conv", "part", "block", summed("codes", "repeats").alias("s")).select("conv", "part", "block", "s.*"), "codes")

    def per_block(df: DataFrame, packed: str, of, kind: str) -> DataFrame:
        lists = df.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "block", packed))).alias("chain"))
        return lists.select(F.inline(_chained("chain", of, kind)))

    follow = per_block(coded, "matrix", _ends, "ends: binary, last: boolean, cost: long")

    @F.arrow_udf("struct<exits: binary, audits: array<string>>")
    def solved(codes: pa.Array, ends: pa.Array, last: pa.Array) -> pa.Array:
        own = [np.frombuffer(c, dtype=np.uint8) for c in codes.to_pylist()]
        costs = np.frombuffer(b"".join(ends.to_pylist()), dtype="<f8").reshape(-1, 4)
        exits, audits = least_paths(own, costs, np.asarray(last.to_pylist(), dtype=bool))
        columns = [pa.array([e.astype(np.int8).tobytes() for e in exits], pa.binary()), pa.array([[a.decode() for a in r] for r in audits], pa.list_(pa.string()))]
        return pa.StructArray.from_arrays(columns, names=["exits", "audits"])

    paths = coded.join(follow, ["part", "block"]).select("conv", "part", "block", "codes", "cost", solved("codes", "ends", "last").alias("s"))
    paths = materialise(paths.select("conv", "part", "block", "codes", "cost", "s.exits", "s.audits"), "paths")
    entry = per_block(paths, "exits", _entries, "entry: int")
    chosen = paths.join(entry, ["part", "block"])
    chosen = chosen.select("part", "block", "codes", "cost", "entry", F.element_at("audits", F.col("entry") + 1).alias("audit"))

    @F.arrow_udf(EDITS)
    def applied(audit: pa.Array, entry: pa.Array, codes: pa.Array, turns: pa.Array, roles: pa.Array, texts: pa.Array) -> pa.Array:
        each = zip(*(c.to_pylist() for c in (audit, entry, codes, turns, roles, texts)), strict=True)
        kind = pa.struct([(n, pa.int64() if n == "turn" else pa.string()) for n in ("edit", "fault", "turn", "was", "role", "text")])
        return pa.array([_edits(*x) for x in each], pa.list_(kind))

    made = blocks.drop("codes", "firsts").join(chosen, ["part", "block"])
    made = made.withColumn("edits", applied("audit", "entry", "codes", "turns", "roles", "texts"))
    return made.select(F.col("conv").alias(key), "part", "block", "cost", "edits")


def repaired(edits: DataFrame, key: str = "conv_id") -> DataFrame:
    """The turns of the repaired conversations: key, part, block, place (their order), edit, turn, role, text."""
    rows = edits.select(key, "part", "block", F.posexplode("edits").alias("place", "e")).filter("e.edit <> 'D'")
    return rows.select(key, "part", "block", "place", "e.edit", "e.turn", "e.role", "e.text")


def _digests(kind: pa.DataType):
    """Blocks in order to one row for each conversation; texts pass by and are not gathered."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        kinds = [kind, *[pa.int64()] * 5, pa.string(), pa.string()]
        current, done = None, []

        def closed(c) -> list:
            faults = [c["faults"].get(f, 0) for f in ("blank", "duplicate", "truncated")]
            return [c["conv"], *faults, c["illegal"], c["cost"], "".join(c["audit"]), c["sha"].hexdigest()]

        def packed() -> pa.RecordBatch:
            return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                own = batch.slice(start, 256)
                for conv, cost, edits in zip(*(c.to_pylist() for c in own.columns), strict=True):
                    if current is None or conv != current["conv"]:
                        if current is not None:
                            done.append(closed(current))
                        current = {"conv": conv, "cost": cost, "faults": {}, "illegal": 0, "audit": [], "sha": hashlib.sha256()}
                        current |= {"before": None, "lines": 0}
                    for e in edits:
                        current["audit"].append(e["edit"])
                        if e["edit"] != "I":
                            initial = e["was"][:1]
                            if current["before"] is not None and current["before"] + initial not in ("su", "ua", "au"):
                                current["illegal"] += 1
                            current["before"] = initial
                            current["faults"][e["fault"]] = current["faults"].get(e["fault"], 0) + 1
                        if e["edit"] != "D":
                            line = f"{e['role']}:{e['text']}"
                            current["sha"].update((line if not current["lines"] else "\n" + line).encode())
                            current["lines"] += 1
                    current["audit"] = ["".join(current["audit"])]
                if len(done) >= 1024:
                    yield packed()
                    done = []
        if current is not None:
            done.append(closed(current))
        if done:
            yield packed()

    return of


def digests(edits: DataFrame, key: str = "conv_id") -> DataFrame:
    """For each conversation the numbers of faults, illegal neighbours and costs, the audit, and the SHA-256 of the
    repaired ``role:text`` lines. A conversation's blocks pass through one task in order, as SHA-256 asks; texts are
    not held there."""
    rows = edits.select(F.col(key).alias("conv"), "part", "block", "cost", "edits")
    ordered = rows.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), "part", "block")
    name = rows.schema["conv"].dataType
    kind = f"conv {name.simpleString()}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    kind += "repaired_sha256 string"
    found = ordered.select("conv", "cost", "edits").mapInArrow(_digests(to_arrow_type(name)), kind)
    return found.withColumnRenamed("conv", key)


def damaged(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows with faults by the CRC-32 of ``key:turn`` modulo 20 (nulls: one space): 0 drops the row, 1 empties its text,
    2 removes its ``.!?``, 3 repeats it, 4 makes the user its speaker; others stay."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, "turn", "role", "text")]
    fate = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    role = F.when(fate == 4, "user").otherwise(said[2]).alias("role")
    text = F.when(fate == 1, "").when(fate == 2, F.translate(said[3], ".!?", "")).otherwise(said[3]).alias("text")
    copies = F.explode(F.when(fate == 0, F.array().cast("array<int>")).when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.select(key, "turn", role, text, copies.alias("_copy")).drop("_copy")


def gaps(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """The turn numbers between a conversation's first and last that it lacks; null beyond the range of longs."""
    turns = rows.select(key, F.col("turn").cast("decimal(20,0)").alias("turn")).distinct().groupBy(key)
    missing = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.agg(F.when(F.count("turn") == 0, F.lit(0)).otherwise(missing.try_cast("long")).cast("long").alias("gaps"))


def report(conversations: DataFrame, rows: DataFrame, edits: DataFrame, key: str = "conv_id") -> DataFrame:
    """A row for each key of ``conversations``, with the gaps and digests of its ``rows`` and their ``edits``; without
    rows there is nothing to count and the repaired conversation is empty."""
    out = conversations.select(key).distinct()
    for found in (gaps(rows, key), digests(edits, key)):
        found = found.withColumnRenamed(key, "_key")
        out = out.join(found, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(key, *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
