"""Conversation structure repair by prefix-doubling path ranking.

A conversation is repaired by edits of its rows: Keep (0), Rerole to user or assistant (1), Delete (2), Insert an empty row of
either (5); a truncated row that stays adds 5, blank and duplicate rows must go. The roles left must read ``(s?(ua)+)?``.

Nodes are (row, state): nothing yet, after s, after u, after a. A cost DP from the end gives each node the cost of its cheapest way
out, and arcs on such a way are optimal. Nodes are then ranked by the first 1, 2, 4, ... letters of their audits: the rank for twice the length
is the rank of the pair (own rank, rank of the node that many letters on), and the pointer to that node is doubled along with it. A
state fixes the next role, so the optimal arcs of a node differ in their letter and one pointer a node is enough.
Arcs are chosen by (letter, rank of the target), and the whole least path is read off the doubled pointers at once.

Conversations of at most LONG_ROWS rows and LONG_CHARS characters are solved as wholes, many at a time. A longer one is range-sorted over
many tasks and cut into blocks; each block gives a min-plus matrix of its costs between states, a scan over the matrices (not the rows)
gives each block its costs behind, blocks are solved apart, and a scan forward follows the states. Only the SHA-256 of the
repaired text, which has no parallel form, reads a long conversation in one task, as a stream.

Defined results: a null role or text is one space; rows are taken by turn (nulls first), rows of one turn by role, then text, and equal rows follow
each other; all rows without a conv_id form one conversation; a row of another role than s..., u..., a... (by its first character; the empty role too) can only be reroled or deleted;
an empty table gives no rows; other columns are ignored. No rows left: zeros, an empty audit and the digest of the empty string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketgraph.llm import common
from basketgraph.llm.registry import query

#: Fixed values of the contract: edit costs, and the letters of an audit in ASCII order.
RETYPE, REMOVE, INSERT, TRUNCATED = 1, 2, 5, 5
LETTERS = "DIKR"
SPACE = " \t\n\x0b\x0c\r"

#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a. The state that the next user or assistant leads to, and that of a kept s, u, a or other row (4: none).
NEXT = np.array([2, 2, 3, 2])
KEEP = np.array([[1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4], [4, 4, 4, 4]])
ROLE_OF = {2: "user", 3: "assistant"}
#: A row's code: class of its role's initial in the low two bits, then truncated, then blank or duplicate.
LATE, GONE = 4, 8
NEVER = 1 << 50
AT_END = np.array([0, 2 * INSERT, INSERT, 0])

#: A conversation beyond either is cut into blocks of at most so much; tasks solve about as much at a time.
LONG_ROWS, LONG_CHARS = 4096, 4_000_000


# ---------------------------------------------------------------------------
# Rows: damage and faults, in DataFrame functions
# ---------------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage; dropped rows stay with ``dropped``, so that their conversation does."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fate"),
    )
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("fate") == 0).alias("dropped"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("_copy"),
    )
    return rows.drop("_copy")


def row_code() -> Column:
    """Code of a row but for duplicates: class, truncated, blank (a blank row is not truncated)."""
    initial, seen = F.substring("role", 1, 1), F.rtrim(F.col("text"), F.lit(SPACE))
    blank, late = F.length(seen) == 0, ~F.substring(seen, -1, 1).isin(".", "!", "?")
    cls = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (cls + F.when(blank, GONE).when(late, LATE).otherwise(0)).cast("int")


# ---------------------------------------------------------------------------
# Cost DP and path ranking on blocks of rows
# ---------------------------------------------------------------------------


def _moves(codes: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs of Delete, Keep and Rerole from each state, given the costs behind the row."""
    late = np.where(codes & LATE, TRUNCATED, 0)[:, None] + np.where(codes & GONE, NEVER, 0)[:, None]
    padded = np.concatenate([behind, np.full((len(behind), 1), NEVER)], axis=1)
    return behind + REMOVE, np.take_along_axis(padded, KEEP[codes & 3], axis=1) + late, behind[:, NEXT] + RETYPE + late


def suffix_costs(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cheapest cost from every (row or end, state) on. ``codes`` has one entry more per block, for its end, whose costs are ``ends``."""
    start = np.cumsum(sizes + 1) - (sizes + 1)
    cost = np.empty((len(codes), 4), np.int64)
    cost[start + sizes] = ends
    order = np.argsort(-sizes, kind="stable")
    falling = -sizes[order]
    for back in range(1, int(sizes.max(initial=0)) + 1):
        at = (start + sizes - back)[order[: np.searchsorted(falling, -back, side="right")]]
        best = np.minimum.reduce(_moves(codes[at], cost[at + 1]))
        for _ in range(3):
            best = np.minimum(best, best[:, NEXT] + INSERT)
        cost[at] = best
    return cost


def optimal_arcs(codes: np.ndarray, sizes: np.ndarray, cost: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is it optimal, target node) for each node and letter. Node of (row, state): 4 * row + state. ``last``: blocks that end a conversation."""
    n = len(codes)
    behind = cost[np.minimum(np.arange(n) + 1, n - 1)]
    remove, keep, retype = _moves(codes, behind)
    by_letter = np.stack([remove, cost[:, NEXT] + INSERT, keep, retype], axis=2)
    end = np.cumsum(sizes + 1) - 1
    by_letter[end, :, :1] = by_letter[end, :, 2:] = 2 * NEVER
    by_letter[end[~last], :, 1] = 2 * NEVER
    row, state = np.arange(n)[:, None], np.arange(4)[None, :]
    on = np.minimum(row + 1, n - 1)
    target = np.stack([4 * on + state, 4 * row + NEXT[state], 4 * on + np.minimum(KEEP[codes & 3], 3), 4 * on + NEXT[state]], axis=2)
    optimal = (by_letter == cost[:, :, None]) & (cost[:, :, None] < NEVER)
    return optimal.reshape(-1, 4), target.reshape(-1, 4)


def ranked_paths(optimal: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(letter, audit length, pointers 1, 2, 4, ... letters on) of each node on its least path."""
    node = np.arange(len(optimal))
    arcs = optimal.any(axis=1)
    first = optimal.argmax(axis=1)
    rank, jump = np.where(arcs, first + 1, 0), np.where(arcs, target[node, first], node)
    while arcs[jump].any():
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
        jump = jump[jump]
    width = int(rank.max(initial=0)) + 1
    least = np.where(optimal, np.arange(4)[None, :] * width + rank[target], 4 * width).argmin(axis=1)
    letter, jump = np.where(arcs, least, -1), np.where(arcs, target[node, least], node)
    length, pointers = arcs.astype(np.int64), [jump]
    while arcs[jump].any():
        length = length + length[jump]
        jump = jump[jump]
        pointers.append(jump)
    return letter, length, pointers


def walk(start: np.ndarray, length: np.ndarray, pointers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(nodes of all paths in a row, where each path ends in it): the node t letters on is reached by the bits of t."""
    ends = np.cumsum(length[start])
    t = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - length[start], length[start])
    node = np.repeat(start, length[start])
    for k, p in enumerate(pointers):
        node = np.where(t >> k & 1, p[node], node)
    return node, ends


def least_repairs(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray, last: np.ndarray, entries: list[int]):
    """Costs of all nodes and, per entry state, (letters, nodes, path ends, state at the end of each block)."""
    cost = suffix_costs(codes, sizes, ends)
    letter, length, pointers = ranked_paths(*optimal_arcs(codes, sizes, cost, last))
    first, out = np.cumsum(sizes + 1) - (sizes + 1), []
    for state in entries:
        start = 4 * first + state
        nodes, upto = walk(start, length, pointers)
        out.append((letter[nodes], nodes, upto, pointers[-1][start] % 4))
    return cost[first], out


def _with_ends(codes: list[int], sizes: list[int]) -> np.ndarray:
    """Codes with room for the end of each block."""
    out = np.zeros(len(codes) + len(sizes), np.int64)
    n = np.asarray(sizes, np.int64)
    out[np.arange(len(codes)) + np.repeat(np.arange(len(n)), n)] = codes
    return out


def _repaired(letters, nodes, first_row: int, roles: list[str], texts: list[str]) -> list[str]:
    """``role:text`` of the rows that a path leaves. Nodes count from the block's first position."""
    out = []
    for x, node in zip(letters.tolist(), nodes.tolist(), strict=True):
        if x:
            row = first_row + (node >> 2)
            role = roles[row] if LETTERS[x] == "K" else ROLE_OF[int(NEXT[node & 3])]
            out.append(role + ":" + ("" if LETTERS[x] == "I" else texts[row]))
    return out


def _illegal(cls: np.ndarray) -> int:
    """Adjacent pairs of classes other than su, ua, au."""
    return int((~np.isin(cls[:-1] * 4 + cls[1:], (0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1))).sum())


def _audit(letters: np.ndarray) -> str:
    return np.frombuffer(LETTERS.encode(), np.uint8)[letters].tobytes().decode()


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in RESULT.split(", ")]
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2


# ---------------------------------------------------------------------------
# Conversations solved as wholes
# ---------------------------------------------------------------------------


class _Chunk:
    """Whole conversations gathered in a task until there is enough to solve at once."""

    def __init__(self):
        self.keys, self.sizes, self.turns = [], [], []
        self.roles, self.texts, self.codes = [], [], []
        self.faults, self.chars = [], 0

    def open(self, key) -> None:
        self.keys.append(key)
        self.sizes.append(0)
        self.turns.append([])
        self.faults.append([0, 0, 0])
        self.seen = set()

    def add(self, turn, role: str, text: str, code: int) -> None:
        if code & GONE:
            self.faults[-1][0] += 1
        elif (role, text) in self.seen:
            self.faults[-1][1] += 1
            code = code & 3 | GONE
        elif code & LATE:
            self.faults[-1][2] += 1
        self.seen.add((role, text))
        self.sizes[-1] += 1
        self.chars += len(text)
        self.turns[-1].append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(code)

    def full(self) -> bool:
        return len(self.codes) >= LONG_ROWS or self.chars >= LONG_CHARS or len(self.keys) >= LONG_ROWS

    def solved(self, kind: pa.DataType) -> pa.RecordBatch:
        sizes, codes = np.array(self.sizes, np.int64), _with_ends(self.codes, self.sizes)
        many = len(sizes)
        cost, [(letters, nodes, upto, _)] = least_repairs(codes, sizes, np.tile(AT_END, (many, 1)), np.ones(many, bool), [0])
        rows, row, path = [], 0, 0
        for c, n in enumerate(self.sizes):
            own = slice(path, int(upto[c]))
            kept = _repaired(letters[own], nodes[own] - 4 * (row + c), row, self.roles, self.texts)
            known = {t for t in self.turns[c] if t is not None}
            gaps = max(known) - min(known) + 1 - len(known) if known else 0
            cls = np.array(self.codes[row : row + n], np.int64) & 3
            rows.append((gaps, *self.faults[c], _illegal(cls), int(cost[c, 0]), _audit(letters[own]), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
            row, path = row + n, int(upto[c])
        columns = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(self.keys, kind), *columns], names=["conv_id", *_NAMES])


def repair_wholes(rows: DataFrame) -> DataFrame:
    """conv_id and the result of conversations that a task can hold."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = rows.select("conv_id", "turn", "role", "text", "dropped", row_code().alias("code")).repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", "text")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, arrow = _Chunk(), None
        for batch in batches:
            arrow = batch.schema.field("conv_id").type
            for key, turn, role, text, dropped, code in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not chunk.keys or chunk.keys[-1] != key:
                    if chunk.full():
                        yield chunk.solved(arrow)
                        chunk = _Chunk()
                    chunk.open(key)
                if not dropped:
                    chunk.add(turn, role, text, code)
        if chunk.keys:
            yield chunk.solved(arrow)

    return ordered.mapInArrow(solve, f"conv_id {kind}, {RESULT}")


# ---------------------------------------------------------------------------
# Long conversations, in blocks
# ---------------------------------------------------------------------------


def _stream(table: DataFrame, order: list[Column], schema: str, new, step) -> DataFrame:
    """Reads the rows of each conversation in one order as a stream: ``step(state, row)`` gives an output row or None; ``new()`` the state of a conversation."""
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        key, state, begun = None, None, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != key:
                    if begun:
                        out += step(state, None, key)
                    key, state, begun = row["conv_id"], new(), True
                out += step(state, row, key)
            yield _arrow(out, columns, batch.schema.field("conv_id").type)
            arrow = batch.schema.field("conv_id").type
        if begun:
            yield _arrow(step(state, None, key), columns, arrow)

    kind = table.schema["conv_id"].dataType.simpleString()
    return table.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, schema.replace("conv_id ?", f"conv_id {kind}"))


_ARROW = {
    "part": pa.int32(), "block": pa.int64(), "ends": pa.list_(pa.int64()), "last": pa.bool_(), "cost": pa.int64(), "entry": pa.int32(), "audit": pa.string(),
    "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(), "repaired_sha256": pa.string(),
}


def _arrow(rows: list[tuple], columns: list[str], kind: pa.DataType) -> pa.RecordBatch:
    held = list(zip(*rows, strict=True)) if rows else [[] for _ in columns]
    return pa.RecordBatch.from_arrays([pa.array(v, kind if c == "conv_id" else _ARROW[c]) for c, v in zip(columns, held, strict=True)], names=columns)


def _blocks(rows: DataFrame) -> DataFrame:
    """Range-sorted rows cut into blocks: place, rows, faults and the costs between states (16 numbers, entry by entry)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    digest = F.sha2(F.concat_ws("\x00", "role", "text").cast("binary"), 256).alias("digest")
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    rows = rows.select("conv_id", "turn", "role", "text", row_code().alias("code"), digest, when.alias("at"))
    first = rows.groupBy("conv_id", "digest").agg(F.min("at").alias("first")).select(F.col("conv_id").alias("_c"), F.col("digest").alias("_d"), "first")
    marked = rows.join(first, rows["conv_id"].eqNullSafe(F.col("_c")) & (rows["digest"] == F.col("_d")))
    marked = marked.select("conv_id", "turn", "role", "text", "code", (F.col("at") > F.col("first")).alias("again"))
    # the cuts hold the head of a text, so the driver's sample stays small; equal rows meet in one task
    ordered = marked.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")

    def cut(batches):
        part, number, arrow = TaskContext.get().partitionId(), 0, None
        key, held, chars, before = None, [], 0, None

        def block():
            codes = [c for _, _, c, _ in held]
            sizes = np.array([len(held)] * 4)
            ends = np.where(np.eye(4, dtype=bool), 0, NEVER)
            matrix = suffix_costs(np.tile(np.append(codes, 0), 4), sizes, ends).reshape(4, len(held) + 1, 4)[:, 0, :].T
            faults = [sum(f == k for _, _, _, f in held) for k in (1, 2, 3)]
            values = [key, part, number, bytes(codes), [r for r, _, _, _ in held], [t for _, t, _, _ in held], *faults, matrix.ravel().tolist()]
            types = [arrow, pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["conv_id", "part", "block", "codes", "roles", "texts", "blank", "duplicate", "truncated", "matrix"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            arrow = batch.schema.field("conv_id").type
            for conv, turn, role, text, code, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (conv != key or len(held) >= LONG_ROWS or chars + len(text) > LONG_CHARS):
                    yield block()
                    held, chars, number = [], 0, number + 1
                key, row = conv, (conv, turn, role, text)
                fault = 1 if code & GONE else 2 if again or row == before else 3 if code & LATE else 0
                held.append((role, text, code & 3 | GONE if fault == 2 else code, fault))
                chars, before = chars + len(text), row
        if held:
            yield block()

    return ordered.mapInArrow(
        cut, f"conv_id {kind}, part int, block long, codes binary, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, matrix array<long>"
    )


def _backward(blocks: DataFrame) -> DataFrame:
    """Costs at the end of each block; the row without a place has the conversation's cost."""

    def step(state, row, key):
        if row is None:
            return [(key, None, None, None, None, int(state["ends"][0]))]
        ends, last = state["ends"], not state["begun"]
        state["ends"] = (np.array(row["matrix"]).reshape(4, 4) + ends[None, :]).min(axis=1)
        state["begun"] = True
        return [(key, row["part"], row["block"], ends.tolist(), last, None)]

    order = [F.col("part").desc(), F.col("block").desc()]
    schema = "conv_id ?, part int, block long, ends array<long>, last boolean, cost long"
    return _stream(blocks.select("conv_id", "part", "block", "matrix"), order, schema, lambda: {"ends": AT_END, "begun": False}, step)


def _solved_blocks(blocks: DataFrame, ends: DataFrame) -> DataFrame:
    """For each block and each state it may be entered in: the audit through it and the state it is left in."""
    kind = blocks.schema["conv_id"].dataType.simpleString()
    both = blocks.select("conv_id", "part", "block", "codes").join(ends.where("part IS NOT NULL").select("part", "block", "ends", "last"), ["part", "block"])

    def solve(batches):
        for batch in batches:
            out, arrow = [], batch.schema.field("conv_id").type
            for row in batch.select(["conv_id", "part", "block", "codes", "ends", "last"]).to_pylist():
                codes = list(row["codes"])
                _, found = least_repairs(_with_ends(codes, [len(codes)]), np.array([len(codes)]), np.array([row["ends"]]), np.array([row["last"]]), [0, 1, 2, 3])
                out.append((row["conv_id"], row["part"], row["block"], [_audit(x[0]) for x in found], [int(x[3][0]) for x in found]))
            held = list(zip(*out, strict=True)) if out else [[]] * 5
            types = [arrow, pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(held, types, strict=True)], names=["conv_id", "part", "block", "audits", "leaves"])

    return both.mapInArrow(solve, f"conv_id {kind}, part int, block long, audits array<string>, leaves array<int>")


def _forward(solved: DataFrame) -> DataFrame:
    """The state in which each block is entered."""

    def step(state, row, key):
        if row is None:
            return []
        entry = state["at"]
        state["at"] = row["leaves"][entry]
        return [(key, row["part"], row["block"], entry)]

    schema = "conv_id ?, part int, block long, entry int"
    return _stream(solved.select("conv_id", "part", "block", "leaves"), [F.col("part"), F.col("block")], schema, lambda: {"at": 0}, step)


def _pieces(blocks: DataFrame, solved: DataFrame, entries: DataFrame) -> DataFrame:
    """Repaired text and audit of each block."""
    kind = blocks.schema["conv_id"].dataType.simpleString()
    path = solved.join(entries.select("part", "block", "entry"), ["part", "block"]).select("part", "block", "entry", F.element_at("audits", F.col("entry") + 1).alias("audit"))
    both = blocks.drop("matrix").join(path, ["part", "block"])
    columns = ["conv_id", "part", "block", "audit", "text", "empty", "inner", "head", "tail", "blank", "duplicate", "truncated"]

    def repair(batches):
        for batch in batches:
            for row in batch.to_pylist():
                letters = np.searchsorted(np.frombuffer(LETTERS.encode(), np.uint8), np.frombuffer(row["audit"].encode(), np.uint8))
                # the state before each letter: replayed, since only letters are kept
                state, at, nodes = row["entry"], 0, []
                for x in letters.tolist():
                    nodes.append(4 * at + state)
                    state = state if x == 0 else int(NEXT[state]) if x != 2 else int(KEEP[row["codes"][at] & 3][state])
                    at += x != 1
                kept = _repaired(letters, np.array(nodes, np.int64), 0, row["roles"], row["texts"])
                cls = np.frombuffer(row["codes"], np.uint8).astype(np.int64) & 3
                values = [row["conv_id"], row["part"], row["block"], row["audit"], "\n".join(kept), not kept, _illegal(cls), int(cls[0]), int(cls[-1]), row["blank"], row["duplicate"], row["truncated"]]
                types = [batch.schema.field("conv_id").type, pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_(), *[pa.int64()] * 6]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=columns)

    return both.mapInArrow(repair, f"conv_id {kind}, part int, block long, audit string, text string, empty boolean, inner long, head long, tail long, blank long, duplicate long, truncated long")


def repair_long(rows: DataFrame) -> DataFrame:
    """conv_id and the result of conversations of any length."""
    rows = rows.where(~F.col("dropped"))
    blocks = common.stored(_blocks(rows), "op11-blocks")
    ends = common.stored(_backward(blocks), "op11-ends")
    solved = common.stored(_solved_blocks(blocks, ends), "op11-solved")
    pieces = _pieces(blocks, solved, _forward(solved))

    def new():
        return {"sha": hashlib.sha256(), "any": False, "audit": [], "sums": [0, 0, 0, 0], "tail": None}

    def step(state, row, key):
        if row is None:
            return [(key, *state["sums"], "".join(state["audit"]), state["sha"].hexdigest())]
        if not row["empty"]:
            state["sha"].update((("\n" if state["any"] else "") + row["text"]).encode())
            state["any"] = True
        state["audit"].append(row["audit"])
        border = 0 if state["tail"] is None else _illegal(np.array([state["tail"], row["head"]]))
        state["sums"] = [a + b for a, b in zip(state["sums"], [row["blank"], row["duplicate"], row["truncated"], row["inner"] + border], strict=True)]
        state["tail"] = row["tail"]
        return []

    schema = "conv_id ?, blank long, duplicate long, truncated long, illegal long, audit string, repaired_sha256 string"
    done = _stream(pieces, [F.col("part"), F.col("block")], schema, new, step)
    costs = ends.where("part IS NULL").select(F.col("conv_id").alias("_c"), "cost")
    gaps = rows.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")).withColumnRenamed("conv_id", "_g")
    done = done.join(costs, done["conv_id"].eqNullSafe(F.col("_c"))).join(gaps, F.col("conv_id").eqNullSafe(F.col("_g")))
    return done.select("conv_id", *_NAMES)


def repair(turns: DataFrame, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS) -> DataFrame:
    """(conv_id, turn, role, text, dropped) -> one row per conversation: conv_id and RESULT."""
    size = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.max((~F.col("dropped")).cast("int")).alias("left"))
    long = common.stored(size.where(((F.col("n") > long_rows) | (F.col("chars") > long_chars)) & (F.col("left") == 1)).select(F.col("conv_id").alias("_long")), "op11-long")
    if long.isEmpty():
        return repair_wholes(turns)
    ids = common.broadcast_if_small(long)
    same = turns["conv_id"].eqNullSafe(F.col("_long"))
    return repair_wholes(turns.join(ids, same, "left_anti")).unionByName(repair_long(turns.join(ids, same, "left_semi")))


SQL = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: ascii(ch)::UBIGINT)),
      lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT) % 20 AS fate
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM src, (VALUES (1), (2)) AS copies(k) WHERE fate <> 0 AND (k = 1 OR fate = 3)
), placed AS (
  SELECT *, row_number() OVER w AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen, lag(role) OVER w AS before
  FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), r AS (
  SELECT *, CASE WHEN seen = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS c FROM placed
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND left(before, 1) || c NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY conv_id
), ins(q, q2, cost, letters, added) AS (
  SELECT q, q, 0, '', []::VARCHAR[] FROM range(4) AS s(q)
  UNION ALL SELECT q, CASE WHEN q = 2 THEN 3 ELSE 2 END, 5, 'I', [CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END] FROM range(4) AS s(q)
  UNION ALL SELECT q, 3, 10, 'II', ['user:', 'assistant:'] FROM (VALUES (0), (1), (3)) AS s(q)
  UNION ALL SELECT 2, 2, 10, 'II', ['assistant:', 'user:']
), arcs AS (
  SELECT conv_id, i, q, q AS q2, 2 AS cost, 'D' AS letter, []::VARCHAR[] AS line FROM r, range(4) AS s(q)
  UNION ALL
  SELECT conv_id, i, q, CASE c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K', [role || ':' || text] FROM r, range(4) AS s(q)
  WHERE fault NOT IN ('blank', 'duplicate') AND ((c = 's' AND q = 0) OR (c = 'u' AND q <> 2) OR (c = 'a' AND q = 2))
  UNION ALL
  SELECT conv_id, i, q, CASE WHEN q = 2 THEN 3 ELSE 2 END, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R', [CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END || text] FROM r, range(4) AS s(q)
  WHERE fault NOT IN ('blank', 'duplicate')
), best AS (
  SELECT f.conv_id, 0::BIGINT AS i, ins.q2 AS q, ins.cost AS cost, ins.letters AS audit, ins.added AS rows FROM facts f JOIN ins ON ins.q = 0
  UNION ALL
  SELECT conv_id, i, q, cost, audit, rows FROM (
    SELECT b.conv_id, a.i, ins.q2 AS q, b.cost + a.cost + ins.cost AS cost, b.audit || a.letter || ins.letters AS audit, list_concat(list_concat(b.rows, a.line), ins.added) AS rows
    FROM best b JOIN arcs a ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.i = b.i + 1 AND a.q = b.q JOIN ins ON ins.q = a.q2
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, i, q ORDER BY cost, audit) = 1
), done AS (
  SELECT b.conv_id, b.cost, b.audit, b.rows FROM best b JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.n = b.i AND b.q IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost, b.audit) = 1
)
SELECT o.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal,
  coalesce(d.cost, 0)::BIGINT AS cost, coalesce(d.audit, '') AS audit, sha256(coalesce(array_to_string(d.rows, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op11_conversation_repair", SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(common.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
