"""Conversation structure repair: the cheapest edits that bring roles into order, the least audit among equals.

A conversation's roles must read ``(s?(ua)+)?`` by their initials. Rows are kept (0), given the role that the order asks for
(2), deleted (3) or preceded by an inserted empty turn (2); blank and repeated rows are deleted, an undeleted truncated row
costs 1 more. The letters D, I, K and R of the edits, in order, are the audit.

Nodes are (row, state of the pattern). A backward pass gives every node's least cost, which leaves the optimal arcs; a state
fixes the role that an edit gives, so a node has one arc a letter at most. Nodes are then ranked by the first 1, 2, 4, ...
letters of their least audits: the rank for twice the length is that of (own rank, rank of the node that the doubled pointer
reaches). Each node takes its optimal arc of the least (letter, rank behind it), and the path from the start is laid out
through doubled pointers, 2^k nodes a step. All of it works on many conversations at once.

Conversations are dealt by their id and read in order of (turn, role, text), nulls first, some thousand rows at a time. A
conversation is one audit and one repaired text by definition, so its rows meet in one task, and a task holds little more
than its longest conversation.

Null roles and texts are one space, a null turn comes first, a null conversation id is a conversation; equal rows are
repeated rows, the later ones faults; a conversation without rows left has zeros and an empty audit; an empty table gives
no rows; further columns are ignored; very long texts are read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

#: Costs of the edits.
RENAME, DROP, ADD, CUT = 2, 3, 2, 1
#: State after: nothing, s, u, a. The next state by state and initial (other, s, u, a); -1: not allowed.
KEEP_TO = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])
#: The next state where the edit chooses the role.
GIVE_TO = np.array([2, 2, 3, 2])
ROLE_OF = {2: "user", 3: "assistant"}
LETTERS = np.frombuffer(b"DIKR", np.uint8)
FAR = 1 << 60
#: Rows that are worked on at once.
LOT = 20_000
#: Characters that are not blank, and ends of a whole sentence.
SPACE, ENDS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"

REPAIRED = StructType(
    [StructField(c, LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [StructField("audit", StringType()), StructField("repaired", ArrayType(StructType([StructField("role", StringType()), StructField("text", StringType())])))]
)


def damage(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, gone)`` with the faults that crc32 of ``conv_id:turn`` modulo 20 asks for: 0 drops the row
    (it stays as a mark, ``gone``), 1 empties the text, 2 takes its sentence ends, 3 repeats the row, 4 makes it the user's."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name) % F.lit(20)
    text = F.coalesce("text", F.lit(" "))
    cut = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(text, "[.!?]", "")).when(F.col("_kind") == 0, "").otherwise(text)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), "text", kind.alias("_kind"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(F.col("_kind") == 0))
    return rows.select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), cut.alias("text"), F.explode(copies).alias("gone"))


def least_audits(initials: np.ndarray, doomed: np.ndarray, cut: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Costs and audits of conversations whose rows follow each other: initials (0 other, 1 s, 2 u, 3 a), rows that must go,
    truncated rows, numbers of rows. ``sizes`` should not differ much: the work is in proportion to the longest."""
    count, longest = len(sizes), int(sizes.max())
    base = np.cumsum(sizes + 1) - (sizes + 1)  # node (base + row) * 4 + state; one row more for the end
    row = np.cumsum(sizes) - sizes
    nodes = int((sizes + 1).sum())
    cost = np.full((nodes, 4), FAR, np.int64)
    state = np.arange(4)

    def add(c):
        for _ in range(2):  # two insertions lead from any state to any other
            c = np.minimum(c, ADD + c[:, GIVE_TO])
        return c

    # code, doom and cut of every node's row; the end has none
    code, doom, short = np.zeros(nodes, np.int64), np.ones(nodes, bool), np.zeros(nodes, np.int64)
    at = np.arange(len(initials)) + np.repeat(np.arange(count), sizes)
    code[at], doom[at], short[at] = initials, doomed, cut * CUT
    kept = KEEP_TO[state[None, :], code[:, None]]
    cost[base + sizes] = add(np.tile(np.array([0, FAR, FAR, 0]), (count, 1)))
    order = np.argsort(-sizes, kind="stable")
    for back in range(1, longest + 1):
        here = order[: np.searchsorted(-sizes[order], -back, side="right")]
        v = base[here] + sizes[here] - back
        cost[v] = add(np.minimum(DROP + cost[v + 1], np.minimum(*_edits(cost, v, kept, doom, short))))

    # optimal arcs, by letter
    v = np.arange(nodes)
    inside = np.ones(nodes, bool)
    inside[base + sizes] = False
    after = np.minimum(v + 1, nodes - 1)
    drop = np.where(inside[:, None], DROP + cost[after], FAR)
    keep, give = _edits(cost, v, kept, doom, short)
    keep, give = (np.where(inside[:, None], x, FAR) for x in (keep, give))
    options = np.stack([drop, ADD + cost[:, GIVE_TO], keep, give])
    target = np.stack([after[:, None] * 4 + state, v[:, None] * 4 + GIVE_TO, after[:, None] * 4 + np.maximum(kept, 0), after[:, None] * 4 + GIVE_TO])
    target = np.broadcast_to(target, options.shape).reshape(4, -1)
    flat = cost.reshape(-1)
    optimal = (options.reshape(4, -1) == flat) & (flat < FAR)
    done = ~optimal.any(axis=0)  # accepted ends, and nodes from which there is no way
    own = np.arange(len(flat))

    def chosen(weight):
        k = np.where(optimal, weight, np.iinfo(np.int64).max).argmin(axis=0)
        return np.where(done, 0, LETTERS[k]), np.where(done, own, target[k, own])

    letter, jump = chosen(LETTERS[:, None].astype(np.int64))
    rank = np.unique(letter, return_inverse=True)[1].astype(np.int64)
    while not done[jump].all():
        rank = np.unique(rank * (len(flat) + 1) + rank[jump], return_inverse=True)[1].astype(np.int64)
        jump = jump[jump]
    letter, jump = chosen(LETTERS[:, None].astype(np.int64) * (len(flat) + 1) + rank[target])
    path = (base * 4)[:, None]
    while not done[path[:, -1]].all():
        path = np.concatenate([path, jump[path]], axis=1)
        jump = jump[jump]
    spelled = letter[path].astype(np.uint8)
    length = (spelled > 0).sum(axis=1)
    return flat[base * 4], [spelled[c, :n].tobytes().decode() for c, n in enumerate(length)]


def _edits(cost, v, kept, doom, short):
    """Costs of keeping and of renaming the rows of nodes ``v``."""
    after, to = cost[np.minimum(v + 1, len(cost) - 1)], kept[v]
    keep = np.where((to < 0) | doom[v][:, None], FAR, short[v][:, None] + np.take_along_axis(after, np.maximum(to, 0), axis=1))
    give = np.where(doom[v][:, None], FAR, RENAME + short[v][:, None] + after[:, GIVE_TO])
    return keep, give


def _faults(rows: list[tuple]) -> tuple[list[int], list[str]]:
    """Initial codes and first faults (b, d, t or none) of a conversation's ``(turn, role, text)`` rows."""
    seen, codes, faults = set(), [], []
    for _, role, text in rows:
        end = text.rstrip(SPACE)
        faults.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ENDS else "")
        seen.add((role, text))
        codes.append({"s": 1, "u": 2, "a": 3}.get(role[:1], 0))
    return codes, faults


def _replayed(rows: list[tuple], codes: list[int], audit: str) -> list[dict]:
    """The rows that an audit leaves."""
    out, state, i = [], 0, 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        state = int(KEEP_TO[state, codes[i]]) if edit == "K" else int(GIVE_TO[state])
        out.append({"role": rows[i][1] if edit == "K" else ROLE_OF[state], "text": "" if edit == "I" else rows[i][2]})
        i += edit != "I"
    return out


def _repair_lot(lot: list[list[tuple]]) -> list[dict]:
    """Results of conversations, each a list of (turn, role, text)."""
    told = [_faults(rows) for rows in lot]
    sizes = np.array([len(rows) for rows in lot])
    costs, audits = np.zeros(len(lot), np.int64), [""] * len(lot)
    grade = np.frexp(sizes)[1]  # conversations of like length together
    for g in np.unique(grade):
        here = np.flatnonzero(grade == g)
        codes = np.array([c for k in here for c in told[k][0]], np.int64)
        faults = np.array([f for k in here for f in told[k][1]], "U1")
        cost, audit = least_audits(codes, np.isin(faults, ["b", "d"]), faults == "t", sizes[here])
        costs[here] = cost
        for k, a in zip(here, audit, strict=True):
            audits[k] = a
    out = []
    for k, (rows, (codes, faults)) in enumerate(zip(lot, told, strict=True)):
        turns = {t for t, _, _ in rows if t is not None}
        pairs = zip(rows, rows[1:], strict=False)
        out.append({
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
            "cost": int(costs[k]), "audit": audits[k], "repaired": _replayed(rows, codes, audits[k]),
        })
    return out


def repair_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` rows, and optionally ``gone`` marks of dropped ones, to one row per conversation:
    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired (its role and text structs in order)."""
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("gone"))
    schema = StructType([rows.schema["conv_id"], *REPAIRED.fields])
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def out(ids: list, lot: list[list[tuple]]) -> pa.RecordBatch:
        found = _repair_lot(lot)
        cols = [ids] + [[r[f.name] for r in found] for f in schema.fields[1:]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lot, held = [], [], 0
        for batch in batches:
            for conv, turn, role, text, lost in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not ids or conv != ids[-1]:
                    if held >= LOT:
                        yield out(ids, lot)
                        ids, lot, held = [], [], 0
                    ids.append(conv)
                    lot.append([])
                if not lost:
                    lot[-1].append((turn, role, text))
                held += 1
        if ids:
            yield out(ids, lot)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, schema)
