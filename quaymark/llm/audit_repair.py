"""Repair of conversation structure with the cheapest audit of edits.

Method.  A dynamic program runs over a conversation's rows.  Its states are what the roles so
far allow next (nothing yet, after the system row, after a user, after an assistant); a
state holds its least cost and the audit that reaches it: the initials of the edits Keep,
Rerole, Delete, Insert.  Audits are nodes of a tree in which one edit is one node below the
audit it extends, so all states share their prefixes.  A node carries a rolling hash of its
audit and its ancestors 1, 2, 4, ... steps up; two audits of one cost are compared by a search
for their longest common prefix over these ancestors, and prefixes of equal hash are
verified edit by edit up to a node that they share (``Audits``).

Audits of one cost at one row differ first in a real edit: neither is the beginning of the
other, as what is added would be inserts that cost more.  So the best audit of a state
extends the best audit of a state before it, and rows can be cut into segments: a segment
gives, for each state before it, cost, audit and rank of each state after it, and a
conversation is a fold over its segments that needs costs and ranks only.  A
conversation of any length is solved by segments of at most ``SEGMENT`` rows in parallel.

Rows of a conversation are taken by turn (nulls first), then by role, by the first 256
characters of the text and by its digest; what is equal in all stays adjacent.  Defined
results: a null role or text counts as one space, a null conv_id or turn as one space in the
key of the damage; rows with a null conv_id are one conversation; a role's initial is its
first character, and an empty role has none that is legal; a conversation without rows
has an empty audit and no cost; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quaymark.session import materialize

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
#: Rows of a segment, as a power of two.
SEGMENT = 10
#: Characters that end a sentence, and those that are blank; fixed by the contract.
STOPS, BLANKS = (".", "!", "?"), " \t\n\x0b\f\r"

START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER_INSERT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: A row's class: its initial is s, u, a or another.
_CLASSES = "sua"
_AFTER_KEEP = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_BLANK, _DUPLICATE, _TRUNCATED = 4, 8, 16
_FIELDS = 11


class Audits:
    """A tree of audits; node 0 is the empty one."""

    def __init__(self, base: int = 1_000_003, modulus: int = (1 << 61) - 1) -> None:
        self._base, self._modulus = base, modulus
        self._edit, self._depth, self._hash = [""], [0], [0]
        self._up: list[list[int]] = [[]]

    def extend(self, node: int, edit: str) -> int:
        """The audit ``node`` followed by ``edit``."""
        ancestors, power = [node], 0
        while power < len(self._up[ancestors[-1]]):
            ancestors.append(self._up[ancestors[-1]][power])
            power += 1
        self._edit.append(edit)
        self._depth.append(self._depth[node] + 1)
        self._hash.append((self._hash[node] * self._base + ord(edit)) % self._modulus)
        self._up.append(ancestors)
        return len(self._edit) - 1

    def _lift(self, node: int, depth: int) -> int:
        while self._depth[node] > depth:
            steps = (self._depth[node] - depth).bit_length() - 1
            node = self._up[node][steps]
        return node

    def _first_difference(self, a: int, b: int) -> tuple[int, int] | None:
        """For two audits of one length, the ends of their shortest prefixes that differ; None if they are equal."""
        last: tuple[int, int] | None = None
        while a != b:
            if self._edit[a] != self._edit[b]:
                last = (a, b)
            a, b = self._up[a][0], self._up[b][0]
        return last

    def compare(self, a: int, b: int) -> int:
        """Below 0 if audit ``a`` comes before ``b``, 0 if they are equal."""
        length = min(self._depth[a], self._depth[b])
        x, y = self._lift(a, length), self._lift(b, length)
        found = None
        if self._hash[x] != self._hash[y]:
            below = length
            for step in range(below.bit_length(), -1, -1):
                if step < len(self._up[x]) and step < len(self._up[y]):
                    above = self._up[x][step], self._up[y][step]
                    if self._hash[above[0]] != self._hash[above[1]]:
                        x, y = above
            found = x, y
            # The prefixes above have one hash: that they are equal is verified.
            hidden = self._first_difference(self._up[x][0], self._up[y][0])
            found = hidden or found
        else:
            found = self._first_difference(x, y)
        if found is None:
            return self._depth[a] - self._depth[b]
        return -1 if self._edit[found[0]] < self._edit[found[1]] else 1

    def text(self, node: int) -> str:
        edits = []
        while node:
            edits.append(self._edit[node])
            node = self._up[node][0]
        return "".join(reversed(edits))


def _better(audits: Audits, table: dict[int, tuple[int, int]], state: int, cost: int, node: int, edit: str) -> None:
    """Offer ``state`` the audit ``node`` followed by ``edit``."""
    if state in table and table[state][0] < cost:
        return
    new = audits.extend(node, edit)
    if state not in table or cost < table[state][0] or audits.compare(new, table[state][1]) < 0:
        table[state] = (cost, new)


def solve(codes: list[int], start: int, audits: Audits) -> dict[int, tuple[int, int]]:
    """For each state after the rows ``codes``, the least cost and best audit from ``start``; inserts stand before a row."""
    table = {start: (0, 0)}
    for code in codes:
        before = dict(table)
        for _ in range(2):  # more inserts in a row come back to a state for a higher cost
            for state, (cost, node) in list(before.items()):
                _better(audits, before, _AFTER_INSERT[state], cost + INSERT_COST, node, INSERT)
        table = {}
        for state, (cost, node) in before.items():
            _better(audits, table, state, cost + DELETE_COST, node, DELETE)
            if code & (_BLANK | _DUPLICATE):
                continue
            stay = cost + (TRUNCATED_COST if code & _TRUNCATED else 0)
            kept = _AFTER_KEEP.get((state, code & 3))
            if kept is not None:
                _better(audits, table, kept, stay, node, KEEP)
            _better(audits, table, _AFTER_INSERT[state], stay + REROLE_COST, node, REROLE)
    return table


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, dropped, copy)`` of each row of ``conversations (conv_id, turn, role, text)`` after damage.

    A dropped row stays as a mark of its conversation.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(key) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), F.explode(copies).alias("copy"))


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` as they are, in the form of ``damage``."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *texts, F.lit(False).alias("dropped"), F.lit(0).alias("copy"))


def _placed(rows: DataFrame) -> DataFrame:
    """The rows with their place: one range sort over all conversations, so that a long one spans many tasks.

    ``conv`` is the id as a text that is never null, for joins.
    """
    rest = F.rtrim(F.col("text"), F.lit(BLANKS))
    stop = F.endswith(rest, F.lit(STOPS[0])) | F.endswith(rest, F.lit(STOPS[1])) | F.endswith(rest, F.lit(STOPS[2]))
    kind = F.position(F.substring("role", 1, 1), F.lit(_CLASSES))
    code = F.when((kind > 0) & (F.col("role") != ""), kind - 1).otherwise(3) + F.when(rest == "", _BLANK).when(~stop, _TRUNCATED).otherwise(0)
    digest = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = rows.withColumns({"conv": conv, "code": code, "digest": digest, "head": F.substring("text", 1, 256), "id": F.monotonically_increasing_id()})
    keys = ["conv_id", "turn", "role", "head", "digest", "id", "copy"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialize(ordered.select("conv", "turn", "role", "text", "dropped", "code", "digest", F.monotonically_increasing_id().alias("place")), "placed_turns")


def _segments(placed: DataFrame, segment: int) -> DataFrame:
    """``(conv, seg, whole, rows)``: rows of a conversation, at most 2^segment at a time, as (place, turn, marks).

    ``whole`` is true for a conversation's first segment.
    """
    light = placed.select("conv", "place", "turn", "code", "digest", "dropped", F.shiftright("place", segment).alias("seg"))
    live = light.where(~F.col("dropped") & (F.col("code").bitwiseAND(_BLANK) == 0))
    repeated = live.groupBy("conv", "digest").agg(F.min("place").alias("first_place"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = light.join(repeated, ["conv", "digest"], "left")
    # Marks: the code, 32 for a row without a turn, 64 for a dropped one.
    marks = F.col("code") + F.when(F.col("place") > F.col("first_place"), _DUPLICATE).otherwise(0)
    marks = marks + F.when(F.col("turn").isNull(), 32).otherwise(0) + F.when(F.col("dropped"), 64).otherwise(0)
    packed = F.array(F.col("place"), F.coalesce("turn", F.lit(0).cast("long")), marks.cast("long"))
    lists = joined.groupBy("conv", "seg").agg(F.flatten(F.collect_list(packed)).alias("rows"))
    spans = light.groupBy("conv").agg(F.min("seg").alias("low"), F.max("seg").alias("high")).where("low < high")
    return lists.join(spans, "conv", "left").select("conv", "seg", (F.col("low").isNull() | (F.col("seg") == F.col("low"))).alias("whole"), "rows")


def _solve_segments(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts, costs and ranks of each segment, packed, and the audits themselves."""
    for batch in batches:
        out = []
        for conv, seg, whole, packed in zip(batch["conv"], batch["seg"], batch["whole"], batch["rows"]):
            rows = np.asarray(packed, np.int64).reshape(-1, 3)
            rows = rows[np.argsort(rows[:, 0])]
            some = rows[:1, 0]  # where inserts stand in a segment whose rows were all dropped
            rows = rows[rows[:, 2] < 64]
            turns, marks = rows[rows[:, 2] & 32 == 0, 1], rows[:, 2]
            blank = marks & _BLANK > 0
            duplicate = ~blank & (marks & _DUPLICATE > 0)
            truncated = ~blank & ~duplicate & (marks & _TRUNCATED > 0)
            codes = ((marks & 3) + np.where(blank, _BLANK, np.where(duplicate, _DUPLICATE, np.where(truncated, _TRUNCATED, 0)))).tolist()
            classes = [c & 3 for c in codes]
            illegal = sum((a, b) not in _LEGAL for a, b in zip(classes, classes[1:]))
            ends = (classes[0], classes[-1]) if classes else (-1, -1)
            span = (1, turns.min(), turns.max(), len(np.unique(turns))) if len(turns) else (0, 0, 0, 0)
            facts = [seg, blank.sum(), duplicate.sum(), truncated.sum(), illegal, *ends, *span]
            costs, ranks, audits = np.full(16, -1), np.zeros(16, np.int64), [None] * 16
            for start in (START,) if whole else range(4):
                tree = Audits()
                table = solve(codes, start, tree)
                ordered: list[int] = []
                for state in sorted(table):
                    at = len(ordered)
                    while at and tree.compare(table[state][1], table[ordered[at - 1]][1]) < 0:
                        at -= 1
                    ordered.insert(at, state)
                for rank, state in enumerate(ordered):
                    costs[4 * start + state], ranks[4 * start + state] = table[state][0], rank
                    audits[4 * start + state] = tree.text(table[state][1])
            summary = np.concatenate([np.array(facts, np.int64), costs, ranks]).tobytes()
            out.append((conv, seg, (rows[:, 0] if len(rows) else some).tolist(), codes, audits, summary))
        yield pd.DataFrame(out, columns=["conv", "seg", "places", "codes", "audits", "summary"])


def _fold(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row of each conversation: its counts, its cost, and the audit chosen in each segment."""
    for batch in batches:
        out = []
        for conv, packed in zip(batch["conv"], batch["summaries"]):
            table = np.array([np.frombuffer(s, np.int64) for s in packed])
            table = table[np.argsort(table[:, 0])]
            facts, costs, ranks = table[:, :_FIELDS], table[:, _FIELDS : _FIELDS + 16], table[:, _FIELDS + 16 :]
            illegal, low, high, distinct, last = int(facts[:, 4].sum()), None, None, 0, -1
            best, back = {START: (0, 0)}, []  # state: cost, rank among the audits so far
            for f, cost, rank in zip(facts, costs, ranks):
                if f[5] >= 0:
                    illegal += last >= 0 and (last, int(f[5])) not in _LEGAL
                    last = int(f[6])
                if f[7]:
                    distinct += int(f[10]) - (high == f[8])
                    low, high = int(f[8]) if low is None else low, int(f[9])
                offers: dict[int, tuple] = {}
                for state, (paid, order) in best.items():
                    for after in range(4):
                        c = int(cost[4 * state + after])
                        if c >= 0:
                            offer = (paid + c, order, int(rank[4 * state + after]), state)
                            offers[after] = min(offers.get(after, offer), offer)
                ordered = sorted(offers, key=lambda s: offers[s][1:3])
                back.append({s: offers[s][3] for s in offers})
                best = {s: (offers[s][0], ordered.index(s)) for s in offers}
            tails = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
            state = min(best, key=lambda s: (best[s][0] + INSERT_COST * tails[s], best[s][1]))
            total, tail = best[state][0] + INSERT_COST * tails[state], tails[state]
            picks = []
            for step in reversed(back):
                picks.append(4 * step[state] + state)
                state = step[state]
            gaps = 0 if low is None else high - low + 1 - distinct
            out.append((conv, gaps, *(int(x) for x in facts[:, 1:4].sum(0)), illegal, total, facts[:, 0].tolist(), picks[::-1], tail))
        yield pd.DataFrame(out, columns=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "segs", "picks", "tail"])


def _edits(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``(conv, place, step, edit, role)`` of each edit of the chosen audits; the role is null where it stays."""
    for batch in batches:
        conv, place, step, edit, role = [], [], [], [], []
        for key, places, codes, audit, state in zip(batch["conv"], batch["places"], batch["codes"], batch["audit"], batch["state"]):
            at = 0
            for k, e in enumerate(audit):
                if e == KEEP:
                    state = _AFTER_KEEP[state, int(codes[at]) & 3]
                elif e != DELETE:
                    state = _AFTER_INSERT[state]
                conv.append(key)
                place.append(int(places[min(at, len(places) - 1)]))
                step.append(k)
                edit.append(e)
                role.append(_ROLE[state] if e in (REROLE, INSERT) else None)
                at += e != INSERT
        yield pd.DataFrame({"conv": conv, "place": place, "step": step, "edit": edit, "role": role})


def repair(rows: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """The repair of ``rows`` in the form of ``damage``.

    The first table has ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of
    each conversation, the second the repaired rows ``(conv_id, place, step, edit, role, text)``
    in order of place and step.
    """
    placed = _placed(rows)
    conv_id = F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(rows.schema["conv_id"].dataType).alias("conv_id")
    solved = _segments(placed, segment).mapInPandas(_solve_segments, "conv string, seg long, places array<long>, codes array<int>, audits array<string>, summary binary")
    solved = materialize(solved, "solved")
    folded = solved.groupBy("conv").agg(F.collect_list("summary").alias("summaries"))
    folded = folded.mapInPandas(_fold, "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, segs array<long>, picks array<int>, tail int")
    folded = materialize(folded, "folded")
    chosen = folded.select("conv", "tail", F.array_max("segs").alias("last"), F.explode(F.arrays_zip("segs", "picks")).alias("c"))
    chosen = chosen.select("conv", F.col("c.segs").alias("seg"), F.col("c.picks").alias("pick"), F.when(F.col("c.segs") == F.col("last"), F.col("tail")).otherwise(0).alias("tail"))
    audit = F.concat(F.get("audits", F.col("pick")), F.expr(f"repeat('{INSERT}', tail)"))
    joined = solved.join(chosen, ["conv", "seg"]).select("conv", "seg", "places", "codes", audit.alias("audit"), F.shiftright("pick", 2).alias("state"))
    joined = materialize(joined, "chosen_audits")
    edits = joined.where("audit <> ''").mapInPandas(_edits, "conv string, place long, step long, edit string, role string")
    texts = placed.select("place", F.col("role").alias("old_role"), F.col("text").alias("old_text"))
    text = F.when(F.col("edit") == INSERT, "").otherwise(F.col("old_text"))
    repaired = edits.where(F.col("edit") != DELETE).join(texts, "place").select(conv_id, "place", "step", "edit", F.coalesce("role", "old_role").alias("role"), text.alias("text"))
    parts = joined.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "audit"))).alias("parts"))
    parts = parts.select("conv", F.array_join("parts.audit", "").alias("audit"))
    return folded.join(parts, "conv").select(conv_id, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), repaired


def _hash_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each conversation of a sorted partition; only the digest's state is held."""
    key, state = None, None
    for batch in batches:
        done: list[tuple] = []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            if state is None or conv != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        yield _digests(done, batch.schema.field("conv").type)
        kind = batch.schema.field("conv").type
    if state is not None:
        yield _digests([(key, state.hexdigest())], kind)


def _digests(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], names=["conv", "repaired_sha256"])


def digest(summary: DataFrame, repaired: DataFrame) -> DataFrame:
    """The summary with a digest of each conversation's repaired lines."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    lines = repaired.withColumnRenamed("conv_id", "conv").repartition("conv").sortWithinPartitions("conv", "place", "step").select("conv", "role", "text")
    digests = lines.mapInArrow(_hash_lines, f"conv {kind}, repaired_sha256 string")
    joined = summary.join(digests, summary["conv_id"].eqNullSafe(digests["conv"]), "left").drop("conv")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))
