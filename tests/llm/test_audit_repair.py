"""Conversation repair against exhaustive search and against a plain program over whole strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quaymark.llm import audit_repair
from quaymark.llm.audit_repair import Audits

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_repair(rows):
    """Least cost, audit and lines of rows (role, text, blank, duplicate, truncated), by whole strings for each state."""
    best = {"": (0, "", ())}  # the legal end of the roles so far: "", s, u, a
    put = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def offer(table, state, cost, audit, lines):
        if state not in table or (cost, audit) < table[state][:2]:
            table[state] = (cost, audit, lines)

    def inserts(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                offer(table, put[state], cost + 3, audit + "I", (*lines, name[put[state]] + ":"))

    for role, text, blank, duplicate, truncated in rows:
        inserts(best)
        new = {}
        for state, (cost, audit, lines) in best.items():
            offer(new, state, cost + 4, audit + "D", lines)
            if blank or duplicate:
                continue
            more = 3 if truncated else 0
            after = role[:1]
            if after and (after == put[state] or (state == "" and after == "s")):
                offer(new, after, cost + more, audit + "K", (*lines, f"{role}:{text}"))
            offer(new, put[state], cost + more + 3, audit + "R", (*lines, f"{name[put[state]]}:{text}"))
        best = new
    inserts(best)
    return min(v for k, v in best.items() if k in ("", "a"))


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        blank = not last
        duplicate = not blank and (role, text) in seen
        seen.add((role, text))
        out.append((role, text, blank, duplicate, not blank and not duplicate and last not in ".!?"))
    return out


def expected(rows):
    """The query's row of each conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " "))
    result = {}
    for conv, group in itertools.groupby(rows, key=lambda r: r[0]):
        left = []
        for _, turn, role, text in group:
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            left += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:256], hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()))
        found = faults([r[1:] for r in left])
        turns = [r[0] for r in left if r[0] is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(left, left[1:]))
        cost, audit, lines = plain_repair(found)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        result[conv] = (gaps, *(sum(f[k] for f in found) for k in (2, 3, 4)), illegal, cost, audit, digest)
    return result


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversations(seed, count, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(count), None]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "sys"])
            text = rng.choice(["Yes.", "No", "  \t", "", None, f"Text {turn}!", "müde 😀?", "Ok. \n", f"open {turn}"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), role, text))
    return rows


@pytest.fixture(scope="module")
def rows():
    # The last conversation is long enough for several segments; one row is repeated exactly.
    rng = random.Random(8)
    long = [(900, t, rng.choice(["user", "assistant"]), rng.choice(["a.", f"b {t}.", f"c {t}", ""])) for t in range(150)]
    return [*conversations(3, 60, 9), *long, (901, 1, "user", "x" * 300_000 + "."), (901, 2, "assistant", "y."), (901, 2, "assistant", "y.")]


@pytest.mark.parametrize("segment", [0, 1, 3, audit_repair.SEGMENT])
def test_against_whole_strings(spark, rows, segment):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for clash in ("place", "seg", "audit", "cost", "code", "conv", "copy", "id", "head"):
        frame = frame.withColumn(clash, F.lit("clash"))
    found = audit_repair.digest(*audit_repair.repair(audit_repair.damage(frame), segment)).collect()
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in found} == expected(rows)
    assert len(found) == len({r[0] for r in rows})


def test_repaired_rows_are_legal(spark, rows):
    summary, repaired = audit_repair.repair(audit_repair.damage(spark.createDataFrame(rows, SCHEMA)))
    lines = {}
    for r in repaired.orderBy("conv_id", "place", "step").collect():
        lines.setdefault(r["conv_id"], []).append(r)
    for r in summary.collect():
        mine = lines.get(r["conv_id"], [])
        assert LEGAL.fullmatch("".join(x["role"][0] for x in mine))
        assert "".join(x["edit"] for x in mine) == r["audit"].replace("D", "")
        assert all(x["text"] == "" for x in mine if x["edit"] == "I")


def test_undamaged_and_dropped(spark):
    # No row of conversation 1 stays: its only turn is one that damage drops.
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(1, turn, "user", "a."), (2, 0, "user", "a."), (2, 1, "assistant", "b.")], SCHEMA)
    kept = {r["conv_id"]: r for r in audit_repair.digest(*audit_repair.repair(audit_repair.undamaged(frame))).collect()}
    assert (kept[2]["audit"], kept[2]["cost"]) == ("KK", 0)
    assert kept[2]["repaired_sha256"] == hashlib.sha256(b"user:a.\nassistant:b.").hexdigest()
    gone = {r["conv_id"]: r for r in audit_repair.digest(*audit_repair.repair(audit_repair.damage(frame))).collect()}[1]
    assert [gone[c] for c in COLUMNS] == [0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()]
    assert audit_repair.digest(*audit_repair.repair(audit_repair.damage(frame.limit(0)))).count() == 0


def test_text_ids(spark):
    rows = [("7", 0, "user", "a."), ("=", 0, "assistant", "b."), ("", 0, "user", "c."), (None, 0, "user", "d.")]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    found = audit_repair.digest(*audit_repair.repair(audit_repair.undamaged(frame))).collect()
    assert {r["conv_id"] for r in found} == {"7", "=", "", None} and len(found) == 4


def every_repair(rows):
    """All audits of at most two inserts between rows, with their cost."""
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(e != "D" and (r[2] or r[3]) for e, r in zip(edits, rows)):
            continue
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            if sum(gaps) > 4:
                continue
            audit, slots, cost = "", [], 3 * sum(gaps)
            for k, n in enumerate(gaps):
                audit += "I" * n
                slots += ["ua"] * n
                if k < len(rows):
                    e, r = edits[k], rows[k]
                    audit += e
                    cost += {"K": 0, "R": 3, "D": 4}[e] + (3 if r[4] and e != "D" else 0)
                    if e != "D":
                        slots.append(r[0][:1] if e == "K" else "ua")
            if any(LEGAL.fullmatch("".join(roles)) for roles in itertools.product(*slots)):
                yield cost, audit


def test_plain_program_against_every_repair():
    rng = random.Random(1)
    for _ in range(60):
        rows = faults([(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", "c!"])) for _ in range(rng.randint(0, 4))])
        assert plain_repair(rows)[:2] == min(every_repair(rows))


@pytest.mark.parametrize("modulus", [1, 2, 7, (1 << 61) - 1])
def test_comparison_survives_hash_collisions(modulus):
    rng, tree = random.Random(4), Audits(modulus=modulus)
    nodes = [0]
    for _ in range(300):
        nodes.append(tree.extend(rng.choice(nodes[-40:]), rng.choice("DIKR")))
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        x, y = tree.text(a), tree.text(b)
        assert (tree.compare(a, b) > 0) - (tree.compare(a, b) < 0) == (x > y) - (x < y)


def test_inserts_after_a_segment_without_rows(spark):
    turn = next(t for t in range(1, 1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0 and zlib.crc32(f"5:{t - 1}".encode()) % 20 > 4)
    frame = spark.createDataFrame([(5, turn - 1, "user", "a."), (5, turn, "assistant", "b.")], SCHEMA)
    found = audit_repair.digest(*audit_repair.repair(audit_repair.damage(frame), segment=0)).collect()
    assert [(r["audit"], r["cost"]) for r in found] == [("KI", 3)]
    assert found[0]["repaired_sha256"] == hashlib.sha256(b"user:a.\nassistant:").hexdigest()
