import functools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymark.llm import chosen_path
from quaymark.llm.text import LOWER


def brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        own = (text or "").encode().translate(LOWER).split()
        sets[i] = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if len(own) >= size else ({tuple(own)} if own else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_matches_brute_force(docs, corpus, size, percent):
    got = chosen_path.near_duplicates(docs, size, percent).collect()
    assert len(got) == len(corpus)
    expected = brute([(r[0], r[1]) for r in corpus if r[0] is not None], size, percent)
    assert {r[0]: tuple(r)[1:] for r in got if r[0] is not None} == expected
    assert [tuple(r)[2:] for r in got if r[0] is None] == [(None, True)]


def test_large_group_of_near_copies_keeps_a_bridge(spark, monkeypatch):
    """More near copies than a leaf holds, and one text near only to a few of them."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(150):
        near = list(base)
        near[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(near)))
    far = list(rows[9][1].split())
    for k in range(150, 159):
        far[k] = f"far{k}"
    rows.append((900, " ".join(far)))
    monkeypatch.setattr(chosen_path, "DEPTH", 3)
    got = {r[0]: r[2] for r in chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {i: c for i, (_, c, _) in brute(rows, 3, 85).items()}


@functools.cache
def brute_of(rows):
    return brute(rows, 3, 85)


@pytest.mark.parametrize("entries", [1 << 19, 4000])
def test_two_large_groups_and_their_bridges(spark, monkeypatch, entries):
    """2,000 near copies around two bases that are not alike, a few texts between them, and a chain in one leaf."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    other = base[:51] + [f"v{k}" for k in range(9)]  # 49 of 67 shingles: below the threshold
    rows = []
    for i in range(2000):
        near = list(base if i % 2 else other)
        if i > 1:
            near[rng.randrange(2, 58)] = f"x{i}"
        rows.append((i, " ".join(near)))
    rows.append((5000, " ".join(base[:55] + other[55:])))
    chain = [f"c{k}" for k in range(120)]
    for k in range(12):
        rows.append((6000 + k, " ".join(chain)))
        chain[10 * k : 10 * k + 2] = [f"y{k}", f"z{k}"]
    rounds = []
    cut = chosen_path._dealt
    monkeypatch.setattr(chosen_path, "_dealt", lambda r, name: rounds.append(name) or cut(r, name))
    monkeypatch.setattr(chosen_path, "ENTRIES", entries)
    got = {r[0]: r[2] for r in chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {i: c for i, (_, c, _) in brute_of(tuple(rows)).items()}
    assert rounds and len(rounds) <= 12


def test_keep_one(docs, no_docs):
    kept = chosen_path.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and None in ids and 3 in ids and 70 not in ids
    assert chosen_path.keep_one_of_each(no_docs).count() == 0
    assert chosen_path.near_duplicates(docs.where(F.col("doc_id") == 80)).collect()[0].asDict() == {"doc_id": 80, "n_shingles": 0, "component_id": 80, "kept": True}


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_at_the_threshold_share_a_last_node(percent):
    rng = np.random.default_rng(1)
    pairs = 20_000
    one = rng.integers(0, 1 << 32, (pairs, chosen_path.TOKENS), dtype=np.uint32)
    other = np.where(rng.random(one.shape) < percent / 100, one, rng.integers(0, 1 << 32, one.shape, dtype=np.uint32))
    together = np.zeros(pairs, bool)
    for tree in range(chosen_path.TREES):
        start = chosen_path.mix(np.full(pairs, 1000 + tree, np.uint64))
        roots = [chosen_path._child(start, t) for t in (one, other)]
        for ends in zip(*(chosen_path._children(r, t, chosen_path.branches_needed(percent)) for r, t in zip(roots, (one, other)))):
            for _ in range(chosen_path.DEPTH - 1):
                ends = [chosen_path._child(e, t) for e, t in zip(ends, (one, other))]
            together |= ends[0] == ends[1]
    # By `miss`, one branch loses about 970 and 240 of them.
    assert (~together).sum() <= 10


def test_only_texts_that_are_compared_in_full_are_kept_for_the_rounds(spark, monkeypatch):
    """Whole texts go through one join; the joins after it read a table of the compared ones."""
    kept = {}

    def record(df, label, write=chosen_path.materialize):
        kept[label] = write(df, label)
        return kept[label]

    monkeypatch.setattr(chosen_path, "materialize", record)
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(0, text), (1, text + " end"), (2, text + " end")] + [(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(3, 60)]
    got = {r["doc_id"]: r["component_id"] for r in chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()}
    assert got == {i: 0 if i < 3 else i for i in range(60)}
    assert sorted(r["doc_id"] for r in kept["texts"].collect()) == [0, 1]


def test_tables_without_rows_start_no_python_workers_of_another_kind(spark):
    reps = spark.range(3).selectExpr("id AS rep", "CAST(repeat('abcd', 64) AS BINARY) AS tokens", "5L AS n")
    pairs, suspects = chosen_path.candidates(reps, 80)
    for frame in (pairs, suspects):
        assert "ExistingRDD" not in frame._jdf.queryExecution().toString()
        assert frame.dtypes[0][1] == frame.dtypes[1][1] == "bigint"
    assert {(r["a"], r["b"]) for r in pairs.collect()} == {(0, 1), (0, 2)}
