import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymark.llm import nn_descent, segment_search

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        rows.append((i, rng.standard_normal(16).round(2).tolist(), int(i % 3)))
    for i in range(400, 440):  # near copies of one vector, more than a list holds
        rows.append((i, (np.array(rows[5][1]) + rng.standard_normal(16) * 0.08).tolist(), 2))
    for i in range(440, 446):  # exact copies, one of another label
        rows.append((i, rows[9][1], 0 if i < 445 else 1))
    for i in range(446, 476):
        rows.append((i, (np.array(rows[i - 446][1]) * 2 + rng.standard_normal(16) * 0.1).tolist(), rows[i - 446][2]))
    rows += [(500, None, 1), (501, [1.0, None] * 8, 1), (502, [NAN] * 16, 1), (503, [INF] + [0.0] * 15, 1), (504, [0.0] * 16, 1), (505, rows[0][1], None), (506, [], 1), (507, [1.0, 2.0], 1), (508, [2.0, 4.0], 1), (None, rows[0][1], 0), (5, rows[5][1], 2), (520, rows[0][1], 0), (540, rows[0][1], 0)]
    return rows


@pytest.fixture(scope="module")
def table(spark, vectors):
    return spark.createDataFrame(vectors, SCHEMA).withColumn("u", F.lit("clash")).withColumn("score", F.lit("clash")).withColumn("dims", F.lit("clash")).repartition(3)


def whole(x):
    return x is not None and all(c is not None and math.isfinite(c) for c in x)


@pytest.mark.parametrize("small", [False, True])
def test_top_k(spark, table, vectors, monkeypatch, small):
    if small:  # a first search that sets a line for the second, and many tiles
        for name, value in (("SAMPLE", 100), ("QUERY_TILE", 3), ("ROW_TILE", 30), ("QUERY_BLOCK", 5)):
            monkeypatch.setattr(segment_search, name, value)
    got = {}
    for r in segment_search.top_k(table, table.where("vec_id % 20 = 0"), 20, 64).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ints = [(i, [math.floor(64 * float(np.float32(c))) for c in x]) for i, x, _ in vectors if i is not None and whole(x)]
    expected = {}
    for q, x in ints:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ints if i != q and len(y) == len(x))[:20]
            expected[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    expected = {q: v for q, v in expected.items() if v}
    assert {q: sorted(v) for q, v in got.items()} == expected
    few = table.where("vec_id in (0, 20, 507, 500)")
    assert len(segment_search.top_k(few, few, 20, 64).collect()) == 2
    assert segment_search.top_k(table.limit(0), table.limit(0), 20, 64).count() == 0
    assert segment_search.top_k(table, table.where("vec_id = 500"), 20, 64).count() == 0


def test_bounds_exclude_most_pairs_and_no_result():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 64))
    x = np.floor(64 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    side = segment_search.Side(x, segment_search.statistics(x.astype(float)))
    some = segment_search._cut(side, slice(0, 200))
    scores = some.whole @ x.T
    least = np.sort(scores, axis=1)[:, -20].astype(float)
    i, j = segment_search.candidates(some, side, least)
    assert len(i) < 0.1 * scores.size
    assert (segment_search.products(some, side, i, j) == scores[i, j]).all()
    assert set(zip(*np.nonzero(scores >= least[:, None]))) <= set(zip(i, j))


def brute(vectors, threshold):
    rows = [(i, np.array(x, np.float32).astype(float), label) for i, x, label in vectors if i is not None and label is not None and whole(x) and any(x)]
    ids = sorted({i for i, _, _ in vectors if i is not None})
    links = {i: set() for i in ids}
    for n, (i, x, a) in enumerate(rows):
        for j, y, b in rows[n + 1 :]:
            if i != j and a == b and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i].add(j)
                links[j].add(i)
    component = {}
    for i in ids:
        if i not in component:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in component:
                    component[k] = i
                    todo += links[k]
    return {i: (len(links[i]), component[i], component[i] == i) for i in ids}


def test_near_duplicates(table, vectors):
    plain = [v for k, v in enumerate(vectors) if v[0] != 5 or k < 400]
    got = nn_descent.near_duplicate_vectors(table.dropDuplicates(["vec_id", "embedding"]), 0.93).collect()
    assert len(got) == len(plain)
    assert {r[0]: tuple(r)[1:] for r in got if r[0] is not None} == brute(plain, 0.93)
    assert [tuple(r)[1:] for r in got if r[0] is None] == [(0, None, True)]


def test_near_duplicates_of_nothing(table):
    assert nn_descent.near_duplicate_vectors(table.limit(0)).count() == 0
    row = nn_descent.near_duplicate_vectors(table.where("vec_id = 500")).collect()
    assert [tuple(r) for r in row] == [(500, 0, 500, True)]


def test_large_group_is_whole(spark):
    rng = random.Random(4)
    rows = [(i, [1.0 + rng.random() * 0.1 for _ in range(8)] if i % 2 else [rng.gauss(0, 1) for _ in range(8)], 1) for i in range(1200)]
    got = {r[0]: tuple(r)[1:] for r in nn_descent.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    expected = brute(rows, 0.93)
    hot = [i for i in expected if expected[i][0] > 500]
    assert len(hot) >= 600 and all(got[i] == expected[i] for i in hot)
    found, true = sum(g[0] for g in got.values()), sum(e[0] for e in expected.values())
    assert found <= true and found >= 0.98 * true


@pytest.mark.parametrize("audited", [1000, 200])
def test_single_links_beside_a_large_group(spark, monkeypatch, audited):
    """Windows far smaller than the label lose isolated pairs, which a group of copies must not hide."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((500, 24))
    near = base[:200] + rng.standard_normal((200, 24)) * 0.25
    group = base[499] + rng.standard_normal((60, 24)) * 0.02
    rows = [(i, x.tolist(), 1) for i, x in enumerate(np.concatenate([base, near, group]))]
    for name, value in (("WINDOW", 4), ("ORDERS", 1), ("ROUNDS", 0), ("EXTRA", 0), ("AUDITED", audited)):
        monkeypatch.setattr(nn_descent, name, value)
    # Too few orders, as for signs that crowd together.
    monkeypatch.setattr(nn_descent, "MISS", 0.5, raising=False)
    got = {r[0]: tuple(r)[1:] for r in nn_descent.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows, 0.93)


def test_orders_grow_with_the_label():
    few, some, many = nn_descent.orders_needed(np.array([200, 20_000, 400_000]), 0.93)
    assert nn_descent.ORDERS <= few < some < many < 50
