import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from quaymark.llm import text as T
from quaymark.llm.components import connected_components


def words(text):
    return (text or "").encode().translate(T.LOWER).split()


def test_word_hashes_follow_words(corpus):
    texts = [r[1] for r in corpus]
    hashes, offsets = T.word_hashes(texts)
    seen = {}
    for text, a, b in zip(texts, offsets, offsets[1:]):
        own = words(text)
        assert b - a == len(own)
        for w, h in zip(own, hashes[a:b].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_pieces_do_not_change_hashes(monkeypatch, corpus):
    texts = [r[1] for r in corpus]
    whole = T.word_hashes(texts)
    monkeypatch.setattr(T, "PIECE", 64)
    for a, b in zip(whole, T.word_hashes(texts)):
        assert np.array_equal(a, b)


def test_hashing_holds_little_beside_its_texts():
    texts = ["some words of no great length " * 4000] * 32  # 3.8 MB
    T.word_hashes(texts[:1])
    tracemalloc.start()
    T.word_hashes(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20


def test_shingle_sets(corpus):
    texts = [r[1] for r in corpus]
    for size in (3, 5):
        for text, s in zip(texts, T.shingle_sets(texts, size)):
            own = words(text)
            expected = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if len(own) >= size else ({tuple(own)} if own else set())
            assert len(s) == len(expected)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 1000 + i) for i in range(50)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in [100, *range(1000, 1050)]} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    assert connected_components(spark.createDataFrame([(2, 1)], "u long, v long").withColumn("x", F.lit(1))).count() == 2
