"""Ranked search and phrase search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymark.llm import phrase_index, stratified_search

LOWER = {i: i + 32 for i in range(65, 91)}
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    return TERM.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def items(spark, corpus):
    by_id = {r[0]: r[1] for r in corpus}
    rows = [
        (1, by_id[4]),
        (2, by_id[7]),
        (3, "Two WORDS"),
        (4, None),
        (5, " .,- "),
        (6, "no such thing anywhere here at all in these texts of ours"),
        (7, " ".join(by_id[85].split()[500:560])),
        (8, " ".join(by_id[9].split()[3:20]) + " zzz " + " ".join(by_id[11].split()[5:17])),
        (9, "müde straße 😀 ÄÖ É"),
        (10, by_id[7]),
        (10, by_id[12]),
        (None, by_id[13]),
        (11, "the"),
    ]
    frame = spark.createDataFrame(rows, ITEMS).repartition(3)
    for clash in ("seq", "term", "item", "pos", "w"):
        frame = frame.withColumn(clash, F.lit("clash"))
    return rows, frame


def ranked(corpus, items, k):
    docs = [(r[0], Counter(words(r[1]))) for r in corpus]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, length = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(words(text))
    out = set()
    for item, terms in asked.items():
        scores = []
        for doc, counts, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * counts[t] // (1000 * counts[t] + 20 * m)) for t in terms if counts[t])
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out |= {(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.mark.parametrize("k,block,first,pairs", [(50, 1024, 1024, 1 << 20), (5, 2, 3, 40), (3, 8, 1, 1 << 20)])
def test_ranked_search(spark, docs, corpus, items, k, block, first, pairs):
    rows, frame = items
    found = stratified_search.search(docs, frame, k, block, first, pairs).collect()
    assert sorted(tuple(r) for r in found) == sorted(ranked(corpus, rows, k))


def test_ranked_search_of_nothing(spark, docs, no_docs, items):
    assert stratified_search.search(no_docs, items[1]).count() == 0
    assert stratified_search.search(docs, items[1].limit(0)).count() == 0
    assert stratified_search.search(docs, items[1].where("item_id in (4, 5, 6)").withColumn("text", F.lit("qqqq"))).count() == 0


def test_bounds_leave_strata_unread(spark):
    """Documents that only have the common words are never scored once better ones are known."""
    rng = random.Random(2)
    common, rare = [f"c{i}" for i in range(5)], [f"r{i}" for i in range(5)]
    rows = [(i, " ".join(rng.choice(common) for _ in range(10 + i % 30)) + (" " + " ".join(rare * 3) if i % 100 == 0 else "")) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(1, " ".join(common + rare))], ITEMS)
    found = {tuple(r) for r in stratified_search.search(docs, asked, 10, block=64, first=400).collect()}
    assert found == ranked(rows, [(1, " ".join(common + rare))], 10)
    pairs = stratified_search.item_terms(asked)
    known = sorted(r["term"] & (2**64 - 1) for r in pairs.collect())
    counted = stratified_search.count_terms(docs, np.array(known, np.uint64))
    index, top, documents = stratified_search.strata(counted, 64)
    sizes = index.select("m", (F.length("docs") / 8).alias("n")).groupBy("m").agg(F.count("*").alias("blocks"), F.sum("n").alias("n"))
    assert documents == 3000 and sizes.agg(F.max("blocks")).first()[0] > 1 and sizes.agg(F.sum("n")).first()[0] == 3000
    # With the tenth score known, strata without the rare words stay below it.
    limit = min(f[3] for f in found)
    weight = {i: math.floor(1000 * math.log((2 * 3000 + 2) / (2 * r["n"] + 1))) for i, r in enumerate(counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).orderBy("t").collect())}
    bounds = {}
    for r in top.collect():
        bounds[r["m"]] = bounds.get(r["m"], 0) + weight[r["place"]] * r["impact"]
    assert 0 < sum(b >= limit for b in bounds.values()) < 0.5 * len(bounds)


def contaminated(corpus, items, size):
    windows = []
    for item, text in items:
        w = words(text)
        k = min(size, len(w))
        if item is not None and w:
            windows += [(str(item), w[s : s + k]) for s in range(len(w) - k + 1)]
    by_first = {}
    for item, v in windows:
        by_first.setdefault(v[0], []).append((item, v))
    out = []
    for doc, text, *_ in corpus:
        w, hit, ids = words(text), set(), set()
        for p, word in enumerate(w):
            for item, v in by_first.get(word, []):
                if w[p : p + len(v)] == v:
                    hit.update(range(p, p + len(v)))
                    ids.add(item)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


def key(row):
    return tuple(str(v) for v in row)


@pytest.mark.parametrize("size,most", [(10, 1 << 20), (10, 0), (4, 1 << 20), (1, 1 << 20)])
def test_phrases(docs, corpus, items, size, most):
    rows, frame = items
    found = phrase_index.digest(phrase_index.contamination(docs, frame, size, most=most)).collect()
    assert sorted((tuple(r) for r in found), key=key) == sorted(contaminated(corpus, rows, size), key=key)
    assert any(r["contaminated"] for r in found) and not all(r["contaminated"] for r in found)


def test_phrases_of_nothing(docs, no_docs, items, corpus):
    assert phrase_index.contamination(no_docs, items[1]).count() == 0
    clean = phrase_index.contamination(docs, items[1].limit(0)).collect()
    assert sorted((r["n_words"] for r in clean)) == sorted(len(words(r[1])) for r in corpus)
    assert not any(r["contaminated"] for r in clean)


def test_one_passage_in_very_many_documents(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"a b {passage} c" if i % 2 else "a b c w1 w2 w3 w4 w5 w6 w7 w8 w9") for i in range(3000)]
    found = phrase_index.contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, passage), (2, f"a b {passage}")], ITEMS))
    counts = {(r["doc_id"] % 2, r["n_hit"], tuple(r["item_ids"])) for r in found.collect()}
    assert counts == {(0, 0, ()), (1, 32, ("1", "2"))}


def near(text, phrase, size, slop):
    """Places of a phrase's windows in a text, each word at most ``slop`` places off; the rarest two words count as anchors."""
    w, v = words(text), words(phrase)
    return any(all(any(0 <= s + p + d < len(w) and w[s + p + d] == v[p] for d in range(-slop, slop + 1)) for p in range(b, b + size)) for b in range(len(v) - size + 1) for s in range(-len(v), len(w)))


def test_proximity(spark):
    rng = random.Random(6)
    phrase = [f"p{i}" for i in range(14)]
    rows = []
    for i in range(60):
        text = list(phrase)
        for _ in range(i % 4):
            text.insert(rng.randrange(len(text)), f"x{rng.randrange(9)}")
        if i % 5 == 0:
            a = rng.randrange(13)
            text[a], text[a + 1] = text[a + 1], text[a]
        if i % 7 == 0:
            text[rng.randrange(len(text))] = "gone"
        rows.append((i, " ".join([f"f{rng.randrange(30)}" for _ in range(rng.randrange(5))] + text)))
    docs, asked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(phrase))], ITEMS)
    for slop in (0, 1, 2):
        found = {r["doc_id"] for r in phrase_index.contamination(docs, asked, 10, slop).where("contaminated").collect()}
        assert found == {i for i, t in rows if near(t, " ".join(phrase), 10, slop)}
