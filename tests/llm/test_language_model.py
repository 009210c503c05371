import math
from collections import Counter

import numpy as np
import pytest

from quaymark.llm import bloom_lm


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def test_base_score_is_exact(docs, corpus, no_docs, monkeypatch):
    monkeypatch.setattr(bloom_lm, "FREQUENT", 2000)
    learnt = docs.where("doc_id % 10 <> 0")
    model = bloom_lm.learn(learnt)
    counts = Counter(t for r in corpus if r[0] is not None and r[0] % 10 for t in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    assert (model.tokens, model.words) == (n, v)
    assert 0 < len(model.filter.value.frequent) < v
    rows = bloom_lm.score(docs, model).collect()
    expected = [(r[0], len(tokens(r[1])), sum(t in counts for t in tokens(r[1])), n, sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(r[1]))) for r in corpus]
    key = lambda r: (r[0] is None, r[0] or 0)
    for got, want in zip(sorted(rows, key=key), sorted(expected, key=key), strict=True):
        assert tuple(got)[:4] == want[:4]
        assert got["base_score"] == pytest.approx(want[4], abs=1e-6)
        assert -9 * got["n_tokens"] < got["score"] < 0
    better = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 60]
    assert sum(r["score"] for r in better) > sum(r["base_score"] for r in better)
    assert bloom_lm.score(no_docs, model).count() == 0
    empty = bloom_lm.learn(no_docs)
    assert {r["base_score"] == pytest.approx(0) for r in bloom_lm.score(docs, empty).collect()} == {True}


def test_filter_returns_levels(docs):
    model = bloom_lm.learn(docs.where("doc_id < 70")).filter.value
    from quaymark.llm.text import word_hashes

    texts = [r["text"] for r in docs.where("doc_id < 70").select("text").collect()]
    counts = Counter(word_hashes(texts)[0].tolist())
    keys = np.array(list(counts), np.uint64)
    levels = bloom_lm._levels(np.array(list(counts.values())))
    assert (bloom_lm._probe(keys, model) >= levels).all()
    assert (bloom_lm._probe(keys, model) == levels).mean() > 0.9
    unknown = bloom_lm.mix(np.arange(10_000, dtype=np.uint64) + np.uint64(1 << 50))
    assert (bloom_lm._probe(unknown, model) > 0).mean() < 0.05


def test_full_filter_drops_rare_entries_only(docs, monkeypatch):
    whole = bloom_lm.learn(docs.where("doc_id < 70"))
    monkeypatch.setattr(bloom_lm, "MOST_BITS", 1 << 14)
    small = bloom_lm.learn(docs.where("doc_id < 70"))
    assert len(small.filter.value.bits) == 1 << 11 and small.tokens == whole.tokens
    rows = bloom_lm.score(docs, small)
    exact = {r[0]: r[1] for r in bloom_lm.score(docs, whole).select("doc_id", "base_score").collect()}
    assert {r["doc_id"]: r["base_score"] for r in rows.collect()} == {k: pytest.approx(v, abs=1e-6) for k, v in exact.items()}


def test_packing():
    for values in ([], [0], [5, 5, 9], [3, 1 << 40, 1 << 63]):
        array = np.array(values, np.uint64)
        assert bloom_lm._unpack(bloom_lm._pack(array)).tolist() == values
        if values:
            assert bloom_lm._unpack_sorted(bloom_lm._pack_sorted(array)).tolist() == values
    shifted = np.array([1 << 16, 7 << 30], np.uint64)
    assert bloom_lm._unpack_sorted(bloom_lm._pack_sorted(shifted)).tolist() == shifted.tolist()


def test_probabilities_stay_below_one(docs):
    model = bloom_lm.learn(docs.where("doc_id < 60 and length(text) > 0")).filter.value
    from quaymark.llm.text import word_hashes

    words = np.unique(word_hashes([r["text"] for r in docs.where("doc_id < 60").select("text").collect()])[0])
    words = np.append(words, bloom_lm.END)
    for context in words[:20]:
        pairs_before = np.full(len(words), context)
        own, ctx = bloom_lm._probe(words, model), bloom_lm._probe(np.array([context]), model)
        assert (own > 0).all() and ctx[0] > 0
        # Through texts of two tokens, of which the second is the one asked for.
        tokens_ = np.stack([pairs_before, words], 1).ravel()
        before = np.stack([np.full(len(words), bloom_lm.START), pairs_before], 1).ravel()
        logs = bloom_lm._log_probabilities(tokens_, before, model)[1::2]
        assert (10**logs).sum() < 1.1


@pytest.mark.parametrize("most", [1 << 14, 1])
def test_scores_do_not_depend_on_what_is_sent(docs, monkeypatch, most):
    def scores(model):
        return sorted([tuple(r) for r in bloom_lm.score(docs, model).collect()], key=str)

    whole = bloom_lm.learn(docs.where("doc_id < 70"))
    expected = scores(whole)
    monkeypatch.setattr(bloom_lm, "MOST_BITS", most)
    split = bloom_lm.learn(docs.where("doc_id < 70"))
    sent = split.filter.value
    assert sent.held < sent.segments == whole.filter.value.held and sent.block == whole.filter.value.block
    got = scores(split)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in expected], abs=1e-6)


@pytest.mark.parametrize("most", [1 << 40, 1])
def test_score_is_that_of_the_quantised_model(docs, corpus, monkeypatch, most):
    """With so many bits that the filter gives no false answer."""
    monkeypatch.setattr(bloom_lm, "BITS_PER_ENTRY", 400)
    monkeypatch.setattr(bloom_lm, "MOST_BITS", most)
    lines = [tokens(r[1]) for r in corpus if r[0] is not None and r[0] % 10]
    words = Counter(t for line in lines for t in line)
    pairs = Counter(pair for line in lines for pair in zip(["start", *line], line))
    n, v = sum(words.values()), len(words)

    def level(count):
        return 1 + math.floor(math.log(count) / math.log(1.5) + 1e-9) if count else 0

    def down(at):
        return math.ceil(1.5 ** (at - 1) - 1e-9) if at else 0

    def up(at):
        return math.ceil(1.5**at - 1e-9) if at else 0

    def logs(line):
        for before, word in zip(["start", *line], line):
            own, context = level(words[word]), 99 if before == "start" else level(words[before])
            joint = down(min(level(pairs[before, word]), own, context))
            times = up(level(words[None])) if before == "start" else up(context)
            yield math.log10((joint + 10 * (down(own) + 0.1) / (n + 0.1 * (v + 1))) / (times + 10))

    model = bloom_lm.learn(docs.where("doc_id % 10 <> 0"))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], r["score"]) for r in bloom_lm.score(docs, model).collect()), key=key)
    expected = sorted(((r[0], sum(logs(tokens(r[1])))) for r in corpus), key=key)
    assert [i for i, _ in got] == [i for i, _ in expected]
    assert [s for _, s in got] == pytest.approx([s for _, s in expected], abs=1e-6)


def test_packing_in_parts():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**64, 500, dtype=np.uint64))
    bounds = np.array([0, 1, 2, 300, len(keys)])
    for shift in (0, 16):
        some = np.unique(keys >> np.uint64(shift) << np.uint64(shift))
        packets = bloom_lm._pack_sorted_parts(some, bounds)
        assert packets == [bloom_lm._pack_sorted(some[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        back, where = bloom_lm._unpack_sorted_parts(packets)
        assert back.tolist() == some.tolist() and where.tolist() == bounds.tolist()
    values = np.array([0, 1, 1 << 63, 255, 256, 7], np.uint64)
    packets = bloom_lm._pack_parts(values, np.array([0, 2, 3, 6]))
    assert bloom_lm._unpack_parts(packets)[0].tolist() == values.tolist()
    # Packets that leave the low bits out beside one that doesn't.
    mixed = [np.array([1 << 16, 3 << 40], np.uint64), np.array([5, 6], np.uint64)]
    assert bloom_lm._unpack_sorted_parts([bloom_lm._pack_sorted(k) for k in mixed])[0].tolist() == [k for part in mixed for k in part.tolist()]
    for some in (keys, keys[:0], np.array([0, 0, 2**64 - 1, 0], np.uint64)):
        assert bloom_lm._distinct(some).tolist() == np.unique(some).tolist()


def test_answers_cost_by_keys_and_not_by_packets(monkeypatch):
    """A segment gets a packet of each piece of text, so their number grows with the text."""
    import pandas as pd

    segments, block, segment = 64, 1 << 17, 5
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(segment << 58, (segment + 1) << 58, 2000, dtype=np.uint64))
    learnt, counts = keys[::2], np.arange(1, len(keys[::2]) + 1).astype(np.uint64)
    packed = [segment, bloom_lm._pack_sorted(learnt), bloom_lm._pack(counts)]
    pairs = [bloom_lm._pack_sorted(learnt), bloom_lm._pack(bloom_lm._levels(counts))]
    own = next(bloom_lm._build(segments, block, 900)([pd.DataFrame([packed + pairs], columns=["segment", "words", "counts", "pairs", "levels"])]))
    often = np.frombuffer(own["often"][0], np.uint64)
    bits = np.frombuffer(own["block"][0], np.uint8)
    levels = bloom_lm._levels_in(bits, segment, keys, segments, block)
    assert often.tolist() == learnt[counts > 900].tolist() and np.frombuffer(own["often_levels"][0], np.uint8).tolist() == levels[np.isin(keys, often)].tolist()
    calls = []
    monkeypatch.setattr(bloom_lm, "mix", lambda x, f=bloom_lm.mix: calls.append(len(x)) or f(x))

    def answered(packets, held):
        cuts = [np.sort(part) for part in np.array_split(rng.permutation(keys), packets)]
        rows = [(f"p{i}", segment, *[None if i % 3 == skip else bloom_lm._pack_sorted(part) for skip in (1, 2)]) for i, part in enumerate(cuts)]
        calls.clear()
        got = bloom_lm._answer(segments, block, held)(own, pd.DataFrame(rows, columns=["batch", "segment", "words", "pairs"]))
        n = len(calls)
        assert got["batch"].tolist() == [r[0] for r in rows]
        for i, part in enumerate(cuts):
            at = np.searchsorted(keys, part)
            if i % 3 == 1:
                assert got["counts"][i] is None and got["words"][i] is None
            else:
                assert bloom_lm._unpack(got["counts"][i]).tolist() == [0 if k % 2 else int(counts[k // 2]) for k in at]
                assert got["words"][i] is None if held > segment else list(got["words"][i]) == levels[at].tolist()
            assert got["pairs"][i] is None if i % 3 == 2 else list(got["pairs"][i]) == levels[at].tolist()
        return n

    assert answered(200, 0) < 2 * answered(4, 0)
    monkeypatch.setattr(bloom_lm, "ANSWER_BYTES", 1000)
    answered(200, 0)


def test_frequent_words_are_not_asked_for(docs, monkeypatch):
    """Their levels are sent with their counts, also those of segments that are not."""
    monkeypatch.setattr(bloom_lm, "MOST_BITS", 1)
    monkeypatch.setattr(bloom_lm, "FREQUENT", 2000)
    model = bloom_lm.learn(docs.where("doc_id < 70"))
    sent = model.filter.value
    assert sent.held == 0 and 0 < len(sent.frequent) < model.words
    asked = docs.selectExpr("doc_id", "text").mapInArrow(bloom_lm._asks(model.filter), "batch string, segment int, words binary, pairs binary").collect()
    words = np.concatenate([bloom_lm._unpack_sorted(r["words"]) for r in asked if r["words"]])
    assert len(words) and not np.isin(words, sent.frequent).any()
    monkeypatch.setattr(bloom_lm, "MOST_BITS", 1 << 40)
    whole = bloom_lm.learn(docs.where("doc_id < 70")).filter.value
    assert whole.held == whole.segments and bloom_lm._probe(whole.frequent, whole).tolist() == sent.frequent_levels.tolist()


@pytest.mark.parametrize("share, held", [(4, 16), (8, 8), (9, 0)])
def test_a_small_share_of_the_filter_is_not_sent(docs, monkeypatch, share, held):
    learnt = docs.where("doc_id < 70")
    whole = bloom_lm.learn(learnt).filter.value
    monkeypatch.setattr(bloom_lm, "MOST_BITS", whole.segments * whole.block // share)
    sent = bloom_lm.learn(learnt).filter.value
    assert (sent.held, len(sent.bits)) == (held, held * whole.block // 8)


def test_learning_leaves_only_the_filter(spark, docs):
    from pathlib import Path

    from quaymark.session import scratch_path

    folder = Path(scratch_path(spark, "x")).parent
    before = set(folder.glob("lm_*"))
    model = bloom_lm.learn(docs.where("doc_id < 70"))
    assert [p.name.split("-")[0] for p in set(folder.glob("lm_*")) - before] == ["lm_filter"]
    assert bloom_lm.score(docs, model).count() == docs.count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
