import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from quaymark.llm import byte_bpe


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encodes_like_the_library_and_back(docs, corpus, ranks, library, no_docs):
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    assert encoded.columns == [c for c in docs.columns if c not in ("text", "ids")] + ["ids"]
    rows = byte_bpe.decode(encoded, ranks).select("doc_id", "ids", "decoded").collect()
    expected = sorted(((r[0] is None, r[0] or 0, library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in corpus), key=str)
    assert sorted(((r[0] is None, r[0] or 0, r[1], bytes(r[2])) for r in rows), key=str) == expected
    assert byte_bpe.encode(no_docs, ranks, public_tokenizers.PATTERN).count() == 0


def ids_of(words, merges):
    return [np.frombuffer(packed, np.int32).tolist() for packed in byte_bpe.replay(words, merges)]


def test_replay_in_rank_order(ranks, library):
    words = ["ababababab", "aaaaaaaaaaa", "tiontiontion", "x", " the", "ßß😀", "y" * 5000]
    merges = byte_bpe.merges_of(ranks)
    assert ids_of([w.encode() for w in words], merges) == [library.encode_ordinary(w) for w in words]
    assert ids_of([b"", b"ab", b""], merges) == [[], library.encode_ordinary("ab"), []]
    assert ids_of([], merges) == ids_of([b""], merges)[1:]
    # A merge that makes a pair of a lower rank possible comes before the next place of its own rank.
    odd = byte_bpe.merges_of({bytes([i]): i for i in range(256)} | {b"aba": 300, b"ab": 301})
    assert ids_of([b"abab"], odd) == [[300, ord("b")]]


def test_too_large_a_vocabulary(tmp_path, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_VOCABULARY", 2)
    path = tmp_path / "ranks"
    path.write_text("YQ== 0\nYg== 1\nYw== 2\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(path))


def test_null_ids_decode_to_nothing(spark, ranks):
    frame = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in byte_bpe.decode(frame, ranks).collect()] == [b"", b""]


def test_memory_is_bounded_by_a_piece_of_text(docs, ranks, library, monkeypatch):
    rng = np.random.default_rng(3)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnop"), (200_000, 9))]
    # Texts of a usual size, then one that is longer than a piece.
    texts = [" ".join(words[i : i + 100]) for i in range(0, 100_000, 100)] + [" ".join(words[100_000:]), "", None]
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    run = byte_bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    try:
        made = list(run([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # A long text's words and their ids stay known; what a piece takes for its merges does not add up.
    assert peak < 150 << 20
    ids = [line for part in made for line in part.column("ids").to_pylist()]
    assert ids == [library.encode_ordinary(text or "") for text in texts]


@pytest.mark.parametrize("operator", ["encode", "near_duplicates", "predict"])
def test_texts_reach_python_in_small_batches(spark, ranks, operator):
    """2,000 texts of 10,000 characters in one partition come in batches of about 2 MB, not of 20 MB."""
    from quaymark.llm import batches, chosen_path, nearest_centroid

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    some = spark.createDataFrame([(1, "one two three", "en")], "doc_id long, text string, lang string")

    def sizes(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([part.nbytes])], names=["bytes"])

    try:
        spark.conf.set(setting, "64m")
        if operator == "encode":
            byte_bpe.encode(some, ranks, public_tokenizers.PATTERN)
        elif operator == "near_duplicates":
            chosen_path.near_duplicates(some)
        else:
            nearest_centroid.predict(some, nearest_centroid.fit(some))
        wide = spark.range(0, 2000, 1, 1).select("id", F.repeat(F.lit("0123456789"), 1000).alias("text"))
        got = [r[0] for r in wide.mapInArrow(sizes, "bytes long").collect()]
        assert sum(got) >= 20_000_000 and max(got) <= 1.1 * batches.BATCH
        spark.conf.set(setting, "1m")
        batches.bound_batches(spark)
        assert spark.conf.get(setting) == "1m"
    finally:
        spark.conf.set(setting, before)
