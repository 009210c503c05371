"""The registered queries on small tables, and the pipeline stage by stage."""

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from quaymark.llm import byte_bpe, chosen_path, queries

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs.select(*DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    vectors = [(i, [float((i * k) % 7 - 3) for k in range(1, 9)], i % 2) for i in range(50)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame([(1, "two words and more"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    turns = [(i // 4, i % 4, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(40)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return path


def test_names():
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in queries.QUERIES) == 1
    assert queries.QUERIES.items() <= __spark_entry__.queries().items()
    assert {"op4_licence_scan", "op11_stratified_search", "op12_phrase_index"} <= __spark_entry__.oracle_sql().keys()


COLUMNS = {
    "op1": ["doc_id", "n_shingles", "component_id", "kept"],
    "op2": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op3": ["doc_id", "source", "epoch", "n_tokens", "place"],
    "op4": ["doc_id", "line", "licence", "dice"],
    "op5": ["query_id", "rank", "vec_id", "score"],
    "op6": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8": ["vec_id", "n_links", "component_id", "kept"],
    "op9": ["doc_id", "held_out", "lang_pred", "score"],
    "op10": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op11": ["item_id", "rank", "doc_id", "score"],
    "op12": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op13": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}


@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES if n != "pipeline"))
def test_query(spark, folder, name):
    found = queries.QUERIES[name](spark, folder)
    assert set(COLUMNS[name.split("_")[0]]) <= set(found.columns)
    assert found.count() >= 0


def test_pipeline_stages(spark, folder, docs, corpus, tmp_path):
    step = spark.read.parquet(f"{folder}/documents.parquet")
    outputs = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, step, folder).write.parquet(str(tmp_path / name))
        step = spark.read.parquet(str(tmp_path / name))
        outputs[name] = step.collect()
        if name != "tokens":
            assert step.columns == DOCUMENTS
    texts = {}
    for r in corpus:
        texts.setdefault(r[0], r[1])
    # Only documents without letters go.
    assert {r["doc_id"] for r in outputs["language"]} == set(texts) - {80, 81, 82, 88}
    assert len(outputs["language"]) == len(corpus) - 4
    kept = chosen_path.near_duplicates(docs, 5, 80).where("kept").select("doc_id").distinct().collect()
    assert {r["doc_id"] for r in outputs["near_duplicates"]} == {r[0] for r in kept} - {80, 81, 82, 88}
    assert sorted((r["doc_id"] for r in outputs["secrets"]), key=str) == sorted((r["doc_id"] for r in outputs["near_duplicates"]), key=str)
    assert {r["doc_id"] for r in outputs["mixing"]} <= {r["doc_id"] for r in outputs["secrets"]}
    masked = {r["doc_id"]: r["text"] for r in outputs["secrets"]}
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(outputs["tokens"]) == len(outputs["mixing"])
    for r in outputs["tokens"]:
        assert r["ids"] == library.encode_ordinary(masked[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_pipeline_runs_whole(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "lang", "source", "ids", "n_tokens"]


def test_pipeline_of_nothing(spark, tmp_path, docs):
    docs.select(*DOCUMENTS).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
