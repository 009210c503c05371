import pytest
from pyspark.sql import functions as F

from quaymark.llm import nearest_centroid as N


def test_learns_and_rejects(docs, corpus, no_docs):
    model = N.fit(docs.where("doc_id < 60 and doc_id % 3 <> 1"))
    assert set(model.languages) == {"en", "de"}
    found = N.predict(docs, model)
    assert found.columns == [c for c in docs.columns if c not in ("text", "score")] + ["text", "lang_pred", "score", "rejected"]
    rows = found.collect()
    assert len(rows) == len(corpus)
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 60 and r["doc_id"] % 3 == 1]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert not any(r["rejected"] for r in held)
    by_id = {r["doc_id"]: r for r in rows}
    for i in (80, 81, 82, 88):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    assert by_id[85]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert N.predict(no_docs, model).count() == 0


def test_nothing_to_learn(docs, no_docs):
    model = N.fit(no_docs)
    assert {r["lang_pred"] for r in N.predict(docs, model).collect()} == {"und"}
    model = N.fit(docs.where("doc_id = 88"))
    assert {r["lang_pred"] for r in N.predict(docs, model).collect()} == {"und"}


def test_label_is_not_an_input(docs):
    model = N.fit(docs.where("doc_id < 60"))
    one = {r[0]: r[1:] for r in N.predict(docs, model).select("doc_id", "lang_pred", "score").collect()}
    two = {r[0]: r[1:] for r in N.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy")), model).select("doc_id", "lang_pred", "score").collect()}
    assert one == two


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(N, "LANGUAGES", 3)
    with pytest.raises(ValueError):
        N.fit(spark.createDataFrame([(str(i), "text") for i in range(5)], "lang string, text string"))


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(N, "SAMPLE", 5)
    seen = []
    inner = N.materialize
    monkeypatch.setattr(N, "materialize", lambda df, label: seen.append(inner(df, label)) or seen[-1])
    N.fit(spark.createDataFrame([(i, f"same text {i % 7}", "en") for i in range(900)], "doc_id long, text string, lang string"))
    assert 0 < seen[0].count() <= 5
