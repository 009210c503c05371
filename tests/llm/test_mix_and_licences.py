import math

import duckdb
import pytest
from pyspark.sql import functions as F

from quaymark.llm import licence_scan, temperature_mix


def test_mix_meets_budgets(docs, corpus, monkeypatch, no_docs):
    monkeypatch.setattr(temperature_mix, "BLOCK_TOKENS", 300)
    tokens = {}
    for r in corpus:
        n = len((r[1] or "").encode().split())
        tokens.setdefault(r[3], []).append(n)
    totals = {s: sum(n) for s, n in tokens.items() if sum(n)}
    total = sum(totals.values())
    drawn = temperature_mix.mix(docs, 1.0, max_repetition=1.5)
    assert drawn.columns == [c for c in docs.columns if c not in ("epoch", "n_tokens", "place")] + ["epoch", "n_tokens", "place"]
    rows = drawn.collect()
    got = {}
    for r in rows:
        got[r["source"]] = got.get(r["source"], 0) + r["n_tokens"]
        assert 0 <= r["place"] <= 1

    def weights(a):
        powers = {s: (n / total) ** a for s, n in totals.items()}
        return {s: p / sum(powers.values()) for s, p in powers.items()}

    low, high = 0.0, 1.0
    for _ in range(60):
        a = (low + high) / 2
        low, high = (low, a) if max(weights(a)[s] * total / totals[s] for s in totals) <= 1.5 else (a, high)
    longest = {s: max(n) for s, n in tokens.items()}
    for s, w in weights(high).items():
        assert w * total - 1e-2 * total <= got[s] <= w * total + 2 * longest[s] + 1e-2 * total, s
    # Epoch 1 holds documents that epoch 0 holds, and whole epochs hold all.
    first = [(r["doc_id"], r["source"]) for r in rows if r["epoch"] == 0]
    assert {(r["doc_id"], r["source"]) for r in rows if r["epoch"] == 1} <= set(first)
    assert temperature_mix.mix(no_docs).count() == 0
    assert temperature_mix.mix(docs.where("doc_id in (80, 81, 82)")).count() == 0


def test_entropy_target(spark):
    shares = [0.7, 0.2, 0.1]
    totals = spark.createDataFrame([(math.log(p),) for p in shares], "lp double")
    for a in (0.3, 0.5, 2.0):
        powers = [p**a for p in shares]
        w = [p / sum(powers) for p in powers]
        entropy = -sum(x * math.log(x) for x in w)
        assert temperature_mix.exponent(totals, 1.0, entropy, None) == pytest.approx(a, abs=1e-4)
    assert temperature_mix.exponent(totals, 1.0, 5.0, None) == 0.0
    assert temperature_mix.exponent(totals, 1.0, None, None) == 1.0
    assert temperature_mix.exponent(totals, 1.0, None, 1.0) == pytest.approx(1.0, abs=1e-4)


def test_plain_epoch_draws_everything_once(docs, corpus):
    rows = temperature_mix.mix(docs, 1.0).select("doc_id", "epoch").collect()
    assert {r[1] for r in rows} == {0}
    assert len(rows) == sum(bool((r[1] or "").split()) for r in corpus)


NOTICES = [
    (1, "Released under the MIT License."),
    (2, "words before\n  RELEASED under the  mit license!!\nwords after"),
    (3, "This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0."),
    (4, "license license license"),
    (5, None),
    (6, ""),
    (7, "rights"),
    (8, "All rights reserved"),
    (9, "x " * 50_000 + "\nLicensed under the Apache License, Version 2.0."),
    (None, "Licensed under CC BY-SA 4.0."),
    (1, "Released under the MIT License."),
]


def test_licences(spark, docs, no_docs):
    frame = spark.createDataFrame(NOTICES, "doc_id long, text string").withColumn("line", F.lit("clash"))
    got = sorted([tuple(r) for r in licence_scan.scan(frame).collect()], key=str)
    duck = duckdb.connect()
    documents = frame.drop("line").toPandas().astype({"doc_id": "Int64"})
    duck.register("given", documents)
    duck.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text FROM given")
    # The oracle keeps one row of rows that repeat each other.
    expected = {tuple(r) for r in duck.execute(licence_scan.oracle()).fetchall()}
    assert set(got) == expected and len(got) == len(expected) + 1
    assert {(i, name) for i, _, name, _ in got} >= {(1, "MIT"), (2, "MIT"), (3, "GPL-3.0"), (3, "CC-BY-NC-4.0"), (8, "Proprietary"), (9, "Apache-2.0"), (None, "CC-BY-SA-4.0")}
    assert licence_scan.scan(no_docs).count() == 0 and licence_scan.scan(docs).count() == 0
