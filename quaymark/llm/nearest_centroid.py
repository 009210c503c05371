"""Language identification by the nearest of several TF-IDF n-gram centroids per language.

Method.  A text's letters are lower-cased, everything between them becomes one space, and
its runs of two and three characters are counted in ``DIMENSIONS`` hashed places.  A
vector is (1 + log count) times the inverse document frequency, at length one.  The texts
of each language are clustered (spherical k-means) and every centroid is kept; a text gets
the language of the centroid with the largest cosine.  It is rejected if it has no letter,
or if that cosine is below ``REJECT`` times the smallest one seen in fitting.

Fitting takes at most ``SAMPLE`` labelled rows of each language, chosen by a hash of the
row, and at most ``LANGUAGES`` languages: that bounds what reaches the driver and the
broadcast model.  Prediction takes whole texts of all rows.

Defined results: null texts and texts without letters get ``und`` and score 0; with nothing
to learn from, every text does; equal cosines go to the first language in text order;
ids, labels and all other columns pass through and never enter a prediction; columns named
as a result are replaced.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from quaymark.llm.batches import bound_batches, map_texts
from quaymark.llm.text import mix
from quaymark.session import materialize

DIMENSIONS = 1 << 14
SAMPLE = 300
LANGUAGES = 1000
CLUSTERS = 3
REJECT = 0.5
UNKNOWN = "und"

_letters: np.ndarray | None = None


@dataclass
class Model:
    languages: list[str]
    centroids: np.ndarray
    weights: np.ndarray
    least: float


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """A row of n-gram counts for each text; all zero for a text without letters."""
    counts = np.zeros((len(texts), DIMENSIONS), np.float32)
    for i, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        letter = np.concatenate([[False], _letter_table()[codes], [False]])
        if not letter.any():
            continue
        codes = np.where(letter, np.concatenate([[32], codes, [32]]), 32).astype(np.uint64)
        codes = codes[letter | np.concatenate([letter[1:], [False]])]
        codes = np.concatenate([codes, [np.uint64(32)]])
        pairs = codes[:-1] * np.uint64(0x110000) + codes[1:]
        triples = pairs[:-1] * np.uint64(0x110000) + codes[2:]
        for grams in (pairs, triples):
            counts[i] += np.bincount((mix(grams) % np.uint64(DIMENSIONS)).astype(np.int64), minlength=DIMENSIONS)
    return counts


def _vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted rows at length one; ``counts`` is overwritten."""
    np.log1p(counts, out=counts)
    counts *= weights
    norms = np.sqrt(np.einsum("ij,ij->i", counts, counts))
    counts /= np.where(norms > 0, norms, 1)[:, None]
    return counts


def _cluster(vectors: np.ndarray) -> np.ndarray:
    """Up to ``CLUSTERS`` centroids: farthest-first seeds, then spherical k-means."""
    seeds = [vectors.sum(0)]
    for _ in range(min(CLUSTERS, len(vectors)) - 1):
        seeds.append(vectors[np.argmin(np.max([vectors @ s for s in seeds], axis=0))])
    centroids = np.stack(seeds)
    for _ in range(10):
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1), 1e-12)[:, None]
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        sums = [vectors[nearest == k].sum(0) for k in range(len(centroids)) if (nearest == k).any()]
        centroids = np.stack(sums)
    return centroids / np.maximum(np.linalg.norm(centroids, axis=1), 1e-12)[:, None]


def fit(docs: DataFrame, label: str = "lang") -> Model:
    """Centroids of each language, from rows with a text and a label."""
    key = F.xxhash64(*[c for c in ("doc_id", "text") if c in docs.columns])
    rows = docs.select(F.col(label).cast("string").alias("lang"), F.col("text").cast("string").alias("text"), key.alias("key")).where("lang is not null and text is not null")
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(totals) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not totals:
        return Model([], np.zeros((0, DIMENSIONS), np.float32), np.ones(DIMENSIONS, np.float32), 0.0)
    # About twice the sample by a threshold on the hash, so that little is moved; then the first of these.
    share = F.create_map(*[x for k, n in sorted(totals.items()) for x in (F.lit(k), F.lit(min(1.0, (2 * SAMPLE + 40) / n)))])
    near = rows.where((F.pmod("key", F.lit(1 << 30)) / (1 << 30)) <= share[F.col("lang")])
    first = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("key", "text")))
    sample = first.where(F.col("place") <= SAMPLE).select("lang", "text")

    def count(texts: list[str | None]) -> dict:
        grams, values = [], []
        for text in texts:
            row = gram_counts([text])[0]
            grams.append(np.flatnonzero(row).astype(np.int32))
            values.append(row[grams[-1]])
        return {"grams": grams, "counts": values}

    counted = materialize(map_texts(sample, count, "grams array<int>, counts array<float>"), "gram_counts")
    in_texts = np.zeros(DIMENSIONS)
    for gram, n in counted.select(F.explode("grams").alias("g")).groupBy("g").count().collect():
        in_texts[gram] = n
    weights = (np.log((1 + counted.count()) / (1 + in_texts)) + 1).astype(np.float32)

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        rows = np.zeros((len(part), DIMENSIONS), np.float32)
        for i, (grams, values) in enumerate(zip(part["grams"], part["counts"])):
            rows[i, np.asarray(grams, np.int64)] = values
        rows = rows[rows.any(axis=1)]
        if not len(rows):
            return pd.DataFrame(columns=["lang", "centroid", "least"], dtype=object)
        vectors = _vectors(rows, weights)
        centroids = _cluster(vectors)
        least = float(np.max(vectors @ centroids.T, axis=1).min())
        return pd.DataFrame({"lang": part["lang"].iloc[0], "centroid": list(centroids), "least": least})

    made = counted.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, least double").collect()
    made.sort(key=lambda r: r["lang"])
    centroids = np.array([r["centroid"] for r in made], np.float32).reshape(len(made), DIMENSIONS)
    return Model([r["lang"] for r in made], centroids, weights, min((r["least"] for r in made), default=0.0))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the cosine) and ``rejected``; the text stays."""
    bound_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str | None]) -> dict:
        m: Model = held.value
        names, scores, rejected = [], [], []
        for place in range(0, len(texts), 64):
            counts = gram_counts(texts[place : place + 64])
            known = counts.any(axis=1)
            if m.languages:
                cosines = _vectors(counts, m.weights) @ m.centroids.T
                best = np.argmax(cosines, axis=1)
                score = np.clip(cosines[np.arange(len(best)), best], 0, 1).astype(float)
            else:
                known[:] = False
            names += [m.languages[best[i]] if known[i] else UNKNOWN for i in range(len(known))]
            scores += [float(score[i]) if known[i] else 0.0 for i in range(len(known))]
            rejected += [bool(not known[i] or score[i] < REJECT * m.least) for i in range(len(known))]
        return {"lang_pred": names, "score": scores, "rejected": rejected, "text": texts}

    rest = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    return map_texts(docs.select(*rest), run, "text string, lang_pred string, score double, rejected boolean")
