"""Language identification by the nearest of several centroids per language.

Texts become vectors of hashed character bigrams and trigrams, weighed by TF-IDF
and normalised. The vectors of each language are clustered by spherical k-means;
a text takes the language of the centroid of the highest cosine, and is marked
as rejected where the distance exceeds that language's radius.

The fit uses a bounded sample: about PER_LANGUAGE labelled texts of each
language, picked by a hash of doc_id (the bound holds on average; the pick
is the same in every run). Prediction reads all texts whole.

Defined cases: `und` with score 0 for null texts, texts without a letter, and all
texts where nothing is labelled; a null doc_id counts as held out; of equal cosines
the language that comes first by name wins; very long texts are counted whole, one
at a time; repeated rows are predicted each; an empty table gives an empty result;
other columns are kept by predict(), but for those named lang_pred, score and
rejected, which its own replace; the query ignores them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import nullcontext
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import written
from .vectext import LOWER, NOT_LETTER, filled, pieces, with_fields

DIMS = 8192
PER_LANGUAGE = 500
CENTROIDS = 3
#: Rows that a broadcast takes at most; more are joined by a shuffle.
MOST_BROADCAST = 100_000
#: Letters in lower case, anything else a space.
FOLDED = np.where(NOT_LETTER, np.uint8(0x20), LOWER)


class Model(NamedTuple):
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    owner: np.ndarray
    radius: np.ndarray


def counts(texts: list[str]) -> np.ndarray:
    """A row of n-gram counts for each text."""
    raw = [f"  {t} ".encode() for t in texts]
    data = FOLDED[np.frombuffer(b"".join(raw), dtype=np.uint8)].astype(np.int64)
    size = np.array([len(r) for r in raw], dtype=np.int64)
    doc = np.repeat(np.arange(len(raw)), size)
    last = np.cumsum(size)
    two = (data[:-1] << 8) | data[1:]
    three = (two[:-1] << 8) | data[2:]
    ok2, ok3 = np.ones(len(two), dtype=bool), np.ones(len(three), dtype=bool)
    ok2[last[:-1] - 1] = False
    ok3[last[:-1] - 1] = False
    ok3[last[:-1] - 2] = False
    ok2 &= two != 0x2020
    ok3 &= (three & 0xFFFF) != 0x2020
    spot = np.concatenate([(two * 2654435761 >> 7) % DIMS + doc[:-1] * DIMS, (three * 2246822519 >> 9) % DIMS + doc[:-2] * DIMS])
    return np.bincount(spot[np.concatenate([ok2, ok3])], minlength=len(raw) * DIMS).reshape(len(raw), DIMS).astype(np.float32)


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(count) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of spherical k-means, started from points far from each other."""
    picked = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(picked) < min(k, len(x)):
        picked.append(int(np.argmin((x @ x[picked].T).max(axis=1))))
    c = x[picked]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, k: int = CENTROIDS) -> Model | None:
    """Learn from labelled (doc_id, text, lang)."""
    ship(labelled.sparkSession)
    usable = labelled.filter("text is not null and lang is not null and doc_id is not null")
    named = usable.select("doc_id", "lang")
    sizes = written(named.groupBy("lang").agg(F.count("*").alias("n")), "langid-sizes")  # one row a language
    few = F.broadcast(sizes) if sizes.count() <= MOST_BROADCAST else sizes
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    picked = written(named.join(few, "lang").filter(chance < per_language / F.col("n")).distinct(), "langid-picked")  # about per_language rows of each language
    texts = usable.join(F.broadcast(picked) if picked.count() <= MOST_BROADCAST else picked, ["doc_id", "lang"])
    # one text of each picked row, however many rows repeat its doc_id, so that the sample stays bounded
    sample = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")

    def sparse(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            texts = filled(pdf["text"])
            for piece in pieces(texts):
                rows = [(np.flatnonzero(r), r) for r in counts(texts[piece])]
                yield pd.DataFrame({"lang": pdf["lang"].iloc[piece].to_numpy(), "spot": [i.astype(np.int32).tobytes() for i, _ in rows], "count": [r[i].tobytes() for i, r in rows]})

    rows = sample.mapInPandas(sparse, "lang string, spot binary, count binary").toPandas()
    if rows.empty:
        return None

    def dense(part: pd.DataFrame) -> np.ndarray:
        x = np.zeros((len(part), DIMS), dtype=np.float32)
        for i, (spot, count) in enumerate(zip(part["spot"], part["count"])):
            x[i, np.frombuffer(spot, dtype=np.int32)] = np.frombuffer(count, dtype=np.float32)
        return x

    df = np.bincount(np.concatenate([np.frombuffer(s, dtype=np.int32) for s in rows["spot"]]), minlength=DIMS)
    idf = (np.log((1 + len(rows)) / (1 + df)) + 1).astype(np.float32)
    languages, found, owner, radius = sorted(rows["lang"].unique()), [], [], []
    for i, lang in enumerate(languages):
        x = vectors(dense(rows[rows["lang"] == lang]), idf)
        x = x[x.any(axis=1)]
        if not len(x):
            continue
        c = clusters(x, k)
        found.append(c)
        owner += [i] * len(c)
        radius.append(1.1 * np.quantile(1 - (x @ c.T).max(axis=1), 0.99))
    return Model(idf, languages, np.concatenate(found), np.array(owner), np.array(radius)) if found else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs (doc_id, text and others) with lang_pred, score and rejected instead of text."""
    ship(docs.sparkSession)

    def made(texts: list[str]) -> Iterator[tuple]:
        lettered = np.array([has_letter(t) for t in texts])
        pred, score, rejected = np.array(["und"] * len(texts), dtype=object), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        if model and lettered.any():
            cosine = vectors(counts([t for t, ok in zip(texts, lettered) if ok]), model.idf) @ model.centroids.T
            best = cosine.argmax(axis=1)
            own = model.owner[best]
            pred[lettered] = np.array(model.languages, dtype=object)[own]
            score[lettered] = np.clip(cosine.max(axis=1), 0, 1)
            rejected[lettered] = 1 - score[lettered] > model.radius[np.searchsorted(np.unique(model.owner), own)]
        return zip(pred, score, rejected)

    return with_fields(docs, "lang_pred string, score double, rejected boolean", lambda: nullcontext(made), keep_text=False)


def op4_langid(docs: DataFrame) -> DataFrame:
    marked = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(marked.filter(~F.col("held_out")))
    return predict(marked.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
