"""Toxicity by cumulative-link ordinal regression on sparse features of words.

One weight vector is shared by all thresholds: P(grade > j) = sigmoid(w.x - t_j)
with t_0 < t_1 < ... . The expected severity is the sum of these probabilities.

The labels are binary, so the grades of the training texts are made from them:
0 where toxic is 0, and 1 to 3 where it is 1, by terciles of how often the text
has marker words, which are words far more frequent under toxic = 1.

The fit uses a bounded sample of about SAMPLE labelled texts, picked by a hash of
doc_id (the bound holds on average); an L1 penalty leaves few weights. Scoring
reads all texts whole.

Defined cases: null texts count as empty; documents without doc_id are scored;
null labels take no part; with no label of one of the two classes nothing is
learned, the severity is 0 and nothing is rejected; repeated rows are scored each;
very long texts are read whole, one at a time; a probability of exactly the limit
is rejected; an empty table gives an empty result; other columns are kept by
scored(), but for those named toxic_severity, toxic_p and toxic_rejected, which its
own replace.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import nullcontext
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import written
from .vectext import NOT_LETTER, filled, pieces, prefix_hash, released, with_fields, words

BITS = 18
SAMPLE = 3000
GRADES = 3
#: Bytes of the word beginnings that are features.
PREFIXES = (3, 4, 5, 6, 7)


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray


def features(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature hash, occurrences); with wanted, only of hashes where it is true.

    The features are the words and their beginnings, since stems take many endings.
    """
    found = words(texts, NOT_LETTER)
    docs, spots = [], []
    for size in (None, *PREFIXES):
        use = slice(None) if size is None else found.end - found.start > size
        value = found.hash if size is None else prefix_hash(found, found.start[use], size)
        spot, doc = (value >> np.uint64(64 - BITS)).astype(np.int64), found.doc[use]
        if wanted is not None:
            keep = wanted[spot]
            spot, doc = spot[keep], doc[keep]
        docs.append(doc)
        spots.append(spot)
    code, n = np.unique((np.concatenate(docs) << BITS) | np.concatenate(spots), return_counts=True)
    return code >> BITS, code & ((1 << BITS) - 1), n


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def grades(doc: np.ndarray, spot: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Ordered grades of the training texts from binary labels and marker words."""
    bad, good = toxic[doc] == 1, toxic[doc] == 0
    size = 1 << BITS
    with_bad, with_good = np.bincount(spot[bad], minlength=size), np.bincount(spot[good], minlength=size)
    odds = ((with_bad + 0.5) / (toxic.sum() + 1)) / ((with_good + 0.5) / ((1 - toxic).sum() + 1))
    marker = (odds >= 8) & (with_bad >= max(3, 0.02 * toxic.sum()))
    hits = np.bincount(doc, weights=n * marker[spot], minlength=len(toxic))
    seen = hits[(toxic == 1) & (hits > 0)]
    cuts = np.quantile(seen, [1 / 3, 2 / 3]) if len(seen) else np.array([np.inf, np.inf])
    return np.where(toxic == 1, 1 + (hits > cuts[0]).astype(int) + (hits > cuts[1]).astype(int), 0)


def fit_rows(doc: np.ndarray, spot: np.ndarray, n: np.ndarray, toxic: np.ndarray, steps: int = 200, l1: float = 5e-4, least: int = 4) -> Model:
    """Proximal Adam on the whole sample."""
    y = grades(doc, spot, n, toxic)
    keep = np.bincount(spot, minlength=1 << BITS)[spot] >= least
    used, col = np.unique(spot[keep], return_inverse=True)
    doc, col, x = doc[keep].astype(np.int32), col.astype(np.int32), np.log1p(n[keep]).astype(np.float32)
    del spot, n, keep
    w, t = np.zeros(len(used)), np.zeros(GRADES)
    above = np.array([(y > j).mean() for j in range(GRADES)])
    t[:] = -np.log(np.maximum(above, 1e-4) / (1 - np.minimum(above, 1 - 1e-4)))
    t = np.maximum.accumulate(t + 1e-3 * np.arange(GRADES))
    first, second = np.zeros(len(w) + GRADES), np.zeros(len(w) + GRADES)
    rate = 0.05
    for step in range(1, steps + 1):
        s = np.bincount(doc, weights=x * w[col], minlength=len(y))
        up = sigmoid(s[:, None] - t)  # P(grade > j)
        edge = np.concatenate([np.ones((len(y), 1)), up, np.zeros((len(y), 1))], axis=1)
        p = np.maximum(edge[np.arange(len(y)), y] - edge[np.arange(len(y)), y + 1], 1e-9)
        slope = np.concatenate([np.zeros((len(y), 1)), up * (1 - up), np.zeros((len(y), 1))], axis=1)
        low, high = slope[np.arange(len(y)), y] / p, slope[np.arange(len(y)), y + 1] / p
        g_s = (high - low) / len(y)
        g_t = np.zeros(GRADES + 2)
        np.add.at(g_t, y, low / len(y))
        np.add.at(g_t, y + 1, -high / len(y))
        g = np.concatenate([np.bincount(col, weights=x * g_s[doc], minlength=len(w)), g_t[1:-1]])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        size = rate / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        moved = np.concatenate([w, t]) - size * first / (1 - 0.9**step)
        w = np.sign(moved[:-GRADES]) * np.maximum(np.abs(moved[:-GRADES]) - l1 * size[:-GRADES], 0)
        t = np.maximum.accumulate(moved[-GRADES:] + 1e-6 * np.arange(GRADES))
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[used] = w
    return Model(weights, t)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    ship(docs.sparkSession)
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("label_toxic"))
    n = known.count()
    chance = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    picked = known.filter(chance < sample / max(n, 1)).withColumnRenamed("doc_id", "label_doc_id")
    picked = written(picked, "toxicity-picked")  # about `sample` rows
    few = F.broadcast(picked) if picked.count() <= 4 * sample else picked
    met = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("label_doc_id"))
    # one text of each picked id, however many rows repeat it, so that the sample stays bounded
    texts = met.groupBy("label_doc_id", "label_toxic").agg(F.min("text").alias("text"))

    def sparse(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            all_texts = filled(pdf["text"])
            for piece in pieces(all_texts):
                doc, spot, n = features(all_texts[piece])
                cut = np.searchsorted(doc, np.arange(len(all_texts[piece]) + 1))
                spans = list(zip(cut[:-1], cut[1:]))
                yield pd.DataFrame({"toxic": pdf["label_toxic"].iloc[piece].to_numpy(), "spot": [spot[a:b].astype(np.int32).tobytes() for a, b in spans], "n": [n[a:b].astype(np.int32).tobytes() for a, b in spans], "size": [b - a for a, b in spans]})

    rows = texts.select("label_toxic", "text").mapInPandas(released(sparse), "toxic int, spot binary, n binary, size int").toPandas()
    if rows.empty or rows["toxic"].nunique() < 2:
        return None
    spot, n = (np.frombuffer(b"".join(rows.pop(c)), dtype=np.int32) for c in ("spot", "n"))
    return fit_rows(np.repeat(np.arange(len(rows), dtype=np.int32), rows["size"]), spot, n, rows["toxic"].to_numpy())


def severity(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(expected severity, P(grade > 0)) of each text."""
    doc, spot, n = features(texts, model.weights != 0)
    s = np.bincount(doc, weights=np.log1p(n) * model.weights[spot], minlength=len(texts))
    up = sigmoid(s[:, None] - model.thresholds)
    return up.sum(axis=1), up[:, 0]


def scored(docs: DataFrame, model: Model | None, reject_at: float = 0.5) -> DataFrame:
    """docs with toxic_severity (0 to 3), toxic_p and toxic_rejected."""
    ship(docs.sparkSession)
    names = ("toxic_severity", "toxic_p", "toxic_rejected")
    if model is None:
        rest = docs.select(*(c for c in docs.columns if c not in names))
        return rest.select("*", F.lit(0.0).alias(names[0]), F.lit(0.0).alias(names[1]), F.lit(False).alias(names[2]))

    def made(texts: list[str]) -> Iterator[tuple]:
        expected, p = severity(texts, model)
        return zip(expected, p, p >= reject_at)

    return with_fields(docs, f"{names[0]} double, {names[1]} double, {names[2]} boolean", lambda: nullcontext(made))


def op5_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    done = scored(docs.select("doc_id", "text"), fit(docs, labels))
    return done.select("doc_id", F.col("toxic_severity").alias("severity"), F.col("toxic_p").alias("p_toxic"), F.col("toxic_rejected").alias("rejected"))
