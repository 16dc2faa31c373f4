"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All
but the last return the columns of documents, and whatever columns docs has
besides, by any name. Null values pass through; a null or empty text is a document
without words, kept by every filter; very long texts are taken whole; repeated rows
are documents of their own but for the second stage, which keeps one; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm import bpe, mixing, ngram_join, pii, toxicity
from bindery.llm.common import discard, table, written


def apart(docs: DataFrame) -> DataFrame:
    """docs with all columns but text named by their place, so that no column of an operator clashes with them."""
    return docs.toDF(*("text" if c == "text" else f"kept_{i}" for i, c in enumerate(docs.columns)))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of any toxic grade is below one half."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    rows = apart(docs)
    return toxicity.scored(rows, model).filter(~F.col("toxic_rejected")).select(*rows.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: of the smallest doc_id the row that comes first by text and then by the other columns.

    Rows that share a doc_id are in one group. Documents without doc_id stay.
    """
    kept = ngram_join.near_duplicates(docs.select("doc_id", "text")).filter("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row")).join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi")
    again = written(docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("kept_id")), "pipeline-repeated")
    if again.isEmpty():
        chosen = rows.select("row.*")
    else:
        shared = F.col("doc_id") == F.col("kept_id")
        ties = [F.col(f"row.`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
        # the least row of each task goes on alone, so that an id of many rows is no hot key
        first = rows.join(again, shared, "left_semi").groupBy("doc_id").agg(F.min_by("row", F.struct("row.text", *ties)).alias("row"))
        chosen = rows.join(again, shared, "left_anti").select("row.*").union(first.select("row.*"))
    return chosen.union(docs.filter("doc_id is null"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    rows = apart(docs)
    done = pii.redacted(rows)
    changed = {"text": F.col("pii_text"), "n_chars": F.length("pii_text").cast("long")}
    return done.select(*(changed.get(c, F.col(k)).alias(c) for c, k in zip(docs.columns, rows.columns)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source of every document, with its token ids, checked by decoding them again, instead of its text."""
    done = bpe.encoded(docs.select("doc_id", "lang", "source", "text"))
    names = {"bpe_n_tokens": "n_tokens", "bpe_ids": "ids", "bpe_ids_sha256": "ids_sha256", "bpe_decoded_sha256": "decoded_sha256", "bpe_round_trip": "round_trip"}
    return done.select("doc_id", "lang", "source", *(F.col(c).alias(n) for c, n in names.items()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: A classifier, a learned sequence model and BPE merges are no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
