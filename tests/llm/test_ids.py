"""Ids above 2^53 beside nulls, and nullable nested columns, through every operator that works on texts, and every stage."""

import collections
import datetime

import pytest

import corpus_pipeline
from bindery.llm import bpe, langid, mixing, ngram_join, pii, suffix_dedup, tokencount, toxicity
from bindery.llm.common import table
from tests.llm.test_edges import prose

BIG = 1 << 60
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, other long, pair struct<a:long,b:string>, many array<bigint>, day date, at timestamp"
NOON = datetime.datetime(2024, 5, 1, 12, 30, 0, 123456)
ROWS = [
    (BIG, prose(21, 40), "en", "a", 5, BIG + 1, (BIG + 1, None), [BIG + 1, None], None, NOON), (BIG + 1, prose(22, 40), "en", "a", None, None, (None, "x"), None, datetime.date(2024, 1, 2), None),
    (None, prose(23, 40), "en", "b", BIG + 3, BIG + 3, None, [None, BIG + 3], None, NOON), (BIG + 2, None, None, None, None, None, None, [], None, None),
]
KEPT = ["doc_id", "lang", "source", "other", "pair", "many", "day", "at"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).coalesce(1).cache()


def counted(df, *columns):
    return collections.Counter(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("apply", [pii.found, pii.redacted, lambda d: langid.predict(d, None), lambda d: bpe.encoded(d), mixing.with_copies], ids=["found", "redacted", "predict", "encoded", "copies"])
def test_columns_pass_as_they_are(docs, apply):
    assert counted(apply(docs), *KEPT) == counted(docs, *KEPT)


def test_scored_columns_pass_as_they_are(spark, docs):
    bad = [(i, prose(i, 40) + (" nasty vile words" if i % 3 == 0 else "")) for i in range(240)]
    model = toxicity.fit(spark.createDataFrame(bad, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in bad], "doc_id long, toxic int"))
    assert model and counted(toxicity.scored(docs, model), *KEPT) == counted(docs, *KEPT)


@pytest.mark.parametrize("apply", [pii.op2_pii, langid.op4_langid, suffix_dedup.op6_suffix_dedup, bpe.op7_bpe, ngram_join.op8_ngram_join, mixing.op10_mixing], ids=["op2", "op4", "op6", "op7", "op8", "op10"])
def test_ids_stay(docs, apply):
    assert counted(apply(docs), "doc_id") == counted(docs, "doc_id")


def test_section_ids_stay(docs):
    assert {r["doc_id"] for r in tokencount.op9_token_counts(docs).collect()} == {r[0] for r in ROWS}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:4])
def test_stages_keep_every_document(spark, sf_dir, docs, name, stage):
    done, given = set(counted(stage(spark, docs, sf_dir), *KEPT)), set(counted(docs, *KEPT))
    assert done <= given if name == "mixing" else done == given


def test_a_sample_takes_one_text_of_an_id(spark):
    rows = [(7, f"copy {i}", "en") for i in range(500)] + [(i, prose(i, 20), "en") for i in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.fit(docs) is not None
    labels = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(100, 140)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is not None


def test_spans_and_ids_of_the_tables(spark, sf_dir):
    """op2's base spans by plain patterns, op7 by tiktoken, on all texts of the tables."""
    import hashlib
    import re

    import numpy as np
    import tiktoken

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(digits):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0

    def valid(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else False, "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]

    for r in pii.op2_pii(docs).collect():
        spans = sorted((m.start(), list(patterns).index(k), m.end(), k) for k, p in patterns.items() for m in re.finditer(p, texts[r["doc_id"]]) if valid(k, m[0]))
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()
    plain = tiktoken.Encoding("own", pat_str=bpe.pattern(), mergeable_ranks=bpe.ranks(bpe.vocabulary_path()), special_tokens={})
    for r in bpe.op7_bpe(docs).collect():
        ids = np.array(plain.encode_ordinary(texts[r["doc_id"]]), dtype="<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())
