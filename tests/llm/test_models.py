"""Held-out accuracy, and the patterns against plain regular expressions."""

import random
import re

import pytest

from bindery.llm import langid, pii, queries
from bindery.llm.common import table

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def ok(kind, s):
        d = pii.digits_of(s)
        return (True, kind == 1 and all(int(p) <= 255 for p in s.split(".")), 14 <= len(d) <= 19 and pii.luhn(d), 10 <= len(d) <= 15)[kind]

    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if ok(k, m[0]))


def test_base_spans_equal_the_patterns():
    r = random.Random(1)
    for _ in range(5000):
        text = "".join(r.choice("0123456789..@@+- ()ab4é") for _ in range(r.randint(0, 40)))
        assert pii.base_spans(text, [m.span() for m in pii.DIGITS.finditer(text)]) == plain_spans(text)


def test_crf_on_held_out_sentences(spark):
    model = pii.fit(pii.training_table(spark))
    held = pii.training_table(spark, rows=150, seed=99).collect()
    right = total = 0
    for row in held:
        text = " ".join(row["tokens"])
        (_, spans), = pii.all_spans([text], model)
        at = 0
        for token, label in zip(row["tokens"], row["labels"]):
            hit = {pii.KINDS[k] for a, k, b in spans if a < at + len(token) and b > at}
            if label != "O" or hit:
                total += 1
                right += label in hit
            at += len(token) + 1
    assert right / total > 0.97


def test_language_on_held_out_documents(spark, sf_dir):
    rows = langid.op4_langid(table(spark, sf_dir, "documents")).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    theirs = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in theirs.description]
    mine = queries.queries()[name](spark, sf_dir).select(*columns).collect()
    assert sorted(tuple(map(str, r)) for r in mine) == sorted(tuple(map(str, r)) for r in theirs.fetchall())


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = table(spark, sf_dir, "documents")
    names, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf_dir).cache()
        if name != "bpe":
            assert after.columns == names
        if name in ("toxicity", "ngram_join"):
            assert after.join(before, "doc_id", "left_anti").count() == 0 and after.count() <= before.count()
        if name == "pii":
            assert after.count() == before.count()
        before = after
    assert before.filter("not round_trip").count() == 0 and before.count() > 0
    assert corpus_pipeline.STAGES[1][1](spark, docs.limit(0), sf_dir).count() == 0
