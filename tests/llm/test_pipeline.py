"""Each stage on nulls, empty and long texts, ties, repeated rows, empty tables and columns with the operators' names."""

import collections

import pytest

import corpus_pipeline
from tests.llm.test_edges import LONG, PASSAGE, prose

STAGES = dict(corpus_pipeline.STAGES)
CLASHES = ("toxic_p", "toxic_severity", "toxic_rejected", "pii_text", "pii_n", "pii_spans", "ngram_row", "component_id", "kept_id", "place", "mix_size", "mix_copies", "mix_row", "bpe_ids", "row", "set", "node", "kept_0")
ROWS = [
    (1, None, "en", "a"), (2, "", "en", None), (3, "one two", None, "b"), (4, PASSAGE, "en", "a"), (5, PASSAGE, "en", "b"), (5, PASSAGE, "en", "b"), (6, LONG, "en", "c"), (7, LONG + " end", "fr", "c"),
    (8, "mail a.b@mail.example.com now please", "en", "a"), (9, prose(11, 40), "fr", "b"), (9, prose(12, 40), "de", "a"), (None, prose(13, 20), "en", "a"), (None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    rows = [(*r, len(r[1] or ""), *(f"{c} of {i}" for c in CLASHES)) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, schema).repartition(3).cache()


def counted(df, *columns):
    return collections.Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_odd_rows(spark, sf_dir, docs, name):
    done = STAGES[name](spark, docs, sf_dir).cache()
    again = STAGES[name](spark, docs.repartition(2), sf_dir)
    assert STAGES[name](spark, docs.limit(0), sf_dir).count() == 0
    if name == "bpe":
        assert counted(done, "doc_id", "lang", "source") == counted(docs, "doc_id", "lang", "source") and done.filter("not round_trip").isEmpty()
        return
    assert done.columns == docs.columns
    assert counted(done, "doc_id", "text", *CLASHES) == counted(again, "doc_id", "text", *CLASHES)  # reruns agree
    mine = counted(done, "doc_id", *CLASHES)
    every = counted(docs, "doc_id", *CLASHES)
    assert set(mine) <= set(every)  # no value of a clashing column is replaced
    if name in ("toxicity", "pii"):
        assert mine == every
    if name == "pii":
        changed = {r["doc_id"]: r for r in done.collect()}
        assert changed[8]["text"] == "mail [email] now please" and changed[8]["n_chars"] == 23 and changed[1]["text"] is None
    if name == "ngram_join":
        kept = collections.Counter(r["doc_id"] for r in done.collect())
        assert kept == {1: 1, 2: 1, 3: 1, 4: 1, 6: 1, 8: 1, 9: 1, None: 2}
        assert [r["text"] for r in done.filter("doc_id = 9").collect()] == [min(prose(11, 40), prose(12, 40))]
    if name == "mixing":
        words = lambda df: sum(len((r["text"] or "").split()) for r in df.select("text").collect())
        assert words(done) <= 2 * words(docs)


def test_rejected_documents_go(spark, tmp_path):
    bad = [(i, prose(i, 40) + (" nasty vile words" if i % 3 == 0 else ""), "kept") for i in range(240)]
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, *_ in bad], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    done = STAGES["toxicity"](spark, spark.createDataFrame(bad, "doc_id long, text string, toxic_p string"), str(tmp_path))
    assert sorted(r["doc_id"] for r in done.collect()) == [i for i in range(240) if i % 3] and done.filter("toxic_p = 'kept'").count() == 160
