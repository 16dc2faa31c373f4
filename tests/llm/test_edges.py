"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import itertools
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import corpus_pipeline
from bindery.llm import bpe, imatch, langid, mixing, ngram_join, pii, suffix_dedup, tokencount, topk, toxicity
from bindery.llm.anchors import LENGTH, WINDOW, Hashes, anchors
from bindery.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, score int, bucket string, imatch_slice int, mix_size int, pii_n int, toxic_p string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in r.integers(0, len(WORDS), n))


LONG = prose(1, 30_000)
PASSAGE = prose(2, 90)
ROWS = [
    (1, None, "en", "a"), (2, "", "en", None), (3, "one", None, "b"), (4, PASSAGE + " first end " + prose(3, 50), "en", "a"), (5, "begin here " + prose(4, 30) + " " + PASSAGE, "en", "b"),
    (6, LONG, "en", "c"), (7, LONG, "en", "c"), (7, LONG, "en", "c"), (8, "mail a.b@mail.example.com or +1 (555) 555-0100, card 4111 1111 1111 1111, ip 10.0.0.1", "en", "a"), (9, "é" * 600, "fr", "b"), (None, "no id at all here today", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, len(r[1] or ""), 5, "k", 6, "b", 7, 8, 9, "t") for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def texts():
    return [r[1] or "" for r in ROWS]


def test_mixing(docs, empty):
    rows = mixing.op10_mixing(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    sizes = collections.Counter()
    for r, t in zip(ROWS, texts()):
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert {r["source_size"] for r in rows} == set(sizes.values())
    assert sum(mixing.source_targets(docs.select(F.col("source").alias("mix_source"), mixing.word_count(F.col("text")).alias("size"))).toPandas()["target"]) == pytest.approx(1.5 * sum(sizes.values()))
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.op10_mixing(empty).count() == 0


def test_targets_stop_at_the_cap_and_reshare(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 5)], "mix_source string, size long")
    found = {r["mix_source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert found["a"] == 200 and found["c"] == 20 and found[None] == 10
    assert found["b"] == pytest.approx(1.5 * 1115 - 230)


def test_imatch(docs, empty):
    rows = imatch.op3_imatch(docs).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = collections.Counter()
    first = next(r for r in order if r[0] is not None)
    for r, following in zip(order, [*order[1:], first]):
        text, after = r[1] or "", following[1] or ""
        half = len(text) // 2
        expected[r[0], len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == expected
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[r["n_chars"]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert len(by_text[len(LONG)]) == 1
    assert imatch.op3_imatch(empty).count() == 0


@pytest.mark.parametrize("log", [1, 2, 10])
@pytest.mark.parametrize("ids", [[1, 5, 5, 9, 100, 101, 102, 10**12, 7, 3, 2**60 + 1, 2**60], [None, None, 4, 4, 4, 4, 4, 8], [None, 2], [7], [-3, -2**60, 2**62, 0]])
def test_imatch_slices_cover_every_neighbour(spark, monkeypatch, log, ids):
    monkeypatch.setattr(imatch, "RANGES_LOG", log)
    every = [(i, f"text {i} {n:02}") for n, i in enumerate(ids * 3)]
    docs = spark.createDataFrame(every, "doc_id long, text string")
    placed = imatch.slices(docs, len(every), rows_each=2)
    ahead = Window.partitionBy("imatch_slice").orderBy("imatch_ghost", "doc_id", "text")
    found = placed.withColumn("next", F.lead("text").over(ahead)).filter("not imatch_ghost")
    order = sorted(every, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    first = next(r for r in order if r[0] is not None)
    assert {(r["text"], r["next"]) for r in found.collect()} == {(a[1], b[1]) for a, b in zip(order, [*order[1:], first])}
    if log > 2:
        assert imatch.neighbour_fingerprints(docs).count() == imatch.neighbour_fingerprints(docs, most_broadcast=0).count() == len(every)


def test_langid(docs, empty, spark):
    marked = langid.op4_langid(docs).collect()
    assert len(marked) == len(ROWS)
    assert {r["lang_pred"] for r in marked if r["doc_id"] in (1, 2)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in marked)
    assert langid.op4_langid(empty).count() == 0
    assert {r["lang_pred"] for r in langid.op4_langid(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not any(r["rejected"] for r in toxicity.op5_toxicity(docs, none).collect())
    bad = [(100 + i, prose(i, 40) + (" nasty vile words" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(240)]
    more = spark.createDataFrame([(i, t) for i, t, _ in bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, x) for i, _, x in bad] + [(None, 1, 1), (101, 1, None), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.op5_toxicity(more, labels).collect()}
    assert all(found[i]["rejected"] == bool(x) and 0 <= found[i]["severity"] <= 3 for i, _, x in bad)
    model = toxicity.fit(more, labels)
    assert toxicity.scored(docs, model).count() == len(ROWS)
    assert toxicity.scored(empty, model).count() == 0


def test_pii(docs, empty):
    rows = {r["doc_id"]: r for r in pii.op2_pii(docs).collect()}
    r = rows[8]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    assert rows[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    text = {x["doc_id"]: x["pii_text"] for x in pii.redacted(docs).select("doc_id", "pii_text").collect()}
    assert text[8] == "mail [email] or [phone], card [card], ip [ip]" and text[1] is None and text[6] == LONG
    assert pii.op2_pii(docs).count() == len(ROWS) and pii.op2_pii(empty).count() == 0


def test_bpe_equals_tiktoken(docs, empty):
    import tiktoken

    merges = bpe.ranks(bpe.vocabulary_path())
    plain = tiktoken.Encoding("own", pat_str=bpe.pattern(), mergeable_ranks=merges, special_tokens={})
    expected = collections.Counter()
    for t in texts():
        ids = np.array(plain.encode_ordinary(t), dtype="<u4")
        expected[len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert collections.Counter((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.op7_bpe(docs).collect()) == expected
    assert bpe.op7_bpe(empty).count() == 0
    odd = ["ab" * 3000, "=-" * 2000, " " * 3000 + "x", "é" * 300, "😀\u0000" * 200, "don't I'LL 12345"]
    own = bpe.Encoder(bpe.vocabulary_path(), bpe.pattern())
    for t, (ids, text) in zip(odd, own.encode(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(t) and text == t.encode()


def test_token_counts(docs, empty):
    rows = tokencount.op9_token_counts(docs).collect()
    total = collections.Counter()
    for r in rows:
        total[r["doc_id"]] += r["n_tokens"]
    assert total[6] == next(r["doc_tokens"] for r in rows if r["doc_id"] == 6) and total[1] == 0
    assert tokencount.op9_token_counts(empty).count() == 0


@pytest.mark.parametrize("rule, expected", [("first", [0, 1, 1]), ("last", [1, 1, 1]), ("most", [0, 1, 1])])
def test_crossing_tokens_go_by_the_rule(rule, expected):
    to, crossing = tokencount.attribute(np.array([0, 3, 5]), np.array([3, 5, 9]), np.array([0, 2]), rule)
    assert to.tolist() == expected and crossing.tolist() == [True, False, False]


def test_ngram_join(docs, empty):
    rows = ngram_join.op8_ngram_join(docs).collect()
    assert len(rows) == len(ROWS)
    found = {r["doc_id"]: r for r in rows}
    assert found[7]["component_id"] == 6 and found[None]["component_id"] is None and found[1]["n_shingles"] == 0 and found[3]["n_shingles"] == 1
    assert all(found[i]["component_id"] == i for i in (1, 2, 3, 4, 5, 8, 9))
    assert ngram_join.op8_ngram_join(empty).count() == 0


@pytest.mark.parametrize("last", [None, "", " "])
def test_ngram_join_links_copies_of_six_words_before_a_text_without_words(spark, last):
    six = "one two three four five six"
    rows = [(1, "a b c d e f g h"), (2, six), (3, six), (4, last), (5, last)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in ngram_join.near_duplicates(df).collect()}
    assert found == {1: (1, 4), 2: (2, 2), 3: (2, 2), 4: (4, 0), 5: (5, 0)}
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()) == [1, 2, 4, 5]


def test_ngram_join_keeps_texts_of_one_id_together(spark):
    x, y = "one two three four five six seven eight", "other words stand in this text of mine"
    rows = [(3, x), (5, x), (5, y), (8, y), (9, "quite alone")]
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(3, 3), (5, 3), (5, 3), (8, 3), (9, 9)]


def test_a_passage_in_every_text_links_none(spark):
    rows = [(i, prose(5, 50) + " " + " ".join(f"own{i}x{j}" for j in range(14))) for i in range(200)] + [(500, prose(5, 50))]
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # 46 of 60 shingles: two such texts share 46 of 74, each shares 46 of 60 with the passage itself
    assert {r["component_id"] for r in found} == {0}
    alone = ngram_join.near_duplicates(spark.createDataFrame(rows[:-1], "doc_id long, text string")).collect()
    assert all(r["component_id"] == r["doc_id"] for r in alone)


@pytest.mark.parametrize("frequent", [None, 1, 3])
def test_ngram_join_by_brute_force(spark, frequent):
    rng = np.random.default_rng(5)
    made = []
    for i in range(160):
        if i % 3 == 0 or not made:
            words = list(rng.integers(0, 60, rng.integers(3, 60)))
        else:
            words = list(made[rng.integers(0, len(made))])
            for _ in range(rng.integers(0, 3)):
                words[rng.integers(0, len(words))] = rng.integers(0, 60)
        made.append(words)
    sets = {}
    for i, w in enumerate(made):
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or {tuple(w)}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame([(i, " ".join(f"W{x}" for x in w)) for i, w in enumerate(made)], "doc_id long, text string")
    found = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in ngram_join.near_duplicates(df, frequent).collect()}
    assert found == {i: (root(i), len(sets[i])) for i in sets}


def brute_removed(rows, length=400):
    seen = collections.Counter()
    for _, t in rows:
        raw = t.encode()
        seen.update(raw[p : p + length] for p in range(len(raw) - length + 1))
    out = collections.Counter()
    for i, t in rows:
        raw = t.encode()
        cover = np.zeros(len(raw) + 1, dtype=int)
        for p in range(len(raw) - length + 1):
            if seen[raw[p : p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover)[: len(raw)] > 0
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("words", [60, 34])
def test_ngram_join_of_near_copies_grows_with_their_places_not_with_their_number(spark, monkeypatch, words):
    lists, write = [], ngram_join.written

    def counted(df, label, rows=None):
        out = write(df, label, rows)
        if label == "ngram-lists":
            lists.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", counted)

    def copies(n):
        out = []
        for i in range(n):  # one word in each differs, at one of 12 places; and two differ in some
            text = [f"w{k}" for k in range(words)]
            text[5 + 2 * (i % 12)] = f"x{i}"
            if i % 40 == 7:
                text[(3 * i) % words] = f"y{i}"
            out.append((i, " ".join(text)))
        return out

    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(words - 4)} for i, t in copies(240)}
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    found = ngram_join.near_duplicates(spark.createDataFrame(copies(240), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == root
    if words == 60:
        assert sum(lists) < 60 * 40  # 18 sets or so with a prefix of 15; a set for each copy would have over 3,000


def test_suffix_dedup_by_brute_force(spark, empty):
    rows = [(1, ""), (2, "short"), (3, PASSAGE + prose(3, 60)), (4, prose(4, 70) + PASSAGE), (5, prose(5, 20) + PASSAGE[3:] + prose(6, 5)), (6, "é" * 600), (7, "ab" * 700), (8, prose(7, 200)), (8, prose(7, 200)), (9, prose(8, 300)), (10, prose(8, 300)[:700] + "x" + prose(8, 300)[701:]), (11, "a" * 399), (12, "b" * 400)]
    df = spark.createDataFrame([(i, t if t else None, 1) for i, t in rows], "doc_id long, text string, row int")
    found = collections.Counter(tuple(r) for r in suffix_dedup.op6_suffix_dedup(df).collect())
    assert found == brute_removed(rows)
    assert suffix_dedup.op6_suffix_dedup(empty).count() == 0


def test_suffix_dedup_of_common_beginnings(spark):
    rows = [(i, prose(99, 200)[: 430 + 6 * i] + " " + prose(100 + i, 30)) for i in range(40)]
    found = suffix_dedup.op6_suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert collections.Counter(tuple(r) for r in found.collect()) == brute_removed(rows)


def test_suffix_dedup_of_mixed_passages(spark):
    r = np.random.default_rng(7)
    pool, rows = [prose(1000 + i, 300) for i in range(4)], []
    for i in range(60):
        parts = []
        for _ in range(r.integers(1, 4)):
            text = pool[r.integers(0, 4)]
            start = r.integers(0, len(text) - 350)
            parts.append(text[start : start + r.integers(300, 900)])
            if r.random() < 0.5:
                parts.append(prose(int(r.integers(1e6)), int(r.integers(1, 20))))
        rows.append((i, "".join(parts)))
    found = suffix_dedup.op6_suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert collections.Counter(tuple(r) for r in found.collect()) == brute_removed(rows)


def test_suffix_dedup_hashes_pieces_of_a_batch(monkeypatch):
    sizes = []

    def hashes(data):
        sizes.append(len(data))
        return Hashes(data)

    monkeypatch.setattr(suffix_dedup, "Hashes", hashes)
    raw = [prose(i, 120)[:500].encode() for i in range(1500)]
    pdf = pd.DataFrame({"around": range(1500), "offset": 60, "spare": 50, "rows": 1, "bytes": raw, "opened": [[0, 64]] * 1500})
    asked = suffix_dedup._asked(16, 64)
    whole = pd.concat(asked(iter([pdf])), ignore_index=True)
    assert len(sizes) > 1 and max(sizes) <= 250_000 < sum(sizes)
    assert whole.equals(pd.concat(asked(pdf.iloc[i : i + 1] for i in range(1500)), ignore_index=True))


def test_suffix_dedup_of_the_tables_by_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    assert collections.Counter(tuple(r) for r in suffix_dedup.op6_suffix_dedup(docs).collect()) == brute_removed(rows)


def test_windows_have_their_anchors(spark):
    raw = [t.encode() for t in (prose(1, 300), "a" * 399, prose(1, 300)[200:1200], "", "xy" * 400)]
    found = anchors(raw)
    for d, text in enumerate(raw):
        mine = sorted((int(a), int(f), int(z)) for i, a, f, z in zip(found.doc, found.at, found.first, found.last) if i == d)
        covered = [p for _, f, z in mine for p in range(f, z + 1)]
        assert sorted(covered) == list(range(len(text) - LENGTH + 1)) and all(0 <= a - p < WINDOW for a, f, z in mine for p in (f, z))
    offsets = {}
    for d, a, f, z in zip(found.doc, found.at, found.first, found.last):
        for p in range(f, z + 1):
            assert offsets.setdefault(raw[d][p : p + LENGTH], a - p) == a - p


def test_topk_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    vectors += [(400 + i, [0.5] * 8) for i in range(60)] + [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 8), (1150, [float("inf")] * 8), (None, [1.0] * 8), (7, vectors[7][1]), (450, [0.5] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<float>, v string, chunk int")
    clean = {i: np.floor(256 * np.array(v, dtype=np.float32).astype(float)) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all()}
    expected = []
    for q in (i for i in clean if i % 50 == 0):
        ranked = sorted(((-int(clean[q] @ clean[c]), c) for c in clean if c != q))[:5]
        expected += [(q, r + 1, c, -s) for r, (s, c) in enumerate(ranked)]
    usable = df.select("vec_id", topk.scaled(F.col("embedding")).alias("v")).filter("vec_id is not null and v is not null").distinct()
    for chunk, lists, block, most in ((1024, 2, 4096, topk.MOST_BROADCAST), (50, 3, 4, 600)):  # the second broadcasts two blocks at a time
        monkeypatch.setattr(topk, "MOST_BROADCAST", most)
        found = topk.top_k(usable, usable.filter("vec_id % 50 = 0"), 5, lists, chunk, block)
        assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert sorted(map(tuple, topk.op1_topk(df).collect())) == sorted(expected)
    assert topk.op1_topk(df.limit(0)).count() == 0
    assert topk.op1_topk(df.filter("vec_id in (100, 150)")).count() == 2
