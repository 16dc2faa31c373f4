"""Operators that SQL cannot express against plain versions of themselves."""

import collections
import itertools
import math
import os
import time

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from bindery.llm import bpe, imatch, langid, pii, tokencount, toxicity
from bindery.llm.common import table


def hashed(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64_intdigest(data, seed)


def test_imatch_by_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    terms = lambda text: {hashed(t.encode()) >> 1 for t in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if t}
    df = collections.Counter(t for _, text in rows for t in terms(text))
    lexicon = {t for t, n in df.items() if 0.005 * len(rows) <= n <= 0.2 * len(rows)}

    def print_of(text):
        mine, out = sorted(terms(text) & lexicon), []
        for k in range(imatch.SUBSETS):
            seed = hashed(k.to_bytes(4, "little"))
            if len(mine) < 3:
                out.append(hashed(hashed(text.encode()).to_bytes(8, "little"), seed) & 0xFFFFFFFF)
                continue
            part = [t for t in mine if (t >> 3) % imatch.SUBSETS == k]
            for t in part:
                seed = hashed(t.to_bytes(8, "little"), seed)
            out.append(seed & 0xFFFFFFFF if part else None)
        return out

    def near(a, b):
        some = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
        return sum(x == y for x, y in some) / len(some)

    shown = lambda p: "".join("-" * 8 if x is None else f"{x:08x}" for x in p)
    prints = [print_of(t) for _, t in rows]
    found = {r["doc_id"]: r for r in imatch.op3_imatch(docs).collect()}
    for i, (doc_id, text) in enumerate(rows):
        after, half = (i + 1) % len(rows), len(text) // 2
        edited = print_of(text[: len(text) - half] + rows[after][1][:half])
        r = found[doc_id]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(prints[i]), shown(edited))
        assert math.isclose(r["near_edited"], near(prints[i], edited)) and math.isclose(r["near_next"], near(prints[i], prints[after]))
    edits, nexts = (sum(r[c] for r in found.values()) / len(rows) for c in ("near_edited", "near_next"))
    assert edits > 0.05 and edits > 10 * nexts


def test_imatch_subsets_cost_less_than_a_pass_over_all_terms_each(spark):
    terms = F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.shiftrightunsigned(F.xxhash64("id", i), 1))
    rows = spark.range(0, 3000, 1, 1).select(terms.alias("terms"), F.xxhash64("id").alias("whole")).persist()
    rows.count()

    def one(k):
        mine = F.filter("terms", lambda t: F.shiftright(t, 3).bitwiseAND(F.lit(imatch.SUBSETS - 1)) == k)
        return F.when(F.size(mine) > 0, F.xxhash64(k, mine).bitwiseAND(F.lit(0xFFFFFFFF)))

    def timed(column):
        begin = time.monotonic()
        return rows.agg(F.sum(F.xxhash64(column).cast("decimal(20,0)"))).first()[0], time.monotonic() - begin

    plain, dealt = F.transform(F.sequence(F.lit(0), F.lit(imatch.SUBSETS - 1)), one), imatch.subset_hashes(F.col("terms"), F.col("whole"))
    timed(plain), timed(dealt)
    (a, slow), (b, fast) = timed(plain), timed(dealt)
    assert a == b and fast < 0.7 * slow
    rows.unpersist()


def test_viterbi_by_enumeration():
    rng = np.random.default_rng(4)
    labels, features = len(pii.LABELS), 5
    emit = np.vstack([rng.normal(size=(features, labels)), np.zeros((1, labels))])
    model = pii.Model({str(i): i for i in range(features)}, emit, rng.normal(size=(labels, labels)), rng.normal(size=labels))
    runs = [[rng.integers(0, features, 2).tolist() for _ in range(n)] for n in (1, 2, 3, 4, 4, 2)]
    best = pii.viterbi(model, *pii.batch(runs, features))
    for run, path in zip(runs, best):
        def score(labels_of):
            total = model.begin[labels_of[0]] + sum(emit[f, y].sum() for f, y in zip(run, labels_of))
            return total + sum(model.move[a, b] for a, b in zip(labels_of, labels_of[1:]))

        ranked = max(itertools.product(range(labels), repeat=len(run)), key=score)
        assert tuple(path[: len(run)].tolist()) == ranked


def test_crf_training_raises_the_likelihood(spark):
    rows = pii.training_table(spark, rows=40, seed=3).collect()
    tokens, labels = [r["tokens"] for r in rows], [r["labels"] for r in rows]

    def likelihood(model):
        total = 0.0
        for words, tags in zip(tokens, labels):
            text, starts = " ".join(words), np.cumsum([0] + [len(w) + 1 for w in words])
            for run in pii.token_runs(text, [m.span() for m in pii.DIGITS.finditer(text)]):
                if len(run) > 4:
                    continue
                gold = [pii.LABELS.index(tags[int(np.searchsorted(starts, t.start, side="right")) - 1]) for t in run]
                known = [[model.index.get(f, len(model.index)) for f in pii.token_features(t)] for t in run]
                score = lambda path: model.begin[path[0]] + sum(model.emit[f, y].sum() for f, y in zip(known, path)) + sum(model.move[a, b] for a, b in zip(path, path[1:]))
                every = [score(p) for p in itertools.product(range(len(pii.LABELS)), repeat=len(run))]
                total += score(gold) - float(np.logaddexp.reduce(every))
        return total

    before, after = (likelihood(pii.fit_rows(tokens, labels, steps=n)) for n in (1, 60))
    assert after > 0.2 * before > before


def test_language_by_plain_cosines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").limit(60)
    model = langid.fit(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    texts |= {-1: "12 34 !?", -2: None, -3: "и ещё one mixed текст here"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    for doc_id, text in texts.items():
        if not text or not any(c.isalpha() for c in text):
            assert (found[doc_id]["lang_pred"], found[doc_id]["score"]) == ("und", 0)
            continue
        row = langid.counts([text])[0]
        weights = {i: math.sqrt(n) * float(model.idf[i]) for i, n in enumerate(row.tolist()) if n}
        size = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * float(c[i]) for i, w in weights.items()) / size for c in model.centroids]
        assert math.isclose(found[doc_id]["score"], max(cosines), abs_tol=1e-4)
        assert found[doc_id]["lang_pred"] in {model.languages[model.owner[i]] for i, x in enumerate(cosines) if x > max(cosines) - 1e-4}


def test_severity_by_plain_sums(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    assert model is not None and (np.diff(model.thresholds) > 0).all()
    found = {r["doc_id"]: r for r in toxicity.scored(docs.select("doc_id", "text"), model).collect()}
    for r in docs.select("doc_id", "text").limit(40).collect():
        _, spots, times = toxicity.features([r["text"] or ""])
        s = sum(math.log1p(n) * float(model.weights[i]) for i, n in zip(spots.tolist(), times.tolist()))
        above = [1 / (1 + math.exp(-(s - t))) for t in model.thresholds]
        mine = found[r["doc_id"]]
        assert math.isclose(mine["toxic_severity"], sum(above), abs_tol=1e-4) and math.isclose(mine["toxic_p"], above[0], abs_tol=1e-4)


def test_toxicity_on_held_out_labels(spark, sf_dir):
    larger = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.1")
    if not os.path.isdir(larger):
        pytest.skip("no larger tables here")
    docs, labels = table(spark, larger, "documents"), table(spark, larger, "labels").filter("doc_id is not null")
    model = toxicity.fit(docs, labels.filter("doc_id % 2 = 0"))
    held = toxicity.scored(docs.join(labels.filter("doc_id % 2 = 1"), "doc_id").select("doc_id", "text", "toxic"), model)
    rows = held.select("toxic", "toxic_rejected").collect()
    toxic, clean = ([r["toxic_rejected"] for r in rows if (r["toxic"] > 0) == kind] for kind in (True, False))
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)


@pytest.mark.parametrize("rule", tokencount.RULES)
def test_token_counts_by_brute_force(spark, sf_dir, rule):
    import tiktoken

    plain = tiktoken.Encoding("own", pat_str=bpe.pattern(), mergeable_ranks=bpe.ranks(bpe.vocabulary_path()), special_tokens={})
    odd = ["", "one\ntwo\n\nthree", "\n", "é\nü 😀\n\nend\n", "no break", "a\n\n\n\nb", "x" * 50 + "\n" + " " * 30 + "\n\ty"]
    rows = [(-1 - i, t) for i, t in enumerate(odd)] + [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").select("doc_id", "text").limit(40).collect()]
    expected = collections.Counter()
    for doc_id, text in rows:
        parts = (text or "").splitlines(keepends=True) if set(regex.findall(r"[\v\f\r\x1c-\x1e\x85  ]", text or "")) == set() else regex.findall(r"[^\n]*\n|[^\n]+", text)
        bounds = list(itertools.accumulate((len(p) for p in parts), initial=0)) if parts else [0, 0]
        section_of = [i for i, (a, b) in enumerate(zip(bounds, bounds[1:])) for _ in range(b - a)]
        counts, crossing = collections.Counter(), collections.Counter()
        raw_at = [i for i, c in enumerate(text or "") for _ in c.encode()]
        at, ids = 0, plain.encode_ordinary(text or "")
        for token in ids:
            size = len(plain.decode_single_token_bytes(token))
            chars = sorted(set(raw_at[at : at + size]))
            at += size
            homes = [section_of[c] for c in chars]
            most = max(sorted(set(homes)), key=homes.count)
            home = {"first": homes[0], "last": homes[-1], "most": most}[rule]
            counts[home] += 1
            crossing[home] += len(set(homes)) > 1
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[doc_id, i, a, b, counts[i], crossing[i], len(ids)] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collections.Counter(tuple(r) for r in tokencount.section_tokens(df, rule).collect()) == expected
