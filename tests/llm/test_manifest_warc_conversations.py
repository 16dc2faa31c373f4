"""Merkle manifest, WARC archives and conversation repair against plain versions, and on odd rows."""

import base64
import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from bindery.llm import conversations, merkle, warc
from bindery.llm.common import table, written

BIG = 1 << 60


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """All levels of a plain tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_manifest(rows):
    """op11's rows from (doc_id, source, lang, n_chars, text)."""
    trees = collections.defaultdict(list)
    for r in rows:
        doc_id, source, lang, n, text = r
        leaf = sha(*map(field, r))
        odd = doc_id is None or zlib.crc32(str(doc_id).encode()) % 2
        other = leaf if odd or text is None else sha(*map(field, (doc_id, source, lang, n, text.replace("\n", ""))))
        trees[source].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, other))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: climb([x[2] for x in sorted(trees[s], key=lambda x: x[0])]) for s in order}
    above = climb([levels[s][-1][0] for s in order])
    out = collections.Counter()
    for k, s in enumerate(order):
        for i, (_, doc_id, leaf, other) in enumerate(sorted(trees[s], key=lambda x: x[0])):
            proof, folded = "", other
            for at, level in [(i // 3**h, x) for h, x in enumerate(levels[s][:-1])] + [(k // 3**h, x) for h, x in enumerate(above[:-1])]:
                run = at - at % 3
                before, after = "".join(level[run:at]), "".join(level[at + 1 : run + 3])
                proof, folded = proof + before + after, sha(before, folded, after)
            root = above[-1][0]
            out[doc_id, leaf, levels[s][-1][0], root, sha(proof), folded, folded == root] += 1
    return out


DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, place int, digest string"


def manifest_rows(spark, rows):
    df = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], DOCS).repartition(3)
    return collections.Counter(map(tuple, merkle.op11_merkle(df).collect()))


def test_manifest_by_brute_force(spark):
    r = random.Random(3)
    rows = [(i, "large", "en", r.choice((None, i)), f"text {i}\nmore" if i % 3 else f"text {i}") for i in range(700)]
    rows += [(BIG + i, f"s{i % 7}", None, 5, "é\n" * (i % 4)) for i in range(30)] + [(None, None, None, None, None), (None, None, "fr", 1, "b\n"), (None, None, None, None, None)]
    rows += [(5, "ü", "en", 1, ""), (6, "", "en", 1, None), (7, "Z", "en", 2, "long " * 50_000), (7, "Z", "en", 2, "long " * 50_000), (BIG + 1, None, "en", 2, "a\n\n")]
    found = manifest_rows(spark, rows)
    assert found == plain_manifest(rows)
    assert {v for *_, v in found} == {True, False}


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "a", "en", 1, "x\n"), (1, "a", "en", 1, "x\n")], [(i, f"s{i:03}", "en", 1, "x") for i in range(5)]])
def test_manifest_of_few_rows(spark, rows):
    assert manifest_rows(spark, rows) == plain_manifest(rows)


def test_manifest_over_three_rounds_of_blocks(spark):
    n = merkle.BLOCK**2 + 10
    nodes = spark.range(n).select(F.lit("t").alias("tree"), F.col("id").alias("place"), F.lit(n).cast("long").alias("size"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"))
    done = merkle.paths(written(nodes, "test-nodes"))
    root = climb([sha(str(i)) for i in range(n)])[-1][0]
    folded = merkle.folded(F.col("digest"), F.col("lefts"), F.col("beside"))
    assert [tuple(r) for r in done.select("top", folded.alias("f")).distinct().collect()] == [(root, root)] and done.count() == n


PAGES = "page_id long, url string, html string, digest string, file string, offset int"


def page_rows(spark, rows):
    return spark.createDataFrame([(*r, "x", "f", 3) for r in rows], PAGES).repartition(3)


def plain_warc(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = max(first.get(html or "", i), i)
    out = collections.Counter()
    for i, _, html in rows:
        raw, to = (html or "").encode(), first.get(html or "")
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out[i, len(raw), digest, "response" if i == to else "revisit", None if i == to else to] += 1
    return out


ODD_PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (BIG, None, "<p>one</p>"), (BIG + 1, "http://a/ b\r\nX: yé<>", "<p>é</p>"), (4, "", None), (5, "u", ""), (6, "u", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (7, "u", "long\n" * 100_000), (7, "v", "long\n" * 100_000), (8, "u", "long\n" * 100_000), (None, "n", "<p>one</p>"), (None, "n", "alone"), (None, "m", "alone"), (9, "u", "x"), (9, "u", "y"),
]


def test_warc_by_brute_force(spark):
    found = collections.Counter(map(tuple, warc.op12_warc(page_rows(spark, ODD_PAGES)).collect()))
    assert found == plain_warc(ODD_PAGES)
    assert warc.op12_warc(page_rows(spark, [])).count() == 0


@pytest.mark.parametrize("compress", [False, True])
def test_archives_come_back_by_index(spark, tmp_path, compress):
    folder = f"file://{tmp_path}/archives"
    index = warc.write_archives(warc.planned(page_rows(spark, ODD_PAGES)), folder, compress)
    payloads = collections.Counter((r["page_id"], bytes(r["payload"]).decode()) for r in warc.read_records(index.filter("record_type = 'response'"), folder).collect())
    kept = plain_warc(ODD_PAGES)
    kind = {(r[0], r[2]): r[3] for r in kept}
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    assert payloads == collections.Counter((i, h or "") for i, _, h in ODD_PAGES if kind[i, digest(h)] == "response")
    one = index.filter("page_id = 6")
    assert [bytes(r["payload"]).decode() for r in warc.read_records(one, folder).collect()] == ["\r\n\r\nWARC/1.1\r\n\r\n"]
    assert sorted(r["url"] or "" for r in index.collect()) == sorted(u or "" for _, u, _ in ODD_PAGES)
    sizes = {r["file"]: 0 for r in index.collect()}
    for r in index.collect():
        sizes[r["file"]] += r["length"]
    assert {f: (tmp_path / "archives" / f).stat().st_size for f in sizes} == sizes


def test_payloads_below_the_least_size_are_all_responses(spark):
    kinds = {(r["page_id"], r["url"]): r["record_type"] for r in warc.planned(page_rows(spark, ODD_PAGES), least=11).collect()}
    assert kinds[1, "http://a/1"] == kinds[2, "http://a/2"] == "response" and kinds[7, "u"] == "revisit"


def test_a_damaged_payload_is_told():
    raw = warc.record(1, "u", b"hello", "A" * 32, "response", None, "d")
    with pytest.raises(ValueError):
        warc.parsed(raw)


def test_reads_take_near_records_together():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 20 + warc.GAP, 5), ("a", 26 + 2 * warc.GAP, 5), ("b", 0, 3), ("b", 3, warc.SPAN)]
    assert list(warc.spans(iter(rows))) == [("a", 0, [(0, 10), (10, 10), (20 + warc.GAP, 5)]), ("a", 26 + 2 * warc.GAP, [(0, 5)]), ("b", 0, [(0, 3)]), ("b", 3, [(0, warc.SPAN)])]


MOVES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def every_repair(rows):
    """(cost, audit) of the best of all edits, tried one by one; rows are (initial, fault)."""
    best, most = [], 4 * len(rows)

    def go(i, state, cost, audit):
        if cost > most:
            return
        if i == len(rows) and state in ("", "a"):
            best.append((cost, audit))
        for role in "ua":
            if (state, role) in MOVES:
                go(i, role, cost + 3, audit + "I")
        if i < len(rows):
            initial, fault = rows[i]
            go(i + 1, state, cost + 4, audit + "D")
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if (state, initial) in MOVES:
                    go(i + 1, initial, cost + more, audit + "K")
                for role in "ua":
                    if (state, role) in MOVES:
                        go(i + 1, role, cost + 3 + more, audit + "R")

    go(0, "", 0, "")
    return min(best)


FAULTS = ("sound", "blank", "duplicate", "truncated")


def test_repair_is_the_cheapest_and_least():
    r = random.Random(5)
    cases = [list(c) for n in range(3) for c in itertools.product(itertools.product("suax", FAULTS), repeat=n)]
    cases += [[(r.choice("suuaax"), r.choices(FAULTS, (6, 1, 1, 2))[0]) for _ in range(r.randint(3, 5))] for _ in range(150)]
    for rows in cases:
        codes = bytes(4 * "suax".index(i) + FAULTS.index(f) for i, f in rows)
        assert conversations.repair(codes) == every_repair(rows)


def test_repair_is_the_same_over_many_blocks():
    r = random.Random(6)
    codes = bytes(r.choice((0, 4, 4, 8, 8, 7, 11, 12, 5)) for _ in range(3 * conversations.BLOCK + 17))
    cost, audit = conversations.repair(codes)
    keep, conversations.BLOCK = conversations.BLOCK, 1 << 30
    try:
        assert conversations.repair(codes) == (cost, audit)
    finally:
        conversations.BLOCK = keep


def plain_conversations(rows):
    out, by = collections.Counter(), collections.defaultdict(list)
    space = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        fate, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        kept = by[conv]
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            kept += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    for conv, found in by.items():
        tie = lambda r: sha(f"{len(r[1].encode())}:", r[1], r[2])
        found = sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), tie(r)))
        faults, seen = [], set()
        for _, role, text in found:
            words = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "sound")
            seen.add((role, text))

        @functools.cache
        def best(i, state, inserts=3):
            ways = [(0, "", ())] if i == len(found) and state in ("", "a") else []
            for role in "ua":
                if (state, role) in MOVES and inserts:
                    c, a, t = best(i, role, inserts - 1)
                    ways.append((c + 3, "I" + a, ({"u": "user:", "a": "assistant:"}[role], *t)))
            if i < len(found):
                _, role, text = found[i]
                c, a, t = best(i + 1, state)
                ways.append((c + 4, "D" + a, t))
                if faults[i] not in ("blank", "duplicate"):
                    more = 3 if faults[i] == "truncated" else 0
                    if (state, role[:1]) in MOVES:
                        c, a, t = best(i + 1, role[:1])
                        ways.append((c + more, "K" + a, (f"{role}:{text}", *t)))
                    for other in ("user", "assistant"):
                        if (state, other[0]) in MOVES:
                            c, a, t = best(i + 1, other[0])
                            ways.append((c + 3 + more, "R" + a, (f"{other}:{text}", *t)))
            return min(ways, default=(1 << 30, "", ()))

        cost, audit, turns = best(0, "")
        numbers = [t for t, *_ in found if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out[(conv, gaps, *(faults.count(f) for f in FAULTS[1:]), illegal, cost, audit, sha("\n".join(turns)))] += 1
    return out


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
ODD_TURNS = [
    (1, 0, "system", "You are."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."), (1, 3, "assistant", "Yes."), (2, None, None, None), (2, None, "user", "no end"), (2, 5, "user", "ok."), (2, 5, "user", "ok."), (2, 5, "assistant", "other"),
    (None, 1, "user", "Who?"), (None, None, "assistant", "Me!"), (BIG, 1, "user", "one."), (BIG + 1, 1, "user", "two."), (BIG + 1, 9, "tool", "  \t\n"), (3, 0, "", ""), (4, 7, "assistant", "word " * 60_000 + "."), (5, 0, "user", "line\n"), (5, 1, "assistant", "end. \n\n"),
] + [(6, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(60)]


def test_conversations_by_brute_force(spark, sf_dir):
    schema = "conv_id long, turn int, role string, text string, digest string, code int"
    df = spark.createDataFrame([(*r, "d", 1) for r in ODD_TURNS], schema).repartition(3)
    found = collections.Counter(tuple(r) for r in conversations.op13_conversations(df).select(*COLUMNS).collect())
    assert found == plain_conversations(ODD_TURNS)
    assert conversations.op13_conversations(df.limit(0)).count() == 0
    given = table(spark, sf_dir, "conversations")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    assert collections.Counter(tuple(r) for r in conversations.op13_conversations(given).select(*COLUMNS).collect()) == plain_conversations(rows)


def test_a_conversation_without_rows_left(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "x.")], "conv_id long, turn int, role string, text string")
    assert [tuple(r) for r in conversations.op13_conversations(df).select(*COLUMNS).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns_give_the_digest(spark):
    df = spark.createDataFrame(ODD_TURNS, "conv_id long, turn int, role string, text string")
    rows = conversations.damaged(df)
    told = written(conversations.summaries(rows), "test-audits")
    turns = collections.defaultdict(list)
    for r in sorted(conversations.repaired(rows, told).collect(), key=lambda r: r["place"]):
        turns[r["conv_id"]].append(r)
    hashed = {r["conv_id"]: r["repaired_sha256"] for r in conversations.digests(rows, told).collect()}
    for conv, digest in hashed.items():
        assert digest == sha("\n".join(f"{r['role']}:{r['text']}" for r in turns[conv]))
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in turns[conv]))
