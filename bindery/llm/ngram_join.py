"""Jaccard join of documents on 5-word shingles, by token-combination prefixes.

Equal sets are one node, so copies cost nothing. Each set's shingles are hashed
and dealt by hash range to buckets, which tell every set which of its shingles
some other set has too; only a set with enough of them can have a partner, and
only these shingles can be shared. Among such sets the shingles are ordered by
frequency, rarest first. Of a set with n shingles a partner must share
ceil(0.75 n), so a prefix in that order is indexed.

Leaders come first: each set is compared with one leader of the keys of its
prefix, so that groups of near copies become components without meeting in pairs.
Sets of one size with the same shareable shingles share these and nothing else, and
share as many with any third set: where that is enough for a link, they are linked
with one of them, which stands for all from then on. So near copies that differ from
a text in one place each are as many sets as there are places, not as copies.
Then only shingles count that sets of several components have, and sets that
still have enough of them; after at most three such turns all pairs that are left
are compared. Their index has rare tokens alone and frequent ones, of which the
bound grows with the sets' size but not with the table, in combinations of two.
The prefix is extended until rare + max(0, frequent - 1) exceeds the shingles that
may differ; then two partners share a rare token or a combination. Keys are kept
apart by size class, since a set's shareable shingles bound a partner's size.
No link is lost.

Shingles are identified by the bucket and 32 more bits of a 64-bit hash: two
different shingles of sets of n and m are taken for equal with a probability of at
most n m / 2^36, 1 in 70 million for 30 each, less with more buckets. Equal sets
are told by 64 bits.

Defined cases: null text counts as empty; a document without words has no
shingle, links with nothing and is its own component; documents with fewer than
five words have one shingle, all their words; rows that share a doc_id count as
one node, each row being returned, whatever texts they have; of sets of equal size
the one of the smaller hash leads; very long texts are taken whole, one at a time; a
null doc_id links with nothing and its component is null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import discard, written
from .components import components
from .vectext import filled, mixed, pieces, released, words

SIZE = 5
#: Jaccard threshold as a fraction of integers.
SHARE, OF = 75, 100
#: A token that more sets have is indexed in combinations; more still among large sets, see frequent_from().
FREQUENT = 512
#: Bits of a set's sketch, and tokens that a key brings to tell whether two sets share an earlier one.
SKETCH, EARLIER = 512, 16
#: Sets that one bucket's row can tell apart.
SEVERAL = 0xFFFF


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash), distinct and sorted; texts of fewer than SIZE words have one."""
    found = words(texts)
    n = np.bincount(found.doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    odd = [np.uint64(2 * int(x) + 1) for x in mixed(np.arange(1, SIZE + 1, dtype=np.uint64)) >> np.uint64(1)]
    docs, hashes = [], []
    full = len(found.hash) - SIZE + 1
    if full > 0:
        value = sum(found.hash[i : i + full] * odd[i] for i in range(SIZE))
        inside = found.doc[:full] == found.doc[SIZE - 1 :]
        docs.append(found.doc[:full][inside])
        hashes.append(mixed(value[inside]))
    short = np.flatnonzero((n > 0) & (n < SIZE))
    if len(short):
        value = np.full(len(short), np.uint64(0x5851F42D4C957F2D), dtype=np.uint64) * n[short].astype(np.uint64)
        for i in range(SIZE - 1):
            has = n[short] > i
            value[has] += found.hash[first[short[has]] + i] * odd[i]
        docs.append(short)
        hashes.append(mixed(value))
    if not docs:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    doc, value = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[fresh], value[fresh]


def _dealt(buckets: int):
    """Texts to rows of buckets: the shingles of each bucket's hash range and whose they are; and each document's set."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            texts = filled(pdf["text"])
            ids = pdf["doc_id"].to_numpy(dtype=np.int64)
            for piece in pieces(texts, 1_000_000):
                part = [shingles(texts[piece][sub]) for sub in pieces(texts[piece], 500_000)]
                shift = np.cumsum([0] + [len(texts[piece][sub]) for sub in pieces(texts[piece], 500_000)])
                doc = np.concatenate([d + s for (d, _), s in zip(part, shift)])
                value = np.concatenate([v for _, v in part])
                n = np.bincount(doc, minlength=shift[-1])
                some = n > 0
                key = np.zeros(len(n), dtype=np.uint64)
                key[some] = np.add.reduceat(mixed(value), (np.cumsum(n) - n)[some])  # documents without shingles have no start
                key = mixed(key ^ (n.astype(np.uint64) << np.uint64(40))).view(np.int64)
                yield pd.DataFrame({"bucket": [int(ids[piece][0]) % buckets], "kind": [0], "sets": [ids[piece].tobytes() + key.tobytes() + n.astype(np.int64).tobytes()], "whose": [b""], "shingles": [b""]})

                # one copy of equal sets, then shingles that several sets have
                _, keep = np.unique(key, return_index=True)
                keep = np.sort(keep[n[keep] > 0])
                for begin in range(0, len(keep), SEVERAL - 1):
                    chosen = keep[begin : begin + SEVERAL - 1]
                    place = np.full(len(n), -1, dtype=np.int64)
                    place[chosen] = np.arange(len(chosen))
                    mine = place[doc] >= 0
                    at, v = place[doc[mine]], value[mine]
                    order = np.argsort(v, kind="stable")
                    at, v = at[order], v[order]
                    same = v[1:] == v[:-1]
                    several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
                    head = several & ~np.concatenate([[False], same])
                    bucket = ((v >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                    if several.any():  # these need no bucket's answer: any bucket may carry them
                        full_id = (bucket[several] << 32) | v[several].astype(np.uint32)
                        yield pd.DataFrame({"bucket": [int(v[several].sum() % np.uint64(buckets))], "kind": [2], "sets": [key[chosen][at[several]].tobytes()], "whose": [b""], "shingles": [full_id.tobytes()]})
                    send = ~several | head
                    bucket, low, at = bucket[send], v[send].astype(np.uint32), np.where(several[send], len(chosen), at[send])
                    order = np.lexsort((at, bucket))
                    bucket, low, at = bucket[order], low[order], at[order]
                    used, cuts = np.unique(bucket, return_index=True)
                    rows = []
                    for b, i, j in zip(used.tolist(), cuts, np.append(cuts[1:], len(bucket))):
                        whose, runs = np.unique(at[i:j], return_counts=True)
                        rows.append((b, 1, np.append(key[chosen], 0)[whose].tobytes(), np.concatenate([runs, [whose[-1] == len(chosen)]]).astype(np.uint32).tobytes(), low[i:j].tobytes()))
                    yield pd.DataFrame(rows, columns=["bucket", "kind", "sets", "whose", "shingles"])

    return run


def _answered(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: (1, shingle, set, 0) for every shingle of a set that another set has as well; documents pass through as (0, doc_id, set, n)."""
    out, sets, values, many = [], [], [], []
    for kind, keys, whose, low in zip(pdf["kind"], pdf["sets"], pdf["whose"], pdf["shingles"]):
        numbers = np.frombuffer(keys, dtype=np.int64)
        if kind == 0:
            ids, key, n = numbers.reshape(3, -1)
            out.append((np.zeros(len(ids), dtype=np.int64), ids, key, n))
        elif kind == 2:
            out.append((np.ones(len(numbers), dtype=np.int64), np.frombuffer(low, dtype=np.int64), numbers, np.zeros(len(numbers), dtype=np.int64)))
        else:
            *runs, last = np.frombuffer(whose, dtype=np.uint32).tolist()
            values.append(np.frombuffer(low, dtype=np.uint32))
            sets.append(np.repeat(numbers, runs))
            flag = np.zeros(len(values[-1]), dtype=bool)
            if last:  # the row's last run: shingles that several of its sets have
                flag[len(flag) - runs[-1] :] = True
            many.append(flag)
    if values:
        v, key, several = np.concatenate(values), np.concatenate(sets), np.concatenate(many)
        order = np.lexsort((key, v))
        v, key, several = v[order], key[order], several[order]
        start = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        last = np.append(start[1:], len(v)) - 1
        # a shingle is shared if rows of different sets have it, or several sets of one row
        shared = (key[start] != key[last]) | np.logical_or.reduceat(several, start)
        hit = np.repeat(shared, last - start + 1) & ~several
        n = int(hit.sum())
        out.append((np.ones(n, dtype=np.int64), (int(pdf["bucket"].iloc[0]) << 32) | v[hit].astype(np.int64), key[hit], np.zeros(n, dtype=np.int64)))
    kind, number, key, n = (np.concatenate(x) for x in zip(*out))
    return pd.DataFrame({"kind": kind, "number": number, "set": key, "n": n})


def dealt(docs: DataFrame, per_bucket: int = 700_000, least: int = 16) -> DataFrame:
    """(0, doc_id, set, n) of every document and (1, shingle, set, 0) of every shared shingle of a set; buckets grow in number with the text."""
    characters = docs.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()[0]
    buckets = max(least, characters // 6 // per_bucket)
    rows = docs.select("doc_id", "text").mapInPandas(released(_dealt(buckets)), "bucket int, kind int, sets binary, whose binary, shingles binary")
    return rows.groupBy("bucket").applyInPandas(_answered, "kind int, number long, set long, n long")


def needed(n: Column | str) -> Column:
    """Shingles that a partner of a set of n must share with it: ceil(0.75 n)."""
    n = F.col(n) if isinstance(n, str) else n
    return F.floor((n * SHARE + (OF - 1)) / OF)


def size_class(n: int) -> int:
    """A number that grows with n, eight to each doubling."""
    shift = max(0, n.bit_length() - 4)
    return 8 * shift + (n >> shift)


def frequent_from(size: int) -> int:
    """Sets that a token must have to be indexed in combinations among sets of this size.

    A set of n has prefixes of about n / 4 and so (n / 4)^2 / 2 combinations, which
    pay where a token's list is longer than that.
    """
    return max(FREQUENT, size * size // 16)


def _prefix(token: np.ndarray, common: np.ndarray, may_differ: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys of tokens in order of frequency: rare ones alone, then common ones in twos, until a partner must share a key; and the first few tokens before each key's last, its own left out."""
    done = np.cumsum(~common) + np.maximum(np.cumsum(common) - 1, 0)
    upto = int(np.searchsorted(done, may_differ + 1)) + 1
    token, common = token[:upto], common[:upto]
    rare = int((~common).sum())
    keys, before = [token[:rare]], [token[: min(j, EARLIER)] for j in range(rare)]
    pair = mixed(token[rare:].view(np.uint64))
    for j in range(1, len(pair)):
        keys.append((pair[:j] * np.uint64(0x9E3779B97F4A7C15) + pair[j]).view(np.int64))
        for i in range(j):
            before.append(np.delete(token[: min(rare + j, EARLIER + 1)], rare + i)[:EARLIER] if rare + i <= EARLIER else token[:EARLIER])
    return np.concatenate(keys), before


def _single_keys(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The tokens of each set's prefix, alone."""
    for pdf in pdfs:
        keys = [np.asarray(t, dtype=np.int64)[: len(t) - -(-SHARE * n // OF) + 1] for t, n in zip(pdf["tokens"], pdf["n"].tolist())]
        times = [len(k) for k in keys]
        yield pd.DataFrame({"key": np.concatenate(keys or [np.zeros(0, dtype=np.int64)]), **{c: np.repeat(pdf[c].to_numpy(), times) for c in ("node", "n", "component")}})


def _class_keys(frequent: int | None):
    """Index keys of each set by size class: as the larger set of a pair in its own class, as the smaller one in each class that a partner can be of."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            out, earlier, about, held = [], [], [], 0
            for row in pdf.itertuples(index=False):
                token, counts = np.asarray(row.tokens, dtype=np.int64), np.asarray(row.counts, dtype=np.int64)
                most = (OF + SHARE) * len(token) // SHARE - row.n  # a larger partner has no more than this
                roles = [(False, -(-SHARE * row.n // OF), [size_class(row.n)])]
                if most >= row.n:
                    roles.append((True, -(-2 * SHARE * row.n // (OF + SHARE)), list(range(size_class(row.n), size_class(most) + 1))))
                for small, share, classes in roles:
                    known = {}
                    for c in classes:
                        bound = frequent if frequent is not None else frequent_from(c if c < 16 else (8 + c % 8) << (c // 8 - 1))
                        if bound not in known:
                            known[bound] = _prefix(token, counts > bound, len(token) - share)
                        keys, before = known[bound]
                        out.append(mixed(keys.view(np.uint64) + np.uint64(c)).view(np.int64))
                        earlier += before
                        about.append((row.node, row.component, small, len(keys)))
                        held += len(keys)
                if held > 50_000:
                    yield _repeated(out, earlier, about)
                    out, earlier, about, held = [], [], [], 0
            if held:
                yield _repeated(out, earlier, about)

    return run


def _repeated(keys: list[np.ndarray], earlier: list[np.ndarray], about: list[tuple]) -> pd.DataFrame:
    *columns, times = (np.array(x) for x in zip(*about))
    return pd.DataFrame({"key": np.concatenate(keys), "earlier": earlier, **{c: np.repeat(x, times) for c, x in zip(("node", "component", "small"), columns)}})


def _sketches(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each bit of a sketch, whether the set's tokens that hash to it are odd in number."""
    for pdf in pdfs:
        bits = np.zeros((len(pdf), SKETCH), dtype=np.uint8)
        for i, tokens in enumerate(pdf["tokens"]):
            spot = (mixed(np.asarray(tokens, dtype=np.int64).view(np.uint64)) % np.uint64(SKETCH)).astype(np.int64)
            bits[i] = np.bincount(spot, minlength=SKETCH) & 1
        parts = np.packbits(bits, axis=1).view(np.int64)
        yield pd.DataFrame({"node": pdf["node"], "n": pdf["n"], "s": [len(t) for t in pdf["tokens"]], **{f"bits_{k}": parts[:, k] for k in range(SKETCH // 64)}})


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that link."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("tokens_a"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("tokens_b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return pairs.join(one, "a").join(two, "b").filter(OF * both >= SHARE * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")


def fits(n: str, m: str) -> Column:
    """Sets of these sizes can link at all."""
    return (OF * F.least(n, m) >= SHARE * F.greatest(n, m))


def still_open(sets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(node, n, component, tokens, counts) of the sets that can have a link to another component.

    Only a token that sets of several components have can be shared between two of
    them, and a set needs enough such tokens; they come rarest first.
    """
    named = sets.select("node", "n", "tokens")
    named = named.withColumn("component", F.col("node")) if labels is None else named.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    each = named.select("node", "n", "component", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("count"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("token", "count")
    often = written(often, "ngram-often")
    kept = each.join(often, "token").groupBy("node", "n", "component").agg(F.array_sort(F.collect_list(F.struct("count", "token"))).alias("t"))
    kept = written(kept.filter(F.size("t") >= needed("n")).select("node", "n", "component", F.col("t.token").alias("tokens"), F.col("t.count").alias("counts")), "ngram-sets")
    discard(often)
    return kept


def without_twins(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, links (a, b)): of sets that are equal in n and tokens, where these are enough for a link, the smallest node, and the others' links with it."""
    alike = F.size("tokens") * (OF + SHARE) >= 2 * SHARE * F.col("n")
    twins = F.xxhash64("n", "tokens").alias("twins")
    rows = sets.select("node", twins, alike.alias("alike"))
    # the least node of each group comes from a map-side minimum
    first = written(rows.filter("alike").groupBy("twins").agg(F.min("node").alias("a"), F.count("*").alias("several")).filter("several > 1").select("twins", "a"), "ngram-twins")
    links = written(rows.filter("alike").join(first, "twins").filter("node <> a").select("a", F.col("node").alias("b")), "ngram-twin-links")
    discard(first)
    return sets.join(links.select(F.col("b").alias("node")), "node", "left_anti"), links


def led_pairs(sets: DataFrame) -> DataFrame:
    """Each set with one leader of another component, the one that leads most of the keys they share.

    A key's leaders are the smallest set of its lowest component and the
    smallest of its highest one.
    """
    lists = written(sets.select("node", "n", "component", "tokens").mapInPandas(released(_single_keys), "key long, node long, n long, component long"), "ngram-lists")
    low, high = F.min(F.struct("component", "n", "node")).alias("low"), F.max(F.struct("component", (-F.col("n")).alias("less"), "node")).alias("high")
    ends = lists.groupBy("key").agg(low, high).filter("low.component < high.component")
    ends = ends.select("key", F.col("low.component").alias("c_low"), F.col("low.node").alias("low"), F.col("low.n").alias("n_low"), F.col("high.node").alias("high"), (-F.col("high.less")).alias("n_high"))
    ends = written(ends, "ngram-leaders")
    own = F.col("component") == F.col("c_low")
    led = lists.join(ends, "key").select("node", "n", F.when(own, F.col("high")).otherwise(F.col("low")).alias("a"), F.when(own, F.col("n_high")).otherwise(F.col("n_low")).alias("n_a")).filter(fits("n", "n_a"))
    most = led.groupBy("node", "a").count().groupBy("node").agg(F.min(F.struct((-F.col("count")).alias("less"), "a")).alias("m"))
    pairs = most.select("node", F.col("m.a").alias("a"))
    pairs = written(pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), "ngram-led")
    discard(lists)
    discard(ends)
    return pairs


def open_pairs(sets: DataFrame, frequent: int | None) -> DataFrame:
    """All pairs of sets of different components that share an index key and may link.

    A pair stays if the numbers of shingles and of shareable ones allow a link, and
    if the sketches do: the bits in which two sketches differ are at most the
    tokens in which the sets do. Of the keys that two sets share one is enough: a
    pair is left out where it has an earlier token in common, which gives another
    key.
    """
    index = written(sets.mapInPandas(released(_class_keys(frequent)), "key long, earlier array<bigint>, node long, component long, small boolean"), "ngram-index")
    sides = index.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.bool_or("small").alias("some_small"), F.bool_or(~F.col("small")).alias("some_large"))
    sides = written(sides.filter("low < high and some_small and some_large").select("key"), "ngram-keys")
    bits = [f"bits_{k}" for k in range(SKETCH // 64)]
    sketches = written(sets.select("node", "n", "tokens").mapInPandas(released(_sketches), "node long, n long, s long, " + ", ".join(f"{c} long" for c in bits)), "ngram-sketches")
    lists = written(index.join(sides, "key").join(sketches, "node"), "ngram-lists")
    for done in (index, sides, sketches):
        discard(done)
    fields = [c for c in lists.columns if c not in ("key", "small")]
    one = lists.filter("small").select("key", *(F.col(c).alias(f"{c}_a") for c in fields))
    two = lists.filter("not small").select("key", *(F.col(c).alias(f"{c}_b") for c in fields))
    of = lambda c: (F.col(f"{c}_a"), F.col(f"{c}_b"))
    (n_a, n_b), (s_a, s_b), (a, b) = of("n"), of("s"), of("node")
    ordered = (n_a < n_b) | ((n_a == n_b) & (a < b))
    can = (OF + SHARE) * F.least(s_a, s_b) >= SHARE * (n_a + n_b)
    differ = sum(F.bit_count(x.bitwiseXOR(y)) for x, y in map(of, bits)) + (n_a - s_a) + (n_b - s_b)
    near = (OF + SHARE) * differ <= (OF - SHARE) * (n_a + n_b)
    apart = of("component")[0] != of("component")[1]
    pairs = one.join(two, "key").filter(ordered & apart & can & near & ~F.arrays_overlap(*of("earlier")))
    pairs = written(pairs.select(a.alias("a"), b.alias("b")).distinct(), "ngram-pairs")
    discard(lists)
    return pairs


def link_components(sets: DataFrame, given: DataFrame, frequent: int | None = None, led: int = 3) -> DataFrame:
    """(node, component) of nodes that link, from sets (node, n, tokens) and links (a, b) that are given.

    At most `led` turns compare sets with leaders, as long as that joins components;
    the last turn compares all pairs that are still open.
    """
    links, labels = given, None if given.isEmpty() else written(components(given), "ngram-labels")
    turn = 0
    while turn <= led:
        now = still_open(sets, labels)
        if now.isEmpty():
            break
        one_each, twins = without_twins(now)
        one_each = written(one_each, "ngram-sets")
        pairs = led_pairs(one_each) if turn < led else open_pairs(one_each, frequent)
        fresh = written(verified(pairs, one_each).union(twins), "ngram-links")
        for done in (pairs, now, twins):
            discard(done)
        if turn:
            discard(sets)
        sets = one_each
        if fresh.isEmpty():
            turn = turn + 1 if turn == led else led
            continue
        turn += 1
        links = links.union(fresh)
        labels = written(components(links), "ngram-labels")
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def near_duplicates(docs: DataFrame, frequent: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs."""
    ship(docs.sparkSession)
    known = docs.select("doc_id", "text")
    table = written(dealt(known.filter("doc_id is not null")), "ngram-dealt")
    documents = table.filter("kind = 0").select(F.col("number").alias("doc_id"), F.col("set").alias("node"), "n")
    nodes = documents.filter("n > 0").groupBy("node", "n").agg(F.min("doc_id").alias("least"))
    shared = table.filter("kind = 1").groupBy(F.col("set").alias("node")).agg(F.collect_set("number").alias("tokens"))
    able = nodes.join(shared, "node").filter((F.size("tokens") >= needed("n")) & (F.col("n") > 2))
    able = written(able.select("node", "n", "tokens"), "ngram-able")

    # the sets of one doc_id are one node
    several = documents.filter("n > 0").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z").select("doc_id", "a")
    given = written(documents.filter("n > 0").join(several, "doc_id").select("a", F.col("node").alias("b")).filter("a < b").distinct(), "ngram-given")
    labels = link_components(able, given, frequent)
    discard(able)

    named = written(nodes.join(labels, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component")), "ngram-named")
    roots = named.groupBy("component").agg(F.min("least").alias("component_id"))
    found = documents.join(named.join(roots, "component").select("node", "component_id"), "node", "left")
    if several.isEmpty():
        found = found.withColumn("of_id", F.col("component_id"))
    else:  # rows of one doc_id without words belong to its other rows
        by_id = found.groupBy("doc_id").agg(F.min("component_id").alias("of_id"))
        found = found.join(by_id, "doc_id")
    found = found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("of_id", "doc_id").alias("component_id"))
    lost = known.filter("doc_id is null")
    if lost.isEmpty():
        return found
    counted = lost.select(F.lit(0).cast("long").alias("doc_id"), "text").mapInPandas(_counted, "n_shingles long")
    return found.union(counted.select(F.lit(None).cast("long"), "n_shingles", F.lit(None).cast("long")))


def _counted(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in pdfs:
        doc, _ = shingles(filled(pdf["text"]))
        yield pd.DataFrame({"n_shingles": np.bincount(doc, minlength=len(pdf))})


def op8_ngram_join(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


#: Shingles compared as texts, all pairs of documents with one in common, and the closure of their links.
OP8_SQL = r"""
with recursive split as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
shingled as (
  select distinct doc_id, array_to_string(words[i:i + 4], ' ') as shingle
  from (select doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) as i from split where len(words) > 0)),
sizes as (select doc_id, cast(count(*) as bigint) as n from shingled group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as same from shingled a join shingled b using (shingle) where a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as (
  select p.a, p.b from pairs p join sizes s on s.doc_id = p.a join sizes t on t.doc_id = p.b where 100 * same >= 75 * (s.n + t.n - same)),
reached(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reached r join links l on l.a = r.b)
select d.doc_id, coalesce(s.n, 0) as n_shingles, min(r.b) as component_id
from documents d left join reached r on r.a = d.doc_id left join sizes s on s.doc_id = d.doc_id group by d.doc_id, s.n
"""
