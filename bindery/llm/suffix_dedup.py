"""Removal of long repeated byte strings with a distributed difference-cover suffix array.

The sample of places is taken by content: the anchors of all windows of LENGTH
bytes (see anchors.py), about one in 90 bytes. Only anchors whose gram occurs
twice or more matter. Runs of them are strings over (gram, distance to the next
anchor); equal runs are kept once. Their suffixes are ranked by the difference
cover {1, 2} modulo 3: triples of names at these places are sorted and named, the
names' strings are ranked by recursion, and the remaining suffixes are merged in by
their first name and the rank of what follows. Ranks need only tell the first
LENGTH + WINDOW bytes apart, which limits the recursion's depth. Neighbours in the
order are then compared: what a suffix shares with either is the most it shares
with any. That decides the windows within runs that occur again.

What is left are windows at the edges of such runs, where the texts begin to
differ within LENGTH bytes of an anchor. They are decided exactly by halving: of the
windows at offsets lo to hi before an anchor, all occur again if the bytes that
they cover together do, and none does if the bytes that they all cover don't;
otherwise their quarters are asked, down to single windows. Strings are compared by
64-bit hashes: two different ones of n are taken for equal with a probability of
about n^2 / 2^65, 1 in 10^5 for 10^7 strings asked.

Defined cases: null text counts as empty; a text of fewer than LENGTH bytes keeps
all; very long texts are taken whole, one at a time; rows that repeat a doc_id are
documents of their own, and equal rows repeat each other; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .anchors import GRAM, LENGTH, WINDOW, Hashes, anchors
from .common import discard, written
from .vectext import by_size, mixed, released, text_pieces

#: Offsets that one check decides together, from turn to turn.
BLOCKS = (64, 16, 4, 1)
#: Bytes of text that a task hashes at once, whatever a batch holds; running sums and powers take some 60 bytes for each.
PIECE = 250_000


def in_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with `at`, which grows with the keys: the range of keys in its upper bits, the place in the range in the lower 33."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())


def named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of rows with names (from 1) in their order."""
    return written(in_order(rows.select(*keys).distinct(), keys).select(*keys, (F.col("at") + 1).alias("t")), "suffix-order")


def before(rows: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Distinct keys, with the sums of counts over all smaller keys: a sort by ranges, running sums in each, and a number per range."""
    sums = rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))
    ordered = written(in_order(sums, keys).withColumn("part", F.shiftright("at", 33).cast("int")), "suffix-order")
    totals = sorted(tuple(r) for r in ordered.groupBy("part").agg(*(F.sum(c) for c in counts)).collect())
    shift, pairs = [0] * len(counts), {c: [] for c in counts}
    for part, *n in totals:
        for i, c in enumerate(counts):
            pairs[c] += [F.lit(part), F.lit(shift[i])]
            shift[i] += n[i]
    smaller = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    running = written(ordered.select(*keys, "part", *(F.coalesce(F.sum(c).over(smaller), F.lit(0)).alias(f"before_{c}") for c in counts)), "suffix-running")
    discard(ordered)
    moved = {c: F.col(f"before_{c}") + (F.element_at(F.create_map(*pairs[c]), F.col("part")) if pairs[c] else F.lit(0)) for c in counts}
    return running.select(*keys, *(moved[c].cast("long").alias(f"before_{c}") for c in counts))


def gathered(parts: Iterator[dict[str, np.ndarray | list]], most: int = 50_000) -> Iterator[pd.DataFrame]:
    """Columns that come in small parts, as frames of about `most` rows."""
    held: list[dict] = []
    rows = 0

    def frame() -> pd.DataFrame:
        return pd.DataFrame({c: [x for p in held for x in p[c]] if isinstance(held[0][c], list) else np.concatenate([p[c] for p in held]) for c in held[0]})

    for part in parts:
        held.append(part)
        rows += len(next(iter(part.values())))
        if rows >= most:
            yield frame()
            held, rows = [], 0
    if held:
        yield frame()


def each(pdfs: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple]:
    for pdf in pdfs:
        yield from zip(*(pdf[c] for c in columns))


def _triples(every: bool):
    def parts(rows: Iterator[tuple]) -> Iterator[dict]:
        for key, names in rows:
            x = np.concatenate([names, [0, 0]]).astype(np.int64)
            i = np.arange(len(x) - 2)
            if not every:
                i = i[i % 3 != 0]
            yield {"key": np.full(len(i), key), "i": i, "a": x[i], "b": x[i + 1], "c": x[i + 2]}

    return lambda pdfs: gathered(parts(each(pdfs, "key", "names")))


def _sampled(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The recursion's strings: names of the triples at places 1, 4, ..., a zero, and those at places 2, 5, ... ."""
    for pdf in pdfs:
        names = []
        for i, t in zip(pdf["i"], pdf["t"]):
            i, t = np.asarray(i), np.asarray(t)
            names.append(np.concatenate([t[i % 3 == 1], [0], t[i % 3 == 2]]))
        yield pd.DataFrame({"key": pdf["key"], "names": names})


def _merge_keys(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every place with its kind (i mod 3), its own names a and b, and the ranks r1 and r2 of the suffixes one and two further."""

    def parts() -> Iterator[dict]:
        for key, names, ranks in each(pdfs, "key", "names", "ranks"):
            x, n = np.asarray(names, dtype=np.int64), len(names)
            rank = np.zeros(n + 3, dtype=np.int64)
            if ranks is not None and len(ranks):
                ranks = np.asarray(ranks, dtype=np.int64)
                one = len(range(1, n, 3))
                rank[1:n:3], rank[2:n:3] = ranks[:one], ranks[one + 1 :]
            i = np.arange(n)
            yield {"key": np.full(n, key), "i": i, "kind": i % 3, "a": x, "b": np.append(x[1:], 0), "r0": rank[:n], "r1": rank[1 : n + 1], "r2": rank[2 : n + 2]}

    return gathered(parts())


def suffix_ranks(strings: DataFrame, depth: int) -> DataFrame:
    """(key, ranks) of strings (key, names): 1 + the number of smaller suffixes, for every place.

    Suffixes that agree in their first 3^(depth + 1) names may share a rank. Names are positive.
    """
    triples = strings.mapInPandas(released(_triples(depth == 0)), "key long, i int, a long, b long, c long")
    order = named(triples, ["a", "b", "c"])
    coded = triples.join(order, ["a", "b", "c"]).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "t"))).alias("x"))
    coded = coded.select("key", F.col("x.i").alias("i"), F.col("x.t").alias("t"))
    if depth == 0:
        ranks = written(coded.select("key", F.col("t").alias("ranks")), "suffix-ranks")
        discard(order)
        return ranks
    sample = written(coded.mapInPandas(released(_sampled), "key long, names array<bigint>"), "suffix-sample")
    discard(order)
    ranked = suffix_ranks(sample, depth - 1)
    discard(sample)
    places = written(strings.join(ranked, "key", "left").select("key", "names", "ranks").mapInPandas(released(_merge_keys), "key long, i int, kind int, a long, b long, r0 long, r1 long, r2 long"), "suffix-places")
    discard(ranked)
    kinds = [(F.col("kind") == k).cast("long").alias(f"n{k}") for k in range(3)]
    near = before(places.filter("kind <> 2").select("a", "r1", *kinds), ["a", "r1"], ["n0", "n1"])
    far = before(places.filter("kind <> 1").select("a", "b", "r2", *kinds), ["a", "b", "r2"], ["n0", "n2"])
    near, far = near.withColumnsRenamed({"before_n0": "near_0", "before_n1": "near_1"}), far.withColumnsRenamed({"before_n0": "far_0", "before_n2": "far_2"})
    # r0 counts zeros of the sample's strings, which are smaller than all: only differences between its values matter
    sampled = before(places.filter("kind <> 0").select("r0", F.lit(1).cast("long").alias("n")), ["r0"], ["n"])
    first = places.filter("kind = 0").join(near, ["a", "r1"]).join(far, ["a", "b", "r2"]).select("key", "i", (F.col("near_0") + F.col("near_1") + F.col("far_2")).alias("less"))
    rest = places.filter("kind <> 0").join(sampled, "r0")
    second = rest.filter("kind = 1").join(near, ["a", "r1"]).select("key", "i", (F.col("before_n") + F.col("near_0")).alias("less"))
    third = rest.filter("kind = 2").join(far, ["a", "b", "r2"]).select("key", "i", (F.col("before_n") + F.col("far_0")).alias("less"))
    merged = first.union(second).union(third).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", (F.col("less") + 1).alias("r")))).alias("x"))
    result = written(merged.select("key", F.col("x.r").alias("ranks")), "suffix-ranks")
    for done in (places, near, far, sampled):
        discard(done)
    return result


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_pieces(batches, PIECE):
        found = anchors([t.encode() for t in texts])
        places = [x.astype(np.int32) for x in (found.at, found.first, found.last)]
        columns = [part.column("row").to_numpy()[found.doc], *places, found.name, found.around]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["row", "at", "first", "last", "name", "around"])


def _strings(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The runs of near anchors of each row: (row, start, key, names, sizes); the key is a hash of the names."""
    for pdf in pdfs:
        out = []
        for row, at, name in zip(pdf["row"], pdf["at"], pdf["name"]):
            at, name = np.asarray(at, dtype=np.int64), np.asarray(name, dtype=np.int64)
            first = np.flatnonzero(np.concatenate([[True], np.diff(at) > WINDOW]))
            for i, j in zip(first, np.append(first[1:], len(at))):
                sizes = np.append(np.diff(at[i:j]), GRAM)
                # the last anchor's distance is none, which no other's is
                symbol = mixed(name[i:j].view(np.uint64) + np.append(np.diff(at[i:j]), 0).astype(np.uint64))
                symbol = (symbol >> np.uint64(2)).astype(np.int64) + 1
                key = int.from_bytes(hashlib.blake2b(symbol.tobytes(), digest_size=8).digest(), "little", signed=True)
                out.append((row, int(at[i]), key, symbol, sizes))
        yield pd.DataFrame(out, columns=["row", "start", "key", "names", "sizes"])


def _ends(sizes: np.ndarray) -> np.ndarray:
    """For each place of a string, the end of the names that cover LENGTH + WINDOW bytes from it."""
    upto = np.concatenate([[0], np.cumsum(sizes)])
    return np.minimum(np.searchsorted(upto, upto[:-1] + LENGTH + WINDOW, side="left"), len(sizes))


def _reach(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The most names that LENGTH + WINDOW bytes take in each string."""
    for pdf in pdfs:
        yield pd.DataFrame({"most": [max((int((_ends(np.asarray(s)) - np.arange(len(s))).max()) for s in pdf["sizes"]), default=1)]})


def _suffixes(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every suffix with its rank and the names and sizes of its first LENGTH + WINDOW bytes, as bytes."""

    def parts() -> Iterator[dict]:
        for key, names, sizes, ranks in each(pdfs, "key", "names", "sizes", "ranks"):
            names, sizes = np.asarray(names, dtype=np.int64), np.asarray(sizes, dtype=np.int64)
            to, n = _ends(sizes), len(names)
            every, small, ends = names.tobytes(), sizes.astype(np.uint8).tobytes(), to.tolist()
            yield {"rank": np.asarray(ranks), "key": np.full(n, key), "i": np.arange(n), "prefix": [every[8 * a : 8 * b] for a, b in enumerate(ends)], "widths": [small[a:b] for a, b in enumerate(ends)]}

    return gathered(parts(), 10_000)


def shared_bytes(a: bytes, b: bytes, widths: bytes) -> int:
    """Bytes that two suffixes share by their equal first names."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    upto = ((differ & -differ).bit_length() - 1) // 64 if differ else n // 8  # the name that holds the lowest differing bit
    # an equal name means an equal gram as well, so the last one reaches GRAM bytes
    return sum(widths[: upto - 1]) + GRAM if upto else 0


def _compared(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bytes that each suffix of one range of ranks shares with a neighbour; the outermost keep their prefixes."""
    part, held, last = TaskContext.get().partitionId(), None, None
    for pdf in pdfs:
        if not len(pdf):
            continue
        prefixes, widths = pdf["prefix"].tolist(), pdf["widths"].tolist()
        left = [shared_bytes(p, q, w) for p, q, w in zip([last or b"", *prefixes[:-1]], prefixes, widths)]
        shared = np.maximum(left, left[1:] + [0])
        n, edge = len(pdf), [0] * len(pdf)
        if held is None:
            edge[0] = 1
        else:
            held["shared"][-1] = max(held["shared"][-1], left[0])
            yield _edged(held)
        held = {"key": pdf["key"].tolist(), "i": pdf["i"].tolist(), "shared": shared.tolist(), "part": [part] * n, "edge": edge, "prefix": prefixes, "widths": widths}
        last = prefixes[-1]
    if held is not None:
        held["edge"][-1] += 2
        yield _edged(held)


def _edged(columns: dict[str, list]) -> pd.DataFrame:
    """A frame that keeps prefix and widths only where edge is not 0."""
    for c in ("prefix", "widths"):
        columns[c] = [x if e else None for x, e in zip(columns[c], columns["edge"])]
    return pd.DataFrame(columns)


def neighbours(strings: DataFrame, ranks: DataFrame) -> DataFrame:
    """(key, i, shared): the most bytes that each suffix of strings (key, names, sizes) shares with another, as far as they are asked."""
    parts = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    suffixes = strings.join(ranks, "key").select("key", "names", "sizes", "ranks").mapInPandas(released(_suffixes), "rank long, key long, i int, prefix binary, widths binary")
    ordered = suffixes.repartitionByRange(parts, "rank", "key", "i").sortWithinPartitions("rank", "key", "i")
    table = written(ordered.mapInPandas(released(_compared), "key long, i int, shared long, part int, edge int, prefix binary, widths binary"), "suffix-compared")
    edges = sorted(table.filter("edge > 0").select("key", "i", "part", "edge", "prefix", "widths").collect(), key=lambda r: (r["part"], r["edge"] == 2))  # two suffixes of each range
    patches = {}
    for a, b in zip(edges[:-1], edges[1:]):
        if a["part"] != b["part"]:
            both = shared_bytes(bytes(a["prefix"]), bytes(b["prefix"]), bytes(a["widths"]))
            for r in (a, b):
                patches[r["key"], r["i"]] = max(both, patches.get((r["key"], r["i"]), 0))
    out = table.select("key", "i", "shared")
    if patches:
        fixed = table.sparkSession.createDataFrame([(k, i, n) for (k, i), n in patches.items()], "key long, i int, at_edge long")
        out = out.join(F.broadcast(fixed), ["key", "i"], "left").select("key", "i", F.greatest("shared", F.coalesce("at_edge", F.lit(0).cast("long"))).alias("shared"))
    return out


def merged(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Overlapping or touching [first, last] joined, flat."""
    if not len(first):
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > last[:-1] + 1])
    return np.stack([first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)]], axis=1).ravel()


def _decided(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Starts of windows within each string that occur again, as first, last, first, last, ... from its own start."""
    for pdf in pdfs:
        sure = []
        for sizes, shared, many in zip(pdf["sizes"], pdf["shared"], pdf["many"]):
            sizes, shared = np.asarray(sizes, dtype=np.int64), np.asarray(shared, dtype=np.int64)
            at = np.cumsum(sizes) - sizes
            shared = sizes.sum() - at if many else shared
            whole = shared >= LENGTH
            sure.append(merged(at[whole], at[whole] + shared[whole] - LENGTH))
        yield pd.DataFrame({"key": pdf["key"], "sure": sure})


def suffix_array_starts(runs: DataFrame, deepest: int = 1) -> DataFrame:
    """(row, sure): starts that the suffix array of runs (row, start, key, names, sizes) decides to occur again.

    The recursion tells 3^(depth + 1) names apart, nine at the deepest, which take
    about 900 bytes. Where anchors stand closer, as in periodic text, suffixes that
    agree in nine names come in any order, and more is left to the check.
    """
    strings = written(runs.groupBy("key").agg(F.first("names").alias("names"), F.first("sizes").alias("sizes"), (F.count("*") > 1).alias("many")), "suffix-strings")
    most = strings.select("sizes").mapInPandas(released(_reach), "most int").agg(F.max("most")).first()[0] or 1
    depth = 0
    while depth < deepest and 3 ** (depth + 1) < most:
        depth += 1
    ranks = suffix_ranks(strings.select("key", "names"), depth)
    near = neighbours(strings, ranks)
    placed = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "shared"))).alias("x"))
    placed = strings.select("key", "sizes", "many").join(placed, "key").select("key", "sizes", "many", F.col("x.shared").alias("shared"))
    sure = written(placed.mapInPandas(released(_decided), "key long, sure array<bigint>"), "suffix-sure")
    for done in (ranks, strings):
        discard(done)
    found = runs.select("row", "start", "key").join(sure, "key").select("row", F.transform("sure", lambda x: x + F.col("start")).alias("sure"))
    return found.groupBy("row").agg(F.flatten(F.collect_list("sure")).alias("sure"))


def _left_open(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The anchors of each row, and whether some of their windows are not decided yet."""

    def parts() -> Iterator[dict]:
        for row, at, first, last, name, around, sure in each(pdfs, "row", "at", "first", "last", "name", "around", "sure"):
            pairs = np.asarray(sure if sure is not None else [], dtype=np.int64).reshape(-1, 2)
            spans = merged(pairs[:, 0], pairs[:, 1]).reshape(-1, 2)
            i = np.searchsorted(spans[:, 0], first, side="right") - 1
            covered = (i >= 0) & (np.append(spans[:, 1], -1)[i] >= last)
            yield {"row": np.full(len(at), row), "at": at, "first": first, "last": last, "name": name, "around": around, "undecided": ~covered}

    return gathered(parts())


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of all windows of the chosen anchors of each text, and where the anchor is in them."""
    kinds = {"around": pa.int64(), "offset": pa.int32(), "spare": pa.int32(), "rows": pa.int64(), "bytes": pa.binary()}

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds.values())], names=list(kinds))

    out, size = [], 0
    for part, texts in text_pieces(batches, PIECE):
        for text, chosen in zip(texts, part.column("chosen").to_pylist()):
            raw = text.encode()
            for c in chosen:
                out.append((c["around"], c["at"] - c["first"], c["last"] - c["first"], c["rows"], raw[c["first"] : c["last"] + LENGTH]))
                size += len(out[-1][-1])
                if size >= PIECE:
                    yield batch(out)
                    out, size = [], 0
    if out:
        yield batch(out)


def _asked(block: int, before_block: int):
    """For each block of offsets of an open node: the hash of what all its windows cover (inner), and together (outer, if known)."""

    def asked(pdf: pd.DataFrame, size: np.ndarray) -> pd.DataFrame:
        hashes = Hashes(np.frombuffer(b"".join(pdf["bytes"]), dtype=np.uint8))
        places = [np.asarray(x, dtype=np.int64) for x in pdf["opened"]]
        of = np.repeat(np.arange(len(pdf)), [len(x) for x in places])
        low = np.concatenate(places)[:, None] + np.arange(0, before_block, block)
        of, low = np.repeat(of, low.shape[1]), low.ravel()
        offset, spare = pdf["offset"].to_numpy(dtype=np.int64)[of], pdf["spare"].to_numpy(dtype=np.int64)[of]
        high = low + block - 1
        use = (low <= offset) & (high >= offset - spare)  # windows start offset - spare to offset bytes before the anchor
        of, low, high, offset = of[use], low[use], high[use], offset[use]
        begin = np.cumsum(size) - size
        anchor, end = begin[of] + offset, (begin + size)[of]
        salt = mixed((low + 1).astype(np.uint64))
        inner = mixed(hashes.of(anchor - low, anchor - high + LENGTH) + salt)
        known = (anchor - high >= begin[of]) & (anchor - low + LENGTH <= end)
        outer = np.zeros(len(of), dtype=np.uint64)
        outer[known] = mixed(hashes.of((anchor - high)[known], (anchor - low)[known] + LENGTH) + salt[known])
        return pd.DataFrame({"around": pdf["around"].to_numpy()[of], "low": low, "rows": pdf["rows"].to_numpy()[of], "inner": inner.view(np.int64), "outer": outer.view(np.int64), "known": known})

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            size = np.array([len(t) for t in pdf["bytes"]], dtype=np.int64)
            for begin, n in by_size(size, PIECE):
                yield asked(pdf.iloc[begin : begin + n], size[begin : begin + n])

    return run


def edge_blocks(surroundings: DataFrame) -> DataFrame:
    """(around, low, high): offsets of windows before an anchor that occur again, of surroundings (around, offset, spare, rows, bytes)."""
    many = surroundings.filter("rows > 1").select("around", F.lit(0).alias("low"), F.lit(WINDOW - 1).alias("high"))
    found, opened, size = many, surroundings.select("around", F.array(F.lit(0)).alias("opened")), 256
    rows = 4 * surroundings.count()  # about as many blocks are asked at most in a turn
    for block in BLOCKS:
        nodes = surroundings.join(opened, "around").select("around", "offset", "spare", "rows", "bytes", "opened")
        asked = written(nodes.mapInPandas(released(_asked(block, size)), "around long, low int, rows long, inner long, outer long, known boolean"), "suffix-asked", rows)
        again = asked.filter("known").groupBy("outer").agg(F.sum("rows").alias("n")).filter("n > 1").select("outer", F.lit(True).alias("again"))
        told = asked.filter("known").join(again, "outer", "left").select("around", "low", "rows", "inner", F.coalesce("again", F.lit(False)).alias("again"))
        told = written(told.union(asked.filter("not known").select("around", "low", "rows", "inner", F.lit(False))), "suffix-told", rows)
        found = found.union(told.filter("again and rows = 1").select("around", "low", (F.col("low") + (block - 1)).alias("high")))
        discard(asked)
        if block > 1:
            # of equal inner bytes all go on as long as one is open, for the others' sake
            on = told.groupBy("inner").agg(F.sum("rows").alias("n"), F.bool_or((F.col("rows") == 1) & ~F.col("again")).alias("some")).filter("n > 1 and some").select("inner")
            opened = written(told.join(on, "inner").groupBy("around").agg(F.collect_list("low").alias("opened")), "suffix-opened", rows)
            size = block
    return found


def repeated_starts(texts: DataFrame) -> DataFrame:
    """(row, starts): where strings of LENGTH bytes of texts (row, text) that occur again start, as first, last, first, last, ... ."""
    table = written(texts.mapInArrow(released(_anchored), "row long, at int, first int, last int, name long, around long"), "suffix-anchors")
    often = written(table.groupBy("name").count().filter("count > 1").select("name"), "suffix-names")
    fields = ("at", "first", "last", "name", "around")
    by_row = table.join(often, "name").groupBy("row").agg(F.array_sort(F.collect_set(F.struct(*fields))).alias("x"))
    by_row = written(by_row.select("row", *(F.col(f"x.{c}").alias(c) for c in fields)), "suffix-rows")
    discard(table)
    runs = written(by_row.select("row", "at", "name").mapInPandas(released(_strings), "row long, start long, key long, names array<bigint>, sizes array<bigint>"), "suffix-runs")
    sure = written(suffix_array_starts(runs), "suffix-decided")

    left = by_row.join(sure, "row", "left").select("row", *fields, "sure")
    left = written(left.mapInPandas(released(_left_open), "row long, at int, first int, last int, name long, around long, undecided boolean"), "suffix-left")
    names = written(left.filter("undecided").select("name").distinct(), "suffix-names")
    chosen = left.join(names, "name").groupBy("around").agg(F.count("*").alias("rows"), F.min(F.struct("row", "at", "first", "last")).alias("c"))
    chosen = chosen.groupBy("c.row").agg(F.collect_list(F.struct("around", "c.at", "c.first", "c.last", "rows")).alias("chosen"))
    surroundings = texts.join(written(chosen, "suffix-chosen"), "row").select("text", "chosen").mapInArrow(released(_surroundings), "around long, offset int, spare int, rows long, bytes binary")
    blocks = written(edge_blocks(written(surroundings.dropDuplicates(["around"]), "suffix-surroundings")), "suffix-blocks")
    ends = F.greatest("first", F.col("at") - F.col("high")), F.least("last", F.col("at") - F.col("low"))
    edges = left.filter("undecided").join(blocks, "around").select("row", ends[0].cast("long").alias("a"), ends[1].cast("long").alias("b")).filter("a <= b")
    edges = edges.groupBy("row").agg(F.flatten(F.collect_list(F.array("a", "b"))).alias("sure"))
    return sure.union(edges).groupBy("row").agg(F.flatten(F.collect_list("sure")).alias("starts"))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_pieces(batches):
        out = []
        for text, starts in zip(texts, part.column("starts").to_pylist()):
            raw = text.encode()
            pairs = np.asarray(starts if starts is not None else [], dtype=np.int64).reshape(-1, 2)
            spans = merged(pairs[:, 0], pairs[:, 1] + LENGTH - 1).reshape(-1, 2)
            kept, at = [], 0
            for a, b in spans.tolist():
                kept.append(raw[at:a])
                at = b + 1
            kept = b"".join([*kept, raw[at:]])
            out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
        columns = [pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs."""
    ship(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    starts = repeated_starts(texts.select("row", "text"))
    equal = texts.groupBy("row").agg(F.count("*").alias("rows"), F.max(F.octet_length("text")).alias("size")).filter(f"rows > 1 and size >= {LENGTH}")
    whole = equal.select("row", F.array(F.lit(0).cast("long"), (F.col("size") - LENGTH).cast("long")).alias("starts"))
    known = written(starts.union(whole).groupBy("row").agg(F.flatten(F.collect_list("starts")).alias("starts")), "suffix-known")
    removed = texts.join(known, "row", "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "starts")
    return removed.mapInArrow(released(_removed), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_suffix_dedup(docs: DataFrame) -> DataFrame:
    return without_repeats(docs)
