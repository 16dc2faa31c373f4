"""A Merkle manifest of a dataset: a tree of digests per source, and one over the sources' roots.

Every row becomes a leaf, a SHA-256 over its fields with their sizes. The leaves of
a tree get their places by a sort over ranges of (tree, order), with one running
number per range, so that no tree has to fit a task. Aligned blocks of FANOUT^HEIGHT
leaves then go to numpy: contiguous matrices of 64-byte hex digests, whose rows of
FANOUT are hashed level by level, and siblings found by index arithmetic. The tops of
the blocks are the leaves of the next, smaller round, until each tree has one block;
the paths come back down the same way, block by block.

Defined cases: a null field is `-` in its leaf; null sources form one tree, the
first; rows without doc_id come first in their tree, rows that share one go by their
leaves, and equal rows each have their place; a document without doc_id is not
tampered with; a lone leaf is its tree's root, and the root of a lone source is the
whole root; very long texts are hashed whole, on the JVM; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .common import discard, written

FANOUT = 3
#: Levels that one block takes: 243 leaves, a matrix of 15 KB.
HEIGHT = 5
BLOCK = FANOUT**HEIGHT
#: Rows of some 2 KB that are broadcast at most; more are joined by a shuffle.
MOST_BROADCAST = 10_000


def joined_hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """The digest of a row: of each value `-` if null, else its bytes, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return joined_hash(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """A table of rows (tree and others) with place, from 0 in the order within its tree, and size, the tree's rows."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order).withColumn("at", F.monotonically_increasing_id())
    ordered = written(ordered.withColumn("part", F.shiftright("at", 33)), "merkle-ordered")
    # one row for each tree in each range: the trees and the ranges together
    runs = ordered.groupBy("tree", "part").agg(F.min("at").alias("begin"), F.count("*").alias("n"))
    of_tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = written(runs.select("tree", "part", (before - F.col("begin")).alias("shift"), F.sum("n").over(of_tree).alias("size")), "merkle-runs")
    few = F.broadcast(runs) if runs.count() <= MOST_BROADCAST else runs
    nodes = written(ordered.join(few, ["tree", "part"]).withColumn("place", F.col("at") + F.col("shift")).drop("at", "part", "shift"), "merkle-nodes")
    for done in (ordered, runs):
        discard(done)
    return nodes


def raised(leaves: np.ndarray, height: int | None) -> list[np.ndarray]:
    """The levels over leaves (n x 64 bytes): `height` of them, or as many as lead to one node."""
    levels = [leaves]
    while len(levels[-1]) > 1 if height is None else len(levels) <= height:
        below = levels[-1]
        full = len(below) // FANOUT
        runs = [*np.ascontiguousarray(below[: full * FANOUT]).reshape(full, FANOUT * 64), *([below[full * FANOUT :].ravel()] if len(below) % FANOUT else [])]
        digests = "".join([hashlib.sha256(r.tobytes()).hexdigest() for r in runs])
        levels.append(np.frombuffer(digests.encode(), dtype=np.uint8).reshape(-1, 64))
    return levels


def siblings(levels: list[np.ndarray]) -> tuple[list[list[int]], list[list[str]]]:
    """For each leaf, level by level: how many siblings stand left of its node, and all of them from left to right."""
    places = np.arange(len(levels[0]))
    lefts, beside = [], []
    for height, nodes in enumerate(levels[:-1]):
        at = places // FANOUT**height
        place = at % FANOUT
        others = np.arange(FANOUT - 1)
        spots = (at - place)[:, None] + others + (others >= place[:, None])
        exists = spots < len(nodes)
        digests = nodes[np.minimum(spots, len(nodes) - 1)]
        lefts.append(place)
        beside.append([d[e].tobytes().decode() for d, e in zip(digests, exists)])
    return [list(map(int, x)) for x in zip(*lefts)] or [[] for _ in places], [list(x) for x in zip(*beside)] or [[] for _ in places]


def _matrix(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows in order of place, and their digests as a matrix."""
    table = table.sort_by("place")
    return table, np.frombuffer("".join(table["digest"].to_pylist()).encode(), dtype=np.uint8).reshape(-1, 64)


def _tops(key: tuple, table: pa.Table) -> pa.Table:
    table, leaves = _matrix(table)
    tree, block = (k.as_py() for k in key)
    n = table["size"][0].as_py()
    top = raised(leaves, HEIGHT)[-1].tobytes().decode()
    return pa.table({"tree": [tree], "place": pa.array([block], pa.int64()), "size": pa.array([-(-n // BLOCK)], pa.int64()), "digest": [top]})


def _paths(names: list[str]):
    def run(key: tuple, table: pa.Table, above: pa.Table) -> pa.Table:
        table, leaves = _matrix(table)
        levels = raised(leaves, HEIGHT if above.num_rows else None)
        lefts, beside = siblings(levels)
        if above.num_rows:
            more_lefts, more_beside = above["lefts"][0].as_py(), above["beside"][0].as_py()
            lefts, beside = [x + more_lefts for x in lefts], [x + more_beside for x in beside]
            top = above["top"][0].as_py()
        else:
            top = levels[-1].tobytes().decode()
        made = {"lefts": pa.array(lefts, pa.list_(pa.int32())), "beside": pa.array(beside, pa.list_(pa.string())), "top": pa.array([top] * len(table))}
        return pa.table({c: table[c] for c in names} | made)

    return run


PATH = [T.StructField("lefts", T.ArrayType(T.IntegerType())), T.StructField("beside", T.ArrayType(T.StringType())), T.StructField("top", T.StringType())]


def paths(nodes: DataFrame) -> DataFrame:
    """nodes (tree, place, size, digest and others) with the path of each to its tree's root: lefts and beside level by level, and the root as top.

    nodes is read twice, so it should be a table.
    """
    ship(nodes.sparkSession)
    block = F.floor(F.col("place") / BLOCK)
    above_schema = T.StructType([T.StructField("tree", T.StringType()), T.StructField("place", T.LongType()), *PATH])
    large = nodes.filter(F.col("size") > BLOCK)
    if large.isEmpty():
        above = nodes.sparkSession.createDataFrame([], above_schema)
    else:
        blocks = large.select("tree", "place", "size", "digest").groupBy("tree", block.alias("block"))
        tops = written(blocks.applyInArrow(_tops, "tree string, place long, size long, digest string"), "merkle-tops")
        above = paths(tops).select("tree", "place", "lefts", "beside", "top")
    schema = T.StructType([*nodes.schema.fields, *PATH])
    return nodes.groupBy("tree", block).cogroup(above.groupBy("tree", "place")).applyInArrow(_paths(nodes.columns), schema)


def folded(digest: Column, lefts: Column, beside: Column) -> Column:
    """The root that a leaf and its siblings give."""
    step = lambda h, x: joined_hash(F.substring(x["beside"], F.lit(1), 64 * x["lefts"]), h, F.substring(x["beside"], 64 * x["lefts"] + 1, F.lit(64 * FANOUT)))
    return F.aggregate(F.arrays_zip(lefts.alias("lefts"), beside.alias("beside")), digest, step)


def manifest(leaves: DataFrame) -> DataFrame:
    """leaves (source, doc_id, digest and others) with subroot, root, lefts and beside: the path from leaf to root.

    Trees are named by source with a mark before it, so that null sorts first.
    """
    named = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    named = written(named, "merkle-leaves")
    nodes = placed(named, ["doc_id", "digest"])
    discard(named)
    rows = paths(nodes)
    # the roots once more, one row for each source, from the path of its first leaf
    roots = written(paths(nodes.select("tree", "place", "size", "digest")).filter("place = 0").select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("top").alias("digest")), "merkle-roots")
    top = paths(placed(roots, ["of"])).select("of", F.col("lefts").alias("up_lefts"), F.col("beside").alias("up_beside"), F.col("top").alias("root"))
    top = written(top, "merkle-top")
    few = F.broadcast(top) if top.count() <= MOST_BROADCAST else top
    discard(roots)
    joined = rows.join(few, F.col("tree") == F.col("of"))
    path = F.concat("lefts", "up_lefts").alias("lefts"), F.concat("beside", "up_beside").alias("beside")
    return joined.select(*leaves.columns, F.col("top").alias("subroot"), "root", *path)


def op11_merkle(docs: DataFrame) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(chosen, leaf(*fields, F.replace("text", F.lit("\n"), F.lit(""))))
    leaves = docs.select("doc_id", "source", leaf(*fields, F.col("text")).alias("digest"), tampered.alias("tampered"))
    done = manifest(leaves).withColumn("folded_root", folded(F.coalesce("tampered", "digest"), F.col("lefts"), F.col("beside")))
    proof = F.sha2(F.array_join("beside", "").cast("binary"), 256).alias("proof_sha256")
    return done.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: CRC-32 of the bytes of an ASCII string, by its polynomial, bit by bit.
CRC = "xor(4294967295::bigint, list_reduce(list_transform(string_split({0}, ''), lambda x: ascii(x)::bigint), lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda a, z: xor(a >> 1, (a & 1) * 3988292384::bigint), xor(c, b)), 4294967295::bigint))"

OP11_SQL = r"""
with recursive given as (
  select doc_id, coalesce('=' || source, '') as tree, concat(
      coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
      coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-')) as head,
    text, case when doc_id is null then 1 else {crc} % 2 end as odd
  from documents),
hashed as (
  select doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when odd = 0 then sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) end as tampered
  from given),
leaves as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by tree) as size from hashed),
nodes(tree, height, place, size, digest) as (
  select tree, 0, place, size, leaf from leaves
  union all
  select tree, any_value(height) + 1, place // 3, any_value(size + 2) // 3, sha256(string_agg(digest, '' order by place)) from nodes where size > 1 group by tree, place // 3),
sources as (select tree, digest, row_number() over (order by tree) - 1 as place, count(*) over () as size from nodes where size = 1),
upper_nodes(height, place, size, digest) as (
  select 0, place, size, digest from sources
  union all
  select any_value(height) + 1, place // 3, any_value(size + 2) // 3, sha256(string_agg(digest, '' order by place)) from upper_nodes where size > 1 group by place // 3),
every as (
  select tree, height, place, size, digest from nodes where size > 1
  union all
  select s.tree, b.size + u.height, u.place, u.size, u.digest
  from upper_nodes u cross join sources s join (select tree, max(height) as size from nodes group by tree) b on b.tree = s.tree where u.size > 1),
climb as (
  select l.doc_id, l.tree, l.place as leaf_place, b.top, h.height, case when h.height < b.top then l.place // cast(power(3, h.height) as bigint) else s.place // cast(power(3, h.height - b.top) as bigint) end as at
  from leaves l join (select tree, max(height) as top from nodes group by tree) b on b.tree = l.tree join sources s on s.tree = l.tree
  join (select distinct tree, height from every) h on h.tree = l.tree),
beside as (
  select c.tree, c.leaf_place, c.height, coalesce(string_agg(e.digest, '' order by e.place) filter (where e.place < c.at), '') as before, coalesce(string_agg(e.digest, '' order by e.place) filter (where e.place > c.at), '') as after
  from climb c join every e on e.tree = c.tree and e.height = c.height and e.place // 3 = c.at // 3 group by c.tree, c.leaf_place, c.height),
fold(tree, leaf_place, height, digest) as (
  select tree, place, 0, coalesce(tampered, leaf) from leaves
  union all
  select f.tree, f.leaf_place, f.height + 1, sha256(b.before || f.digest || b.after) from fold f join beside b on b.tree = f.tree and b.leaf_place = f.leaf_place and b.height = f.height),
proofs as (select tree, leaf_place, sha256(string_agg(before || after, '' order by height)) as proof from beside group by tree, leaf_place)
select l.doc_id, l.leaf, s.digest as subroot, r.digest as root, coalesce(p.proof, sha256('')) as proof_sha256, f.digest as folded_root, f.digest = r.digest as verified
from leaves l join sources s on s.tree = l.tree cross join (select digest from upper_nodes where size = 1) r
join (select tree, leaf_place, max_by(digest, height) as digest from fold group by tree, leaf_place) f on f.tree = l.tree and f.leaf_place = l.place
left join proofs p on p.tree = l.tree and p.leaf_place = l.place
""".replace("{crc}", CRC.format("cast(doc_id as varchar)"))
