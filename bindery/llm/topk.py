"""Exact top-k search by inner product: three phases with a uniform threshold.

A vector's components are dealt over `lists` equal blocks, so that a score is the
sum of as many partial scores. Vectors are packed into chunks of bounded size.
Queries are packed into blocks, which are broadcast to the chunks as many at a
time as MOST_BROADCAST bytes hold; nothing of their product is written.

1. Gather: each chunk gives, for each query, the k best entries of each of its
   local lists of partial scores. Only these few are then scored in full, and the
   k-th best of a query's is a safe cutoff: at least k entries reach it.
2. Collect: with the cutoff c sent back beside the queries, each chunk takes the
   entries with a partial score of c / lists or more in some list. An entry that
   misses this everywhere totals less than c. Counting c / lists for each list
   that did not give an entry bounds its total, which drops more of them.
3. Resolve: the remaining entries' totals are computed in full; those that reach
   the cutoff compete for the k places.

Defined cases: vectors that are null or hold null, NaN or infinite components
take no part, nor do rows without vec_id; shorter vectors count as padded with
zeros; rows that repeat a vec_id count once, with the smallest vector; ties go to
the smaller vec_id; very long vectors only make chunks larger; with fewer than k other vectors all are returned; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .common import written

LOWEST = -(1 << 62)
#: Queries that one product takes.
AT_ONCE = 512
#: Bytes of query vectors that are broadcast at a time.
MOST_BROADCAST = 128 << 20


def scaled(embedding: Column, factor: float = 256.0) -> Column:
    """floor(factor * x) of each component; null where any is null, NaN or infinite."""
    finite = F.forall(embedding, lambda x: F.coalesce((F.abs(x.cast("double")) < F.lit(float("inf"))) & ~F.isnan(x), F.lit(False)))
    return F.when(embedding.isNotNull() & finite, F.transform(embedding, lambda x: F.floor(F.lit(factor) * x.cast("double"))))


def packed(vectors: DataFrame, dims: int, parts: int, names: tuple[str, str, str]) -> DataFrame:
    """vectors (vec_id, v) dealt by hash into `parts` rows of (part, ids, values)."""
    part, ids, values = names
    padded = F.concat(F.col("v"), F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v")))
    dealt = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(part), F.struct("vec_id", padded.alias("v")).alias("row"))
    rows = dealt.groupBy(part).agg(F.collect_list("row").alias("rows"))
    return rows.select(part, F.col("rows.vec_id").alias(ids), F.flatten("rows.v").alias(values))


def _matrices(row, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids and vectors of some of the row's queries, and of its chunk."""
    q_ids, c_ids = np.asarray(row.q_ids, dtype=np.int64), np.asarray(row.c_ids, dtype=np.int64)
    q, c = (np.asarray(x, dtype=np.int64).reshape(-1, dims) for x in (row.q_values, row.c_values))
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(dims, 1) < 2.0**53:
        q, c = q.astype(np.float64), c.astype(np.float64)  # exact, and faster than integer products
    for i in range(0, len(q_ids), AT_ONCE):
        yield q_ids[i : i + AT_ONCE], q[i : i + AT_ONCE], c_ids, c


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best entries, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    sorted_query = query[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_query, sorted_query, side="left")
    return order[rank < k]


def _partials(q: np.ndarray, c: np.ndarray, lists: int) -> Iterator[np.ndarray]:
    cuts = np.linspace(0, q.shape[1], lists + 1).astype(int)
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield q[:, a:b] @ c[:, a:b].T


def _totals(q: np.ndarray, c: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The full scores of single entries."""
    score = np.empty(len(at), dtype=np.int64)
    for i in range(0, len(at), 65536):
        score[i : i + 65536] = np.einsum("ij,ij->i", q[at[i : i + 65536]], c[to[i : i + 65536]])
    return score


def gather(k: int, lists: int, dims: int):
    def local(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for row in pdf.itertuples(index=False):
                for q_ids, q, c_ids, c in _matrices(row, dims):
                    own = q_ids[:, None] == c_ids[None, :]
                    near = np.zeros(own.shape, dtype=bool)
                    for p in _partials(q, c, lists):
                        top = np.argpartition(np.where(own, np.inf, -p), min(k, p.shape[1]) - 1, axis=1)[:, :k]
                        np.put_along_axis(near, top, True, axis=1)
                    at, to = np.nonzero(near & ~own)
                    score = _totals(q, c, at, to)
                    keep = _best(at, c_ids[to], score, k)
                    yield pd.DataFrame({"query_id": q_ids[at[keep]], "score": score[keep]})

    return local


def resolve(k: int, lists: int, dims: int):
    def local(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for row in pdf.itertuples(index=False):
                cuts = dict(zip(row.cut_ids, row.cut_scores))
                for q_ids, q, c_ids, c in _matrices(row, dims):
                    cut = np.array([cuts.get(x, LOWEST) for x in q_ids.tolist()], dtype=np.float64)[:, None]
                    bound, seen = np.zeros((len(q_ids), len(c_ids))), q_ids[:, None] != q_ids[:, None]
                    for p in _partials(q, c, lists):
                        given = p * lists >= cut
                        seen = seen | given
                        bound += np.where(given, p, cut / lists)
                    at, to = np.nonzero(seen & (bound >= cut - 0.5) & (q_ids[:, None] != c_ids[None, :]))
                    score = _totals(q, c, at, to)
                    reach = score >= cut[at, 0]
                    at, to, score = at[reach], to[reach], score[reach]
                    keep = _best(at, c_ids[to], score, k)
                    yield pd.DataFrame({"query_id": q_ids[at[keep]], "vec_id": c_ids[to[keep]], "score": score[keep]})

    return local


def met(asked: DataFrame, given: DataFrame, blocks: int, block_bytes: int) -> DataFrame:
    """Every chunk beside every block of queries; the blocks are broadcast, some at a time."""
    each = max(1, MOST_BROADCAST // max(1, block_bytes))
    turns = []
    for first in range(0, blocks, each):
        last = min(first + each, blocks) - 1
        some = F.broadcast(asked.filter(F.col("block").between(first, last)))
        turns.append(given.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(last)))).join(some, "block"))
    return reduce(DataFrame.union, turns)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, lists: int = 2, chunk: int = 1024, block: int = 4096) -> DataFrame:
    """The k vectors of highest inner product for each query: query_id, rank, vec_id, score.

    vectors and queries have vec_id and v (array of long); a query's own vec_id is no candidate.
    """
    ship(vectors.sparkSession)
    n, dims = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    n_queries = queries.count()
    chunks, blocks = max(1, -(-n // chunk)), max(1, -(-n_queries // block))
    tasks = max(2 * vectors.sparkSession.sparkContext.defaultParallelism, chunks // 64)
    asked = written(packed(queries, dims, blocks, ("block", "q_ids", "q_values")), "topk-queries")
    given = written(packed(vectors, dims, chunks, ("chunk", "c_ids", "c_values")).repartition(tasks, "chunk"), "topk-chunks")
    size = 8 * dims * block

    gathered = met(asked, given, blocks, size).mapInPandas(gather(k, lists, dims), "query_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    cutoffs = gathered.withColumn("place", place).filter(F.col("place") == k).select(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), "query_id", "score")
    sent = cutoffs.groupBy("block").agg(F.collect_list(F.struct("query_id", "score")).alias("cuts")).select("block", F.col("cuts.query_id").alias("cut_ids"), F.col("cuts.score").alias("cut_scores"))
    nothing = F.array().cast("array<bigint>")
    told = written(asked.join(sent, "block", "left").withColumns({c: F.coalesce(c, nothing) for c in ("cut_ids", "cut_scores")}), "topk-cutoffs")

    found = met(told, given, blocks, size + 16 * block).mapInPandas(resolve(k, lists, dims), "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk(embeddings: DataFrame) -> DataFrame:
    usable = embeddings.select("vec_id", scaled(F.col("embedding")).alias("v")).filter("vec_id is not null and v is not null")
    vectors = written(usable.groupBy("vec_id").agg(F.min("v").alias("v")), "topk-vectors")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


OP1_SQL = """
with usable as (
  select vec_id, min(list_transform(embedding, lambda x: cast(floor(256.0::double * cast(x as double)) as bigint))) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  group by vec_id),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
  from usable q, usable c where q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""
