"""Mixing sources to target weights, in DataFrame operations only.

Every source gets a target in words; its documents are repeated at the rate
target / size. A document is emitted floor(rate) times, plus once more with the
probability of the fraction, which a hash of seed and doc_id decides, so that
reruns and retried tasks agree.

Defined cases: null text counts no words; null sources form one source, which
comes last; repeated rows are documents of their own that share a decision;
sources without words get the target 0 and none of their documents are taken;
an empty table gives an empty result; very long texts count all their words;
sources that stop at the same share are taken in order of their names; other
columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

WEIGHTS = (3, 1, 2)
#: Sources whose targets are broadcast; beyond this they are joined by a shuffle.
MOST_BROADCAST = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, ratio: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: mix_source, source_size, target.

    sizes has mix_source and size. Shares go by weight; a source stops at cap
    times its size and the excess is shared among the others. With sources in
    the order of the share at which each stops, the common share per unit of
    weight is the largest of (words still to give) / (weight still open).

    The windows run over one row per source, after aggregation, not over
    documents: their input is as small as the list of sources, at most a few
    million rows of some forty bytes for any list of sources that people keep.
    """
    by_source = sizes.groupBy("mix_source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("mix_source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1)
    weighed = by_source.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    stops = (F.col("most") / F.col("weight"), F.col("mix_source").asc_nulls_last())
    upto = Window.orderBy(*stops).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.orderBy(*stops).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = (F.lit(float(ratio)) * F.sum("source_size").over(every) - (F.sum("most").over(upto) - F.col("most"))) / F.sum("weight").over(onward)
    shared = weighed.withColumn("share", share)
    return shared.select("mix_source", "source_size", F.least("most", F.col("weight") * F.max("share").over(every)).alias("target"))


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:key); any SQL engine can repeat it."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def with_copies(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, ratio: float = 1.5, cap: float = 2.0) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_copies.

    Two scans of the input instead of a shuffle of its texts: the first sums
    words by source, map-side first, so that a hot source costs no more than
    another; the second counts again and looks its source up.
    """
    sized = docs.withColumn("mix_size", word_count(F.col("text")))
    targets = written(source_targets(sized.select(F.col("source").alias("mix_source"), F.col("mix_size").alias("size")), weights, ratio, cap), "mixing-targets")
    few = F.broadcast(targets) if targets.count() <= MOST_BROADCAST else targets
    joined = sized.join(few, sized["source"].eqNullSafe(targets["mix_source"]), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (uniform(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return joined.select(*(sized[c] for c in sized.columns), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), (F.floor(rate) + extra).alias("mix_copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, in the columns of docs."""
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("mix_row"))
    taken = with_copies(rows, **options).filter(F.col("mix_copies") > 0)
    return taken.select("mix_row", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select("mix_row.*")


def op10_mixing(docs: DataFrame) -> DataFrame:
    taken = with_copies(docs.select("doc_id", "source", "text"))
    return taken.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


OP10_SQL = r"""
with sized as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from documents),
by_source as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
weighed as (
  select source, source_size, source_size * 2.0::double as most,
    ([3.0::double, 1.0::double, 2.0::double])[1 + (row_number() over (order by source asc nulls last) - 1) % 3] as weight from by_source),
shares as (
  select *, (1.5::double * cast(sum(source_size) over () as bigint)
      - (sum(most) over (order by most / weight, source asc nulls last rows between unbounded preceding and current row) - most))
    / sum(weight) over (order by most / weight, source asc nulls last rows between current row and unbounded following) as share
  from weighed),
targets as (select source, source_size, least(most, weight * max(share) over ()) as target from shares),
rated as (
  select doc_id, size, source_size, target, case when source_size > 0 then target / source_size else 0.0::double end as rate,
    cast(('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 13)) as bigint) / 4503599627370496.0::double as u
  from sized join targets on sized.source is not distinct from targets.source)
select doc_id, size, source_size, target,
  cast(size * (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end) as bigint) as taken from rated
"""
