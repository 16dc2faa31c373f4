"""I-Match document fingerprints, in DataFrame operations only.

Terms whose relative document frequency lies in a band (which bounds their
inverse document frequency at both ends) form the lexicon. A document keeps its
distinct lexicon terms, sorted, and hashes several random subsets of them. The
lexicon is dealt at random into 64 subsets, so that each holds only a few terms of
a document, and an edit leaves those of its hashes untouched whose terms it does
not touch. The fingerprint joins these hashes. The likeness of two documents is the
share of equal hashes among the subsets of which at least one of them has terms.

The band's lower end bounds the lexicon: at most (mean distinct terms per
document) / min_df terms can be that frequent, however many documents there are.
Its size is still counted before it is broadcast; a larger one is joined by a
shuffle.

Defined cases: null text counts as empty; a document with fewer than min_terms
lexicon terms hashes its whole text in each subset instead, so that equal texts
still agree and different ones don't; very long texts are taken whole; terms are
sorted by their hashes, which tells them apart but for a chance of 2^-63 a pair; rows that repeat a doc_id are kept, ordered by text; rows
without doc_id come before all others, and the last document's next is the first
that has one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Lexicon subsets, a power of two.
SUBSETS = 64


def term_ids(text: Column) -> Column:
    """Distinct terms (runs of letters and digits, lower case) as non-negative 63-bit hashes."""
    terms = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.array_distinct(F.transform(terms, lambda t: F.shiftrightunsigned(F.xxhash64(t), 1)))


def lexicon(docs: DataFrame, n_docs: int, min_df: float = 0.005, max_df: float = 0.2) -> DataFrame:
    """term: the terms with min_df <= df / n_docs <= max_df."""
    counted = docs.select(F.explode(term_ids(F.col("text"))).alias("term")).groupBy("term").count()
    return counted.filter((F.col("count") >= min_df * n_docs) & (F.col("count") <= max_df * n_docs)).select("term")


def subset_hashes(terms: Column, whole: Column, min_terms: int = 3) -> Column:
    """32 bits of hash for each lexicon subset, null for one without terms. A few bits of a term's hash give its subset.

    Terms are dealt to groups of subsets first and then to the subsets of each
    group, so that each is looked at twice times the square root of SUBSETS, not SUBSETS times.
    """
    fine = 1 << (SUBSETS.bit_length() - 1) // 2

    def mine(t: Column) -> Column:
        return F.shiftright(t, 3).bitwiseAND(F.lit(SUBSETS - 1))

    def group(g: Column) -> Column:
        return F.filter(terms, lambda t: F.shiftright(mine(t), fine.bit_length() - 1) == g)

    def subset(own: Column, k: Column) -> Column:
        own = F.filter(own, lambda t: mine(t) == k)
        return F.when(F.size(own) > 0, F.xxhash64(k, own).bitwiseAND(F.lit(0xFFFFFFFF)))

    every = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    groups = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS // fine - 1)), group)
    # each group is the argument of a lambda, so that it is computed once and not for each of its subsets
    dealt = F.flatten(F.transform(groups, lambda own, g: F.transform(F.sequence(g * fine, g * fine + (fine - 1)), lambda k: subset(own, k))))
    return F.when(F.size(terms) >= min_terms, dealt).otherwise(F.transform(every, lambda k: F.xxhash64(k, whole).bitwiseAND(F.lit(0xFFFFFFFF))))


def printed(hashes: Column) -> Column:
    """Eight hexadecimal digits for each subset, eight dashes for one without terms."""
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lpad(F.lower(F.hex(h)), 8, "0"), F.lit("-" * 8))), "")


def likeness(a: Column, b: Column) -> Column:
    """Null where one side is null."""
    both = F.arrays_zip(a.alias("a"), b.alias("b"))
    same = F.size(F.filter(both, lambda x: x["a"] == x["b"]))
    some = F.size(F.filter(both, lambda x: x["a"].isNotNull() | x["b"].isNotNull()))
    return F.when(a.isNotNull() & b.isNotNull(), same / some.cast("double"))


#: Ranges of doc_id at each of two levels, a power of two: bounds what a plan holds in literals and what is broadcast, 16 MB.
RANGES_LOG = 10


def _found(cuts: Column, value: Column, levels: int) -> Column:
    """How many of 2^levels - 1 ascending cuts are at most value, by halving; 0 for null."""

    def further(at: Column, level: Column) -> Column:
        ahead = at + F.call_function("shiftleft", F.lit(1), level)
        return F.when(value >= F.get(cuts, ahead - 1), ahead).otherwise(at)

    return F.aggregate(F.sequence(F.lit(levels - 1), F.lit(0)), F.lit(0), further) if levels else F.lit(0)


def _quantiles(levels: int) -> list[float]:
    return [i / (1 << levels) for i in range(1, 1 << levels)]


def slices(docs: DataFrame, n_docs: int, rows_each: int = 500) -> DataFrame:
    """docs with imatch_slice, a range of doc_id, and a copy of each slice's first document in the slice before it.

    So every document stands beside the next one without a global sort. Ranges
    are quantiles at two levels: at most 1,023 cuts stand in the plan, and the
    ranges between them are cut again by a table of one row a range, at most 1,024
    rows of 1,023 numbers, which is broadcast. That makes up to a million slices, of
    100 MB each at 100 TB.
    imatch_ghost marks the copies; the first slice's goes to the last slice.
    """
    levels = max(0, min(2 * RANGES_LOG, (n_docs // rows_each).bit_length() - 1))
    upper, lower = min(levels, RANGES_LOG), max(0, levels - RANGES_LOG)
    cuts, least = docs.agg(F.percentile_approx("doc_id", _quantiles(upper), 20 << upper), F.min("doc_id")).first() if upper else (None, None)
    value, fine = F.coalesce("doc_id", F.lit(least).cast("long")), 1 << lower  # rows without doc_id stand beside the first that has one
    ranged = docs.withColumn("imatch_range", _found(F.lit(cuts or []), value, upper if cuts else 0))
    ids = ranged.select("imatch_range", "doc_id")
    inner = ids.groupBy("imatch_range").agg((F.percentile_approx("doc_id", _quantiles(lower), 20 << lower) if lower else F.array().cast("array<bigint>")).alias("imatch_cuts"))
    inner = written(inner, "imatch-cuts", rows=1 << upper)
    placed = ranged.join(F.broadcast(inner), "imatch_range").withColumn("imatch_slice", F.col("imatch_range") * fine + _found(F.col("imatch_cuts"), value, lower))
    firsts = placed.groupBy("imatch_range", "imatch_slice").agg(F.min("doc_id").alias("first"))
    firsts = firsts.groupBy("imatch_range").agg(F.array_sort(F.collect_list(F.struct("imatch_slice", "first"))).alias("imatch_firsts"))
    # one row a range, at most 1,024: the last slice of the range before, for the very first range the last one of all
    every = Window.orderBy("imatch_range")
    last = F.element_at("imatch_firsts", -1)["imatch_slice"]
    around = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.withColumn("imatch_before", F.coalesce(F.lag(last).over(every), F.max(last).over(around)))
    firsts = written(firsts, "imatch-firsts", rows=1 << upper)
    at = F.array_position(F.transform("imatch_firsts", lambda f: f["imatch_slice"]), F.col("imatch_slice")).cast("int")
    first = F.get(F.col("imatch_firsts"), F.col("imatch_at") - 1)["first"]
    back = F.when(first == F.col("doc_id"), F.coalesce(F.get(F.col("imatch_firsts"), F.col("imatch_at") - 2)["imatch_slice"], F.col("imatch_before")))
    placed = placed.join(F.broadcast(firsts), "imatch_range").withColumn("imatch_at", at).withColumn("imatch_back", back)
    homes = F.array_compact(F.array(F.struct(F.col("imatch_slice").alias("s"), F.lit(False).alias("g")), F.when(F.col("imatch_back").isNotNull(), F.struct(F.col("imatch_back").alias("s"), F.lit(True).alias("g")))))
    return placed.select(*docs.columns, F.explode(homes).alias("imatch_home")).select(*docs.columns, F.col("imatch_home.s").alias("imatch_slice"), F.col("imatch_home.g").alias("imatch_ghost"))


def neighbour_fingerprints(docs: DataFrame, most_broadcast: int = 400_000) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness to each other and to the next document's.

    The texts are shuffled once, to slices of neighbouring doc_id; exploding,
    the lexicon's lookup, regrouping and the second neighbour lookup all stay
    in the partitioning of that shuffle.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n_docs = docs.count()
    lex = written(lexicon(docs, max(n_docs, 1)), "imatch-lexicon")
    lex_size = lex.count()

    beside = Window.partitionBy("imatch_slice").orderBy("imatch_ghost", "doc_id", "text")
    placed = slices(docs, n_docs).repartition("imatch_slice")
    placed = placed.select("imatch_slice", "imatch_ghost", "doc_id", "text", F.row_number().over(beside).alias("at"), F.lead("text").over(beside).alias("next_text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    placed = placed.withColumn("edited", edited)
    coded = F.concat(F.array(F.lit(-1).cast("long")), F.transform(term_ids(F.col("text")), lambda t: F.shiftleft(t, 1)), F.transform(term_ids(F.col("edited")), lambda t: F.shiftleft(t, 1) + 1))
    meta = placed.select(
        "imatch_slice", "imatch_ghost", "doc_id", "at", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.xxhash64("text").alias("whole"), F.xxhash64("edited").alias("edited_whole"), coded.alias("codes"),
    )
    # a select of its own: what stands beside an explode is computed again for every row that it makes
    rows = meta.select(*(c for c in meta.columns if c != "codes"), F.explode("codes").alias("code"))
    rows = rows.withColumn("term", F.when(F.col("code") == -1, F.lit(-1).cast("long")).otherwise(F.shiftrightunsigned("code", 1)))
    # every document has the term -1 once; where terms are shuffled, those rows stay out of it
    if lex_size <= most_broadcast:
        found = rows.join(F.broadcast(lex.union(lex.sparkSession.range(1).select(F.lit(-1).cast("long").alias("term")))), "term")
    else:
        found = rows.filter("term <> -1").join(lex, "term").unionByName(rows.filter("term = -1"))
    once, of = F.col("code") == -1, lambda part: F.sort_array(F.collect_set(F.when((F.col("code") != -1) & (F.col("code").bitwiseAND(F.lit(1)) == part), F.col("term"))))
    grouped = found.groupBy("imatch_slice", "at").agg(
        *(F.max(F.when(once, F.col(c))).alias(c) for c in ("imatch_ghost", "doc_id", "n_chars", "edited_sha256", "whole", "edited_whole")), of(0).alias("terms"), of(1).alias("edited_terms"),
    )
    hashed = grouped.select("imatch_slice", "at", "imatch_ghost", "doc_id", "n_chars", "edited_sha256", subset_hashes(F.col("terms"), F.col("whole")).alias("own"), subset_hashes(F.col("edited_terms"), F.col("edited_whole")).alias("changed"))
    ahead = hashed.withColumn("next", F.lead("own").over(Window.partitionBy("imatch_slice").orderBy("at")))
    return ahead.filter(~F.col("imatch_ghost")).select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("own")).alias("fingerprint"), printed(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), F.coalesce(likeness(F.col("own"), F.col("next")), F.lit(1.0)).alias("near_next"),
    )


def op3_imatch(docs: DataFrame) -> DataFrame:
    return neighbour_fingerprints(docs)
