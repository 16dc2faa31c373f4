"""Counters, their text form, and rows of the structured log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label_text(labels: dict[str, Column]) -> Column:
    """Labels in name order as name="value" pairs; names in lower case, nulls left out."""
    pairs = [F.concat(F.lit(f'{k.lower()}="'), v.cast("string"), F.lit('"')) for k, v in sorted(labels.items(), key=lambda x: x[0].lower())]
    return F.concat_ws(",", *pairs)


def totals(events: DataFrame, labels: dict[str, Column]) -> DataFrame:
    """(metric, labels, value): counters only go up, so negative amounts are dropped."""
    rows = events.filter("amount >= 0").select("metric", label_text(labels).alias("labels"), "amount")
    return rows.groupBy("metric", "labels").agg(F.sum("amount").alias("value"))


def exposition(counters: DataFrame) -> DataFrame:
    return counters.select(F.concat("metric", F.lit("{"), "labels", F.lit("} "), F.col("value").cast("string")).alias("line"))


def read_value(lines: DataFrame, prefix: str) -> DataFrame:
    """The value of the one line that starts with a prefix; 0 when none or several do."""
    found = lines.filter(F.col("line").startswith(prefix)).agg(F.count("*").alias("n"), F.max(F.element_at(F.split("line", " "), -1).cast("long")).alias("v"))
    return found.select(F.when(F.col("n") == 1, F.col("v")).otherwise(0).cast("long").alias("value"))


def buckets(value: Column, edges: list[int]) -> Column:
    """The first edge that is not below the value; null beyond the last."""
    out = F.when(F.lit(False), F.lit(None).cast("long"))
    for edge in sorted(edges):
        out = out.when(value <= edge, F.lit(edge).cast("long"))
    return out


def unrepeated(log: DataFrame, by: list[str], order: list[str], message: str) -> DataFrame:
    """Log rows whose message differs from the one before."""
    before = F.lag(message).over(Window.partitionBy(*by).orderBy(*order))
    return log.withColumn("_before", before).filter(~F.col("_before").eqNullSafe(F.col(message))).drop("_before")


def log_line(text: Column, fields: dict[str, Column]) -> Column:
    """text, then `name: value` pairs after tabs; (null) and (empty) where there is nothing."""
    shown = lambda v: F.when(v.isNull(), "(null)").when(v == "", "(empty)").otherwise(v)
    return F.concat_ws("\t", text, *(F.concat(F.lit(f"{k}: "), shown(v.cast("string"))) for k, v in fields.items()))


def remediable(flag: Column) -> Column:
    return F.when(flag == 1, "Remediable").when(flag == 2, "Possibly remediable").otherwise("Nonremediable")
