"""Look-ups of bibliographic sources, configuration layers, tags and page features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sources(items: DataFrame, collections: DataFrame, digitizers: DataFrame, names: DataFrame) -> DataFrame:
    """Items with their collection's provider, their digitizer's access profile and the source's display name."""
    joined = items.join(collections, "collection").join(digitizers, ["collection", "digitization_source"], "left")
    joined = joined.join(names, F.col("digitization_source") == F.col("name"))
    return joined.withColumn("status", F.when(F.col("access_profile").isNull(), "MissingField").otherwise("ok"))


def access_profile(items: DataFrame, digitizers: DataFrame) -> DataFrame:
    """The profile in two steps, so that an unknown pair (BadValue) differs from one without profile (MissingField)."""
    known = digitizers.withColumn("_known", F.lit(True))
    joined = items.join(known, ["collection", "digitization_source"], "left")
    return joined.withColumn("status", F.when(F.col("_known").isNull(), "BadValue").when(F.col("access_profile").isNull(), "MissingField").otherwise("ok")).drop("_known")


def overlay(layers: DataFrame, keys: list[str]) -> DataFrame:
    """Settings of layers (keys..., layer, value): for each key the highest layer that has one."""
    last = Window.partitionBy(*keys).orderBy(F.desc("layer"))
    return layers.withColumn("_at", F.row_number().over(last)).filter("_at = 1").drop("_at")


def setting(*layers: Column) -> Column:
    """A setting from its most specific layer to its least; an error where none has it."""
    return F.coalesce(*layers, F.raise_error(F.lit("no such setting")))


def has_tags(tags: Column, wanted: list[str]) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, wanted)), tags)) == 0


def inverted(df: DataFrame, key: str, values: str, name: str) -> DataFrame:
    """(value, name): the keys of each element of the lists, sorted."""
    return df.select(key, F.explode(values).alias("value")).groupBy("value").agg(F.array_sort(F.collect_set(key)).alias(name))


def page_features(pages: DataFrame, features: DataFrame, keys: list[str]) -> DataFrame:
    """Pages with their labels; NotEqualValues where a page's files disagree."""
    agreed = features.groupBy(*keys).agg(F.min("label").alias("label"), F.count_distinct("label").alias("_n"))
    joined = pages.join(agreed, keys, "left")
    return joined.select(*pages.columns, "label", F.when(F.coalesce("_n", F.lit(0)) > 1, "NotEqualValues").otherwise("ok").alias("status"))


def skipped(rule: Column, *exceptions: Column) -> Column:
    """Whether any of the volume's exception lists names the rule."""
    return F.array_contains(F.flatten(F.array(*exceptions)), rule)


def typed(volumes: DataFrame, common: dict[str, Column], own: dict[str, dict[str, Column]]) -> DataFrame:
    """volumes (pkg_type) with derived columns: those of a type's own, and what is common to all where it has none; a null type has the common ones."""
    names = dict.fromkeys([*common, *(name for columns in own.values() for name in columns)])
    chosen = {}
    for name in names:
        column = common.get(name, F.lit(None))
        for pkg_type, columns in own.items():
            if name in columns:
                column = F.when(F.col("pkg_type") == pkg_type, columns[name]).otherwise(column)
        chosen[name] = column
    return volumes.withColumns(chosen)
