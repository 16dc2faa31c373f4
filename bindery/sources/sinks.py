"""Writes as snapshot rewrites: a table is replaced by a new state of itself.

Without a table format there is no MERGE; these functions return the new state and
leave it to the caller to write it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def insert_ignore(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows that are new to table: the first of each key, by the other columns' order."""
    order = [c for c in rows.columns if c not in keys] or keys
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    fresh = rows.withColumn("_first", first).filter("_first = 1").drop("_first")
    return fresh.join(table.select(*keys), keys, "left_anti")


def duplicates(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows that a plain INSERT would refuse, their keys being in table."""
    return rows.join(table.select(*keys).distinct(), keys, "left_semi")


def upsert(table: DataFrame, rows: DataFrame, keys: list[str], assign: dict[str, Column] | None = None) -> DataFrame:
    """The state after rows were merged into table.

    A matched row takes every column that rows have, null included, as an
    assignment from the new values does; assign gives further columns of a written
    row. Unmatched rows of either side stay or come in with nulls elsewhere.
    """
    assign = assign or {}
    old = table.select(*keys, F.struct(*table.columns).alias("_old"))
    new = rows.select(*keys, F.struct(*rows.columns).alias("_new"))
    both = old.join(new, keys, "full_outer")
    written = F.col("_new").isNotNull()

    def column(c: str) -> Column:
        if c in keys:
            return F.col(c)
        before = F.col(f"_old.{c}")
        if c in assign:
            return F.when(written, assign[c]).otherwise(before).alias(c)
        return F.when(written, F.col(f"_new.{c}")).otherwise(before).alias(c) if c in rows.columns else before.alias(c)

    return both.select(*(column(c) for c in table.columns))


def replace_into(table: DataFrame, rows: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """The state after REPLACE: the row of the highest sequence wins, rows over table."""
    both = table.withColumn("_side", F.lit(0)).unionByName(rows.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_side"), F.desc(sequence)))
    return both.withColumn("_last", last).filter("_last = 1").select(*table.columns)


def delete(table: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(keys_of.select(*keys).distinct(), keys, "left_anti")


def detail_text(details: Column) -> Column:
    """A map as `key: value` pairs in key order, tab-separated."""
    entries = F.array_sort(F.map_entries(details))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\t")


def log_rows(log: DataFrame, most: int = 255) -> DataFrame:
    """Rows for the log table: detail is cut to its column's width."""
    return log.withColumn("detail", F.left("detail", F.lit(most)))


def id_file(volumes: DataFrame, path: str) -> None:
    """One namespace.id per line; refuses to overwrite."""
    volumes.select(F.concat_ws(".", "namespace", "id").alias("value")).write.mode("errorifexists").text(path)


def admin_handle(index: Column, permissions: Column, handle: Column) -> Column:
    """The binary admin record of a handle: permissions (2 bytes), name length (4), name, index (4), 2 zero bytes, big-endian."""
    def number(x: Column, digits: int) -> Column:
        return F.lpad(F.hex(x), digits, "0")

    name = F.upper(handle)
    return F.unhex(F.concat(number(permissions, 4), number(F.octet_length(name), 8), F.hex(F.encode(name, "UTF-8")), number(index, 8), F.lit("0000")))
