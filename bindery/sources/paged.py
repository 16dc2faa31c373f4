"""Object-store listings that come in pages, as a Python data source whose partitions are ranges of keys.

A store gives its keys in order, a page at a time, from after a given key. One walk
over a prefix that holds most of the keys would be one task, so ranges with more than
a page are cut at the characters that follow what their keys have in common, until
there are enough of them or none holds more than a page. A store that knows how its
keys lie, as an inventory does, names keys to cut at instead. Every key lies in one
range, whatever the cuts. A page goes to Spark as one Arrow batch.
"""

from __future__ import annotations

import importlib
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, InputPartition, IsNotNull, StringStartsWith

Row = tuple[str, int]
#: function(prefix, start_after, page_size): rows in order of code points, and whether there are more.
Client = Callable[[str, str, int], tuple[list[Row], bool]]
HIGHEST = chr(0x10FFFF)


class Range(InputPartition):
    """The keys of prefix after `after`, up to and with `last` where that is given."""

    def __init__(self, prefix: str, after: str, last: str | None) -> None:
        self.prefix, self.after, self.last = prefix, after, last


def load(client: str, store: str) -> Client:
    module, _, name = client.partition(":")
    return getattr(importlib.import_module(module), name)(store)


def disjoint(prefixes: Iterable[str]) -> list[str]:
    """The prefixes without those that another one covers."""
    kept: list[str] = []
    for p in sorted(set(prefixes)):
        if not kept or not p.startswith(kept[-1]):
            kept.append(p)
    return kept


def pages(client: Client, part: Range, size: int) -> Iterator[list[Row]]:
    after, more = part.after, True
    while more:
        rows, more = client(part.prefix, after, size)
        if rows:
            after = rows[-1][0]
        elif more:
            raise ValueError(f"an empty page of {part.prefix!r} after {after!r} that says there are more")
        if part.last is not None and after >= part.last:
            rows, more = rows[: bisect_right(rows, part.last, key=lambda row: row[0])], False
        if rows:
            yield rows


def walk(client: Client, part: Range, size: int) -> Iterator[Row]:
    for rows in pages(client, part, size):
        yield from rows


def cut_at_bounds(client: Client, prefixes: list[str], most: int) -> list[Range]:
    """Ranges over the prefixes, about `most` of them, that end at keys which the client names."""
    bounds = [(p, key) for p in prefixes for key in client.bounds(p)]
    step = 1 + len(bounds) // max(1, most)
    done: list[Range] = []
    chosen = bounds[step - 1 :: step]
    for prefix in prefixes:
        after = ""
        for key in (key for p, key in chosen if p == prefix):
            done.append(Range(prefix, after, key))
            after = key
        done.append(Range(prefix, after, None))
    return done


def cut(client: Client, prefixes: list[str], size: int, most: int) -> list[Range]:
    """Ranges over the prefixes, about `most` of them; one or two requests for each, whatever it holds."""
    if hasattr(client, "bounds"):
        return cut_at_bounds(client, prefixes, most)
    done: list[Range] = []
    waiting = deque(prefixes)
    while waiting:
        prefix = waiting.popleft()
        rows, more = client(prefix, "", size)
        if not more or len(done) + len(waiting) >= most - 1:
            if rows:
                done.append(Range(prefix, "", None))
            continue
        after = ""
        children: list[str] = []
        while rows:
            key = rows[0][0]
            if children and key.startswith(children[-1]):  # goes on with the highest character, so it came after the child's end
                after = key
            elif len(done) + len(waiting) + len(children) >= most - 1:  # enough ranges: what is left is one
                done.append(Range(prefix, after, None))
                break
            elif key == prefix:  # a key that is its own prefix has no next character
                done.append(Range(prefix, after, key))
                after = key
            else:
                children.append(key[: len(prefix) + 1])
                after = children[-1] + HIGHEST
            rows, _ = client(prefix, after, 1)
        waiting.extend(children)
    return done


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.client, self.store = options["client"], options.get("store", "")
        self.size, self.ranges = int(options.get("page_size", "1000")), int(options.get("ranges", "64"))
        self.prefixes = disjoint(options.get("prefixes", "").split(","))

    def partitions(self) -> list[Range]:
        return cut(load(self.client, self.store), self.prefixes, self.size, self.ranges) or [Range(HIGHEST, "", "")]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for rows in pages(load(self.client, self.store), partition, self.size):
            keys, sizes = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(sizes, pa.int64())], names=["key", "size"])


class PushedReader(PagedReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, StringStartsWith) and f.attribute == ("key",):
                self.prefixes = [max(p, f.value, key=len) for p in self.prefixes if p.startswith(f.value) or f.value.startswith(p)]
            elif not isinstance(f, IsNotNull):  # a key is never null
                yield f


class PagedListing(DataSource):
    """spark.dataSource.register(PagedListing); spark.read.format("paged_listing").option("client", "module:function").load()

    The client is made on the driver and in each task as function(store), and called as
    client(prefix, start_after, page_size); it returns ([(key, size), ...], whether
    there are more). It may have a method bounds(prefix): keys of the prefix in order,
    with about as many keys between any two. Options: store; prefixes, comma-separated; page_size, by default
    1000; ranges, by default 64. A limit ends a walk early.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return "key string, size long"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


class PushedListing(PagedListing):
    """A PagedListing that gives filters on the beginning of the key to the store; it needs spark.sql.python.filterPushdown.enabled."""

    @classmethod
    def name(cls) -> str:
        return "pushed_listing"

    def reader(self, schema) -> PushedReader:
        return PushedReader(dict(self.options))


class Inventory:
    """A client over an inventory of a store: Parquet files of (key, size), sorted by key within row groups that do not overlap."""

    def __init__(self, store: str) -> None:
        from pyarrow import fs, parquet

        system, path = fs.FileSystem.from_uri(store)
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        self.groups: list[tuple[str, str, str, int]] = []
        for f in found:
            if f.is_file and f.base_name.endswith(".parquet"):
                about = parquet.read_metadata(f.path, filesystem=system)
                stats = [(about.row_group(i).column(0).statistics, i) for i in range(about.num_row_groups)]
                self.groups += [(s.min, s.max, f.path, i) for s, i in stats]
        self.groups.sort()
        self.highs = [high for _, high, _, _ in self.groups]
        opened = lru_cache(2)(lambda path: parquet.ParquetFile(path, filesystem=system))
        self.group = lru_cache(2)(lambda path, i: [c.combine_chunks() for c in opened(path).read_row_group(i, columns=["key", "size"]).columns])

    def bounds(self, prefix: str) -> list[str]:
        """The highest keys of the row groups that end in the prefix."""
        begin = bisect_left(self.highs, prefix)
        return self.highs[begin : bisect_left(self.highs, True, begin, key=lambda k: not k.startswith(prefix))]

    def __call__(self, prefix: str, after: str, size: int) -> tuple[list[Row], bool]:
        rows: list[Row] = []
        text = pa.StringScalar.as_py
        for g in range(max(bisect_right(self.highs, after), bisect_left(self.highs, prefix)), len(self.groups)):
            keys, sizes = self.group(*self.groups[g][2:])
            begin = max(bisect_right(keys, after, key=text), bisect_left(keys, prefix, key=text))
            end = bisect_left(keys, True, begin, key=lambda k: not text(k).startswith(prefix))
            n = min(end - begin, size - len(rows))
            rows += zip(keys.slice(begin, n).to_pylist(), sizes.slice(begin, n).to_pylist())
            if begin + n < end:
                return rows, True
            if end < len(keys):
                return rows, False
        return rows, False


def inventory(keys: DataFrame, store: str) -> str:
    """Write (key, size) as an Inventory reads it; a key that is there twice is one, with the greater size."""
    once = keys.filter(F.col("key").isNotNull()).groupBy("key").agg(F.max("size").alias("size"))
    once.repartitionByRange("key").sortWithinPartitions("key").write.option("parquet.block.size", 1 << 20).parquet(store)
    return store
