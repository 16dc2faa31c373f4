"""Listings in pages, cut into ranges of keys."""

import json
import random

import pytest

from bindery.sources import paged
from tests.paged_client import KEYS, store


def listed(client, prefixes, size, most):
    parts = paged.cut(client, paged.disjoint(prefixes), size, most)
    return [k for part in parts for k, _ in paged.walk(client, part, size)], parts


def reader(spark, source=paged.PagedListing, **options):
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(client="tests.paged_client:store", **options)


def test_every_page_of_every_prefix_is_read(spark):
    df = reader(spark, prefixes="a,b", page_size="10", ranges="8").load()
    assert sorted(r["key"] for r in df.collect()) == sorted(KEYS)
    assert 2 < df.rdd.getNumPartitions() <= 8
    assert reader(spark, prefixes="a", page_size="100").load().rdd.getNumPartitions() == 1
    assert reader(spark, prefixes="nothing").load().count() == 0


@pytest.mark.parametrize("size,most", [(1, 1), (1, 40), (2, 3), (3, 7), (10, 64), (1000, 64)])
def test_each_key_lies_in_one_range_whatever_the_cuts(tmp_path, size, most):
    rng = random.Random(size * 100 + most)
    high = chr(0x10FFFF)
    keys = {"".join(rng.choice("ab/é" + high) for _ in range(rng.randrange(1, 7))) for _ in range(300)} | {"a", "a" + high, "a" + high * 3}
    (tmp_path / "keys.json").write_text(json.dumps(sorted(keys)))
    client = store(str(tmp_path / "keys.json"))
    for prefixes in ([""], ["a", "b"], ["a", "ab", "a"], ["é", "zz"]):
        found, parts = listed(client, prefixes, size, most)
        assert sorted(found) == sorted(k for k in keys if k.startswith(tuple(prefixes)))
        assert len(parts) <= most + len(prefixes)


def test_a_hot_prefix_is_split_and_the_cuts_cost_few_requests(tmp_path):
    keys = [f"ns/{i:05d}.zip" for i in range(20000)] + ["other/1.zip"]
    (tmp_path / "keys.json").write_text(json.dumps(keys))
    client = store(str(tmp_path / "keys.json"))
    found, parts = listed(client, [""], 100, 32)
    assert sorted(found) == sorted(keys) and 16 <= len(parts) <= 32
    held = [sum(1 for _ in paged.walk(client, p, 1000)) for p in parts]
    client.calls.clear()
    paged.cut(client, [""], 100, 32)
    assert len(client.calls) < 4 * 32 and max(held) <= 10000


def test_a_page_that_is_empty_but_not_the_last_is_an_error():
    with pytest.raises(ValueError):
        list(paged.walk(lambda prefix, after, size: ([], True), paged.Range("", "", None), 5))


def test_a_filter_on_the_beginning_of_the_key_goes_to_the_store(spark, tmp_path):
    keys = [f"{n}/{i}" for n in ("x", "y") for i in range(40)]
    (tmp_path / "keys.json").write_text(json.dumps(keys))
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = reader(spark, paged.PushedListing, store=str(tmp_path / "keys.json"), page_size="5", ranges="4").load().filter("key like 'x/1%'")
        assert sorted(r["key"] for r in df.collect()) == sorted(k for k in keys if k.startswith("x/1"))
        plan = df._jdf.queryExecution().toString()
        assert "Filter " not in plan.split("== Physical Plan ==")[1]
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def test_an_inventory_gives_the_same_in_pages(spark, tmp_path):
    keys = [f"{n}.{i}" for n in ("ns1", "ns2", "é") for i in range(700)]
    rows = spark.createDataFrame([(k, len(k)) for k in [*keys, *keys[:9]]] + [(None, 1)], "key string, size long")
    where = paged.inventory(rows.repartition(6), f"file://{tmp_path}/inventory")
    found, _ = listed(paged.Inventory(where), ["ns1", "é"], 50, 16)
    assert sorted(found) == sorted(k for k in keys if not k.startswith("ns2"))


def test_an_inventory_is_cut_evenly_and_a_page_reads_only_its_groups(tmp_path):
    import pyarrow as pa
    from pyarrow import parquet

    keys = [f"ns.{'1' if i % 10 else '2'}{i:05d}" for i in range(20000)] + [f"é{i:04d}" for i in range(500)]
    keys.sort()
    (tmp_path / "inventory").mkdir()
    parquet.write_table(pa.table({"key": keys[:12000], "size": range(12000)}), tmp_path / "inventory" / "a.parquet", row_group_size=250)
    parquet.write_table(pa.table({"key": keys[12000:], "size": range(8500)}), tmp_path / "inventory" / "b.parquet", row_group_size=250)
    client = paged.Inventory(f"file://{tmp_path}/inventory")
    read, group = [], client.group
    client.group = lambda path, i: read.append((path, i)) or group(path, i)
    parts = paged.cut(client, [""], 100, 16)
    assert not read and 8 <= len(parts) <= 17
    held = [[k for k, _ in paged.walk(client, p, 100)] for p in parts]
    assert [k for part in held for k in part] == keys and max(map(len, held)) <= 2 * len(keys) / 16
    for prefixes in (["ns.1", "é"], ["ns.10000", "ns.2"], ["", "ns"], ["zz"], ["a"]):
        for size, most in ((1000, 1), (250, 5), (7, 1000)):
            found, parts = listed(client, prefixes, size, most)
            assert sorted(found) == sorted(k for k in keys if k.startswith(tuple(prefixes)))
            assert len(parts) <= most + len(prefixes)
    client.groups = Counted(client.groups)
    assert client("", keys[15000], 10) == ([(k, i) for i, k in enumerate(keys[15001:15011], 3001)], True)
    assert client.groups.asked <= 2


class Counted(list):
    """A list that counts what is taken from it one by one."""

    asked = 0

    def __iter__(self):
        for x in super().__iter__():
            self.asked += 1
            yield x

    def __getitem__(self, i):
        self.asked += 1
        return super().__getitem__(i)
