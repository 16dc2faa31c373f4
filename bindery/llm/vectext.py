"""Words of many texts as numpy arrays: bytes in, word places and 64-bit word hashes out."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BASE, BASE_INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Words(NamedTuple):
    """start and end: byte places in data; doc: the text's number; hash: of the word's bytes; upto: running sums for more hashes."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    upto: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i below n."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for base in (BASE, BASE_INVERSE):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        _powers[size] = (both[0], both[1])
    return _powers[size]


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_ascii()
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII bytes that are not letters; bytes of other scripts count as letters.
NOT_LETTER = np.array([x < 128 and not chr(x).isalpha() for x in range(256)])


def words(texts: list[str], separator: np.ndarray = SPACE) -> Words:
    """The maximal runs of bytes that are no separators, lower-casing A-Z. Words never cross texts."""
    raw = [t.encode() for t in texts]
    data = LOWER[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    ends_of = np.cumsum(np.array([len(r) + 1 for r in raw], dtype=np.int64)) if raw else np.zeros(0, dtype=np.int64)
    apart = separator[data]
    edge = np.flatnonzero(np.diff(apart, prepend=True))
    start, end = edge[0::2], edge[1::2]
    if len(end) < len(start):
        end = np.append(end, len(data))
    up, down = powers(len(data) + 1)
    upto = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=upto[1:])
    value = (upto[end] - upto[start]) * down[start]
    return Words(data, start, end, np.searchsorted(ends_of, start, side="right"), mixed(value ^ (end - start).astype(np.uint64)), upto)


def prefix_hash(found: Words, start: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the `size` bytes from each start."""
    _, down = powers(len(found.data) + 1)
    return mixed(((found.upto[start + size] - found.upto[start]) * down[start]) ^ np.uint64(size + 1_000_003))


def pieces(texts: list[str], most: int = 1_000_000) -> Iterator[slice]:
    """Runs of texts of together about `most` characters; a longer text stands alone."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def released[Parts](run: Callable[[Iterator[Parts]], Iterator[Parts]]) -> Callable[[Iterator[Parts]], Iterator[Parts]]:
    """run, after which the worker, which lives on for other work, gives its free memory back to the system."""

    def whole(parts: Iterator[Parts]) -> Iterator[Parts]:
        try:
            yield from run(parts)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
            if trim:
                trim(0)

    return whole


def filled(column) -> list[str]:
    """A column of texts as a list, null as empty."""
    return ["" if t is None or t != t else t for t in column]


def by_size(sizes: np.ndarray, most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of sizes of together about `most`; a larger one stands alone."""
    begin = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield begin, i - begin
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes) - begin


def text_pieces(batches: Iterable[pa.RecordBatch], most: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of record batches of about `most` bytes of text, with their texts; all columns stay as Arrow has them."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        for begin, n in by_size(sizes, most):
            part = batch.slice(begin, n)
            yield part, filled(part.column("text").to_pylist())


Made = Iterator[tuple]


def with_fields(rows: DataFrame, fields: str, compute: Callable[[], contextlib.AbstractContextManager[Callable[[list[str]], Made]]], keep_text: bool = True, most: int = 1_000_000) -> DataFrame:
    """rows with more columns, computed from their text; columns of these names give way to them.

    compute opens what a partition needs and gives a function from texts to one tuple
    of values each. Python meets texts alone: every other column passes as the Arrow
    array it is, so that large whole numbers beside nulls, and nested columns, stay as they are.
    """
    new = T.StructType.fromDDL(fields)
    kinds = to_arrow_schema(new)
    kept = [f for f in rows.schema.fields if f.name not in new.names and (keep_text or f.name != "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with compute() as made:
            for part, texts in text_pieces(batches, most):
                columns = list(zip(*made(texts))) or [()] * len(kinds)
                arrays = [part.column(f.name) for f in kept] + [pa.array(x, k.type) for x, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in kept] + kinds.names)

    given = rows.select(*(F.col(f"`{c}`") for c in rows.columns if c not in new.names))
    return given.mapInArrow(released(run), T.StructType(kept + new.fields))
