"""Anchors: a sample of places in byte strings that depends on near bytes only.

A window of LENGTH bytes holds LENGTH - GRAM + 1 grams of GRAM bytes. The one with
the least hash, the first of equal ones, is the window's anchor. Equal windows
have their anchors at equal offsets, so the anchors sample places as a difference
cover does, and two windows can be equal only if their anchors' grams are.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from .vectext import mixed, powers

LENGTH, GRAM = 400, 201
#: No window's anchor is further from its start; nor are neighbouring anchors of overlapping windows from each other.
WINDOW = LENGTH - GRAM + 1


class Anchors(NamedTuple):
    """Of each anchor: text number, place, first and last start of the windows that it anchors, hash of its gram, hash of all bytes of its windows."""

    doc: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    name: np.ndarray
    around: np.ndarray


class Hashes:
    """Hashes of byte ranges, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.upto = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.upto[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed(((self.upto[end] - self.upto[start]) * self.down[start]) ^ mixed((end - start).astype(np.uint64)))


def least(x: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each run of `size` values."""
    step = 1
    while 2 * step <= size:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[: step - size], x[size - step :]) if size > step else x


def anchors(raw: list[bytes]) -> Anchors:
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return Anchors(none, none, none, none, none, none)
    hashes = Hashes(data)
    n = len(data) - GRAM + 1
    value = hashes.of(np.arange(n), np.arange(GRAM, n + GRAM))
    low = least((value & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64), WINDOW)
    size = np.array([len(r) for r in raw], dtype=np.int64)
    ends = np.cumsum(size)
    crossing = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(crossing, np.maximum(ends - size, ends - LENGTH + 1), 1)
    np.add.at(crossing, ends, -1)
    start = np.flatnonzero(np.cumsum(crossing)[: len(low)] == 0)
    if not len(start):
        return Anchors(none, none, none, none, none, none)
    at = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    at, first, last = at[new], start[new], start[np.append(new[1:], len(at)) - 1]
    doc = np.searchsorted(ends, at, side="right")
    shape = mixed(((at - first) * 1024 + (last - first)).astype(np.uint64))
    around = mixed(hashes.of(first, last + LENGTH) + shape)
    begin = (ends - size)[doc]
    return Anchors(doc, at - begin, first - begin, last - begin, value[at].view(np.int64), around.view(np.int64))
