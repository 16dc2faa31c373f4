"""Byte-level BPE encoding and decoding with recursive DuckDB queries in every partition.

A text is split by the tokenizer's pattern; each distinct match is encoded and
decoded once per partition, or again if it was not met for long; a match that decodes
to its own bytes, as all should, is remembered by its ids alone. The first COMMON_MATCHES short
ones that a worker meets stay known to its later partitions. A recursive query holds one row per token position: each step joins
neighbouring positions with the merge table and contracts the leftmost pair of
the lowest rank of each match, until no pair merges. Decoding joins the ids with
the vocabulary and aggregates the bytes in order.

A step repeats the rows of every match that still changes, so a match of n bytes
costs up to n^2 / 2 rows. Matches over LONGEST bytes are therefore merged by the
same rule with a heap, in n log n.

Defined cases: null text counts as empty and has no tokens; repeated rows are
encoded each; very long texts are encoded whole, one at a time; of pairs of equal
rank the leftmost merges first; an empty table gives an empty result; other columns
pass through encoded(), but for text and those named as its own (bpe_...), which
these replace; the query ignores them.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .vectext import with_fields

#: Bytes of the longest match that the recursive query takes.
LONGEST = 400
#: Distinct matches that an encoder remembers: when half of them are new since the last time, those not met since then go.
REMEMBERED = 480_000
#: Matches, of at most COMMON_LENGTH characters, that a worker keeps from one partition to the next: about 25 MB.
COMMON_MATCHES, COMMON_LENGTH = 100_000, 24
_common: dict[tuple[str, str], dict[str, bytes]] = {}

#: A key packs the rank of a pair and its position, below 512, so that the least key is the leftmost pair of the lowest rank.
MERGE_STEPS = """
create or replace temp table merged as
with recursive parts(word, pos, tok, step) as (
  select word, pos, tok, 0 from pieces
  union all
  select word, pos, case when pos = best % 512 then cast(best // 512 as int) else tok end, case when best is null then -1 else step + 1 end
  from (
    select *, min(key) over (partition by word) as best
    from (
      select p.word, p.pos, p.tok, p.step, p.before, cast(m.merged as bigint) * 512 + p.pos as key
      from (select *, lead(tok) over w as nxt, lag(pos) over w as before from parts where step >= 0 window w as (partition by word order by pos)) p
      left join merges m on m.l = p.tok and m.r = p.nxt))
  where best is null or before is distinct from best % 512)
select word, pos, tok from parts where step = -1
"""

DECODE = """
select e.word, list(e.tok order by e.pos) as ids, string_agg(v.digits, '' order by e.pos) as digits
from (select * from merged union all select * from whole) e join vocabulary v on v.id = e.tok group by e.word
"""


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder:
    """One per partition: the merge table in DuckDB and the matches seen so far; closed, it leaves only the common matches in the worker."""

    def __init__(self, path: str, pattern: str) -> None:
        import duckdb
        import regex

        self.ranks, self.split = ranks(path), regex.compile(pattern).findall
        self.common = _common.setdefault((path, pattern), {})
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.unlike: dict[str, bytes] = {}  # decoded bytes of matches that don't come back as they were
        self.spill = tempfile.mkdtemp(prefix="bpe-")
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": self.spill})
        self.single = np.array([self.ranks[bytes([x])] for x in range(256)], dtype=np.int32)
        self._load("vocabulary", {"id": np.array(list(self.ranks.values()), dtype=np.int32), "digits": [t.hex() for t in self.ranks]})
        halves = [(self.ranks[t[:i]], self.ranks[t[i:]], m) for t, m in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self._load("merges", dict(zip(("l", "r", "merged"), np.array(halves, dtype=np.int32).T)))

    def _load(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create or replace temp table {name} as select * from given")
        self.db.unregister("given")

    def close(self) -> None:
        self.db.close()
        for cache in (self.known, self.before, self.unlike, self.ranks):
            cache.clear()
        shutil.rmtree(self.spill, ignore_errors=True)

    def learn(self, matches: Iterable[str]) -> None:
        """Encode matches and decode their ids again."""
        order = list(matches)
        raw = [m.encode() for m in order]
        direct = [i for i, b in enumerate(raw) if b in self.ranks]
        long = {i: self._merged(b) for i, b in enumerate(raw) if len(b) > LONGEST and b not in self.ranks}
        self._load("whole", {
            "word": np.array(direct + [i for i, x in long.items() for _ in x], dtype=np.int32),
            "pos": np.array([0] * len(direct) + [k for x in long.values() for k in range(len(x))], dtype=np.int32),
            "tok": np.array([self.ranks[raw[i]] for i in direct] + [t for x in long.values() for t in x], dtype=np.int32),
        })
        left = np.array([i for i, b in enumerate(raw) if len(b) <= LONGEST and b not in self.ranks], dtype=np.int32)
        size = np.array([len(raw[i]) for i in left], dtype=np.int32)
        starts = np.cumsum(size) - size
        self._load("pieces", {
            "word": np.repeat(left, size), "pos": np.arange(size.sum(), dtype=np.int32) - np.repeat(starts, size).astype(np.int32),
            "tok": self.single[np.frombuffer(b"".join([raw[i] for i in left]), dtype=np.uint8)],
        })
        self.db.execute(MERGE_STEPS)
        found = self.db.sql(DECODE).to_arrow_table().combine_chunks()
        ids = found["ids"].chunk(0) if found.num_rows else None
        if ids is not None:
            flat, ends = ids.values.to_numpy().astype("<u4").tobytes(), ids.offsets.to_pylist()
            for i, a, b, digits in zip(found["word"].to_pylist(), ends[:-1], ends[1:], found["digits"].to_pylist()):
                self.known[order[i]] = flat[4 * a : 4 * b]
                if (decoded := bytes.fromhex(digits)) != raw[i]:
                    self.unlike[order[i]] = decoded
                elif len(order[i]) <= COMMON_LENGTH and len(self.common) < COMMON_MATCHES:
                    self.common[order[i]] = self.known[order[i]]

    def _merged(self, raw: bytes) -> list[int]:
        """The same rule for a long match: merge the pair of the lowest rank, the leftmost first."""
        n = len(raw)
        part, after, before = [raw[i : i + 1] for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 1, 1) for i in range(n - 1) if (r := self.ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if len(part[i]) != left or j >= n or len(part[j]) != right or not part[i]:
                continue
            part[i], part[j], after[i] = part[i] + part[j], b"", after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := self.ranks.get(part[a] + part[b])) is not None:
                    heapq.heappush(heap, (r, a, len(part[a]), len(part[b])))
        return [self.ranks[p] for p in part if p]

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """For each text its ids as little-endian unsigned 32-bit integers, and the bytes decoded from them."""
        if len(self.known) > REMEMBERED // 2:
            self.before, self.known = self.known, {}
        split = [self.split(t) for t in texts]
        new = []
        for m in set().union(*split).difference(self.known):
            if m in self.before:
                self.known[m] = self.before[m]
            elif m in self.common:
                self.known[m] = self.common[m]
            else:
                new.append(m)
        if new:
            self.learn(new)
        for matches in split:
            text = b"".join([self.unlike[m] if m in self.unlike else m.encode() for m in matches]) if self.unlike else "".join(matches).encode()
            yield b"".join([self.known[m] for m in matches]), text


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encoded(docs: DataFrame, path: str | None = None, keep_ids: bool = True, keep_text: bool = False) -> DataFrame:
    """docs without text, with bpe_n_tokens, bpe_ids_sha256, bpe_decoded_sha256, bpe_round_trip and, if kept, bpe_ids and the decoded bpe_text."""
    ship(docs.sparkSession)
    path, splits = path or vocabulary_path(), pattern()
    fields = ["bpe_n_tokens long", "bpe_ids_sha256 string", "bpe_decoded_sha256 string", "bpe_round_trip boolean"]
    if keep_ids:
        fields.append("bpe_ids array<bigint>")
    if keep_text:
        fields.append("bpe_text string")

    @contextmanager
    def opened() -> Iterator[Callable[[list[str]], Iterator[tuple]]]:
        own = Encoder(path, splits)

        def made(texts: list[str]) -> Iterator[tuple]:
            for given, (ids, text) in zip(texts, own.encode(texts)):
                row = [len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest(), given.encode() == text]
                if keep_ids:
                    row.append(np.frombuffer(ids, dtype="<u4").astype(np.int64))
                if keep_text:
                    row.append(text.decode())
                yield tuple(row)

        try:
            yield made
        finally:
            own.close()

    return with_fields(docs, ", ".join(fields), opened, keep_text=False)


def op7_bpe(docs: DataFrame) -> DataFrame:
    done = encoded(docs.select("doc_id", "text"), keep_ids=False)
    return done.select("doc_id", F.col("bpe_n_tokens").alias("n_tokens"), F.col("bpe_ids_sha256").alias("ids_sha256"), F.col("bpe_decoded_sha256").alias("decoded_sha256"))
