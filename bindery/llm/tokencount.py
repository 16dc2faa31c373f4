"""Token counts by field or section, from one encoding of each whole document.

The document is encoded once; the byte lengths of its tokens give their character
spans, which an interval join on sorted section starts attributes to sections. A
token that crosses a boundary goes by the rule to the section of its first
character ("first"), of its last ("last"), or of most of its characters, the
earlier at a tie ("most"). The sections' counts always add up to the document's.

Defined cases: null text counts as empty; an empty text has one empty section;
characters outside all sections belong to the section before them, or the first;
empty sections get no token; repeated rows are counted each; very long texts are
encoded whole, one at a time; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .bpe import pattern, ranks, vocabulary_path
from .vectext import text_pieces

RULES = ("first", "last", "most")


class Tokenizer:
    def __init__(self, path: str, split: str) -> None:
        import tiktoken

        merges = ranks(path)
        self.encoding = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=merges, special_tokens={})
        self.size = np.zeros(max(merges.values()) + 1, dtype=np.int64)
        for token, rank in merges.items():
            self.size[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last of each token; a character cut by a boundary counts for both tokens."""
        ids = np.array(self.encoding.encode_ordinary(text), dtype=np.int64)
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        ends = np.cumsum(self.size[ids])
        if len(raw) == len(text):
            return ends - self.size[ids], ends
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        return char[ends - self.size[ids]], char[ends - 1] + 1


_tokenizers: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(path: str, split: str) -> Tokenizer:
    if (path, split) not in _tokenizers:
        _tokenizers[path, split] = Tokenizer(path, split)
    return _tokenizers[path, split]


def lines(text: str) -> np.ndarray:
    """Starts of the sections of a text: its lines, each with its line break."""
    raw = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate([[0], np.flatnonzero(raw == 10) + 1])
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(raw) else starts


def attribute(first: np.ndarray, after: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary); starts are sorted."""
    a = np.maximum(np.searchsorted(starts, first, side="right") - 1, 0)
    b = np.maximum(np.searchsorted(starts, np.maximum(after - 1, first), side="right") - 1, 0)
    if rule == "first":
        return a, a != b
    if rule == "last":
        return b, a != b
    best = a.copy()
    for i in np.flatnonzero(a != b):
        edges = np.concatenate([[first[i]], starts[a[i] + 1 : b[i] + 1], [after[i]]])
        best[i] = a[i] + int(np.argmax(np.diff(edges)))
    return best, a != b


def section_tokens(docs: DataFrame, rule: str = "first", sections=lines, path: str | None = None) -> DataFrame:
    """docs (doc_id, text) as one row per section: doc_id, section, char_start, char_end, n_tokens, n_crossing, doc_tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship(docs.sparkSession)
    path, split = path or vocabulary_path(), pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path, split)
        for part, texts in text_pieces(batches):
            held: list[list[np.ndarray]] = []
            for row, text in enumerate(texts):
                starts = sections(text)
                first, after = own.spans(text)
                to, crossing = attribute(first, after, starts, rule)
                n = len(starts)
                held.append([np.full(n, row), np.arange(n, dtype=np.int32), starts, np.append(starts[1:], len(text)), np.bincount(to, minlength=n), np.bincount(to[crossing], minlength=n), np.full(n, len(to))])
            rows, section, *counts = (np.concatenate(x) for x in zip(*held))
            ids = part.column("doc_id").take(pa.array(rows))  # never through numpy: a null beside it would make it a float
            yield pa.RecordBatch.from_arrays([ids, pa.array(section, pa.int32()), *(pa.array(c, pa.int64()) for c in counts)], names=["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, section int, char_start long, char_end long, n_tokens long, n_crossing long, doc_tokens long")


def op9_token_counts(docs: DataFrame) -> DataFrame:
    return section_tokens(docs)
