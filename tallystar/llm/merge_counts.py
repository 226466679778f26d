"""Token counts by byte-pair merging with a heap and a linked list (operator 5).

A piece of text starts as one symbol per byte. The heap gives the adjacent pair with the lowest
rank, leftmost first; the pair becomes one symbol, and the list of neighbours gives the two new
pairs. The count is the number of bytes minus the number of merges; no ids are made. A piece of n
bytes takes n log n steps, however long it is. Counts of short pieces are remembered by a worker,
CACHED at most.

Texts are cut into pieces by the vocabulary's pattern. An added token inside a text is one token
by itself, as is the library's default.

A null text counts as empty: no bytes, no tokens. Repeated rows and null ids are counted like any
other; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.tables import id_type, ship, texts
from tallystar.llm.text import chunks

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Pieces whose counts a worker remembers, and the most characters of such a piece.
CACHED, CACHED_LENGTH = 1 << 19, 40


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    signs = {b: chr(b) for b in shown}
    signs |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in signs)}
    return [signs[b] for b in range(256)]


class MergeCounter(dict):
    """Counts the tokens of texts; as a dict, from pieces to their counts."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        ids = model["model"]["vocab"]
        self.byte = [ids[s] for s in byte_signs()]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[ids[a] << 20 | ids[b]] = rank
            self.made.append(ids[a + b])
        added = sorted((t["content"] for t in model["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall

    def merged(self, piece: str) -> int:
        """Symbols left of a piece after all merges."""
        symbol = [self.byte[b] for b in piece.encode("utf-8", "replace")]
        n = left = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        rank = self.rank.get
        heap = []
        for i in range(n - 1):
            r = rank(symbol[i] << 20 | symbol[i + 1])
            if r is not None:
                heap.append(r << 40 | i)
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            r, i = entry >> 40, entry & ((1 << 40) - 1)
            j = after[i]
            # Entries of symbols that have changed since are passed over.
            if symbol[i] < 0 or j >= n or rank(symbol[i] << 20 | symbol[j]) != r:
                continue
            symbol[i], symbol[j] = self.made[r], -1
            after[i] = k = after[j]
            before[k] = i
            left -= 1
            if k < n and (s := rank(symbol[i] << 20 | symbol[k])) is not None:
                heapq.heappush(heap, s << 40 | i)
            h = before[i]
            if h >= 0 and (s := rank(symbol[h] << 20 | symbol[i])) is not None:
                heapq.heappush(heap, s << 40 | h)
        return left

    def __missing__(self, piece: str) -> int:
        count = self.merged(piece)
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = count
        return count

    def count(self, text: str) -> int:
        if self.added is None:
            return sum(map(self.__getitem__, self.pieces(text)))
        parts = self.added.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(p))) for p in parts)


_counters: dict[str, MergeCounter] = {}


def counter(path: str = VOCABULARY) -> MergeCounter:
    """The counter of a vocabulary file, read once in a worker."""
    if path not in _counters:
        _counters[path] = MergeCounter(path)
    return _counters[path]


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch, texts_ in chunks(batches):
            tokens = np.fromiter(
                (count(x.as_py()) for x in batch.column("text")), np.int64, batch.num_rows
            )
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array(texts_.sizes, pa.int64()),
                    "n_tokens": tokens,
                }
            )

    return run


def token_counts(
    docs: DataFrame,
    limit: int = 1024,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each document."""
    ship(docs.sparkSession)
    kind = id_type(docs, id_col).simpleString()
    return (
        texts(docs, id_col, text_col)
        .mapInArrow(_counted(vocabulary), f"doc_id {kind}, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
