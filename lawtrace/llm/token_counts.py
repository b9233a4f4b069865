"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a word form a doubly linked list; a heap holds every adjacent pair that has a merge rank. The lowest
pair, leftmost on ties, is popped until none is left, and stale entries are skipped. The count is the number of first
symbols less the number of merges: no identifier is looked up or emitted.
"""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.encoding import Memo, chunked, slices

#: FIXED VALUE: the published pre-tokenization pattern of byte-level BPE files.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The printable character that a byte-level file writes for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class MergeCounter:
    """Counts the tokens of texts for a byte-level BPE file; ``memo_bytes`` bounds what is remembered and changes no result."""

    def __init__(self, path: str, memo_bytes: int = 32 << 20):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = {c: b for b, c in byte_letters().items()}
        raw = lambda s: bytes(letters[c] for c in s)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.single = [bytes([b]) for b in range(256)]
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = regex.compile(PRE_TOKENS)
        self.memo = Memo(memo_bytes)

    def merged(self, word: bytes) -> int:
        """Symbols left of one pre-token after all merges."""
        symbols = [self.single[b] for b in word]
        n = len(symbols)
        if n < 2:
            return n
        rank = self.rank
        after = [*range(1, n), -1]
        before = [-1, *range(n - 1)]
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank.get((symbols[i], symbols[i + 1]))) is not None]
        heapify(heap)
        merges = 0
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if j < 0 or symbols[i] != left or symbols[j] != right:
                continue  # one of the two has been merged since
            merges += 1
            symbols[i], symbols[j] = left + right, b""
            after[i] = k = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (r := rank.get((symbols[i], symbols[k]))) is not None:
                    heappush(heap, (r, i, symbols[i], symbols[k]))
            if (h := before[i]) >= 0 and (r := rank.get((symbols[h], symbols[i]))) is not None:
                heappush(heap, (r, h, symbols[h], symbols[i]))
        return n - merges

    def of_chunk(self, chunk: str) -> int:
        special = 0
        parts = [chunk]
        if self.special and self.special.search(chunk):
            special = len(self.special.findall(chunk))
            parts = self.special.split(chunk)
        return special + sum(self.merged(w.encode("utf-8")) for p in parts for w in self.words.findall(p))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of a string array without nulls; each distinct chunk is merged once while it is remembered."""
        out = np.zeros(len(texts), np.int64)
        for places, chunks, offsets in chunked(texts, spaced=True):
            coded = chunks.dictionary_encode()
            known = np.array(self.memo.values(coded.dictionary.to_pylist(), lambda new: [self.of_chunk(c) for c in new]), np.int64)
            sums = np.concatenate([[0], np.cumsum(known[coded.indices.to_numpy()])])
            out[places] = sums[offsets[1:]] - sums[offsets[:-1]]
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One for each worker process."""
    return MergeCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``, as the file's library counts them.

    A map over rows: no shuffle, and each task holds one Arrow batch and the remembered words. Null and empty texts
    have 0 bytes and 0 tokens; repeated rows are counted each; a null id stays null; other columns are not read.
    """

    def counted(batches):
        own = counter(path)
        for batch in batches:
            n = np.concatenate([np.zeros(0, np.int64), *(own.counts(x) for x in slices(batch.column(1)))])
            sizes = pc.fill_null(pc.cast(pc.binary_length(batch.column(1)), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
