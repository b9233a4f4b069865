"""Token-id files: blocks of concatenated ids with Elias-Fano document boundaries.

One row of the Parquet container is one block: whole documents in ascending id order, their ids as one fixed-width
little-endian array, and the cumulative ends of the documents in Elias-Fano form. With n ends below u the low
``l = floor(log2(u / n))`` bits of each end lie packed, and the high parts are a unary bit string with a one for the
i-th end at ``(end >> l) + i``; ``select`` finds that one by the byte counts of the string, so a boundary takes about
``2 + log2(u / n)`` bits and no table of 64-bit offsets exists. Document ids are kept in the same form after
subtraction of the block's first id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.encoding import encoder, slices

BLOCK = "partition int, block int, ids_before long, n_docs long, n_ids long, width int, first_doc long, doc_span long, docs_low binary, docs_high binary, ends_low binary, ends_high binary, ids binary, null_docs long"


#: Bytes of the high bits that one entry of the rank directory covers, and the places of the ones of every byte.
SPAN = 64
_ONES = np.argsort(~np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(bool), axis=1, kind="stable")


class EliasFano:
    """A non-decreasing sequence of integers below ``2 ** 62``; ``select`` finds values through a rank directory of one
    32-bit number for every 64 bytes, and no table of offsets is made."""

    def __init__(self, n: int, universe: int, low: bytes, high: bytes):
        self.n, self.universe, self.bits = n, universe, self.low_bits(n, universe)
        self.low, self.high = low, high
        padded = np.frombuffer(high + b"\0" * (-len(high) % SPAN), np.uint8).reshape(-1, SPAN)
        self._spans, counts = padded, np.bitwise_count(padded).sum(axis=1, dtype=np.uint32)
        self._ranks = np.cumsum(counts, dtype=np.uint32) - counts

    @staticmethod
    def low_bits(n: int, universe: int) -> int:
        return max(0, (universe // n).bit_length() - 1) if n else 0

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        """universe: more than the largest value."""
        values = np.asarray(values, np.int64)
        n, bits = len(values), cls.low_bits(len(values), universe)
        low = ((values[:, None] >> np.arange(bits, dtype=np.int64)) & 1).astype(np.uint8)
        high = np.zeros((universe >> bits) + n + 1, np.uint8)
        high[(values >> bits) + np.arange(n)] = 1
        return cls(n, universe, np.packbits(low.ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes())

    def select(self, places: np.ndarray) -> np.ndarray:
        """The values at these places: the span of each by the directory, then its byte and bit by counting ones."""
        out = np.zeros(len(places), np.int64)
        for at in range(0, len(places), 4096):
            i = np.asarray(places[at : at + 4096], np.int64)
            span = np.searchsorted(self._ranks, i, side="right") - 1
            held = np.cumsum(np.bitwise_count(self._spans[span]), axis=1, dtype=np.int64)
            left = i - self._ranks[span]
            byte = (held <= left[:, None]).sum(axis=1)
            rows = np.arange(len(i))
            left -= np.where(byte > 0, held[rows, byte - 1], 0)
            place = 8 * (SPAN * span + byte) + _ONES[self._spans[span, byte], left]
            out[at : at + 4096] = ((place - i) << self.bits) | self._low(i)
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        raw = np.frombuffer(self.low, np.uint8)
        bit = i[:, None] * self.bits + np.arange(self.bits, dtype=np.int64)
        return ((raw[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(np.int64) << np.arange(self.bits, dtype=np.int64)).sum(axis=1)

    def first_not_below(self, value: int) -> int:
        """The place of the first value that is at least ``value``, by halving with ``select``."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.select(np.array([mid]))[0] < value else (low, mid)
        return low


def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int, spaced: bool = True, width: int = 2, block_ids: int = 1 << 20, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text of ``docs`` and write blocks in ascending id order under the folder ``out``.

    One range shuffle by id; each task encodes its range in order and emits a block as soon as it holds ``block_ids``
    ids, so memory is bounded by a block and the longest text. Files come from Spark's committer: a lost executor's
    half-written file never counts. width: bytes of an id (2 holds ids below 65,536). Null and empty texts are the end
    id alone; rows with one id keep an order fixed by their text; null ids come first. An empty table writes no block.
    """
    kind, most = {2: ("<u2", 1 << 16), 4: ("<u4", 1 << 32)}[width]
    end = np.array([end_id], kind)

    def blocks(batches):
        from pyspark import TaskContext

        own, part, number = encoder(tokenizer, spaced), TaskContext.get().partitionId(), 0
        ids, ends, keys, nulls, size, earlier = [], [], [], 0, 0, 0

        def packed():
            ends_ef = EliasFano.of(np.array(ends), size + 1)
            first = keys[0] if keys else 0
            span = (keys[-1] - first + 1) if keys else 1
            docs_ef = EliasFano.of(np.array(keys, np.int64) - first, span)
            row = [part, number, earlier, len(ends), size, width, first, span, docs_ef.low, docs_ef.high, ends_ef.low, ends_ef.high, np.concatenate(ids).tobytes(), nulls]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, ARROW_BLOCK)], schema=ARROW_BLOCK)

        for batch in batches:
            owners, done = batch.column(0).to_pylist(), 0
            for texts in slices(batch.column(1)):
                for key, found in zip(owners[done:], own.encode(texts)):
                    if len(found) and int(found.max()) >= most:
                        raise ValueError(f"token id {found.max()} does not fit in {width} bytes; write with width=4")
                    size += len(found) + 1
                    ids += found.astype(kind), end
                    ends.append(size)
                    if key is None:
                        nulls += 1
                    else:
                        keys.append(key)
                    if size >= block_ids:
                        yield packed()
                        earlier, number = earlier + size, number + 1
                        ids, ends, keys, nulls, size = [], [], [], 0, 0
                done += len(texts)
        if ends:
            yield packed()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    by = ["doc_id"] if partitions is None else [partitions, "doc_id"]
    rows.repartitionByRange(*by).sortWithinPartitions("doc_id", "text").mapInArrow(blocks, BLOCK).write.option("compression", "none").parquet(out)


ARROW_BLOCK = pa.schema([
    ("partition", pa.int32()), ("block", pa.int32()), ("ids_before", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("first_doc", pa.int64()), ("doc_span", pa.int64()),
    ("docs_low", pa.binary()), ("docs_high", pa.binary()), ("ends_low", pa.binary()), ("ends_high", pa.binary()), ("ids", pa.binary()), ("null_docs", pa.int64()),
])


def partition_starts(blocks: DataFrame) -> DataFrame:
    """``(partition, base)``: ids before each partition of the writing job, from block headers alone.

    One row for each task of that job, so its size is bounded by the task count the driver already tracked.
    """
    total = blocks.groupBy("partition").agg(F.sum("n_ids").alias("n"))
    return total.selectExpr("partition", "coalesce(sum(n) over (order by partition rows between unbounded preceding and 1 preceding), 0) as base")


def _bounds(row: dict) -> tuple[EliasFano, EliasFano]:
    """The document ids and the ends of a block."""
    kept = row["n_docs"] - row["null_docs"]
    return EliasFano(kept, row["doc_span"], row["docs_low"], row["docs_high"]), EliasFano(row["n_docs"], row["n_ids"] + 1, row["ends_low"], row["ends_high"])


def _starts(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``base``, the ids before their partition. The side with a row for each task of the writing job is
    broadcast up to a million tasks, so that no block is shuffled; beyond that both sides are."""
    starts = partition_starts(blocks)
    return blocks.join(F.broadcast(starts) if starts.count() <= 1_000_000 else starts, "partition")


def read_token_files(spark, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files; bounds come from ``EliasFano.select``."""

    def documents(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                n, width = row["n_docs"], row["width"]
                docs_ef, ends_ef = _bounds(row)
                ends = ends_ef.select(np.arange(n))
                starts = np.concatenate([[0], ends[:-1]])
                keys = docs_ef.select(np.arange(docs_ef.n)) + row["first_doc"]
                ids = np.frombuffer(row["ids"], f"<u{width}").astype("<u4", copy=False)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([None] * row["null_docs"] + keys.tolist(), pa.int64()), pa.array(starts + row["base"] + row["ids_before"], pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _starts(spark.read.schema(BLOCK).parquet(folder)).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(spark, folder: str, doc_id: int) -> DataFrame:
    """``(doc_id, start, ids)`` of the documents with one id: only blocks whose id range holds it are read, the document
    is found by halving and its bounds by two calls of ``select``."""

    def found(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                docs_ef, ends_ef = _bounds(row)
                at = docs_ef.first_not_below(doc_id - row["first_doc"])
                ids = np.frombuffer(row["ids"], f"<u{row['width']}")
                out = []
                while at < docs_ef.n and docs_ef.select(np.array([at]))[0] + row["first_doc"] == doc_id:
                    place = at + row["null_docs"]
                    start, end = (ends_ef.select(np.array([place - 1]))[0] if place else 0), ends_ef.select(np.array([place]))[0]
                    out.append((doc_id, int(start) + row["base"] + row["ids_before"], ids[start:end].tolist()))
                    at += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 3, (pa.int64(), pa.int64(), pa.list_(pa.int64())))], ["doc_id", "start", "ids"])

    blocks = spark.read.schema(BLOCK).parquet(folder)
    held = _starts(blocks).where(F.expr(f"n_docs > null_docs and {doc_id} between first_doc and first_doc + doc_span - 1"))
    return held.mapInArrow(found, "doc_id long, start long, ids array<long>")
