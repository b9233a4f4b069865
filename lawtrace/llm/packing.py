"""Packing of token pieces into fixed-capacity sequences: Martello-Toth dominance reduction, then best fit.

Pieces of one length are interchangeable, so the whole instance is the histogram of lengths: at most ``capacity``
numbers at any corpus size. The plan is made on that histogram and says, for each length, which sequences and places
its pieces go to; the pieces themselves are ranked and placed where they lie.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.encoding import encoder, slices
from lawtrace.llm.storage import written

PIECES = "partition int, doc_id long, piece int, start long, length long, ids_crc32 long, nth long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, spaced: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids: whole documents, and only longer ones cut into full pieces and a rest.

    Null and empty texts are the end id alone; repeated rows and rows of one id each have their own pieces. ``nth`` numbers the pieces of one length inside a task, so that ranks
    over all tasks need only one count for each task and length.
    """

    def cut(batches):
        from pyspark import TaskContext

        own, part = encoder(tokenizer, spaced), TaskContext.get().partitionId()
        end, seen = np.array([end_id], "<u4"), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            keys, done = batch.column(0).to_pylist(), 0
            for texts in slices(batch.column(1)):
                out: list[tuple] = []
                for key, ids in zip(keys[done:], own.encode(texts)):
                    for i, at in enumerate(range(0, len(ids) + 1, capacity)):
                        piece = ids[at : at + capacity]
                        n, crc = len(piece), zlib.crc32(piece)
                        if n < capacity:  # so it is the last piece, which the end id closes
                            n, crc = n + 1, zlib.crc32(end, crc)
                        out.append((part, key, i, at, n, crc, int(seen[n])))
                        seen[n] += 1
                done += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 4))], [x.split(" ")[0] for x in PIECES.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def beside(counts: dict[int, int], lengths: list[int], a: int, room: int) -> list[int] | None:
    """The pieces that go with one of length ``a`` into a bin that dominates every other bin holding it; None if no rule tells.

    Nothing fits: a alone. A piece of length ``room`` is at least any set that fits. If only one more piece fits, the
    largest fitting one is at least any other. If two but no three fit, let p >= q be the pair of largest sum and ``top`` the
    largest fitting piece: top alone is at least any pair if top >= p + q; and p with q is at least any other set if p is
    as large as top and no two pieces strictly between q and p fit together.
    """

    def free(x: int) -> int:
        return counts.get(x, 0) - (x == a)

    def smallest(of: list[int], many: int) -> list[int]:
        out: list[int] = []
        for x in of:
            if len(out) == many:
                break
            out += [x] * min(free(x), many - len(out))
        return out

    low = smallest(lengths, 3)
    if not low or low[0] > room:
        return []
    if free(room) > 0:
        return [room]
    fitting = [x for x in lengths[: bisect_right(lengths, room)] if free(x) > 0]
    top = fitting[-1]
    if len(low) < 2 or low[0] + low[1] > room:
        return [top]
    if len(low) == 3 and sum(low) <= room:
        return None
    p = q = 0
    at, end = 0, len(fitting) - 1
    while at < end:
        x, y = fitting[at], fitting[end]
        if x + y > room:
            end -= 1
        else:
            p, q = max((p + q, p, q), (x + y, y, x))[1:]
            at += 1
    twice = max((x for x in fitting if 2 * x <= room and free(x) > 1), default=0)
    if 2 * twice > p + q:
        p = q = twice
    if top >= p + q:
        return [top]
    inner = smallest(fitting[bisect_right(fitting, q) : bisect_left(fitting, p)], 2)
    return [p, q] if top == p and (len(inner) < 2 or sum(inner) > room) else None


def reduced(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins that dominate every other bin holding their largest piece; takes their pieces out of ``counts``.

    A rule of ``beside`` that holds for one piece holds for the next equal one as long as the same pieces are left, so each
    fixes as many equal bins at once as the counts allow; passes are repeated until none applies.
    Returns ``(bins, [(length, copies), ...])``.
    """
    fixed: list[tuple[int, list[tuple[int, int]]]] = []
    lengths, changed = sorted(counts), True
    while changed:
        changed = False
        for a in sorted(counts, reverse=True):
            while counts.get(a, 0) and (others := beside(counts, lengths, a, capacity - a)) is not None:
                pattern = Counter([a, *others])
                many = min(counts[x] // k for x, k in pattern.items())
                for x, k in pattern.items():
                    counts[x] -= many * k
                    if not counts[x]:
                        del counts[x], lengths[bisect_left(lengths, x)]
                fixed.append((many, sorted(pattern.items(), reverse=True)))
                changed = True
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing on counts: equal bins are one group, and equal pieces enter a group at once.

    A piece goes to the fullest bin that holds it; that bin then stays the fullest, so it takes all further equal
    pieces that fit. Each length splits at most two groups, so the groups stay below a few times ``capacity``.
    """
    by_room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    rooms: list[int] = []

    def put(room, many, pattern):
        if many:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append((many, pattern))

    for a in sorted(counts, reverse=True):
        n = counts[a]
        while n:
            at = bisect_left(rooms, a)
            if at == len(rooms):
                put(capacity, -(-n // (capacity // a)), [])
                continue
            room = rooms[at]
            many, pattern = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            each = room // a
            full = min(many, n // each)
            put(room - each * a, full, [*pattern, (a, each)])
            n -= full * each
            left = many - full
            if left and 0 < n < each:
                put(room - n * a, 1, [*pattern, (a, n)])
                n, left = 0, left - 1
            put(room, left, pattern)
    return [(many, pattern) for groups in by_room.values() for many, pattern in groups if pattern]


def plan(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Segments ``(length, first, copies, sequence, offset)`` sorted by length and first.

    The piece of that length with rank r, first <= r, goes to sequence ``sequence + (r - first) // copies`` at
    ``offset + (r - first) % copies * length``.
    """
    left = dict(counts)
    bins = reduced(left, capacity)
    bins += best_fit(left, capacity)
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for many, pattern in bins:
        offset = 0
        for length, copies in pattern:
            rows.append((length, used.get(length, 0), copies, sequence, offset))
            used[length] = used.get(length, 0) + many * copies
            offset += length * copies
        sequence += many
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "sequence", "offset"), table.T))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Place every row of ``token_pieces``: its columns with ``sequence_id`` and ``offset`` (gapless from 0).

    ``pieces`` is written once to the shared folder. Two aggregations by length (map-side combined, so a hot length
    costs one row for each task) give the histogram and each task's first rank; the plan built from the histogram has
    a size bounded by ``capacity`` and is broadcast. No shuffle moves pieces by length. An empty table packs to none; equal
    pieces, of repeated rows too, are placed one by one.
    """
    spark = pieces.sparkSession
    stored, _ = written(pieces, "pieces")
    held = stored.groupBy("partition", "length").agg(F.count("*").alias("n"))
    held, _ = written(held, "piece-counts")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments = plan(counts, capacity)
    segments["key"] = segments["length"] << 44 | segments["first"]
    shared = spark.sparkContext.broadcast(segments)
    ranks = held.selectExpr("partition", "length", "coalesce(sum(n) over (partition by length order by partition rows between unbounded preceding and 1 preceding), 0) as earlier")

    def placed(batches):
        s = shared.value
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("nth").to_numpy() + b.column("earlier").to_numpy()
            at = np.searchsorted(s["key"], length << 44 | rank, side="right") - 1
            r, copies = rank - s["first"][at], s["copies"][at]
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(s["sequence"][at] + r // copies), pa.array(s["offset"][at] + r % copies * length)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = stored.join(ranks, ["partition", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "earlier")
    return ranked.mapInArrow(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
