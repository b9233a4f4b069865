"""Removal of long byte strings that stand more than once, by suffix arrays of shards.

A string of ``length`` bytes belongs to the anchor that its own content names: of its first places, the one whose sixteen bytes have
the least hash. Equal strings thus have equal anchors, and the bytes from the anchor on that every string of it holds, hashed, are its
key. Neighbouring strings of one anchor make a segment of the text. Only segments whose key stands in two places or more can hold a
repeated string; equal ones are one with a weight, and keys deal them to shards of about a megabyte. Every shard is sorted
into a suffix array (Larsson-Sadakane refinement: ranks of the first h bytes order the first 2h, and only suffixes that still
share their rank are sorted again) up to the length of a string, so that strings of one rank are equal, and the segments of a key that fills
several shards are compared shard by shard, each one's sorted strings looked up in the others' by binary search. Nothing is decided by a hash
alone but which texts, and which segments, are equal (128 bits).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.encoding import slices
from lawtrace.llm.storage import Scratch, dropped, new_path

GRAM = 16  # bytes whose hash places an anchor
SHARD = 1 << 19  # bytes of segments in a shard, about
INDEX = 21  # bits of a place in a shard and of a rank: three of them, 63, are one sort key
BUFFER = 1 << 19  # bytes scanned for anchors at once
_TABLE = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64, False) | np.uint64(1)
_MIX, _PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64((1 << 24) - 1)


def _span(length: int) -> int:
    """Places at the head of a string among which its anchor is; the key's bytes are the ``length`` less these, plus one."""
    return max(1, length * 16 // 25)


def _anchor_places(raw: np.ndarray, length: int) -> np.ndarray:
    """For every start of a string in ``raw`` the place of its anchor."""
    span = _span(length)
    h, size = _TABLE[raw], 1
    while 2 * size <= min(GRAM, length - span + 1):
        h = h[:-size] * np.uint64(int(_MIX) * (2 * size + 1) % (1 << 64)) + h[size:]
        h ^= h >> np.uint64(29)
        size *= 2
    h *= _MIX
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the first place
    done = 1
    while 2 * done <= span:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < span:
        least = np.minimum(least[: len(least) - (span - done)], least[span - done :])
    return (least[: len(raw) - length + 1] & _PLACE).astype(np.int64)


def segments(raw: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of texts end to end in ``raw``, text i from ``bounds[i]`` to ``bounds[i + 1]``: text, first string, number of strings and
    anchor of each segment, by buffers of the bytes."""
    for at in range(0, len(raw), BUFFER):
        part = raw[at : at + BUFFER + length - 1]
        if len(part) < length:
            return
        anchor = _anchor_places(part, length)
        first = np.maximum(bounds[:-1] - at, 0)
        count = np.maximum(np.minimum(bounds[1:] - length - at + 1, min(BUFFER, len(anchor))) - first, 0)
        total = np.cumsum(count)
        text = np.repeat(np.arange(len(count)), count)
        p = np.arange(total[-1] if len(total) else 0) + np.repeat(first - (total - count), count)
        if not len(p):
            continue
        own = anchor[p]
        new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (text[1:] != text[:-1]))))
        yield text[new], p[new] + at, np.diff(np.append(new, len(p))), own[new] + at


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``data`` (bytes, fewer than 2 ** 21) in order; the end of the data is below every byte."""
    return ranked(data, len(data) + 1)[0]


def ranked(data: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """``suffix_array`` of the first ``most`` bytes of every suffix, and the rank of each suffix: equal where those bytes are, so that
    sorting ends with them. The last step looks no further ahead than is left."""
    n, bits = len(data), np.uint64(INDEX)
    h = min(5, most)
    if n >> INDEX:
        raise ValueError(f"{n} bytes do not fit the sort key of a suffix array")
    digits = np.zeros(n + 5, np.uint64)
    digits[:n] = data.astype(np.uint64) + np.uint64(1)
    head = digits[:n]
    for k in range(1, h):
        head = head * np.uint64(257) + digits[k : n + k]
    packed = np.sort((head << bits) | np.arange(n, dtype=np.uint64))
    sa = (packed & np.uint64((1 << INDEX) - 1)).astype(np.int64)
    head = packed >> bits
    rank = np.zeros(n + 1, np.int64)  # one more than the first slot of the suffix's group; 0 beyond the end
    begins = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1]))) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, n))
    rank[sa] = np.repeat(begins, sizes) + 1
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(slots) and h < most:
        who, ahead = sa[slots], min(h, most - h)
        old, nxt = rank[who], rank[np.minimum(who + ahead, n)]
        packed = np.sort((old.astype(np.uint64) << np.uint64(2 * INDEX)) | (nxt.astype(np.uint64) << bits) | who.astype(np.uint64))
        who, group = (packed & np.uint64((1 << INDEX) - 1)).astype(np.int64), packed >> bits
        sa[slots] = who  # groups keep their slots, so the k-th of what is sorted goes to the k-th open slot
        begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.append(begins, len(who)))
        rank[who] = np.repeat(slots[begins], sizes) + 1
        slots = slots[np.repeat(sizes > 1, sizes)]
        h += ahead
    return sa, rank[:n]


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int, lane: int = 128) -> np.ndarray:
    """For each slot of the suffix array the bytes it shares with the slot before, up to ``most``: Kasai's walk through the text,
    in which a prefix shrinks by one byte at most, taken in step by many lanes of ``lane`` places each."""
    n = len(data)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    words = np.ndarray((n + most + 8,), np.dtype("<u8"), np.concatenate((data, np.zeros(most + 16, np.uint8))), strides=(1,))
    slot = np.empty(n, np.int64)
    slot[sa] = np.arange(n)
    before = np.where(slot > 0, sa[slot - 1], -1)
    starts = np.arange(0, n, lane)
    h = np.zeros(len(starts), np.int64)
    for step in range(lane):
        i = starts[: np.searchsorted(starts, n - step)] + step
        h = np.maximum(h[: len(i)] - 1, 0)
        j = before[i]
        h[j < 0] = 0
        room = np.minimum(n - np.maximum(i, j), most)
        live = np.flatnonzero((j >= 0) & (h < room))
        while len(live):
            at = h[live]
            x = words[i[live] + at] ^ words[j[live] + at]
            same = x == 0
            low = (x & (~x + np.uint64(1))).astype(np.float64)
            grown = at + np.where(same, 8, (np.frexp(low)[1] - 1) // 8)
            h[live] = np.minimum(grown, room[live])
            live = live[same & (grown < room[live])]
        lcp[slot[i]] = h
    return lcp


class Shard:
    """Segments end to end with their suffix array; ``total`` is, for each set of equal strings, the weight of its places."""

    def __init__(self, texts: list[bytes], weights: np.ndarray, length: int):
        self.length = length
        sizes = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sa, rank = ranked(self.data, length)
        run = np.cumsum(np.diff(rank[sa], prepend=-1) != 0) - 1
        inside = np.arange(len(self.data)) - np.repeat(self.begin, sizes)
        starts = inside <= np.repeat(sizes, sizes) - length  # strings that lie in their segment
        sorted_starts = starts[sa]
        self.places, self.run = sa[sorted_starts], run[sorted_starts]  # strings in order, and their sets
        self.total = np.bincount(self.run, np.repeat(weights, sizes)[self.places].astype(float), run[-1] + 1 if len(run) else 0)
        self.first = self.places[np.concatenate(([True], self.run[1:] != self.run[:-1]))] if len(self.places) else self.places

    def repeated(self, also: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Segment, first strings and numbers of strings in a row that stand twice or more, or whose sets are in ``also``."""
        hit = self.total[self.run] > 1 if also is None else np.isin(self.run, also)
        p = np.sort(self.places[hit])
        segment = np.searchsorted(self.begin, p, side="right") - 1
        new = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1] + 1) | (segment[1:] != segment[:-1])))) if len(p) else np.zeros(0, np.int64)
        owner, at, n = segment[new], p[new] - self.begin[segment[new]], np.diff(np.append(new, len(p)))
        cuts = np.flatnonzero(np.diff(owner)) + 1
        for group in np.split(np.arange(len(new)), cuts) if len(new) else []:
            yield int(owner[group[0]]), at[group], n[group]

    def sets(self) -> np.ndarray:
        return np.unique(self.run)

    def in_order(self, mine: np.ndarray, other: "Shard", theirs: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the string at ``mine`` stands to the other shard's at ``theirs``, eight bytes at a time."""
        out, live = np.zeros(len(mine), np.int64), np.arange(len(mine))
        for at in range(0, self.length, 8):
            a = np.zeros(len(live), np.uint64)
            b = np.zeros(len(live), np.uint64)
            for k in range(at, min(at + 8, self.length)):
                a = (a << np.uint64(8)) | self.data[mine[live] + k]
                b = (b << np.uint64(8)) | other.data[theirs[live] + k]
            out[live] = (a > b).astype(np.int64) - (a < b)
            live = live[a == b]
            if not len(live):
                break
        return out

    def shared(self, other: "Shard") -> tuple[np.ndarray, np.ndarray]:
        """Sets of equal strings that both shards hold, as numbered here and there: binary search of all of ours in theirs."""
        low, high = np.zeros(len(self.first), np.int64), np.full(len(self.first), len(other.first), np.int64)
        found = np.full(len(self.first), -1, np.int64)
        live = np.arange(len(self.first)) if len(other.first) else np.zeros(0, np.int64)
        while len(live):
            mid = (low[live] + high[live]) // 2
            order = self.in_order(self.first[live], other, other.first[mid])
            found[live[order == 0]] = mid[order == 0]
            low[live[order > 0]] = mid[order > 0] + 1
            high[live[order < 0]] = mid[order < 0]
            live = live[(order != 0) & (low[live] < high[live])]
        return self.sets()[found >= 0], other.sets()[found[found >= 0]]


HITS = "key long, h1 long, h2 long, at array<int>, n array<int>"


def _by_key(key: np.ndarray, sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows in groups of whole keys of at most ``most`` bytes, one key at least: equal strings have one key, so groups share none."""
    order = np.argsort(key, kind="stable")
    begins = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
    out, held = [[]], 0
    for rows in np.split(order, begins[1:]):
        need = int(sizes[rows].sum())
        if held and held + need > most:
            out.append([])
            held = 0
        out[-1].append(rows)
        held += need
    return [np.concatenate(rows) for rows in out]


def _shard_hits(table: pa.Table, length: int) -> pa.Table:
    """Repeated strings of one shard, or those that the two shards of a pair share."""
    key, h1, h2, weight, side = (table.column(c).to_numpy() for c in ("key", "h1", "h2", "weight", "side"))
    texts = table.column("seg").to_pylist()
    of = [np.flatnonzero(side == s) for s in (0, 1)]
    if len(of[1]):
        shards = [Shard([texts[i] for i in w], weight[w], length) for w in of]
        found = [list(s.repeated(also)) for s, also in zip(shards, shards[0].shared(shards[1]))]
    else:
        of = _by_key(key, np.array([len(t) for t in texts]), 1 << (INDEX - 1))
        found = [list(Shard([texts[i] for i in w], weight[w], length).repeated()) for w in of]
    rows = [(int(key[w[s]]), int(h1[w[s]]), int(h2[w[s]]), at, n) for w, part in zip(of, found) for s, at, n in part]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, types)], [c.split(" ")[0] for c in HITS.split(", ")])


def repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False, shard: int = SHARD) -> DataFrame:
    """``(doc_id, n_bytes, spans array<struct<start, end>>, kept_sha256)`` of every row, and ``kept`` (binary) if ``with_kept``.

    ``spans`` are the maximal runs of bytes that some string of ``length`` bytes covers which starts at another place too, in this text or
    another; what is left, put together, is ``kept``. Strings are judged on the whole input, as UTF-8 bytes, and none reaches over the end
    of a text. Null texts are empty; texts shorter than ``length`` keep everything; a text that stands in two rows or more, whatever
    their ids, goes wholly if it is long enough; rows with null or equal ids are judged as any other. An empty table has no rows.

    Equal texts are one row of a bucketed table, which every later step reads by key without another shuffle of texts. Segments of about
    ``shard`` bytes share a task; those of one key that need more are dealt over several shards, which meet in pairs.
    """
    spark = docs.sparkSession
    early, middle, own, lasting = (Scratch(spark) for _ in range(4))  # what is dropped first, next, last and never
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("text_key"), text.alias("text"))
    path, name = new_path(spark, "texts"), f"lawtrace_{uuid.uuid4().hex}"
    once = keyed.groupBy("text_key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    once.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "text_key").option("path", path).format("parquet").saveAsTable(name)
    texts = spark.table(name)
    context = length - _span(length) + 1

    def found(batches):
        for batch in batches:
            at = 0
            for part in slices(batch.column(1), size=BUFFER):
                if isinstance(part, pa.ChunkedArray):
                    part = part.combine_chunks()
                keys = batch.column(0).slice(at, len(part))
                at += len(part)
                bounds = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1].astype(np.int64)
                raw = np.frombuffer(part.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
                for own_text, first, count, anchor in segments(raw, bounds - bounds[0], length):
                    held = memoryview(raw)
                    hashes = np.fromiter((xxhash.xxh3_64_intdigest(held[a : a + context]) for a in anchor.tolist()), np.uint64, len(anchor)).view(np.int64)
                    start = first - (bounds[own_text] - bounds[0])
                    yield pa.RecordBatch.from_arrays([pa.array(hashes), keys.take(pa.array(own_text)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))], ["key", "text_key", "start", "n"])

    places = early.written(texts.select("text_key", "text").mapInArrow(found, "key long, text_key binary, start int, n int"), "places")
    # stored, so that both sides of the join are plain and adaptive execution can split a hot key
    twice = early.written(places.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key"), "twice")
    wanted = places.join(twice.hint("merge"), "key").groupBy("text_key").agg(F.collect_list(F.struct("key", "start", "n")).alias("places"))

    def cut(batches):
        for batch in batches:
            out, seen = [], set()
            for text_key, raw, copies, where in zip(*(batch.column(i) for i in range(4))):
                held = memoryview(raw.as_buffer())
                text_key, weight = text_key.as_py(), min(copies.as_py(), 2)
                for p in where.as_py():
                    seg = held[p["start"] : p["start"] + p["n"] + length - 1]
                    h = xxhash.xxh3_128_intdigest(seg)
                    name = (p["key"], h)
                    out.append((p["key"], (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63), text_key, p["start"], weight, None if name in seen else bytes(seg)))
                    seen.add(name)
                    if len(out) >= 20_000:
                        yield _members(out)
                        out, seen = [], set()
            if out:
                yield _members(out)

    near = texts.select("text_key", "text", "copies").join(wanted.hint("merge"), "text_key").select("text_key", "text", "copies", "places")
    members = own.written(near.mapInArrow(cut, "key long, h1 long, h2 long, text_key binary, start int, weight int, seg binary"), "members")
    early.drop()
    one = middle.written(members.groupBy("key", "h1", "h2").agg(F.first("seg", ignorenulls=True).alias("seg"), F.sum("weight").alias("weight")), "segments")
    total = one.agg(F.coalesce(F.sum(F.length("seg")), F.lit(0)).alias("n")).first()["n"]
    large = one.groupBy("key").agg(F.sum(F.length("seg")).alias("bytes")).where(f"bytes > {shard}").selectExpr("key", f"cast(ceil(bytes / {shard}D) as int) as parts")
    placed = one.join(large, "key", "left").selectExpr("*", "coalesce(pmod(h1, parts), 0L) as own")
    shards = placed.withColumn("other", F.explode(F.expr("if(parts is null, array(0L), sequence(0L, parts - 1L))")))
    # a shard of several keys has a number, a pair of shards of one key the key and both places
    group = ["shard", "low", "high"]
    dealt = shards.selectExpr("key", "h1", "h2", "seg", "weight", f"if(parts is null, pmod(xxhash64(key), {-(-total // shard) or 1}L), key) as shard", "if(parts is null, -1L, least(own, other)) as low", "greatest(own, other) as high", "cast(own > other as int) as side")
    hits = own.written(dealt.groupBy(*group).applyInArrow(lambda t: _shard_hits(t, length), HITS), "hits")
    middle.drop()
    spans = members.select("key", "h1", "h2", "text_key", "start").join(hits.hint("merge"), ["key", "h1", "h2"]).groupBy("text_key").agg(F.collect_list(F.struct("start", "at", "n")).alias("runs"))

    def judged(batches):
        for batch in batches:
            rows = []
            for text_key, raw, copies, runs in zip(*(batch.column(i) for i in range(4))):
                held = memoryview(raw.as_buffer()) if len(raw.as_buffer()) else memoryview(b"")
                if copies.as_py() > 1 and len(held) >= length:
                    found = [(0, len(held))]
                else:
                    covered = sorted((r["start"] + a, r["start"] + a + n + length - 1) for r in runs.as_py() or [] for a, n in zip(r["at"], r["n"]))
                    found = []
                    for a, b in covered:
                        if found and a <= found[-1][1]:
                            found[-1] = (found[-1][0], max(b, found[-1][1]))
                        else:
                            found.append((a, b))
                left = b"".join(bytes(held[a:b]) for a, b in zip([0, *[b for _, b in found]], [*[a for a, _ in found], len(held)]))
                rows.append((text_key.as_py(), len(held), [{"start": a, "end": b} for a, b in found], hashlib.sha256(left).hexdigest(), left if with_kept else None))
            kinds = (pa.binary(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)], ["text_key", "n_bytes", "spans", "kept_sha256", "kept"])

    whole = texts.select("text_key", "text", "copies").join(spans.hint("merge"), "text_key", "left").select("text_key", "text", "copies", "runs")
    result = lasting.written(whole.mapInArrow(judged, "text_key binary, n_bytes long, spans array<struct<start: long, end: long>>, kept_sha256 string, kept binary"), "kept")
    spark.sql(f"drop table {name}")
    dropped(spark, path)
    own.drop()
    columns = ["doc_id", "n_bytes", "spans", "kept_sha256", *(["kept"] if with_kept else [])]
    return keyed.select("doc_id", "text_key").join(result.hint("merge"), "text_key").select(*columns)


def _members(rows: list) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["key", "h1", "h2", "text_key", "start", "weight", "seg"])
