"""The trie of conversation prefixes, by union-find over the common prefixes of sorted neighbours.

A conversation is the string of its turns' digests. Equal strings are one row with a count; the distinct strings are
range-sorted, and neighbours' longest common prefixes are edges. Inside a part, edges are taken in descending depth: each one
merges two components and thereby creates the branching node (or extends the node of that depth) that holds both. Nodes of a part
that reach over its borders, prefixes of the last string before or of the first one after, are contracted to sums, and the sums
of one node from several parts are merged. Every measure of a node is a sum, a minimum or belongs to its first part, so this is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.storage import Scratch

WIDTH = 16  # bytes of a turn's digest
IDS = 12  # ids that agree but for so many low bits are listed together before a node's list is hashed
NODE = "part int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_strings(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, turns array<struct<d string, b int>>)``: digests of a conversation's turns in order, and bytes of their texts.

    Turns go by turn number, null first, then by role and text; null roles and texts are empty. Rows without an id belong
    to no conversation. One conversation is one value, of about 40 bytes a turn.
    """
    t = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("conv_id is not null")
    digest = f"substring(sha2(concat(octet_length(role), ':', role, text), 256), 1, {2 * WIDTH})"
    placed = t.selectExpr("conv_id", "row_number() over (partition by conv_id order by turn asc nulls first, role, text) as place", f"{digest} as d", "octet_length(text) as b")
    listed = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "d", "b"))).alias("t"))
    return listed.selectExpr("conv_id", "transform(t, e -> named_struct('d', e.d, 'b', e.b)) as turns")


def distinct_strings(strings: DataFrame) -> DataFrame:
    """``(seq, sizes, n, first_id, ends)``: each string once, its conversations' count, least id and the hash of their listed ids.

    Ids of one string are listed in ranges first; then the ranges stream, in order, through the task of their string, which holds
    one range at a time however many conversations are equal.
    """
    s = strings.selectExpr("conv_id", "unhex(array_join(turns.d, '')) as seq", "turns.b as sizes").selectExpr("*", f"substring(unhex(sha2(seq, 256)), 1, {WIDTH}) as seq_key", f"shiftright(conv_id, {IDS}) as span")
    ranges = s.groupBy("seq_key", "span").agg(F.first("seq").alias("seq"), F.first("sizes").alias("sizes"), F.array_sort(F.collect_list("conv_id")).alias("ids"))
    ranges = ranges.selectExpr("seq_key", "span", "seq", "sizes", "ids[0] as first_id", "cast(size(ids) as long) as n", "array_join(cast(ids as array<string>), ',') as ids")
    dealt = ranges.repartition("seq_key").sortWithinPartitions("seq_key", "span").select("seq_key", "seq", "sizes", "n", "first_id", "ids")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None

        def out(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()))], ["seq", "sizes", "n", "first_id", "ends"])

        for batch in batches:
            done = []
            for key, seq, sizes, n, first, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if last and last[0] == key:
                    last[3] += n
                    last[5].update(b"," + ids.encode())
                    continue
                if last:
                    done.append((*last[1:5], last[5].hexdigest()))
                last = [key, seq, sizes, n, first, hashlib.sha256(ids.encode())]
            if done:
                yield out(done)
        if last:
            yield out([(*last[1:5], last[5].hexdigest())])

    return dealt.mapInArrow(folded, "seq binary, sizes array<int>, n long, first_id long, ends string")


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that both strings begin with."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    if a[: high * WIDTH] == b[: high * WIDTH]:
        return high
    while low < high - 1:
        mid = (low + high) // 2
        if a[low * WIDTH : mid * WIDTH] == b[low * WIDTH : mid * WIDTH]:
            low = mid
        else:
            high = mid
    return low


def _path_keys(seq: bytes, depth: int) -> list[bytes]:
    """Names of the prefixes of depth 0, 1, ... ``depth``."""
    h, out = hashlib.sha256(), []
    for d in range(depth + 1):
        if d:
            h.update(seq[(d - 1) * WIDTH : d * WIDTH])
        out.append(d.to_bytes(4, "big") + h.digest()[:WIDTH])
    return out


class Forest:
    """The trie of one part's sorted distinct strings. ``left`` and ``right`` are the turns that its first and last string share with
    the string before and after it in other parts, -1 where there is none: prefixes up to there are open."""

    def __init__(self, seqs: list[bytes], sizes: list, counts: list[int], ids: list[int], left: int, right: int):
        self.seqs, self.left, self.right, self.m = seqs, left, right, len(seqs)
        self.bytes = [np.concatenate(([0], np.cumsum(np.asarray(s, np.int64)))) for s in sizes]
        lcp = [common_turns(a, b) for a, b in zip(seqs, seqs[1:])]
        self.depth = [len(s) // WIDTH for s in seqs]
        self.low, self.high, self.row = list(range(self.m)), list(range(self.m)), list(range(self.m))
        self.n, self.first = list(counts), list(ids)
        self.leaves = [int(x < d) for x, d in zip([*lcp, right], self.depth)]
        self.kids, self.saved, self.up = [0] * self.m, [0] * self.m, [-1] * self.m
        owner, top = list(range(self.m)), list(range(self.m))

        def find(i: int) -> int:
            while owner[i] != i:
                owner[i] = owner[owner[i]]
                i = owner[i]
            return i

        for i in np.argsort(-np.asarray(lcp, np.int64), kind="stable").tolist():
            a, b = find(i), find(i + 1)
            node = top[a] if self.depth[top[a]] == lcp[i] else self._branch(lcp[i], top[a])
            self._attach(node, top[b])
            owner[b], top[a] = a, node
        self.root = top[find(0)]
        if self.depth[self.root]:
            self.root = self._branch(0, self.root)

    def _branch(self, depth: int, child: int) -> int:
        """A new node of ``depth`` over ``child``."""
        node = len(self.depth)
        for column, value in ((self.depth, depth), (self.low, self.low[child]), (self.high, 0), (self.row, -1), (self.n, 0), (self.first, self.first[child]), (self.leaves, 0), (self.kids, 0), (self.saved, 0), (self.up, -1)):
            column.append(value)
        self._attach(node, child)
        return node

    def _own(self, node: int, above: int, depth: int | None = None) -> int:
        """Saved bytes of the node's prefixes deeper than ``above``. What is open to the left has its one unsaved copy there."""
        at, depth = self.bytes[self.low[node]], self.depth[node] if depth is None else depth
        kept = (self.n[node] - 1) * int(at[depth] - at[above])
        return kept + (int(at[min(depth, self.left)] - at[above]) if self.low[node] == 0 and self.left > above else 0)

    def _begun(self, node: int, depth: int) -> bool:
        """Whether the prefix has its first string in this part."""
        return self.low[node] > 0 or depth > self.left

    def _open(self, node: int, depth: int) -> bool:
        return not self._begun(node, depth) or self.high[node] == self.m - 1 and depth <= self.right

    def _attach(self, node: int, child: int) -> None:
        above = self.depth[node]
        self.up[child] = node
        self.kids[node] += self._begun(child, above + 1)
        self.saved[node] += self.saved[child] + self._own(child, above)
        self.n[node] += self.n[child]
        self.first[node] = min(self.first[node], self.first[child])
        self.leaves[node] += self.leaves[child]
        self.high[node] = self.high[child]

    def rows(self, part: int, ends: list[str]) -> Iterator[tuple]:
        """A row of ``NODE`` for every prefix, those between branching nodes too."""
        heads, tails = _path_keys(self.seqs[0], self.left), _path_keys(self.seqs[-1], self.right)
        for node in range(len(self.depth)):
            up, deep = self.up[node], self.depth[node]
            above = self.depth[up] if up >= 0 else -1
            for d in range(above + 1, deep + 1):
                parent = node if d - 1 > above else up
                is_open, parent_open = self._open(node, d), parent >= 0 and self._open(parent, d - 1)
                name = heads if self.low[node] == 0 and d <= self.left else tails
                over = heads if parent >= 0 and self.low[parent] == 0 and d - 1 <= self.left else tails
                below = self.kids[node] if d == deep else int(self._begun(node, d + 1))
                end = ends[self.row[node]] if d == deep and self.row[node] >= 0 else None
                yield (
                    part, name[d] if is_open else None, over[d - 1] if parent_open else None, d, self.first[node], self.first[parent] if parent >= 0 and not parent_open else None,
                    self.n[node], below, self.leaves[node], self.saved[node] + (self._own(node, d - 1) if d else 0), end,
                )


def _borders(sorted_rows: DataFrame) -> dict[int, tuple[int, int]]:
    """For each part the turns shared with the parts before and after: two numbers a part come to the driver."""

    def shared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            pairs = [(-1 if a is None else common_turns(bytes(a), bytes(b))) for a, b in zip(f["before"], f["low"])], [(-1 if b is None else common_turns(bytes(a), bytes(b))) for a, b in zip(f["high"], f["after"])]
            yield pd.DataFrame({"part": f["part"], "left": pairs[0], "right": pairs[1]})

    ends = sorted_rows.groupBy("part").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    near = ends.selectExpr("part", "low", "high", "lag(high) over (order by part) as before", "lead(low) over (order by part) as after")  # one row for each part
    return {r["part"]: (r["left"], r["right"]) for r in near.mapInPandas(shared, "part int, left int, right int").collect()}


def trie(strings: DataFrame, turns_per_part: int = 200_000) -> DataFrame:
    """All nodes of the trie of ``turn_strings``: conv_id, the least of its conversations; depth; parent_conv_id, that of its parent; n_convs;
    n_children; n_leaves, childless nodes in its subtree; saved_tokens, over its subtree the bytes of each node's last text for every
    conversation but one; ends_sha256, of the ids of conversations that end there, ascending and parted by commas.

    The root has depth 0, no parent and all conversations, those without turns among them; a table without conversations has no
    node. Equal conversations are one string with a count; a part holds about ``turns_per_part`` turns, one string at least.
    """
    spark = strings.sparkSession
    own, lasting = Scratch(spark), Scratch(spark)
    found = own.written(distinct_strings(strings), "strings")
    total = found.selectExpr("coalesce(sum(size(sizes) + 1), 0) as turns").first()["turns"]
    dealt = found.repartitionByRange(max(1, -(-total // turns_per_part)), "seq").sortWithinPartitions("seq")
    parts = own.written(dealt.withColumn("part", F.spark_partition_id()), "parts")
    borders = _borders(parts)
    types = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]
    names = [c.split(" ")[0] for c in NODE.split(", ")]

    def grown(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("seq", "sizes", "n", "first_id", "ends"))))
        seqs, sizes, counts, ids, ends = (list(c) for c in zip(*rows))
        nodes = Forest(seqs, sizes, counts, ids, *borders[part]).rows(part, ends)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes), types)], names)

    nodes = lasting.written(parts.groupBy("part").applyInArrow(grown, NODE), "nodes")
    own.drop()
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    pieces = nodes.where("key is not null")
    merged = lasting.written(pieces.groupBy("key").agg(F.min("parent_key").alias("parent_key"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256")), "open")
    named = merged.selectExpr("key as parent_key", "conv_id as parent_conv_id")
    upper = merged.join(named, "parent_key", "left")
    # each part has its own copy of the names of its open nodes, so that the children of one node meet it in many tasks
    local = pieces.select("part", "key").join(merged.select("key", "conv_id"), "key").selectExpr("part", "key as parent_key", "conv_id as parent_conv_id")
    closed = nodes.where("key is null")
    lower = closed.where("parent_key is not null").drop("parent_conv_id").join(local, ["part", "parent_key"])
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")]
    return closed.where("parent_key is null").select(*columns).unionByName(lower.select(*columns)).unionByName(upper.select(*columns))
