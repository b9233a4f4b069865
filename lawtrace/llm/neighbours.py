"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

Vectors are scaled to the unit ball and completed to unit length in one more coordinate, so that the largest inner
product is the largest cosine. A pseudo-rotation is three rounds of random signs and a fast Hadamard transform, and hashes
a vector to its nearest signed axis. A table's bucket joins the axes of ``depth`` rotations, as many as leave about 64
vectors or fewer in a bucket; a query probes the buckets whose axes have the largest summed coordinates, about
``effort * sqrt(n)`` vectors in each table. All inner products of a probed bucket are computed and only each query's best stay.
"""

from __future__ import annotations

from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.storage import Scratch


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the orthonormal Hadamard matrix, in n log n steps each; n is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


class CrossPolytope:
    """The tables' pseudo-rotations; equal parameters give equal tables in every task."""

    def __init__(self, dim: int, tables: int, depth: int, seed: int, longest: float, shortest: float):
        self.dim, self.longest, self.equal = dim, longest, shortest >= longest * (1 - 1e-6)
        self.width = 1 << (dim - self.equal).bit_length()  # with room for the completing coordinate, if lengths differ
        self.axes, self.depth, self.tables = 2 * self.width, depth, tables
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, depth, 3, self.width))

    def _axes(self, x: np.ndarray, table: int, level: int) -> np.ndarray:
        for s in self.signs[table, level]:
            x = hadamard(x * s)
        return np.concatenate([x, -x], axis=1)

    def _placed(self, x: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        size = np.linalg.norm(x, axis=1)
        out[:, : self.dim] = x / (size[:, None] if query else self.longest)
        if not query and not self.equal:
            out[:, self.dim] = np.sqrt(np.clip(1 - (size / self.longest) ** 2, 0, None))
        return out

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        """The nearest signed axis of every level, as digits of one number."""
        x, out = self._placed(x, query=False), np.zeros(len(x), np.int64)
        for level in range(self.depth):
            out = out * self.axes + self._axes(x, table, level).argmax(axis=1)
        return out

    def probes(self, x: np.ndarray, table: int, n: int) -> np.ndarray:
        """``[rows, n]``: the n buckets of the largest summed coordinates. A bucket is among them only if its first
        levels are among the n best of those, so the levels are joined one by one."""
        x = self._placed(x, query=True)
        score, code = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for level in range(self.depth):
            joined = (len(x), score.shape[1] * self.axes)
            score = (score[:, :, None] + self._axes(x, table, level)[:, None, :]).reshape(joined)
            code = (code[:, :, None] * self.axes + np.arange(self.axes)).reshape(joined)
            keep = np.argsort(-score, axis=1, kind="stable")[:, :n]
            score, code = np.take_along_axis(score, keep, 1), np.take_along_axis(code, keep, 1)
        return code


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` without null or zero vectors and those holding null or non-finite components."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return v.where("v is not null and vec_id is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")


def nearest(vectors: DataFrame, query_condition: str, k: int = 20, tables: int = 32, effort: float = 0.55, seed: int = 11, block: int = 16384, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for rows meeting ``query_condition`` (SQL on vec_id) their k nearest found.

    Nearest is the largest inner product in double precision, ties to the smaller id; rows with a query's own id are no
    candidates of it. Rows of ``usable`` take part; vectors meet those of their own dimension, in one search for each.
    There is no cap: every vector of a probed bucket is scored. The few queries whose probed buckets together hold fewer
    than k other rows are asked again with all buckets of one table, so no result is short while rows are left. An empty
    table has no result; of repeated rows with one id and vector a query names the id once.
    """
    rows = usable(vectors, id_col, vector_col)
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    length = F.expr("sqrt(aggregate(v, 0D, (a, x) -> a + x * x))")
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(length).alias("longest"), F.min(length).alias("shortest")).orderBy("dim").collect()
    found = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for s in sizes:  # one row for each dimension, commonly a single one
        own = rows.where(F.size("v") == s["dim"]).withColumn("is_query", F.expr(query_condition))
        found = found.unionByName(_of_one_dimension(own, s, k, tables, effort, seed, block, kind))
    return found


def _of_one_dimension(rows: DataFrame, size, k: int, tables: int, effort: float, seed: int, block: int, kind: str) -> DataFrame:
    axes = CrossPolytope(size["dim"], 1, 1, seed, size["longest"], size["shortest"]).axes
    depth = max(1, ceil(log(max(size["n"] / 64, 1)) / log(axes)))
    probes = min(axes**depth, ceil(effort * size["n"] ** 0.5 * axes**depth / size["n"]) + (depth == 1))
    own = Scratch(rows.sparkSession)
    found = Scratch(rows.sparkSession).written(_probed(rows, CrossPolytope(size["dim"], tables, depth, seed, size["longest"], size["shortest"]), k, probes, block, kind), "neighbours")
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).where(f"n >= {k}").select(F.col("query_id").alias("vec_id"))
    short = own.written(rows.where("is_query").select("vec_id").distinct().join(full, "vec_id", "left_anti"), "short-queries")
    if short.isEmpty():
        own.drop()
        return found
    asked = rows.join(short.withColumn("asked", F.lit(True)), "vec_id", "left").withColumn("is_query", F.expr("is_query and asked is not null")).select(*rows.columns)
    again = Scratch(rows.sparkSession).written(_probed(asked, CrossPolytope(size["dim"], 1, 1, seed, size["longest"], size["shortest"]), k, axes, block, kind).unionByName(found.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi")), "neighbours")
    own.drop()
    return again


def _probed(rows: DataFrame, polytope: CrossPolytope, k: int, probes: int, block: int, kind: str) -> DataFrame:
    """One search. Rows are dealt out by (table, all levels but the last): a group holds the buckets of all last axes, and a
    query comes to it once with the last axes that it probes there. Groups of more than ``block`` vectors or queries, as
    a hot vector makes them, are cut into blocks of each; what is broadcast is the number of blocks of those groups.
    Vectors of single precision are shuffled in it, which loses nothing.
    """
    spark, dim, axes, tables = rows.sparkSession, polytope.dim, polytope.axes, polytope.tables

    def parts(batches):
        """Ids, vectors and which rows ask, a thousand rows at a time."""
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                yield b.column("vec_id").to_numpy(), np.array(b.column("v").flatten().to_numpy(zero_copy_only=False), float).reshape(b.num_rows, dim), np.asarray(b.column("is_query").to_pylist(), bool)

    def asked_groups(near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of probed buckets [queries, n]: query, group, and the last axes of each such pair as (axes, offsets)."""
        who, code = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
        order = np.lexsort((code, who))
        who, code = who[order], code[order]
        new = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (code[1:] // axes != code[:-1] // axes))) if len(who) else np.zeros(0, np.int64)
        return who[new], code[new] // axes, (code % axes).astype(np.int32), np.append(new, len(who)).astype(np.int32)

    def counted(batches):
        for _, x, asks in parts(batches):
            for t in range(tables):
                held, n_held = np.unique(polytope.buckets(x, t) // axes, return_counts=True)
                group, n_asked = np.unique(asked_groups(polytope.probes(x[asks], t, probes))[1], return_counts=True)
                g = np.concatenate([held, group])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), t), pa.int32()), pa.array(g), pa.array(np.append(n_held, np.zeros(len(group), np.int64))), pa.array(np.append(np.zeros(len(held), np.int64), n_asked))], ["t", "g", "held", "asked"])

    picked = rows.select("vec_id", "v", "is_query")
    counts = picked.mapInArrow(counted, "t int, g long, held long, asked long").groupBy("t", "g").agg(F.sum("held").alias("held"), F.sum("asked").alias("asked")).where(f"held > {block} or asked > {block}").collect()
    large = {(r["t"], r["g"]): (-(-r["held"] // block) or 1, -(-r["asked"] // block) or 1) for r in counts}

    def blocks(t: int, groups: np.ndarray) -> np.ndarray:
        """``[groups, 2]``: blocks of vectors and of queries."""
        names, place = np.unique(groups, return_inverse=True)
        return np.array([large.get((t, int(g)), (1, 1)) for g in names], np.int64).reshape(-1, 2)[place]

    def dealt(batches):
        for ids, x, asks in parts(batches):
            mixed = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
            q = np.flatnonzero(asks)
            for t in range(tables):
                code = polytope.buckets(x, t)
                who, group, last, offsets = asked_groups(polytope.probes(x[q], t, probes))
                for asking, w, g, last_axes, bounds in ((False, np.arange(len(x)), code // axes, (code % axes).astype(np.int32), np.arange(len(x) + 1, dtype=np.int32)), (True, q[who], group, last, offsets)):
                    n = blocks(t, g)
                    mine, other = n[:, int(asking)], n[:, 1 - int(asking)]
                    part = (mixed[w] % mine.astype(np.uint64)).astype(np.int64)
                    at = np.repeat(np.arange(len(w)), other)  # once for every block of the other side
                    facing = np.arange(len(at)) - np.repeat(np.cumsum(other) - other, other)
                    pair = (facing, part[at]) if asking else (part[at], facing)
                    key = ((np.int64(t) * axes ** (polytope.depth - 1) + g[at]) << 36) | (pair[0] << 18) | pair[1]
                    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(last_axes)).take(pa.array(at))
                    flat = pa.array(x[w[at]].ravel(), pa.float32() if kind == "array<float>" else pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[w[at]]), pa.array(np.full(len(at), asking)), lists, pa.FixedSizeListArray.from_arrays(flat, dim).cast(pa.list_(flat.type))], ["key", "vec_id", "asks", "last", "v"])

    def best(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks = np.asarray(group.column("asks").to_pylist(), bool)
        x = np.concatenate([np.zeros(0), *(c.flatten().to_numpy() for c in group.column("v").chunks)]).astype(float).reshape(len(asks), -1) if len(asks) else np.zeros((0, dim))
        ids, lasts = group.column("vec_id").to_numpy(), group.column("last").to_pylist()
        at_q, at_c = np.flatnonzero(asks), np.flatnonzero(~asks)
        wanted: dict[int, list[int]] = {}
        for i in at_q.tolist():
            for a in lasts[i]:
                wanted.setdefault(a, []).append(i)
        own = np.array([lasts[i][0] for i in at_c.tolist()], np.int64)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for a in np.unique(own).tolist():
            c = at_c[own == a]
            for at in range(0, len(wanted.get(a, ())), 256):
                q = np.array(wanted[a][at : at + 256])
                rough = x[q] @ x[c].T
                rough[ids[q][:, None] == ids[c][None, :]] = -np.inf
                least = np.partition(rough, len(c) - min(k, len(c)), axis=1)[:, len(c) - min(k, len(c))] - 1e-9
                i, j = np.nonzero((rough >= np.where(np.isfinite(least), least, -np.finfo(float).max)[:, None]) & np.isfinite(rough))
                found.append((q[i], c[j], (x[q[i]] * x[c[j]]).sum(axis=1)))  # equal vectors get equal scores in any block
        q, c, score = (np.concatenate([f[n] for f in found]) for n in range(3))
        order = np.lexsort((ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        return pa.table({"query_id": ids[q[nth < k]], "vec_id": ids[c[nth < k]], "score": score[nth < k]})

    pairs = picked.mapInArrow(dealt, f"key long, vec_id long, asks boolean, last array<int>, v {kind}").groupBy("key").applyInArrow(best, "query_id long, vec_id long, score double")
    once = pairs.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.selectExpr("query_id", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank", "vec_id", "score")
    return ranked.where(f"rank <= {k}")
